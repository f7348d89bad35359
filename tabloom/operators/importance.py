"""Feature importance from boosted trees and from permutation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window as W, functions as F

from tabloom.functions.columns import quoted, value
from tabloom.functions.lineage import materialize
from tabloom.functions.wide import aggregate_row, small_table
from tabloom.operators.boosting import split_gains
from tabloom.operators.clean import fit_fill_values
from tabloom.operators.sampling import row_hash, sample_rows
from tabloom.operators.target import add_class_weight, class_weights

MISSING = "_MISSING"
#: Distinct rows that trees read instead of all: so many Spark takes in whole to find its splits.
DISTINCT_ROWS = 10_000


@dataclass
class Inputs:
    """Numeric columns made ready for trees: gaps take the median and get a flag column."""

    columns: list[str]
    medians: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fit(cls, train: DataFrame, columns: Sequence[str]) -> "Inputs":
        gaps = aggregate_row(train, {c: F.count_if(value(train, c).isNull()) for c in columns})
        return cls(list(columns), fit_fill_values(train, [c for c in columns if gaps[c]]))

    @property
    def names(self) -> list[str]:
        return self.columns + [c + MISSING for c in self.medians]

    def apply(self, df: DataFrame, *keep: str) -> DataFrame:
        filled = [
            F.coalesce(value(df, c).cast("double"), F.lit(self.medians.get(c, 0.0))).alias(c) for c in self.columns
        ]
        flags = [value(df, c).isNull().cast("double").alias(c + MISSING) for c in self.medians]
        return df.select(*[quoted(k) for k in keep], *filled, *flags)


def tree_importance(
    train: DataFrame,
    columns: Sequence[str],
    *,
    target: str = "target",
    trees: int = 200,
    step: float = 0.05,
    depth: int = 5,
    seed: int = 42,
) -> DataFrame:
    """(column, importance) from gradient boosted trees on class-balanced rows, largest first.

    The importance of a column's missing flag counts for the column. Nothing is drawn, so
    ``seed`` makes no difference.
    """
    # The fills, the weights, the bins and the codes of the rows each read these columns.
    stored = materialize(train.select(*[quoted(c) for c in dict.fromkeys([target, *columns])]), "tree-input")
    inputs = Inputs.fit(stored, columns)
    labelled = stored.where(quoted(target).isNotNull())
    weights = {r["class"]: r["weight"] for r in class_weights(labelled, target=target).collect()}
    rows, copies = _merged(inputs.apply(labelled, target))
    shares = split_gains(
        rows, inputs.names, weights, label=target, copies=copies, trees=trees, step=step, depth=depth
    )
    scores = dict.fromkeys(columns, 0.0)
    for name, score in zip(inputs.names, shares):
        scores[name if name in scores else name.removesuffix(MISSING)] += score
    return small_table(train.sparkSession, list(scores.items()), "column string, importance double"
    ).orderBy(F.desc("importance"), "column")


def _merged(rows: DataFrame) -> tuple[DataFrame, str | None]:
    """Rows that agree in everything as one row with their number, if at most DISTINCT_ROWS are left.

    To trees these are the same: a split weighs rows, and equal rows always fall on the same side.
    """
    names = [quoted(c) for c in rows.columns]
    seen = F.approx_count_distinct(F.xxhash64(*names))
    # The estimate is off by a few percent; the count decides.
    if rows.agg(seen).first()[0] > 1.2 * DISTINCT_ROWS:
        return rows, None
    groups = materialize(rows.groupBy(*names).agg(F.count("*").alias("_rows")), "tree-input")
    return (groups.coalesce(1), "_rows") if groups.count() <= DISTINCT_ROWS else (rows, None)


def stratified_sample(df: DataFrame, size: int, *, target: str = "target", seed: int = 42) -> DataFrame:
    """``size`` rows with the class shares of ``df``; all rows when there are no more.

    Of each class the rows with the smallest hashes are drawn, see :func:`sample_rows`.
    """
    counts = {
        r[0]: r[1] for r in df.where(quoted(target).isNotNull()).groupBy(quoted(target)).count().collect()
    }
    total = sum(counts.values())
    if total <= size:
        return df.where(quoted(target).isNotNull())
    parts = None
    for label, n in sorted(counts.items()):
        quota = round(size * n / total)
        rows = sample_rows(df.where(quoted(target) == label), quota, seed=seed)
        parts = rows if parts is None else parts.unionAll(rows)
    return parts


def grouped_auc(scored: DataFrame, groups: Sequence[str]) -> DataFrame:
    """ROC AUC per group from (score, label) rows, ties counted half.

    Equal scores are merged first, so the window sees distinct scores only.
    """
    label = F.col("label")
    ties = scored.groupBy(*groups, "score").agg(
        F.count_if(label == 1).alias("pos"), F.count_if(label == 0).alias("neg")
    )
    before = W.partitionBy(*groups).orderBy("score").rowsBetween(W.unboundedPreceding, -1)
    won = F.col("pos") * (F.coalesce(F.sum("neg").over(before), F.lit(0)) + F.col("neg") / 2)
    return (
        ties.withColumn("_won", won)
        .groupBy(*groups)
        .agg(
            F.try_divide(F.sum("_won"), (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc")
        )
    )


def permutation_importance(
    train: DataFrame,
    columns: Sequence[str],
    *,
    target: str = "target",
    sample_size: int = 50_000,
    repeats: int = 5,
    trees: int = 50,
    depth: int = 10,
    seed: int = 42,
) -> DataFrame:
    """(column, importance_mean, importance_std): loss of AUC when a column is shuffled, largest first.

    A balanced random forest is fitted on a stratified sample of at most
    ``sample_size`` rows. Per repeat one donor join on shuffled row numbers gives
    every column its shuffled value; all columns and repeats are scored in one job.
    The sample bounds every window and join here, whatever the size of the table.
    """
    columns = list(columns)
    inputs = Inputs.fit(train, columns)
    sampled = stratified_sample(train.select(*[quoted(c) for c in [target, *columns]]), sample_size, target=target, seed=seed)
    # Drawn once: both the weights and the rows come from it.
    sampled = materialize(sampled, "permutation-rows")
    weights = {r["class"]: r["weight"] for r in class_weights(sampled, target=target).collect()}
    rows = add_class_weight(inputs.apply(sampled, target), weights, target=target, name="_weight")
    numbered = materialize(
        rows.select(
            F.row_number().over(W.partitionBy(F.lit(0)).orderBy(row_hash(rows, seed=seed))).alias("id"),
            quoted(target).cast("double").alias("label"),
            "_weight",
            F.array(*[quoted(c) for c in inputs.names]).alias("x"),
        ),
        "permutation-sample",
    )
    model = RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="_weight", numTrees=trees, maxDepth=depth, seed=seed
    ).fit(numbered.select("label", "_weight", array_to_vector("x").alias("features")))

    def score(frame: DataFrame, *keep: str) -> DataFrame:
        vectors = frame.select(*keep, "label", array_to_vector("x").alias("features"))
        return model.transform(vectors).select(*keep, "label", vector_to_array("probability")[1].alias("score"))

    baseline = grouped_auc(score(numbered.withColumn("all", F.lit(0)), "all"), ["all"]).first()["auc"]

    # A row's place in a seeded hash order is a permutation of the row numbers.
    shuffled = (
        numbered.select("id", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"))
        .withColumn(
            "donor",
            F.row_number().over(
                W.partitionBy("repeat").orderBy(F.xxhash64(F.lit(seed), F.col("repeat"), F.col("id")), "id")
            ),
        )
    )
    donors = numbered.select(F.col("id").alias("donor"), F.col("x").alias("z"))
    # A column and its missing flag are shuffled together.
    parts = F.array(
        *[
            F.array(*[F.lit(i) for i, n in enumerate(inputs.names) if n in (c, c + MISSING)])
            for c in columns
        ]
    )
    replaced = F.transform(
        "x",
        lambda v, i: F.when(F.array_contains("part", i), F.get(F.col("z"), i)).otherwise(v),
    )
    scored = score(
        numbered.join(shuffled, "id")
        .join(donors, "donor")
        .select("repeat", "label", "x", "z", F.posexplode(parts).alias("feature", "part"))
        .select("repeat", "feature", "label", replaced.alias("x")),
        "repeat",
        "feature",
    )
    loss = grouped_auc(scored, ["feature", "repeat"]).withColumn("loss", F.lit(baseline) - F.col("auc"))
    names = F.array(*[F.lit(c) for c in columns])
    return (
        loss.groupBy("feature")
        .agg(F.avg("loss").alias("importance_mean"), F.stddev_pop("loss").alias("importance_std"))
        .select(F.get(names, F.col("feature")).alias("column"), "importance_mean", "importance_std")
        .orderBy(F.desc("importance_mean"), "column")
    )
