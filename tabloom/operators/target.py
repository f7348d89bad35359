"""Binary target and the time-based, stratified and random splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabloom.functions.columns import quoted
from tabloom.operators.profile import target_distribution
from tabloom.operators.sampling import below, class_sizes, hash_thresholds, row_hash
from tabloom.functions.wide import small_table


def make_binary_target(
    df: DataFrame,
    column: str,
    positive: Sequence[str],
    negative: Sequence[str],
    ignore: Sequence[str] = (),
    *,
    name: str = "target",
) -> DataFrame:
    """Drop ignored rows, map the rest to 1 and 0, drop what maps to neither.

    A value in both lists is positive. A missing column is an error here;
    :func:`target_summary` reports it as not passed.
    """
    status = quoted(column)
    label = F.when(status.isin(list(positive)), 1).when(status.isin(list(negative)), 0)
    kept = df
    if ignore:
        kept = kept.where(status.isNull() | ~status.isin(list(ignore)))
    return kept.withColumn(name, label.cast("tinyint")).where(quoted(name).isNotNull())


def target_summary(
    df: DataFrame,
    column: str,
    positive: Sequence[str],
    negative: Sequence[str],
    ignore: Sequence[str] = (),
) -> DataFrame:
    """One row: passed, class counts, positive rate and balance."""
    if column not in df.columns:
        return small_table(df.sparkSession, [(False, None, None, None, None)],
            "passed boolean, positive bigint, negative bigint, positive_rate_pct double, balance string",
        )
    labelled = make_binary_target(df, column, positive, negative, ignore)
    return target_distribution(labelled).select(F.lit(True).alias("passed"), "*")


def target_values(
    df: DataFrame,
    column: str,
    positive: Sequence[str],
    negative: Sequence[str],
    ignore: Sequence[str] = (),
) -> DataFrame:
    """Every value of the status column with its count and the role it plays; NULL is a value."""
    status = quoted(column)
    role = (
        F.when(status.isin(list(ignore)) if ignore else F.lit(False), "ignored")
        .when(status.isin(list(positive)), "positive")
        .when(status.isin(list(negative)), "negative")
        .otherwise("unexpected")
    )
    return (
        df.groupBy(status.alias("value"), role.alias("role"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "value")
    )


def split_label(year: Column, *, train_until: int, val_year: int, test_year: int) -> Column:
    """`train`, `val`, `test` or NULL for a year outside every slice."""
    return (
        F.when(year <= train_until, "train").when(year == val_year, "val").when(year == test_year, "test")
    )


def split_by_year(
    df: DataFrame, year: str, *, train_until: int, val_year: int, test_year: int, name: str = "split"
) -> DataFrame:
    """Label each row. Slices are filters on the label; write with ``partitionBy`` to prune files."""
    label = split_label(quoted(year), train_until=train_until, val_year=val_year, test_year=test_year)
    return df.withColumn(name, label)


def take_split(df: DataFrame, which: str, *, name: str = "split") -> DataFrame:
    return df.where(quoted(name) == which).drop(name)


def split_report(df: DataFrame, *, target: str = "target", name: str = "split") -> DataFrame:
    """Rows and positive rate per slice."""
    return (
        df.where(quoted(name).isNotNull())
        .groupBy(quoted(name).alias("split"))
        .agg(F.count(F.lit(1)).alias("rows"), (F.avg(quoted(target)) * 100).alias("positive_rate_pct"))
        .orderBy("split")
    )


def _split(
    df: DataFrame, keys: Sequence[str], by: str | None, test_size: float, val_size: float, seed: int, name: str
) -> DataFrame:
    """Label the rows of each class by their hash: the first go to test, the next to val, the others to train."""
    hash_ = row_hash(df, [by, *keys] if by else list(keys), seed)
    sizes = class_sizes(df, by) if by else {None: df.count()}
    rows = df.select((quoted(by) if by else F.lit(None).cast("string")).alias("class"), hash_.alias("hash"))

    def rounded(share: float, n: int) -> int:
        return int(share * n + 0.5 + 1e-9)

    ranks = {c: [rounded(test_size, n), rounded(test_size, n) + rounded(val_size, n)] for c, n in sizes.items()}
    label = None
    for value, (test, val) in hash_thresholds(rows, ranks).items():
        own = quoted(by).eqNullSafe(F.lit(value)) if by else F.lit(True)
        cut = F.when(below(F.col("_hash"), test), "test").when(below(F.col("_hash"), val), "val").otherwise("train")
        label = F.when(own, cut) if label is None else label.when(own, cut)
    # A NULL class is a class like any other.
    return df.withColumn("_hash", hash_).withColumn(name, F.lit("train") if label is None else label).drop("_hash")


def split_random(
    df: DataFrame,
    keys: Sequence[str],
    *,
    test_size: float = 0.20,
    val_size: float = 0.10,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Split by a hash of the key columns into exactly the rounded shares.

    The same table gives the same slices in any order. Nothing is shuffled: counts of hash
    prefixes give the two thresholds, and rows that repeat a key at one of them stay together.
    """
    return _split(df, keys, None, test_size, val_size, seed, name)


def split_stratified(
    df: DataFrame,
    keys: Sequence[str],
    *,
    target: str = "target",
    test_size: float = 0.20,
    val_size: float = 0.10,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """The same shares within every class, each rounded to whole rows; see :func:`split_random`."""
    return _split(df, keys, target, test_size, val_size, seed, name)


def class_weights(df: DataFrame, *, target: str = "target") -> DataFrame:
    """(class, rows, weight) with weight = rows / (classes * rows in class)."""
    counts = (
        df.where(quoted(target).isNotNull())
        .groupBy(quoted(target).alias("class"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    # One row per class by now, so a window over all of them is tiny.
    everything = W.partitionBy(F.lit(0))
    total, classes = F.sum("rows").over(everything), F.count(F.lit(1)).over(everything)
    return counts.select("class", "rows", (total / (classes * F.col("rows"))).alias("weight")).orderBy("class")


def add_class_weight(df: DataFrame, weights: dict[int, float], *, target: str = "target", name: str = "weight") -> DataFrame:
    chain = None
    for label, weight in weights.items():
        test = quoted(target) == label
        chain = F.when(test, F.lit(float(weight))) if chain is None else chain.when(test, F.lit(float(weight)))
    return df.withColumn(name, chain if chain is not None else F.lit(None).cast("double"))
