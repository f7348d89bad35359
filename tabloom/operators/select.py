"""The single steps of the feature-selection funnel.

A step looks at the train slice, returns the columns to drop in candidate order,
and, where it scores columns, the score table. Only per-column results reach
the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tabloom.functions.columns import is_numeric, value
from tabloom.functions.lineage import materialize
from tabloom.functions.wide import column_report, small_table
from tabloom.operators.correlation import correlation_table


# Two columns that are multiples of each other differ in the last bits only: a tie.
TIE = 1e-9
# Pairs that the driver may look at one by one.
MAX_PAIRS = 100_000


def column_health(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, missing_ratio, variance): the inputs of the first two steps, from one scan."""
    report = column_report(
        df,
        columns,
        lambda c: {
            "missing": F.count_if(value(df, c).isNull()),
            # Infinite values have no variance: NaN counts as missing.
            "variance": F.nanvl(F.var_samp(value(df, c).cast("double")), F.lit(None))
            if is_numeric(df, c)
            else F.max(F.lit(None).cast("double")),
        },
        "missing bigint, variance double",
    )
    ratio = F.try_divide(F.col("missing").cast("double"), F.col("rows").cast("double"))
    return (
        report.select("column", ratio.alias("missing_ratio"), "variance", "position").orderBy("position").drop("position")
    )


def drop_by_missing(health: Sequence[Mapping], threshold: float = 0.95) -> list[str]:
    return [r["column"] for r in health if r["missing_ratio"] is not None and r["missing_ratio"] > threshold]


def drop_by_variance(health: Sequence[Mapping], numeric: Sequence[str], threshold: float = 0.01) -> list[str]:
    """Numeric columns whose sample variance is missing or small; other columns pass."""
    return [
        r["column"]
        for r in health
        if r["column"] in set(numeric) and (r["variance"] is None or r["variance"] < threshold)
    ]


def select_by_missing(df: DataFrame, columns: Sequence[str], *, threshold: float = 0.95) -> list[str]:
    return drop_by_missing(column_health(df, columns).collect(), threshold)


def select_by_variance(df: DataFrame, columns: Sequence[str], *, threshold: float = 0.01) -> list[str]:
    numeric = [c for c in columns if is_numeric(df, c)]
    return drop_by_variance(column_health(df, numeric).collect(), numeric, threshold)


def select_by_correlation(
    df: DataFrame, columns: Sequence[str], *, target: str = "target", threshold: float = 0.95
) -> list[str]:
    """Of each pair above the threshold drop the column less correlated with the target.

    Pairs are visited in column order and a pair with a column already dropped is
    passed over. When a target correlation is undefined the first column goes.
    Only names reach the driver, and pairs once there are at most MAX_PAIRS.
    """
    numeric = [c for c in columns if is_numeric(df, c) and c != target]
    with_target = target in df.columns
    pairs = correlation_table(df, [*numeric, target] if with_target else numeric)
    strong = materialize(pairs.where((F.abs("correlation") > threshold) | (F.col("right") == F.lit(target))), "strong-pairs")
    strength = {}
    if with_target:
        own = strong.where(F.col("right") == F.lit(target)).select("left", "correlation").collect()
        strength = {r["left"]: r["correlation"] for r in own}
    places = small_table(
        df.sparkSession,
        [(c, i, strength.get(c)) for i, c in enumerate(numeric)],
        "column string, place int, strength double",
    )

    def side(name: str, place: str) -> DataFrame:
        return F.broadcast(places.select(F.col("column").alias(name), F.col("place").alias(place), F.col("strength").alias(f"s{place}")))

    edges = strong.where(F.abs("correlation") > threshold)
    if with_target:
        edges = edges.where(F.col("right") != F.lit(target))
    keeps_left = F.lit(True)
    if with_target:
        keeps_left = F.coalesce(F.abs("si") >= F.abs("sj") - TIE, F.lit(False))
    edges = edges.join(side("left", "i"), "left").join(side("right", "j"), "right")
    edges = edges.select("i", "j", F.when(keeps_left, F.col("j")).otherwise(F.col("i")).alias("loser"))
    dropped = {numeric[i] for i in ordered_losers(edges)}
    return [c for c in columns if c in dropped]


def ordered_losers(edges: DataFrame, max_pairs: int | None = None) -> set[int]:
    """Losers of the edges (i, j, loser) with i < j, visited by (i, j); an edge of one that has lost is passed over.

    In each round an edge decides if no open edge before it can touch its ends: none that ends in i, none
    that ends in j from a smaller i, and of those that start in i only such as i wins and that decide in
    this round too. So the first open edge always does, and one node that beats all others is one round.
    """
    limit = MAX_PAIRS if max_pairs is None else max_pairs
    lost: set[int] = set()
    edges = materialize(edges, "edges")
    while edges.count() > limit:
        ends = edges.groupBy(F.col("j").alias("node")).agg(F.min("i").alias("first"))
        # One row for each column.
        ends = F.broadcast(ends)
        open_ = edges.join(ends.withColumnRenamed("node", "j"), "j").join(
            ends.select(F.col("node").alias("i"), F.lit(True).alias("waits")), "i", "left"
        )
        ready = F.col("waits").isNull() & (F.col("first") == F.col("i"))
        before = W.partitionBy("i").orderBy("j").rowsBetween(W.unboundedPreceding, -1)
        stopped = F.max(~F.col("ready") | (F.col("loser") == F.col("i"))).over(before)
        decided = open_.withColumn("ready", ready).withColumn("stopped", F.coalesce(stopped, F.lit(False)))
        now = [r["loser"] for r in decided.where("ready and not stopped").select("loser").distinct().collect()]
        lost |= set(now)
        gone = F.broadcast(small_table(edges.sparkSession, [(n,) for n in now], "gone int"))
        edges = edges.join(gone, F.col("i") == F.col("gone"), "left_anti").join(gone, F.col("j") == F.col("gone"), "left_anti")
        edges = materialize(edges, "edges")
    for r in edges.orderBy("i", "j").collect():
        if r["i"] not in lost and r["j"] not in lost:
            lost.add(r["loser"])
    return lost


def drop_by_iv(scores: Sequence[Mapping], threshold: float = 0.02) -> list[str]:
    """Columns whose rounded information value is below the threshold."""
    return [r["column"] for r in scores if r["iv"] < threshold]


def linear_quantile(values: Sequence[float], p: float) -> float:
    """Linear-interpolation quantile of a few driver-side scores."""
    ordered = sorted(values)
    at = p * (len(ordered) - 1)
    low = int(at)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (at - low)


def drop_by_importance(scores: Sequence[Mapping], percentile: float = 0.25) -> list[str]:
    """Columns without importance, and those at or below the percentile of the rest."""
    positive = [r["importance"] for r in scores if r["importance"] > 0]
    cut = linear_quantile(positive, percentile) if positive else 0.0
    return [r["column"] for r in scores if r["importance"] <= cut]


def drop_by_permutation(scores: Sequence[Mapping], threshold: float = 0.0005) -> list[str]:
    return [r["column"] for r in scores if r["importance_mean"] <= threshold]
