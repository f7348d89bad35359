"""Weight of evidence and information value."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.columns import is_numeric, quoted, round_even, sql_double, value
from tabloom.functions.quantiles import exact_quantiles
from tabloom.functions.wide import chunks, melt, small_table
from tabloom.operators.profile import group_rare_values, value_table

COLUMNS_PER_SCAN = 100
SMOOTHING = 0.5
_COUNTS = "column string, kind string, bin string, low double, high double, bad double, good double"


def class_totals(df: DataFrame, target: str) -> tuple[float, float]:
    """Positive and negative labels of the whole slice."""
    y = quoted(target).cast("double")
    row = df.agg(F.coalesce(F.sum(y), F.lit(0.0)), F.coalesce(F.sum(1 - y), F.lit(0.0))).first()
    return float(row[0]), float(row[1])


def fit_quantile_edges(df: DataFrame, columns: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Distinct equal-frequency edges per numeric column; a constant column has a single one."""
    points = [Fraction(i, bins) for i in range(bins + 1)]
    found = exact_quantiles(df, columns, points)
    return {c: sorted({e for e in found[c] if e is not None}) for c in columns}


def bin_number(column: str, edges: Sequence[float]) -> Column:
    """1-based right-closed bin of a double column between ascending edges; the lowest edge is in bin 1."""
    if len(edges) < 2:
        return F.lit(None).cast("tinyint")
    name = "`" + column.replace("`", "``") + "`"
    steps = " ".join(f"WHEN {name} <= {sql_double(high)} THEN {i}Y" for i, high in enumerate(edges[1:], 1))
    return F.expr(f"CASE WHEN {name} < {sql_double(edges[0])} THEN NULL {steps} END")


def _numeric_counts(df: DataFrame, columns: Sequence[str], target: str, edges: dict[str, list[float]]) -> DataFrame:
    """Bin numbers are worked out before the table is made long, so only (column, bin, y) is grouped."""
    y = quoted(target).cast("double")
    parts = []
    for group in chunks(columns, COLUMNS_PER_SCAN):
        numbers = df.where(y.isNotNull()).select(
            y.alias("y"), *[value(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(group)]
        )
        binned = numbers.select("y", *[bin_number(f"v{i}", edges[c]).alias(c) for i, c in enumerate(group)])
        parts.append(
            melt(binned, group, "tinyint", [F.col("y")])
            .withColumnRenamed("value", "bin")
            .where(F.col("bin").isNotNull())
            .groupBy("column", "bin")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("y").alias("bad"))
        )
    bounds = [
        (c, i, edges[c][i - 1], edges[c][i]) for c in columns for i in range(1, len(edges[c]))
    ]
    table = small_table(df.sparkSession, bounds, "column string, bin tinyint, low double, high double")
    return (
        reduce(DataFrame.unionAll, parts)
        .join(F.broadcast(table), ["column", "bin"])
        .select(
            "column",
            F.lit("numeric").alias("kind"),
            F.col("bin").cast("string").alias("bin"),
            "low",
            "high",
            "bad",
            (F.col("rows") - F.col("bad")).alias("good"),
        )
    )


def _categorical_counts(df: DataFrame, columns: Sequence[str], target: str, max_categories: int) -> DataFrame:
    per_value = value_table(df.where(quoted(target).isNotNull()), columns, target=target)
    return (
        group_rare_values(per_value, max_categories)
        .groupBy("column", F.col("category").alias("bin"))
        .agg(F.sum("bad").cast("double").alias("bad"), F.sum("count").cast("double").alias("rows"))
        .select(
            "column",
            F.lit("categorical").alias("kind"),
            "bin",
            F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
            "bad",
            (F.col("rows") - F.col("bad")).alias("good"),
        )
    )


def woe_table(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    target: str = "target",
    bins: int = 10,
    max_categories: int = 50,
    totals: tuple[float, float] | None = None,
) -> DataFrame:
    """(column, kind, bin, low, high, bad, good, woe, iv), one row per bin.

    Numeric columns are cut at their deciles, others by value with rare values as
    one bin. Half a row is added to both classes of a bin; the shares are taken over
    the labels of the whole slice, rows with a missing value included.
    """
    columns = [c for c in (columns or df.columns) if c != target]
    numeric = [c for c in columns if is_numeric(df, c)]
    other = [c for c in columns if c not in numeric]
    total_bad, total_good = totals or class_totals(df, target)
    parts = []
    if numeric:
        labelled = df.where(quoted(target).isNotNull())
        edges = fit_quantile_edges(labelled, numeric, bins)
        parts.append(_numeric_counts(df, numeric, target, edges))
    if other:
        parts.append(_categorical_counts(df, other, target, max_categories))
    counts = reduce(DataFrame.unionAll, parts) if parts else small_table(df.sparkSession, [], _COUNTS)
    share_bad = (F.col("bad") + SMOOTHING) / F.nullif(F.lit(total_bad), F.lit(0.0))
    share_good = (F.col("good") + SMOOTHING) / F.nullif(F.lit(total_good), F.lit(0.0))
    woe = F.ln(share_good / share_bad)
    return counts.withColumns({"woe": woe, "iv": (share_good - share_bad) * woe})


def iv_label(iv: Column) -> Column:
    return (
        F.when(iv < 0.02, "weak")
        .when(iv < 0.1, "low")
        .when(iv < 0.3, "medium")
        .when(iv < 0.5, "strong")
        .otherwise("very_strong")
    )


def information_value(
    df: DataFrame, columns: Sequence[str] | None = None, *, target: str = "target", **options
) -> DataFrame:
    """(column, iv, label, kind) per feature, largest first; iv is rounded to four decimals.

    A feature without a usable bin (empty or constant) has iv 0.
    """
    columns = [c for c in (columns or df.columns) if c != target]
    kinds = [(c, "numeric" if is_numeric(df, c) else "categorical") for c in columns]
    listed = small_table(df.sparkSession, kinds, "column string, kind string")
    sums = woe_table(df, columns, target=target, **options).groupBy("column").agg(F.sum("iv").alias("raw"))
    raw = F.coalesce("raw", F.lit(0.0))
    return (
        listed.join(F.broadcast(sums), "column", "left")
        .select("column", round_even(raw, 4).alias("iv"), iv_label(raw).alias("label"), "kind")
        .orderBy(F.desc("iv"), "column")
    )
