"""Profiles: missing values, numeric shape, categories, target rates, counts.

Each profile is one scan that Spark aggregates partially in every task. The
long (column, value) groupings combine equal values before the shuffle, so one
value that fills a third of the table costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabloom.functions.columns import (
    KEY_BYTES,
    key_column,
    numeric_columns,
    percent_of,
    present,
    quoted,
    round_even,
    string_columns,
    text_key,
    value,
)
from tabloom.functions.quantiles import exact_quantiles
from tabloom.functions.wide import column_report, melt, small_table


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(position, column, rows, missing) per column."""
    names = list(df.columns if columns is None else columns)
    return column_report(
        df, names, lambda c: {"missing": F.count_if(value(df, c).isNull())}, "missing bigint"
    )


def raw_profile(df: DataFrame) -> DataFrame:
    """Rows, column count and the missing ratio (0 to 1) per column, largest ratio first."""
    return profile_of_counts(missing_counts(df), len(df.columns))


def profile_of_counts(counts: DataFrame, columns: int) -> DataFrame:
    """The raw profile from (column, rows, missing)."""
    ratio = F.try_divide(F.col("missing").cast("double"), F.col("rows").cast("double"))
    return counts.select(
        "column", "rows", F.lit(columns).alias("columns"), "missing", ratio.alias("missing_ratio")
    ).orderBy(F.desc("missing_ratio"), "column")


def missing_profile(df: DataFrame, *, drop_above: float = 0.60, flag_above: float = 0.20) -> DataFrame:
    """Columns with missing values, their share in percent and the strategy it calls for.

    The strategy looks at the share after rounding to two decimals, so a handful of
    missing cells in a huge table is listed as COMPLETE.
    """
    catalog = small_table(
        df.sparkSession,
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields],
        "column string, type string",
    )
    share = F.col("missing_pct")
    strategy = (
        F.when(share > drop_above * 100, "DROP")
        .when(share > flag_above * 100, "FLAG+MEDIAN")
        .when(share > 0, "MEDIAN/MODE")
        .otherwise("COMPLETE")
    )
    return (
        missing_counts(df)
        .where(F.col("missing") > 0)
        .join(F.broadcast(catalog), "column")
        .withColumn("missing_pct", round_even(percent_of(F.col("missing"), F.col("rows")), 2))
        .select("column", "type", "missing", "missing_pct", strategy.alias("strategy"))
        .orderBy(F.desc("missing_pct"), "column")
    )


def top_missing(df: DataFrame, k: int = 10, **thresholds) -> DataFrame:
    return missing_profile(df, **thresholds).limit(k)


def null_total(df: DataFrame) -> DataFrame:
    """One row: all missing cells of the table."""
    return missing_counts(df).agg(F.sum("missing").alias("missing_cells"))


def adjusted_skewness(population: Column, n: Column) -> Column:
    """Bias-adjusted skewness; NULL below three values, 0 for a constant."""
    size = n.cast("double")
    factor = F.sqrt(size * (size - 1)) / F.nullif(size - 2, F.lit(0.0))
    return F.when(n >= 3, F.coalesce(population * factor, F.lit(0.0)))


def numeric_profile(df: DataFrame, *, target: str = "target", columns: Sequence[str] | None = None) -> DataFrame:
    """Location, spread, quartiles, skewness and outlier share of each numeric column.

    The quartiles come from :func:`exact_quantiles`; they are literals in the second
    pass, which computes everything else in one aggregate. Columns without a value
    are left out.
    """
    names = [c for c in (columns or numeric_columns(df)) if c != target]
    quartiles = exact_quantiles(df, names, [0.25, 0.5, 0.75])
    names = [c for c in names if quartiles[c][1] is not None]

    def metrics(c: str) -> dict[str, Column]:
        col = value(df, c).cast("double")
        q1, _, q3 = quartiles[c]
        spread = 1.5 * (q3 - q1)
        outside = (col < F.lit(q1 - spread)) | (col > F.lit(q3 + spread))
        return {
            "n": F.count(col),
            "mean": F.avg(col),
            "std": F.stddev_samp(col),
            "low": F.min(col),
            "high": F.max(col),
            # A constant is told by its range: its moments may be rounding noise.
            "skew": F.when(F.min(col) < F.max(col), F.skewness(col)),
            "outliers": F.count_if(outside),
        }

    schema = "n bigint, mean double, std double, low double, high double, skew double, outliers bigint"
    report = column_report(df, names, metrics, schema)
    skew = F.col("skewness")
    label = F.when(F.abs(skew) < 0.5, "symmetric").when(F.abs(skew) < 1.0, "moderate").otherwise("high")
    known = small_table(df.sparkSession, [(c, df.schema[c].dataType.simpleString(), *quartiles[c]) for c in names],
        "column string, type string, q1 double, median double, q3 double",
    )
    return (
        report.join(F.broadcast(known), "column")
        .withColumn("skewness", adjusted_skewness(F.col("skew"), F.col("n")))
        .select(
            "column",
            "type",
            round_even(percent_of(F.col("rows") - F.col("n"), F.col("rows")), 2).alias("missing_pct"),
            *[round_even(F.col(m), 4).alias(m) for m in ("mean", "median", "std")],
            round_even(F.col("low"), 4).alias("min"),
            round_even(F.col("high"), 4).alias("max"),
            round_even(F.col("q1"), 4).alias("q1"),
            round_even(F.col("q3"), 4).alias("q3"),
            label.alias("skew_label"),
            round_even(skew, 3).alias("skewness"),
            round_even(percent_of(F.col("outliers"), F.col("n")), 2).alias("outlier_pct"),
            "position",
        )
        .orderBy("position")
        .drop("position")
    )


def value_table(df: DataFrame, columns: Sequence[str], *, target: str | None = None) -> DataFrame:
    """(column, value, count[, bad]) for the non-missing values of several columns, as text."""
    keep = [quoted(target).cast("bigint").alias("y")] if target else []
    long = melt(df, columns, "string", keep).where(F.col("value").isNotNull())
    sums = [F.count(F.lit(1)).alias("count")] + ([F.sum("y").alias("bad")] if target else [])
    return long.groupBy("column", "value").agg(*sums)


def top_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, distinct_values, present, top_value, top_count): ties go to the lowest value.

    Values are grouped by their keys, so that a long text is shuffled as a digest. Of the most frequent
    ones the least start decides. If that is the start of long values, a second scan reads the rows with
    this start alone and finds the value; where no column needs that, the scan falls away.
    """
    start = F.substring("value", 1, KEY_BYTES)
    long = F.octet_length("value") > KEY_BYTES
    values = melt(df, columns, "string").where(F.col("value").isNotNull())
    values = values.select("column", "value", text_key(F.col("value")).alias("key"), start.alias("start"), long.alias("long"))
    per_key = values.groupBy("column", "key").agg(
        F.count(F.lit(1)).alias("count"), F.first("start").alias("start"), F.first("long").alias("long")
    )
    best = F.min(F.struct((-F.col("count")).alias("minus"), "start", "long")).alias("best")
    stats = per_key.groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct_values"), F.sum("count").alias("present"), best
    )
    stats = stats.select(
        "column", "distinct_values", "present", (-F.col("best.minus")).alias("top_count"), "best.start", "best.long"
    )
    # One row per column.
    needy = F.broadcast(stats.where("long").select("column", "start", "top_count"))
    late = (
        values.where("long")
        .join(needy, ["column", "start"])
        .groupBy("column", "key", "top_count")
        .agg(F.count(F.lit(1)).alias("count"), F.min("value").alias("value"))
        .where(F.col("count") == F.col("top_count"))
        .groupBy("column")
        .agg(F.min("value").alias("late_value"))
    )
    return stats.join(F.broadcast(late), "column", "left").select(
        "column", "distinct_values", "present", F.coalesce("late_value", "start").alias("top_value"), "top_count"
    )


def categorical_profile(df: DataFrame, *, target: str = "target", max_unique: int = 50) -> DataFrame:
    """Distinct values, cardinality level, missing % and the most frequent value per string column."""
    columns = string_columns(df, exclude=[target])
    if not columns:
        return small_table(df.sparkSession, [],
            "column string, distinct_values bigint, cardinality string, missing_pct double, "
            "top_value string, top_share_pct double",
        )
    stats = top_values(df, columns)
    missing = missing_counts(df, columns)
    distinct = F.coalesce("distinct_values", F.lit(0))
    level = F.when(distinct <= 5, "low").when(distinct <= max_unique, "medium").otherwise("high")
    return (
        missing.join(F.broadcast(stats), "column", "left")
        .select(
            "column",
            distinct.alias("distinct_values"),
            level.alias("cardinality"),
            round_even(percent_of(F.col("missing"), F.col("rows")), 2).alias("missing_pct"),
            "top_value",
            round_even(percent_of(F.col("top_count"), F.col("present")), 1).alias("top_share_pct"),
        )
        .orderBy(F.desc("distinct_values"), "column")
    )


def target_rate_by_category(
    df: DataFrame, column: str, *, target: str = "target", order: str = "key", top: int | None = None
) -> DataFrame:
    """Rows and mean target in percent per non-missing value.

    ``order`` is ``key``, ``rate`` (ascending) or ``rate_desc``; ``top`` keeps the
    first so many rows of that order.
    """
    rates = (
        df.where(quoted(column).isNotNull())
        .groupBy(quoted(column).alias("value"))
        .agg(F.count(quoted(target)).alias("count"), (F.avg(quoted(target)) * 100).alias("rate_pct"))
    )
    orders = {
        "key": [F.col("value")],
        "rate": [F.col("rate_pct"), F.col("value")],
        "rate_desc": [F.desc("rate_pct"), F.col("value")],
    }
    out = rates.orderBy(*orders[order])
    return out.limit(top) if top else out


def value_counts(df: DataFrame, column: str, *, by_key: bool = False) -> DataFrame:
    """Rows per non-missing value, most frequent first or in key order."""
    counts = (
        df.where(value(df, column).isNotNull())
        .groupBy(quoted(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return counts.orderBy("value") if by_key else counts.orderBy(F.desc("count"), "value")


def target_distribution(df: DataFrame, *, target: str = "target") -> DataFrame:
    """One row: positives, negatives, positive rate in percent and the balance label."""
    t = quoted(target)
    counts = df.agg(F.count_if(t == 1).alias("positive"), F.count_if(t == 0).alias("negative"))
    rate = percent_of(F.col("positive"), F.col("positive") + F.col("negative"))
    label = F.when(rate < 5, "severe").when(rate < 30, "imbalanced").when(rate.isNotNull(), "balanced")
    return counts.select(
        "positive", "negative", round_even(rate, 2).alias("positive_rate_pct"), label.alias("balance")
    )


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row: table rows and rows beyond the first of each key. Nulls are one key value; long text is grouped by digest."""
    keys = [key_column(df, c).alias(f"k{i}") for i, c in enumerate(subset or df.columns)]
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
        )
    )


def duplicate_gate(df: DataFrame, subset: Sequence[str] | None = None, *, max_ratio: float = 0.01) -> DataFrame:
    """The duplicate share against its allowed maximum."""
    ratio = F.try_divide(F.col("duplicates").cast("double"), F.col("rows").cast("double"))
    return duplicate_count(df, subset).select(
        "rows", "duplicates", ratio.alias("ratio"), F.coalesce(ratio <= max_ratio, F.lit(True)).alias("passed")
    )


def range_report(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum and maximum of each column on both sides of a change."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return column_report(
            df,
            present(df, columns),
            lambda c: {f"min_{name}": F.min(value(df, c)), f"max_{name}": F.max(value(df, c))},
            f"min_{name} double, max_{name} double",
        ).drop("rows", "position")

    return side(before, "before").join(F.broadcast(side(after, "after")), "column").orderBy("column")


def frequency_levels(per_value: DataFrame) -> DataFrame:
    """(column, count, values, rank): how many values share a count, and their average-tie rank.

    Works on the (column, count) pairs of a :func:`value_table`. A table of n rows has
    at most about sqrt(2n) different counts per column, so these windows stay small
    when a column has billions of distinct values.
    """
    levels = per_value.groupBy("column", "count").agg(F.count(F.lit(1)).alias("values"))
    running = W.partitionBy("column").orderBy(F.desc("count")).rowsBetween(W.unboundedPreceding, 0)
    upto = F.sum("values").over(running)
    rank = upto - F.col("values") + (F.col("values") + 1) / F.lit(2.0)
    return levels.select("column", "count", "values", rank.alias("rank"))


def group_rare_values(per_value: DataFrame, max_categories: int = 50, other: str = "OTHER") -> DataFrame:
    """Add ``category``: the value itself, or ``other`` for values ranked beyond ``max_categories``.

    The rank falls as the count rises, so the cut is one count per column.
    """
    floor = (
        frequency_levels(per_value)
        .where(F.col("rank") <= max_categories)
        .groupBy("column")
        .agg(F.min("count").alias("floor"))
    )
    # One row per column: always small enough to broadcast.
    return per_value.join(F.broadcast(floor), "column", "left").withColumn(
        "category", F.when(F.col("count") >= F.col("floor"), F.col("value")).otherwise(F.lit(other))
    ).drop("floor")
