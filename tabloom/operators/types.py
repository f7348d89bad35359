"""Type recommendations, type narrowing and the type report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabloom.functions.columns import is_fractional, is_string, percent_of, quoted, round_even, text_key, value
from tabloom.functions.wide import column_report, melt, small_table

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
CATEGORY_RATIO = 0.50


def _is_integral(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, _INTEGRAL)


def _distinct(df: DataFrame, name: str, exact: bool) -> Column:
    col = value(df, name)
    if isinstance(df.schema[name].dataType, (T.ArrayType, T.StructType, T.MapType)):
        col = F.to_json(F.struct(col))
    return F.count_distinct(col) if exact else F.approx_count_distinct(col)


def _distinct_counts(df: DataFrame, columns: list[str], exact: bool) -> DataFrame:
    """Distinct non-missing values per column.

    Exact counts go through one long (column, value) grouping, so a hot value is
    combined before the shuffle and a column is spread over many tasks. Long values
    are counted by their digests.
    """
    if not exact:
        return column_report(
            df, columns, lambda c: {"distinct_values": _distinct(df, c, False)}, "distinct_values bigint"
        ).select("column", "distinct_values")
    text = df.select(*[text_key(_as_text(df, c)).alias(c) for c in columns])
    return (
        melt(text, columns, "string")
        .where(F.col("value").isNotNull())
        .distinct()
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("distinct_values"))
    )


def _as_text(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    col = value(df, name)
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.when(col.isNotNull(), F.to_json(F.struct(col)))
    if is_fractional(df, name):
        col = col + F.lit(0.0)  # -0.0 and 0.0 are one value
    return col.cast("string")


def _column_types(df: DataFrame) -> DataFrame:
    return small_table(
        df.sparkSession,
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields],
        "column string, type string",
    )


def recommend_types(df: DataFrame, *, exact: bool = True) -> DataFrame:
    """Suggested type per column, in column order.

    Integers get the narrowest of smallint, int and bigint for their range; floats
    get float; strings get `category` when distinct / rows is below one half.
    """
    columns = df.columns
    integral = [c for c in columns if _is_integral(df, c)]
    text = [c for c in columns if is_string(df, c)]
    report = column_report(
        df,
        columns,
        lambda c: {
            "low": F.min(quoted(c)).cast("bigint") if c in integral else F.max(F.lit(None).cast("bigint")),
            "high": F.max(quoted(c)).cast("bigint") if c in integral else F.max(F.lit(None).cast("bigint")),
        },
        "low bigint, high bigint",
    )
    kind = F.col("kind")
    ratio = F.try_divide(F.col("distinct_values").cast("double"), F.col("rows").cast("double"))
    suggested = (
        F.when(
            kind == "integer",
            F.when((F.col("low") >= -32768) & (F.col("high") <= 32767), "smallint")
            .when((F.col("low") >= -2147483648) & (F.col("high") <= 2147483647), "int")
            .otherwise("bigint"),
        )
        .when(kind == "float", "float")
        .when(kind == "string", F.when(ratio < CATEGORY_RATIO, "category").otherwise("string"))
        .otherwise(F.col("current_type"))
    )
    catalog = small_table(
        df.sparkSession,
        [
            (
                c,
                df.schema[c].dataType.simpleString(),
                "integer" if c in integral else "float" if is_fractional(df, c) else "string" if c in text else "other",
            )
            for c in columns
        ],
        "column string, current_type string, kind string",
    )
    report = report.join(F.broadcast(catalog), "column")
    if text:
        counts = _distinct_counts(df, text, exact)
        report = report.join(F.broadcast(counts), "column", "left").withColumn(
            "distinct_values", F.coalesce("distinct_values", F.lit(0))
        )
    else:
        report = report.withColumn("distinct_values", F.lit(0).cast("bigint"))
    return report.select("column", "current_type", suggested.alias("suggested_type"), "position").orderBy(
        "position"
    ).drop("position")


def optimize_types(df: DataFrame) -> DataFrame:
    """Cast every column to its recommended type. Only the integer ranges need a scan."""
    integral = [c for c in df.columns if _is_integral(df, c)]
    targets: dict[str, str] = {}
    if integral:
        ranges = column_report(
            df,
            integral,
            lambda c: {"low": F.min(quoted(c)).cast("bigint"), "high": F.max(quoted(c)).cast("bigint")},
            "low bigint, high bigint",
        ).collect()
        for r in ranges:
            if r["low"] is not None and r["low"] >= -32768 and r["high"] <= 32767:
                targets[r["column"]] = "smallint"
            elif r["low"] is not None and r["low"] >= -(2**31) and r["high"] < 2**31:
                targets[r["column"]] = "int"
            else:
                targets[r["column"]] = "bigint"
    targets |= {c: "float" for c in df.columns if is_fractional(df, c)}
    if not targets:
        return df
    return df.select(
        *[quoted(c).try_cast(targets[c]).alias(c) if c in targets else quoted(c) for c in df.columns]
    )


def type_report(df: DataFrame, *, exact: bool = True) -> DataFrame:
    """Type, distinct values, missing % and the smallest value as an example, per column."""
    columns = df.columns
    report = column_report(
        df,
        columns,
        lambda c: {"present": F.count(value(df, c)), "example": F.min(_as_example(df, c))},
        "present bigint, example string",
    )
    catalog = _column_types(df)
    missing = round_even(percent_of(F.col("rows") - F.col("present"), F.col("rows")), 2)
    return (
        report.join(F.broadcast(catalog), "column")
        .join(F.broadcast(_distinct_counts(df, columns, exact)), "column", "left")
        .select(
            "column",
            "type",
            F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
            missing.alias("missing_pct"),
            "example",
        )
        .orderBy(F.desc("missing_pct"), "column")
    )


def _as_example(df: DataFrame, name: str) -> Column:
    """Orderable values keep their own order; nested ones are compared as JSON."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return _as_text(df, name)
    return value(df, name)
