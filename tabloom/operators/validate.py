"""Schema, leakage and quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabloom.functions.columns import (
    is_infinite,
    is_fractional,
    is_string,
    quoted,
    string_columns,
    value,
)
from tabloom.functions.wide import column_report, small_table
from tabloom.operators.types import _distinct_counts


def _presence(df: DataFrame, names: Sequence[str]) -> DataFrame:
    rows = [(n, n in df.columns) for n in names]
    return small_table(df.sparkSession, rows, "column string, present boolean")


def check_schema(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """(column, present) per required column; the check passes when all are present."""
    return _presence(df, required)


def schema_passes(df: DataFrame, required: Sequence[str]) -> bool:
    return set(required) <= set(df.columns)


def check_leakage_columns(df: DataFrame, listed: Sequence[str]) -> DataFrame:
    """(column, present) plus the share of the table's columns that are listed, in percent."""
    found = sum(n in df.columns for n in listed)
    share = found / len(df.columns) * 100
    return _presence(df, listed).withColumn("leakage_pct", F.lit(share))


def quality_report(df: DataFrame) -> DataFrame:
    """Nulls, infinities and, for string columns, distinct values; one row per column."""
    text = string_columns(df)
    report = column_report(
        df,
        df.columns,
        lambda c: {
            "nulls": F.count_if(value(df, c).isNull()),
            "infinities": F.count_if(is_infinite(quoted(c))) if is_fractional(df, c) else F.count_if(F.lit(False)),
        },
        "nulls bigint, infinities bigint",
    ).withColumn("is_string", F.col("column").isin(text) if text else F.lit(False))
    if text:
        report = report.join(F.broadcast(_distinct_counts(df, text, True)), "column", "left")
    else:
        report = report.withColumn("distinct_values", F.lit(None).cast("bigint"))
    return report.select("column", "is_string", "nulls", "infinities", "distinct_values").orderBy("column")


def remaining_categoricals(df: DataFrame) -> list[str]:
    return [c for c in df.columns if is_string(df, c)]
