"""Parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tabloom.functions.columns import nan_to_null


def read_parquet_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read parquet with NaN turned into NULL. A missing path is an error."""
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    return nan_to_null(df)


def write_parquet_table(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
