"""Fitted state as JSON: mappings, lists and rule documents.

A fit has one entry per column or category, so it is a few kilobytes whatever
the size of the table it was learned from. It is written with Spark so that the
path may be on any storage the session can reach.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from tabloom.functions.wide import small_table


def save_fit(spark: SparkSession, fit: dict | list, path: str) -> None:
    if not isinstance(fit, (dict, list)):
        raise ValueError(f"a fit is a dict or a list, got {type(fit).__name__}")
    text = json.dumps(fit, ensure_ascii=False)
    small_table(spark, [(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_fit(spark: SparkSession, path: str, kind: type = dict) -> dict | list:
    """Read a stored fit and check that it is a ``kind`` (dict or list)."""
    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    try:
        fit = json.loads(text)
    except json.JSONDecodeError as error:
        raise ValueError(f"{path} is not valid JSON: {error}") from error
    if not isinstance(fit, kind):
        raise ValueError(f"{path} holds a {type(fit).__name__}, expected a {kind.__name__}")
    return fit


def load_shift_map(spark: SparkSession, path: str) -> dict[str, float]:
    return {column: float(shift) for column, shift in load_fit(spark, path, dict).items()}


def load_column_list(spark: SparkSession, path: str) -> list[str]:
    return [str(c) for c in load_fit(spark, path, list)]


def load_encoding_rules(spark: SparkSession, path: str) -> dict:
    return load_fit(spark, path, dict)
