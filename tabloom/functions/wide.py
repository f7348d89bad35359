"""One aggregate row over many columns, reshaped to one report row per column.

A report over k columns is a single scan with partial and final aggregation.
Very wide tables are cut into groups of columns so that no aggregate holds
more expressions than generated code can take; the scans are columnar, so the
groups do not read each other's columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

MAX_EXPRESSIONS = 200


def chunks(items: Sequence, size: int) -> list[Sequence]:
    return [items[i : i + size] for i in range(0, len(items), size)]


def small_table(spark: SparkSession, rows: Iterable[Sequence], ddl: str) -> DataFrame:
    """Driver-side rows as a local relation: joins with it need no job of their own."""
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))
    rows = list(rows)
    columns = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(schema)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=schema))


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column_report(
    df: DataFrame,
    columns: Sequence[str],
    metrics: Callable[[str], dict[str, Column]],
    schema: str,
) -> DataFrame:
    """One row per column: `position`, `column`, `rows` and the named metrics.

    ``metrics(column)`` gives the same metric names for every column; ``schema``
    is the DDL of those metrics, used to give all rows one type.
    """
    fields = f"position int, column string, rows bigint, {schema}"
    if not columns:
        return small_table(df.sparkSession, [], fields)
    types = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(schema).fields}
    parts = []
    for group in chunks(list(enumerate(columns)), max(1, MAX_EXPRESSIONS // len(types))):
        aggregates = [F.count(F.lit(1)).alias("n_rows")]
        entries = []
        for position, name in group:
            values = metrics(name)
            aggregates += [values[m].alias(f"m{position}_{m}") for m in types]
            casts = ", ".join(f"CAST(m{position}_{m} AS {t})" for m, t in types.items())
            entries.append(f"{position}, {_sql_text(name)}, n_rows, {casts}")
        names = ", ".join(f"`{n}`" for n in ("position", "column", "rows", *types))
        parts.append(df.agg(*aggregates).selectExpr(f"stack({len(group)}, {', '.join(entries)}) AS ({names})"))
    return reduce(DataFrame.unionAll, parts)


def aggregate_row(df: DataFrame, expressions: dict[object, Column]) -> dict[object, object]:
    """Evaluate named aggregates in as few scans as the expression limit allows."""
    out: dict[object, object] = {}
    for group in chunks(list(expressions.items()), MAX_EXPRESSIONS):
        row = df.agg(*[c.alias(f"a{i}") for i, (_, c) in enumerate(group)]).first()
        out.update({name: row[i] for i, (name, _) in enumerate(group)})
    return out


def melt(df: DataFrame, columns: Sequence[str], cast: str, keep: Sequence[Column] = ()) -> DataFrame:
    """Long form (*keep, `column`, `value`), every value cast to one type."""
    kept = df.select(*keep, *[F.col("`" + c.replace("`", "``") + "`").cast(cast).alias(f"c{i}") for i, c in enumerate(columns)])
    entries = ", ".join(f"{_sql_text(c)}, `c{i}`" for i, c in enumerate(columns))
    names = kept.columns[: len(keep)]
    return kept.selectExpr(*[f"`{n}`" for n in names], f"stack({len(columns)}, {entries}) AS (`column`, `value`)")
