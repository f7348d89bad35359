"""The missing-value profile kept up to date while files arrive.

Two ways: a streaming aggregation whose state is one row of counters, for a query that
stays up; and a fold that is called now and then, reads the files it has not seen and
stores mergeable sums, so that nothing is read twice and nothing has to stay up. The
fitted apply functions are plain projections and run on a streaming frame as they are.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabloom.functions.columns import value
from tabloom.functions.wide import small_table
from tabloom.functions.workers import ship_package
from tabloom.operators.profile import profile_of_counts


def running_missing_counts(stream: DataFrame) -> DataFrame:
    """(column, rows, missing) over everything read so far; write it in complete mode."""
    names = stream.columns
    counts = stream.groupBy().agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(value(stream, c).isNull()).alias(f"m{i}") for i, c in enumerate(names)],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"m{i}").alias("missing"))
        for i, c in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*rows)))


_SUMS = "position int, rows bigint, missing bigint"


def _column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and missing values of each column over the rows of a task; nothing if it has none."""
    rows, missing = 0, 0
    for batch in batches:
        rows += batch.num_rows
        missing = missing + np.array([c.to_numpy(zero_copy_only=False).sum() for c in batch.columns], dtype=np.int64)
    if rows:
        columns = [
            pa.array(np.arange(len(missing)), pa.int32()),
            pa.array(np.full(len(missing), rows), pa.int64()),
            pa.array(missing, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["position", "rows", "missing"])


def fold_arrivals(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    state: str,
    *,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
    files_per_batch: int = 1000,
) -> None:
    """Read the files in ``source`` that no earlier call has read and add their sums to ``state``.

    A run ends when it has read what is there. Its checkpoint, kept in ``state`` with the sums, names the
    files of each batch, and the file sink counts a batch once even if it is written twice; so a call after
    a crash goes on where the last one stopped. Each task adds one short row per column. ``schema`` is that of
    all arrivals; a column that a file lacks is missing in it.
    """
    ship_package(spark)
    reader = spark.readStream.format(format).schema(schema).options(**(options or {}))
    stream = reader.option("maxFilesPerTrigger", files_per_batch).load(source)
    flags = stream.select(*[value(stream, c).isNull().cast("tinyint").alias(f"m{i}") for i, c in enumerate(stream.columns)])
    writer = flags.mapInArrow(_column_sums, _SUMS).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", f"{state}/sums").option("checkpointLocation", f"{state}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()


def stored_profile(spark: SparkSession, schema: T.StructType | str, state: str) -> DataFrame:
    """:func:`raw_profile` of everything folded into ``state`` so far, from the stored sums alone."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    sums = spark.read.schema(_SUMS).parquet(f"{state}/sums").groupBy("position")
    sums = sums.agg(F.sum("rows").alias("rows"), F.sum("missing").alias("missing"))
    names = small_table(spark, list(enumerate(fields.fieldNames())), "position int, column string")
    counts = names.join(F.broadcast(sums), "position", "left")
    counts = counts.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("rows", "missing")})
    return profile_of_counts(counts, len(fields))
