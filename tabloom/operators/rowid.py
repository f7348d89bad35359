"""Dense row ids without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.columns import quoted
from tabloom.functions.lineage import materialize
from tabloom.functions.wide import small_table


def add_row_id(
    df: DataFrame,
    order_by: Sequence[str | Column],
    *,
    name: str = "row_id",
    start: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Ids ``start``, ``start + 1``, ... in ``order_by`` order, as a bigint first column.

    The rows are range-partitioned and sorted once, numbered inside their partition
    and written to the shared folder. A second, one-column pass counts the partitions,
    and each row's id is its number plus the rows of the partitions before. Writing
    first matters: range bounds are sampled anew in every job. A random last sort key
    spreads rows that tie on ``order_by``, so a hot value does not fill one partition.
    """
    if name in df.columns:
        return df
    order = [quoted(c) if isinstance(c, str) else c for c in order_by]
    spread = df.withColumn("_tie", F.rand(17))
    keys = [*order, F.col("_tie")]
    ranged = spread.repartitionByRange(partitions, *keys) if partitions else spread.repartitionByRange(*keys)
    low_bits = F.lit((1 << 33) - 1)
    numbered = materialize(
        ranged.sortWithinPartitions(*keys)
        .drop("_tie")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(low_bits)),
        "row-id",
    )
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    offsets, total = [], start
    for r in sizes:
        offsets.append((r["_part"], total))
        total += r["n"]
    # One row per partition of the sort: small by construction.
    table = small_table(df.sparkSession, offsets, "_part int, _offset bigint")
    return numbered.join(F.broadcast(table), "_part").select(
        (F.col("_offset") + F.col("_place")).alias(name), *[quoted(c) for c in df.columns]
    )
