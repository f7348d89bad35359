"""Pairwise-complete Pearson correlation of many columns, a tile of columns against another at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tabloom.functions.columns import finite
from tabloom.functions.wide import aggregate_row, chunks, column_report, small_table

_SUMS = ("n", "sum_left", "sum_right", "square_left", "square_right", "cross")
_SCHEMA = "i int, j int, " + ", ".join(f"{s} double" for s in _SUMS)
# Columns of a tile: a task holds six sums for each pair of two tiles, 50 MB, whatever the table's width.
TILE = 1024
# Bytes of the rows that are multiplied at once.
ROW_BYTES = 16 << 20
# Rows of a left column are first added up in so many groups of tasks.
PARTS = 64
# Rounding noise of standardised values: a spread below this is a constant.
_FLAT = 1e-12


def correlation_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(left, right, pairs, correlation) for every column pair, in column order.

    A pair uses the rows where both values are present and finite; a side that is constant on
    those rows gives NULL. Columns form tiles; for each pair of tiles a task multiplies its Arrow
    batches into one small matrix for each kind of sum and emits one packed row per left column,
    so the shuffle carries sums and never rows, and the left columns are spread over the reducers.
    Up to TILE columns that is one scan; wider tables are scanned once for each pair of tiles, each
    time only the columns of the two. As SQL aggregates the same thing is several expressions for
    each of k*(k-1)/2 pairs.
    """
    spark = df.sparkSession
    columns = list(columns)
    index = list(enumerate(columns))
    moments = aggregate_row(
        df,
        {
            (i, m): f(finite(df, c))
            for i, c in index
            for m, f in (("mean", F.avg), ("std", F.stddev_samp))
        },
    )
    filled = [i for i, _ in index if moments[i, "mean"] is not None]
    numbers = df.select(
        *[
            ((finite(df, columns[i]) - F.lit(moments[i, "mean"])) / F.lit(moments[i, "std"] or 1.0)).alias(f"v{i}")
            for i in filled
        ]
    )
    totals = small_table(spark, [], _SCHEMA)
    if len(filled) > 1:
        tiles = chunks(filled, TILE)
        packed = reduce(
            DataFrame.unionAll,
            [
                numbers.select(*[f"v{i}" for i in dict.fromkeys([*left, *right])]).mapInArrow(
                    _tile_sums(left, right), "i int, tile int, part int, sums binary"
                )
                for a, left in enumerate(tiles)
                for right in tiles[a:]
            ],
        )
        # Two levels: no left column meets the rows of all tasks at once.
        halfway = packed.groupBy("i", "tile", "part").applyInArrow(_merge(None), "i int, tile int, sums binary")
        totals = halfway.groupBy("i", "tile").applyInArrow(_merge({t[0]: t for t in tiles}), _SCHEMA).where("j > i")
    names = small_table(spark, index, "i int, left string")
    places = names.withColumn("j", F.explode(F.expr(f"sequence(i + 1, {max(len(columns) - 1, 0)})")))
    places = places.where("j > i").join(
        names.select(F.col("i").alias("j"), F.col("left").alias("right")), "j"
    )

    def spread(side: str):
        s = F.col(f"square_{side}") - F.col(f"sum_{side}") * F.col(f"sum_{side}") / F.col("n")
        return F.when(s > F.col("n") * _FLAT, s)

    covariance = F.col("cross") - F.col("sum_left") * F.col("sum_right") / F.nullif(F.col("n"), F.lit(0.0))
    correlation = F.when(F.col("n") > 1, covariance / F.sqrt(spread("left") * spread("right")))
    return (
        places.join(totals, ["i", "j"], "left")
        .select(
            "i",
            "j",
            "left",
            "right",
            F.coalesce("n", F.lit(0)).cast("bigint").alias("pairs"),
            F.greatest(F.lit(-1.0), F.least(F.lit(1.0), correlation)).alias("bounded"),
            correlation.alias("raw"),
        )
        .select("i", "j", "left", "right", "pairs", F.when(F.col("raw").isNotNull(), F.col("bounded")).alias("correlation"))
        .orderBy("i", "j")
        .drop("i", "j")
    )


def _tile_sums(left: list[int], right: list[int]):
    """The per-task function of two tiles; it closes over plain values only.

    Rows without a gap add to one product and to sums of columns; only rows with gaps need
    a product for each kind of sum.
    """
    row_bytes, parts = ROW_BYTES, PARTS

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        width, same = len(left), left == right
        shape = width, len(right)
        rows, cross, gaps = 0.0, np.zeros(shape), None
        whole = [np.zeros(n) for n in (*shape, *shape)]
        for batch in batches:
            step = max(1, row_bytes // (8 * batch.num_columns))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                x = np.empty((part.num_rows, part.num_columns))
                for at, column in enumerate(part.columns):
                    x[:, at] = column.to_numpy(zero_copy_only=False)
                full = ~np.isnan(x).any(axis=1)
                for chosen, complete in ((full, True), (~full, False)):
                    if not chosen.any():
                        continue
                    y = x if chosen.all() else x[chosen]
                    a, b = y[:, :width], (y if same else y[:, width:])
                    if complete:
                        rows += len(y)
                        cross += a.T @ b
                        for total, values in zip(whole, (a.sum(0), b.sum(0), (a * a).sum(0), (b * b).sum(0))):
                            total += values
                    else:
                        if gaps is None:
                            gaps = [np.zeros(shape) for _ in range(5)]
                        mask_a, mask_b = (~np.isnan(z) for z in (a, b))
                        a, b = np.where(mask_a, a, 0.0), np.where(mask_b, b, 0.0)
                        mask_a, mask_b = mask_a.astype("float64"), mask_b.astype("float64")
                        for total, (p, q) in zip(
                            gaps, ((mask_a, mask_b), (a, mask_b), (mask_a, b), (a * a, mask_b), (mask_a, b * b))
                        ):
                            total += p.T @ q
                        cross += a.T @ b
        if not rows and gaps is None:
            return
        part = TaskContext.get().partitionId() % parts if TaskContext.get() else 0
        for at, i in enumerate(left):
            sums = np.empty((6, shape[1]))
            sums[:5] = np.array([rows, whole[0][at], 0.0, whole[2][at], 0.0])[:, None]
            sums[2], sums[4], sums[5] = whole[1], whole[3], cross[at]
            if gaps is not None:
                sums[:5] += [total[at] for total in gaps]
            columns = [pa.array([v], pa.int32()) for v in (i, right[0], part)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([sums.tobytes()], pa.binary())], names=["i", "tile", "part", "sums"]
            )

    return run


def _merge(tiles: dict[int, list[int]] | None):
    """Add up the packed sums of a left column and a tile: packed again, or one row per right column with ``tiles``."""
    names = _SUMS

    def run(table):
        import numpy as np
        import pyarrow as pa

        left, tile = table["i"][0].as_py(), table["tile"][0].as_py()
        added = sum(np.frombuffer(x, dtype="float64") for x in table["sums"].to_pylist())
        if tiles is None:
            return pa.table({"i": pa.array([left], pa.int32()), "tile": pa.array([tile], pa.int32()), "sums": pa.array([added.tobytes()], pa.binary())})
        right = np.asarray(tiles[tile], dtype="int32")
        columns = dict(zip(names, added.reshape(len(names), -1)))
        return pa.table({"i": np.full(len(right), left, dtype="int32"), "j": right, **columns})

    return run


def target_correlation(df: DataFrame, columns: Sequence[str], *, target: str = "target") -> DataFrame:
    """(column, correlation): absolute Pearson with the target, NULL where undefined."""
    columns = [c for c in columns if c != target]
    label = finite(df, target)
    expressions = []
    for c in columns:
        x = finite(df, c)
        # Both sides are blanked where either is missing, so all three use the same rows.
        left, right = F.when(label.isNotNull(), x), F.when(x.isNotNull(), label)
        # A constant is told by its range: its standard deviation may be rounding noise.
        varies = (F.min(left) < F.max(left)) & (F.min(right) < F.max(right))
        scale = F.stddev_samp(left) * F.stddev_samp(right)
        expressions.append(F.when(varies, F.abs(F.try_divide(F.covar_samp(x, label), scale))))
    if not columns:
        return small_table(df.sparkSession, [], "column string, correlation double")
    by_name = dict(zip(columns, expressions))
    return (
        column_report(df, columns, lambda c: {"correlation": by_name[c]}, "correlation double")
        .select("column", "correlation", "position")
        .orderBy("position")
        .drop("position")
    )
