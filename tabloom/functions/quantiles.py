"""Exact quantiles of many columns in two passes, without holding a column in one task.

The builtin exact percentile keeps every distinct value of a column in one
buffer. Here each wanted order statistic is cornered between two values:

1. *Sketch*: the first pass counts every column and builds a KLL sketch of it, a few
   kilobytes a task that merge in two levels. The sketch proposes a value on each side
   of every wanted rank. It only steers; it never decides a result.
2. *Count*: the second pass counts the rows between and on these values, exactly, and
   keeps the distinct values that lie between the two of a rank, with their counts.
   That table is small and written; nothing later reads the columns again.
3. *Pick*: a running count over the kept values names the ranks. Many values are sorted
   over all partitions, whose totals say which partition holds a rank.

A value shared by a third of all rows is one count in every task. If a rank should lie
outside of its two values, which the margin makes rarer than one in a million, the
count shows it, and the values of the right cell are read in one pass more.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterable, Sequence
from fractions import Fraction
from itertools import accumulate

from pyspark.sql import DataFrame, Window as W, functions as F

from tabloom.functions.columns import sql_double, value
from tabloom.functions.lineage import materialize
from tabloom.functions.wide import MAX_EXPRESSIONS, chunks, small_table

# Rows of one interval that a single window may order.
MAX_INSIDE = 1_000_000
# Values that a level of a sketch holds; a sketch takes some 25 bytes for each.
ACCURACY = 2048
# Sketches of tasks are first merged in so many groups.
PARTS = 256


def as_fraction(p: float | Fraction) -> Fraction:
    """Read 0.1 as one tenth, so that positions are exact integers where they should be."""
    return p if isinstance(p, Fraction) else Fraction(str(p))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float | Fraction],
    *,
    max_inside: int | None = None,
    accuracy: int | None = None,
) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles of the non-missing values of each column.

    Two passes read ``df`` with only ``columns`` selected (a hundred columns at a time),
    so its rows must be the same both times; materialise a non-deterministic frame first.
    """
    columns = list(dict.fromkeys(columns))
    wanted = [as_fraction(p) for p in fractions]
    result: dict[str, list[float | None]] = {}
    for group in chunks(columns, MAX_EXPRESSIONS // 2):
        result |= _quantiles(df, group, wanted, max_inside or MAX_INSIDE, accuracy or ACCURACY)
    return result


def _quantiles(df: DataFrame, columns: Sequence[str], wanted: Sequence[Fraction], max_inside: int, accuracy: int) -> dict:
    numbers = df.select(*[value(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    sizes, bounds = _sketch(numbers, wanted, accuracy)
    cuts = [sorted({b for pair in own for b in pair}) for own in bounds]
    inside = [{2 * j for lo, hi in own for j in range(points.index(lo) + 1, points.index(hi) + 1)} for own, points in zip(bounds, cuts)]
    ranks = [
        sorted({f(p * (n - 1)) for p in wanted for f in (math.floor, math.ceil)}) if n else [] for n in sizes
    ]
    found: dict[tuple[int, int], float] = {}
    waiting = {i for i, own in enumerate(ranks) if own}
    while waiting:
        cells, counts = _cells(numbers, {i: cuts[i] for i in sorted(waiting)}, inside)
        places: dict[tuple[int, int], list[tuple[int, int]]] = {}
        missed = set()
        for i in waiting:
            upto = list(accumulate(counts.get((i, cell), 0) for cell in range(2 * len(cuts[i]) + 1)))
            for rank in ranks[i]:
                cell = bisect_right(upto, rank)
                if cell % 2:
                    found[i, rank] = cuts[i][cell // 2]
                elif cell in inside[i]:
                    places.setdefault((i, cell), []).append((rank, rank - (upto[cell - 1] if cell else 0)))
                else:
                    inside[i].add(cell)
                    missed.add(i)
        found |= _pick(cells, places, counts, max_inside)
        waiting = missed
    return {
        c: [_interpolate(p * (sizes[i] - 1), i, found) if sizes[i] else None for p in wanted]
        for i, c in enumerate(columns)
    }


def _interpolate(position: Fraction, column: int, found: dict[tuple[int, int], float]) -> float:
    low = found[column, math.floor(position)]
    high = found[column, math.ceil(position)]
    if low == high:
        return low
    if math.isinf(low) or math.isinf(high):
        return high  # nothing lies between a number and an infinity
    return low + (high - low) * float(position - math.floor(position))


def _sketch(numbers: DataFrame, wanted: Sequence[Fraction], accuracy: int) -> tuple[list[int], list[list[tuple[float, float]]]]:
    """Size of each column, and values around each wanted fraction of it."""
    names = numbers.columns
    # Twice the rank error that a sketch keeps to with 99 % confidence.
    margin = 2 * 2.296 / accuracy**0.9021
    around = [(max(0.0, float(p) - margin), min(1.0, float(p) + margin)) for p in wanted]
    flat = F.array(*[F.lit(q) for pair in around for q in pair])
    part = numbers.withColumn("part", F.spark_partition_id() % PARTS)
    counts = {f"n_{v}": F.count(v) for v in names}
    sketches = {f"s_{v}": F.kll_sketch_agg_double(v, accuracy) for v in names}
    by_part = part.groupBy("part").agg(*[e.alias(n) for n, e in {**counts, **sketches}.items()])
    merged = by_part.agg(
        *[F.sum(n).alias(n) for n in counts], *[F.kll_merge_agg_double(s, accuracy).alias(s) for s in sketches]
    )
    row = merged.select(
        *[F.coalesce(n, F.lit(0)).alias(n) for n in counts],
        *[F.when(F.col(f"n_{v}") > 0, F.kll_sketch_get_quantile_double(f"s_{v}", flat)).alias(v) for v in names],
    ).first()
    sizes = [row[n] for n in counts]
    return sizes, [list(zip(row[v][::2], row[v][1::2])) if row[v] else [] for v in names]


def _cell(v: str, cuts: Sequence[float], low: int, high: int) -> str:
    """SQL for the cell of a value: 2i lies between cuts i-1 and i, 2i+1 is cut i itself."""
    if low == high:
        return str(2 * low)
    middle = (low + high) // 2
    cut = sql_double(cuts[middle])
    return (
        f"CASE WHEN {v} < {cut} THEN {_cell(v, cuts, low, middle)} "
        f"WHEN {v} = {cut} THEN {2 * middle + 1} ELSE {_cell(v, cuts, middle + 1, high)} END"
    )


def _cells(
    numbers: DataFrame, cuts: dict[int, Sequence[float]], inside: Sequence[Iterable[int]]
) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """(column, cell, v, n) written, v being NULL outside of the cells to keep; and the rows of each cell."""
    numbered = numbers.selectExpr(
        *[f"v{i}" for i in cuts], *[f"CASE WHEN v{i} IS NOT NULL THEN {_cell(f'v{i}', c, 0, len(c))} END AS c{i}" for i, c in cuts.items()]
    )
    entries = []
    for i in cuts:
        kept = ", ".join(map(str, sorted(inside[i]))) or "-1"
        entries.append(f"{i}, c{i}, CASE WHEN c{i} IN ({kept}) THEN v{i} END")
    table = (
        numbered.selectExpr(f"stack({len(cuts)}, {', '.join(entries)}) AS (column, cell, v)")
        .where("cell IS NOT NULL")
        .groupBy("column", "cell", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    table = materialize(table, "cells")
    # At most two cells for each bound, whatever the table holds.
    rows = table.groupBy("column", "cell").agg(F.sum("n").alias("n")).collect()
    return table, {(r["column"], r["cell"]): r["n"] for r in rows}


def _pick(cells: DataFrame, places: dict, counts: dict, max_inside: int) -> dict[tuple[int, int], float]:
    """Values of the ranks in kept cells, by running counts; ``places`` has (rank, rank in its cell)."""
    if not places:
        return {}
    spark = cells.sparkSession
    wanted = [(i, cell, rank, at) for (i, cell), own in places.items() for rank, at in own]
    # One row for each rank that was asked for.
    ranks = small_table(spark, wanted, "column int, cell int, rank bigint, at bigint")
    keys = ["column", "cell"]
    held = cells.join(F.broadcast(ranks.select(*keys).distinct()), keys, "left_semi")
    if max(counts[place] for place in places) > max_inside:
        held = held.repartitionByRange("column", "cell", "v").withColumn("part", F.spark_partition_id())
        held = materialize(held, "sorted-cells")
        totals = held.groupBy(*keys, "part").agg(F.sum("n").alias("n"))
        ahead = totals.withColumn("ahead", F.sum("n").over(W.partitionBy(*keys).orderBy("part")) - F.col("n"))
        # The partition that holds a rank, and its place there: again a row for each rank.
        ranks = ahead.join(F.broadcast(ranks), keys).where("at >= ahead and at < ahead + n")
        ranks = ranks.select(*keys, "part", "rank", (F.col("at") - F.col("ahead")).alias("at"))
        keys = [*keys, "part"]
        held = held.join(F.broadcast(ranks.select(*keys).distinct()), keys, "left_semi")
    running = W.partitionBy(*keys).orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    counted = held.withColumn("upto", F.sum("n").over(running))
    rows = (
        counted.join(F.broadcast(ranks), keys)
        .where((F.col("at") >= F.col("upto") - F.col("n")) & (F.col("at") < F.col("upto")))
        .select("column", "rank", "v")
        .collect()
    )
    return {(r["column"], r["rank"]): r["v"] for r in rows}
