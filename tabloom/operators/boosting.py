"""Gradient boosted trees over binned columns, for the importance of each column.

The trees are those of Spark's GBTClassifier: 32 bins, variance gain on the residuals of the logistic
loss, a first tree of weight 1 and the others of weight ``step``. Rows are kept as blocks of small codes,
each for the bins of several columns at once, with the score of each row. A level of a tree is one job
that sends back sums by node, column and bin; of two siblings only the smaller one is summed, the other
one is what is left of their parent. The job that adds a tree to the scores sums the next tree's root.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.functions.columns import quoted
from tabloom.functions.lineage import new_path
from tabloom.functions.workers import ship_package

BINS = 32
#: Joint bins that one code may tell apart.
CELLS = 1024
#: Values that stand for a column's rows in each task when its bins are found.
POINTS = 10_000
#: Rows of a block when they are dealt out, and when they are summed.
BLOCK_ROWS = 1 << 15, 1 << 17
#: Rows of a task: cores stay idle rather than get fewer, and take turns rather than get more.
TASK_ROWS = 1 << 14, 1 << 22
#: Sums of so many tasks meet on the driver.
MAX_PARTS = 64
#: Trees between two checkpoints.
CHECKPOINT = 20
# Gains this close are a tie: the first column, then the lower bin.
TIE = 1e-9
# A gain this small against the weight of all rows is rounding.
ROUNDING = 1e-16


def split_gains(
    rows: DataFrame,
    columns: Sequence[str],
    weights: dict[int, float],
    *,
    label: str,
    copies: str | None = None,
    trees: int,
    step: float,
    depth: int,
) -> list[float]:
    """Each column's share of the gain of all splits; zeros when nothing splits.

    ``rows`` are few steps away from a stored table, hold numbers without gaps and labels 0 and 1;
    a row counts ``copies`` times the weight of its label.
    """
    if not set(weights) <= {0, 1}:
        raise ValueError(f"labels must be 0 or 1, found {sorted(weights)}")
    count = rows.count()
    if not count:
        raise ValueError("boosted trees need rows with a label")
    spark = rows.sparkSession
    ship_package(spark)
    by_label = np.array([weights.get(k, 0.0) for k in (0, 1)])
    plain = rows.select(
        # A column without any value is a constant.
        *[F.coalesce(quoted(c).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(columns)],
        quoted(label).cast("double").alias("y"),
        (quoted(copies).cast("double") if copies else F.lit(None).cast("double")).alias("copies"),
    )
    edges = _fit_edges(plain, len(columns), by_label, min(BINS, count))
    used = [i for i, e in enumerate(edges) if len(e)]
    gains = np.zeros(len(columns))
    if used:
        packs = _packs([len(edges[i]) + 1 for i in used])
        cores = spark.sparkContext.defaultParallelism
        tasks = min(cores, ceil(count / TASK_ROWS[0])) * ceil(count / cores / TASK_ROWS[1])
        narrow = plain.select(*[f"x{i}" for i in used], "y", "copies")
        blocks = narrow.mapInArrow(_packed([edges[i] for i in used], packs), "codes binary, y binary, copies binary")
        gains[used] = _boost(blocks.repartition(tasks), packs, by_label, trees, step, depth)
    total = gains.sum()
    return (gains / total if total else gains).tolist()


# --- Bins --------------------------------------------------------------------


def _fit_edges(plain: DataFrame, columns: int, by_label: np.ndarray, bins: int) -> list[np.ndarray]:
    """Upper edges of the bins of each column but the last bin's, of equal weight as far as values allow.

    All rows count. Up to POINTS different values in a task are taken as they are; of more, that many
    with their exact ranks stand for the others, so an edge is off by a few ten-thousandths of the weight.
    """

    def found(key: tuple, table: pa.Table) -> pa.Table:
        values, sums = (np.concatenate([np.frombuffer(v) for v in table[c].to_pylist()]) for c in ("points", "sums"))
        edges = _edges(*_merge(values, sums), bins)
        return pa.table({"at": pa.array([key[0].as_py()], pa.int32()), "edges": pa.array([edges], pa.list_(pa.float64()))})

    summaries = plain.mapInArrow(_summaries(columns, by_label, POINTS, BLOCK_ROWS[1]), "at int, points binary, sums binary")
    rows = summaries.groupBy("at").applyInArrow(found, "at int, edges array<double>").collect()
    edges = {r["at"]: np.array(r["edges"], "float64") for r in rows}
    return [edges[i] for i in range(columns)]


def _row_weights(batch: pa.RecordBatch | pa.Table, by_label: np.ndarray) -> np.ndarray:
    weights = by_label[batch["y"].to_numpy().astype("int8")]
    copies = batch["copies"]
    return weights if copies.null_count else weights * copies.to_numpy()


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == size:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _merge(values: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values in order, each with its weight."""
    order = np.argsort(values)
    values, sums = values[order], sums[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[starts], np.add.reduceat(sums, starts)


def _thinned(values: np.ndarray, sums: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``points`` of the values; each has the weight of those up to it."""
    values, sums = _merge(values, sums)
    if len(values) <= points:
        return values, sums
    ranks = np.cumsum(sums)
    last = np.searchsorted(ranks, ranks[-1] * np.arange(1, points + 1) / points)
    last = np.unique(np.append(last[:-1], len(values) - 1))
    return values[last], np.diff(ranks[last], prepend=0.0)


def _summaries(columns: int, by_label: np.ndarray, points: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(columns)]
        for chunk in _chunks(batches, block_rows):
            weights = _row_weights(chunk, by_label)
            for i, parts in enumerate(held):
                parts.append(_thinned(chunk[f"x{i}"].to_numpy(), weights, points))
                if len(parts) == 8:
                    parts[:] = [_thinned(*map(np.concatenate, zip(*parts)), points)]
        for i, parts in enumerate(held):
            if parts:
                values, sums = _thinned(*map(np.concatenate, zip(*parts)), points)
                yield pa.RecordBatch.from_pydict(
                    {"at": pa.array([i], pa.int32()), "points": [values.tobytes()], "sums": [sums.tobytes()]}
                )

    return run


def _edges(values: np.ndarray, sums: np.ndarray, bins: int) -> list[float]:
    """The thresholds that Spark's trees choose, midway between two values, from all of them."""
    with np.errstate(invalid="ignore"):
        middle = (values[:-1] / 2 + values[1:] / 2).tolist()
    if len(middle) < bins:
        return middle
    edges = []
    stride = float(sums.sum()) / bins
    target, so_far = stride, float(sums[0])
    for i, weight in enumerate(sums[1:].tolist()):
        before, so_far = so_far, so_far + weight
        if abs(before - target) < abs(so_far - target):
            edges.append(middle[i])
            target += stride
    return edges


def _packs(sizes: Sequence[int]) -> list[tuple[list[int], list[int]]]:
    """(places of columns, their numbers of bins) of each code, with at most CELLS joint bins."""
    packs: list[tuple[list[int], list[int]]] = []
    for at in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for places, shape in packs:
            if np.prod(shape) * sizes[at] <= CELLS:
                break
        else:
            places, shape = [], []
            packs.append((places, shape))
        places.append(at)
        shape.append(sizes[at])
    return packs


def _packed(edges: list[np.ndarray], packs: list, block_rows: int = BLOCK_ROWS[0]):
    """Rows as blocks: a row of codes for each pack, labels, and copies if there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, block_rows):
            codes = np.zeros((len(packs), chunk.num_rows), "uint16")
            for code, (places, shape) in zip(codes, packs):
                for at, size in zip(places, shape):
                    code *= np.uint16(size)
                    code += np.searchsorted(edges[at], chunk.column(at).to_numpy()).astype("uint16")
            copies = chunk["copies"]
            yield pa.RecordBatch.from_pydict(
                {
                    "codes": [codes.tobytes()],
                    "y": [chunk["y"].to_numpy().astype("uint8").tobytes()],
                    "copies": [b"" if copies.null_count else copies.to_numpy().tobytes()],
                }
            )

    return run


# --- Trees -------------------------------------------------------------------
# Nodes are numbered from 1; those below node i are 2i and 2i + 1. ``splits`` has (pack, which of its codes go to
# the second one) of each inner node, ``values`` the mean residual of each leaf.


def _boost(blocks: DataFrame, packs: list, by_label: np.ndarray, trees: int, step: float, depth: int) -> np.ndarray:
    """The summed gain of each column."""
    spark = blocks.sparkSession
    gains = np.zeros(sum(len(places) for places, _ in packs))
    _cut_lineage(spark)
    # Codes, labels, copies and scores of each block; there are no scores before the first tree.
    state = blocks.rdd.mapPartitions(_arrays(len(packs))).persist(StorageLevel.MEMORY_AND_DISK)
    root = _sums(state, packs, by_label, {}, [1])[0]
    counts, checkpoint = root[:2], None
    smallest = ROUNDING * float(counts[:, 0].sum(-1) @ by_label)
    for tree in range(trees):
        nodes = {1: np.concatenate([counts, root[2:]])}
        splits: dict[int, tuple] = {}
        values: dict[int, float] = {}
        for level in range(depth):
            wanted = []
            for node, found in nodes.items():
                best = _best(found, by_label, smallest)
                if best is None:
                    values[node] = _mean(found, by_label)
                    continue
                place, bin_, gain, values[2 * node], values[2 * node + 1], smaller = best
                gains[place] += gain
                splits[node] = _side(packs, place, bin_)
                wanted.append(2 * node + smaller)
            if not wanted or level == depth - 1:
                break
            children = {}
            for node, found in zip(wanted, _sums(state, packs, by_label, splits, wanted)):
                children[node], children[node ^ 1] = found, nodes[node // 2] - found
            nodes = children
        if tree == trees - 1:
            break
        by_task = spark.sparkContext.accumulator({}, _ByTask())
        before, state = state, state.mapPartitions(
            _scored(splits, values, step if tree else 1.0, packs, by_label, by_task)
        ).persist(StorageLevel.MEMORY_AND_DISK)
        if tree % CHECKPOINT == CHECKPOINT - 1:
            state.checkpoint()
        # Scores are computed and stored by this, and no Python worker reads them.
        state._jrdd.count()
        root, by_task.value = sum(by_task.value.values())[0], {}
        # The scores that these came from are not needed again.
        before.unpersist()
        if state.is_checkpointed:
            checkpoint, old = state.getCheckpointFile(), checkpoint
            _delete(spark, old)
    state.unpersist()
    _delete(spark, checkpoint)
    return gains


def _cut_lineage(spark: SparkSession) -> None:
    """Let the scores be written to a checkpoint, which happens every few trees."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(new_path(spark, "boosting"))


def _delete(spark: SparkSession, folder: str | None) -> None:
    if folder:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class _ByTask(AccumulatorParam):
    """Sums by partition, so that a task which runs twice counts once."""

    def zero(self, value: dict) -> dict:
        return {}

    def addInPlace(self, value1: dict, value2: dict) -> dict:
        return value1 | value2


def _arrays(packs: int, block_rows: int = BLOCK_ROWS[1]):
    def joined(held: list[tuple]) -> tuple:
        codes, y, copies = zip(*held)
        return np.concatenate(codes, axis=1), np.concatenate(y), None if copies[0] is None else np.concatenate(copies), None

    def run(rows: Iterator) -> Iterator[tuple]:
        held, size = [], 0
        for row in rows:
            y = np.frombuffer(row["y"], "uint8")
            copies = np.frombuffer(row["copies"]) if row["copies"] else None
            held.append((np.frombuffer(row["codes"], "uint16").reshape(packs, len(y)), y, copies))
            size += len(y)
            if size >= block_rows:
                yield joined(held)
                held, size = [], 0
        if held:
            yield joined(held)

    return run


def _residuals(y: np.ndarray, scores: np.ndarray | None) -> np.ndarray:
    """The labels -1 and 1 for the first tree, then the negative gradient of the logistic loss."""
    sign = y * 2.0 - 1.0
    if scores is None:
        return sign
    with np.errstate(over="ignore"):
        return 4.0 * sign / (1.0 + np.exp(2.0 * sign * scores))


def _rows_by_node(codes: np.ndarray, splits: dict, wanted: set[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each wanted node, or of each leaf."""
    above = None if wanted is None else {node >> up for node in wanted for up in range(node.bit_length())}
    left = [(1, np.arange(codes.shape[1]))]
    while left:
        node, rows = left.pop()
        if node not in splits or (wanted is not None and node in wanted):
            yield node, rows
            continue
        pack, second = splits[node]
        side = second.take(codes[pack].take(rows))
        if above is None or 2 * node in above:
            left.append((2 * node, rows.take(np.flatnonzero(~side))))
        if above is None or 2 * node + 1 in above:
            left.append((2 * node + 1, rows.take(np.flatnonzero(side))))


def _sums(
    state: RDD, packs: list, by_label: np.ndarray, splits: dict, wanted: list[int], counted: bool = True
) -> np.ndarray:
    """Rows of label 0, rows of label 1 and weighted residuals, by wanted node, column and bin."""
    found = state.mapPartitions(_block_sums(packs, by_label, splits, wanted, counted))
    if state.getNumPartitions() > MAX_PARTS:
        return found.treeReduce(np.add)
    return sum(found.collect())


def _block_sums(packs: list, by_label: np.ndarray, splits: dict, wanted: list[int], counted: bool):
    width = max(int(np.prod(shape)) for _, shape in packs)
    places, bins = sum(len(p) for p, _ in packs), max(max(shape) for _, shape in packs)
    slots = {node: slot for slot, node in enumerate(wanted)}

    def run(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        cells = len(wanted) * 2 * width
        totals = np.zeros((2, len(packs), cells))
        for codes, y, copies, scores in blocks:
            if wanted == [1]:
                rows, base = None, y.astype("int64")
            else:
                parts = list(_rows_by_node(codes, splits, set(wanted)))
                rows = np.concatenate([r for _, r in parts])
                base = np.repeat([2 * slots[node] for node, _ in parts], [len(r) for _, r in parts])
                y, copies, scores = (None if a is None else a.take(rows) for a in (y, copies, scores))
                base += y
            base *= width
            weighted = _residuals(y, scores) * by_label.take(y)
            if copies is not None:
                weighted *= copies
            for pack, code in enumerate(codes):
                cell = base + (code if rows is None else code.take(rows))
                if counted:
                    totals[0, pack] += np.bincount(cell, copies, cells)
                totals[1, pack] += np.bincount(cell, weighted, cells)
        out = np.zeros((len(wanted), 3, places, bins))
        totals = totals.reshape(2, len(packs), len(wanted), 2, width)
        for pack, (members, shape) in enumerate(packs):
            rows_of, residuals = totals[:, pack, ..., : np.prod(shape)].reshape(2, len(wanted), 2, *shape)
            for axis, (place, size) in enumerate(zip(members, shape)):
                others = tuple(2 + k for k in range(len(shape)) if k != axis)
                out[:, :2, place, :size] = rows_of.sum(axis=others)
                out[:, 2, place, :size] = residuals.sum(axis=(1, *others))
        yield out

    return run


def _scored(splits: dict, values: dict[int, float], weight: float, packs: list, by_label: np.ndarray, by_task):
    """Blocks with the scores of one more tree; the residuals that are left go to ``by_task``."""
    root_sums = _block_sums(packs, by_label, {}, [1], False)

    def scored(block: tuple) -> tuple:
        codes, y, copies, scores = block
        scores = np.zeros(len(y)) if scores is None else scores.copy()
        for node, rows in _rows_by_node(codes, splits):
            scores[rows] += weight * values[node]
        return codes, y, copies, scores

    def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
        sums = 0.0
        for block in blocks:
            block = scored(block)
            sums += next(root_sums(iter([block])))
            yield block
        by_task.add({TaskContext.get().partitionId(): sums})

    return run


def _mean(found: np.ndarray, by_label: np.ndarray) -> float:
    return float(found[2, 0].sum() / (by_label @ found[:2, 0].sum(-1)))


def _best(found: np.ndarray, by_label: np.ndarray, smallest: float) -> tuple | None:
    """(column, last bin of the first side, gain, mean of either side, whether the second has fewer rows)."""
    first = np.cumsum(found, axis=-1)
    second = first[..., -1:] - first
    first, second = first[..., :-1], second[..., :-1]
    weights = [np.tensordot(by_label, side[:2], 1) for side in (first, second)]
    with np.errstate(divide="ignore", invalid="ignore"):
        means = [side[2] / weight for side, weight in zip((first, second), weights)]
        gain = weights[0] * weights[1] / (weights[0] + weights[1]) * (means[0] - means[1]) ** 2
    # Rows are whole numbers, so an empty side is told without rounding.
    gain[(first[:2].sum(0) < 1) | (second[:2].sum(0) < 1)] = 0.0
    if not gain.size or gain.max() <= smallest:
        return None
    at = np.unravel_index(np.argmax(gain >= gain.max() * (1 - TIE)), gain.shape)
    fewer = second[:2].sum(0)[at] < first[:2].sum(0)[at]
    return int(at[0]), int(at[1]), float(gain[at]), float(means[0][at]), float(means[1][at]), int(fewer)


def _side(packs: list, place: int, bin_: int) -> tuple[int, np.ndarray]:
    """The pack of a column and which of its codes have a bin behind this one."""
    for pack, (members, shape) in enumerate(packs):
        if place in members:
            bins = np.indices(shape)[members.index(place)].ravel()
            return pack, bins > bin_
    raise KeyError(place)
