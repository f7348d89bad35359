"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.lineage import materialize
from tabloom.functions.workers import ship_package as ship_package

#: A side of at most so many short rows may be broadcast.
SMALL_ROWS = 200_000
#: A key with at least this share of all rows is a heavy one, so there are at most 1 / share of them.
HEAVY_SHARE = 0.001

U64 = np.uint64


def is_small(df: DataFrame) -> bool:
    """Whether a table has at most SMALL_ROWS rows; reads no more than that."""
    return df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """The table with a broadcast hint if its rows are few; else Spark joins by shuffle."""
    return F.broadcast(df) if is_small(df) else df


def join_groups(
    rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, how: str = "inner"
) -> DataFrame:
    """Join rows to one row per group, without a hot key in any task.

    Few groups go by broadcast. Of many, those that hold at least HEAVY_SHARE of all rows are at most
    1 / HEAVY_SHARE and go by broadcast; every other key is small enough for a shuffle. `how` is inner
    or left.
    """
    if is_small(groups):
        return rows.join(F.broadcast(groups), keys, how)
    is_heavy = F.col(size) >= max(2, int(total * HEAVY_SHARE))
    heavy = F.broadcast(groups.where(is_heavy))
    hot = rows.join(heavy, keys, "inner")
    rest = rows.join(F.broadcast(groups.where(is_heavy).select(*keys)), keys, "left_anti")
    return hot.unionByName(rest.join(groups.where(~is_heavy), keys, how), allowMissingColumns=True)


def free_name(taken: Iterable[str], wanted: str) -> str:
    """`wanted`, with underscores in front while a column has that name already."""
    taken = {c.lower() for c in taken}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def small(
    batches: Iterable[pa.RecordBatch], rows: int = 2048, size: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few rows and bytes, so that what Python makes of one stays small.

    Behind the last one a worker, which Spark uses for later stages too, gives back what it does not use.
    """
    batch = part = None
    for batch in batches:
        waiting = [batch]
        while waiting:
            part = waiting.pop()
            half = part.num_rows // 2
            if half and (part.num_rows > rows or part.nbytes > size):
                waiting += [part.slice(half), part.slice(0, half)]
            elif part.num_rows:
                yield part
    del batch, part
    release_memory()


def release_memory() -> None:
    """Return unused memory of Arrow and of the C library to the system, where they can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def append_columns(
    df: DataFrame,
    column: str,
    fields: list[T.StructField],
    start: Callable[[], Callable[[pa.Array], list[pa.Array]]],
) -> DataFrame:
    """Add columns computed from one column, batch by batch.

    `start` runs once in each task and returns the function of a batch. A column of the frame that
    has the name of a new one is replaced.
    """
    new = {f.name.lower() for f in fields}
    keep = [c for c in df.columns if c.lower() not in new or c == column]
    base = df.select(*[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([f for f in base.schema if f.name.lower() not in new] + fields)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in small(batches):
            values = dict(zip(batch.schema.names, batch.columns, strict=True))
            values |= dict(zip([f.name for f in fields], work(values[column]), strict=True))
            yield pa.RecordBatch.from_arrays([values[n] for n in names], names=names)

    return base.mapInArrow(run, schema)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The values of a text column in UTF-8."""
    return column.cast(pa.binary()).to_pylist()


class WordHashes(dict):
    """64-bit hash of each word seen; a cache that is emptied when it is full."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finishing steps of a public 64-bit mixer)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each run of `size` consecutive word hashes."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, dtype=U64)
    out = np.full(count, size, dtype=U64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = mix(out * U64(0x9E3779B97F4A7C15) + words[i : i + count])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for, and notes the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


class ChunkTable:
    """Distinct chunks with their ids: each chunk is segmented once, documents gather by position.

    `encode_many` turns a list of chunks into a list of id lists. The table starts anew when it holds
    more than `limit` chunks; that changes no result.
    """

    def __init__(self, encode_many: Callable[[list], list[list[int]]], limit: int = 400_000):
        self.encode_many, self.limit = encode_many, limit
        self.clear()

    def clear(self) -> None:
        self.index = _Numbers()
        self.flat = np.empty(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.int64)

    def ids(self, documents: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents one after another, and where each document starts."""
        if len(self.index) > self.limit:
            self.clear()
        lengths = np.fromiter(map(len, documents), dtype=np.int64, count=len(documents))
        chunks = chain.from_iterable(documents)
        at = np.fromiter(map(self.index.__getitem__, chunks), dtype=np.int64, count=int(lengths.sum()))
        if self.index.new:
            coded = self.encode_many(self.index.new)
            self.index.new.clear()
            sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
            ids = np.fromiter(chain.from_iterable(coded), dtype=np.int32, count=int(sizes.sum()))
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            self.flat = np.concatenate([self.flat, ids])
        sizes = self.starts[at + 1] - self.starts[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.starts[at] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[np.concatenate([[0], np.cumsum(lengths)])]


_KEPT: dict[tuple, object] = {}


def kept_in_worker(key: tuple, make: Callable[[], object]):
    """What `make` returns, made once in each Python worker, which Spark uses for many tasks.

    A worker keeps one such thing: what an earlier stage needed goes when a later one asks for its own.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
        release_memory()
    return _KEPT[key]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest node) for every node that an edge names.

    Alternating stars: each node links its neighbours to the smallest one it knows. Minima are combined
    inside the tasks, hot nodes are joined by broadcast, each round is written to the shared folder.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v").distinct()
    links = materialize(links, "links")
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = materialize(_star(both, F.col("v") > F.col("u")), "links")
        down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        links = materialize(_star(down, F.lit(True)), "links")
        row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if row == before:
            break
        before = row
    out = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    own = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return out.unionByName(own)


def _star(links: DataFrame, wanted) -> DataFrame:
    """Link the wanted neighbours of each node, and the node itself, to the smallest of them all."""
    least = links.groupBy("u").agg(
        F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("n")
    )
    total = links.count()
    out = join_groups(links, least, ["u"], "n", total)
    sent = out.where(wanted).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return sent.union(own).where("u != v").distinct()
