"""Near-duplicate documents by HyperMinHash registers, exact on full shingle sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.lineage import materialize
from tabloom.llm.common import (
    U64,
    WordHashes,
    as_bytes,
    connected_components,
    join_groups,
    kept_in_worker,
    maybe_broadcast,
    mix,
    signed,
    small,
    window_hashes,
)

#: Bands of registers; two documents of similarity 0.8 share none with a chance of 1.3e-7.
BANDS, BAND_REGISTERS = 40, 5
REGISTERS = BANDS * BAND_REGISTERS
MANTISSA_BITS = 10
#: Standard errors that the estimate may lie below the threshold before a pair is given up.
MARGIN = 5
#: Rows and queries of a block in the comparison of components that share a bucket.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
#: Pairs that read one copy of a set.
PAIRS_PER_COPY = 2_000
#: Shingles of a block in which sets are compared.
BLOCK_SHINGLES = 1_000_000

# What a document does in a block of sets.
LEADER, QUERY, ROW = 0, 1, 2

#: Odd multipliers, one for each register.
_FACTORS = (mix(np.arange(1, REGISTERS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) >> U64(32)).astype(
    np.uint32
) | np.uint32(1)


def shingle_set(text: bytes, size: int, table: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; of the whole text if it has fewer words.

    A-Z count as lower case, words are cut at ASCII white space.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=U64)
    return np.unique(window_hashes(table.of(words), min(size, len(words))))


def registers_of(shingles: np.ndarray) -> np.ndarray:
    """One register for each hash function: leading zeros of the minimum, then its next bits."""
    keys = (shingles >> U64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(keys), 1024):
        hashed = keys[at : at + 1024, None] * _FACTORS
        np.minimum(least, hashed.min(axis=0), out=least)
    zeros = (32 - np.frexp(least.astype(np.float64))[1]).astype(np.int64)
    wide = least.astype(np.int64) << (zeros + 1) & 0xFFFFFFFF
    return (zeros << MANTISSA_BITS | wide >> (32 - MANTISSA_BITS)).astype("<u2")


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row of registers."""
    parts = registers.reshape(len(registers), BANDS, BAND_REGISTERS).astype(U64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64), parts.shape[:2])
    with np.errstate(over="ignore"):
        for i in range(BAND_REGISTERS):
            keys = mix(keys * U64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from counts of equal registers, less those that are equal by chance.

    Two independent minima agree if they fall into the same octave and there on the same mantissa.
    """
    edges = 0.5 ** np.arange(0, 34)

    def octaves(size: np.ndarray) -> np.ndarray:
        above = np.exp(np.asarray(size, dtype=float)[..., None] * np.log1p(-np.minimum(edges, 1 - 1e-12)))
        return above[..., 1:] - above[..., :-1]

    chance = (octaves(n) * octaves(m)).sum(axis=-1) / (1 << MANTISSA_BITS)
    return (equal / REGISTERS - chance) / (1 - chance)


def lowest_estimate(percent: int) -> float:
    share = percent / 100
    return share - MARGIN * np.sqrt(share * (1 - share) / REGISTERS)


def _scan(df: DataFrame, size: int, doc_id: str, text: str, with_set: bool) -> DataFrame:
    """doc_id, n_shingles and either the digest and registers of the set, or the set itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept_in_worker(("word hashes",), WordHashes)
        for batch in small(batches):
            sets = [shingle_set(t or b"", size, table) for t in as_bytes(batch.column(1))]
            counts = pa.array([len(s) for s in sets], pa.int64())
            if with_set:
                arrays = [batch.column(0), counts, pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_shingles", "shingles"])
                continue
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            registers = [registers_of(s).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(digests, pa.binary()), pa.array(registers, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "registers"],
            )

    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rest = "shingles binary" if with_set else "digest binary, registers binary"
    return source.mapInArrow(run, f"doc_id long, n_shingles long, {rest}")


def _bands(documents: DataFrame) -> DataFrame:
    """doc_id, band, key: one row for each band of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            joined = b"".join(batch.column(1).to_pylist())
            keys = band_keys(np.frombuffer(joined, dtype="<u2").reshape(-1, REGISTERS))
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
            bands = np.tile(np.arange(BANDS, dtype=np.int32), len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(bands), pa.array(signed(keys.ravel()))],
                names=["doc_id", "band", "key"],
            )

    return documents.select("doc_id", "registers").mapInArrow(run, "doc_id long, band int, key long")


def _copies_join(pairs: DataFrame, table: DataFrame, key: str, name: str) -> DataFrame:
    """Add the row of `table` for pairs.key as a struct; rows that many pairs need are copied first.

    Pairs of one key are dealt over as many copies as PAIRS_PER_COPY asks for, so a document with very
    many partners meets them in many tasks.
    """
    uses = pairs.groupBy(key).agg(F.ceil(F.count("*") / PAIRS_PER_COPY).cast("long").alias("copies"))
    hot = F.broadcast(materialize(uses.where("copies > 1"), "hot-documents"))
    other = "b" if key == "a" else "a"
    dealt = pairs.join(hot, key, "left").withColumn(
        "copy", F.when(F.col("copies").isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64(other), F.col("copies")))
    )
    copied = table.join(hot.withColumnRenamed(key, "doc_id"), "doc_id", "left").withColumn(
        "copy", F.explode(F.expr("sequence(0L, coalesce(copies, 1L) - 1L)"))
    )
    fields = [c for c in table.columns if c != "doc_id"]
    copied = copied.select(
        F.col("doc_id").alias(key), "copy", F.struct(*fields).alias(name)
    )
    return dealt.drop("copies").join(copied, [key, "copy"]).drop("copy")


def _near(pairs: DataFrame, registers: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b that are alike by estimate on their registers, which gives up only pairs far below."""
    least = lowest_estimate(percent)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 1000):
            x, y = batch.column(2), batch.column(3)
            equal = _table(x.field("registers")) == _table(y.field("registers"))
            n, m = (np.asarray(s.field("n_shingles")) for s in (x, y))
            # Sizes alone rule out pairs that differ by more than the threshold allows.
            fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            keep = fits & (estimate(equal.sum(axis=1), n, m) >= least)
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(keep)) for c in batch.columns[:2]], names=["a", "b"]
            )

    rows = _copies_join(_copies_join(pairs, registers, "a", "x"), registers, "b", "y")
    return materialize(rows.select("a", "b", "x", "y").mapInArrow(near, "a long, b long"), "near-pairs")


def _table(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, REGISTERS)


def _stars(members: DataFrame, total: int) -> DataFrame:
    """Pairs of each bucket's members with its most central one: the one with most company in all buckets."""
    central = members.groupBy("doc_id").agg(F.sum("n").alias("company"))
    ranked = members.join(central, "doc_id")
    leaders = ranked.groupBy("key").agg(
        F.max(F.struct("company", -F.col("doc_id"))).alias("top"), F.max("n").alias("n")
    )
    leaders = leaders.select("key", "n", (-F.col("top.col2")).alias("leader"))
    pairs = join_groups(members.drop("n"), leaders, ["key"], "n", total)
    return pairs.select(
        F.least("doc_id", "leader").alias("a"), F.greatest("doc_id", "leader").alias("b")
    ).where("a != b").distinct()


def _numbers(column: str):
    """A row for each number below the value of a column."""
    return F.explode(F.expr(f"sequence(0L, {column} - 1L)"))


def _across(members: DataFrame, cluster: DataFrame, registers: DataFrame, percent: int, total: int) -> DataFrame:
    """Pairs that connect different clusters, share a bucket and have registers that look alike.

    In a bucket with several clusters the documents outside the largest one are queries against all
    of its documents, in blocks of bounded size. A pair is handled in the first band that it shares. Of
    the pairs of a block only such are returned as connect what no other has connected: fewer than it has
    documents.
    """
    least = lowest_estimate(percent)
    placed = members.join(cluster.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "doc_id"))
    placed = materialize(placed, "placed")
    by_component = placed.groupBy("key", "component").agg(F.count("*").alias("c"))
    buckets = by_component.groupBy("key").agg(
        F.sum("c").alias("n"), F.max(F.struct("c", "component")).alias("largest"), F.count("*").alias("k")
    )
    buckets = buckets.where("k > 1").select(
        "key",
        "n",
        F.col("largest.component").alias("main"),
        F.ceil(F.col("n") / BLOCK_ROWS).cast("long").alias("row_blocks"),
        F.ceil((F.col("n") - F.col("largest.c")) / BLOCK_QUERIES).cast("long").alias("query_blocks"),
    )
    buckets = materialize(buckets, "open-buckets")
    open_rows = join_groups(placed.drop("n"), buckets, ["key"], "n", total)
    open_rows = open_rows.join(registers, "doc_id")
    row_block = F.pmod(F.xxhash64("doc_id"), F.col("row_blocks"))
    query_block = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("query_blocks"))

    fields = ["key", "band", "doc_id", "component", "n_shingles", "registers"]
    rows = open_rows.select(*fields, F.lit(False).alias("query"), row_block.alias("r"), "query_blocks")
    rows = rows.withColumn("q", _numbers("query_blocks"))
    queries = open_rows.where("component != main").select(
        *fields, F.lit(True).alias("query"), "row_blocks", query_block.alias("q")
    )
    queries = queries.withColumn("r", _numbers("row_blocks"))
    both = rows.drop("query_blocks").unionByName(queries.drop("row_blocks"))

    def compare(table: pa.Table) -> pa.Table:
        is_query = np.asarray(table["query"])
        ids, n = (np.asarray(table[c]) for c in ("doc_id", "n_shingles"))
        label = np.asarray(table["component"]).copy()
        values = _table(table["registers"].combine_chunks())
        band = table["band"][0].as_py()
        plain = np.flatnonzero(~is_query)
        found = []
        for q in np.flatnonzero(is_query):
            own = plain[label[plain] != label[q]]
            own = own[100 * np.minimum(n[own], n[q]) >= percent * np.maximum(n[own], n[q])]
            if not len(own):
                continue
            equal = values[own] == values[q]
            similar = estimate(equal.sum(axis=1), n[own], np.full(len(own), n[q]))
            first = equal.reshape(-1, BANDS, BAND_REGISTERS).all(axis=2).argmax(axis=1)
            found += _connect(label, q, own[(similar >= least) & (first == band)])
        return _pairs(ids, found)

    return both.groupBy("key", "q", "r").applyInArrow(compare, "a long, b long")


def _connect(label: np.ndarray, q: int, others: np.ndarray) -> list[tuple[int, int]]:
    """The pairs of q with those others that have another label still; each time the labels become one."""
    found = []
    for x in others.tolist():
        if label[x] != label[q]:
            label[label == label[x]] = label[q]
            found.append((q, x))
    return found


def _pairs(ids: np.ndarray, found: list[tuple[int, int]]) -> pa.Table:
    at = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": ids[at[:, 0]], "b": ids[at[:, 1]]})


def links_among(sets: list[np.ndarray], role: np.ndarray, label: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Places of linked sets that connect the labels of a block; `label` becomes the components.

    Roles are LEADER (first, at most one), QUERY and ROW. Queries are compared with all sets, on all of
    their elements; those that are connected to the leader already need not be.
    """
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    marked = np.zeros(len(numbers), dtype=bool)
    found: list[tuple[int, int]] = []
    for q in np.flatnonzero(role != ROW).tolist():
        if q and role[0] == LEADER and label[q] == label[0]:
            continue
        fits = 100 * np.minimum(sizes, sizes[q]) >= percent * np.maximum(sizes, sizes[q])
        others = np.flatnonzero(fits & (label != label[q]))
        if not len(others):
            continue
        own = numbers[starts[q] : ends[q]]
        marked[own] = True
        if len(others) <= 32:
            shared = np.array([np.count_nonzero(marked[numbers[starts[x] : ends[x]]]) for x in others])
        else:
            shared = np.add.reduceat(marked[numbers], starts, dtype=np.int64)[others]
        marked[own] = False
        linked = 100 * shared >= percent * (sizes[others] + sizes[q] - shared)
        found += _connect(label, q, others[linked])
    return found


def _links(sets: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Links a, b among the sets that `placed` brings together: doc_id, block, cluster, part, role, component."""
    fields = ["doc_id", "cluster", "part", "role", "component", "shingles"]

    def verify(table: pa.Table) -> pa.Table:
        table = table.select(fields).sort_by([(c, "ascending") for c in ("cluster", "part", "role", "doc_id")])
        ids, cluster, part, role, component = (np.asarray(table[c]) for c in fields[:5])
        new = (cluster[1:] != cluster[:-1]) | (part[1:] != part[:-1])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(ids)]
        out = [_pairs(ids[:0], [])]
        for a, b in zip(cuts, cuts[1:], strict=False):
            # A document that is there twice, as query and row, is a query.
            at = a + np.sort(np.unique(ids[a:b], return_index=True)[1])
            if len(at) > 1:
                own = [np.frombuffer(x.as_buffer(), dtype=U64) for x in table["shingles"].take(pa.array(at))]
                out.append(_pairs(ids[at], links_among(own, role[at], component[at], percent)))
        return pa.concat_tables(out)

    joined = sets.join(maybe_broadcast(placed), "doc_id").select("block", *fields)
    return materialize(joined.groupBy("block").applyInArrow(verify, "a long, b long"), "links")


def _blocks(placed: DataFrame) -> DataFrame:
    """Deal the parts of all clusters over blocks, whose number follows the shingles in them."""
    weight = placed.agg(F.sum("n_shingles")).first()[0] or 0
    number = F.lit(max(1, int(np.ceil(weight / BLOCK_SHINGLES))))
    return materialize(placed.withColumn("block", F.pmod(F.xxhash64("cluster", "part"), number)), "placed")


def _verify_clusters(
    members: DataFrame, cluster: DataFrame, registers: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int
) -> DataFrame:
    """Links a, b, confirmed on full sets, that connect all linked documents of each cluster.

    Any link is within a cluster. A cluster of at most BLOCK_SHINGLES shingles is one part, in which each
    set is once. A larger one is dealt into parts that all have its most central document, with most company
    in all buckets; then what lies in different components of such a cluster is compared in a grid of blocks.
    """
    company = members.groupBy("doc_id").agg(F.sum("n").alias("company"))
    documents = cluster.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
    documents = documents.join(registers.select("doc_id", "n_shingles"), "doc_id").join(company, "doc_id")
    documents = materialize(documents, "cluster-documents")
    total = documents.count()
    parts = F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("long")
    clusters = documents.groupBy("cluster").agg(
        F.count("*").alias("n"), parts.alias("parts"), F.max(F.struct("company", -F.col("doc_id"))).alias("top")
    )
    clusters = clusters.select("cluster", "n", "parts", (-F.col("top.col2")).alias("leader"))
    clusters = materialize(clusters, "cluster-sizes")
    placed = join_groups(documents.drop("company"), clusters, ["cluster"], "n", total)
    leads = F.col("doc_id") == F.col("leader")
    own_part = F.array(F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    placed = placed.select(
        "doc_id",
        "cluster",
        "n_shingles",
        F.when(leads, LEADER).otherwise(QUERY).alias("role"),
        F.col("doc_id").alias("component"),
        F.explode(F.when(leads, F.expr("sequence(0L, parts - 1L)")).otherwise(own_part)).alias("part"),
    )
    sets = sets_of(documents.select("doc_id"))
    links = _links(sets, _blocks(placed), percent)
    large = clusters.where("parts > 1")
    if large.isEmpty():
        return links

    component = materialize(connected_components(links), "part-components")
    open_rows = join_groups(documents.drop("company"), large.drop("leader"), ["cluster"], "n", total)
    open_rows = open_rows.join(component.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    open_rows = materialize(open_rows.withColumn("component", F.coalesce("component", "doc_id")), "open-rows")
    sizes = open_rows.groupBy("cluster", "component").agg(F.count("*").alias("c"), F.sum("n_shingles").alias("own"))
    sizes = sizes.groupBy("cluster").agg(F.max(F.struct("c", "component", "own")).alias("main"), F.sum("own").alias("all"))
    query_parts = F.ceil((F.col("all") - F.col("main.own")) / BLOCK_SHINGLES).cast("long")
    sizes = sizes.select("cluster", F.col("main.component").alias("main"), query_parts.alias("query_parts"))
    # One row for each cluster of more than BLOCK_SHINGLES.
    open_rows = open_rows.join(F.broadcast(sizes.where("query_parts > 0")), "cluster")
    row = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    query = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("query_parts"))
    fields = ["doc_id", "cluster", "n_shingles", "component"]
    rows = open_rows.select(*fields, F.lit(ROW).alias("role"), row.alias("i"), "query_parts", _numbers("query_parts").alias("j"))
    queries = open_rows.where("component != main").select(
        *fields, F.lit(QUERY).alias("role"), _numbers("parts").alias("i"), "query_parts", query.alias("j")
    )
    placed = rows.unionByName(queries).withColumn("part", F.col("i") * F.col("query_parts") + F.col("j"))
    return links.union(_links(sets, _blocks(placed.drop("i", "j", "query_parts")), percent))


def near_duplicates(
    df: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document.

    Two documents are linked if 100 * intersection >= percent * union of their sets of `words`-word
    shingles; component_id is the smallest doc_id that links lead to, and that document is kept.
    Documents without a word (NULL, empty, white space) have an empty set and stand alone. Repeated rows
    are rows of one document. Empty in, empty out.

    Documents with equal sets form a class, of which only the smallest doc_id goes on. Classes that
    agree in a band of registers meet in a bucket; those whose registers look alike form clusters: first each
    member with the most central one, then whatever still lies in different clusters of a bucket, in blocks.
    Every link between classes that share a band is thus within a cluster. There full sets are compared,
    each sent to one block unless its cluster is a large one, and only links that connect are kept.
    """
    scanned = materialize(_scan(df, words, doc_id, text, with_set=False), "registers")
    total = scanned.count()
    filled = scanned.where("n_shingles > 0")
    classes = filled.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size"))
    classes = materialize(classes, "classes")
    first = classes.select(F.col("rep").alias("doc_id"))
    documents = filled.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    documents = materialize(documents.select("doc_id", "n_shingles", "registers"), "class-registers")
    bands = materialize(_bands(documents), "bands")
    rows = total * BANDS
    buckets = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(
        join_groups(bands, materialize(buckets, "buckets"), ["key"], "n", rows), "members"
    )
    wanted = materialize(members.select("doc_id").distinct(), "candidates")
    wanted = maybe_broadcast(wanted)
    registers = materialize(documents.join(wanted, "doc_id", "left_semi"), "candidate-registers")
    alike = _near(_stars(members, rows), registers, percent)
    cluster = materialize(connected_components(alike), "clusters")
    more = materialize(_across(members, cluster, registers, percent, rows), "more-alike")
    if not more.isEmpty():
        cluster = materialize(connected_components(alike.union(more)), "clusters")
    texts = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def sets_of(some: DataFrame) -> DataFrame:
        found = texts.join(maybe_broadcast(some), "doc_id", "left_semi")
        return _scan(found, words, "doc_id", "text", with_set=True).drop("n_shingles")

    links = _verify_clusters(members, cluster, registers, sets_of, percent)
    component = materialize(connected_components(links), "components")

    joined = classes.join(component.withColumnRenamed("node", "rep"), "rep", "left")
    joined = joined.select("digest", "size", F.coalesce("component", "rep").alias("component"))
    out = join_groups(
        filled.select("doc_id", "n_shingles", "digest"), materialize(joined, "class-components"),
        ["digest"], "size", total,
    ).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    alone = scanned.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id") == F.col("component_id"))
