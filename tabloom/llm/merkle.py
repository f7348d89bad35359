"""Merkle manifest of a dataset by time-forward processing.

Rows are leaves, the leaves of a group (a source) form a tree of runs of three, the roots of all groups
form one more such tree. A tree is cut into blocks of 3 ** levels leaves, so that no group, however
large, meets in one task; the roots of its blocks are the leaves of the next round.

Within a block nodes are processed in the order of their labels (last leaf below, level). The shuffle
sorts the leaves by label, which is the external part of the priority queue; a heap in the task holds
the digests that wait for a parent, never more than two for each level. The reversed sweep reads the
written nodes from the last label to the first, and the queue delivers to each child its parent's
proof with the child's siblings in front.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tabloom.functions.columns import quoted
from tabloom.functions.lineage import materialize
from tabloom.llm.common import ship_package

ARITY = 3
#: Levels of a tree that one task works off: blocks of 6,561 leaves.
LEVELS = 8
HEX = 64
#: Label of the message to the top of a block: before all others in the reversed sweep.
_FIRST = (1 << 62, 99)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(columns: Iterable[Column]) -> Column:
    """SHA-256 in hex of the columns: `-` for NULL, else UTF-8 byte count, `:` and the value."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _rows(schema: pa.Schema, rows: Iterable[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches."""
    rows = iter(rows)
    while waiting := list(islice(rows, size)):
        columns = zip(*waiting, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _blocks(rows: Iterator[tuple]) -> Iterator[tuple[object, int, Iterator[tuple]]]:
    """Consecutive rows of one (tree, block), which are their first two values, as one stream each."""
    waiting = next(rows, None)

    def same(tree, block):
        nonlocal waiting
        while waiting is not None and waiting[0] == tree and waiting[1] == block:
            yield waiting
            waiting = next(rows, None)

    while waiting is not None:
        tree, block = waiting[:2]
        stream = same(tree, block)
        yield tree, block, stream
        for _ in stream:
            pass


_NODES = "tree string, block long, end long, level int, digest string, children string, top boolean, done boolean"
_NODE_ROWS = pa.schema(
    [("tree", pa.string()), ("block", pa.int64()), ("end", pa.int64()), ("level", pa.int32()), ("digest", pa.string()),
     ("children", pa.string()), ("top", pa.bool_()), ("done", pa.bool_())]
)


def block_nodes(tree, block: int, leaves: Iterable[tuple[int, str]], levels: int) -> Iterator[tuple]:
    """Nodes of one block in the order of their labels, from (position, digest) in order.

    A node's label is (last position it could cover, level). The last row is the top of the block. A
    tree that ends in its first block stops at its root (`done`); any other block goes up all levels.
    """
    heap: list[tuple[int, int, int, str]] = []

    def send(end: int, level: int, child: str) -> None:
        width = ARITY ** (level + 1)
        heapq.heappush(heap, ((end // width + 1) * width - 1, level + 1, end, child))

    def pop() -> tuple[int, int, str]:
        end, level = heap[0][:2]
        children = []
        while heap and heap[0][:2] == (end, level):
            children.append(heapq.heappop(heap)[3])
        return end, level, "".join(children)

    position, child = -1, ""
    for position, child in leaves:
        while heap and heap[0][0] < position:
            end, level, children = pop()
            own = digest(children)
            yield tree, block, end, level, own, children, False, False
            if level < levels:
                send(end, level, own)
        send(position, 0, child)
    lone = block == 0 and position + 1 < ARITY**levels
    if lone and position == 0:
        yield tree, block, 0, 0, child, None, True, True
        return
    while heap:
        end, level, children = pop()
        own = digest(children)
        top = level == levels or (lone and ARITY**level > position)
        yield tree, block, end, level, own, children, top, top and lone
        if top:
            return
        send(end, level, own)


def _block(levels: int) -> Column:
    return F.expr(f"position div {ARITY**levels}").alias("block")


def _forward(leaves: DataFrame, levels: int) -> DataFrame:
    """Nodes of all blocks, from (tree, position, digest)."""
    blocked = leaves.select("tree", _block(levels), "position", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes():
            for tree, block, stream in _blocks(_tuples(batches)):
                yield from block_nodes(tree, block, (r[2:] for r in stream), levels)

        yield from _rows(_NODE_ROWS, nodes())

    dealt = blocked.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")
    return dealt.mapInArrow(run, _NODES)


def block_proofs(above: str, rows: Iterable[tuple]) -> Iterator[tuple[int, str, tuple]]:
    """(position, proof, row) of the leaves of one block, last first, given the proof of its top.

    Rows start with (tree, block, end, level, children), in falling order of (end, level); leaves have
    level 0. A proof is, level by level upwards, the place in the run, the size of the run and the
    digests of the others in it.
    """
    heap: list[tuple[int, int, str]] = []
    for row in rows:
        _, _, end, level, children = row[:5]
        if above is None:
            *label, proof = heapq.heappop(heap)
            if label != [-end, -level]:
                raise ValueError(f"node {end}, {level} of tree {row[0]!r} is not its parent's child")
        else:
            proof, above = above, None
        if not level:
            yield end, proof, row
            continue
        count = len(children) // HEX
        width = ARITY ** (level - 1)
        first = end // (width * ARITY) * ARITY
        for i in range(count):
            others = children[: i * HEX] + children[(i + 1) * HEX :]
            heapq.heappush(heap, (1 - (first + i + 1) * width, 1 - level, f"{i}{count}{others}{proof}"))


_PROOFS = [T.StructField(n, T.StringType()) for n in ("tree", "proof", "subroot")]
_PROOFS.insert(1, T.StructField("position", T.LongType()))


def _backward(leaves: DataFrame, nodes: DataFrame, messages: DataFrame, levels: int, carried: list[str]) -> DataFrame:
    """tree, position, proof, subroot and the carried columns of all leaves.

    `messages` are the proofs of the tops of all blocks: (tree, block, proof, subroot).
    """
    # Leaves, nodes and messages in one sorted stream; each has what it lacks as NULL.
    rows = (
        messages.withColumns({"end": F.lit(_FIRST[0]), "level": F.lit(_FIRST[1])})
        .unionByName(nodes.where("level > 0").select("tree", "block", "end", "level", "children"), True)
        .unionByName(
            leaves.select(
                "tree",
                _block(levels),
                F.col("position").alias("end"),
                F.lit(0).alias("level"),
                *carried,
            ),
            True,
        )
        .select("tree", "block", "end", "level", "children", "proof", "subroot", *carried)
    )
    schema = T.StructType([*_PROOFS, *[rows.schema[c] for c in carried]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def proofs():
            for tree, _, stream in _blocks(_tuples(batches)):
                message = next(stream)
                for position, proof, row in block_proofs(message[5], stream):
                    yield tree, position, proof, message[6], *row[7:]

        yield from _rows(to_arrow_schema(schema), proofs(), 1024)

    order = ["tree", "block", F.col("end").desc(), F.col("level").desc()]
    return rows.repartition("tree", "block").sortWithinPartitions(*order).mapInArrow(run, schema)


@dataclass
class Forest:
    """The rounds of all trees: leaves and written nodes of each, and the root of every tree."""

    rounds: list[tuple[DataFrame, DataFrame]]
    roots: DataFrame
    levels: int

    @classmethod
    def build(cls, leaves: DataFrame, levels: int = LEVELS) -> Forest:
        """Forward sweep over (tree, position, digest); positions of a tree count from 0 without gaps."""
        rounds, roots = [], None
        while True:
            nodes = materialize(_forward(leaves, levels), "merkle-nodes")
            rounds.append((leaves, nodes))
            done = nodes.where("done").select("tree", "digest")
            roots = done if roots is None else roots.union(done)
            leaves = nodes.where("top and not done").select("tree", F.col("block").alias("position"), "digest")
            if leaves.isEmpty():
                return cls(rounds, roots, levels)

    def proofs(self, messages: DataFrame, carried: list[str] | None = None) -> DataFrame:
        """Reversed sweep: tree, position, proof, subroot and carried columns of the leaves.

        `messages` are the proofs of the roots: (key, proof, subroot), key being the tree.
        """
        below = None
        for leaves, nodes in reversed(self.rounds):
            own = nodes.where("done").select("tree", "block").join(messages, F.expr("tree <=> key")).drop("key")
            if below is not None:
                own = own.unionByName(below.withColumnRenamed("position", "block"))
            last = leaves is self.rounds[0][0]
            below = _backward(leaves, nodes, own, self.levels, (carried or []) if last else [])
            if not last:
                below = materialize(below, "merkle-proofs")
        return below


def number_leaves(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add `position`, the place of a row in its tree by `order`, without a tree meeting in one task.

    Rows are range-partitioned by tree and order and written, each with its place among the rows of its
    tree in its partition. Only trees that go on from an earlier partition need an offset: at most one
    for each partition.
    """
    fields = T.StructType([*rows.schema, T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType())])
    at = rows.columns.index(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        now, count = object(), 0
        for batch in batches:
            places = []
            for value in batch.column(at).to_pylist():
                if value != now:
                    now, count = value, 0
                places.append(count)
                count += 1
            columns = [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=fields.fieldNames())

    ranged = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    numbered = materialize(ranged.mapInArrow(run, fields), "merkle-leaves")
    parts = numbered.groupBy(F.col(tree).alias("of_tree"), F.col("part").alias("of_part")).agg(F.count("*").alias("n"))
    ahead = parts.selectExpr("of_tree", "of_part", "sum(n) over (partition by of_tree order by of_part) - n as ahead")
    # Trees that start in a partition need none, so this has at most as many rows as there are partitions.
    offsets = F.broadcast(ahead.where("ahead > 0"))
    joined = numbered.join(offsets, F.expr(f"`{tree}` <=> of_tree and part = of_part"), "left")
    return joined.withColumn("position", F.col("place") + F.coalesce("ahead", F.lit(0))).drop(
        "of_tree", "of_part", "ahead", "part", "place"
    )


@dataclass
class Manifest:
    """leaves: tree, position, key, digest, carried columns; sources: tree, subroot, position.

    `root` is that of everything, None if there are no rows.
    """

    leaves: DataFrame
    sources: DataFrame
    root: str | None
    _forest: Forest
    _top: Forest

    def proofs(self) -> DataFrame:
        """The leaves with `proof` and `subroot`; a proof leads from the leaf to the root."""
        spark = self.leaves.sparkSession
        start = spark.createDataFrame([("", "", "")], "key string, proof string, subroot string")
        above = self._top.proofs(start).select("position", "proof")
        # One row for each source on both sides.
        sources = self.sources.join(above, "position").select(F.col("tree").alias("key"), "proof", "subroot")
        carried = [c for c in self.leaves.columns if c not in ("tree", "position")]
        return self._forest.proofs(sources, carried)


def build(
    df: DataFrame,
    columns: list[str],
    group: str = "source",
    key: str = "doc_id",
    carry: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> Manifest:
    """Digest every row and build one tree for each value of `group` and the tree of their roots.

    A leaf is leaf_digest() of `columns`, NULLs included. Leaves ascend by `key` (NULL first); rows of
    equal key by digest, so repeated rows are leaves of their own and their order changes nothing. NULL
    in `group` is a group like any other, the first one. `carry` are further columns for the leaves
    table, computed from the row. Other columns of `df` are not read and may have any names. Only
    digests are shuffled. Empty in: no leaves, no sources, root None.
    """
    ship_package(df.sparkSession)
    rows = df.select(
        quoted(group).cast("string").alias("tree"),
        quoted(key).alias("key"),
        leaf_digest([quoted(c) for c in columns]).alias("digest"),
        *[c.alias(f"carry_{n}") for n, c in (carry or {}).items()],
        # Spreads rows that are alike over the range partitions.
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = materialize(rows, "merkle-digests")
    leaves = number_leaves(rows, "tree", ["key", "digest", "tie"]).drop("tie")
    forest = Forest.build(leaves, levels)
    roots = forest.roots.select(F.lit("").alias("all"), "tree", F.col("digest").alias("subroot"))
    sources = materialize(number_leaves(roots, "all", ["tree"]).drop("all"), "merkle-sources")
    top = Forest.build(sources.select(F.lit("").alias("tree"), "position", F.col("subroot").alias("digest")), levels)
    root = top.roots.select("digest").first()
    return Manifest(leaves, sources, root and root["digest"], forest, top)


def fold(leaf: str, proof: str) -> tuple[str, str]:
    """The root that a leaf and its proof lead to, and the digest of the proof's siblings in order."""
    own, at, siblings = leaf, 0, []
    while at < len(proof):
        place, count = int(proof[at]), int(proof[at + 1])
        end = at + 2 + HEX * (count - 1)
        others = proof[at + 2 : end]
        own = digest(others[: HEX * place] + own + others[HEX * place :])
        siblings.append(others)
        at = end
    return own, digest("".join(siblings))


def verify(df: DataFrame, leaf: str, proof: str) -> DataFrame:
    """Add `folded_root` and `proof_sha256` from a leaf digest and its proof; NULL in either gives NULLs."""
    schema = T.StructType(
        [f for f in df.schema if f.name not in ("folded_root", "proof_sha256")]
        + [T.StructField("folded_root", T.StringType()), T.StructField("proof_sha256", T.StringType())]
    )
    base = df.select(*[quoted(n) for n in schema.fieldNames()[:-2]])
    a, b = base.columns.index(leaf), base.columns.index(proof)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(a).to_pylist(), batch.column(b).to_pylist(), strict=True)
            found = [(None, None) if x is None or y is None else fold(x, y) for x, y in pairs]
            columns = [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.fieldNames())

    return base.mapInArrow(run, schema)


def audit(
    df: DataFrame,
    columns: list[str],
    tampered: Callable[[Column], Column],
    when: Column,
    text: str = "text",
    group: str = "source",
    key: str = "doc_id",
    levels: int = LEVELS,
) -> DataFrame:
    """Build the manifest of `df`, change `text` by `tampered` in the rows where `when`, and prove every row again.

    Returns key, leaf, subroot, root, proof, proof_sha256 (all of the rows as they were), folded_root (from
    the leaf as it is now and the old siblings) and verified (equals root).
    """
    now = [tampered(quoted(c)) if c == text else quoted(c) for c in columns]
    carry = {"now": F.when(F.coalesce(when, F.lit(False)), leaf_digest(now))}
    manifest = build(df, columns, group, key, carry, levels)
    rows = manifest.proofs().select(
        F.col("key").alias(key),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        "proof",
        F.coalesce("carry_now", "digest").alias("_leaf_now"),
    )
    proven = verify(rows, "_leaf_now", "proof").drop("_leaf_now")
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


#: DuckDB SQL for the rows of audit() over `documents`: levels by recursion, CRC-32 bit by bit.
ORACLE = """
    WITH RECURSIVE
    raw AS (
        SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
            concat(
                coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'),
                coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'),
                coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
            replace(text, chr(10), '') AS cut,
            list_reduce(list_prepend(4294967295, flatten([[CAST(unicode(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]
                FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
                lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
                    ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END) AS crc
        FROM documents),
    leaves AS (
        SELECT doc_id, g, sha256(concat(head, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
            CASE WHEN xor(crc, 4294967295) % 2 = 0
                THEN sha256(concat(head, coalesce(strlen(cut) || ':' || cut, '-'))) END AS changed
        FROM raw),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY g) AS n
        FROM leaves),
    low(g, lvl, pos, n, digest) AS (
        SELECT g, 0, pos, n, leaf FROM placed
        UNION ALL
        SELECT g, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
        FROM low WHERE n > 1 GROUP BY g, lvl, pos // 3, n),
    sub AS (SELECT g, digest AS subroot FROM low WHERE n = 1),
    high(lvl, pos, n, digest) AS (
        SELECT 0, g, count(*) OVER (), subroot FROM sub
        UNION ALL
        SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
        FROM high WHERE n > 1 GROUP BY lvl, pos // 3, n),
    siblings AS (
        SELECT p.g, p.pos, 0 AS part, s.lvl, s.pos AS place, s.digest
        FROM placed p JOIN low s ON s.g = p.g AND s.n > 1
            AND s.pos // 3 = p.pos // CAST(3 ** (s.lvl + 1) AS BIGINT) AND s.pos <> p.pos // CAST(3 ** s.lvl AS BIGINT)
        UNION ALL
        SELECT p.g, p.pos, 1, s.lvl, s.pos, s.digest
        FROM placed p JOIN high s ON s.n > 1
            AND s.pos // 3 = p.g // CAST(3 ** (s.lvl + 1) AS BIGINT) AND s.pos <> p.g // CAST(3 ** s.lvl AS BIGINT)),
    proofs AS (
        SELECT g, pos, sha256(string_agg(digest, '' ORDER BY part, lvl, place)) AS proof_sha256
        FROM siblings GROUP BY g, pos),
    up(g, leaf_pos, lvl, pos, n, own) AS (
        SELECT g, pos, 0, pos, n, coalesce(changed, leaf) FROM placed
        UNION ALL
        SELECT u.g, u.leaf_pos, u.lvl + 1, u.pos // 3, (u.n + 2) // 3,
            sha256(string_agg(CASE WHEN s.pos = u.pos THEN u.own ELSE s.digest END, '' ORDER BY s.pos))
        FROM up u JOIN low s ON s.g = u.g AND s.lvl = u.lvl AND s.pos // 3 = u.pos // 3
        WHERE u.n > 1 GROUP BY u.g, u.leaf_pos, u.lvl, u.pos, u.n),
    over_all(g, leaf_pos, lvl, pos, n, own) AS (
        SELECT g, leaf_pos, 0, g, (SELECT count(*) FROM sub), own FROM up WHERE n = 1
        UNION ALL
        SELECT u.g, u.leaf_pos, u.lvl + 1, u.pos // 3, (u.n + 2) // 3,
            sha256(string_agg(CASE WHEN s.pos = u.pos THEN u.own ELSE s.digest END, '' ORDER BY s.pos))
        FROM over_all u JOIN high s ON s.lvl = u.lvl AND s.pos // 3 = u.pos // 3
        WHERE u.n > 1 GROUP BY u.g, u.leaf_pos, u.lvl, u.pos, u.n)
    SELECT doc_id, leaf, subroot, (SELECT digest FROM high WHERE n = 1) AS root,
        coalesce(proof_sha256, sha256('')) AS proof_sha256, o.own AS folded_root,
        o.own = (SELECT digest FROM high WHERE n = 1) AS verified
    FROM placed p JOIN sub USING (g) JOIN over_all o ON o.g = p.g AND o.leaf_pos = p.pos AND o.n = 1
    LEFT JOIN proofs f ON f.g = p.g AND f.pos = p.pos"""
