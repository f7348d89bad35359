"""Align the tokens of two tokenizers on the same text by lockstep merging of a whole batch.

Tokenizer A is a byte-level BPE (a `tokenizers` file) that sees a space and the text, tokenizer B a
sentencepiece model that adds this space itself. Both cut the same bytes, so tokens overlap where their
byte ranges do, and a place where an A and a B token both end cuts the text into groups.

All documents of a batch advance together: a state vector holds for each the A token and the B token it
stands at. A step emits one link and, where both tokens end, one cut for every document, moves the
pointer whose token ends first (both at a cut) and then leaves finished documents out. Long documents
enter as several lanes that start behind common ends, so that the steps follow the length of a lane.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.columns import quoted
from tabloom.functions.lineage import materialize
from tabloom.llm.common import ChunkTable, append_columns, kept_in_worker, ship_package, small
from tabloom.llm.sentencepiece_codec import check_model, split_chunks

MARK = "▁"
#: A tokens after which a lane ends at the next common end.
LANE = 1024
#: Bytes of text in a block; what a task makes of one stays a small multiple.
BLOCK_BYTES = 2 << 20
# Fixed value: how byte-level vocabularies of this kind split a text before they merge.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose kind newer tables of characters may change, and blanks on which a backtracking splitter stumbles.
_SLOW = re.compile("[^\x00-\u024f\u2010-\u2026]|\\s{500}")


def _byte_of_sign() -> dict[str, int]:
    """How byte-level vocabularies write a byte: itself if it prints in Latin-1, else from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def piece_bytes(piece: str) -> bytes:
    """The bytes a sentencepiece piece stands for."""
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(MARK, " ").encode()


class Tokenizers:
    """Both tokenizers and the byte lengths of their tokens; B has a table of distinct words."""

    def __init__(self, byte_level: str, pieces: str, limit: int = 150_000):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(byte_level)
        self.coder.encode_special_tokens = True
        signs = _byte_of_sign()
        with open(byte_level) as file:
            settings = json.load(file)
        splitter, words = settings["pre_tokenizer"], settings["model"]["vocab"]
        if settings["normalizer"] or splitter["type"] != "ByteLevel" or splitter["add_prefix_space"]:
            raise ValueError("tokenizer A is not a plain byte-level BPE")
        self.a_length = np.zeros(max(words.values()) + 1, dtype=np.int64)
        ranks = {bytes(map(signs.__getitem__, w)): i for w, i in words.items() if all(c in signs for c in w)}
        for word, i in ranks.items():
            self.a_length[i] = len(word)
        # Merging by the rank of the result equals merging by listed pairs if every token is what its bytes merge to.
        self.by_rank = None
        if all([t.id for t in self.coder.model.tokenize(w)] == [i] for w, i in words.items() if self.a_length[i]):
            self.by_rank = tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.processor = sentencepiece.SentencePieceProcessor(model_file=pieces)
        check_model(self.processor)
        count = self.processor.get_piece_size()
        self.b_bytes = [piece_bytes(self.processor.id_to_piece(i)) for i in range(count)]
        self.b_length = np.array([len(b) for b in self.b_bytes], dtype=np.int64)
        self.lone = self.processor.piece_to_id(MARK)
        self.b_table = ChunkTable(self.b_ids, limit)

    def a_ids(self, text: str) -> list[int]:
        if not text:
            return []
        if self.by_rank is None or _SLOW.search(text):
            return self.coder.encode(" " + text, add_special_tokens=False).ids
        return self.by_rank.encode_ordinary(" " + text)

    def b_ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks; -1 behind those whose pieces do not spell the chunk."""
        out = []
        for chunk, ids in zip(chunks, self.processor.encode(chunks, num_threads=1), strict=True):
            ids = ids if chunk else [self.lone]
            spelled = b"".join([self.b_bytes[i] for i in ids]) == b" " + chunk.encode()
            out.append(ids if spelled else [*ids, -1])
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and where each document starts, the same of B; documents that do not align have none."""
        texts = [t if t and MARK not in t else "" for t in texts]
        parts = [np.array(self.a_ids(t), dtype=np.int32) for t in texts]
        a_at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        a = np.concatenate([np.empty(0, dtype=np.int32), *parts])
        b, b_at = self.b_table.ids([split_chunks(t) for t in texts])
        sizes = np.array([len(t.encode()) + 1 if t else 0 for t in texts], dtype=np.int64)
        odd = _sums(self.a_length[a], a_at) != sizes
        odd |= (_sums(np.where(b < 0, 0, self.b_length[b]), b_at) != sizes) | (_sums(b < 0, b_at) > 0)
        if odd.any():
            a, a_at = _without(a, a_at, odd)
            b, b_at = _without(b, b_at, odd)
        return a, a_at, b, b_at


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the values between consecutive bounds."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[at])


def _without(ids: np.ndarray, at: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(at)
    return ids[np.repeat(~gone, counts)], np.concatenate([[0], np.cumsum(np.where(gone, 0, counts))])


@dataclass
class Alignment:
    """Tokens of a batch with bounds of documents; positions of links (A, B) and of the tokens at cuts."""

    a: np.ndarray
    a_at: np.ndarray
    b: np.ndarray
    b_at: np.ndarray
    a_end: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray

    @cached_property
    def document(self) -> np.ndarray:
        """The document of each A token."""
        return np.repeat(np.arange(len(self.a_at) - 1), np.diff(self.a_at))

    def per_document(self, positions: np.ndarray) -> np.ndarray:
        """How many of these A positions each document has."""
        return np.bincount(self.document[positions], minlength=len(self.a_at) - 1)

    def group_digests(self) -> list[str]:
        """SHA-256 in hex of each document's `a1,a2|b1;a3|b2,b3`; empty for a document without tokens."""
        last_a, last_b = np.zeros(len(self.a), dtype=bool), np.zeros(len(self.b), dtype=bool)
        last_a[self.cut_a], last_b[self.cut_b] = True, True
        # Groups are in the same order on both sides; a token stands behind all tokens of earlier groups.
        ends_a = np.concatenate([[0], np.flatnonzero(last_a) + 1])
        ends_b = np.concatenate([[0], np.flatnonzero(last_b) + 1, [0]])
        to_a = np.arange(len(self.a)) + ends_b[np.cumsum(last_a) - last_a]
        to_b = np.arange(len(self.b)) + ends_a[np.cumsum(last_b) - last_b + (len(self.b) > 0)]
        codes = np.empty(len(self.a) + len(self.b), dtype=np.int32)
        codes[to_a] = self.a * 3 + last_a
        codes[to_b] = self.b * 3 + 2 * last_b
        shown = _with_signs(int(codes.max(initial=0)) // 3 + 1).__getitem__
        at = (self.a_at + self.b_at).tolist()
        texts = (b"".join(map(shown, codes[x:y].tolist()))[:-1] for x, y in pairwise(at))
        return [hashlib.sha256(t).hexdigest() if t else "" for t in texts]


@lru_cache(maxsize=None)
def _numbers(count: int) -> list[bytes]:
    return [f"{i}{sign}".encode() for i in range(count) for sign in ",|;"]


def _with_signs(count: int) -> list[bytes]:
    """Each number below `count` (a power of two or less) with a comma, a bar and a semicolon behind it."""
    return _numbers(1 << (count - 1).bit_length())


def lanes(a_at: np.ndarray, a_end: np.ndarray, b_end: np.ndarray, lane: int = LANE) -> np.ndarray:
    """A positions at which lanes start: documents, and in long ones the token behind a common end.

    From each `lane`-th A token of a document the next one is sought that ends where a B token ends.
    If there is none before the following start, two lanes stay one.
    """
    counts = np.diff(a_at)
    extra = np.maximum(counts - 1, 0) // lane
    number = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    at = np.repeat(a_at[:-1], extra) + number * lane - 1
    stop = np.minimum(at + lane, np.repeat(a_at[1:], extra) - 1)
    found = [a_at[:-1][counts > 0]]
    while len(at):
        common = b_end[np.searchsorted(b_end, a_end[at])] == a_end[at]
        found.append(at[common] + 1)
        at, stop = at[~common] + 1, stop[~common]
        at, stop = at[at < stop], stop[at < stop]
    return np.sort(np.concatenate(found))


def lockstep(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, a_length: np.ndarray, b_length: np.ndarray, lane: int = LANE) -> Alignment:
    """Links and cuts of a batch; the tokens of each document must spell the same number of bytes."""
    a_end, b_end = np.cumsum(a_length[a]), np.cumsum(b_length[b])
    at_a = lanes(a_at, a_end, b_end, lane)
    stop = np.append(at_a[1:], len(a))
    start = np.concatenate([[0], a_end])[at_a]
    at_b = np.searchsorted(b_end, start, side="right") if len(at_a) else at_a
    link_a, link_b, cut_a, cut_b = [], [], [], []
    at_a, at_b = at_a.astype(np.int32), at_b.astype(np.int32)
    while len(at_a):
        link_a.append(at_a)
        link_b.append(at_b)
        x, y = a_end[at_a], b_end[at_b]
        cut = x == y
        cut_a.append(at_a[cut])
        cut_b.append(at_b[cut])
        at_a, at_b = at_a + (x <= y), at_b + (y <= x)
        going = at_a < stop
        if not going.all():
            at_a, at_b, stop = at_a[going], at_b[going], stop[going]

    def joined(parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)

    return Alignment(a, a_at, b, b_at, a_end, joined(link_a), joined(link_b), joined(cut_a), joined(cut_b))


def _align(tokenizers: Tokenizers, texts: list[str | None]) -> Alignment:
    coded = tokenizers.encode(texts)
    return lockstep(*coded, tokenizers.a_length, tokenizers.b_length)


def _tokenizers(byte_level: str, pieces: str) -> Tokenizers:
    return kept_in_worker(("alignment", byte_level, pieces), lambda: Tokenizers(byte_level, pieces))


def align(df: DataFrame, byte_level: str, pieces: str, text: str = "text") -> DataFrame:
    """Add a_ids, b_ids, links (positions a and b of overlapping tokens, in order) and cuts (byte ends of groups).

    `byte_level` is a `tokenizers` file of a byte-level BPE, `pieces` a sentencepiece model, both on every
    machine. Byte ends count in a space and the text. A text that is NULL or empty, or that the pieces do
    not spell (a literal marker), has empty arrays. Columns of these names are replaced, others stay.
    Each task works on batches of whole texts; nothing is shuffled.
    """
    ship_package(df.sparkSession)
    pair = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    numbers = T.ArrayType(T.IntegerType())
    fields = [T.StructField(n, t) for n, t in [("a_ids", numbers), ("b_ids", numbers), ("links", T.ArrayType(pair)), ("cuts", T.ArrayType(T.LongType()))]]

    def start():
        tokenizers = _tokenizers(byte_level, pieces)

        def work(column: pa.Array) -> list[pa.Array]:
            found = _align(tokenizers, column.to_pylist())
            order = np.lexsort((found.link_b, found.link_a))
            link_a, link_b = found.link_a[order], found.link_b[order]
            own = found.document[link_a]
            links = pa.StructArray.from_arrays(
                [pa.array((link_a - found.a_at[own]).astype(np.int32)), pa.array((link_b - found.b_at[own]).astype(np.int32))],
                names=["a", "b"],
            )
            cut = np.sort(found.cut_a)
            base = np.concatenate([[0], found.a_end])[found.a_at[:-1]]
            cuts = found.a_end[cut] - base[found.document[cut]]

            def lists(values, counts):
                at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                return pa.ListArray.from_arrays(pa.array(at), values if isinstance(values, pa.Array) else pa.array(values))

            return [
                lists(found.a, np.diff(found.a_at)),
                lists(found.b, np.diff(found.b_at)),
                lists(links, found.per_document(link_a)),
                lists(cuts, found.per_document(cut)),
            ]

        return work

    return append_columns(df, text, fields, start)


_BLOCKS = (
    "block long, pairs array<long>, holders array<int>, doc_id array<long>, n_a array<int>, n_b array<int>, "
    "n_groups array<int>, n_links array<int>, groups_sha256 array<string>, n_pairs array<int>, "
    "place array<int>, times array<int>"
)
_BLOCK_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.int32()] * 4, pa.string(), *[pa.int32()] * 3]
_DOCUMENTS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def block_values(found: Alignment, b_size: int, span: int) -> list[np.ndarray | list]:
    """pairs, holders, n_a, n_b, n_groups, n_links, groups_sha256, n_pairs, place and times of a batch.

    `pairs` are the distinct id pairs that it links, `holders` how many of its documents hold each; then
    for each document its distinct pairs, as places in `pairs`, and how often it links them.
    """
    own = found.document[found.link_a]
    pair = found.a[found.link_a].astype(np.int64) * b_size + found.b[found.link_b]
    held, times = np.unique(own * span + pair, return_counts=True)
    owner, pair = np.divmod(held, span)
    pairs, place, holders = np.unique(pair, return_inverse=True, return_counts=True)
    n_pairs = np.bincount(owner, minlength=len(found.a_at) - 1)
    n_groups, n_links = found.per_document(found.cut_a), found.per_document(found.link_a)
    return [
        pairs, holders, np.diff(found.a_at), np.diff(found.b_at), n_groups, n_links, found.group_digests(),
        n_pairs, place, times,
    ]


def _blocks(df: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """One row for each batch of documents of about 2 MB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = _tokenizers(byte_level, pieces)
        b_size = len(tokenizers.b_length)
        number = TaskContext.get().partitionId() << 32
        for batch in small(batches, size=BLOCK_BYTES):
            found = _align(tokenizers, batch.column(1).to_pylist())
            pairs, holders, *values = block_values(found, b_size, b_size * len(tokenizers.a_length))
            columns = [[number], [pairs], [holders], [batch.column(0)], *[[v] for v in values]]
            types = [_BLOCK_TYPES[0], *map(pa.list_, _BLOCK_TYPES[1:])]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in _BLOCKS.split(", ")])
            number += 1

    return df.mapInArrow(run, _BLOCKS)


def pair_counts(blocks: DataFrame, b_size: int) -> DataFrame:
    """pair, count (documents that hold it linked) and best (no pair of its A id is held by more)."""
    found = blocks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("x")).select("x.pairs", "x.holders")
    counts = found.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("count"))
    counts = materialize(counts.withColumn("a_id", F.expr(f"pair div {b_size}")), "alignment-pairs")
    # As many rows as tokenizer A has ids at most.
    highest = counts.groupBy("a_id").agg(F.max("count").alias("highest"))
    return counts.join(F.broadcast(highest), "a_id").select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best")
    )


def link_statistics(df: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """How well the links of each document fit those of the whole table.

    Returns doc_id (as long), n_a, n_b, n_groups, n_links, n_best (links whose id pair is held by no fewer
    documents than any other pair of its A id), count_sum (documents that hold the pair, over all links) and
    groups_sha256 (of `a1,a2|b1;a3|b2,b3`). Texts without tokens, see align(), have zeros and an empty
    digest. Every row is a document, repeated ones too; other columns are not read. Empty in, empty out.

    Documents stay in blocks of about 2 MB. A block asks once for each distinct pair it holds, so the
    shuffle carries pairs of blocks, not of documents, and a pair that every document holds is one row a
    block. Answers meet their block again by its number.
    """
    ship_package(df.sparkSession)
    source = df.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    blocks = materialize(_blocks(source, byte_level, pieces), "alignment-blocks")
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    counts = pair_counts(blocks.select("pairs", "holders"), b_size)
    asked = blocks.select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, "pair").select("of_block", "place", "count", "best")

    def close(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = {n: block.column(n).combine_chunks().flatten() for n in block.column_names if n != "block"}
        order = np.argsort(answers.column("place").to_numpy())
        count = answers.column("count").to_numpy()[order]
        best = answers.column("best").to_numpy()[order]
        place, times = row["place"].to_numpy(), row["times"].to_numpy().astype(np.int64)
        at = np.concatenate([[0], np.cumsum(row["n_pairs"].to_numpy())])
        found = {"n_best": _sums(times * best[place], at), "count_sum": _sums(times * count[place], at)}
        columns = [found[n] if n in found else row[n] for n, _ in _fields]
        return pa.table([pa.array(c).cast(t) for c, (_, t) in zip(columns, _fields, strict=True)], names=[n for n, _ in _fields])

    names = [x.split()[0] for x in _DOCUMENTS.split(", ")]
    _fields = [(n, pa.string() if n == "groups_sha256" else pa.int64()) for n in names]
    kept = blocks.drop("pairs", "holders")
    return kept.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(close, _DOCUMENTS)
