"""Repeated passages by content-defined chunks of a gear rolling hash."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.lineage import materialize
from tabloom.llm.common import append_columns, as_bytes, free_name, join_groups, mix, small

#: Bytes that the rolling hash remembers: it has 16 bits and moves by one for each byte.
WINDOW = 16
#: A chunk ends after a word with a chance of one in this.
CHUNK_WORDS = 5
#: A chunk that has not ended after so many bytes ends there, in front of the character that it would cut.
CHUNK_BYTES = 2048
#: Documents of a batch in which a chunk must occur for its places to go apart from those of others.
FREQUENT_DOCUMENTS = 8
#: Bits of the map that tells chunks which cannot be frequent from the others.
MAP_BITS = 24
#: Words that consecutive repeated chunks must have together to count as a repeated passage.
PASSAGE_WORDS = 16
#: Of these, words that must have been in one and the same earlier document.
SAME_DOCUMENT_WORDS = 8

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(
    np.uint16
)
_GEAR[0] = 0
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash h = 2 h + G[byte] after each byte, in 16 bits; by doubling the window."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        moved = np.zeros_like(h)
        moved[step:] = h[:-step] << np.uint16(step)
        h = h + moved
    return h


def chunk_ends(texts: list[bytes]) -> list[np.ndarray]:
    """Where the chunks of each text end: at ends of words, by the last bytes in front alone.

    Equal passages therefore have equal chunks from a few words after their start, whatever stands
    before them. Texts are kept apart by zero bytes, which the hash forgets everything over.
    """
    gap = b"\0" * WINDOW
    data = np.frombuffer(gap.join(texts) + gap, dtype=np.uint8)
    white = _WHITE[data] | (data == 0)
    word_end = np.flatnonzero(~white[:-1] & white[1:])
    chosen = word_end[gear_hashes(data)[word_end].astype(np.uint32) * CHUNK_WORDS < 65536]
    out, start = [], 0
    for text in texts:
        a, b = np.searchsorted(chosen, (start, start + len(text)))
        ends = chosen[a:b] - start + 1
        if len(text) and (not len(ends) or ends[-1] < len(text)):
            ends = np.append(ends, len(text))
        gaps = np.diff(ends, prepend=0)
        if len(gaps) and gaps.max() > CHUNK_BYTES:
            parts = [
                np.append(np.arange(e - g + CHUNK_BYTES, e, CHUNK_BYTES), e) if g > CHUNK_BYTES else [e]
                for e, g in zip(ends, gaps, strict=True)
            ]
            ends = np.concatenate(parts).astype(np.int64)
            ends = np.unique([character_start(text, e) for e in ends.tolist()])
        out.append(ends)
        start += len(text) + WINDOW
    return out


def character_start(text: bytes, at: int) -> int:
    """`at`, or the start of the UTF-8 character that it lies within; at most the end of the text."""
    at = min(at, len(text))
    while 0 < at < len(text) and text[at] & 0xC0 == 0x80:
        at -= 1
    return at


_ENTRIES = "digest long, first_doc long, frequent boolean, docs array<long>, starts array<int>, ends array<int>"


def _bits(digest: np.ndarray) -> list[np.ndarray]:
    """The two bits of each digest in a map of digests."""
    value = digest.view(np.uint64)
    return [(value >> np.uint64(at)) & np.uint64((1 << MAP_BITS) - 1) for at in (0, 64 - MAP_BITS)]


def _digest_map(digests: DataFrame) -> np.ndarray:
    """A map of fixed size in which each of the digests has its bits set, packed eight to a byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << MAP_BITS, dtype=bool)
        for batch in batches:
            for at in _bits(batch.column(0).to_numpy(zero_copy_only=False)):
                bits[at] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])

    out = np.zeros(1 << MAP_BITS >> 3, dtype=np.uint8)
    for row in digests.select("digest").coalesce(32).mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def _chunks(df: DataFrame, doc_id: str, text: str, wanted: np.ndarray | None = None) -> DataFrame:
    """One row for each distinct chunk of a batch, with its places there.

    Without `wanted` all chunks, those in many documents of the batch without their places; with it all
    that have their bits in that map, with their places, whatever they are in this batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = [t or b"" for t in as_bytes(batch.column(1))]
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            all_ends = chunk_ends(texts)
            sizes = np.array([len(e) for e in all_ends])
            ends = np.concatenate([np.empty(0, dtype=np.int64), *all_ends])
            starts = np.concatenate([np.empty(0, dtype=np.int64), *[np.append(0, e)[:-1] for e in all_ends]])
            digest = xxhash.xxh3_64_intdigest
            values = np.fromiter(
                (
                    digest(t[a:b].strip())
                    for t, e in zip(texts, all_ends, strict=True)
                    for a, b in zip([0, *e.tolist()], e.tolist(), strict=False)
                ),
                dtype=np.uint64,
                count=len(ends),
            ).view(np.int64)
            docs = np.repeat(ids, sizes)
            order = np.lexsort((starts, docs, values))
            values, docs, starts, ends = (x[order] for x in (values, docs, starts, ends))
            new_value = np.append(True, values[1:] != values[:-1])[: len(values)]
            new_doc = new_value | np.append(True, docs[1:] != docs[:-1])[: len(values)]
            first = np.flatnonzero(new_value)
            places = np.diff(np.append(first, len(values)))
            frequent = np.bincount(np.cumsum(new_value)[new_doc] - 1, minlength=len(first)) >= FREQUENT_DOCUMENTS
            if wanted is None:
                with_places, rows = ~frequent, np.ones(len(first), dtype=bool)
            else:
                low, high = (wanted[x >> np.uint64(3)] >> (7 - (x & np.uint64(7))) & 1 for x in _bits(values[first]))
                with_places = rows = (low & high).astype(bool)
            shown = np.repeat(with_places, places)
            bounds = pa.array(np.append(0, np.cumsum((places * with_places)[rows])).astype(np.int32))
            lists = [docs[shown], starts[shown].astype(np.int32), ends[shown].astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(values[first][rows]),
                    pa.array(docs[first][rows]),
                    pa.array(frequent[rows]),
                    *[pa.ListArray.from_arrays(bounds, pa.array(x)) for x in lists],
                ],
                names=["digest", "first_doc", "frequent", "docs", "starts", "ends"],
            )

    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.where("text is not null").mapInArrow(run, _ENTRIES)


def repeated_chunks(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, end (bytes), owner of each chunk that a document with a smaller doc_id has too.

    The owner is the document with the smallest doc_id. Tasks send a row for each distinct chunk of a
    batch. Rows of a digest then stand next to each other in a sorted partition, those of batches in
    which it is frequent first; they are read as a stream, and only those of digests with several
    documents are written. A chunk that is frequent in any batch, and might fill the corpus, is written
    without its places: all of them come from a second scan and meet their owner in a join that keeps
    hot keys apart. Only the written table of the first scan decides, so batches may differ between them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Digest at the end of the batch before, its first document, and whether it is frequent.
        owner: tuple[int | None, int, bool] = (None, 0, False)
        for batch in batches:
            digest, first = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(digest):
                continue
            new = np.append(digest[0] != owner[0], digest[1:] != digest[:-1])
            heads = np.maximum.accumulate(np.where(new, np.arange(len(digest)), -1))
            owners = np.where(heads >= 0, first[heads], owner[1])
            frequent = np.asarray(batch.column(2).to_numpy(zero_copy_only=False), dtype=bool)
            often = np.where(heads >= 0, frequent[heads], owner[2])
            owner = int(digest[-1]), int(owners[-1]), bool(often[-1])
            lists = [batch.column(i) for i in (3, 4, 5)]
            sizes = np.diff(lists[0].offsets.to_numpy())
            docs, starts, ends = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
            each = np.repeat(owners, sizes)
            other = (docs != each) & ~np.repeat(often, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[other]) for x in (docs, starts, ends, each)] + [pa.nulls(int(other.sum()), pa.int64())],
                names=["doc_id", "start", "end", "owner", "digest"],
            )
            none = [pa.nulls(int(often.sum()), t) for t in (pa.int64(), pa.int32(), pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array(first[often]), pa.array(digest[often])],
                names=["doc_id", "start", "end", "owner", "digest"],
            )

    sorted_rows = _chunks(df, doc_id, text).repartition("digest")
    sorted_rows = sorted_rows.sortWithinPartitions("digest", F.desc("frequent"), "first_doc")
    found = materialize(
        sorted_rows.mapInArrow(run, "doc_id long, start int, end int, owner long, digest long"), "repeated-chunks"
    )
    spans = found.where("doc_id is not null").select("doc_id", "start", "end", "owner")
    owners = found.where("digest is not null").groupBy("digest")
    owners = materialize(owners.agg(F.min("owner").alias("owner"), F.count("*").alias("n")), "frequent-chunks")
    frequent = _chunks(df, doc_id, text, _digest_map(owners)).drop("first_doc", "frequent")
    frequent = materialize(frequent, "frequent-places")
    placed = join_groups(frequent, owners, ["digest"], "n", frequent.count())
    places = F.explode(F.arrays_zip("docs", "starts", "ends"))
    placed = placed.select("owner", places.alias("p")).select(
        F.col("p.docs").alias("doc_id"), F.col("p.starts").alias("start"), F.col("p.ends").alias("end"), "owner"
    )
    return spans.unionByName(placed.where("doc_id != owner"))


def passages(text: bytes, places: list[dict], least_words: int = PASSAGE_WORDS) -> list[tuple[int, int]]:
    """Spans of consecutive repeated chunks with so many words, SAME_DOCUMENT_WORDS of them of one owner.

    The second rule keeps chance repeats, a few common words each, from adding up.
    """
    joined: list[tuple[int, int, Counter]] = []
    for p in sorted(places, key=lambda p: p["start"]):
        words = len(text[p["start"] : p["end"]].split())
        if joined and p["start"] <= joined[-1][1]:
            a, _, owners = joined.pop()
        else:
            a, owners = p["start"], Counter()
        owners[p["owner"]] += words
        joined.append((a, p["end"], owners))
    same = min(SAME_DOCUMENT_WORDS, least_words)
    return [(a, b) for a, b, n in joined if n.total() >= least_words and max(n.values()) >= same]


def dedup_passages(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = PASSAGE_WORDS
) -> DataFrame:
    """Every row with repeated passages cut out of its text, plus removed_spans and removed_chars.

    A chunk is repeated if it occurs in a document with a smaller doc_id; consecutive repeated chunks of
    at least `least_words` words together are a passage and go, the rest stays as it is. So the first
    document keeps each passage, and repeats within one document stay. removed_spans holds start and end
    in bytes of the old text. A NULL text stays NULL, an empty one empty; other columns are kept, but for
    those with the names of the two new ones. Rows with a NULL doc_id are returned unchanged; rows that
    repeat a doc_id with another text are cut where their own doc_id has the spans.
    """
    spans = repeated_chunks(df.where(F.col(doc_id).isNotNull()), doc_id, text)
    found = spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "owner")).alias("_places"))
    base = df.drop("removed_spans", "removed_chars")
    work, of = free_name(df.columns, "_work"), free_name(df.columns, "_place_doc")
    found = found.select(F.col("doc_id").alias(of), F.col("_places").alias(work))
    # A NULL id meets nothing: such rows are spread by their text and not joined in one task.
    key = F.when(F.col(doc_id).isNull(), -F.abs(F.xxhash64(text)) - 1).otherwise(F.col(doc_id).cast("long"))
    matched = (key == F.col(of)) & F.col(doc_id).isNotNull()
    joined = base.join(found, matched, "left").drop(of)
    packed = joined.withColumn(work, F.struct(F.col(text).alias("text"), F.col(work).alias("places"))).drop(text)
    place = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    fields = [
        T.StructField(text, T.StringType()),
        T.StructField("removed_spans", T.ArrayType(place)),
        T.StructField("removed_chars", T.LongType()),
    ]

    def start():
        def work(column: pa.Array) -> list[pa.Array]:
            texts = as_bytes(column.field("text"))
            places = column.field("places").to_pylist()
            out, cut, removed = [], [], []
            for value, own in zip(texts, places, strict=True):
                going = passages(value or b"", own or [], least_words)
                # Spans may come from another row with this doc_id.
                going = [tuple(character_start(value, x) for x in span) for span in going]
                kept, at = [], 0
                for a, b in going:
                    kept.append(value[at:a])
                    at = b
                kept.append(value[at:] if value is not None else b"")
                out.append(b"".join(kept).decode() if value is not None else None)
                cut.append([{"start": a, "end": b} for a, b in going])
                removed.append(sum(len(value[a:b].decode()) for a, b in going))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            return [pa.array(out, pa.string()), pa.array(cut, kind), pa.array(removed, pa.int64())]

        return work

    result = append_columns(packed, work, fields, start).drop(work)
    return result.select(*base.columns, "removed_spans", "removed_chars")
