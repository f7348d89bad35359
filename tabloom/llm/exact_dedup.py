"""Exact duplicates through counting quotient filters that merge without loss."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.lineage import materialize
from tabloom.llm.common import U64, as_bytes, join_groups, maybe_broadcast, signed, small

#: Fingerprints that one slice of the merged filter holds on average.
SLICE_FINGERPRINTS = 50_000
#: Fingerprints that a task collects before it sends its filter on.
FILTER_FINGERPRINTS = 1 << 20


class CountingQuotientFilter:
    """64-bit fingerprints with counts: the high bits (quotient) name a slice, the rest (remainder) is
    kept sorted in it. Remainders are whole, so neither building nor merging loses anything."""

    def __init__(self, remainders: np.ndarray, counts: np.ndarray):
        self.remainders, self.counts = remainders, counts

    @classmethod
    def build(cls, fingerprints: np.ndarray) -> CountingQuotientFilter:
        return cls(*np.unique(fingerprints, return_counts=True))

    @classmethod
    def merge(cls, parts: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """Sum the counts of equal remainders of several sorted parts."""
        remainders = np.concatenate([p.remainders for p in parts])
        counts = np.concatenate([p.counts for p in parts])
        order = np.argsort(remainders, kind="stable")
        remainders, counts = remainders[order], counts[order]
        first = np.flatnonzero(np.append(True, remainders[1:] != remainders[:-1]))
        return cls(remainders[first], np.add.reduceat(counts, first))

    def slices(self, bits: int) -> Iterator[tuple[int, CountingQuotientFilter]]:
        quotients = (self.remainders >> U64(64 - bits)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, quotients[1:] != quotients[:-1]))
        for a, b in zip(starts, np.append(starts[1:], len(quotients)), strict=True):
            low = self.remainders[a:b] & U64((1 << (64 - bits)) - 1)
            yield int(quotients[a]), CountingQuotientFilter(low, self.counts[a:b])


def normalize(texts: pa.Array) -> pa.Array:
    """Texts with A-Z in lower case and NULL as the empty text."""
    return pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))


def _prints(texts: list[bytes]) -> pa.Array:
    return pa.array([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in texts], pa.int64())


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (64 bits) and text_sha256 of each normalised text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = as_bytes(normalize(batch.column(1)))
            digests = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
            arrays = [batch.column(0), _prints(texts), digests]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "fingerprint", "text_sha256"])

    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, fingerprint long, text_sha256 string")


def _texts(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, fingerprint and the normalised text itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = normalize(batch.column(1))
            arrays = [batch.column(0), _prints(as_bytes(texts)), texts]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "fingerprint", "norm"])

    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, fingerprint long, norm string")


def repeated_fingerprints(keys: DataFrame, total: int) -> DataFrame:
    """fingerprint, n for every fingerprint counted above one.

    Each task builds a filter of what it reads, with one entry for a fingerprint however often it
    occurs, and sends it slice by slice; each slice merges its sorted remainders.
    """
    bits = max(8, int(np.ceil(np.log2(max(1, total / SLICE_FINGERPRINTS)))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(parts: list[np.ndarray]) -> pa.RecordBatch:
            rows = list(CountingQuotientFilter.build(np.concatenate(parts)).slices(bits))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([q for q, _ in rows], pa.int64()),
                    pa.array([f.remainders.tobytes() for _, f in rows], pa.binary()),
                    pa.array([f.counts.astype(np.int64).tobytes() for _, f in rows], pa.binary()),
                ],
                names=["quotient", "remainders", "counts"],
            )

        parts, held = [], 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(U64) ^ U64(1 << 63)
            parts.append(values)
            held += len(values)
            if held >= FILTER_FINGERPRINTS:
                yield sent(parts)
                parts, held = [], 0
        if held:
            yield sent(parts)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        merged = CountingQuotientFilter.merge(
            [
                CountingQuotientFilter(np.frombuffer(r, dtype=U64), np.frombuffer(c, dtype=np.int64))
                for r, c in zip(
                    table["remainders"].to_pylist(), table["counts"].to_pylist(), strict=True
                )
            ]
        )
        many = merged.counts > 1
        high = U64(key[0].as_py() << (64 - bits))
        values = signed((merged.remainders[many] | high) ^ U64(1 << 63))
        return pa.table({"fingerprint": values, "n": merged.counts[many]})

    filters = keys.select("fingerprint").mapInArrow(
        build, "quotient long, remainders binary, counts binary"
    )
    return filters.groupBy("quotient").applyInArrow(merge, "fingerprint long, n long")


def exact_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every document.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty. The largest doc_id of
    equal texts stays. Fingerprints of one document only are settled by the filter; the texts of all
    others are compared byte by byte, by grouping the texts themselves, combined inside the tasks
    first. Should two different texts share fingerprint and digest, they stay apart: such documents are
    joined by their text. Repeated doc_ids count as rows of their own. Empty in, empty out.
    """
    keys = materialize(fingerprints(df, doc_id, text), "fingerprints")
    total = keys.count()
    repeated = materialize(repeated_fingerprints(keys, total), "repeated")
    routed = _texts(df, doc_id, text).join(maybe_broadcast(repeated.select("fingerprint")), "fingerprint")
    same = routed.groupBy("fingerprint", "norm").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    same = same.withColumn("text_sha256", F.sha2(F.col("norm"), 256))
    same = materialize(same, "equal-texts")
    by_digest = same.groupBy("fingerprint", "text_sha256").agg(
        F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size"),
        F.count("*").alias("variants"),
    )
    groups = by_digest.where("variants = 1").drop("variants")
    clashes = by_digest.where("variants > 1").select("fingerprint", "text_sha256")
    plain = join_groups(keys, groups, ["fingerprint", "text_sha256"], "group_size", total, "left")
    if not clashes.isEmpty():
        texts = _texts(df, doc_id, text).withColumn("text_sha256", F.sha2(F.col("norm"), 256))
        apart = texts.join(clashes, ["fingerprint", "text_sha256"], "left_semi").join(
            same.drop("text_sha256"), ["fingerprint", "norm"]
        )
        plain = plain.join(clashes, ["fingerprint", "text_sha256"], "left_anti").unionByName(
            apart.drop("norm")
        )
    keep_id = F.coalesce("keep_id", "doc_id")
    return plain.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (keep_id == F.col("doc_id")).alias("kept"),
        "text_sha256",
    )
