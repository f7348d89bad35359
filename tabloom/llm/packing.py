"""Pack token pieces into sequences of a fixed length by minimum bin slack."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.lineage import materialize
from tabloom.llm.common import ChunkTable, as_bytes, kept_in_worker, small

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, local_rank long"


def tokenize(
    df: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, task, local_rank (and ids).

    A document is the ids of its whole text plus `end_id` (NULL text: only `end_id`). Documents of more
    than `capacity` ids are cut into pieces of that length. No token crosses a space, so each task
    encodes every distinct word once. `task` and `local_rank` number the pieces of equal length.
    """
    schema = _PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept_in_worker(("words", tokenizer), lambda: ChunkTable(word_encoder(tokenizer), 250_000))
        seen = np.zeros(capacity + 1, dtype=np.int64)
        task = TaskContext.get().partitionId()
        for batch in small(batches, size=1 << 20):
            keys = batch.column(0).to_pylist()
            # ASCII white space cuts; what else is white space is the tokenizer's matter.
            flat, bounds = table.ids([(t or b"").split() for t in as_bytes(batch.column(1))])
            rows: list[tuple] = []
            for k, key in enumerate(keys):
                ids = np.append(flat[bounds[k] : bounds[k + 1]], np.int32(end_id)).astype("<u4")
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    own = ids[at : at + capacity]
                    rank = int(seen[len(own)])
                    seen[len(own)] += 1
                    row = (key, piece, at, len(own), zlib.crc32(own.tobytes()), task, rank)
                    rows.append((*row, own.astype(np.int32)) if with_ids else row)
            if rows:
                columns = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int32())]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
                yield pa.RecordBatch.from_arrays(arrays, names=_names(schema))

    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, schema)


#: A word of lower-case Latin letters, already composed, and ASCII signs after it but no apostrophe.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def word_encoder(tokenizer: str) -> Callable[[list[bytes]], list[list[int]]]:
    """Ids of words by a tokenizer file whose pre-tokens are letters, digits or runs of signs.

    Letters and signs of plain words are merged straight from their bytes, since the tokenizer's
    normaliser and splitter leave them as they are; all other words go through the whole tokenizer.
    """
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer)
    part = _merger(tokenizer) or _by_model(coder.model)

    def encode(words: list[bytes]) -> list[list[int]]:
        out = []
        for coded in words:
            word = coded.decode()
            if word.isascii() and word.isalpha():
                out.append(part(coded.lower()))
                continue
            plain = _PLAIN.fullmatch(word.lower()) if word.isascii() or _LATIN.fullmatch(word) else None
            if plain:
                out.append(part(plain[1].encode()) + (part(plain[2].encode()) if plain[2] else []))
            else:
                out.append(coder.encode(word, add_special_tokens=False).ids)
        return out

    return encode


def _by_model(model) -> Callable[[bytes], list[int]]:
    return lambda word: [t.id for t in model.tokenize(word.decode("latin-1").translate(_BYTE_SIGNS))]


#: Stands behind the last byte of a word, as no byte of UTF-8 does.
_END = b"\xff"


def _merger(tokenizer: str) -> Callable[[bytes], list[int]] | None:
    """Ids of a word's bytes by merging the pair whose result has the lowest rank; None if that is not the file's rule.

    The end of a word is a byte of its own that joins the last byte before all other merges. The file
    merges listed pairs; both rules agree if each token is what the listed pairs make of its own bytes.
    """
    import tiktoken

    with open(tokenizer) as file:
        model = json.load(file)["model"]
    end = model.get("end_of_word_suffix")
    signs = {chr(_BYTE_SIGNS.get(b, b)): b for b in range(256)}

    def as_bytes_(token: str) -> bytes | None:
        body, closed = (token[: -len(end)], _END) if end and token.endswith(end) and token != end else (token, b"")
        return bytes(signs[c] for c in body) + closed if all(c in signs for c in body) else None

    tokens = {b: i for t, i in model["vocab"].items() if (b := as_bytes_(t)) is not None}
    base = [bytes([b]) for b in range(256)]
    ended = [b + _END for b in base[:-1]]
    pairs = {}
    for rank, (x, y) in enumerate(model["merges"]):
        pairs[as_bytes_(x), as_bytes_(y)] = rank
    if not end or any(b not in tokens for b in base + ended):
        return None
    ranks = {b: i for i, b in enumerate(base + ended)}
    for x, y in pairs:
        ranks.setdefault(x + y, len(ranks))
    if not all(_merged(token, pairs) == [token] for token in ranks if len(token) > 1):
        return None
    ids = [tokens[b] for b in ranks]
    encode = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    return lambda word: [ids[r] for r in encode(word + _END)]


def _merged(token: bytes, pairs: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """What the listed pairs make of the bytes of a token."""
    closed = token.endswith(_END)
    parts = [bytes([b]) for b in token]
    if closed:
        parts[-2:] = [parts[-2] + _END]
    while len(parts) > 1:
        best = min(zip(parts, parts[1:], strict=False), key=lambda p: pairs.get(p, len(pairs)))
        if best not in pairs:
            break
        joined, i = [], 0
        while i < len(parts):
            if tuple(parts[i : i + 2]) == best:
                joined.append(parts[i] + parts[i + 1])
                i += 2
            else:
                joined.append(parts[i])
                i += 1
        parts = joined
    return parts


#: ASCII, and the Latin-1 letters whose lower case is a Latin-1 letter too.
_LATIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def _byte_signs() -> dict[int, int]:
    """How byte-level vocabularies write a byte: itself if it prints in Latin-1, else from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


_BYTE_SIGNS = _byte_signs()


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to `room`, by bitset subset sums.

    Bit s of `reach` says that some choice sums to s. Lengths go from long to short, each as often as it
    is available and fits, in powers of two; the search ends as soon as `room` itself is reached.
    """
    reach, steps = 1, []
    full = 1 << room
    mask = (full << 1) - 1
    for length in lengths:
        if length > room:
            continue
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << length * take) & mask
            left -= take
            take *= 2
        if reach & full:
            break
    target, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> target & 1:
            target -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Minimum bin slack over a histogram of lengths.

    Each step opens a bin with the longest length left, finds the fullest feasible combination for the
    rest and removes it, as many times as the lengths allow. Rows are (length, first rank, last rank + 1,
    first sequence, pieces of this length in a bin, offset of the first). Steps use up a length or halve
    what is left of it, so their number follows the distinct lengths and not the pieces.
    """
    counts = {n: c for n, c in histogram.items() if c > 0}
    lengths = sorted(counts, reverse=True)
    used = dict.fromkeys(counts, 0)
    sequence, plan = 0, []
    while lengths:
        top = lengths[0]
        counts[top] -= 1
        chosen = fullest(counts, [n for n in lengths if counts[n]], capacity - top)
        counts[top] += 1
        chosen[top] = chosen.get(top, 0) + 1
        times = min(counts[n] // c for n, c in chosen.items())
        offset = 0
        for n in sorted(chosen, reverse=True):
            plan.append((n, used[n], used[n] + times * chosen[n], sequence, chosen[n], offset))
            offset += n * chosen[n]
            used[n] += times * chosen[n]
            counts[n] -= times * chosen[n]
        sequence += times
        lengths = [n for n in lengths if counts[n]]
    return plan


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Add sequence_id and offset to the pieces of tokenize().

    Only the histogram of lengths, at most `capacity` rows, and the plan made from it reach the driver.
    Pieces of equal length are interchangeable: the rank of a piece among them is its rank in its task
    plus what the tasks before hold, so no length, however common, meets in one task. Empty in, empty out.
    """
    spark = pieces.sparkSession
    pieces = materialize(pieces, "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    by_task = materialize(by_task, "lengths")
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.array(plan_bins(histogram, capacity), dtype=np.int64).reshape(-1, 6)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    shared = spark.sparkContext.broadcast(plan)
    before = by_task.selectExpr(
        "length", "task", "sum(n) over (partition by length order by task) - n as ahead"
    )
    ranked = pieces.join(before, ["length", "task"])
    ranked = ranked.withColumn("rank", F.col("ahead") + F.col("local_rank")).drop("ahead", "task", "local_rank")
    extra = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    out = T.StructType([f for f in ranked.schema if f.name != "rank"] + extra)
    names = out.fieldNames()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            values = dict(zip(batch.schema.names, batch.columns, strict=True))
            length, rank = (values[c].to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            row = table[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            slot = rank - row[:, 1]
            values["sequence_id"] = pa.array(row[:, 3] + slot // row[:, 4])
            values["offset"] = pa.array(row[:, 5] + slot % row[:, 4] * length)
            yield pa.RecordBatch.from_arrays([values[n] for n in names], names=names)

    return ranked.mapInArrow(place, out)
