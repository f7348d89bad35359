"""Language identification by unigram pieces, summed over all segmentations of each word."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.lineage import materialize
from tabloom.llm.common import U64, append_columns, small
from tabloom.operators.sampling import hash_thresholds, row_hash

#: Documents of each language, those with the smallest hashes of their ids, that the piece probabilities are
#: fitted on: a documented bound on labelled rows.
TRAIN_DOCUMENTS = 1_000
#: Rounds of expectation-maximisation.
ROUNDS = 3
#: Letters after which a longer word is scored in parts, so that no probability runs out of range.
WORD_LETTERS = 24
#: Probability of a letter that no piece covers.
UNKNOWN = 1e-6
UNDETERMINED = "und"

_MARK = "▁"
_WORD = re.compile(r"[^\W\d_]+")
_BASE = U64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case, long ones in parts."""
    found = _WORD.findall(text.lower())
    if not all(map(str.isalpha, found)):
        # Fractions, circled and Roman numerals are no letters.
        found = [w for w in ("".join(filter(str.isalpha, w)) for w in found) if w]
    if any(len(w) > WORD_LETTERS for w in found):
        step = WORD_LETTERS
        found = [w[i : i + step] for w in found for i in range(0, len(w), step)]
    return found


def vocabulary(model: str) -> list[str]:
    """The lower-case letter pieces of a public sentencepiece model, with at most one marker in front."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    found = {p for p in pieces if (p[1:] if p[:1] == _MARK else p).isalpha() and p == p.lower()}
    return sorted(found | {_MARK})


def _codes(words: list[str]) -> np.ndarray:
    text = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(text, dtype=np.uint32).astype(U64).reshape(len(words), -1)


class PieceModel:
    """Probabilities of pieces by language, and the sum over segmentations of a word.

    Pieces are found by a polynomial hash of their characters, in one sorted table for each length.
    """

    def __init__(self, pieces: list[str], probabilities: np.ndarray):
        self.probabilities = probabilities
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_length = defaultdict(list)
        for i, piece in enumerate(pieces):
            by_length[len(piece)].append(i)
        for length, own in by_length.items():
            keys = self._prefix(_codes([pieces[i] for i in own]))[:, -1]
            order = np.argsort(keys)
            self.tables[length] = keys[order], np.array(own)[order]

    @staticmethod
    def _prefix(codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), codes.shape[1] + 1), dtype=U64)
        with np.errstate(over="ignore"):
            for j in range(codes.shape[1]):
                out[:, j + 1] = out[:, j] * _BASE + codes[:, j]
        return out

    def _matches(self, words: list[str]) -> tuple[int, dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]]:
        """For words of one length: which of them have which piece between two places."""
        prefix = self._prefix(_codes([_MARK + w for w in words]))
        size = prefix.shape[1] - 1
        found = {}
        with np.errstate(over="ignore"):
            for length, (keys, own) in self.tables.items():
                power = U64(pow(int(_BASE), length, 1 << 64))
                for i in range(size - length + 1):
                    key = prefix[:, i + length] - prefix[:, i] * power
                    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    rows = np.flatnonzero(keys[at] == key)
                    if len(rows):
                        found[i, i + length] = rows, own[at[rows]]
        return size, found

    def _steps(self, size: int, found: dict, count: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """All (from, to, words, chance) in the order of their ends; letters without a piece included."""
        p = self.probabilities
        for j in range(1, size + 1):
            for i in range(j):
                rows, pieces = found.get((i, j), (None, None))
                if rows is not None:
                    yield i, j, rows, p[pieces]
                if i == j - 1:
                    rest = np.ones(count, dtype=bool)
                    if rows is not None:
                        rest[rows] = False
                    if (rows := np.flatnonzero(rest)).size:
                        yield i, j, rows, np.full((len(rows), p.shape[1]), UNKNOWN)

    def forward(self, words: list[str]) -> np.ndarray:
        """Log of the sum over all segmentations, for each word (row) and language (column)."""
        out = np.empty((len(words), self.probabilities.shape[1]))
        for own in _by_length(words):
            batch = [words[i] for i in own]
            size, found = self._matches(batch)
            alpha = np.zeros((size + 1, len(batch), self.probabilities.shape[1]))
            alpha[0] = 1
            for i, j, rows, chance in self._steps(size, found, len(batch)):
                alpha[j, rows] += alpha[i, rows] * chance
            out[own] = np.log(alpha[size])
        return out

    def expected_counts(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        """How often each piece is used, by language, over all segmentations of the weighted words."""
        counts = np.zeros_like(self.probabilities)
        for own in _by_length(words):
            batch, weight = [words[i] for i in own], weights[own]
            size, found = self._matches(batch)
            steps = list(self._steps(size, found, len(batch)))
            alpha = np.zeros((size + 1, len(batch), counts.shape[1]))
            beta = np.zeros_like(alpha)
            alpha[0] = beta[size] = 1
            for i, j, rows, chance in steps:
                alpha[j, rows] += alpha[i, rows] * chance
            for i, j, rows, chance in sorted(steps, key=lambda s: -s[0]):
                beta[i, rows] += beta[j, rows] * chance
            scale = weight / alpha[size]
            for (i, j), (rows, pieces) in found.items():
                used = alpha[i, rows] * self.probabilities[pieces] * beta[j, rows] * scale[rows]
                np.add.at(counts, pieces, used)
        return counts


def _by_length(words: list[str], most: int = 20_000) -> Iterator[np.ndarray]:
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        yield from (own[i : i + most] for i in range(0, len(own), most))


class LanguageModel:
    """What a fit returns; small: pieces by languages, whatever the corpus."""

    def __init__(self, languages: list[str], pieces: list[str], probabilities: np.ndarray, prior: np.ndarray):
        self.languages, self.pieces = languages, pieces
        self.probabilities, self.prior = probabilities, prior


def fit(
    df: DataFrame,
    pieces: list[str],
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    documents: int = TRAIN_DOCUMENTS,
) -> LanguageModel:
    """Piece probabilities of each language from labelled documents.

    The labels of all rows give the priors; the probabilities are fitted on at most `documents` of each
    language, those with the smallest hashes of their ids. Rows without a text or label are left out. An
    empty table gives a model without languages.
    """
    spark = df.sparkSession
    labelled = df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).where("lang is not null and text is not null")
    totals = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()
    languages = [r["lang"] for r in totals]
    if not languages:
        return LanguageModel([], pieces, np.ones((len(pieces), 0)), np.empty(0))
    # Counts of hash prefixes give each language its threshold: no language is ordered in one task.
    hashed = labelled.withColumn("hash", row_hash(labelled, ["doc_id"]))
    limits = hash_thresholds(hashed.select(F.col("lang").alias("class"), "hash"), {c: [documents] for c in languages})
    own = spark.createDataFrame([(c, limit) for c, (limit,) in limits.items()], "lang string, most string")
    sample = hashed.join(F.broadcast(own), "lang").where("most is null or hash < most")
    words = materialize(
        sample.mapInArrow(_count_words, "lang string, word string, n long")
        .groupBy("word", "lang")
        .agg(F.sum("n").alias("n")),
        "language-words",
    )
    probabilities = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    for _ in range(ROUNDS):
        counts = np.zeros_like(probabilities)
        shared = spark.sparkContext.broadcast((pieces, probabilities, languages))
        for row in words.mapInArrow(_expectation(shared), "piece int, lang int, n double").groupBy(
            "piece", "lang"
        ).agg(F.sum("n").alias("n")).collect():
            counts[row["piece"], row["lang"]] = row["n"]
        # A little of what all languages use keeps every piece possible in each.
        pooled = counts.sum(axis=1, keepdims=True) + 0.01
        counts += 20 * pooled / pooled.sum()
        probabilities = counts / counts.sum(axis=0)
    prior = np.array([r["n"] for r in totals], dtype=float)
    return LanguageModel(languages, pieces, probabilities, prior / prior.sum())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches, 1000):
        counts: Counter = Counter()
        values = dict(zip(batch.schema.names, batch.columns, strict=True))
        for text, lang in zip(values["text"].to_pylist(), values["lang"].to_pylist(), strict=True):
            counts.update((lang, w) for w in words_of(text))
        if counts:
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [k[0] for k in counts],
                    "word": [k[1] for k in counts],
                    "n": pa.array(counts.values(), pa.int64()),
                }
            )


def _expectation(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, probabilities, languages = shared.value
        model = PieceModel(pieces, probabilities)
        column = {name: i for i, name in enumerate(languages)}
        counts = np.zeros_like(probabilities)
        for batch in batches:
            words, langs, n = (batch.column(batch.schema.names.index(c)) for c in ("word", "lang", "n"))
            weights = np.zeros((len(words), len(languages)))
            at = [column[x] for x in langs.to_pylist()]
            weights[np.arange(len(words)), at] = n.to_numpy(zero_copy_only=False)
            counts += model.expected_counts(words.to_pylist(), weights)
        piece, lang = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(counts[piece, lang])],
            names=["piece", "lang", "n"],
        )

    return run


class _Scorer:
    """Log probabilities of the distinct words seen; starts anew when full."""

    def __init__(self, model: LanguageModel, limit: int = 400_000):
        self.model, self.limit = model, limit
        self.pieces = PieceModel(model.pieces, model.probabilities)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.logs: list[np.ndarray] = [np.empty((0, len(self.model.languages)))]

    def totals(self, documents: list[list[str]]) -> np.ndarray:
        if len(self.index) > self.limit:
            self.clear()
        words = [w for d in documents for w in d]
        new = list(set(words).difference(self.index))
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.logs = [np.concatenate([*self.logs, self.pieces.forward(new)])]
        at = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        out = np.zeros((len(documents), len(self.model.languages)))
        start = 0
        for k, own in enumerate(documents):
            if own:
                used, times = np.unique(at[start : start + len(own)], return_counts=True)
                out[k] = times @ self.logs[0][used]
            start += len(own)
        return out


def predict(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add lang_pred and score (its posterior probability) from the whole text alone.

    `und` with score 0 where the text is NULL or has no letter, or the model knows no language.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

    def start():
        scorer = _Scorer(shared.value)
        languages = shared.value.languages

        def work(column: pa.Array) -> list[pa.Array]:
            documents = [words_of(t or "") for t in column.to_pylist()]
            if not languages or not documents:
                n = len(documents)
                return [pa.array([UNDETERMINED] * n, pa.string()), pa.array([0.0] * n, pa.float64())]
            logs = scorer.totals(documents) + np.log(shared.value.prior)
            best = np.argmax(logs, axis=1)
            odds = np.exp(logs - logs.max(axis=1, keepdims=True))
            score = odds[np.arange(len(best)), best] / odds.sum(axis=1)
            known = [bool(d) for d in documents]
            names = [languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
            return [pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))]

        return work

    return append_columns(df, text, fields, start)


def is_held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def identify(
    df: DataFrame, pieces: list[str], doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """doc_id, held_out, lang_pred, score; fitted on the labelled documents that are not held out."""
    model = fit(df.where(~is_held_out(doc_id)), pieces, doc_id, text, lang)
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return predict(source, model).select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )
