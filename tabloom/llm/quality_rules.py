"""Quality filter by weak supervision: rules vote, expectation-maximisation weighs them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.lineage import materialize
from tabloom.llm.common import WordHashes, as_bytes, kept_in_worker, small, window_hashes

_SYMBOLS = b"#*$%&|<>"
_WHITE = b" \t\n\r\x0b\f"
_SIGNS = b"#*$%&|<>@^_~{}[]\\/+="
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_ENDS = (b".", b"!", b"?", b'"', b":", b";", b"\xe2\x80\x9d", b"\xc2\xbb")

#: Rules by the signal they read: bad from (or up to), good from (or up to). Between: the rule abstains.
#: A third value names the least number of words below which the rule abstains as well.
RULES: list[tuple[str, str, float, float, int]] = [
    # name, direction in which a signal gets worse, bad beyond, good within, least words
    ("length", "low", 10, 40, 0),
    ("repeated_words", "high", 0.20, 0.05, 10),
    ("symbols", "high", 0.10, 0.02, 10),
    ("repeated_lines", "high", 0.40, 0.05, 10),
    ("short_words", "low", 2.5, 3.0, 10),
    ("long_words", "high", 12.0, 9.0, 10),
    ("capitals", "high", 0.50, 0.20, 10),
    ("line_ends", "low", 0.10, 0.50, 10),
    ("distinct_words", "low", 0.15, 0.30, 50),
    ("exclamations", "high", 0.10, 0.02, 10),
    ("signs", "high", 0.20, 0.05, 10),
    ("clean_ends", "low", 0.50, 0.80, 10),
]

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = f"doc_id long, {', '.join(f'{c} long' for c in BASE)}, votes long"


def repeated_window_words(hashes: np.ndarray, size: int = 5) -> int:
    """Words that stand in a window of `size` words which occurs twice or more."""
    windows = window_hashes(hashes, size)
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(windows, twice))
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    edges[at] += 1
    edges[at + size] -= 1
    return int(np.count_nonzero(np.cumsum(edges)))


def measure(text: bytes, table: WordHashes) -> tuple[list[int], list[float]]:
    """The base counts of a text, and the signals that RULES read, in their order."""
    words = text.split()
    n = len(words)
    # Characters are bytes that do not continue one.
    chars = len(text) - sum(map(text.count, _WHITE_BYTES)) - len(text.translate(None, _NOT_CONTINUING))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(_WHITE)]
    dup_lines = len(lines) - len(set(lines))
    hashes = table.of(words)
    repeated = repeated_window_words(hashes)
    base = [n, chars, symbols, dup_lines, repeated]
    upper = len(text) - len(text.translate(None, _UPPER))
    lower = len(text) - len(text.translate(None, _LOWER))
    ended = sum(x.rstrip(_WHITE).endswith(_ENDS) for x in lines)
    mean = chars / max(n, 1)
    # Words that end in a letter, digit, comma or full stop, in any script.
    clean = n - sum(w[-1] in _SIGNS or w.endswith(b"!!") for w in words)
    signals = [
        n,
        repeated / max(n, 1),
        symbols / max(n, 1),
        dup_lines / max(len(lines), 1),
        mean,
        mean,
        upper / max(upper + lower, 1),
        ended / max(len(lines), 1),
        len(set(words)) / max(n, 1) ** 0.75 if n else 0.0,
        text.count(b"!") / max(n, 1),
        (len(text) - len(text.translate(None, _SIGNS))) / max(n, 1),
        clean / max(n, 1),
    ]
    return base, signals


_WHITE_BYTES = [_WHITE[i : i + 1] for i in range(len(_WHITE))]
_NOT_CONTINUING = bytes(b for b in range(256) if not 0x80 <= b < 0xC0)


def vote(signals: list[float], n_words: int) -> int:
    """Votes as one number in base 3: for each rule 0 abstains, 1 is for, 2 against."""
    out = 0
    for (_, worse, bad, good, least), x in zip(RULES, signals, strict=True):
        if worse == "low":
            x, bad, good = -x, -bad, -good
        out = out * 3 + (0 if n_words < least else 2 if x > bad else 1 if x <= good else 0)
    return out


def quality_signals(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base counts and the votes of each whole text; NULL counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept_in_worker(("word hashes",), WordHashes)
        for batch in small(batches):
            rows = []
            for value in as_bytes(batch.column(1)):
                base, signals = measure(value or b"", table)
                rows.append((*base, vote(signals, base[0])))
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *columns], names=["doc_id", *BASE, "votes"]
                )

    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, _SCHEMA)


@dataclass
class VoteModel:
    """Share of good documents, and for each rule the chance of each vote in either class."""

    prior: float
    given_good: np.ndarray
    given_bad: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance that documents with these votes (one row each) are good."""
        rules = np.arange(votes.shape[1])
        good = np.log(self.prior) + np.log(self.given_good[rules, votes]).sum(axis=1)
        bad = np.log(1 - self.prior) + np.log(self.given_bad[rules, votes]).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def digits(votes: np.ndarray) -> np.ndarray:
    powers = 3 ** np.arange(len(RULES) - 1, -1, -1)
    return votes[:, None] // powers % 3


def fit_votes(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> VoteModel:
    """Expectation-maximisation over vote patterns and how many documents have each.

    Each rule looks for one kind of fault, and a bad document has some of them and not all. Hence the
    bounds, which also keep the classes from changing sides: a rule is against 0.5 to 1 % of the good
    documents and 5 to 30 % of the bad ones. So one rule alone seldom decides, two against mostly do.
    A rule that is against a large share of a corpus, such as text without full stops, says little
    there: its first bound rises with the square of that share, and the second is at least the first.
    Abstaining says nothing about the class.
    """
    good, bad = np.array([1.0, 0.99, 0.01]), np.array([1.0, 0.8, 0.2])
    model = VoteModel(0.9, np.tile(good, (len(RULES), 1)), np.tile(bad, (len(RULES), 1)))
    if not len(votes):
        return model
    for _ in range(rounds):
        good = model.posterior(votes) * counts
        bad = counts - good
        model.prior = float(np.clip(good.sum() / counts.sum(), 0.5, 0.99))
        for j in range(votes.shape[1]):
            against, cast = votes[:, j] == 2, votes[:, j] > 0
            in_good = (good[against].sum() + 0.2) / (good[cast].sum() + 1)
            in_bad = (bad[against].sum() + 0.8) / (bad[cast].sum() + 1)
            share = counts[against].sum() / max(counts[cast].sum(), 1)
            in_good = np.clip(in_good, 0.005, max(0.01, share**2))
            in_bad = max(np.clip(in_bad, 0.05, 0.3), in_good)
            model.given_good[j] = [1.0, 1 - in_good, in_good]
            model.given_bad[j] = [1.0, 1 - in_bad, in_bad]
    return model


def quality_filter(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """doc_id, base counts, base_failed, quality (posterior chance of being good) and kept.

    A document goes if base_failed (under 10 words, or over 20 % repeated words) or if its quality is
    below `least`. The model is fitted on the votes of all documents; what reaches the driver is one row
    per pattern of votes, at most 3 to the number of rules. Empty and NULL texts fail; an empty table
    gives an empty result.
    """
    spark = df.sparkSession
    signals = materialize(quality_signals(df, doc_id, text), "signals")
    patterns = signals.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    votes = np.array([r["votes"] for r in patterns], dtype=np.int64)
    model = fit_votes(digits(votes), np.array([r["n"] for r in patterns], dtype=float))
    quality = model.posterior(digits(votes)) if len(votes) else np.empty(0)
    rows = [(int(v), float(q)) for v, q in zip(votes, quality, strict=True)]
    verdicts = spark.createDataFrame(rows, "votes long, quality double")
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    return (
        signals.join(F.broadcast(verdicts), "votes")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
        .select("doc_id", *BASE, "base_failed", "kept", "quality")
    )
