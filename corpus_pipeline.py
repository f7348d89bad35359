"""The corpus pipeline: language, lines, near-duplicates, passages, packing.

Each stage takes the table that the stage before has written and decides on all of its rows. All but the
last return the columns of `documents`; n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.lineage import materialize
from tabloom.llm import language_id, line_dedup, minhash, packing, substring_dedup
from tabloom.llm.common import maybe_broadcast, ship_package
from tabloom.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Posterior probability below which a language is not taken as known.
LEAST_SCORE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter, or torn between two, go."""
    ship_package(spark)
    pieces = language_id.vocabulary(tokenizer_path("piece_bpe_32k.model"))
    model = language_id.fit(docs.where(~language_id.is_held_out("doc_id")), pieces)
    found = language_id.predict(docs.select(*COLUMNS), model)
    known = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return found.where(known).select(*COLUMNS)


def _changed(docs: DataFrame, was_cut: str) -> DataFrame:
    """Rows with their new length; those of which nothing but white space is left go."""
    emptied = (F.col(was_cut) > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    docs = docs.where(~F.coalesce(emptied, F.lit(False)))
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of templates that recur across documents, but for the first."""
    return _changed(line_dedup.dedup_lines(docs.select(*COLUMNS)), "dropped_lines")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by shingles of five words."""
    ship_package(spark)
    groups = minhash.near_duplicates(docs, words=5, percent=80)
    gone = materialize(groups.where(~F.col("kept")).select("doc_id"), "near-duplicates")
    return docs.select(*COLUMNS).join(maybe_broadcast(gone), "doc_id", "left_anti").select(*COLUMNS)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has too."""
    ship_package(spark)
    return _changed(substring_dedup.dedup_passages(docs.select(*COLUMNS)), "removed_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the tokens of each document stand in sequences of 4096."""
    ship_package(spark)
    pieces = packing.tokenize(docs, tokenizer_path("word_bpe_49k.json"), capacity=4096, end_id=1)
    return packing.pack(pieces, capacity=4096)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_recurring_lines),
    ("minhash", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: SQL cannot express language models, registers, rolling hashes and tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
