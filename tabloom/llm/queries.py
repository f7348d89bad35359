"""Registered queries of this subpackage over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.lineage import new_path
from tabloom.llm import (
    alignment,
    exact_dedup,
    html_extract,
    language_id,
    license_scan,
    line_dedup,
    merkle,
    minhash,
    packing,
    quality_rules,
    sentencepiece_codec,
    substring_dedup,
    warc,
)
from tabloom.llm.common import ship_package


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file of that name lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    coded = sentencepiece_codec.encode(documents(spark, sf_dir), model).drop("text")
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    coded = coded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
    )
    return sentencepiece_codec.decode(coded, model).select(
        "doc_id",
        "n_tokens",
        "ids_sha256",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_passages(documents(spark, sf_dir))
    return found.withColumn("n_removed", F.size("removed_spans").cast("long"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return html_extract.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir)).drop("detections")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), words=2, percent=80)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = language_id.vocabulary(tokenizer_path("piece_bpe_32k.model"))
    return language_id.identify(documents(spark, sf_dir, "doc_id", "text", "lang"), pieces)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_filter(documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    return packing.pack(pieces)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = documents(spark, sf_dir, *columns)
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    proven = merkle.audit(docs, columns, lambda text: F.replace(text, F.lit("\n"), F.lit("")), chosen)
    return proven.drop("proof")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    archive = new_path(spark, "warc")
    warc.write_warc(pages, archive, min_bytes=0)
    captures = warc.assemble(warc.read_records(spark, archive, with_payload=False))
    return captures.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("referred.page_id").alias("refers_to")
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_level, pieces = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.link_statistics(documents(spark, sf_dir), byte_level, pieces)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_html_extract": op4_html_extract,
    "op5_line_dedup": op5_line_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_minhash": op7_minhash,
    "op8_language_id": op8_language_id,
    "op9_quality_rules": op9_quality_rules,
    "op10_packing": op10_packing,
    "op11_merkle": op11_merkle,
    "op12_warc": op12_warc,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {
    "op5_line_dedup": line_dedup.ORACLE,
    "op11_merkle": merkle.ORACLE,
    "op12_warc": warc.ORACLE,
    "op2_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
            doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
}
