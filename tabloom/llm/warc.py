"""WARC archives: write pages as captures, read them back by transaction assembly.

A capture is three records that name each other: a request, a response (or a revisit of an equal payload)
and a metadata record. Archives are written through Spark's own text sink, a record a row, so that its
commit protocol leaves no half file behind when an executor is lost, and read through its text source as
one ordered stream for each compressed file. Records of a capture are joined by their concurrent-to
identifiers, revisits are joined to what they refer to.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.columns import quoted
from tabloom.functions.lineage import materialize
from tabloom.llm.common import join_groups, ship_package, small

#: Ends a record; the sink writes it after each row, the source cuts the stream at it.
BREAK = "\r\n\r\n"
_BREAK = BREAK.encode()
_LENGTH = re.compile(rb"(?im)^content-length:\s*(\d+)\s*$")
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_NOT_IN_URI = re.compile(rb"[\x00-\x20\x7f-\xff]")


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(kind: str, record_id: str, date: str, length: int, fields: list[tuple[str, str | None]]) -> str:
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record_id}>", f"WARC-Date: {date}"]
    lines += [f"{name}: {value}" for name, value in fields if value is not None]
    return "\r\n".join([*lines, f"Content-Length: {length}", "", ""])


def _uri(url: str | None) -> str | None:
    """The address with blanks, controls and what is not ASCII percent-encoded."""
    if url is None:
        return None
    return _NOT_IN_URI.sub(lambda m: b"%%%02X" % m[0][0], url.encode()).decode()


def capture_records(
    page_id: int | None, url: str | None, html: str, own: str, first: str, date: str, payload: bytes
) -> list[str]:
    """The request, response or revisit, and metadata records of a page as text, without their final break.

    `own` and `first` are the record ids of the page's response and of the response with its payload.
    """
    uri, kind = _uri(url), "response" if own == first else "revisit"
    http = _HTTP.format(len(payload))
    near = [("WARC-Target-URI", uri), ("WARC-Concurrent-To", f"<urn:uuid:{own}>")]
    http_type = "application/http; msgtype={}".format
    digest = ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}")
    ask = f"GET {uri or '/'} HTTP/1.1{BREAK}"
    about = "" if page_id is None else f"page-id: {page_id}\r\n"
    request_id, metadata_id = (uuid.uuid5(uuid.UUID(own), part) for part in ("request", "metadata"))
    request = _header("request", str(request_id), date, len(ask), [*near, ("Content-Type", http_type("request"))]) + ask
    fields = [("WARC-Target-URI", uri), ("Content-Type", http_type("response")), digest]
    if kind == "response":
        answer = _header(kind, own, date, len(http) + len(payload), fields) + http + html
    else:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:uuid:{first}>")]
        answer = _header(kind, own, date, len(http), fields) + http
    fields = [*near, ("Content-Type", "application/warc-fields")]
    return [request, answer, _header("metadata", str(metadata_id), date, len(about), fields) + about]


def _identify(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """The pages written once, each with an id of its own and the digest of its payload."""
    payload = F.coalesce(quoted(html).cast("string"), F.lit(""))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        quoted(page_id).cast("long").alias("page_id"),
        quoted(url).cast("string").alias("url"),
        payload.alias("html"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha2(payload.cast("binary"), 256).alias("content"),
    )
    return materialize(rows, "warc-pages")


def write_warc(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write a capture for each row as gzip-compressed WARC 1.0 files into the folder `path`, which must be new.

    The payload is `html` in UTF-8 (NULL: empty). Of equal payloads of at least `min_bytes` bytes the row
    with the smallest page_id is a response (a NULL id comes last), the others are revisits of it; equal
    means equal in SHA-256, and rows that tie are told apart by their place in the table, so that one of
    repeated rows is the response and the others revisit it. A NULL url has no target URI. Other columns
    are not read. Each file starts with a warcinfo record; a page's records stand together. Empty in:
    files without captures.
    """
    spark = pages.sparkSession
    ship_package(spark)
    rows = _identify(pages, page_id, url, html)
    key = F.struct(F.coalesce(F.col("page_id"), F.lit((1 << 63) - 1)).alias("id"), "row")
    # Tasks send one row for each content that they hold; only what occurs again needs to be known.
    repeated = (
        rows.where(F.col("size") >= min_bytes)
        .groupBy("content")
        .agg(F.count("*").alias("copies"), F.min(key)["row"].alias("first"))
        .where("copies > 1")
    )
    repeated = materialize(repeated, "warc-repeated")
    joined = join_groups(rows, repeated, ["content"], "copies", rows.count(), "left")
    joined = joined.select("page_id", "url", "html", "row", F.coalesce("first", "row").alias("first"))
    archive = uuid.uuid4()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = "software: tabloom\r\nformat: WARC File Format 1.0\r\n"
        fields = [("Content-Type", "application/warc-fields")]
        first = [_header("warcinfo", str(uuid.uuid4()), date, len(info), fields) + info]
        yield pa.RecordBatch.from_arrays([pa.array(first, pa.string())], names=["value"])
        for batch in small(batches, 512):
            records = []
            coded = batch.column(2).cast(pa.binary()).to_pylist()
            for *page, row, first_row, payload in zip(*[c.to_pylist() for c in batch.columns], coded, strict=True):
                ids = [str(uuid.uuid5(archive, str(n))) for n in (row, first_row)]
                records += capture_records(*page, *ids, date, payload)
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.string())], names=["value"])

    out = joined.mapInArrow(run, "value string")
    out.write.option("lineSep", BREAK).option("compression", "gzip").text(path)


_RECORDS = (
    "file string, record_id string, type string, date string, target_uri string, concurrent_to array<string>, "
    "refers_to string, declared_digest string, payload_bytes long, payload_digest string, fields array<struct<name: string, value: string>>"
)
_RECORD_ROWS = [
    ("file", pa.string()), ("record_id", pa.string()), ("type", pa.string()), ("date", pa.string()),
    ("target_uri", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
    ("declared_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("fields", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))), ("payload", pa.binary()),
]


class _Stream:
    """The bytes of one file, joined again from the parts between breaks and cut by the lengths that records state."""

    def __init__(self):
        self.parts: list[bytes] = []
        self.size = 0
        self.wanted: int | None = None

    def add(self, part: bytes) -> Iterator[bytes]:
        """Yield the records, without the break behind them, that are whole with this part."""
        self.parts += [part, _BREAK]
        self.size += len(part) + len(_BREAK)
        while self.size:
            if self.wanted is None:
                head, found, _ = b"".join(self.parts).partition(_BREAK)
                if not head:
                    return  # what a break that overlaps with the end of a block leaves at the end of a file
                length = _LENGTH.search(head)
                if not (found and head.startswith(b"WARC/") and length):
                    raise ValueError(f"not the header of a WARC record: {head[:80]!r}")
                self.wanted = len(head) + int(length[1]) + 2 * len(_BREAK)
            if self.size < self.wanted:
                return
            data = b"".join(self.parts)
            record, rest = data[: self.wanted], data[self.wanted :]
            if not record.endswith(_BREAK):
                raise ValueError("a WARC record does not end where its length says")
            self.parts, self.size, self.wanted = [rest], len(rest), None
            yield record[: -len(_BREAK)]

    def close(self) -> None:
        if b"".join(self.parts).strip(b"\r\n"):
            raise ValueError("a WARC file ends within a record")


def _unbracketed(value: str | None) -> str | None:
    return value.strip().strip("<>").removeprefix("urn:uuid:") if value is not None else None


def parse_record(record: bytes) -> dict:
    """Type, names, links, payload and fields of one record."""
    head, _, block = record.partition(_BREAK)
    pairs = [x.split(":", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:]]
    named: dict[str, list[str]] = {}
    for pair in pairs:
        named.setdefault(pair[0].strip().lower(), []).append(pair[-1].strip())
    one = {k: v[0] for k, v in named.items()}
    kind, content = one.get("warc-type"), one.get("content-type", "")
    payload, fields = block, []
    if content.startswith("application/http"):
        payload = block.partition(_BREAK)[2]
    elif content.startswith("application/warc-fields"):
        lines = [x.split(":", 1) for x in block.decode("utf-8", "replace").split("\r\n") if ":" in x]
        fields = [{"name": a.strip(), "value": b.strip()} for a, b in lines]
    has_payload = kind in ("response", "resource")
    return {
        "record_id": _unbracketed(one.get("warc-record-id")),
        "type": kind,
        "date": one.get("warc-date"),
        "target_uri": one.get("warc-target-uri"),
        "concurrent_to": [_unbracketed(x) for x in named.get("warc-concurrent-to", [])],
        "refers_to": _unbracketed(one.get("warc-refers-to")),
        "declared_digest": one.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload_bytes": len(payload) if has_payload else None,
        "payload_digest": payload_digest(payload) if has_payload else None,
        "fields": fields,
        "payload": payload if has_payload else None,
    }


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row for each record of the .gz archives below `path`, with links and the digest of its payload.

    A compressed file is one task, which holds one record at a time. A record that is cut short, or whose
    length does not fit, is an error. `payload` is left out on demand.
    """
    ship_package(spark)
    names = [n for n, _ in _RECORD_ROWS if with_payload or n != "payload"]
    types = dict(_RECORD_ROWS)
    lines = spark.read.option("lineSep", BREAK).option("pathGlobFilter", "*.gz").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("part"))

    def batch(rows: list[dict]) -> pa.RecordBatch:
        columns = [pa.array([r[n] for r in rows], types[n]) for n in names]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, stream, rows, size = None, _Stream(), [], 0
        for parts in batches:
            for file, part in zip(*[c.to_pylist() for c in parts.columns], strict=True):
                if file != now:
                    stream.close()
                    now, stream = file, _Stream()
                for record in stream.add(part):
                    rows.append({"file": file, **parse_record(record)})
                    size += len(record) if with_payload else 200
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
        stream.close()
        if rows:
            yield batch(rows)

    return lines.mapInArrow(run, _RECORDS + (", payload binary" if with_payload else ""))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each response or revisit among the rows of read_records().

    capture_id, target_uri, date, record_type, request and metadata (arrays of the records that say they
    are concurrent to it, or that it says so of, by record id), payload_bytes, payload_digest, digest_ok
    (as the header declares it), refers_to (record id) and referred (record id, page_id, payload_bytes and
    payload_digest of the response that a revisit stands for; NULL if that is in no archive). A revisit
    has the payload values of that response. page_id comes from the metadata. Record ids must be unique.
    """
    records = materialize(records, "warc-records")
    anchors = records.where("type in ('response', 'revisit')")
    others = records.where("type in ('request', 'metadata')")
    body = F.struct("record_id", "type", "target_uri", "date", "fields")
    # Links may be stated on either side.
    said = others.select(F.explode("concurrent_to").alias("capture_id"), body.alias("other"))
    heard = anchors.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("to"))
    heard = heard.join(others.select(F.col("record_id").alias("to"), body.alias("other")), "to").select("capture_id", "other")
    linked = (
        said.unionByName(heard)
        .groupBy("capture_id")
        .agg(F.array_sort(F.collect_list("other")).alias("linked"))
        .withColumnRenamed("capture_id", "of")
    )
    captures = anchors.join(linked, F.col("record_id") == F.col("of"), "left")

    def of_type(kind: str):
        return F.array_distinct(F.filter(F.coalesce("linked", F.array()), lambda x: x["type"] == kind))

    fields = F.flatten(F.transform("metadata", lambda m: m["fields"]))
    ids = F.transform(F.filter(fields, lambda f: f["name"] == "page-id"), lambda f: f["value"])
    extra = ["payload"] if "payload" in records.columns else []
    captures = (
        captures.withColumns({"request": of_type("request"), "metadata": of_type("metadata")})
        .withColumn("page_id", F.try_element_at(ids, F.lit(1)).try_cast("long"))
        .select(
            F.col("record_id").alias("capture_id"), "target_uri", "date", F.col("type").alias("record_type"), "page_id",
            "request", "metadata", "payload_bytes", F.coalesce("payload_digest", "declared_digest").alias("payload_digest"),
            (F.col("payload_digest") == F.col("declared_digest")).alias("digest_ok"), "refers_to", *extra,
        )
    )
    captures = materialize(captures, "warc-captures")
    revisits = captures.where("record_type = 'revisit'")
    counts = revisits.groupBy("refers_to").agg(F.count("*").alias("n"))
    referred = F.struct(F.col("capture_id").alias("record_id"), "page_id", "payload_bytes", "payload_digest")
    responses = captures.where("record_type = 'response'").select(
        F.col("capture_id").alias("refers_to"), referred.alias("referred")
    )
    # A response may have any number of revisits, so those with many are joined apart.
    groups = materialize(counts.join(responses, "refers_to"), "warc-referred")
    found = join_groups(revisits, groups, ["refers_to"], "n", revisits.count(), "left").drop("n")
    found = found.withColumn("payload_bytes", F.col("referred.payload_bytes")).withColumn(
        "digest_ok", F.col("referred.payload_digest") == F.col("payload_digest")
    )
    return captures.where("record_type = 'response'").unionByName(found, allowMissingColumns=True)


#: DuckDB SQL for the digest of the captures of `pages`; base32 from groups of five hexadecimal digits.
ORACLE = """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
            min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
        FROM pages)
    SELECT page_id, strlen(html) AS payload_bytes,
        list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + CAST(CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) // [32768, 1024, 32, 1][1 + i % 4] % 32 AS INT), 1)
            FOR i IN range(32)], 'string_agg', '') AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to
    FROM p"""
