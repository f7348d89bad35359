"""Records of CSV files whose quoted values may hold line breaks, read in byte ranges.

A range that starts in the middle of a file does not know whether it starts within quotes. A line is
therefore read as a function of two states: from the start of a record, or from within quotes, to the
state behind its line break. The first scan composes the lines of each range (quotes in lines, all
others change nothing), a prefix over the few values of each range gives every range its true state,
and the second scan joins lines to records. A record that crosses a cut leaves a fragment in each range
it touches; these, at most two a range, are put together by a small grouping.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.functions.lineage import materialize
from tabloom.functions.workers import ship_package

# Text up to the quote that closes a value; a doubled quote belongs to the value.
_INSIDE = re.compile(r'[^"]*(?:""[^"]*)*')
_COMPRESSED = re.compile(r"\.(gz|bz2|zst|lz4|snappy|deflate|xz)$")
# Encodings in which a quote, a separator and a line break are the ASCII bytes, and that Spark decodes.
_ENCODINGS = {"utf-8": None, "utf8": None, "us-ascii": "US-ASCII", "ascii": "US-ASCII", "iso-8859-1": "ISO-8859-1"}


def ends_inside(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether the text is within quotes behind this line. Quotes count only where a value starts with one."""
    at = 0
    if inside:
        at = _INSIDE.match(line).end() + 1
        if at > len(line):
            return True
    elif line.startswith('"'):
        at = _INSIDE.match(line, 1).end() + 1
        if at > len(line):
            return True
    while (start := line.find(f'{sep}"', at)) >= 0:
        at = _INSIDE.match(line, start + len(sep) + 1).end() + 1
        if at > len(line):
            return True
    return False


def can_split(spark: SparkSession, path: str, encoding: str) -> bool:
    """Whether ranges of the files can be read: none compressed, in an encoding that keeps ASCII bytes."""
    return encoding.lower() in _ENCODINGS and not any(map(_COMPRESSED.search, spark.read.text(path).inputFiles()))


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """file (hash of its path), at (start of the byte range) and line, in the same ranges whenever it is read.

    Ranges follow the number of cores, which changes as executors come and go; a session of its own holds
    the settings they are made from.
    """
    fixed = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        fixed.conf.set(key, spark.conf.get(key))
    number = spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism
    fixed.conf.set("spark.sql.files.minPartitionNum", str(number))
    charset = _ENCODINGS[encoding.lower()]
    line = F.decode(F.col("value").cast("binary"), charset) if charset else F.make_valid_utf8("value")
    lines = fixed.read.option("lineSep", "\n").text(path).select(
        # Two of a million files share a 64-bit hash with a chance of one in ten million.
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
        line.alias("line"),
    )
    # An empty table in front takes the frame back to the caller's session.
    return spark.createDataFrame([], lines.schema).union(lines)


_RANGES = pa.schema(
    [("file", pa.int64()), ("at", pa.int64())]
    + [(n, pa.bool_()) for n in ("from_start", "from_inside", "closes", "breaks", "breaks_inside")]
)
#: What lines without a quote do: nothing to either state, and from within quotes no record is closed.
_NOTHING = (False, True, False, False, False)


def _turns(batch: pa.RecordBatch) -> np.ndarray:
    """Rows at which another range may start."""
    file, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    return np.concatenate([[0], np.flatnonzero((file[1:] != file[:-1]) | (at[1:] != at[:-1])) + 1])


def _range_states(lines: DataFrame, sep: str) -> DataFrame:
    """One row for each range: its effect on the two states, and whether a line of it ends within quotes.

    from_start and from_inside are the states at its end; closes and breaks_inside hold for a range that
    starts within quotes: a record ends in it, and a line of a later record ends within quotes.
    """

    def step(states: tuple, line: str) -> tuple:
        start, inside, closes, breaks, breaks_inside = states
        after = {s: ends_inside(line, s, sep) for s in {start, inside}}
        # A line reader of Spark's would also break at a carriage return within a value.
        odd = "\r" in line[:-1]
        later = (closes and after[inside]) or odd
        return after[start], after[inside], closes or not after[inside], breaks or after[start] or odd, breaks_inside or later

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, states, rows = None, _NOTHING, []
        for batch in batches:
            file, at, line = batch.columns
            quoted = np.flatnonzero(line.is_valid().to_numpy(zero_copy_only=False))
            for i in np.union1d(_turns(batch), quoted).tolist():
                here = file[i].as_py(), at[i].as_py()
                if here != now:
                    if now:
                        rows.append((*now, *states))
                    now, states = here, _NOTHING
                if (text := line[i].as_py()) is not None:
                    states = step(states, text)
        if now:
            rows.append((*now, *states))
        yield _batch(_RANGES, rows)

    quoted = F.when(F.contains("line", F.lit('"')), F.col("line")).alias("line")
    ddl = "file long, at long, " + ", ".join(f"{f.name} boolean" for f in list(_RANGES)[2:])
    return lines.select("file", "at", quoted).mapInArrow(run, ddl)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_STARTS = "file long, at long, inside boolean, chain long, breaks boolean"


def _range_starts(ranges: DataFrame) -> DataFrame:
    """For each range the state it starts in and how many crossing records were opened before it.

    A group is the few values of each range of one file.
    """

    def run(table: pa.Table) -> pa.Table:
        inside, chain, rows = False, 0, []
        for r in table.sort_by("at").to_pylist():
            rows.append((r["file"], r["at"], inside, chain, r["breaks_inside"] if inside else r["breaks"]))
            after = r["from_inside"] if inside else r["from_start"]
            chain += after and (not inside or r["closes"])
            inside = after
        names = ["file", "at", "inside", "chain", "breaks"]
        return pa.table(dict(zip(names, zip(*rows, strict=True), strict=True)))

    return ranges.groupBy("file").applyInArrow(run, _STARTS)


_PARTS = pa.schema(
    [("file", pa.int64()), ("at", pa.int64()), ("chain", pa.int64()), ("header", pa.bool_()), ("record", pa.string())]
)


class _Range:
    """Joins the lines of one range to records."""

    def __init__(self, file: int, at: int, inside: bool, chain: int):
        if inside is None:
            raise RuntimeError("the byte ranges of a CSV file changed between two scans")
        self.file, self.at, self.inside, self.opened = file, at, inside, chain
        # The record that an earlier range opened.
        self.crossing, self.header, self.lines = inside, at == 0, []

    def part(self, chain: int | None) -> tuple:
        text = "\n".join(self.lines)
        out = self.file, self.at, chain, self.header, text
        # Blank lines may stand before the header.
        self.crossing, self.header, self.lines = False, self.header and text in ("", "\r"), []
        return out

    def add(self, line: str, after: bool) -> Iterator[tuple]:
        self.lines.append(line)
        self.inside = after
        if not after:
            yield self.part(self.opened if self.crossing else None)

    def close(self) -> Iterator[tuple]:
        """What is left belongs to the crossing record, or opens the next one."""
        if self.lines:
            yield self.part(self.opened if self.crossing else self.opened + 1)


def _parts(lines: DataFrame, sep: str) -> DataFrame:
    """Whole records (chain is NULL), and the fragments of those that cross a cut, numbered by file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: _Range | None = None
        for batch in batches:
            rows: list[tuple] = []
            turns = set(_turns(batch).tolist())
            quoted = batch.column(3).to_pylist()
            for i, line in enumerate(batch.column(2).to_pylist()):
                if i in turns:
                    file, at, inside, opened = (batch.column(c)[i].as_py() for c in (0, 1, 4, 5))
                    if own is None or (file, at) != (own.file, own.at):
                        if own is not None:
                            rows += own.close()
                        own = _Range(file, at, inside, opened)
                rows += own.add(line, ends_inside(line, own.inside, sep) if quoted[i] else own.inside)
            yield _batch(_PARTS, rows)
        if own is not None:
            yield _batch(_PARTS, list(own.close()))

    return lines.mapInArrow(run, "file long, at long, chain long, header boolean, record string")


def read_records(spark: SparkSession, path: str, sep: str = ",", encoding: str = "utf-8") -> DataFrame | None:
    """The text of every record but the first of each file, in one column `record`; blank lines are left out.

    None if no quoted value holds a line break, so that lines are records and Spark's own reader can split
    the files. Lines end with \\n or \\r\\n; a break within quotes stays as it is. Two scans of the files,
    each in as many tasks as there are byte ranges.
    """
    ship_package(spark)
    lines = _lines(spark, path, encoding)
    starts = materialize(_range_starts(_range_states(lines, sep)), "csv-ranges")
    if starts.where("breaks or inside").isEmpty():
        return None
    # A few numbers for each task of the scan.
    known = F.broadcast(starts.drop("breaks"))
    joined = lines.join(known, ["file", "at"], "left")
    quoted = F.contains("line", F.lit('"')).alias("quoted")
    parts = _parts(joined.select("file", "at", "line", quoted, "inside", "chain"), sep)
    pieces = F.sort_array(F.collect_list(F.struct("at", "record")))
    crossing = (
        parts.where("chain is not null")
        .groupBy("file", "chain")
        .agg(F.array_join(F.transform(pieces, lambda p: p["record"]), "\n").alias("record"), F.max("header").alias("header"))
    )
    whole = parts.where("chain is null").select("record", "header")
    records = whole.unionByName(crossing.select("record", "header")).where("not header")
    return records.select(F.regexp_replace("record", "\r$", "").alias("record")).where("record != ''")
