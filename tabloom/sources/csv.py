"""CSV sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabloom.functions.columns import parse_number, present, quoted, quoted_name
from tabloom.operators.sampling import sample_rows
from tabloom.operators.types import optimize_types
from tabloom.sources.records import can_split, read_records

_EXTRA = "_extra_field"

# The words that table files commonly use for a missing value.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _options(sep: str, encoding: str, multiline: bool) -> dict[str, str]:
    """A quote inside a quoted value is doubled; blanks are part of a value."""
    return {
        "header": "true",
        "sep": sep,
        "encoding": encoding,
        "quote": '"',
        "escape": '"',
        "multiLine": str(multiline).lower(),
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "mode": "PERMISSIVE",
        # Stands for an unquoted empty value, so that a quoted one is told from it.
        "nullValue": "\u0001",
    }


def _header(spark: SparkSession, path: str, options: dict) -> list[str]:
    return spark.read.options(**options).csv(path).columns


def read_csv_table(
    spark: SparkSession,
    path: str,
    *,
    columns: Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
    rows: int | None = None,
    sep: str = ",",
    encoding: str = "utf-8",
    decimal: str = ".",
    missing: Sequence[str] = MISSING_WORDS,
    multiline: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Read CSV or gzip CSV with a header.

    A row with too many fields is dropped and a short row is padded with NULL.
    Spark on its own would cut the long row, so one column more than the header
    is declared and rows that fill it are filtered out.

    ``schema`` may name only some columns; the others have their type inferred
    from the kept rows, with ``rows`` from those rows alone. ``decimal`` other than
    "." applies to numeric columns of ``schema``. Values in ``missing`` become NULL
    in every column; with ``()`` only an unquoted empty value is NULL. Quoted line
    breaks need ``multiline``: a first scan tells for each byte range whether it starts
    within quotes, so that a large file is still read by many tasks; with
    ``multiline=False`` every line is a record and that scan falls away. With ``rows``
    files are read from their start. Of a compressed file, or one in UTF-16, each is one
    task to read in any case: its rows are spread over the cores, or over ``partitions``.
    """
    options = _options(sep, encoding, multiline)
    names = _header(spark, path, options)
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    forced = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    raw = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _EXTRA]])
    # Every value is read as text first: the header check would reject the extra column.
    text = _text(spark, path, raw, options, whole_files=bool(rows)).where(F.col(_EXTRA).isNull())
    if rows:
        text = text.limit(rows)
    wanted = [c for c in names if c in set(columns)] if columns else names
    text = text.select(*[_present_value(quoted(c), missing).alias(c) for c in wanted])
    inferred = _infer(text, [c for c in wanted if c not in forced], decimal)
    types = {**inferred, **forced}
    if partitions is None and path.endswith(".gz"):
        partitions = spark.sparkContext.defaultParallelism
    if partitions:
        text = text.repartition(partitions)
    return text.select(*[_typed(quoted(c), types[c], decimal).alias(c) for c in wanted])


def _text(spark: SparkSession, path: str, schema: T.StructType, options: dict, whole_files: bool) -> DataFrame:
    """All values as text. Quoted line breaks are found in byte ranges, unless files must be read from their start."""
    if options["multiLine"] == "true" and not whole_files and can_split(spark, path, options["encoding"]):
        records = read_records(spark, path, options["sep"], options["encoding"])
        if records is not None:
            ddl = ", ".join(quoted_name(n) + " string" for n in schema.fieldNames())
            return records.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
        options = options | {"multiLine": "false"}
    return spark.read.options(**{**options, "enforceSchema": "true"}).schema(schema).csv(path)


def _present_value(col, missing: Sequence[str]):
    return F.when(~col.isin(*missing), col) if missing else col


def _typed(col, dtype: T.DataType, decimal: str):
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)) and decimal != ".":
        col = F.translate(col, decimal, ".")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return parse_number(col).cast(dtype)
    return col.try_cast(dtype)


def _infer(text: DataFrame, columns: Sequence[str], decimal: str) -> dict[str, T.DataType]:
    """bigint, double or string, from one aggregate over all kept rows."""
    if not columns:
        return {}
    tests = {}
    for i, c in enumerate(columns):
        col = quoted(c)
        number = parse_number(F.translate(col, decimal, ".") if decimal != "." else col)
        tests[f"n{i}"] = F.count(col)
        tests[f"i{i}"] = F.count_if(col.rlike(r"^\s*[+-]?[0-9]+\s*$") & col.try_cast("bigint").isNotNull())
        tests[f"d{i}"] = F.count(number)
    row = text.agg(*[v.alias(k) for k, v in tests.items()]).first()
    found: dict[str, T.DataType] = {}
    for i, c in enumerate(columns):
        n = row[f"n{i}"]
        if n and row[f"i{i}"] == n:
            found[c] = T.LongType()
        elif n and row[f"d{i}"] == n:
            found[c] = T.DoubleType()
        else:
            found[c] = T.StringType()
    return found


def load_table(
    spark: SparkSession,
    path: str,
    *,
    columns: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    optimize: bool = True,
    rows: int | None = None,
    **dialect,
) -> DataFrame:
    """Read, drop the listed columns that exist, narrow the types."""
    df = read_csv_table(spark, path, columns=columns, rows=rows, **dialect)
    df = df.drop(*present(df, drop))
    return optimize_types(df) if optimize else df


def count_rows(spark: SparkSession, path: str, **dialect) -> int:
    """Rows kept by the reader; header and over-long rows do not count."""
    how = {"sep": ",", "encoding": "utf-8", "multiline": True} | dialect
    names = _header(spark, path, _options(how["sep"], how["encoding"], how["multiline"]))
    text_only = ", ".join(f"`{n}` string" for n in names)
    return read_csv_table(spark, path, schema=text_only, **dialect).count()


def read_sample(
    spark: SparkSession,
    path: str,
    size: int = 50_000,
    *,
    seed: int = 42,
    head_only: bool = False,
    **options,
) -> DataFrame:
    return sample_rows(read_csv_table(spark, path, **options), size, seed=seed, head_only=head_only)


def write_csv_table(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """CSV with a header that the reader returns unchanged. ``single_file`` is for report-sized tables only."""
    out = df.coalesce(1) if single_file else df
    options = {k: v for k, v in _options(",", "utf-8", True).items() if k not in ("mode", "multiLine", "nullValue")}
    out.write.mode("overwrite").options(**options).csv(path)
