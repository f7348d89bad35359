"""Cleaning: keys, duplicates, formats, missing values, outliers, logs and bins.

``fit_*`` functions run one or two aggregates on the train slice and return a
plain mapping; the matching apply functions are single projections.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabloom.functions.columns import (
    clamp,
    is_fractional,
    is_infinite,
    is_numeric,
    is_string,
    key_column,
    numeric_columns,
    parse_number,
    present,
    quoted,
    string_columns,
    strip,
    value,
)
from tabloom.functions.lineage import materialize
from tabloom.functions.quantiles import exact_quantiles
from tabloom.functions.wide import aggregate_row
from tabloom.operators.profile import top_values, value_table
from tabloom.operators.sampling import sized_text

LOG_EPS = 1e-9
# Rows whose text is measured, and the mean bytes of a row's key beyond which it counts as long.
LOOK_ROWS = 1000
LONG_BYTES = 256
# Row numbers that may be broadcast: 16 MB.
MAX_BROADCAST_ROWS = 2_000_000


# --- columns and keys -------------------------------------------------------


def set_primary_key(df: DataFrame, column: str, new_name: str = "pk") -> DataFrame:
    """Rename the id column; a missing one leaves the frame unchanged."""
    return df.withColumnRenamed(column, new_name) if column in df.columns and column != new_name else df


def primary_key_check(df: DataFrame, column: str) -> DataFrame:
    """One row: rows, null ids and repeated ids (a second null is a repeat).

    Grouped by id first, so a hot id is one row per task when it reaches the shuffle.
    """
    return (
        df.groupBy(quoted(column).alias("id"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("copies"))), F.lit(0)).alias("null_ids"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_ids"),
        )
    )


def dropped_columns(rules: Mapping | None) -> list[str]:
    """The drop section of an encoding rule document, given as a list or as a dict of lists."""
    section = (rules or {}).get("drop", [])
    if isinstance(section, Mapping):
        return [c for names in section.values() for c in names]
    return list(section)


def drop_leakage(
    df: DataFrame, leakage: Sequence[str], *, rules: Mapping | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """Drop the listed columns, those of the rule document and the extra ones, where present."""
    return df.drop(*present(df, [*leakage, *dropped_columns(rules), *extra]))


def deduplicate(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    *,
    keep: str | bool = "first",
    order_by: Sequence[str | Column] = (),
) -> DataFrame:
    """Keep the first or last row per key in ``order_by`` order, or (``keep=False``) only rows whose key is unique.

    Spark limits each task to one candidate per key before the shuffle, so the copies
    of a hot key do not meet in one task. Rows are partitioned by the keys of long text,
    see :func:`text_key`. Without ``order_by`` any one row is kept, which is exact when the
    key is the whole row.
    """
    keys = list(subset or df.columns)
    if keep is False:
        return _unrepeated(df, keys)
    if not order_by:
        return _one_of_each(df, keys)
    order = [quoted(c) if isinstance(c, str) else c for c in order_by]
    if keep == "last":
        order = [c.desc_nulls_last() for c in order]
    window = W.partitionBy(*[key_column(df, c) for c in keys]).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).where(F.col("_place") == 1).drop("_place")


def _unrepeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows alone under their key: at most two candidates per key and task are shuffled."""
    keyed = {f"_key{i}": key_column(df, c) for i, c in enumerate(keys)}
    by = W.partitionBy(*keyed)
    few = df.withColumns(keyed).withColumn("_place", F.row_number().over(by.orderBy(F.lit(1)))).where(F.col("_place") <= 2)
    copies = F.max("_place").over(by)
    return few.withColumn("_copies", copies).where(F.col("_copies") == 1).drop("_place", "_copies", *keyed)


def _one_of_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key. Where keys are long texts the rows are written and only digests and numbers shuffled.

    The length of text in a few rows chooses the way, never the result.
    """
    texts = [c for c in keys if is_string(df, c)]
    if not texts:
        return df.dropDuplicates(keys)
    length = reduce(Column.__add__, [F.coalesce(F.octet_length(quoted(c)), F.lit(0)) for c in texts])
    if (df.limit(LOOK_ROWS).agg(F.avg(length)).first()[0] or 0) <= LONG_BYTES:
        return df.dropDuplicates(keys)
    whole = F.sha2(F.concat(*[sized_text(df, c) for c in keys]).cast("binary"), 256)
    rows = materialize(df.withColumns({"_key": whole, "_row": F.monotonically_increasing_id()}), "rows")
    numbers = rows.select("_key", "_row")
    first = numbers.groupBy("_key").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    gone = materialize(numbers.join(first, "_key").where("_row <> _first").select("_row"), "copies")
    if gone.count() <= MAX_BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return rows.join(gone, "_row", "left_anti").select(*[quoted(c) for c in df.columns])


# --- formats ----------------------------------------------------------------


def normalize_strings(
    df: DataFrame, columns: Sequence[str] | None = None, *, lower: bool = True, strip_text: bool = True
) -> DataFrame:
    """Strip and lower string columns; NULL stays NULL and other types are skipped."""
    names = [c for c in present(df, columns if columns is not None else string_columns(df)) if is_string(df, c)]

    def clean(c: str) -> Column:
        col = strip(quoted(c)) if strip_text else quoted(c)
        return F.lower(col) if lower else col

    return df.withColumns({c: clean(c) for c in names}) if names else df


def trim_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast to string and strip; a missing value stays missing."""
    names = present(df, columns)
    return df.withColumns({c: strip(quoted(c).cast("string")) for c in names}) if names else df


def parse_percentages(df: DataFrame, columns: Sequence[str], *, divide: bool = False) -> DataFrame:
    """`13.56%` to 13.56 (or 0.1356), as float; text that is no number becomes NULL."""

    def parse(c: str) -> Column:
        if is_numeric(df, c):
            number = value(df, c).cast("double")
        else:
            number = parse_number(F.replace(strip(quoted(c).cast("string")), F.lit("%"), F.lit("")))
        return (number / 100 if divide else number).cast("float")

    names = present(df, columns)
    return df.withColumns({c: parse(c) for c in names}) if names else df


#: How dates may be written, as Spark datetime patterns. Of patterns that fit equally many values the first one counts.
DATE_FORMATS = (
    "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm", "yyyy/M/d",
    "yyyyMMdd", "yyyy-MM", "M/d/yyyy", "M-d-yyyy", "M/d/yyyy HH:mm", "M/d/yyyy HH:mm:ss", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy",
    "d/M/yyyy HH:mm", "d/M/yyyy HH:mm:ss", "M/yyyy", "MMM-yyyy", "MMM yyyy", "MMMM yyyy", "MMM-yy", "yyyy-MMM", "d-MMM-yyyy",
    "d MMM yyyy", "d MMMM yyyy", "d-MMM-yy", "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "yyyy",
)
#: Longer text is no date in any of these.
_DATE_LENGTH = 40


def fit_date_formats(
    train: DataFrame, columns: Sequence[str], *, candidates: Sequence[str] = DATE_FORMATS
) -> dict[str, str | None]:
    """The pattern that reads most values of each text column, None if none reads any.

    One grouped aggregate counts the distinct written values of all columns, the patterns are tried on
    those alone. All rows vote, so neither row order nor a bad first value matters; `01/02/2015` alone
    cannot tell day from month and takes the earlier candidate, month first.
    """
    names = [c for c in present(train, columns) if is_string(train, c)]
    if not names:
        return {}
    written = {c: strip(quoted(c)) for c in names}
    short = train.select(*[F.when(F.length(w) <= _DATE_LENGTH, w).alias(c) for c, w in written.items()])
    hits = [
        F.sum(F.when(F.try_to_timestamp("value", F.lit(p)).isNotNull(), F.col("count")).otherwise(0)).alias(f"p{i}")
        for i, p in enumerate(candidates)
    ]
    rows = value_table(short, names).groupBy("column").agg(*hits).collect()
    votes = {r["column"]: [r[f"p{i}"] for i in range(len(candidates))] for r in rows}
    return {c: candidates[votes[c].index(max(votes[c]))] if any(votes.get(c, ())) else None for c in names}


def parse_dates(
    df: DataFrame,
    columns: Sequence[str],
    *,
    reference: str | None = None,
    format: str | Mapping[str, str | None] | None = None,
) -> DataFrame:
    """Replace each date column by `{c}_year`, `{c}_month` and, with a reference date,
    `{c}_months_since`: whole days up to the reference, floored, over 30.

    ``format`` is a Spark datetime pattern such as ``MMM-yyyy``, or one for each column as
    :func:`fit_date_formats` finds them; a text column without one is read as an ISO date.
    What the pattern does not read is NULL. Days are counted on the microsecond difference,
    so a time of day counts.
    """
    names = present(df, columns)
    if not names:
        return df
    added: dict[str, Column] = {}
    for c in names:
        text = quoted(c)
        own = format.get(c) if isinstance(format, Mapping) else format
        if is_string(df, c):
            text = strip(text) if isinstance(format, Mapping) else text
            when = F.try_to_timestamp(text, F.lit(own)) if own else F.try_to_timestamp(text)
        else:
            when = text.cast("timestamp")
        added[f"{c}_year"] = F.year(when).cast("float")
        added[f"{c}_month"] = F.month(when).cast("float")
        if reference is not None:
            gap = F.unix_micros(F.lit(reference).cast("timestamp")) - F.unix_micros(when)
            days = F.floor(gap / F.lit(86_400_000_000.0))
            added[f"{c}_months_since"] = (days / F.lit(30.0)).cast("float")
    return df.withColumns(added).drop(*names)


def infer_dates(df: DataFrame, columns: Sequence[str], *, reference: str | None = None) -> DataFrame:
    """:func:`parse_dates` with the formats that the table's own values vote for; one job at once."""
    return parse_dates(df, columns, reference=reference, format=fit_date_formats(df, columns))


# --- missing values ---------------------------------------------------------


def fit_fill_values(train: DataFrame, columns: Sequence[str]) -> dict[str, float | str | None]:
    """Median of numeric columns, smallest most frequent value of the others."""
    names = present(train, columns)
    numeric = [c for c in names if is_numeric(train, c)]
    other = [c for c in names if c not in numeric]
    medians = exact_quantiles(train, numeric, [0.5])
    fills: dict[str, float | str | None] = {c: medians[c][0] for c in numeric}
    if other:
        found = {r["column"]: r["top_value"] for r in top_values(train, other).collect()}
        fills |= {c: found.get(c) for c in other}
    return {c: fills[c] for c in names}


def fill_missing(
    df: DataFrame,
    fills: Mapping[str, float | str | None],
    *,
    drop: Sequence[str] = (),
    flag: Sequence[str] = (),
    fill: Sequence[str] = (),
) -> DataFrame:
    """Drop columns, flag and fill columns, fill columns; one projection.

    A flag `{c}_MISSING` records what was missing before filling. An absent column
    is skipped and a column without a fill value keeps its gaps.
    """
    df = df.drop(*present(df, drop))
    flagged, plain = present(df, flag), present(df, fill)
    filled = {
        c: _fill(df, c, fills[c]) for c in dict.fromkeys([*flagged, *plain]) if fills.get(c) is not None
    }
    flags = {f"{c}_MISSING": value(df, c).isNull().cast("tinyint") for c in flagged}
    return df.withColumns({**filled, **flags}) if filled or flags else df


def _fill(df: DataFrame, c: str, fill) -> Column:
    """Fill and keep the type, except that an integer column given a fraction turns to double."""
    dtype = df.schema[c].dataType
    literal = F.lit(fill)
    if is_numeric(df, c) and not is_fractional(df, c) and float(fill) != int(fill):
        return F.coalesce(quoted(c).cast("double"), literal.cast("double"))
    return F.coalesce(value(df, c), literal.cast(dtype))


def fit_numeric_medians(train: DataFrame) -> dict[str, float]:
    """Medians of the numeric columns that have gaps."""
    names = numeric_columns(train)
    gaps = aggregate_row(train, {c: F.count_if(value(train, c).isNull()) for c in names})
    medians = exact_quantiles(train, [c for c in names if gaps[c]], [0.5])
    return {c: m[0] for c, m in medians.items() if m[0] is not None}


def fill_numeric_median(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    return fill_missing(df, medians, fill=list(medians))


def replace_infinite(df: DataFrame) -> DataFrame:
    """Both infinities become NULL."""
    names = [c for c in df.columns if is_fractional(df, c)]
    return df.withColumns({c: F.when(~is_infinite(quoted(c)), value(df, c)) for c in names}) if names else df


# --- outliers ---------------------------------------------------------------


def fit_clip_bounds(
    train: DataFrame,
    columns: Sequence[str],
    *,
    lower: float = 0.01,
    upper: float = 0.99,
    rules: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> dict[str, dict[str, float | None]]:
    """Quantile bounds per numeric column, tightened by fixed (min, max) rules."""
    names = [c for c in present(train, columns) if is_numeric(train, c)]
    quantiles = exact_quantiles(train, names, [lower, upper])
    return {c: _tighten(quantiles[c], (rules or {}).get(c, (None, None))) for c in names}


def fit_iqr_bounds(train: DataFrame, columns: Sequence[str], *, factor: float = 1.5) -> dict[str, dict[str, float | None]]:
    """Quartile fences per numeric column, for the `iqr` outlier method."""
    names = [c for c in present(train, columns) if is_numeric(train, c)]
    bounds = {}
    for c, (q1, q3) in exact_quantiles(train, names, [0.25, 0.75]).items():
        if q1 is None:
            bounds[c] = {"low": None, "high": None}
        else:
            bounds[c] = {"low": q1 - factor * (q3 - q1), "high": q3 + factor * (q3 - q1)}
    return bounds


def _tighten(bounds: Sequence[float | None], rule: tuple[float | None, float | None]) -> dict[str, float | None]:
    low, high = bounds
    if low is not None and rule[0] is not None:
        low = max(low, float(rule[0]))
    if high is not None and rule[1] is not None:
        high = min(high, float(rule[1]))
    return {"low": low, "high": high}


def clip_outliers(df: DataFrame, bounds: Mapping[str, Mapping[str, float | None]]) -> DataFrame:
    """Clip fitted numeric columns to their bounds, as float; NULL stays NULL."""
    names = [c for c in present(df, bounds) if is_numeric(df, c)]
    clipped = {
        c: clamp(value(df, c).cast("double"), bounds[c]["low"], bounds[c]["high"]).cast("float") for c in names
    }
    return df.withColumns(clipped) if clipped else df


def clamp_domain(df: DataFrame, rules: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Hold ruled columns inside their fixed range, keeping their type."""
    names = [c for c in present(df, rules) if is_numeric(df, c)]
    held = {
        c: clamp(
            value(df, c), *[None if b is None else float(b) for b in rules[c]]
        ).cast(df.schema[c].dataType)
        for c in names
    }
    return df.withColumns(held) if held else df


# --- logs and bins ----------------------------------------------------------


def fit_log_shift(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Shift per numeric column that makes its train minimum non-negative; 0 when it already is."""
    names = [c for c in present(train, columns) if is_numeric(train, c)]
    lows = aggregate_row(train, {c: F.min(value(train, c)).cast("double") for c in names})
    return {c: -lows[c] + LOG_EPS if lows[c] is not None and lows[c] < 0 else 0.0 for c in names}


def log1p_columns(df: DataFrame, shifts: Mapping[str, float]) -> DataFrame:
    """Add `{c}_LOG` = log1p(c + shift) as float; NULL where that is not defined."""
    names = [c for c in present(df, shifts) if is_numeric(df, c)]
    logs = {
        f"{c}_LOG": F.log1p(value(df, c).cast("double") + F.lit(float(shifts[c]))).cast("float") for c in names
    }
    return df.withColumns(logs) if logs else df


def cut_bins(df: DataFrame, column: str, name: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Label right-closed intervals (a, b]; the lowest edge belongs to the first, outside is NULL."""
    if column not in df.columns:
        raise ValueError(f"no column {column!r}; the frame has {df.columns}")
    if not is_numeric(df, column):
        raise TypeError(f"{column!r} is {df.schema[column].dataType.simpleString()}, binning needs a number")
    if len(labels) != len(edges) - 1:
        raise ValueError(f"{len(edges)} edges need {len(edges) - 1} labels, got {len(labels)}")
    col = value(df, column)
    chain = F.when(col < F.lit(edges[0]), F.lit(None).cast("string"))
    for high, label in zip(edges[1:], labels):
        chain = chain.when(col <= F.lit(high), F.lit(label))
    return df.withColumn(name, chain)
