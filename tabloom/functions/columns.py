"""Null-safe, ANSI-safe column expressions shared by the operators."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The whitespace characters Python's str.strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# What counts as a number inside a percent string.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?inf(inity)?\s*$"

_FRACTIONAL = (T.DoubleType, T.FloatType)


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """A column reference that survives dots and spaces in the name."""
    return F.col(quoted_name(name))


# Bytes of a text that is its own key; the digest of a longer one has a byte more.
KEY_BYTES = 64


def text_key(col: Column) -> Column:
    """What a text is grouped and shuffled by: itself if it is short, else its 256-bit digest; NULL stays NULL."""
    return F.when(F.octet_length(col) > KEY_BYTES, F.concat(F.lit("#"), F.sha2(col.cast("binary"), 256))).otherwise(col)


def key_column(df: DataFrame, name: str) -> Column:
    """A column to group rows by, with text by its key."""
    return text_key(quoted(name)) if is_string(df, name) else quoted(name)


def is_numeric(df: DataFrame, name: str) -> bool:
    """Numeric types only: booleans are not numeric here."""
    return isinstance(df.schema[name].dataType, T.NumericType)


def is_fractional(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, _FRACTIONAL)


def is_string(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [c for c in df.columns if c not in skip and is_numeric(df, c)]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [c for c in df.columns if c not in skip and is_string(df, c)]


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The listed columns the frame has, in list order and without repeats."""
    have = set(df.columns)
    return [c for c in dict.fromkeys(names) if c in have]


def value(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing, so NULL is the only missing value."""
    col = quoted(name)
    return F.nanvl(col, F.lit(None)) if is_fractional(df, name) else col


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every float column, in one projection."""
    fractional = [c for c in df.columns if is_fractional(df, c)]
    return df.withColumns({c: value(df, c) for c in fractional}) if fractional else df


def finite(df: DataFrame, name: str) -> Column:
    """A numeric column in double with NaN and infinities as NULL."""
    col = value(df, name).cast("double")
    return F.when(~is_infinite(col), col)


def is_infinite(col: Column) -> Column:
    return F.abs(col) == F.lit(float("inf"))


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def round_even(col: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the numpy rule."""
    scale = float(10**digits)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def percent_of(part: Column, whole: Column) -> Column:
    """part / whole * 100, NULL for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def safe_divide(numerator: Column, denominator: Column, eps: float = 1e-9) -> Column:
    """Quotient in double; NULL where the denominator is missing, infinite or within eps of zero."""
    num, den = numerator.cast("double"), denominator.cast("double")
    usable = (F.abs(den) > F.lit(eps)) & ~F.isnan(den) & ~is_infinite(den)
    return F.when(usable, F.nanvl(F.try_divide(num, den), F.lit(None)))


def clamp(col: Column, low: float | None, high: float | None) -> Column:
    """Bound a value while leaving NULL alone. Swapped bounds are put in order."""
    if low is not None and high is not None and low > high:
        low, high = high, low
    if low is None and high is None:
        return col
    chain = None
    if low is not None:
        chain = F.when(col < F.lit(low), F.lit(low))
    if high is not None:
        over = col > F.lit(high)
        chain = F.when(over, F.lit(high)) if chain is None else chain.when(over, F.lit(high))
    return chain.otherwise(col)


def parse_number(text: Column) -> Column:
    """Text to double; anything not shaped like a number is NULL (`1d` included)."""
    return (
        F.when(text.rlike(NUMBER_PATTERN), strip(text).try_cast("double"))
        .when(
            text.rlike(INFINITY_PATTERN),
            F.when(strip(text).startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))),
        )
    )


def sql_double(number: float) -> str:
    """A double literal for SQL text. Long `CASE` chains are far quicker to build as text."""
    if math.isinf(number) or math.isnan(number):
        return f"double('{number}')"
    return f"{number!r}D"
