"""Categorical encoding with a vocabulary fixed on the train slice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabloom.functions.columns import present, quoted, strip
from tabloom.functions.lineage import materialize
from tabloom.functions.wide import melt, small_table

MAX_CATEGORIES = 50
# A larger map goes in as a joined table and not as a literal of the plan.
MAX_LITERAL_ENTRIES = 1_000
# Rows of a rate table that is sent to every executor.
MAX_BROADCAST_RATES = 200_000


def _lookup(key: Column, mapping: Mapping, cast: str) -> Column:
    """Value of ``key`` in a literal map; NULL when it is absent."""
    if not mapping:
        return F.lit(None).cast(cast)
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.element_at(F.create_map(*entries), key).cast(cast)


def ordinal_encode(df: DataFrame, column: str, mapping: Mapping[str, int], *, unseen: int = -1) -> DataFrame:
    """Stripped text to its number, as float and in place; unmapped text is ``unseen``, NULL stays NULL."""
    key = strip(quoted(column).cast("string"))
    if len(mapping) <= MAX_LITERAL_ENTRIES:
        found = _lookup(key, mapping, "float")
        return df.withColumn(column, F.when(key.isNotNull(), F.coalesce(found, F.lit(float(unseen)))).cast("float"))
    table = small_table(df.sparkSession, [(k, float(v)) for k, v in mapping.items()], "_key string, _code double"
    )
    joined = df.withColumn("_key", key).join(table, "_key", "left")
    code = F.when(F.col("_key").isNotNull(), F.coalesce("_code", F.lit(float(unseen)))).cast("float")
    return joined.select(*[code.alias(c) if c == column else quoted(c) for c in df.columns])


def unseen_counts(df: DataFrame, rules: Mapping) -> DataFrame:
    """(column, unseen): rows whose text is not in the ordinal or group rules."""
    tests = {}
    for c, mapping in rules.get("ordinal", {}).items():
        if c in df.columns:
            tests[c] = ~strip(quoted(c).cast("string")).isin(list(mapping))
    for c, groups in rules.get("group_one_hot", {}).items():
        if c in df.columns:
            tests[c] = ~quoted(c).isin([v for values in groups.values() for v in values])
    if not tests:
        return small_table(df.sparkSession, [], "column string, unseen bigint")
    counts = df.agg(*[F.count_if(test).alias(c) for c, test in tests.items()])
    rows = [F.struct(F.lit(c).alias("column"), quoted(c).alias("unseen")) for c in tests]
    return counts.select(F.inline(F.array(*rows))).orderBy("column")


def fit_one_hot(
    train: DataFrame, columns: Sequence[str], *, max_categories: int = MAX_CATEGORIES
) -> dict[str, list[str]]:
    """Sorted values per column; an error when a column has more than ``max_categories``.

    At most ``max_categories + 1`` values per column are looked at after the distinct.
    """
    names = present(train, columns)
    if not names:
        return {}
    values = melt(train, names, "string").where(F.col("value").isNotNull()).distinct()
    place = F.row_number().over(W.partitionBy("column").orderBy("value"))
    rows = values.withColumn("place", place).where(F.col("place") <= max_categories + 1).collect()
    vocabulary = {c: sorted(r["value"] for r in rows if r["column"] == c) for c in names}
    for c, found in vocabulary.items():
        if len(found) > max_categories:
            raise ValueError(
                f"{c!r} has more than {max_categories} values; group them first or use a target rate"
            )
    return vocabulary


def _dummies(
    column: str, source: Column, values: Sequence[str], null_column: bool, drop_first: bool
) -> dict[str, Column]:
    out = {
        f"{column}_{v}": F.coalesce(source == F.lit(v), F.lit(False)).cast("tinyint") for v in values
    }
    if null_column:
        out[f"{column}_nan"] = source.isNull().cast("tinyint")
    if drop_first and out:
        out.pop(next(iter(out)))
    return out


def one_hot_encode(
    df: DataFrame,
    vocabulary: Mapping[str, Sequence[str]],
    *,
    null_column: bool = True,
    drop_first: bool = False,
) -> DataFrame:
    """Replace each column by one tinyint per fitted value and one for NULL.

    A value not seen in the fit is 0 everywhere.
    """
    names = present(df, vocabulary)
    added: dict[str, Column] = {}
    for c in names:
        added |= _dummies(c, quoted(c).cast("string"), vocabulary[c], null_column, drop_first)
    return df.withColumns(added).drop(*names) if names else df


def group_categories(
    df: DataFrame, column: str, groups: Mapping[str, Sequence[str]], *, name: str | None = None, other: str = "other"
) -> DataFrame:
    """Map values to group names; unmapped text is ``other``, NULL stays NULL.

    A value listed in two groups belongs to the later one.
    """
    return df.withColumn(name or column, _group(quoted(column).cast("string"), groups, other))


def _group(key: Column, groups: Mapping[str, Sequence[str]], other: str) -> Column:
    group_of = {v: g for g, values in groups.items() for v in values}
    return F.when(key.isNotNull(), F.coalesce(_lookup(key, group_of, "string"), F.lit(other)))


def fit_groups(
    train: DataFrame, groups: Mapping[str, Mapping[str, Sequence[str]]], *, other: str = "other"
) -> dict[str, list[str]]:
    """The groups that occur in train, sorted, per grouped column."""
    found = {}
    grouped = {c: _group(quoted(c).cast("string"), rule, other) for c, rule in groups.items() if c in train.columns}
    if grouped:
        # The groups of a rule are known, so the set is bounded by the rule document.
        row = train.agg(*[F.sort_array(F.collect_set(g)).alias(c) for c, g in grouped.items()]).first()
        found = {c: list(row[c]) for c in grouped}
    return found


def group_one_hot_encode(
    df: DataFrame,
    column: str,
    groups: Mapping[str, Sequence[str]],
    vocabulary: Sequence[str],
    *,
    null_column: bool = True,
    drop_first: bool = False,
    other: str = "other",
) -> DataFrame:
    """One tinyint per fitted group, named `{column}_{group}`; the column is dropped."""
    source = _group(quoted(column).cast("string"), groups, other)
    return df.withColumns(_dummies(column, source, vocabulary, null_column, drop_first)).drop(column)


def fit_encoding(train: DataFrame, rules: Mapping, *, max_categories: int = MAX_CATEGORIES) -> dict:
    """Rules plus the vocabularies found in train; JSON-ready."""
    return {
        "ordinal": {c: dict(m) for c, m in rules.get("ordinal", {}).items()},
        "one_hot": fit_one_hot(train, rules.get("one_hot", []), max_categories=max_categories),
        "group_one_hot": {c: {g: list(v) for g, v in r.items()} for c, r in rules.get("group_one_hot", {}).items()},
        "groups": fit_groups(train, rules.get("group_one_hot", {})),
    }


def encode_categoricals(
    df: DataFrame,
    fit: Mapping,
    *,
    unseen: int = -1,
    null_column: bool = True,
    drop_first: bool = False,
) -> DataFrame:
    """Apply a :func:`fit_encoding`: ordinal, then one-hot, then grouped one-hot. Absent columns are skipped."""
    for c in present(df, fit["ordinal"]):
        df = ordinal_encode(df, c, fit["ordinal"][c], unseen=unseen)
    df = one_hot_encode(df, fit["one_hot"], null_column=null_column, drop_first=drop_first)
    for c in present(df, fit["group_one_hot"]):
        df = group_one_hot_encode(
            df,
            c,
            fit["group_one_hot"][c],
            fit["groups"].get(c, []),
            null_column=null_column,
            drop_first=drop_first,
        )
    return df


def align_columns(df: DataFrame, train_columns: Sequence[str], fill: float = 0) -> DataFrame:
    """Exactly the train columns in train order: absent ones constant, extra ones dropped."""
    return df.select(*[quoted(c) if c in df.columns else F.lit(fill).alias(c) for c in train_columns])


def fit_target_encoding(
    train: DataFrame, columns: Sequence[str], *, target: str = "target", min_categories: int = 10
) -> tuple[DataFrame, float]:
    """Target mean per (column, value) for columns with more than ``min_categories`` values, and the overall mean."""
    long = melt(train, present(train, columns), "string", [quoted(target).cast("double").alias("y")])
    rates = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.avg("y").alias("rate"))
    many = rates.groupBy("column").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_categories)
    overall = train.agg(F.avg(quoted(target).cast("double"))).first()[0]
    return rates.join(F.broadcast(many.select("column")), "column", "left_semi"), overall


def target_encode(df: DataFrame, rates: DataFrame, overall: float, columns: Sequence[str]) -> DataFrame:
    """Replace values by their train rate, as float; unseen values get the overall mean, NULL stays NULL.

    A column without rates was left out of the fit, as it has few categories, and is returned as it is.
    The rates are written once and not aggregated again for each column. A rate table grows with the
    number of categories: up to ``MAX_BROADCAST_RATES`` rows it is broadcast, beyond that the rows go to
    it by value, with NULLs and the values that fill a thousandth of the rows kept out of the shuffle.
    """
    rates = materialize(rates, "target-rates")
    fitted = {r["column"]: r["n"] for r in rates.groupBy("column").agg(F.count("*").alias("n")).collect()}
    for c in [c for c in present(df, columns) if c in fitted]:
        table = rates.where(F.col("column") == c).select(F.col("value").alias("_key"), F.col("rate").alias("_rate"))
        keyed = df.withColumn("_key", quoted(c).cast("string"))
        if fitted[c] <= MAX_BROADCAST_RATES:
            joined = keyed.join(F.broadcast(table), "_key", "left")
        else:
            joined = _join_apart(keyed, table)
        code = F.when(F.col("_key").isNotNull(), F.coalesce("_rate", F.lit(overall))).cast("float")
        df = joined.select(*[code.alias(n) if n == c else quoted(n) for n in df.columns])
    return df


def _join_apart(keyed: DataFrame, table: DataFrame) -> DataFrame:
    """Left join on `_key` in which neither NULL nor a frequent value meets in one task."""
    counts = keyed.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    # At most a thousand values can fill a thousandth of the rows each.
    hot = materialize(counts.where(F.col("_n") * 1000 >= total).select("_key"), "hot-values")
    hot_table = F.broadcast(table.join(F.broadcast(hot), "_key", "left_semi"))
    marked = keyed.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), "_key", "left")
    apart = F.col("_key").isNull() | F.col("_hot").isNotNull()
    few = marked.where(apart).drop("_hot").join(hot_table, "_key", "left")
    rest = marked.where(~apart).drop("_hot").join(table, "_key", "left")
    return few.unionByName(rest)
