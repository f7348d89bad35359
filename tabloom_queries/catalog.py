"""Every registered query with its SQL twin, in the order of the operator inventory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.functions.lineage import new_path
from tabloom.functions.quantiles import exact_quantiles
from tabloom.operators import clean, encode, importance, information, profile, rowid, sampling, select, target, types, validate
from tabloom.operators.correlation import correlation_table, target_correlation
from tabloom.operators.features import add_features, add_formulas
from tabloom.operators.importance import permutation_importance, tree_importance
from tabloom.plans import loan as loans
from tabloom.plans.selection import fit_selector
from tabloom.sources import csv, fits, tables
from tabloom.streaming import profile as incremental
from tabloom_queries import stages
from tabloom_queries.stages import (
    FORMATTED_COLUMNS,
    FORMATTED_NUMBERS,
    FORMATTED_STRINGS,
    REFERENCE_DATE,
    WS,
    pct,
    percent_sql,
    rnd,
    strings,
    union,
    with_stage,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its name, with its SQL twin if there is one."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Float columns as double, rounded, so that both engines print the same digits."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            F.round(F.col(f"`{c}`").cast("double"), digits).alias(c) if kinds[c] in ("float", "double") else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) AS {name}"


LOAN_TYPES = {
    "id": "bigint", "loan_status": "string", "issue_d": "string", "earliest_cr_line": "string",
    "loan_amnt": "double", "annual_inc": "double", "int_rate": "string", "revol_util": "string", "dti": "double",
    "grade": "string", "term": "string", "emp_length": "string", "purpose": "string", "home_ownership": "string",
    "fico_range_low": "double", "fico_range_high": "double", "revol_bal": "double", "tot_hi_cred_lim": "double",
    "open_acc": "int", "total_acc": "int", "delinq_2yrs": "int", "inq_last_6mths": "int", "installment": "double",
    "mths_since_last_delinq": "double", "mths_since_recent_inq": "double", "policy_code": "double",
    "total_pymnt": "double",
}
LOAN_STRINGS = [c for c, t in LOAN_TYPES.items() if t == "string"]
LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
FORMATTED_TYPES = {
    c: "float" if c in ("int_rate", "revol_util") or c.startswith(("issue_d", "earliest")) else LOAN_TYPES.get(c, "tinyint")
    for c in FORMATTED_COLUMNS
}


# --- Sources and sinks -------------------------------------------------------


@query("SELECT * FROM documents")
def csv_round_trip(spark, sf):
    """Every column of the documents, text with its quotes and line breaks included."""
    path = new_path(spark, "documents-csv")
    source = stages.table(spark, sf, "documents")
    csv.write_csv_table(source, path)
    return csv.read_csv_table(spark, path, schema=source.schema, missing=())


@query("SELECT count(*) AS rows FROM documents")
def csv_count_rows(spark, sf):
    path = new_path(spark, "documents-csv")
    csv.write_csv_table(stages.table(spark, sf, "documents"), path)
    return spark.range(1).select(F.lit(csv.count_rows(spark, path)).alias("rows"))


_WORDED = "CASE WHEN s_suppkey % 7 = 0 THEN 'NA' WHEN s_suppkey % 7 = 1 THEN 'nan' WHEN s_suppkey % 7 = 2 THEN 'N/A' WHEN s_suppkey % 7 = 3 THEN NULL"


@query(
    f"""SELECT s_suppkey, {r("CASE WHEN s_suppkey % 7 > 3 THEN s_acctbal END", "s_acctbal")},
    CASE WHEN s_suppkey % 7 > 3 THEN s_nationkey END AS s_nationkey, CASE WHEN s_suppkey % 7 > 3 THEN s_name END AS s_name FROM supplier"""
)
def csv_missing_words(spark, sf):
    """Words for a missing value: NULL in number and text columns alike, which keep their types."""
    path = new_path(spark, "supplier-csv")
    worded = {c: F.expr(f"{_WORDED} ELSE CAST({c} AS STRING) END") for c in ("s_acctbal", "s_nationkey", "s_name")}
    csv.write_csv_table(stages.table(spark, sf, "supplier").withColumns(worded), path)
    read = csv.read_csv_table(spark, path)
    assert dict(read.dtypes)["s_acctbal"] == "double" and dict(read.dtypes)["s_nationkey"] == "bigint", read.dtypes
    return rounded(read.select("s_suppkey", "s_acctbal", "s_nationkey", "s_name"))


@query("SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) t WHERE n <= 100")
def csv_row_limit(spark, sf):
    """The first rows of a file, with types from those rows and not from the text that comes later."""
    path = new_path(spark, "orders-csv")
    orders = stages.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    late = F.when(F.col("o_orderkey") > 1000, F.lit("x")).otherwise(F.col("o_custkey").cast("string"))
    csv.write_csv_table(orders.withColumn("o_custkey", late).orderBy("o_orderkey").coalesce(1), path)
    read = csv.read_csv_table(spark, path, rows=100)
    assert dict(read.dtypes)["o_custkey"] == "bigint", read.dtypes
    return read


@query("SELECT CAST(c_custkey AS INT) AS c_custkey, round(CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE), 2) AS c_acctbal, c_mktsegment FROM customer")
def load_table_narrowed(spark, sf):
    path = new_path(spark, "customer-csv")
    csv.write_csv_table(stages.table(spark, sf, "customer"), path)
    loaded = csv.load_table(spark, path, drop=["c_name", "c_nationkey", "not_there"])
    return rounded(loaded.withColumn("c_custkey", F.col("c_custkey").cast("int")), 2)


@query("SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 6) AS s_acctbal FROM supplier")
def csv_dialect(spark, sf):
    path = new_path(spark, "supplier-csv")
    source = stages.table(spark, sf, "supplier")
    comma = source.withColumn("s_acctbal", F.translate(F.col("s_acctbal").cast("decimal(18,2)").cast("string"), ".", ","))
    comma.write.option("header", True).option("sep", ";").csv(path)
    return rounded(
        csv.read_csv_table(
            spark, path, sep=";", decimal=",", schema="s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
        )
    )


@query("SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events")
def parquet_round_trip(spark, sf):
    path = new_path(spark, "events-parquet")
    source = stages.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    tables.write_parquet_table(source, path, partition_by=["event_type"])
    return rounded(tables.read_parquet_table(spark, path, ["event_id", "user_id", "event_type", "value"]))


def _hash_sql(*keys: str) -> str:
    """The hash by which rows are drawn, in SQL."""
    return "md5('42|' || " + " || ".join(f"coalesce(strlen(CAST({k} AS VARCHAR)) || ':' || {k}, '-')" for k in keys) + ")"


@query(f"SELECT o_orderkey, o_custkey FROM orders ORDER BY {_hash_sql('o_orderkey')} LIMIT 5000")
def sample_rows(spark, sf):
    """The rows themselves, the same in any order and partitioning of the table."""
    orders = stages.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return csv.sample_rows(orders.repartition(7), 5000, keys=["o_orderkey"])


@query(
    f"""SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_hash_sql("o_orderkey")}) AS n
    FROM orders) t WHERE n <= CASE o_orderpriority WHEN '1-URGENT' THEN 100 WHEN '3-MEDIUM' THEN 250 WHEN '5-LOW' THEN 1000000000 ELSE 0 END"""
)
def stratified_sample(spark, sf):
    """Quotas by class; one asks for more than there is."""
    orders = stages.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    quotas = {"1-URGENT": 100, "3-MEDIUM": 250, "5-LOW": 1_000_000_000, "absent": 5}
    return sampling.sample_by_class(orders, quotas, by="o_orderpriority", keys=["o_orderkey"])


@query(
    with_stage("train", union(f"SELECT '{c}' AS \"column\", {r(f'CASE WHEN min({c}) < 0 THEN -min({c}) + CAST(1e-9 AS DOUBLE) ELSE 0 END', 'shift', 9)} FROM train"
                               for c in loans.LOG_COLUMNS))
)
def stored_fit(spark, sf):
    path = new_path(spark, "log-shift")
    fits.save_fit(spark, clean.fit_log_shift(stages.train(spark, sf), loans.LOG_COLUMNS), path)
    shifts = fits.load_shift_map(spark, path)
    return rounded(spark.createDataFrame(list(shifts.items()), "column string, shift double"), 9)


# --- Projections and column operators ----------------------------------------


@query("SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS row_id, * FROM lineitem")
def row_id(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return rowid.add_row_id(stages.table(spark, sf, "lineitem"), keys)


def _key_sql(table: str, key: str) -> str:
    return (
        f"SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(coalesce(sum(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_ids, "
        f"CAST(sum(n - 1) AS BIGINT) AS duplicate_ids FROM (SELECT {key} AS k, count(*) AS n FROM {table} GROUP BY 1) t"
    )


@query(_key_sql("lineitem", "NULLIF(l_orderkey, 7)"))
def primary_key_check(spark, sf):
    lines = stages.table(spark, sf, "lineitem").select(F.nullif("l_orderkey", F.lit(7)).alias("id"))
    return clean.primary_key_check(clean.set_primary_key(lines, "id"), "pk")


_LEAKING = ["loan_status", "total_pymnt", "policy_code"]
_KEPT = [c for c in LOAN_TYPES if c not in _LEAKING]


@query(with_stage("labelled", f"SELECT {', '.join(r(c, c) if LOAN_TYPES[c] == 'double' else c for c in _KEPT)}, target FROM labelled"))
def drop_leakage(spark, sf):
    return rounded(
        clean.drop_leakage(
            stages.labelled(spark, sf), loans.LEAKAGE_COLUMNS, rules={"drop": {"constant": ["policy_code", "not_there"]}}
        )
    )


def _type_sql(source: str, columns: dict[str, str]) -> str:
    parts = []
    for c, t in columns.items():
        if t in ("int", "bigint"):
            s = f"CASE WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint' WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END"
        elif t == "double":
            s = "'float'"
        elif t == "string":
            s = f"CASE WHEN CAST(count(DISTINCT {c}) AS DOUBLE) / count(*) < 0.5 THEN 'category' ELSE 'string' END"
        else:
            s = f"'{t}'"
        parts.append(f"SELECT '{c}' AS \"column\", '{t}' AS current_type, {s} AS suggested_type FROM {source} HAVING count(*) >= 0")
    return union(parts)


@query(with_stage("loan", _type_sql("loan", LOAN_TYPES)))
def type_recommendations(spark, sf):
    return types.recommend_types(stages.loan(spark, sf))


@query(_type_sql("lineitem", LINEITEM_TYPES))
def type_recommendations_lineitem(spark, sf):
    return types.recommend_types(stages.table(spark, sf, "lineitem"))


@query(
    with_stage(
        "loan",
        "SELECT id, CAST(open_acc AS SMALLINT) AS open_acc, CAST(total_acc AS SMALLINT) AS total_acc, "
        + f"{r('CAST(loan_amnt AS FLOAT)', 'loan_amnt', 3)}, {r('CAST(dti AS FLOAT)', 'dti', 3)}, grade FROM loan",
    )
)
def optimize_types(spark, sf):
    narrow = types.optimize_types(stages.loan(spark, sf).select("id", "open_acc", "total_acc", "loan_amnt", "dti", "grade"))
    return rounded(narrow.withColumn("id", F.col("id").cast("bigint")), 3)


@query(
    with_stage(
        "loan",
        union(
            f"SELECT '{c}' AS \"column\", '{LOAN_TYPES[c]}' AS type, count(DISTINCT {c}) AS distinct_values, "
            f"{rnd(pct(f'count(*) - count({c})', 'count(*)'), 2)} AS missing_pct FROM loan"
            for c in LOAN_TYPES
        ),
    )
)
def type_report(spark, sf):
    return types.type_report(stages.loan(spark, sf)).drop("example")


@query(
    union(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count(DISTINCT {c}) AS distinct_values, "
        f"{rnd(pct(f'count(*) - count({c})', 'count(*)'), 2)} AS missing_pct, CAST(min({c}) AS VARCHAR) AS example FROM documents"
        for c, t in {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}.items()
    )
)
def type_report_documents(spark, sf):
    return types.type_report(stages.table(spark, sf, "documents"))


@query(with_stage("labelled", f"SELECT id, trim(term, {WS}) AS term FROM labelled"))
def trim_category(spark, sf):
    return clean.trim_categories(stages.labelled(spark, sf).select("id", "term"), ["term"])


ALIGNED = ["grade", "id", "not_in_table", "dti"]


@query(with_stage("formatted", f"SELECT grade, id, CAST(0 AS INT) AS not_in_table, {r('dti', 'dti')} FROM formatted"))
def align_columns(spark, sf):
    return rounded(encode.align_columns(stages.formatted(spark, sf), ALIGNED))


# --- Filters and checks ------------------------------------------------------


@query(with_stage("labelled", "SELECT id, loan_status, CAST(target AS INT) AS target FROM labelled"))
def binary_target(spark, sf):
    return stages.labelled(spark, sf).select("id", "loan_status", F.col("target").cast("int").alias("target"))


@query(
    with_stage(
        "loan",
        f"""SELECT loan_status AS value, CASE WHEN loan_status IN ({strings(loans.IGNORED_STATUSES)}) THEN 'ignored'
        WHEN loan_status IN ({strings(loans.POSITIVE_STATUSES)}) THEN 'positive'
        WHEN loan_status IN ({strings(loans.NEGATIVE_STATUSES)}) THEN 'negative' ELSE 'unexpected' END AS role,
        count(*) AS count FROM loan GROUP BY 1, 2""",
    )
)
def target_values(spark, sf):
    return target.target_values(
        stages.loan(spark, sf), "loan_status", loans.POSITIVE_STATUSES, loans.NEGATIVE_STATUSES, loans.IGNORED_STATUSES
    )


@query(with_stage("splits", "SELECT id, split FROM splits"))
def split_by_year(spark, sf):
    return stages.splits(spark, sf).select("id", "split")


@query(
    with_stage(
        "splits",
        f"SELECT split, count(*) AS rows, {r('avg(CAST(target AS DOUBLE)) * 100', 'positive_rate_pct')} FROM splits WHERE split IS NOT NULL GROUP BY 1",
    )
)
def split_report(spark, sf):
    return rounded(target.split_report(stages.splits(spark, sf)))


@query(with_stage("splits", "SELECT CAST(issue_d_year AS DOUBLE) AS value, count(*) AS count FROM splits GROUP BY 1"))
def year_counts(spark, sf):
    counts = profile.value_counts(stages.splits(spark, sf), "issue_d_year", by_key=True)
    return counts.withColumn("value", F.col("value").cast("double"))


INFINITE_SQL = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS x FROM orders"


def _with_infinities(spark, sf):
    orders = stages.table(spark, sf, "orders")
    third = F.col("o_orderkey") % 3
    big = F.when(third == 0, F.when(F.col("o_orderkey") % 2 == 0, float("inf")).otherwise(float("-inf")))
    return orders.select("o_orderkey", F.coalesce(big, "o_totalprice").alias("x"))


@query(f"SELECT o_orderkey, round(x, 6) AS x FROM ({INFINITE_SQL}) t")
def replace_infinite(spark, sf):
    return rounded(clean.replace_infinite(_with_infinities(spark, sf)))


@query(
    "SELECT 'o_orderkey' AS \"column\", false AS is_string, CAST(0 AS BIGINT) AS nulls, CAST(0 AS BIGINT) AS infinities, CAST(NULL AS BIGINT) AS distinct_values"
    " UNION ALL SELECT 'x', false, 0, count(*) FILTER (WHERE o_orderkey % 3 = 0), NULL FROM orders"
)
def quality_report_infinite(spark, sf):
    return validate.quality_report(_with_infinities(spark, sf))


@query(
    with_stage(
        "formatted",
        union(
            f"SELECT '{c}' AS \"column\", {str(c in FORMATTED_STRINGS).lower()} AS is_string, count(*) - count({c}) AS nulls, "
            f"CAST(0 AS BIGINT) AS infinities, {f'count(DISTINCT {c})' if c in FORMATTED_STRINGS else 'CAST(NULL AS BIGINT)'} AS distinct_values FROM formatted"
            for c in FORMATTED_COLUMNS
        ),
    )
)
def quality_report(spark, sf):
    return validate.quality_report(stages.formatted(spark, sf))


def _clamp_sql(c: str, expr: str | None = None) -> str:
    low, high = loans.DOMAIN_RULES[c]
    e = expr or c
    parts = [f"WHEN {e} < {low} THEN {low}"] if low is not None else []
    parts += [f"WHEN {e} > {high} THEN {high}"] if high is not None else []
    return f"CASE {' '.join(parts)} ELSE {e} END"


@query(with_stage("formatted", "SELECT id, " + ", ".join(r(_clamp_sql(c), c) for c in loans.DOMAIN_RULES) + " FROM formatted"))
def domain_clamp(spark, sf):
    return rounded(clean.clamp_domain(stages.formatted(spark, sf).select("id", *loans.DOMAIN_RULES), loans.DOMAIN_RULES))


# --- Aggregations and profiles -----------------------------------------------


def _raw_sql(source: str, columns) -> str:
    return union(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, CAST({len(columns)} AS INT) AS columns, count(*) - count({c}) AS missing, "
        f"{r(f'CAST(count(*) - count({c}) AS DOUBLE) / count(*)', 'missing_ratio')} FROM {source}"
        for c in columns
    )


@query(with_stage("loan", _raw_sql("loan", LOAN_TYPES)))
def raw_profile(spark, sf):
    return rounded(profile.raw_profile(stages.loan_view(spark, sf)))


@query(with_stage("loan", _raw_sql("loan", LOAN_TYPES)))
def raw_profile_incremental(spark, sf):
    """Files arrive three times; each fold starts anew from the stored state and reads only the new ones."""
    source, state = new_path(spark, "arrivals"), new_path(spark, "folded")
    rows = stages.loan_view(spark, sf)
    for arrival in range(3):
        rows.where(F.col("id") % 3 == arrival).write.mode("append").parquet(source)
        incremental.fold_arrivals(spark, source, rows.schema, state)
    return rounded(incremental.stored_profile(spark, rows.schema, state))


@query(_raw_sql("lineitem", LINEITEM_TYPES))
def raw_profile_lineitem(spark, sf):
    return rounded(profile.raw_profile(stages.table(spark, sf, "lineitem")))


def _missing_sql() -> str:
    share = "missing_pct"
    inner = union(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) - count({c}) AS missing, "
        f"{rnd(pct(f'count(*) - count({c})', 'count(*)'), 2)} AS missing_pct FROM loan"
        for c, t in LOAN_TYPES.items()
    )
    return f"""SELECT *, CASE WHEN {share} > 60 THEN 'DROP' WHEN {share} > 20 THEN 'FLAG+MEDIAN' WHEN {share} > 0 THEN 'MEDIAN/MODE'
        ELSE 'COMPLETE' END AS strategy FROM ({inner}) t WHERE missing > 0"""


@query(with_stage("loan", _missing_sql()))
def missing_profile(spark, sf):
    return profile.missing_profile(stages.loan_view(spark, sf))


@query(with_stage("loan", f"SELECT * FROM ({_missing_sql()}) m ORDER BY missing_pct DESC, \"column\" LIMIT 3"))
def top_missing(spark, sf):
    return profile.top_missing(stages.loan_view(spark, sf), 3)


def _numeric_sql(source: str, columns: dict[str, str]) -> str:
    parts = []
    for c, t in columns.items():
        v = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", '{t}' AS type, {rnd(pct(f'count(*) - count({c})', 'count(*)'), 2)} AS missing_pct, "
            f"{rnd(f'avg({v})', 4)} AS mean, {rnd('any_value(q2)', 4)} AS median, {rnd(f'stddev_samp({v})', 4)} AS std, "
            f"{rnd(f'min({v})', 4)} AS min, {rnd(f'max({v})', 4)} AS max, {rnd('any_value(q1)', 4)} AS q1, {rnd('any_value(q3)', 4)} AS q3, "
            f"CASE WHEN count({c}) >= 3 THEN coalesce(CASE WHEN stddev_samp({v}) > 0 THEN skewness({v}) END, 0) END AS sk, "
            f"{rnd(pct(f'count(*) FILTER (WHERE {v} < q1 - 1.5 * (q3 - q1) OR {v} > q3 + 1.5 * (q3 - q1))', f'count({c})'), 2)} AS outlier_pct "
            f"FROM {source}, (SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS q2, quantile_cont({v}, 0.75) AS q3 FROM {source}) q "
        )
    return (
        "SELECT * EXCLUDE (sk), CASE WHEN abs(sk) < 0.5 THEN 'symmetric' WHEN abs(sk) < 1 THEN 'moderate' ELSE 'high' END AS skew_label, "
        f"{rnd('sk', 3)} AS skewness FROM ({union(parts)}) t"
    )


@query(with_stage("formatted", _numeric_sql("formatted", {c: FORMATTED_TYPES[c] for c in FORMATTED_NUMBERS})))
def numeric_profile(spark, sf):
    return profile.numeric_profile(stages.formatted(spark, sf))


LINE_NUMBERS = {c: t for c, t in LINEITEM_TYPES.items() if c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")}


@query(_numeric_sql("lineitem", LINE_NUMBERS))
def numeric_profile_lineitem(spark, sf):
    return profile.numeric_profile(stages.table(spark, sf, "lineitem").select(*LINE_NUMBERS))


def _categorical_sql(source: str, columns) -> str:
    parts = []
    for c in columns:
        parts.append(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE v IS NOT NULL) AS distinct_values, "
            f"{rnd(pct('coalesce(sum(n) FILTER (WHERE v IS NULL), 0)', 'sum(n)'), 2)} AS missing_pct, "
            f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1) AS top_value, "
            f"{rnd(pct('max(n) FILTER (WHERE v IS NOT NULL)', 'sum(n) FILTER (WHERE v IS NOT NULL)'), 1)} AS top_share_pct "
            f"FROM (SELECT {c} AS v, count(*) AS n FROM {source} GROUP BY 1) g"
        )
    return f"""SELECT *, CASE WHEN distinct_values <= 5 THEN 'low' WHEN distinct_values <= 50 THEN 'medium' ELSE 'high' END AS cardinality
        FROM ({union(parts)}) t"""


@query(with_stage("labelled", _categorical_sql("labelled", LOAN_STRINGS)))
def categorical_profile(spark, sf):
    return profile.categorical_profile(stages.labelled(spark, sf))


@query(_categorical_sql("documents", ["text", "lang", "source"]))
def categorical_profile_documents(spark, sf):
    return profile.categorical_profile(stages.table(spark, sf, "documents"))


def _rate_sql(c: str, tail: str = "") -> str:
    return with_stage(
        "labelled",
        f"SELECT {c} AS value, count(target) AS count, {r('avg(CAST(target AS DOUBLE)) * 100', 'rate_pct')} FROM labelled WHERE {c} IS NOT NULL GROUP BY 1 {tail}",
    )


@query(_rate_sql("grade"))
def target_rate_by_category(spark, sf):
    return rounded(profile.target_rate_by_category(stages.labelled(spark, sf), "grade"))


@query(_rate_sql("purpose"))
def target_rate_ascending(spark, sf):
    return rounded(profile.target_rate_by_category(stages.labelled(spark, sf), "purpose", order="rate"))


@query(_rate_sql("issue_d", "ORDER BY avg(CAST(target AS DOUBLE)) DESC, issue_d LIMIT 15"))
def target_rate_top(spark, sf):
    return rounded(profile.target_rate_by_category(stages.labelled(spark, sf), "issue_d", order="rate_desc", top=15))


@query(with_stage("labelled", "SELECT emp_length AS value, count(*) AS count FROM labelled WHERE emp_length IS NOT NULL GROUP BY 1"))
def value_counts(spark, sf):
    return profile.value_counts(stages.labelled(spark, sf), "emp_length")


@query(
    with_stage(
        "labelled",
        f"""SELECT true AS passed, positive, negative, {rnd('rate', 2)} AS positive_rate_pct,
        CASE WHEN rate < 5 THEN 'severe' WHEN rate < 30 THEN 'imbalanced' ELSE 'balanced' END AS balance
        FROM (SELECT count(*) FILTER (WHERE target = 1) AS positive, count(*) FILTER (WHERE target = 0) AS negative,
        {pct('count(*) FILTER (WHERE target = 1)', 'count(*)')} AS rate FROM labelled) t""",
    )
)
def target_distribution(spark, sf):
    return target.target_summary(
        stages.loan_view(spark, sf), "loan_status", loans.POSITIVE_STATUSES, loans.NEGATIVE_STATUSES, loans.IGNORED_STATUSES
    )


def _duplicates_sql(source: str, keys: str) -> str:
    return f"SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys}) t"


@query(_duplicates_sql("documents", "text"))
def duplicate_count(spark, sf):
    return profile.duplicate_count(stages.table(spark, sf, "documents"), ["text"])


@query(f"SELECT rows, duplicates, {r('CAST(duplicates AS DOUBLE) / rows', 'ratio')}, CAST(duplicates AS DOUBLE) / rows <= 0.01 AS passed FROM ({_duplicates_sql('documents', 'text')}) d")
def duplicate_gate(spark, sf):
    return rounded(profile.duplicate_gate(stages.table(spark, sf, "documents"), ["text"]))


@query(with_stage("loan", "SELECT CAST(" + " + ".join(f"count(*) - count({c})" for c in LOAN_TYPES) + " AS BIGINT) AS missing_cells FROM loan"))
def null_total(spark, sf):
    return profile.null_total(stages.loan_view(spark, sf))


@query(
    with_stage(
        "formatted",
        union(
            f"SELECT '{c}' AS \"column\", {r(f'min({c})', 'min_before', 3)}, {r(f'max({c})', 'max_before', 3)}, "
            f"{r(f'min({_clamp_sql(c)})', 'min_after', 3)}, {r(f'max({_clamp_sql(c)})', 'max_after', 3)} FROM formatted"
            for c in loans.DOMAIN_RULES
        ),
    )
)
def range_report(spark, sf):
    before = stages.formatted(spark, sf)
    return rounded(profile.range_report(before, clean.clamp_domain(before, loans.DOMAIN_RULES), list(loans.DOMAIN_RULES)), 3)


# --- Cleaning: fit on the train slice, apply to every row --------------------

FILL_NUMBERS = ["annual_inc", "revol_util", "mths_since_recent_inq", "mths_since_last_delinq"]
FILL_TEXT = ["emp_length", "home_ownership"]


def _median_sql(c: str, source: str = "train") -> str:
    return f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM {source})"


def _mode_sql(c: str, source: str = "train") -> str:
    return f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    with_stage(
        "train",
        union(
            [f"SELECT '{c}' AS \"column\", {r(_median_sql(c), 'number')}, CAST(NULL AS VARCHAR) AS text" for c in FILL_NUMBERS]
            + [f"SELECT '{c}' AS \"column\", CAST(NULL AS DOUBLE) AS number, {_mode_sql(c)} AS text" for c in FILL_TEXT]
        ),
    )
)
def fill_values(spark, sf):
    fills = clean.fit_fill_values(stages.train(spark, sf), [*FILL_NUMBERS, *FILL_TEXT])
    rows = [(c, None, v) if isinstance(v, str) else (c, v, None) for c, v in fills.items()]
    return rounded(spark.createDataFrame(rows, "column string, number double, text string"))


@query(
    with_stage(
        "train",
        "SELECT id, CAST(mths_since_recent_inq IS NULL AS INT) AS \"mths_since_recent_inq_MISSING\", "
        + ", ".join(r(f"coalesce({c}, CAST({_median_sql(c)} AS {'FLOAT' if c == 'revol_util' else 'DOUBLE'}))", c) for c in FILL_NUMBERS[:3])
        + ", "
        + ", ".join(f"coalesce({c}, {_mode_sql(c)}) AS {c}" for c in FILL_TEXT)
        + " FROM formatted",
    )
)
def fill_missing(spark, sf):
    fills = clean.fit_fill_values(stages.train(spark, sf), [*FILL_NUMBERS, *FILL_TEXT])
    columns = ["id", *FILL_NUMBERS, *FILL_TEXT]
    filled = clean.fill_missing(
        stages.formatted(spark, sf).select(*columns),
        fills,
        drop=["mths_since_last_delinq"],
        flag=["mths_since_recent_inq"],
        fill=["annual_inc", "revol_util", *FILL_TEXT],
    )
    flag = "mths_since_recent_inq_MISSING"
    return rounded(filled.withColumn(flag, F.col(flag).cast("int")))


GAPPY = ["annual_inc", "revol_util", "mths_since_last_delinq", "mths_since_recent_inq", "earliest_cr_line_year"]


@query(
    with_stage(
        "train",
        "SELECT id, " + ", ".join(r(f"coalesce(CAST({c} AS DOUBLE), CAST({_median_sql(c)} AS {'FLOAT' if FORMATTED_TYPES[c] == 'float' else 'DOUBLE'}))", c) for c in GAPPY) + " FROM formatted",
    )
)
def fill_numeric_median(spark, sf):
    medians = clean.fit_numeric_medians(stages.train(spark, sf).select(*GAPPY, "dti"))
    return rounded(clean.fill_numeric_median(stages.formatted(spark, sf).select("id", *GAPPY), medians))


CLIPPED = ["annual_inc", "dti", "loan_amnt", "revol_bal"]


def _bounds_sql(c: str) -> tuple[str, str]:
    low, high = loans.DOMAIN_RULES.get(c, (None, None))
    lo = f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.01) FROM train)"
    hi = f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.99) FROM train)"
    return (
        f"greatest({lo}, CAST({low} AS DOUBLE))" if low is not None else lo,
        f"least({hi}, CAST({high} AS DOUBLE))" if high is not None else hi,
    )


@query(with_stage("train", union(f"SELECT '{c}' AS \"column\", {r(_bounds_sql(c)[0], 'low')}, {r(_bounds_sql(c)[1], 'high')}" for c in CLIPPED)))
def clip_bounds(spark, sf):
    bounds = clean.fit_clip_bounds(stages.train(spark, sf), CLIPPED, rules=loans.DOMAIN_RULES)
    return rounded(
        spark.createDataFrame([(c, b["low"], b["high"]) for c, b in bounds.items()], "column string, low double, high double")
    )


@query(
    with_stage(
        "train",
        "SELECT id, "
        + ", ".join(
            r(f"CAST(CASE WHEN {c} < {_bounds_sql(c)[0]} THEN {_bounds_sql(c)[0]} WHEN {c} > {_bounds_sql(c)[1]} THEN {_bounds_sql(c)[1]} ELSE {c} END AS FLOAT)", c, 2)
            for c in CLIPPED
        )
        + " FROM formatted",
    )
)
def clip_outliers(spark, sf):
    bounds = clean.fit_clip_bounds(stages.train(spark, sf), CLIPPED, rules=loans.DOMAIN_RULES)
    return rounded(clean.clip_outliers(stages.formatted(spark, sf).select("id", *CLIPPED), bounds), 2)


def _fence_sql(c: str) -> str:
    return (
        f"SELECT '{c}' AS \"column\", {r('q1 - 1.5 * (q3 - q1)', 'low')}, {r('q3 + 1.5 * (q3 - q1)', 'high')} FROM "
        f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM train) q"
    )


@query(with_stage("train", union(_fence_sql(c) for c in CLIPPED)))
def iqr_bounds(spark, sf):
    bounds = clean.fit_iqr_bounds(stages.train(spark, sf), CLIPPED)
    return rounded(
        spark.createDataFrame([(c, b["low"], b["high"]) for c, b in bounds.items()], "column string, low double, high double")
    )


SHIFT_SQL = "(SELECT CASE WHEN min({c}) < 0 THEN -min({c}) + CAST(1e-9 AS DOUBLE) ELSE 0 END FROM train)"


@query(with_stage("train", union(f"SELECT '{c}' AS \"column\", {r(SHIFT_SQL.format(c=c), 'shift')}" for c in loans.LOG_COLUMNS)))
def log_shift(spark, sf):
    shifts = clean.fit_log_shift(stages.train(spark, sf), loans.LOG_COLUMNS)
    return rounded(spark.createDataFrame(list(shifts.items()), "column string, shift double"))


@query(
    with_stage(
        "train",
        "SELECT id, "
        + ", ".join(
            f"round(CAST(CAST(CASE WHEN {c} + {SHIFT_SQL.format(c=c)} > -1 THEN ln(1 + ({c} + {SHIFT_SQL.format(c=c)})) END AS FLOAT) AS DOUBLE), 4) AS \"{c}_LOG\""
            for c in loans.LOG_COLUMNS
        )
        + " FROM formatted",
    )
)
def log1p_columns(spark, sf):
    shifts = clean.fit_log_shift(stages.train(spark, sf), loans.LOG_COLUMNS)
    logged = clean.log1p_columns(stages.formatted(spark, sf), shifts)
    return rounded(logged.select("id", *[f"{c}_LOG" for c in loans.LOG_COLUMNS]), 4)


@query(
    with_stage(
        "formatted",
        "SELECT id, CASE WHEN dti < 0 THEN NULL WHEN dti <= 10 THEN 'low' WHEN dti <= 20 THEN 'middle' WHEN dti <= 100 THEN 'high' END AS dti_band FROM formatted",
    )
)
def cut_bins(spark, sf):
    return clean.cut_bins(
        stages.formatted(spark, sf).select("id", "dti"), "dti", "dti_band", [0, 10, 20, 100], ["low", "middle", "high"]
    ).drop("dti")


DATE_PARTS = [c for c in FORMATTED_COLUMNS if c.startswith(("issue_d_", "earliest_"))]


@query(with_stage("formatted", "SELECT id, " + ", ".join(r(c, c) for c in DATE_PARTS) + " FROM formatted"))
def parse_dates(spark, sf):
    raw = stages.labelled(spark, sf).select("id", *loans.DATE_COLUMNS)
    return rounded(clean.parse_dates(raw, loans.DATE_COLUMNS, reference=stages.REFERENCE_DATE, format=loans.DATE_FORMAT))


@query(
    "SELECT event_id, CAST(year(ts) AS DOUBLE) AS ts_year, CAST(month(ts) AS DOUBLE) AS ts_month, "
    "round(CAST(CAST(floor((epoch_us(TIMESTAMP '2001-12-01 00:00:00') - epoch_us(ts)) / CAST(86400000000 AS DOUBLE)) / CAST(30 AS DOUBLE) AS FLOAT) AS DOUBLE), 4) AS ts_months_since FROM events"
)
def parse_dates_events(spark, sf):
    events = stages.table(spark, sf, "events").select("event_id", "ts")
    return rounded(clean.parse_dates(events, ["ts"], reference="2001-12-01"), 4)


# The date of an order in six ways of writing; every 17th value is no date, every 23rd missing.
WRITTEN = {
    "month": ("MMM-yyyy", "trunc(o_orderdate, 'MM')", "date_trunc('month', o_orderdate)"),
    "american": ("M/d/yyyy", "o_orderdate", "o_orderdate"),
    "european": ("d/M/yyyy", "o_orderdate", "o_orderdate"),
    "long": ("d MMMM yyyy", "o_orderdate", "o_orderdate"),
    "compact": ("yyyyMMdd", "o_orderdate", "o_orderdate"),
    "dotted": ("dd.MM.yyyy", "o_orderdate", "o_orderdate"),
}


def _written_sql(name: str, day: str) -> list[str]:
    known = f"CASE WHEN o_orderkey % 23 <> 0 AND o_orderkey % 17 <> 0 THEN CAST({day} AS TIMESTAMP) END"
    gap = f"floor((epoch_us(TIMESTAMP '{REFERENCE_DATE} 00:00:00') - epoch_us({known})) / CAST(86400000000 AS DOUBLE))"
    return [
        r(f"year({known})", f"{name}_year"),
        r(f"month({known})", f"{name}_month"),
        r(f"CAST({gap} / CAST(30 AS DOUBLE) AS FLOAT)", f"{name}_months_since", 4),
    ]


@query(
    "SELECT o_orderkey, " + ", ".join(x for n, (_, _, day) in WRITTEN.items() for x in _written_sql(n, day)) + " FROM orders"
)
def parse_dates_inferred(spark, sf):
    """No format is given: the values of each column vote."""
    orders = stages.table(spark, sf, "orders")
    texts = [
        F.expr(
            f"CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'unknown {p}' "
            f"ELSE concat(' ', date_format({day}, '{p}')) END"
        ).alias(n)
        for n, (p, day, _) in WRITTEN.items()
    ]
    return rounded(clean.infer_dates(orders.select("o_orderkey", *texts), list(WRITTEN), reference=REFERENCE_DATE), 4)


@query(with_stage("labelled", "SELECT id, " + ", ".join(r(percent_sql(c), c) for c in loans.PERCENT_COLUMNS) + " FROM labelled"))
def parse_percentages(spark, sf):
    raw = stages.labelled(spark, sf).select("id", *loans.PERCENT_COLUMNS)
    return rounded(clean.parse_percentages(raw, loans.PERCENT_COLUMNS))


@query("SELECT doc_id, lower(trim(lang, " + WS + ")) AS lang, lower(trim(source, " + WS + ")) AS source, lower(trim(text, " + WS + ")) AS text FROM documents")
def normalize_strings(spark, sf):
    documents = stages.table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    return clean.normalize_strings(documents)


@query("SELECT min(doc_id) AS doc_id, count(DISTINCT text) AS texts FROM documents GROUP BY text")
def deduplicate_first(spark, sf):
    kept = clean.deduplicate(stages.table(spark, sf, "documents").select("doc_id", "text"), ["text"], order_by=["doc_id"])
    return kept.select("doc_id", F.lit(1).cast("bigint").alias("texts"))


@query(
    "SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) t WHERE n = 1"
)
def deduplicate_last(spark, sf):
    orders = stages.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return clean.deduplicate(orders, ["o_custkey"], keep="last", order_by=["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("SELECT doc_id FROM (SELECT doc_id, count(*) OVER (PARTITION BY text) AS n FROM documents) t WHERE n = 1")
def deduplicate_none(spark, sf):
    documents = stages.table(spark, sf, "documents").select("doc_id", "text")
    return clean.deduplicate(documents, ["text"], keep=False).select("doc_id")


@query("SELECT DISTINCT text, lang, source, n_chars FROM documents")
def deduplicate_rows(spark, sf):
    return clean.deduplicate(stages.table(spark, sf, "documents").drop("doc_id"))


_CORNERED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_TENTHS = [0.01, 0.1, 0.25, 0.5, 0.9, 0.999]


@query(
    union(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS point, {r(f'quantile_cont(CAST({c} AS DOUBLE), {p})', 'quantile')} FROM lineitem"
        for c in _CORNERED
        for p in _TENTHS
    )
)
def quantiles_narrowed(spark, sf):
    """Limits so small that every quantile is found by narrowing intervals, in several rounds."""
    found = exact_quantiles(stages.table(spark, sf, "lineitem"), _CORNERED, _TENTHS, max_inside=50, accuracy=64)
    rows = [(c, p, q) for c, values in found.items() for p, q in zip(_TENTHS, values)]
    return rounded(spark.createDataFrame(rows, "column string, point double, quantile double"))


# --- Encoding ----------------------------------------------------------------

ORDINAL = loans.ENCODING_RULES["ordinal"]
# The view's purposes are market segments; two of them stay outside the groups.
PURPOSE_GROUPS = {"business": ["machinery", "building"], "home": ["household", "furniture"]}
RULES = {
    "ordinal": ORDINAL,
    "one_hot": ["home_ownership", "verification_status"],
    "group_one_hot": {"purpose": PURPOSE_GROUPS},
}


def _ordinal_sql(c: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in ORDINAL[c].items())
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE CASE trim({c}, {WS}) {cases} ELSE -1 END END"


@query(with_stage("labelled", "SELECT id, " + ", ".join(r(_ordinal_sql(c), c) for c in ("grade", "term", "emp_length")) + " FROM labelled"))
def ordinal_encode(spark, sf):
    df = stages.labelled(spark, sf).select("id", "grade", "term", "emp_length")
    for c in ("grade", "term", "emp_length"):
        df = encode.ordinal_encode(df, c, ORDINAL[c])
    return rounded(df)


def _group_sql(c: str = "purpose") -> str:
    cases = " ".join(f"WHEN {c} IN ({strings(v)}) THEN '{g}'" for g, v in PURPOSE_GROUPS.items())
    return f"CASE WHEN {c} IS NULL THEN NULL {cases} ELSE 'other' END"


@query(
    with_stage(
        "labelled",
        f"SELECT 'emp_length' AS \"column\", count(*) FILTER (WHERE {_ordinal_sql('emp_length')} = -1) AS unseen FROM labelled UNION ALL "
        f"SELECT 'grade', count(*) FILTER (WHERE {_ordinal_sql('grade')} = -1) FROM labelled UNION ALL "
        f"SELECT 'term', count(*) FILTER (WHERE {_ordinal_sql('term')} = -1) FROM labelled UNION ALL "
        f"SELECT 'purpose', count(*) FILTER (WHERE {_group_sql()} = 'other') FROM labelled",
    )
)
def unseen_counts(spark, sf):
    return encode.unseen_counts(stages.labelled(spark, sf), RULES)


def _flag(test: str, name: str) -> str:
    return f'CAST(coalesce({test}, false) AS INT) AS "{name}"'


HOMES = ["MORTGAGE", "OWN", "RENT"]
HOME_SQL = ", ".join([_flag(f"home_ownership = '{v}'", f"home_ownership_{v}") for v in HOMES] + [_flag("home_ownership IS NULL", "home_ownership_nan")])
PURPOSE_SQL = ", ".join([_flag(f"({_group_sql()}) = '{g}'", f"purpose_{g}") for g in ("business", "home", "other")] + [_flag("purpose IS NULL", "purpose_nan")])


def _ints(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("int").alias(c) if t == "tinyint" else F.col(f"`{c}`") for c, t in df.dtypes])


@query(with_stage("train", f"SELECT id, {HOME_SQL} FROM formatted"))
def one_hot(spark, sf):
    vocabulary = encode.fit_one_hot(stages.train(spark, sf), ["home_ownership"])
    return _ints(encode.one_hot_encode(stages.formatted(spark, sf).select("id", "home_ownership"), vocabulary))


@query(with_stage("train", f"SELECT id, {', '.join(HOME_SQL.split(', ')[2:])} FROM formatted"))
def one_hot_drop_first(spark, sf):
    vocabulary = encode.fit_one_hot(stages.train(spark, sf), ["home_ownership"])
    source = stages.formatted(spark, sf).select("id", "home_ownership")
    return _ints(encode.one_hot_encode(source, vocabulary, drop_first=True))


@query(with_stage("train", f"SELECT id, {PURPOSE_SQL} FROM formatted"))
def group_one_hot(spark, sf):
    groups = encode.fit_groups(stages.train(spark, sf), {"purpose": PURPOSE_GROUPS})
    source = stages.formatted(spark, sf).select("id", "purpose")
    return _ints(encode.group_one_hot_encode(source, "purpose", PURPOSE_GROUPS, groups["purpose"]))


@query(with_stage("train", "SELECT id, " + ", ".join(r(_ordinal_sql(c), c) for c in ("grade", "term", "emp_length")) + f", {HOME_SQL}, {PURPOSE_SQL} FROM formatted"))
def encode_categoricals(spark, sf):
    columns = ["id", "grade", "term", "emp_length", "home_ownership", "purpose"]
    fit = encode.fit_encoding(stages.train(spark, sf), RULES)
    return rounded(_ints(encode.encode_categoricals(stages.formatted(spark, sf).select(*columns), fit)))


# Columns of a real loan table that the view lacks, by arithmetic on the id, with the values of the shipped rules.
_PURPOSES = [v for group in loans.PURPOSE_GROUPS.values() for v in group] + ["unlisted"]
EXTENSION = {
    "purpose": "CASE CAST(id % 16 AS INT) " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(_PURPOSES)) + " END",
    "verification_status": "CASE CAST(id % 4 AS INT) WHEN 0 THEN 'Verified' WHEN 1 THEN 'Not Verified' WHEN 2 THEN 'Source Verified' END",
    "initial_list_status": "CASE CAST(id % 7 AS INT) WHEN 0 THEN NULL WHEN 1 THEN 'x' WHEN 2 THEN 'w ' WHEN 3 THEN 'w' ELSE 'f' END",
    "sub_grade": "grade || CAST(id % 5 AS STRING)",
    "total_bal_ex_mort": "CASE WHEN id % 11 = 0 THEN NULL ELSE CAST((id * 997) % 120000 AS DOUBLE) END",
}
_EXTENDED = "SELECT * EXCLUDE (purpose), " + ", ".join(f"{e} AS {c}" for c, e in EXTENSION.items()) + " FROM formatted"


def _extended(spark, sf) -> DataFrame:
    return stages.formatted(spark, sf).withColumns({c: F.expr(e) for c, e in EXTENSION.items()})


_SHIPPED = loans.ENCODING_RULES["group_one_hot"]["purpose"]


def _case_groups(groups: dict) -> str:
    cases = " ".join(f"WHEN purpose IN ({strings(v)}) THEN '{g}'" for g, v in groups.items())
    return f"CASE WHEN purpose IS NULL THEN NULL {cases} ELSE 'other' END"


_SHIPPED_SQL = ", ".join(
    [r(_ordinal_sql(c), c) for c in ORDINAL]
    + [HOME_SQL]
    + [_flag(f"verification_status = '{v}'", f"verification_status_{v}") for v in ("Not Verified", "Source Verified", "Verified")]
    + [_flag("verification_status IS NULL", "verification_status_nan")]
    + [_flag(f"({_case_groups(_SHIPPED)}) = '{g}'", f"purpose_{g}") for g in sorted(_SHIPPED)]
    + [_flag("purpose IS NULL", "purpose_nan")]
)


@query(with_stage("formatted", f"SELECT id, {_SHIPPED_SQL} FROM extended", extended=_EXTENDED))
def shipped_rules(spark, sf):
    """The shipped rule document, all of it, on the values that it is written for."""
    table = clean.drop_leakage(_extended(spark, sf), [], rules=loans.ENCODING_RULES)
    ruled = [*ORDINAL, *loans.ENCODING_RULES["one_hot"], "purpose", "sub_grade"]
    source = table.select("id", *[c for c in ruled if c in table.columns])
    return rounded(_ints(encode.encode_categoricals(source, encode.fit_encoding(source, loans.ENCODING_RULES))))


@query(with_stage("formatted", f"SELECT id, {_case_groups(loans.PURPOSE_GROUPS)} AS purpose_group FROM extended", extended=_EXTENDED))
def purpose_groups(spark, sf):
    source = _extended(spark, sf).select("id", "purpose")
    return encode.group_categories(source, "purpose", loans.PURPOSE_GROUPS, name="purpose_group").drop("purpose")


_DEBT_SQL = "CAST(CASE WHEN abs(annual_inc) > 1e-9 THEN total_bal_ex_mort / annual_inc END AS FLOAT)"


@query(with_stage("formatted", f"SELECT id, {r(_DEBT_SQL, 'total_debt_to_income', 3)} FROM extended", extended=_EXTENDED))
def total_debt_to_income(spark, sf):
    return rounded(loans.add_financial_ratios(_extended(spark, sf)).select("id", "total_debt_to_income"), 3)


@query(with_stage("formatted", "SELECT id, CASE WHEN grade IN ('A', 'B') THEN 'low_risk' WHEN grade IN ('C', 'D') THEN 'mid_risk' WHEN grade IN ('E', 'F', 'G') THEN 'high_risk' END AS grade_group FROM formatted"))
def group_categories(spark, sf):
    source = stages.formatted(spark, sf).select("id", "grade")
    return encode.group_categories(source, "grade", loans.GRADE_GROUPS, name="grade_group").drop("grade")


_EMP_RATE = r("coalesce(t.rate, (SELECT avg(CAST(target AS DOUBLE)) FROM train))", "x")[:-5]


@query(
    with_stage(
        "train",
        f"SELECT f.id, CASE WHEN f.emp_length IS NULL THEN NULL ELSE {_EMP_RATE} END AS emp_length, f.home_ownership "
        "FROM formatted f LEFT JOIN (SELECT emp_length, avg(CAST(target AS DOUBLE)) AS rate FROM train WHERE emp_length IS NOT NULL GROUP BY 1) t ON f.emp_length = t.emp_length",
    )
)
def target_encode(spark, sf):
    """One column with enough categories to be encoded, one with too few that stays; both with NULLs."""
    columns = ["emp_length", "home_ownership"]
    rates, overall = encode.fit_target_encoding(stages.train(spark, sf), columns, min_categories=10)
    return rounded(encode.target_encode(stages.formatted(spark, sf).select("id", *columns), rates, overall, columns))


# 1,500 customers and more: a map that goes in as a joined table and not as literals.
@query("SELECT o_orderkey, CAST(CASE WHEN o_custkey <= 1500 THEN o_custkey % 97 ELSE -1 END AS DOUBLE) AS customer FROM orders")
def ordinal_large_map(spark, sf):
    orders = stages.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    return rounded(encode.ordinal_encode(orders, "customer", {str(k): k % 97 for k in range(1501)}))


# --- Derived features --------------------------------------------------------


def _float(expr: str) -> str:
    return f"CAST({expr} AS FLOAT)"


def _over(n: str, d: str) -> str:
    return f"CASE WHEN abs({d}) > 1e-9 THEN ({n}) / ({d}) END"


def _d(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


RATIO_SQL = {
    "income_to_loan_ratio": _over("annual_inc", "loan_amnt"),
    "installment_to_income": _over("installment", "(annual_inc / CAST(12 AS DOUBLE))"),
    "annual_interest_amount_approx": f"loan_amnt * ({_d('int_rate')} / CAST(100 AS DOUBLE))",
    "revol_bal_to_income": _over("revol_bal", "annual_inc"),
    "fico_avg": "(fico_range_low + fico_range_high) / CAST(2 AS DOUBLE)",
    "fico_spread": "fico_range_high - fico_range_low",
    "dti_ratio": "dti / CAST(100 AS DOUBLE)",
    "revol_usage_ratio": _over("revol_bal", "tot_hi_cred_lim"),
    "open_acc_ratio": _over(_d("open_acc"), _d("total_acc")),
}
FICO = f"CAST({_float(RATIO_SQL['fico_avg'])} AS DOUBLE)"
INTERACTION_SQL = {
    "fico_x_intrate": f"{FICO} * {_d('int_rate')}",
    "dti_x_intrate": f"dti * {_d('int_rate')}",
    "revol_util_sq": f"pow({_d('revol_util')}, 2)",
    "delinq_x_inq": f"{_d('delinq_2yrs')} * {_d('inq_last_6mths')}",
    "credit_age_x_fico": f"{_d('earliest_cr_line_months_since')} * {FICO}",
}


def _features_sql(features: dict[str, str]) -> str:
    return ", ".join(r(_float(e), n, 3) for n, e in features.items())


@query(with_stage("formatted", f"SELECT id, {_features_sql(RATIO_SQL)} FROM formatted"))
def ratios(spark, sf):
    return rounded(loans.add_financial_ratios(stages.formatted(spark, sf)).select("id", *RATIO_SQL), 3)


@query(with_stage("formatted", f"SELECT id, {_features_sql({'fico_avg': RATIO_SQL['fico_avg'], **INTERACTION_SQL})} FROM formatted"))
def interactions(spark, sf):
    return rounded(loans.add_interactions(stages.formatted(spark, sf)).select("id", "fico_avg", *INTERACTION_SQL), 3)


@query(with_stage("formatted", f"SELECT id, {_features_sql({**RATIO_SQL, **INTERACTION_SQL})} FROM formatted"))
def build_features(spark, sf):
    return rounded(loans.build_features(stages.formatted(spark, sf)).select("id", *RATIO_SQL, *INTERACTION_SQL), 3)


@query(
    "SELECT l_orderkey, l_linenumber, round(CAST(CAST(CASE WHEN abs(l_discount) > 1e-9 THEN l_tax / l_discount END AS FLOAT) AS DOUBLE), 4) AS tax_to_discount, "
    "round(CAST(CAST(l_extendedprice * l_discount AS FLOAT) AS DOUBLE), 2) AS discount_value FROM lineitem"
)
def generic_features(spark, sf):
    from tabloom.operators.features import Feature

    recipe = [
        Feature("tax_to_discount", "ratio", ("l_tax", "l_discount")),
        Feature("discount_value", "product", ("l_extendedprice", "l_discount")),
        Feature("skipped", "ratio", ("l_tax", "absent")),
    ]
    made = add_features(stages.table(spark, sf, "lineitem"), recipe)
    return made.select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.col("tax_to_discount").cast("double"), 4).alias("tax_to_discount"),
        F.round(F.col("discount_value").cast("double"), 2).alias("discount_value"),
    )


FORMULA_SQL = {
    "INCOME_TO_LOAN_RATIO": RATIO_SQL["income_to_loan_ratio"],
    "DTI_RATIO": "dti / CAST(100 AS DOUBLE)",
    "FICO_AVG": RATIO_SQL["fico_avg"],
    "DTI_INT_INTERACTION": f"dti * {_d('int_rate')}",
    "REVOL_UTIL_SQ": f"pow({_d('revol_util')}, 2)",
}


FORMULA_SQL["TOTAL_INTEREST_BURDEN"] = f"loan_amnt * {_d('int_rate')} * CAST(regexp_extract(term, '[0-9]+') AS DOUBLE) / 12"


@query(with_stage("formatted", f"SELECT id, {', '.join(r(_float(e), n, 3) for n, e in FORMULA_SQL.items())} FROM formatted"))
def formulas(spark, sf):
    termed = stages.formatted(spark, sf).withColumn("term_num", F.regexp_extract("term", "[0-9]+", 0).cast("double"))
    return rounded(add_formulas(termed, loans.FORMULAS).select("id", *FORMULA_SQL), 3)


# --- Splits and weights declared in settings ---------------------------------


def _split_sql(by: str, hash_: str) -> str:
    """First the rounded share of test rows by hash, then that of val rows."""
    share = "CAST(floor({} * count(*) OVER (PARTITION BY {}) + 0.5) AS BIGINT)"
    test, val = share.format("CAST(0.2 AS DOUBLE)", by), share.format("CAST(0.1 AS DOUBLE)", by)
    place = f"row_number() OVER (PARTITION BY {by} ORDER BY {hash_})"
    return f"CASE WHEN {place} <= {test} THEN 'test' WHEN {place} <= {test} + {val} THEN 'val' ELSE 'train' END AS split"


@query(f"SELECT o_orderkey, {_split_sql('1', _hash_sql('o_orderkey'))} FROM orders")
def random_split(spark, sf):
    """Exact shares, row by row."""
    return target.split_random(stages.table(spark, sf, "orders"), ["o_orderkey"]).select("o_orderkey", "split")


@query(with_stage("labelled", f"SELECT id, CAST(target AS INT) AS target, {_split_sql('target', _hash_sql('target', 'id'))} FROM labelled"))
def stratified_split(spark, sf):
    """Exact shares of each class, row by row."""
    labels = target.split_stratified(stages.labelled(spark, sf), ["id"])
    return labels.select("id", F.col("target").cast("int").alias("target"), "split")


@query(
    with_stage(
        "labelled",
        f"SELECT CAST(target AS INT) AS class, count(*) AS rows, {r('(SELECT count(*) FROM labelled) / (CAST(2 AS DOUBLE) * count(*))', 'weight')} FROM labelled GROUP BY 1",
    )
)
def class_weights(spark, sf):
    weights = target.class_weights(stages.labelled(spark, sf))
    return rounded(weights.withColumn("class", F.col("class").cast("int")))


# --- Feature selection on the train slice ------------------------------------

EXCLUDED = ("id", "issue_d_year", "issue_d_month", "issue_d_months_since")
BASE = [c for c in FORMATTED_COLUMNS if c not in EXCLUDED and c != "target"]
MADE = {**RATIO_SQL, **INTERACTION_SQL}
CANDIDATES = [*BASE, *MADE]
NUMERIC = [c for c in CANDIDATES if c not in FORMATTED_STRINGS]
FRAME_SQL = f"SELECT target, {', '.join(BASE)}, {', '.join(f'{_float(e)} AS {n}' for n, e in MADE.items())} FROM train"


def _frame(spark, sf) -> DataFrame:
    return loans.build_features(stages.train(spark, sf)).select("target", *CANDIDATES)


HEALTH_SQL = union(
    f"SELECT {i} AS at, '{c}' AS \"column\", {'true' if c in NUMERIC else 'false'} AS is_number, CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS missing_ratio, "
    f"{f'var_samp(CAST({c} AS DOUBLE))' if c in NUMERIC else 'CAST(NULL AS DOUBLE)'} AS variance FROM frame"
    for i, c in enumerate(CANDIDATES)
)


# A variance may have any magnitude, so it is compared as five significant digits and an exponent.
VARIANCE_SQL = "CASE WHEN variance > 1e-12 THEN {} WHEN variance IS NOT NULL THEN 0 END"


@query(
    with_stage(
        "train",
        f"SELECT \"column\", {r('missing_ratio', 'missing_ratio')}, "
        f"{r(VARIANCE_SQL.format('variance / pow(CAST(10 AS DOUBLE), floor(log10(variance)))'), 'variance_digits', 5)}, "
        f"CAST({VARIANCE_SQL.format('floor(log10(variance))')} AS BIGINT) AS variance_exponent FROM health",
        frame=FRAME_SQL,
        health=HEALTH_SQL,
    )
)
def column_health(spark, sf):
    health = select.column_health(_frame(spark, sf), CANDIDATES)
    v = F.col("variance")
    exponent = F.floor(F.log10(v))

    def of_variance(col, zero):
        return F.when(v > 1e-12, col).when(v.isNotNull(), zero)

    return health.select(
        "column",
        F.round("missing_ratio", 6).alias("missing_ratio"),
        F.round(of_variance(v / F.pow(F.lit(10.0), exponent), F.lit(0.0)), 5).alias("variance_digits"),
        of_variance(exponent, F.lit(0)).cast("bigint").alias("variance_exponent"),
    )


@query(with_stage("train", "SELECT \"column\" FROM health WHERE missing_ratio > 0.25", frame=FRAME_SQL, health=HEALTH_SQL))
def sel_missing(spark, sf):
    dropped = select.select_by_missing(_frame(spark, sf), CANDIDATES, threshold=0.25)
    return spark.createDataFrame([(c,) for c in dropped], "column string")


@query(with_stage("train", "SELECT \"column\" FROM health WHERE is_number AND (variance IS NULL OR variance < 0.01)", frame=FRAME_SQL, health=HEALTH_SQL))
def sel_variance(spark, sf):
    dropped = select.select_by_variance(_frame(spark, sf), CANDIDATES)
    return spark.createDataFrame([(c,) for c in dropped], "column string")


def _pair_sql(i: int, a: str, j: int, b: str) -> str:
    x, y = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END", f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    return (
        f"SELECT {i} AS i, {j} AS j, '{a}' AS \"left\", '{b}' AS \"right\", count({x}) AS pairs, "
        f"covar_samp({x}, {y}) / CASE WHEN stddev_samp({x}) > 1e-9 AND stddev_samp({y}) > 1e-9 THEN stddev_samp({x}) * stddev_samp({y}) END AS correlation FROM frame"
    )


WITH_TARGET = [*NUMERIC, "target"]
PAIRS_SQL = union(
    _pair_sql(i, a, j, b) for i, a in enumerate(WITH_TARGET) for j, b in enumerate(WITH_TARGET) if i < j
)


_WITH_GAPS = "SELECT CASE WHEN o_orderkey % 3 != 0 THEN o_totalprice END AS x, o_custkey AS y FROM orders"


@query(f"SELECT 'x' AS \"left\", 'y' AS \"right\", count(x) AS pairs, {r('corr(x, y)', 'correlation', 5)} FROM ({_WITH_GAPS}) t")
def correlation_infinite(spark, sf):
    """An infinite value is left out of its pairs and no more."""
    numbers = _with_infinities(spark, sf).join(stages.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("y")), "o_orderkey")
    return rounded(correlation_table(numbers, ["x", "y"]), 5)


@query("SELECT 'x' AS \"column\" FROM orders WHERE o_orderkey % 3 = 0 HAVING count(*) > 0")
def sel_variance_infinite(spark, sf):
    """A column with infinite values has no variance and goes."""
    names = select.select_by_variance(_with_infinities(spark, sf), ["o_orderkey", "x"])
    return spark.createDataFrame([(c,) for c in names], "column string")


@query(with_stage("train", f"SELECT \"left\", \"right\", pairs, {r('correlation', 'correlation', 5)} FROM pairs", frame=FRAME_SQL, pairs=PAIRS_SQL))
def correlation_pairs(spark, sf):
    return rounded(correlation_table(_frame(spark, sf), WITH_TARGET), 5)


@query(with_stage("train", f"SELECT \"left\" AS \"column\", {r('abs(correlation)', 'correlation', 5)} FROM pairs WHERE \"right\" = 'target'", frame=FRAME_SQL, pairs=PAIRS_SQL))
def target_correlations(spark, sf):
    return rounded(target_correlation(_frame(spark, sf), NUMERIC), 5)


WALK = {
    "strength": "SELECT \"left\" AS c, abs(correlation) AS s FROM pairs WHERE \"right\" = 'target'",
    "strong": """SELECT row_number() OVER (ORDER BY i, j) AS no, "left" AS a, "right" AS b,
        CASE WHEN (SELECT s FROM strength WHERE c = "left") >= (SELECT s FROM strength WHERE c = "right") - 1e-9 THEN "right" ELSE "left" END AS loser
        FROM pairs WHERE "right" <> 'target' AND abs(correlation) > 0.95 AND {alive}""",
    "walk": """SELECT CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS gone UNION ALL
        SELECT k + 1, CASE WHEN list_contains(gone, a) OR list_contains(gone, b) THEN gone ELSE list_append(gone, loser) END
        FROM walk JOIN strong ON no = k + 1""",
    "uncorrelated": "SELECT unnest(gone) AS \"column\" FROM (SELECT gone FROM walk ORDER BY k DESC LIMIT 1) t",
}


@query(
    with_stage(
        "train", "SELECT \"column\" FROM uncorrelated", recursive=True, frame=FRAME_SQL, pairs=PAIRS_SQL,
        **{k: v.format(alive="true") for k, v in WALK.items()},
    )
)
def sel_correlation(spark, sf):
    dropped = select.select_by_correlation(_frame(spark, sf), CANDIDATES)
    return spark.createDataFrame([(c,) for c in dropped], "column string")


def _iv_ctes(numbers, texts, source: str, label: str, total_bad: str, total_good: str, bins: int = 10) -> dict[str, str]:
    """Edges by rank, so that an edge on a data value is that value to the last bit."""
    share_bad, share_good = f"(bad + 0.5) / {total_bad}", f"(good + 0.5) / {total_good}"
    counts = []
    if numbers:
        counts.append("""SELECT l.c, 'numeric' AS kind, CAST(e.no AS VARCHAR) AS bin, any_value(e.low) AS low, any_value(e.high) AS high,
            CAST(sum(y) AS DOUBLE) AS bad, CAST(count(*) - sum(y) AS DOUBLE) AS good
            FROM longs l JOIN bins e ON l.c = e.c AND ((l.x > e.low AND l.x <= e.high) OR (e.no = 1 AND l.x = e.low)) GROUP BY l.c, e.no""")
    if texts:
        counts.append("""SELECT c, 'categorical' AS kind, CASE WHEN place <= 50 THEN v ELSE 'OTHER' END AS bin, CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high,
            CAST(sum(bad) AS DOUBLE) AS bad, CAST(sum(n - bad) AS DOUBLE) AS good
            FROM (SELECT c, v, n, bad, rank() OVER (PARTITION BY c ORDER BY n DESC) + (count(*) OVER (PARTITION BY c, n) - 1) / 2.0 AS place
                  FROM (SELECT c, v, count(*) AS n, sum(y) AS bad FROM texts GROUP BY 1, 2) g) p GROUP BY c, bin""")
    ctes = {}
    if numbers:
        ctes |= {
            "longs": union(f"SELECT '{c}' AS c, CAST({c} AS DOUBLE) AS x, {label} AS y FROM {source} WHERE {c} IS NOT NULL" for c in numbers),
            "ranked": "SELECT c, x, row_number() OVER (PARTITION BY c ORDER BY x) - 1 AS k, count(*) OVER (PARTITION BY c) AS n FROM longs",
            "spots": f"SELECT c, i, (i * (n - 1)) // {bins} AS k, CAST((i * (n - 1)) % {bins} AS DOUBLE) / {bins} AS part FROM (SELECT DISTINCT c, n FROM ranked) t, range(0, {bins + 1}) s(i)",
            "edges": "SELECT DISTINCT s.c, CASE WHEN s.part = 0 OR h.x IS NULL OR h.x = l.x THEN l.x ELSE l.x + (h.x - l.x) * s.part END AS e FROM spots s JOIN ranked l ON l.c = s.c AND l.k = s.k LEFT JOIN ranked h ON h.c = s.c AND h.k = s.k + 1",
            "bins": "SELECT c, lag(e) OVER (PARTITION BY c ORDER BY e) AS low, e AS high, row_number() OVER (PARTITION BY c ORDER BY e) - 1 AS no FROM edges QUALIFY no > 0",
        }
    if texts:
        ctes["texts"] = union(f"SELECT '{c}' AS c, CAST({c} AS VARCHAR) AS v, {label} AS y FROM {source} WHERE {c} IS NOT NULL" for c in texts)
    ctes["binned"] = union(counts)
    ctes["woes"] = (
        f"SELECT c AS \"column\", kind, bin, low, high, bad, good, ln(({share_good}) / ({share_bad})) AS woe, "
        f"(({share_good}) - ({share_bad})) * ln(({share_good}) / ({share_bad})) AS iv FROM binned"
    )
    every = union(f"SELECT '{c}' AS \"column\", '{k}' AS kind" for k, names in (("numeric", numbers), ("categorical", texts)) for c in names)
    ctes["ivs"] = f"""SELECT "column", {rnd('raw', 4)} AS iv, CASE WHEN raw < 0.02 THEN 'weak' WHEN raw < 0.1 THEN 'low' WHEN raw < 0.3 THEN 'medium'
        WHEN raw < 0.5 THEN 'strong' ELSE 'very_strong' END AS label, kind FROM (SELECT e."column", e.kind, coalesce(w.raw, 0) AS raw
        FROM ({every}) e LEFT JOIN (SELECT "column", sum(iv) AS raw FROM woes GROUP BY 1) w ON w."column" = e."column") t"""
    return ctes


TEXTS = [c for c in CANDIDATES if c in FORMATTED_STRINGS]
IV = _iv_ctes(NUMERIC, TEXTS, "frame", "CAST(target AS INT)", "(SELECT CAST(sum(target) AS DOUBLE) FROM frame)", "(SELECT CAST(sum(1 - target) AS DOUBLE) FROM frame)")


@query(with_stage("train", "SELECT * FROM ivs", frame=FRAME_SQL, **IV))
def iv_scores(spark, sf):
    return information.information_value(_frame(spark, sf))


@query(
    with_stage(
        "train",
        f"SELECT \"column\", kind, bin, {r('low', 'low', 3)}, {r('high', 'high', 3)}, bad, good, {r('woe', 'woe')}, {r('iv', 'iv')} FROM woes",
        frame=FRAME_SQL,
        **IV,
    )
)
def woe_table(spark, sf):
    woe = information.woe_table(_frame(spark, sf))
    return woe.select(
        "column",
        "kind",
        "bin",
        *[F.round(c, 3).alias(c) for c in ("low", "high")],
        "bad",
        "good",
        *[F.round(c, 6).alias(c) for c in ("woe", "iv")],
    )


LINE_IV = _iv_ctes(
    ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], ["l_linestatus", "l_suppkey_text"], "lines", "returned",
    "(SELECT CAST(sum(returned) AS DOUBLE) FROM lines)", "(SELECT CAST(sum(1 - returned) AS DOUBLE) FROM lines)",
)
LINE_SQL = "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, CAST(l_suppkey AS VARCHAR) AS l_suppkey_text, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned FROM lineitem"


def _lines(spark, sf) -> DataFrame:
    return stages.table(spark, sf, "lineitem").select(
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_linestatus",
        F.col("l_suppkey").cast("string").alias("l_suppkey_text"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
    )


def _plain(sql: str, **ctes: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + sql


@query(_plain("SELECT * FROM ivs", lines=LINE_SQL, **LINE_IV))
def iv_scores_lineitem(spark, sf):
    return information.information_value(_lines(spark, sf), target="returned")


@query(
    _plain(
        "SELECT 'l_suppkey_text' AS \"column\", n AS count, count(*) AS values, CAST(any_value(place) AS DOUBLE) AS rank FROM "
        "(SELECT n, rank() OVER (ORDER BY n DESC) + (count(*) OVER (PARTITION BY n) - 1) / 2.0 AS place FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey) g) p GROUP BY n",
        lines=LINE_SQL,
    )
)
def frequency_ranks(spark, sf):
    return profile.frequency_levels(profile.value_table(_lines(spark, sf), ["l_suppkey_text"]))


@query(with_stage("train", "SELECT \"column\" FROM ivs WHERE iv < 0.02", frame=FRAME_SQL, **IV))
def sel_iv(spark, sf):
    dropped = select.drop_by_iv(information.information_value(_frame(spark, sf)).collect())
    return spark.createDataFrame([(c,) for c in dropped], "column string")


_ALIVE = '"left" IN (SELECT "column" FROM fit_columns) AND "right" IN (SELECT "column" FROM fit_columns)'
FUNNEL = {
    "frame": FRAME_SQL,
    "health": HEALTH_SQL,
    "fit_columns": 'SELECT "column" FROM health WHERE missing_ratio <= 0.95 AND (NOT is_number OR variance >= 0.01)',
    "pairs": PAIRS_SQL,
    **{k: v.format(alive=_ALIVE) for k, v in WALK.items()},
    **IV,
    "steps": """SELECT h."column", CASE WHEN missing_ratio > 0.95 THEN 'missing' WHEN is_number AND (variance IS NULL OR variance < 0.01) THEN 'variance'
        WHEN h."column" IN (SELECT "column" FROM uncorrelated) THEN 'correlation' WHEN iv < 0.02 THEN 'iv' END AS step, iv
        FROM health h JOIN ivs ON ivs."column" = h."column\"""",
}


def _funnel(spark, sf):
    return fit_selector(_frame(spark, sf), run_importance=False, run_permutation=False)


@query(
    with_stage(
        "train",
        """SELECT "column", CASE WHEN step IS NULL THEN 'selected' ELSE 'dropped' END AS status, step,
        CASE WHEN step IS NULL OR step = 'iv' THEN iv END AS iv FROM steps""",
        recursive=True,
        **FUNNEL,
    )
)
def selection_report(spark, sf):
    return _funnel(spark, sf).report(spark).select("column", "status", "step", "iv")


@query(
    with_stage(
        "train",
        f"""SELECT CAST(n AS INT) AS step_no, s AS step, CAST((SELECT count(*) FROM steps WHERE step = s) AS INT) AS dropped,
        CAST({len(CANDIDATES)} - (SELECT count(*) FROM steps WHERE step IN (SELECT s FROM names b WHERE b.n <= names.n)) AS INT) AS remaining FROM names""",
        recursive=True,
        names="SELECT * FROM (VALUES (0, 'candidates'), (1, 'missing'), (2, 'variance'), (3, 'correlation'), (4, 'iv'), (5, 'importance'), (6, 'permutation')) t(n, s)",
        **FUNNEL,
    )
)
def selection_waterfall(spark, sf):
    return _funnel(spark, sf).waterfall(spark)


_COUNTED = union(f"SELECT '{c}' AS \"column\", count({c}) AS present, count(*) AS rows FROM {'train' if c == 'id' else 'frame'}" for c in ["id", *CANDIDATES, "target"])


@query(
    with_stage(
        "train",
        """SELECT "column", present, rows FROM counted WHERE "column" IN ('id', 'target')
        OR "column" IN (SELECT "column" FROM steps WHERE step IS NULL)""",
        recursive=True,
        **FUNNEL,
        counted=_COUNTED,
    )
)
def transform_selected(spark, sf):
    """What each column of the final table holds: the excluded id, the selected features and the target."""
    frame = loans.build_features(stages.train(spark, sf)).select("id", "target", *CANDIDATES)
    final = fit_selector(frame, exclude=("id",), run_importance=False, run_permutation=False).transform(frame)
    counts = final.agg(*[F.count(f"`{c}`").alias(c) for c in final.columns], F.count("*").alias("_rows"))
    names = F.expr("stack(" + str(len(final.columns)) + ", " + ", ".join(f"'{c}', `{c}`" for c in final.columns) + ") AS (column, present)")
    return counts.select(F.col("_rows").alias("rows"), names).select("column", "present", "rows")


@query(
    """WITH s AS (SELECT o_orderstatus AS status, round(o_totalprice / 20000) AS score, CAST(o_custkey % 2 AS INT) AS label FROM orders),
    t AS (SELECT status, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM s GROUP BY 1, 2)
    SELECT a.status, round(CAST(sum(a.pos * b.neg * CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END)
        AS DOUBLE) / (sum(a.pos * b.neg)), 6) AS auc FROM t a JOIN t b ON a.status = b.status GROUP BY 1"""
)
def grouped_auc(spark, sf):
    """Area under the curve by group, scores full of ties."""
    scored = stages.table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("status"),
        F.round(F.col("o_totalprice") / 20000).alias("score"),
        (F.col("o_custkey") % 2).cast("int").alias("label"),
    )
    return rounded(importance.grouped_auc(scored, ["status"]))


#: Columns of few values, and the rows' labels, each decided by one of them alone.
_SHORT = ["l_discount", "l_tax", "l_linenumber"]
_PLANTED = {"l_discount": "l_discount >= 0.06", "l_linenumber": "l_linenumber <= 2"}
#: A column decides the label if no value of it has both labels.
_DECIDES_SQL = union(
    f"""SELECT '{by}' AS planted, '{c}' AS "column", CAST(CASE WHEN max(labels) = 1 THEN {{hit}} ELSE 0 END AS DOUBLE) AS importance
    FROM (SELECT count(DISTINCT {test}) AS labels FROM lineitem GROUP BY {c}) t"""
    for by, test in _PLANTED.items()
    for c in _SHORT
)


def _planted(spark, sf, measure: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The importance of each short column for each label."""
    lines = stages.table(spark, sf, "lineitem").select(*_SHORT)
    found = None
    for by, test in _PLANTED.items():
        scores = measure(lines.withColumn("target", F.expr(test).cast("int")))
        scores = scores.select(F.lit(by).alias("planted"), "column", "importance")
        found = scores if found is None else found.unionAll(scores)
    return found


@query(_DECIDES_SQL.format(hit="1.0"))
def tree_importance_planted(spark, sf):
    """Trees give all importance to the column that decides the label."""
    return rounded(_planted(spark, sf, lambda df: tree_importance(df, _SHORT, trees=10)))


@query(_DECIDES_SQL.format(hit="0.5"))
def permutation_importance_planted(spark, sf):
    """A forest that reads a shuffled column that decides the label guesses: it loses half of the area, to a tenth."""
    measure = lambda df: permutation_importance(df, _SHORT, trees=20).withColumnRenamed("importance_mean", "importance")
    return rounded(_planted(spark, sf, measure), 1)


# On the loan table the tree steps have no SQL twin: boosted trees and forests are iterative.


@query()
def sel_tree(spark, sf):
    return rounded(tree_importance(_frame(spark, sf), NUMERIC))


@query()
def sel_permutation(spark, sf):
    return rounded(permutation_importance(_frame(spark, sf), NUMERIC))


@query()
def selection_full(spark, sf):
    """The whole funnel; the report is what comes back from the saved files."""
    chosen = fit_selector(_frame(spark, sf))
    folder = new_path(spark, "selection")
    chosen.save(spark, folder)
    assert fits.load_column_list(spark, f"{folder}/selected_features.json") == chosen.selected
    assert fits.load_fit(spark, f"{folder}/dropped_features.json")["total_selected"] == len(chosen.selected)
    types_of = {f.name: f.dataType for f in chosen.report(spark).schema}
    schema = ", ".join(f"`{c}` {t.simpleString()}" for c, t in types_of.items())
    return rounded(csv.read_csv_table(spark, f"{folder}/feature_selection_report.csv", schema=schema))


# The chain in SQL, each step over all rows with its fits from the train years. The lists of columns are what
# the missing-value advice (see missing_profile) gives for these tables.
_IN_TRAIN = f"WHERE issue_d_year <= {stages.TRAIN_UNTIL}"
_FILLED = ["mths_since_recent_inq", "annual_inc", "revol_util", *(f"earliest_cr_line_{p}" for p in ("year", "month", "months_since"))]
_FILLED_TEXT = ["home_ownership", "emp_length"]
_FLAGGED = ["mths_since_recent_inq", "home_ownership"]
_GAPS_LEFT = ["installment_to_income", "revol_bal_to_income", "revol_usage_ratio", "open_acc_ratio"]


def _between(c: str, low: str | float | None, high: str | float | None) -> str:
    """A value within bounds, NULL where it is NULL."""
    tests = [(f"< {low}", low)] * (low is not None) + [(f"> {high}", high)] * (high is not None)
    return "CASE " + " ".join(f"WHEN {c} {test} THEN {to}" for test, to in tests) + f" ELSE {c} END"


def _clipped_sql() -> str:
    parts = []
    for c in dict.fromkeys([*CLIPPED, *loans.DOMAIN_RULES]):
        value = _d(c)
        if c in CLIPPED:
            value = _d(_float(_between(c, f"(SELECT {c}_low FROM bounds)", f"(SELECT {c}_high FROM bounds)")))
        parts.append(f"{_d(_float(_between(value, *loans.DOMAIN_RULES.get(c, (None, None))))) if c in loans.DOMAIN_RULES else value} AS {c}")
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM filled"


_PREPARED = {
    "filled": "SELECT * EXCLUDE (mths_since_last_delinq) REPLACE ("
    + ", ".join(
        [f"coalesce({c}, CAST({_median_sql(c)} AS {'FLOAT' if FORMATTED_TYPES[c] == 'float' else 'DOUBLE'})) AS {c}" for c in _FILLED]
        + [f"coalesce({c}, {_mode_sql(c)}) AS {c}" for c in _FILLED_TEXT]
    )
    + "), "
    + ", ".join(_flag(f"{c} IS NULL", f"{c}_MISSING") for c in _FLAGGED)
    + " FROM formatted",
    "bounds": "SELECT "
    + ", ".join(
        f"{_bounds_sql(c)[k].replace('FROM train', f'FROM filled {_IN_TRAIN}')} AS {c}_{end}"
        for c in CLIPPED
        for k, end in enumerate(("low", "high"))
    ),
    "clipped": _clipped_sql(),
    "featured": f"SELECT *, {', '.join(f'{_float(e)} AS {n}' for n, e in MADE.items())}, "
    + ", ".join(
        f'{_float(e)} AS "{c}_LOG"'
        for c in loans.LOG_COLUMNS
        for shifted in [f"({c} + {SHIFT_SQL.format(c=c).replace('FROM train', f'FROM clipped {_IN_TRAIN}')})"]
        for e in [f"CASE WHEN {shifted} > -1 THEN ln(1 + {shifted}) END"]
    )
    + " FROM clipped",
}
_PREPARED_NUMBERS = [
    c for c in [*FORMATTED_NUMBERS, *MADE, *(f"{c}_LOG" for c in loans.LOG_COLUMNS)] if c != "mths_since_last_delinq"
]


def _prepared_sql(c: str) -> str:
    if FORMATTED_TYPES.get(c) in ("int", "bigint"):
        return c
    if c in _GAPS_LEFT:
        return r(f"coalesce({c}, CAST({_median_sql(c, f'featured {_IN_TRAIN}')} AS FLOAT))", c)
    return r(c, f'"{c}"')


@query(
    with_stage(
        "train",
        "SELECT CAST(target AS INT) AS target, "
        + ", ".join([_prepared_sql(c) for c in _PREPARED_NUMBERS] + [r(_ordinal_sql(c), c) for c in ("grade", "term", "emp_length")])
        + f", {HOME_SQL}, {PURPOSE_SQL}, "
        + ", ".join(f'"{c}_MISSING"' for c in _FLAGGED)
        + " FROM featured",
        **_PREPARED,
    )
)
def prepared_table(spark, sf):
    """The whole chain: fits on train, one lazy projection over every labelled row."""
    prep = loans.fit_preparation(stages.train(spark, sf), clip=CLIPPED, rules=RULES)
    return rounded(_ints(prep.apply(stages.formatted(spark, sf))))
