"""The loan-shaped view over orders and customer, and the stages built on it, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.functions.lineage import materialize
from tabloom.operators import clean
from tabloom.operators.target import split_by_year
from tabloom.plans import loan as loans
from tabloom.sources.tables import read_parquet_table

# The order dates run from 1995 to 2001: the last two years are validation and test.
TRAIN_UNTIL, VAL_YEAR, TEST_YEAR = 1999, 2000, 2001
REFERENCE_DATE = "2001-12-01"

LOAN_SQL = """
SELECT
  o_orderkey AS id,
  CASE WHEN o_orderstatus = 'P' THEN 'Current'
       WHEN (o_orderkey * 7919) % 100 <
            8 + 2 * (o_custkey % 20) + CASE WHEN c_acctbal < 2000 THEN 20 ELSE 0 END
         THEN CASE WHEN o_orderkey % 5 = 0 THEN 'Default' ELSE 'Charged Off' END
       ELSE 'Fully Paid' END AS loan_status,
  substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * month(o_orderdate) - 2 AS INT), 3)
    || '-' || CAST(year(o_orderdate) AS STRING) AS issue_d,
  CASE WHEN o_custkey % 50 = 0 THEN 'unknown'
       ELSE substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * (o_custkey % 12) + 1 AS INT), 3)
         || '-' || CAST(1975 + o_custkey % 18 AS STRING) END AS earliest_cr_line,
  o_totalprice AS loan_amnt,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE c_acctbal * 10 END AS annual_inc,
  ' ' || CAST(5 + o_custkey % 20 AS STRING) || '.5% ' AS int_rate,
  CASE WHEN o_orderkey % 40 = 0 THEN 'n/a' WHEN o_orderkey % 25 = 0 THEN NULL
       ELSE CAST((o_orderkey * 31) % 130 AS STRING) || '%' END AS revol_util,
  CAST((o_orderkey * 37) % 1200 AS DOUBLE) / 10 AS dti,
  substr('ABCDE', CAST(substr(o_orderpriority, 1, 1) AS INT), 1) AS grade,
  CASE WHEN o_orderkey % 2 = 0 THEN ' 36 months' ELSE ' 60 months' END AS term,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '< 1 year'
       WHEN o_orderkey % 11 = 10 THEN '10+ years'
       ELSE CAST(o_orderkey % 11 AS STRING) || ' years' END AS emp_length,
  lower(c_mktsegment) AS purpose,
  CASE c_nationkey % 4 WHEN 0 THEN 'RENT' WHEN 1 THEN 'OWN' WHEN 2 THEN 'MORTGAGE' END AS home_ownership,
  CAST(600 + (o_custkey * 13) % 250 AS DOUBLE) AS fico_range_low,
  CAST(604 + (o_custkey * 13) % 250 AS DOUBLE) AS fico_range_high,
  CAST((o_orderkey * 101) % 50000 AS DOUBLE) AS revol_bal,
  CASE WHEN o_orderkey % 30 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST((o_orderkey * 211) % 90000 AS DOUBLE) END
    AS tot_hi_cred_lim,
  CAST((o_orderkey * 17) % 30 AS INT) AS open_acc,
  CAST((o_orderkey * 17) % 30 + o_custkey % 12 AS INT) AS total_acc,
  CAST(o_orderkey % 3 AS INT) AS delinq_2yrs,
  CAST(o_custkey % 6 AS INT) AS inq_last_6mths,
  o_totalprice / 36 AS installment,
  CASE WHEN o_orderkey % 10 < 7 THEN NULL ELSE CAST(o_orderkey % 84 AS DOUBLE) END AS mths_since_last_delinq,
  CASE WHEN o_orderkey % 10 < 3 THEN NULL ELSE CAST(o_custkey % 25 AS DOUBLE) END AS mths_since_recent_inq,
  CAST(1 AS DOUBLE) AS policy_code,
  o_totalprice * 0.9 AS total_pymnt
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

_stored: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_table(spark, f"{sf_dir}/{name}.parquet")


def loan_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join as a lazy plan; which side is broadcast, if any, is left to Spark."""
    return spark.sql(LOAN_SQL, orders=table(spark, sf_dir, "orders"), customer=table(spark, sf_dir, "customer"))


def loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view written once per session: fits read it several times and should not join again.

    The test tables have one row group each, so the rows are dealt out to a file for each core.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        _stored[key] = materialize(loan_view(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism), "loan")
    return _stored[key]


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loans.label(loan(spark, sf_dir))


def formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = clean.drop_leakage(labelled(spark, sf_dir), loans.LEAKAGE_COLUMNS, rules=loans.ENCODING_RULES)
    return loans.parse_formats(kept, reference=REFERENCE_DATE)


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_by_year(
        formatted(spark, sf_dir), "issue_d_year", train_until=TRAIN_UNTIL, val_year=VAL_YEAR, test_year=TEST_YEAR
    )


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits(spark, sf_dir).where("split = 'train'").drop("split")


# --- The same stages as SQL common table expressions -------------------------

WS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '||chr(160)"


def strings(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def percent_sql(c: str) -> str:
    return f"CAST(TRY_CAST(replace(trim({c}, {WS}), '%', '') AS DOUBLE) AS FLOAT)"


def month_sql(c: str) -> str:
    return f"try_strptime({c}, '%b-%Y')"


FORMATTED_COLUMNS = [
    "id", "loan_amnt", "annual_inc", "int_rate", "revol_util", "dti", "grade", "term", "emp_length",
    "purpose", "home_ownership", "fico_range_low", "fico_range_high", "revol_bal", "tot_hi_cred_lim",
    "open_acc", "total_acc", "delinq_2yrs", "inq_last_6mths", "installment", "mths_since_last_delinq",
    "mths_since_recent_inq", "policy_code", "target", "issue_d_year", "issue_d_month",
    "issue_d_months_since", "earliest_cr_line_year", "earliest_cr_line_month", "earliest_cr_line_months_since",
]
FORMATTED_STRINGS = ["grade", "term", "emp_length", "purpose", "home_ownership"]
FORMATTED_NUMBERS = [c for c in FORMATTED_COLUMNS if c not in FORMATTED_STRINGS and c != "target"]


def _formatted_sql() -> str:
    parts = []
    for c in FORMATTED_COLUMNS:
        if c in ("int_rate", "revol_util"):
            parts.append(f"{percent_sql(c)} AS {c}")
        elif c.endswith("_year"):
            parts.append(f"CAST(year({month_sql(c.removesuffix('_year'))}) AS FLOAT) AS {c}")
        elif c.endswith("_month"):
            parts.append(f"CAST(month({month_sql(c.removesuffix('_month'))}) AS FLOAT) AS {c}")
        elif c.endswith("_months_since"):
            t = month_sql(c.removesuffix("_months_since"))
            parts.append(
                f"CAST(date_diff('day', {t}, TIMESTAMP '{REFERENCE_DATE} 00:00:00') / CAST(30 AS DOUBLE) AS FLOAT) AS {c}"
            )
        elif c in FORMATTED_STRINGS:
            parts.append(f"trim({c}, {WS}) AS {c}")
        else:
            parts.append(c)
    return "SELECT " + ", ".join(parts) + " FROM labelled"


CTES = {
    "loan": LOAN_SQL.format(orders="orders", customer="customer"),
    "labelled": f"""SELECT * FROM (SELECT *, CAST(CASE WHEN loan_status IN ({strings(loans.POSITIVE_STATUSES)}) THEN 1
        WHEN loan_status IN ({strings(loans.NEGATIVE_STATUSES)}) THEN 0 END AS TINYINT) AS target FROM loan
        WHERE loan_status IS NULL OR loan_status NOT IN ({strings(loans.IGNORED_STATUSES)})) t WHERE target IS NOT NULL""",
    "formatted": _formatted_sql(),
    "splits": f"""SELECT *, CASE WHEN issue_d_year <= {TRAIN_UNTIL} THEN 'train' WHEN issue_d_year = {VAL_YEAR} THEN 'val'
        WHEN issue_d_year = {TEST_YEAR} THEN 'test' END AS split FROM formatted""",
    "train": "SELECT * EXCLUDE (split) FROM splits WHERE split = 'train'",
}
_NEEDS = {"loan": [], "labelled": ["loan"], "formatted": ["labelled"], "splits": ["formatted"], "train": ["splits"]}


def with_stage(stage: str, sql: str, recursive: bool = False, **extra: str) -> str:
    """Prefix a query with the stage it reads, the stages below it and further named ones."""
    chain: list[str] = []

    def visit(s: str) -> None:
        for n in _NEEDS[s]:
            visit(n)
        if s not in chain:
            chain.append(s)

    visit(stage)
    ctes = [f"{s} AS MATERIALIZED ({CTES[s]})" for s in chain] + [f"{k} AS ({v})" for k, v in extra.items()]
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + sql


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def rnd(expr: str, digits: int) -> str:
    """The numpy rounding rule in SQL."""
    s = f"CAST({10**digits} AS DOUBLE)"
    return f"round_even(({expr}) * {s}, 0) / {s}"


def pct(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0) * CAST(100 AS DOUBLE)"
