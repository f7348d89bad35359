"""Loan data: fixed values, the feature recipe and the preparation chain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame

from tabloom.functions.lineage import materialize
from tabloom.operators import clean
from tabloom.operators.encode import align_columns, encode_categoricals, fit_encoding
from tabloom.operators.features import Feature, add_features
from tabloom.operators.profile import missing_profile
from tabloom.operators.target import make_binary_target

# --- Fixed values: status classes, column lists, domain limits, encodings ----

STATUS_COLUMN = "loan_status"
POSITIVE_STATUSES = ["Charged Off", "Default"]
NEGATIVE_STATUSES = ["Fully Paid"]
IGNORED_STATUSES = [
    "Current",
    "In Grace Period",
    "Late (16-30 days)",
    "Late (31-120 days)",
    "Does not meet the credit policy. Status:Fully Paid",
    "Does not meet the credit policy. Status:Charged Off",
]

REQUIRED_COLUMNS = [
    "loan_amnt",
    "int_rate",
    "annual_inc",
    "dti",
    "fico_range_low",
    "fico_range_high",
    "loan_status",
    "grade",
    "emp_length",
    "purpose",
    "term",
]

# Columns that are always dropped before features are built.
LEAKAGE_COLUMNS = [
    "total_pymnt",
    "total_rec_prncp",
    "recoveries",
    "total_rec_int",
    "total_rec_late_fee",
    "last_pymnt_amnt",
    "collection_recovery_fee",
    "debt_settlement_flag",
    "hardship_flag",
    "hardship_status",
    "out_prncp",
    "out_prncp_inv",
    "total_pymnt_inv",
    "loan_status",
    "last_pymnt_d",
    "next_pymnt_d",
    "last_fico_range_low",
    "last_fico_range_high",
    "funded_amnt",
    "funded_amnt_inv",
]

# Columns a raw table is checked for; the status column is not one of them.
REPORTED_LEAKAGE_COLUMNS = [
    "total_pymnt",
    "total_rec_prncp",
    "recoveries",
    "total_rec_int",
    "total_rec_late_fee",
    "last_pymnt_amnt",
    "last_pymnt_d",
    "next_pymnt_d",
    "collection_recovery_fee",
    "debt_settlement_flag",
    "hardship_flag",
    "hardship_status",
    "hardship_amount",
    "hardship_start_date",
    "hardship_end_date",
    "out_prncp",
    "out_prncp_inv",
    "total_pymnt_inv",
    "last_fico_range_low",
    "last_fico_range_high",
    "funded_amnt",
    "funded_amnt_inv",
    "settlement_status",
    "settlement_date",
]

DATE_COLUMNS = ["issue_d", "earliest_cr_line"]
DATE_FORMAT = "MMM-yyyy"
REFERENCE_DATE = "2018-12-01"
PERCENT_COLUMNS = ["int_rate", "revol_util"]
LOG_COLUMNS = ["annual_inc", "revol_bal", "loan_amnt"]

# column: (minimum, maximum)
DOMAIN_RULES = {
    "annual_inc": (0, None),
    "dti": (0, 100),
    "revol_util": (0, 100),
    "loan_amnt": (500, None),
}

ENCODING_RULES = {
    "ordinal": {
        "grade": {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6, "G": 7},
        "term": {"36 months": 0, "60 months": 1},
        "emp_length": {
            "< 1 year": 0,
            "1 year": 1,
            "2 years": 2,
            "3 years": 3,
            "4 years": 4,
            "5 years": 5,
            "6 years": 6,
            "7 years": 7,
            "8 years": 8,
            "9 years": 9,
            "10+ years": 10,
        },
        "initial_list_status": {"w": 0, "f": 1},
    },
    "one_hot": ["home_ownership", "verification_status"],
    "group_one_hot": {
        "purpose": {
            "debt": ["debt_consolidation", "credit_card"],
            "home": ["home_improvement", "house", "moving"],
            "purchases": ["major_purchase", "car", "vacation", "wedding"],
            "business": ["small_business"],
            "health": ["medical"],
            "education": ["educational"],
            "other": ["other", "renewable_energy"],
        },
    },
    "drop": ["sub_grade"],
}

GRADE_GROUPS = {
    "low_risk": ["A", "B"],
    "mid_risk": ["C", "D"],
    "high_risk": ["E", "F", "G"],
}

# Groups of purposes for analysis; unlike those of the rule document they hold education under other.
PURPOSE_GROUPS = {
    "debt": ["debt_consolidation", "credit_card"],
    "home": ["home_improvement", "house", "moving"],
    "purchases": ["major_purchase", "car", "vacation", "wedding"],
    "business": ["small_business"],
    "health": ["medical"],
    "other": ["other", "renewable_energy", "educational"],
}

FORMULAS = {
    "INCOME_TO_LOAN_RATIO": "annual_inc / loan_amnt",
    "DTI_RATIO": "dti / 100",
    "FICO_AVG": "(fico_range_low + fico_range_high) / 2",
    "DTI_INT_INTERACTION": "dti * int_rate",
    "REVOL_UTIL_SQ": "revol_util ** 2",
    "TOTAL_INTEREST_BURDEN": "loan_amnt * int_rate * term_num / 12",
}

RATIOS = [
    Feature("income_to_loan_ratio", "ratio", ("annual_inc", "loan_amnt")),
    Feature("installment_to_income", "ratio", ("installment", "annual_inc"), 12),
    Feature("annual_interest_amount_approx", "product", ("loan_amnt", "int_rate"), 100),
    Feature("revol_bal_to_income", "ratio", ("revol_bal", "annual_inc")),
    Feature("fico_avg", "mean", ("fico_range_low", "fico_range_high")),
    Feature("fico_spread", "difference", ("fico_range_low", "fico_range_high")),
    Feature("dti_ratio", "scaled", ("dti",), 100),
    Feature("total_debt_to_income", "ratio", ("total_bal_ex_mort", "annual_inc")),
    Feature("revol_usage_ratio", "ratio", ("revol_bal", "tot_hi_cred_lim")),
    Feature("open_acc_ratio", "ratio", ("open_acc", "total_acc")),
]

INTERACTIONS = [
    Feature("fico_x_intrate", "product", ("fico_avg", "int_rate")),
    Feature("dti_x_intrate", "product", ("dti", "int_rate")),
    Feature("revol_util_sq", "power", ("revol_util",), 2),
    Feature("delinq_x_inq", "product", ("delinq_2yrs", "inq_last_6mths")),
    Feature("credit_age_x_fico", "product", ("earliest_cr_line_months_since", "fico_avg")),
]

# --- Operators over the fixed values ----------------------------------------


def _without(recipe: Sequence[Feature], *names: str) -> list[Feature]:
    return [f for f in recipe if f.name not in names]


def add_financial_ratios(df: DataFrame, *, dti_ratio: bool = True) -> DataFrame:
    return add_features(df, RATIOS if dti_ratio else _without(RATIOS, "dti_ratio"))


def add_interactions(df: DataFrame, *, need_fico_avg: bool = True, credit_age_x_fico: bool = True) -> DataFrame:
    """Interaction features; ``fico_avg`` is made first when it is absent and wanted."""
    recipe = INTERACTIONS if credit_age_x_fico else _without(INTERACTIONS, "credit_age_x_fico")
    if need_fico_avg and "fico_avg" not in df.columns:
        recipe = [*(f for f in RATIOS if f.name == "fico_avg"), *recipe]
    return add_features(df, recipe)


def build_features(df: DataFrame, *, dti_ratio: bool = True, credit_age_x_fico: bool = True) -> DataFrame:
    return add_interactions(add_financial_ratios(df, dti_ratio=dti_ratio), credit_age_x_fico=credit_age_x_fico)


def label(df: DataFrame) -> DataFrame:
    return make_binary_target(df, STATUS_COLUMN, POSITIVE_STATUSES, NEGATIVE_STATUSES, IGNORED_STATUSES)


def parse_formats(df: DataFrame, *, reference: str = REFERENCE_DATE) -> DataFrame:
    """Percents, term, dates and stripped strings."""
    df = clean.parse_percentages(df, PERCENT_COLUMNS)
    df = clean.trim_categories(df, ["term"])
    df = clean.parse_dates(df, DATE_COLUMNS, reference=reference, format=DATE_FORMAT)
    return clean.normalize_strings(df, lower=False)


@dataclass
class Preparation:
    """Everything learned from the train slice; a few values per column, JSON-ready."""

    drop: list[str]
    flag: list[str]
    fill: list[str]
    fills: dict[str, float | str | None]
    bounds: dict[str, dict[str, float | None]]
    shifts: dict[str, float]
    encoding: dict
    medians: dict[str, float]
    columns: list[str]
    clip_limits: dict[str, list]

    def as_fit(self) -> dict:
        return asdict(self)

    @classmethod
    def from_fit(cls, fit: Mapping) -> "Preparation":
        return cls(**fit)

    def _features(self, df: DataFrame) -> DataFrame:
        df = clean.fill_missing(df, self.fills, drop=self.drop, flag=self.flag, fill=self.fill)
        df = clean.clamp_domain(clean.clip_outliers(df, self.bounds), self.clip_limits)
        return clean.log1p_columns(build_features(df), self.shifts)

    def apply(self, df: DataFrame) -> DataFrame:
        """One lazy chain of projections: no shuffle, no second look at the data."""
        df = encode_categoricals(self._features(df), self.encoding)
        df = clean.fill_numeric_median(clean.replace_infinite(df), self.medians)
        return align_columns(df, self.columns)


def missing_strategies(train: DataFrame) -> dict[str, list[str]]:
    """The profile's advice as column lists: drop, flag, fill."""
    advice = missing_profile(train).collect()
    kinds = {"DROP": "drop", "FLAG+MEDIAN": "flag", "MEDIAN/MODE": "fill", "COMPLETE": "fill"}
    lists: dict[str, list[str]] = {"drop": [], "flag": [], "fill": []}
    for r in advice:
        lists[kinds[r["strategy"]]].append(r["column"])
    return lists


def fit_preparation(
    train: DataFrame,
    *,
    clip: Sequence[str] = (),
    logs: Sequence[str] = LOG_COLUMNS,
    rules: Mapping = ENCODING_RULES,
    limits: Mapping[str, tuple] = DOMAIN_RULES,
) -> Preparation:
    """Learn the chain on a train slice that has its formats parsed and leaking columns dropped.

    The fits read the slice and its features many times, so both are written once to the
    shared folder: dates and percents are parsed once, and scans read the columns they need.
    """
    train = materialize(train, "preparation-train")
    lists = missing_strategies(train)
    wanted = [*lists["flag"], *lists["fill"]]
    prep = Preparation(
        drop=lists["drop"],
        flag=lists["flag"],
        fill=lists["fill"],
        fills=clean.fit_fill_values(train, wanted),
        bounds={},
        shifts={},
        encoding={},
        medians={},
        columns=[],
        clip_limits={c: list(r) for c, r in limits.items()},
    )
    filled = clean.fill_missing(train, prep.fills, drop=prep.drop, flag=prep.flag, fill=prep.fill)
    prep.bounds = clean.fit_clip_bounds(filled, clip, rules=limits)
    clipped = clean.clamp_domain(clean.clip_outliers(filled, prep.bounds), limits)
    prep.shifts = clean.fit_log_shift(clipped, logs)
    featured = materialize(clean.log1p_columns(build_features(clipped), prep.shifts), "preparation-features")
    prep.encoding = fit_encoding(featured, rules)
    encoded = clean.replace_infinite(encode_categoricals(featured, prep.encoding))
    prep.medians = clean.fit_numeric_medians(encoded)
    prep.columns = encoded.columns
    return prep
