import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.functions.columns import nan_to_null, safe_divide
from tabloom.operators import clean


def test_cut_bins(frame, values):
    df = frame([0.0, 1.0, 1.0, 2.0, 5.0, None, -1.0, 6.0], "x double")
    assert values(clean.cut_bins(df, "x", "b", [0, 1, 5], ["a", "b"]), "b") == ["a", "a", "a", "b", "b", None, None, None]
    expected = pd.cut(pd.Series([0, 1, 1, 2, 5, None, -1, 6]), [0, 1, 5], labels=["a", "b"], include_lowest=True)
    assert expected.astype(object).where(expected.notna(), None).tolist() == ["a", "a", "a", "b", "b", None, None, None]


def test_cut_bins_errors(frame):
    df = frame([(1.0, "t")], "x double, s string")
    with pytest.raises(ValueError):
        clean.cut_bins(df, "nope", "b", [0, 1], ["a"])
    with pytest.raises(TypeError):
        clean.cut_bins(df, "s", "b", [0, 1], ["a"])
    with pytest.raises(ValueError):
        clean.cut_bins(df, "x", "b", [0, 1, 2], ["a"])


def test_clip_swapped_bounds_and_idempotence(frame, values):
    df = frame([1.0, 5.0, 9.0, None], "x double")
    bounds = {"x": {"low": 8.0, "high": 2.0}}
    once = clean.clip_outliers(df, bounds)
    assert values(once, "x") == [2.0, 5.0, 8.0, None]
    assert values(clean.clip_outliers(once, bounds), "x") == [2.0, 5.0, 8.0, None]
    assert dict(once.dtypes)["x"] == "float"


def test_clip_bounds_follow_rules(frame):
    df = frame([(float(i),) for i in range(-50, 151)], "dti double")
    bounds = clean.fit_clip_bounds(df, ["dti", "absent"], rules={"dti": (0, 100)})
    assert bounds == {"dti": {"low": 0.0, "high": 100.0}}


def test_mode_takes_the_smallest_of_a_tie(frame):
    df = frame([("b", None), ("a", None), ("a", None), ("b", None)], "s string, e string")
    assert clean.fit_fill_values(df, ["s", "e", "absent"]) == {"s": "a", "e": None}


def test_fill_missing_flags_before_filling(frame):
    df = frame([(1.0, None, "k", 5), (None, "x", None, None), (3.0, None, "k", 6)], "a double, b string, c string, i int")
    fills = clean.fit_fill_values(df, ["a", "c", "i"])
    out = clean.fill_missing(df, fills, drop=["b", "zz"], flag=["a", "zz"], fill=["c", "i"])
    assert out.columns == ["a", "c", "i", "a_MISSING"]
    assert [tuple(r) for r in out.collect()] == [(1.0, "k", 5.0, 0), (2.0, "k", 5.5, 1), (3.0, "k", 6.0, 0)]


def test_percentages(frame, values):
    df = frame(["13%", None, " 7.5% ", "x", "1d", "", "-2.5 %", "1e1%"], "p string")
    assert values(clean.parse_percentages(df, ["p", "absent"]), "p") == [13.0, None, 7.5, None, None, None, -2.5, 10.0]
    assert values(clean.parse_percentages(frame(["50%"], "p string"), ["p"], divide=True), "p") == [0.5]
    assert values(clean.parse_percentages(frame([(4.5,)], "p double"), ["p"]), "p") == [4.5]


def test_dates(frame):
    df = frame(["dec-2018", " Dec-2018", "12-2018", None], "d string")
    rows = clean.parse_dates(df, ["d"], reference="2018-12-01", format="MMM-yyyy").collect()
    assert [tuple(r) for r in rows] == [(2018.0, 12.0, 0.0), (None,) * 3, (None,) * 3, (None,) * 3]


def test_day_gap_is_floored_on_the_time_difference(spark):
    df = spark.sql("SELECT explode(array(timestamp'2018-11-30 10:00:00', timestamp'2018-12-01 10:00:00')) AS t")
    rows = clean.parse_dates(df, ["t"], reference="2018-12-01").collect()
    assert [round(r["t_months_since"] * 30) for r in rows] == [0, -1]


def test_normalize_strings(frame):
    df = frame([("  A\t", 1), (None, 2), (" Bé \n", 3)], "s string, i int")
    assert [r["s"] for r in clean.normalize_strings(df).collect()] == ["a", None, "bé"]
    assert [r["s"] for r in clean.normalize_strings(df, ["s", "i"], lower=False).collect()] == ["A", None, "Bé"]
    assert [r["s"] for r in clean.normalize_strings(df, strip_text=False).collect()] == ["  a\t", None, " bé \n"]


@pytest.mark.parametrize("keep, ids", [("first", [1, 3]), ("last", [2, 3]), (False, [3])])
def test_deduplicate_nulls_are_equal(frame, keep, ids):
    df = frame([(None, 1), (None, 2), (1, 3)], "k int, id int")
    kept = clean.deduplicate(df, ["k"], keep=keep, order_by=["id"])
    assert sorted(r["id"] for r in kept.collect()) == ids


def test_deduplicate_whole_rows(frame):
    assert clean.deduplicate(frame([(1, "a"), (1, "a"), (1, None), (1, None)], "k int, s string")).count() == 2


def test_hot_key_is_thinned_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).alias("k"), "id")
    plan = clean.deduplicate(df, ["k"], order_by=["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange")  # printed top-down: the limit runs below the exchange


def test_primary_key(frame):
    df = frame([(None,), (None,), (1,), (1,), (2,)], "id int")
    renamed = clean.set_primary_key(df, "id")
    assert renamed.columns == ["pk"] and clean.set_primary_key(df, "absent").columns == ["id"]
    assert tuple(clean.primary_key_check(renamed, "pk").first()) == (5, 2, 2)


def test_drop_leakage_takes_list_and_dict(frame):
    df = frame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    assert clean.drop_leakage(df, ["a", "zz"], rules={"drop": ["b"]}).columns == ["c", "d"]
    assert clean.drop_leakage(df, ["a"], rules={"drop": {"x": ["b"], "y": ["c"]}}, extra=["zz"]).columns == ["d"]


def test_logs(frame):
    train = frame([(-5.0, 1.0), (3.0, None)], "a double, b double")
    shifts = clean.fit_log_shift(train, ["a", "b", "absent"])
    assert shifts == {"a": 5.0 + 1e-9, "b": 0.0}
    row = clean.log1p_columns(frame([(3.0, None), (-7.0, -1.0)], "a double, b double"), shifts).collect()
    assert row[0]["a_LOG"] == pytest.approx(math.log1p(8.0), rel=1e-6) and row[0]["b_LOG"] is None
    assert row[1]["a_LOG"] is None and row[1]["b_LOG"] is None


def test_nan_and_infinity(frame, values):
    df = frame([float("nan"), float("inf"), float("-inf"), None, 1.0], "x double")
    assert values(clean.replace_infinite(df), "x") == [None, None, None, None, 1.0]
    assert values(nan_to_null(df), "x") == [None, float("inf"), float("-inf"), None, 1.0]


def test_safe_divide(frame):
    df = frame([(1.0, 2.0), (1.0, 0.0), (1.0, 1e-10), (1.0, float("inf")), (1.0, float("nan")), (None, 2.0)], "n double, d double")
    got = [r[0] for r in df.select(safe_divide(F.col("n"), F.col("d"))).collect()]
    assert got == [0.5, None, None, None, None, None]


def test_domain_clamp_keeps_type(frame):
    df = frame([(-5, 600), (120, 100)], "dti int, loan int")
    out = clean.clamp_domain(df, {"dti": (0, 100), "loan": (500, None), "absent": (0, 1)})
    assert [tuple(r) for r in out.collect()] == [(0, 600), (100, 500)]
    assert dict(out.dtypes) == {"dti": "int", "loan": "int"}


def test_no_nulls_left_after_fill(frame):
    df = frame([(1.0, "a"), (None, None), (4.0, "b"), (float("nan"), "a")], "x double, s string")
    out = clean.fill_missing(df, clean.fit_fill_values(df, df.columns), fill=df.columns)
    assert out.where("x IS NULL OR isnan(x) OR s IS NULL").count() == 0


def test_numeric_medians_only_where_needed(frame):
    df = frame([(1.0, 1.0), (None, 2.0), (5.0, 3.0)], "x double, y double")
    assert clean.fit_numeric_medians(df) == {"x": 3.0}


WRITTEN = [
    (["Dec-2015", "Jan-1999"], "MMM-yyyy", (2015.0, 12.0)),
    (["12/31/2015", "1/2/2016"], "M/d/yyyy", (2015.0, 12.0)),
    (["31/12/2015", "1/2/2016", "2/2/2016"], "d/M/yyyy", (2015.0, 12.0)),
    (["31 Dec 2015", "1 feb 2016"], "d MMM yyyy", (2015.0, 12.0)),
    (["Dec 31, 2015", "MAY 1, 2016"], "MMM d, yyyy", (2015.0, 12.0)),
    (["2015-12-31 23:59:59", "2015-12-30 00:00:00"], "yyyy-MM-dd HH:mm:ss", (2015.0, 12.0)),
    (["20151231"], "yyyyMMdd", (2015.0, 12.0)),
    (["Dec-15"], "MMM-yy", (2015.0, 12.0)),
    (["2015"], "yyyy", (2015.0, 1.0)),
    ([" 01/02/2015 "], "M/d/yyyy", (2015.0, 1.0)),
]


@pytest.mark.parametrize(("texts", "pattern", "first"), WRITTEN)
def test_date_formats_are_voted_for(frame, texts, pattern, first):
    df = frame([*[(t,) for t in texts], (None,), ("",), ("not a date",), ("x" * 5000,)], "d string").repartition(3)
    assert clean.fit_date_formats(df, ["d", "absent"]) == {"d": pattern}
    rows = clean.parse_dates(df.where(df.d == texts[0]), ["d"], format={"d": pattern}).collect()
    assert (rows[0]["d_year"], rows[0]["d_month"]) == first
    assert clean.infer_dates(df, ["d"]).where("d_year is null").count() == 4


def test_date_formats_of_nothing(frame):
    assert clean.fit_date_formats(frame([(None,), ("?",)], "d string"), ["d"]) == {"d": None}
    assert clean.fit_date_formats(frame([], "d string"), ["d"]) == {"d": None}
    assert clean.fit_date_formats(frame([(1,)], "d int"), ["d"]) == {}
