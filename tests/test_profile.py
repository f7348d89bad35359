import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import clean, profile, target, types, validate


@pytest.mark.parametrize(
    "numbers, skew", [([1.0, 2.0, 4.0, 10.0], 1.469), ([1.0, 1.0, 1.0], 0.0), ([0.1] * 7, 0.0), ([1.0, 2.0], None)]
)
def test_skewness(frame, numbers, skew):
    row = profile.numeric_profile(frame(numbers, "x double")).first()
    assert row["skewness"] == skew
    assert row["skew_label"] == ("high" if skew is None or skew >= 1 else "symmetric")


def test_numeric_profile_against_pandas(frame):
    numbers = [3.0, 1.5, None, 8.25, 2.0, 100.0, 4.0, float("nan")]
    row = profile.numeric_profile(frame([(n, None, 1) for n in numbers], "x double, e double, target int")).collect()
    assert [r["column"] for r in row] == ["x"]
    s = pd.Series(numbers, dtype=float)
    got = row[0]
    for name, expected in {
        "missing_pct": 25.0, "mean": s.mean(), "median": s.median(), "std": s.std(), "min": s.min(), "max": s.max(),
        "q1": s.quantile(0.25), "q3": s.quantile(0.75),
    }.items():
        assert got[name] == pytest.approx(expected, abs=5e-5), name
    assert got["outlier_pct"] == pytest.approx(100 / 6, abs=0.01)


def test_missing_profile_levels(frame):
    rows = [(None if i < 70 else 1, None if i < 30 else 1, None if i < 5 else 1, 1) for i in range(100)]
    got = profile.missing_profile(frame(rows, "a int, b int, c int, d int")).collect()
    assert [(r["column"], r["missing_pct"], r["strategy"]) for r in got] == [
        ("a", 70.0, "DROP"),
        ("b", 30.0, "FLAG+MEDIAN"),
        ("c", 5.0, "MEDIAN/MODE"),
    ]


def test_tiny_share_is_listed_as_complete(spark):
    df = spark.range(100_000).select(F.when(F.col("id") > 0, 1).alias("x"))
    assert tuple(profile.missing_profile(df).first()) == ("x", "int", 1, 0.0, "COMPLETE")


def test_categorical_profile(frame):
    df = frame([("b", None, 1), ("a", None, 0), ("a", None, 1), ("b", None, 0), (None, None, 1)], "s string, e string, target int")
    got = {r["column"]: r for r in profile.categorical_profile(df).collect()}
    assert tuple(got["s"])[1:] == (2, "low", 20.0, "a", 50.0)
    assert got["e"]["distinct_values"] == 0 and got["e"]["top_value"] is None
    assert profile.categorical_profile(frame([1], "i int")).count() == 0


def test_average_tie_ranks(frame):
    values = ["w"] * 5 + ["x"] * 3 + ["y"] * 3 + ["z"]
    table = profile.value_table(frame(values, "s string"), ["s"])
    levels = {r["count"]: r["rank"] for r in profile.frequency_levels(table).collect()}
    assert levels == {5: 1.0, 3: 2.5, 1: 4.0}
    grouped = {r["value"]: r["category"] for r in profile.group_rare_values(table, 2).collect()}
    assert grouped == {"w": "w", "x": "OTHER", "y": "OTHER", "z": "OTHER"}


def test_duplicates_and_gate(frame):
    df = frame([None, None, 1], "k int")
    assert tuple(profile.duplicate_count(df).first()) == (3, 1)
    assert profile.duplicate_gate(df, max_ratio=0.5).first()["passed"] is True
    assert profile.duplicate_gate(df).first()["passed"] is False
    assert tuple(profile.duplicate_count(df.limit(0)).first()) == (0, 0)


def test_binary_target(frame):
    df = frame(["bad", "good", None, "skip", "odd", "both"], "s string")
    out = target.make_binary_target(df, "s", ["bad", "both"], ["good", "both"], ["skip"])
    assert {r["s"]: r["target"] for r in out.collect()} == {"bad": 1, "good": 0, "both": 1}
    assert dict(out.dtypes)["target"] == "tinyint"
    roles = {r["value"]: r["role"] for r in target.target_values(df, "s", ["bad", "both"], ["good"], ["skip"]).collect()}
    assert roles == {"bad": "positive", "both": "positive", "good": "negative", "skip": "ignored", None: "unexpected", "odd": "unexpected"}
    summary = target.target_summary(df, "s", ["bad", "both"], ["good"], ["skip"]).first()
    assert tuple(summary) == (True, 2, 1, 66.67, "balanced")
    assert target.target_summary(df, "absent", [], []).first()["passed"] is False


def test_empty_target_has_no_rate(frame):
    row = target.target_summary(frame(["x"], "s string"), "s", ["a"], ["b"]).first()
    assert (row["positive"], row["positive_rate_pct"], row["balance"]) == (0, None, None)


def test_splits(spark):
    df = spark.range(3000).select("id", (F.col("id") % 5).cast("int").alias("y"), (F.col("id") % 7 == 0).cast("int").alias("target"))
    labelled = target.split_by_year(df, "y", train_until=1, val_year=2, test_year=3)
    counts = {r["split"]: r["count"] for r in labelled.groupBy("split").count().collect()}
    assert counts == {"train": 1200, "val": 600, "test": 600, None: 600}
    for split in (target.split_random(df, ["id"]), target.split_stratified(df, ["id"])):
        share = {r["split"]: r["count"] / 3000 for r in split.groupBy("split").count().collect()}
        assert share["test"] == pytest.approx(0.2, abs=0.03) and share["val"] == pytest.approx(0.1, abs=0.03)
    weights = {r["class"]: r["weight"] for r in target.class_weights(df).collect()}
    assert weights[1] == pytest.approx(3000 / (2 * 429))
    assert {r[0] for r in target.add_class_weight(df, weights).select("weight").distinct().collect()} == set(weights.values())


def test_type_recommendations(frame):
    df = frame([(1, 70000, 2**40, None, 1.5, "a", "x"), (2, 1, 1, None, 2.5, "a", "y"), (3, 1, 1, None, 2.5, "a", "z")],
               "s bigint, i bigint, l bigint, n bigint, f double, c string, t string")
    got = {r["column"]: r["suggested_type"] for r in types.recommend_types(df).collect()}
    assert got == {"s": "smallint", "i": "int", "l": "bigint", "n": "bigint", "f": "float", "c": "category", "t": "string"}
    assert dict(types.optimize_types(df).dtypes) == {
        "s": "smallint", "i": "int", "l": "bigint", "n": "bigint", "f": "float", "c": "string", "t": "string"
    }
    approx = {r["column"]: r["suggested_type"] for r in types.recommend_types(df, exact=False).collect()}
    assert approx == got


def test_type_report(frame):
    df = frame([(None, 2.0, [1]), ("b", -0.0, [2]), ("a", 0.0, [1])], "s string, d double, v array<int>")
    got = {r["column"]: tuple(r)[1:] for r in types.type_report(df).collect()}
    assert got["s"] == ("string", 2, 33.33, "a")
    assert got["d"][1] == 2 and got["v"][1] == 2


def test_checks(frame):
    df = frame([(1.0, "a"), (float("inf"), None), (float("nan"), "b")], "x double, s string")
    assert {r["column"]: r["present"] for r in validate.check_schema(df, ["x", "q"]).collect()} == {"x": True, "q": False}
    assert not validate.schema_passes(df, ["x", "q"]) and validate.schema_passes(df, ["x"])
    assert validate.check_leakage_columns(df, ["x", "q"]).first()["leakage_pct"] == 50.0
    got = {r["column"]: tuple(r)[1:] for r in validate.quality_report(df).collect()}
    assert got == {"s": (True, 1, 0, 2), "x": (False, 1, 1, None)}
    assert validate.remaining_categoricals(df) == ["s"]


LONG = "x" * 64


@pytest.mark.parametrize(
    ("texts", "top"),
    [
        (["b", "a", "b", None], ("b", 2, 2)),
        ([LONG + "b", LONG + "a", "z"], (LONG + "a", 3, 1)),
        ([LONG + "b", LONG + "a", LONG + "b", LONG, LONG], (LONG, 3, 2)),
        ([LONG + "b", LONG + "a", LONG + "b", LONG], (LONG + "b", 3, 2)),
        (["y" + LONG, LONG + "é", "y" + LONG, LONG + "é", None], (LONG + "é", 2, 2)),
        (["é" * 70, "é" * 69, "a" * 65], ("a" * 65, 3, 1)),
        ([None, None], (None, None, None)),
    ],
)
def test_top_values(frame, texts, top):
    df = frame([(t,) for t in texts], "t string").repartition(3)
    rows = profile.top_values(df, ["t"]).collect()
    got = tuple(rows[0][c] for c in ("top_value", "distinct_values", "top_count")) if rows else (None, None, None)
    assert got == top


def test_a_digest_is_no_value(spark, frame):
    """A short text that reads like a key is another value; long texts that differ at the end are two."""
    import hashlib

    digest = hashlib.sha256((LONG + "a").encode()).hexdigest()
    df = frame([(LONG + "a",), (digest,), ("#" + digest[:63],), (LONG + "b",), (LONG + "a",)], "t string")
    assert profile.duplicate_count(df).first()["duplicates"] == 1
    assert types.type_report(df).first()["distinct_values"] == 4


def test_long_text_is_not_shuffled(spark, capsys):
    """Exchanges of the plans carry keys, counts and starts, but not the text column."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    long = docs.select("doc_id", "text")
    for frame in (
        profile.duplicate_count(docs, ["text"]),
        clean.deduplicate(long, ["text"], order_by=["doc_id"]).select("doc_id"),
        clean.deduplicate(long, ["text"], keep=False).select("doc_id"),
        clean.deduplicate(docs.drop("doc_id")),
    ):
        frame.explain("formatted")
        plan = capsys.readouterr().out
        for exchange in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan):
            assert not re.search(r"\btext#", exchange), exchange


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_one_of_each_long_row(spark, monkeypatch, limit):
    monkeypatch.setattr(clean, "MAX_BROADCAST_ROWS", limit)
    rows = [("t" * 600 + str(i % 7), None if i % 2 else "k", i % 3) for i in range(200)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "text string, lang string, n int").repartition(5)
    assert sorted(map(tuple, clean.deduplicate(df).collect()), key=str) == sorted(set(rows), key=str)
    assert clean.deduplicate(df, ["text"]).count() == 8
