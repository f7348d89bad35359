import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabloom.operators import boosting, importance, information, select
from tabloom.operators.correlation import correlation_table, target_correlation
from tabloom.operators.target import add_class_weight, class_weights
from tabloom.plans.selection import STEPS, SelectorSettings, fit_selector
from tabloom.sources.fits import load_fit


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(11)
    n = 1200
    risk = rng.normal(size=n)
    return pd.DataFrame(
        {
            "id": np.arange(n),
            "risk": risk,
            "risk_copy": risk * 3 + 1,
            "noise": rng.normal(size=n),
            "holes": np.where(rng.random(n) < 0.99, np.nan, 1.0),
            "flat": 0.1,
            "gappy": np.where(rng.random(n) < 0.3, np.nan, risk + rng.normal(size=n)),
            "city": rng.choice(["a", "b", "c", None], n),
            "flag": rng.random(n) < 0.5,
            "target": (risk + rng.normal(size=n) > 0.5).astype(int),
        }
    )


@pytest.fixture(scope="module")
def train(spark, table):
    rows = table.astype(object).where(table.notna(), None).values.tolist()
    ddl = "id long, risk double, risk_copy double, noise double, holes double, flat double, gappy double, city string, flag boolean, target int"
    return spark.createDataFrame(rows, ddl).repartition(4).persist()


def pandas_iv(x: pd.Series, y: pd.Series, bins: int = 10) -> float:
    """Brute force over the definition, for the fixture."""
    both = pd.DataFrame({"x": x, "y": y}).dropna()
    if pd.api.types.is_numeric_dtype(x):
        both["bin"] = pd.qcut(both["x"], bins, duplicates="drop")
    else:
        both["bin"] = both["x"]
    total = 0.0
    for _, rows in both.groupby("bin", observed=True):
        bad = (rows["y"].sum() + 0.5) / y.sum()
        good = ((1 - rows["y"]).sum() + 0.5) / (1 - y).sum()
        total += (good - bad) * math.log(good / bad)
    return total


def test_information_value(train, table):
    got = {r["column"]: r for r in information.information_value(train, ["risk", "noise", "gappy", "flat", "city"]).collect()}
    for c in ("risk", "noise", "gappy", "city"):
        assert got[c]["iv"] == pytest.approx(pandas_iv(table[c], table["target"]), abs=6e-5), c
    assert tuple(got["flat"]) == ("flat", 0.0, "weak", "numeric")
    assert got["city"]["kind"] == "categorical" and got["risk"]["label"] == "very_strong"


def test_woe_bins_cover_every_row(train, table):
    woe = information.woe_table(train, ["gappy"]).collect()
    assert len(woe) == 10
    assert sum(r["bad"] + r["good"] for r in woe) == table["gappy"].notna().sum()
    assert information.fit_quantile_edges(train, ["gappy"], 4)["gappy"] == pytest.approx(
        table["gappy"].quantile([0, 0.25, 0.5, 0.75, 1]).tolist()
    )


def test_repeated_edges_collapse(frame):
    df = frame([(float(v), v % 2) for v in [0, 0, 0, 0, 0, 0, 1, 2]], "x double, target int")
    assert information.fit_quantile_edges(df, ["x"])["x"][0] == 0.0
    assert len(information.woe_table(df, ["x"]).collect()) == len(information.fit_quantile_edges(df, ["x"])["x"]) - 1


def test_pairwise_complete_correlation(frame):
    df = frame([(1.0, 1.0, 5.0), (None, 2.0, 5.0), (2.0, 2.5, 5.0), (3.0, 2.7, 5.0)], "a double, b double, k double")
    got = {(r["left"], r["right"]): r for r in correlation_table(df, ["a", "b", "k"]).collect()}
    assert got["a", "b"]["correlation"] == pytest.approx(0.914807, abs=1e-6) and got["a", "b"]["pairs"] == 3
    assert got["a", "k"]["correlation"] is None and got["a", "k"]["pairs"] == 3
    assert correlation_table(df.limit(0), ["a", "b"]).first()["correlation"] is None


def test_correlation_against_pandas(train, table):
    columns = ["risk", "noise", "gappy", "holes", "flat"]
    expected = table[columns].corr()
    for r in correlation_table(train, columns).collect():
        want = expected.loc[r["left"], r["right"]]
        if {"flat", "holes"} & {r["left"], r["right"]}:  # both are constant
            assert r["correlation"] is None
        else:
            assert r["correlation"] == pytest.approx(want, abs=1e-9)
    got = {r["column"]: r["correlation"] for r in target_correlation(train, columns).collect()}
    assert got["flat"] is None and got["gappy"] == pytest.approx(abs(table["gappy"].corr(table["target"])), abs=1e-9)


def test_single_steps(train):
    columns = ["risk", "risk_copy", "noise", "holes", "flat", "gappy", "city"]
    assert select.select_by_missing(train, columns) == ["holes"]
    assert select.select_by_variance(train, columns) == ["holes", "flat"]
    assert select.select_by_correlation(train, columns) == ["risk_copy"]
    assert select.drop_by_importance([{"column": c, "importance": i} for c, i in zip("abcde", [0, 1, 2, 3, 4])]) == ["a", "b"]
    assert select.drop_by_permutation([{"column": "a", "importance_mean": 0.0005}, {"column": "b", "importance_mean": 0.1}]) == ["a"]
    assert select.linear_quantile([1, 2, 3, 4], 0.25) == 1.75


def test_undefined_target_correlation_drops_the_first(frame):
    df = frame([(1.0, 2.0, 1), (2.0, 4.0, 1), (3.0, 6.0, 1)], "a double, b double, target int")
    assert select.select_by_correlation(df, ["a", "b"]) == ["a"]
    assert select.select_by_correlation(df.drop("target"), ["a", "b"]) == ["b"]


def test_grouped_auc_counts_ties_half(frame):
    df = frame([("g", 0.1, 0), ("g", 0.5, 1), ("g", 0.5, 0), ("g", 0.9, 1)], "k string, score double, label int")
    assert importance.grouped_auc(df, ["k"]).first()["auc"] == 0.875


def test_stratified_sample(train, table):
    drawn = importance.stratified_sample(train, 400)
    assert drawn.count() == 400
    share = drawn.agg(F.avg("target")).first()[0]
    assert share == pytest.approx(table["target"].mean(), abs=0.01)
    assert importance.stratified_sample(train, 5000).count() == len(table)


def test_importances_find_the_signal(train):
    columns = ["risk", "noise", "gappy"]
    trees = importance.tree_importance(train, columns, trees=5).collect()
    assert trees[0]["column"] == "risk" and sum(r["importance"] for r in trees) == pytest.approx(1.0)
    shuffled = importance.permutation_importance(train, columns, trees=10, repeats=3, sample_size=800).collect()
    assert shuffled[0]["column"] == "risk" and shuffled[0]["importance_mean"] > 0.02
    assert {r["column"] for r in shuffled} == set(columns)


def test_trees_read_equal_rows_once(spark, monkeypatch):
    """Importances are those of all rows; what the trees read does not grow with repeated rows."""
    rows = [(i % 7, float(i % 11) if i % 5 else None, int(i % 7 < 3 or i % 11 > 8)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b double, target int")
    stored, written = importance.materialize, {}

    def counted(frame, label="table"):
        found = stored(frame, label)
        written[label] = found.count()
        return found

    monkeypatch.setattr(importance, "materialize", counted)
    merged = {r["column"]: r["importance"] for r in importance.tree_importance(df, ["a", "b"], trees=3, depth=3).collect()}
    assert written["tree-input"] == len(set(rows)) < 200
    monkeypatch.setattr(importance, "DISTINCT_ROWS", 10)
    plain = {r["column"]: r["importance"] for r in importance.tree_importance(df, ["a", "b"], trees=3, depth=3).collect()}
    assert written["tree-input"] == 3000 and merged == pytest.approx(plain)


def test_trees_are_those_of_spark(spark):
    """The gains of Spark's own boosted trees, without their jobs over all rows for each level of a tree."""
    rng = np.random.default_rng(5)
    data = pd.DataFrame(rng.normal(size=(9000, 5)), columns=list("abcde"))
    data["e"] = rng.integers(0, 4, 9000)
    data["flat"] = 1.0
    data["target"] = (data["a"] + 0.6 * data["b"] * data["c"] + 0.3 * data["e"] + rng.normal(size=9000) > 1).astype(int)
    columns = [*"abcde", "flat"]
    df = spark.createDataFrame(data).repartition(5)
    weights = {r["class"]: r["weight"] for r in class_weights(df).collect()}
    vectors = VectorAssembler(inputCols=columns, outputCol="x").transform(add_class_weight(df, weights))
    model = GBTClassifier(featuresCol="x", labelCol="target", weightCol="weight", maxIter=12, stepSize=0.3, maxDepth=3).fit(vectors)
    got = boosting.split_gains(df, columns, weights, label="target", trees=12, step=0.3, depth=3)
    assert got == pytest.approx(model.featureImportances.toArray().tolist(), abs=1e-9)


def test_tree_importance_is_one_of_all_rows(spark):
    """The bins are not from a drawn part of the rows, so the way they are dealt out makes no difference; five jobs a tree."""
    rng = np.random.default_rng(6)
    data = pd.DataFrame(rng.normal(size=(30_000, 3)), columns=list("abc"))
    data["target"] = (data["a"] + 0.5 * data["b"] + rng.normal(size=30_000) > 0).astype(int)
    df = spark.createDataFrame(data)
    context, found = spark.sparkContext, []
    for parts in (3, 7):
        dealt = df.repartition(parts).persist()
        context.setJobGroup(f"trees-{parts}", "")
        found.append({r["column"]: r["importance"] for r in importance.tree_importance(dealt, ["a", "b", "c"], trees=20).collect()})
        context.setLocalProperty("spark.jobGroup.id", None)
        assert 20 * 4 < len(context.statusTracker().getJobIdsForGroup(f"trees-{parts}")) <= 20 * 5 + 25
    assert found[0] == pytest.approx(found[1], abs=1e-9)


def test_bins_of_many_values_come_from_all_rows(spark, monkeypatch):
    """Ranks of the edges are those of all rows, also where a task keeps few of its values."""
    monkeypatch.setattr(boosting, "POINTS", 500)
    n = 40_000
    df = spark.range(n).select(
        (F.col("id") * 7919 % n).cast("double").alias("x0"),
        F.when(F.col("id") % 2 == 0, float("inf")).otherwise(float("-inf")).alias("x1"),
        F.lit(0.0).alias("y"),
        F.lit(None).cast("double").alias("copies"),
    )
    edges, endless = boosting._fit_edges(df, 2, np.array([2.0, 1.0]), 32)
    assert len(edges) == 31 and len(endless) == 1
    assert edges.tolist() == pytest.approx([n / 32 * (i + 1) for i in range(31)], abs=2 * n / 500)


def test_columns_without_a_split_have_no_importance(spark):
    df = spark.createDataFrame([(1.0, None, i % 2) for i in range(50)], "a double, b double, target int")
    assert {r["column"]: r["importance"] for r in importance.tree_importance(df, ["a", "b"], trees=2).collect()} == {"a": 0.0, "b": 0.0}
    with pytest.raises(ValueError):
        importance.tree_importance(df.withColumn("target", F.lit(3)), ["a"], trees=2)


def test_funnel(spark, train, tmp_path):
    chosen = fit_selector(train, SelectorSettings(exclude=("id",)), importance_trees=5, run_permutation=False)
    assert chosen.dropped["missing"] == ["holes"]
    assert chosen.dropped["variance"] == ["flat"]
    assert chosen.dropped["correlation"] == ["risk_copy"]
    assert {"flag", "city"} <= set(chosen.dropped["iv"])
    assert "risk" in chosen.selected
    assert sorted([*chosen.selected, *sum(chosen.dropped.values(), [])]) == sorted(chosen.candidates)

    assert chosen.transform(train).columns == ["id", *chosen.selected, "target"]
    assert chosen.transform(train.drop("target", "risk"), include_target=True).columns == ["id", *[c for c in chosen.selected if c != "risk"]]

    fall = chosen.waterfall(spark).orderBy("step_no").collect()
    assert [r["step"] for r in fall] == ["candidates", *STEPS]
    assert fall[-1]["remaining"] == len(chosen.selected)

    report = chosen.report(spark).collect()
    assert [r["status"] for r in report] == sorted(r["status"] for r in report)
    folder = str(tmp_path / "artifacts")
    chosen.save(spark, folder)
    assert load_fit(spark, f"{folder}/selected_features.json", list) == chosen.selected
    assert load_fit(spark, f"{folder}/dropped_features.json")["detail"] == chosen.dropped
    assert spark.read.csv(f"{folder}/feature_selection_report.csv", header=True).count() == len(chosen.candidates)
    assert spark.read.csv(f"{folder}/iv_scores.csv", header=True).count() > 0


def test_one_class_skips_information_value(spark, train):
    chosen = fit_selector(
        train.withColumn("target", F.lit(1)), exclude=("id",), run_importance=False, run_permutation=False, reuse=False
    )
    assert chosen.iv == [] and chosen.dropped["iv"] == []


def test_bins_are_exact_fractions(frame):
    df = frame([(float(i),) for i in range(31)], "x double")
    assert information.fit_quantile_edges(df, ["x"], 3)["x"] == [0.0, 10.0, 20.0, 30.0]
    assert Fraction("0.1") == Fraction(1, 10)


def test_infinite_values_fall_into_the_outer_bins(frame):
    rows = [(float(i), i % 2) for i in range(20)] + [(float("inf"), 1)] * 3 + [(float("-inf"), 0)] * 3
    woe = information.woe_table(frame(rows, "x double, target int"), ["x"], bins=4).collect()
    assert sum(r["bad"] + r["good"] for r in woe) == 26


def test_infinite_values(spark):
    inf = float("inf")
    data = pd.DataFrame({"x": [1.0, 2, 3, inf, 5, 6], "y": [2.0, 1, 4, 3, 6, -inf], "target": [0, 1, 0, 1, 1, 1]})
    df = spark.createDataFrame(data)
    finite = data.replace([inf, -inf], np.nan)
    assert select.select_by_variance(df, ["x", "y", "target"]) == ["x", "y"]
    row = correlation_table(df, ["x", "y"]).first()
    assert row["pairs"] == 4 and row["correlation"] == pytest.approx(finite.corr().loc["x", "y"])
    scores = {r["column"]: r["correlation"] for r in target_correlation(df, ["x", "y"]).collect()}
    assert scores["x"] == pytest.approx(abs(finite.corr().loc["x", "target"]))


def test_correlation_of_many_columns(spark):
    rng = np.random.default_rng(4)
    data = pd.DataFrame(rng.normal(size=(60, 300)), columns=[f"c{i}" for i in range(300)])
    data.iloc[::7, 5] = np.nan
    data["c299"] = data["c0"] * 2
    rows = correlation_table(spark.createDataFrame(data).repartition(4), list(data)).collect()
    assert [(r["left"], r["right"]) for r in rows[:2]] == [("c0", "c1"), ("c0", "c2")]
    want = data.corr().to_numpy()
    got = np.array([r["correlation"] for r in rows])
    assert len(rows) == 300 * 299 // 2
    assert np.allclose(got, want[np.triu_indices(300, 1)], atol=1e-9)
