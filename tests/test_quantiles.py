from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tabloom.functions import quantiles
from tabloom.functions.quantiles import exact_quantiles

POINTS = [0, 0.01, 0.25, 0.5, 0.75, 0.99, 1]


@pytest.mark.parametrize("limits", [{}, {"max_inside": 50, "accuracy": 64}, {"max_inside": 5, "accuracy": 8}])
def test_same_as_pandas_whatever_the_limits(spark, limits):
    rng = np.random.default_rng(3)
    table = pd.DataFrame(
        {
            "normal": rng.normal(size=3000),
            "hot": np.where(rng.random(3000) < 0.4, 7.0, rng.integers(0, 5000, 3000) / 4),
            "few": rng.integers(0, 4, 3000).astype(float),
            "gaps": np.where(rng.random(3000) < 0.7, np.nan, rng.random(3000)),
            "constant": 2.5,
        }
    )
    found = exact_quantiles(spark.createDataFrame(table).repartition(5), list(table), POINTS, **limits)
    for c in table:
        assert found[c] == pytest.approx(table[c].quantile(POINTS).tolist(), abs=1e-12), c


def test_edges_on_values_are_exact(spark):
    df = spark.range(101).select((F.col("id") / 10).alias("x"))
    assert exact_quantiles(df, ["x"], [i / 10 for i in range(11)])["x"] == [float(i) for i in range(11)]


def test_empty_and_missing_columns(frame):
    df = frame([(None, 1.0), (float("nan"), 2.0)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.5]}
    assert exact_quantiles(df.limit(0), ["b"], [0.5]) == {"b": [None]}


def test_long_values_beyond_int(frame):
    df = frame([(2**40,), (2**41,), (2**42,)], "a bigint")
    assert exact_quantiles(df, ["a"], [0.5])["a"] == [float(2**41)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(numbers=st.lists(st.integers(-5, 5), min_size=1, max_size=40))
def test_property_narrowing(spark, numbers):
    df = spark.createDataFrame([(float(n),) for n in numbers], "x double")
    found = exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], max_inside=2, accuracy=8)["x"]
    assert found == pytest.approx(pd.Series(numbers, dtype=float).quantile([0.1, 0.5, 0.9]).tolist(), abs=1e-12)


def test_two_passes_over_the_table(spark):
    """Every row is read twice, however many columns and ranks there are."""
    read = spark.sparkContext.accumulator(0)

    def seen(i):
        read.add(1)
        return float(i * 7919 % 30011)

    df = spark.range(30000).repartition(4).select(F.udf(seen, "double")("id").alias("x"))
    df = df.select("x", *[(F.col("x") * k % 1009).alias(f"x{k}") for k in range(2, 9)])
    found = exact_quantiles(df, df.columns, [i / 10 for i in range(11)], accuracy=128)
    assert read.value == 2 * 30000
    values = sorted(float(i * 7919 % 30011) for i in range(30000))
    assert found["x"][5] == (values[14999] + values[15000]) / 2


def test_a_sketch_that_errs(spark, monkeypatch):
    """Bounds that miss their ranks cost a pass and change no result."""
    sketch = quantiles._sketch

    def wrong(numbers, wanted, accuracy):
        sizes, bounds = sketch(numbers, wanted, accuracy)
        return sizes, [[(3.0, 5.0) for _ in own] for own in bounds]

    monkeypatch.setattr(quantiles, "_sketch", wrong)
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    assert exact_quantiles(df, ["x"], POINTS)["x"] == pytest.approx([999 * p for p in POINTS])


def test_infinities(frame):
    df = frame([float("-inf"), 1.0, 2.0, float("inf"), None], "x double")
    assert exact_quantiles(df, ["x"], [0, Fraction(1, 3), 0.5, 1])["x"] == [float("-inf"), 1.0, 1.5, float("inf")]
