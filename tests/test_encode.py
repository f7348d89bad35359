import pytest
from pyspark.sql import functions as F

from tabloom.operators import encode
from tabloom.operators.features import Feature, FormulaError, add_features, add_formulas
from tabloom.plans import loan


def test_ordinal(frame, values):
    df = frame([" A ", "B", "Z", None], "g string")
    assert values(encode.ordinal_encode(df, "g", {"A": 1, "B": 2}), "g") == [1.0, 2.0, -1.0, None]
    assert values(encode.ordinal_encode(df, "g", {}), "g") == [-1.0, -1.0, -1.0, None]


def test_large_map_goes_through_a_join(frame):
    mapping = {f"v{i}": i for i in range(2000)}
    out = encode.ordinal_encode(frame([("v7", 1), ("no", 2), (None, 3)], "g string, id int"), "g", mapping)
    assert out.columns == ["g", "id"]
    assert {r["id"]: r["g"] for r in out.collect()} == {1: 7.0, 2: -1.0, 3: None}


def test_one_hot_names_and_values(frame):
    df = frame(["b", "a", None], "x string")
    vocabulary = encode.fit_one_hot(df, ["x", "absent"])
    out = encode.one_hot_encode(df, vocabulary)
    assert out.columns == ["x_a", "x_b", "x_nan"]
    assert [sum(r) for r in out.collect()] == [1, 1, 1]
    assert set(dict(out.dtypes).values()) == {"tinyint"}
    assert encode.one_hot_encode(frame(["b", "a"], "x string"), vocabulary, drop_first=True).columns == ["x_b", "x_nan"]
    unseen = encode.one_hot_encode(frame(["new"], "x string"), vocabulary)
    assert tuple(unseen.first()) == (0, 0, 0)
    assert encode.one_hot_encode(df, vocabulary, null_column=False).columns == ["x_a", "x_b"]


def test_one_hot_limit(frame):
    df = frame([f"v{i}" for i in range(5)], "x string")
    assert len(encode.fit_one_hot(df, ["x"], max_categories=5)["x"]) == 5
    with pytest.raises(ValueError, match="more than 4"):
        encode.fit_one_hot(df, ["x"], max_categories=4)


def test_groups_later_wins(frame):
    rules = {"p": {"one": ["a", "b"], "two": ["b"]}}
    df = frame(["a", "b", "c", None], "p string")
    groups = encode.fit_groups(df, rules)
    assert groups == {"p": ["one", "other", "two"]}
    out = encode.group_one_hot_encode(df, "p", rules["p"], groups["p"])
    assert out.columns == ["p_one", "p_other", "p_two", "p_nan"]
    assert [tuple(r) for r in out.collect()] == [(1, 0, 0, 0), (0, 0, 1, 0), (0, 1, 0, 0), (0, 0, 0, 1)]
    assert [tuple(r) for r in encode.unseen_counts(df, {"group_one_hot": rules}).collect()] == [("p", 1)]


def test_fit_on_train_apply_anywhere_then_align(frame):
    rules = {"ordinal": {"g": {"A": 1}}, "one_hot": ["h", "absent"], "group_one_hot": {"p": {"k": ["x"]}}}
    train = frame([("A", "r", "x"), ("A", "o", "x")], "g string, h string, p string")
    fit = encode.fit_encoding(train, rules)
    encoded = encode.encode_categoricals(train, fit)
    test = encode.encode_categoricals(frame([("B", "new", "y", 1)], "g string, h string, p string, extra int"), fit)
    aligned = encode.align_columns(test, [*encoded.columns, "made_up"])
    assert aligned.columns == [*encoded.columns, "made_up"]
    assert aligned.first().asDict() == {
        "g": -1.0, "h_o": 0, "h_r": 0, "h_nan": 0, "p_k": 0, "p_nan": 0, "made_up": 0
    }


def test_target_encoding(frame):
    rows = [(f"c{i % 12}", 1 if i % 12 == 0 else 0, i) for i in range(24)]
    train = frame(rows, "c string, target int, id int")
    rates, overall = encode.fit_target_encoding(train, ["c"])
    out = encode.target_encode(frame([("c0", 1), ("c1", 2), ("new", 3), (None, 4)], "c string, id int"), rates, overall, ["c"])
    got = {r["id"]: r["c"] for r in out.collect()}
    assert got == {1: 1.0, 2: 0.0, 3: pytest.approx(1 / 12), 4: None}
    few, _ = encode.fit_target_encoding(frame([("a", 1), ("b", 0)], "c string, target int"), ["c"])
    assert few.count() == 0


def test_features_need_their_inputs(frame):
    df = frame([(1200.0, 100.0, 10.0)], "annual_inc double, loan_amnt double, installment double")
    out = loan.build_features(df)
    assert out.columns == [*df.columns, "income_to_loan_ratio", "installment_to_income"]
    assert tuple(out.first())[3:] == (12.0, pytest.approx(0.1))
    assert dict(out.dtypes)["income_to_loan_ratio"] == "float"


def test_interactions_make_the_average_first(frame):
    df = frame([(600.0, 604.0, 10.0, 3.0)], "fico_range_low double, fico_range_high double, int_rate double, revol_util double")
    row = loan.add_interactions(df).first()
    assert (row["fico_avg"], row["fico_x_intrate"], row["revol_util_sq"]) == (602.0, 6020.0, 9.0)
    assert "fico_avg" not in loan.add_interactions(df, need_fico_avg=False).columns


def test_feature_on_feature_sees_single_precision(frame):
    recipe = [Feature("third", "scaled", ("a",), 3), Feature("again", "product", ("third", "third"))]
    row = add_features(frame([(1.0,)], "a double"), recipe).first()
    assert row["again"] == pytest.approx(row["third"] ** 2, rel=1e-7)
    with pytest.raises(ValueError):
        Feature("x", "unknown", ("a",)).expression()


def test_formulas(frame):
    df = frame([(6.0, 0.0, 3.0), (6.0, 2.0, float("nan"))], "a double, b double, c double")
    out = add_formulas(df, {"q": "a / b", "p": "a ** 2 + 1", "m": "(a + b) / 2", "n": "a / (b + c)", "skip": "a / zz"})
    assert out.columns == ["a", "b", "c", "q", "p", "m", "n"]
    assert [tuple(r)[3:] for r in out.collect()] == [(None, 37.0, 3.0, 2.0), (3.0, 37.0, 4.0, None)]


def test_preparation_round_trip(spark, frame):
    rows = [
        ("Fully Paid" if i % 3 else "Default", float(1000 + i), None if i % 4 == 0 else float(i * 10), f"{i % 30}.5%", "ABC"[i % 3],
         " 36 months", "own" if i % 2 else None, f"{'Jan' if i % 2 else 'Feb'}-{2010 + i % 9}")
        for i in range(90)
    ]
    df = frame(
        rows,
        "loan_status string, loan_amnt double, annual_inc double, int_rate string, grade string, term string, home_ownership string, issue_d string",
    )
    formatted = loan.parse_formats(loan.label(df).drop("loan_status"))
    train = formatted.where("issue_d_year <= 2016")
    prep = loan.fit_preparation(train, clip=["annual_inc"])
    again = loan.Preparation.from_fit(prep.as_fit())
    out = again.apply(formatted)
    assert out.columns == prep.columns
    assert out.count() == 90
    holes = out.select(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c, t in out.dtypes if t != "string"]).first()
    assert set(holes) == {0}


def test_formulas_of_any_shape(frame):
    df = frame([(4.0, 2.0, 3.0), (1.0, 0.0, 2.0)], "a double, b double, c double")
    out = add_formulas(
        df,
        {
            "q": "a ** 2 / b ** 2", "w": "a / b ** 2", "p": "a ** c", "k": "a / abs(b)", "s": "a / 1e-12",
            "m": "-a % 3", "g": "max(a, b, c) - min(a, b)", "absent": "a + nope",
        },
    )
    rows = [tuple(r)[3:] for r in out.collect()]
    assert "absent" not in out.columns
    assert rows[0] == (4.0, 1.0, 64.0, 2.0, pytest.approx(4e12), 2.0, 2.0)
    assert rows[1] == (None, None, 1.0, None, pytest.approx(1e12), 2.0, 2.0)


@pytest.mark.parametrize("text", ["a +", "a if b else c", "__import__('x')", "a.b", "foo(a)", "'x'", "True"])
def test_formulas_that_cannot_be_read(frame, text):
    with pytest.raises(FormulaError):
        add_formulas(frame([(1.0, 2.0)], "a double, b double"), {"x": text})


@pytest.mark.parametrize("limit", [200_000, 2])
def test_target_encoding_keeps_unfitted_columns(frame, monkeypatch, limit):
    """On either side of the size check; NULLs and a frequent value included."""
    monkeypatch.setattr(encode, "MAX_BROADCAST_RATES", limit)
    rows = [(i, None if i % 5 == 0 else i % 13 if i % 2 else 3, "ab"[i % 2], int(i % 3 == 0)) for i in range(400)]
    train = frame(rows, "id int, many int, few string, target int")
    rates, overall = encode.fit_target_encoding(train, ["many", "few"])
    got = {r["id"]: (r["many"], r["few"]) for r in encode.target_encode(train, rates, overall, ["many", "few"]).collect()}
    mean = {m: [t for _, k, _, t in rows if k == m] for m in {r[1] for r in rows}}
    for i, many, few, _ in rows:
        want = None if many is None else pytest.approx(sum(mean[many]) / len(mean[many]))
        assert got[i] == (want, few)
