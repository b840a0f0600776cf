import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelframe.operators import profile
from labelframe.operators.quantiles import quantiles


@pytest.fixture(scope="module")
def gaps(spark):
    rows = [(1, 1.0, "a"), (2, float("nan"), "b"), (3, None, "a"), (4, -2.0, None), (4, -2.0, None)]
    return spark.createDataFrame(rows, "id long, x double, s string")


def test_missing_counts_null_and_nan(gaps):
    got = {r["column"]: r["n_missing"] for r in profile.missing_counts(gaps).collect()}
    assert got == {"id": 0, "x": 2, "s": 2}


def test_duplicates_count_later_copies(gaps):
    assert profile.duplicate_count(gaps).first()[0] == 1
    assert profile.duplicate_count(gaps.limit(0)).first()[0] == 0
    assert profile.duplicate_count(gaps, max_repeated=0).first()[0] == 1
    assert profile.duplicate_count(gaps, ["s"]).first()[0] == 2


def test_duplicates_see_equal_zeros(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (1.0,)], "x double")
    assert profile.duplicate_count(df).first()[0] == 2


def test_ranges_skip_nan(gaps):
    got = {r["column"]: (r["min"], r["max"]) for r in profile.value_ranges(gaps, ["x"]).collect()}
    assert got == {"x": (-2.0, 1.0)}


def test_negative_audit_has_status(gaps):
    got = {r["column"]: (r["n_negative"], r["status"]) for r in profile.negative_audit(gaps, ["id", "x"]).collect()}
    assert got == {"id": (0, "CLEAN"), "x": (2, "2 negatives")}


def test_describe_equals_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(size=501), "b": rng.integers(0, 9, 501)})
    expected = pdf.describe()
    got = profile.describe(spark.createDataFrame(pdf)).toPandas().set_index("column")
    for c in pdf.columns:
        for ours, theirs in {"count": "count", "mean": "mean", "std": "std", "min": "min", "q25": "25%",
                             "q50": "50%", "q75": "75%", "max": "max"}.items():
            assert math.isclose(got.loc[c, ours], expected.loc[theirs, c], rel_tol=1e-12), (c, ours)


def test_describe_of_empty_table(spark):
    row = profile.describe(spark.createDataFrame([], "a double")).first()
    assert row["count"] == 0 and row["mean"] is None and row["q50"] is None


def test_refined_quantiles_are_exact_per_group(spark):
    rng = np.random.default_rng(2)
    heavy = np.concatenate([rng.pareto(0.3, 3000), np.full(2000, 4.0), [-1e300, 1e300, 0.0, -0.0]])
    pdf = pd.DataFrame({"g": np.where(np.arange(len(heavy)) % 3 == 0, "p", None), "v": heavy, "w": -heavy})
    df = spark.createDataFrame(pdf, "g string, v double, w double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = quantiles(df, ["v", "w"], probs, by=["g"], bins=16, small=10).collect()
    assert len(got) == 4
    for r in got:
        part = pdf[pdf["g"] == r["g"]] if r["g"] else pdf[pdf["g"].isna()]
        assert np.allclose(r["q"], np.quantile(part[r["column"]], probs), rtol=1e-12)


@pytest.mark.parametrize("small", [1, 50, 10_000])
def test_rows_do_not_depend_on_sizes(spark, small):
    """A column without values and a group without values have their row, however large the neighbours are."""
    rows = [("big", float(i), None) for i in range(500)] + [("small", 1.0, None), ("small", 2.0, None), (None, 7.0, None), ("none", None, None)]
    df = spark.createDataFrame(rows, "g string, v double, empty double")
    got = {(r["g"], r["column"]): r["q"] for r in quantiles(df, ["v", "empty"], [0.5], by=["g"], small=small, bins=8).collect()}
    assert got == {
        ("big", "v"): [249.5], ("small", "v"): [1.5], (None, "v"): [7.0], ("none", "v"): None,
        **{(g, "empty"): None for g in ("big", "small", "none", None)},
    }
    whole = {r["column"]: r["q"] for r in quantiles(df, ["v", "empty"], [0.0, 1.0], small=small, bins=8).collect()}
    assert whole == {"v": [0.0, 499.0], "empty": None}


@pytest.mark.parametrize("n", [1, 2, 7, 333, 334, 399, 401, 5003, 39_999, 40_001])
def test_ranks_lie_inside_their_brackets(spark, n):
    values = np.random.default_rng(n).permutation(n) * 1.0
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(7)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    assert np.allclose(quantiles(df, ["v"], probs).first()["q"], np.quantile(values, probs), rtol=0, atol=1e-9)


def test_passes_do_not_depend_on_the_values(spark, monkeypatch):
    """Values over 600 decades take as many passes as evenly spread ones, two; narrow limits add a few."""
    module = __import__("labelframe.operators.quantiles", fromlist=["x"])
    written = []
    real = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df: (written.append(1), real(df))[1])
    for values in (10.0 ** np.linspace(-300, 300, 4000), np.arange(4000.0)):
        df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(4)
        for small, most in ((200_000, 2), (50, 6)):
            written.clear()
            assert np.allclose(quantiles(df, ["v"], [0.5], bins=100, small=small).first()["q"], np.quantile(values, [0.5]), rtol=1e-12)
            assert len(written) <= most


def test_quantiles_of_many_groups(spark):
    df = spark.range(30_000).selectExpr("id % 10000 AS g", "CAST(id AS DOUBLE) AS v")
    got = quantiles(df, ["v"], [0.5], by=["g"]).collect()
    assert len(got) == 10_000 and all(r["q"] == [r["g"] + 10_000.0] for r in got)


def test_quantiles_with_infinities(spark):
    values = [float("-inf"), float("inf")] + [float(i) for i in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert quantiles(df, ["v"], [0.0, 0.5, 1.0], bins=4, small=3).first()["q"] == [float("-inf"), 49.5, float("inf")]


def test_quantiles_skip_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    assert quantiles(df, ["v"], [0.5]).first()["q"] == [2.0]
    assert quantiles(df, ["v"], [0.5], small=0).first()["q"] == [2.0]


def test_class_shares_and_comparison(spark):
    before = spark.createDataFrame([("a",)] * 3 + [("b",)], "c string")
    after = spark.createDataFrame([("a",)] * 3 + [("b",)] * 3 + [("n",)], "c string")
    assert {r["class"]: r["pct"] for r in profile.class_distribution(before, "c").collect()} == {"a": 75.0, "b": 25.0}
    got = {r["class"]: (r["added"], r["status"]) for r in profile.compare_distributions(before, after, "c").collect()}
    assert got == {"a": (0, "unchanged"), "b": (2, "resampled"), "n": (1, "resampled")}
    assert [r["class"] for r in profile.minority_flags(before, "c", 3).where("is_minority").collect()] == ["b"]
    assert profile.balance_ratio(before, "c").first()["ratio"] == 3.0


def test_head_tail_and_distinct(spark):
    df = spark.range(100).withColumn("m", F.col("id") % 7)
    assert [r["id"] for r in profile.head(df, ["id"], 3).collect()] == [0, 1, 2]
    assert [r["id"] for r in profile.tail(df, ["id"], 3).collect()] == [99, 98, 97]
    assert [r["n_distinct"] for r in profile.distinct_counts(df, ["id", "m"]).orderBy("ordinal").collect()] == [100, 7]
    named = profile.name_classes(profile.value_counts(df, "m"), {0: "zero"}, "value")
    assert named.where("class_name = 'zero'").first()["n"] == 15
