import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelframe.functions import formulas
from labelframe.operators import encode, explore, train


def test_formulas(spark):
    df = spark.createDataFrame([(90, 3, 4, 0), (None, 0, 0, -1)], "a long, h long, v long, z long")
    sine, cosine = formulas.circular(F.col("a"))
    out = formulas.add_features(
        df,
        {
            "s": sine, "c": cosine,
            "dist": formulas.euclidean(F.col("h"), F.col("v")),
            "diff": formulas.difference(F.col("h"), F.col("v")),
            "mean": formulas.row_mean([F.col("h"), F.col("v"), F.col("z")]),
            "prod": formulas.product(F.col("h"), F.col("v")),
            "ratio": formulas.ratio(F.col("h"), F.col("z")),
        },
        drop=["a"],
    )
    assert "a" not in out.columns
    first, second = out.collect()
    assert math.isclose(first["s"], 1.0) and abs(first["c"]) < 1e-12
    assert (first["dist"], first["diff"], first["prod"], first["ratio"]) == (5.0, -1.0, 12.0, 3.0)
    assert math.isclose(first["mean"], 7 / 3)
    assert second["s"] is None and second["ratio"] is None


def test_one_hot_keeps_all_categories_and_ignores_unseen(spark):
    train = spark.createDataFrame([(3,), (1,), (3,), (None,)], "k long")
    cats = encode.categories(encode.fit_one_hot(train, "k"))
    assert cats == [1, 3]
    out = encode.one_hot(spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id long, k long"), "k", cats)
    assert out.columns == ["id", "k_1", "k_3"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 1.0, 0.0), (2, 0.0, 0.0), (3, 0.0, 0.0)]


def test_sparse_indicators_of_many_categories(spark):
    """12,345 categories, some unseen, one missing: the entries are those of the ordinals."""
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id <> 5 THEN id * 7 % 12345 END AS k", "id % 3 AS x", "CAST(id % 4 AS string) AS s")
    many, few = encode.fit_one_hot(df.where("k % 50 <> 1"), "k"), encode.fit_one_hot(df, "s")
    made = encode.one_hot_vector(df, {"k": many, "s": few}, "vec", dense=["x"])
    assert made.columns == ["id", "k", "x", "s", "vec"]
    size = 1 + many.count() + 4
    place = {r["category"]: r["ordinal"] + 1 for r in many.collect()}
    want = set()
    for r in df.collect():
        want |= {(r["id"], 0, float(r["x"]))} if r["x"] else set()
        want |= {(r["id"], place[r["k"]], 1.0)} if r["k"] in place else set()
        want.add((r["id"], size - 4 + int(r["s"]), 1.0))
    assert {tuple(r) for r in encode.vector_entries(made, "vec", ["id"]).collect()} == want
    assert made.first()["vec"].size == size and size > 12_000


def test_models_take_sparse_vectors(spark):
    df = spark.range(3000).selectExpr("id", "id % 300 AS k", "CAST(id % 300 < 100 AS long) AS label")
    made = encode.one_hot_vector(df, {"k": encode.fit_one_hot(df, "k")}, "vec")
    model = train.train("logistic_regression", made, "label", "vec", {"maxIter": 20})
    assert model.predict(made).where("label = prediction").count() == 3000


def test_too_many_categories_are_refused(spark):
    with pytest.raises(ValueError, match="categories"):
        encode.categories(encode.fit_one_hot(spark.range(20), "id"), max_categories=5)


def test_every_category_is_fitted_and_numbered(spark):
    got = encode.fit_one_hot(spark.range(20_000).selectExpr("id % 12345 AS id"), "id").collect()
    assert {(r["ordinal"], r["category"]) for r in got} == {(i, i) for i in range(12345)}


def test_inverse_takes_the_first_of_equal_indicators(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.2, 0.8), (0.0, 0.0)], "t_7 double, t_12 double")
    assert [r["t"] for r in encode.inverse_one_hot(df, ["t_7", "t_12"], "t").collect()] == [7, 12, 7]


def test_align_rows_shows_a_missing_row_as_null(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, a string")
    b = spark.createDataFrame([(1, 1.0)], "id long, b double")
    assert [tuple(r) for r in encode.align_rows([a, b], "id").orderBy("id").collect()] == [(1, "x", 1.0), (2, "y", None)]


def test_scaler_uses_population_deviation_and_leaves_the_rest(spark):
    df = spark.createDataFrame([(float(i), 5.0, i) for i in (1, 2, 3, 4)], "x double, flat double, other long")
    params = encode.fit_scaler(df, ["x", "flat"])
    assert math.isclose(params.where("column = 'x'").first()["std"], np.std([1, 2, 3, 4]))
    out = encode.apply_scaler(df, params).orderBy("other").collect()
    assert math.isclose(out[0]["x"], -1.5 / np.std([1, 2, 3, 4])) and out[0]["flat"] == 0.0
    assert [r["other"] for r in out] == [1, 2, 3, 4]


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(size=(400, 14)), columns=[f"c{i}" for i in range(14)])
    pdf["c1"] = pdf["c0"] * 2 + rng.normal(size=400) * 0.01 + 1e6
    pdf.loc[::7, "c2"] = np.nan
    pdf["c3"] = 1.5
    pdf["g"] = np.where(np.arange(400) % 3 == 0, "a", "b")
    return pdf, spark.createDataFrame(pdf).repartition(4)


@pytest.mark.parametrize("width, tile", [(4, 512), (14, 512), (14, 5)])
def test_correlations_equal_pandas(mixed, monkeypatch, width, tile):
    monkeypatch.setattr(explore, "TILE", tile)
    pdf, df = mixed
    columns = [f"c{i}" for i in range(width)]
    expected = pdf[columns].corr()
    got = explore.correlations(df, columns).collect()
    assert len(got) == width * width
    for r in got:
        want = expected.loc[r["feature_a"], r["feature_b"]]
        assert (r["r"] is None) == bool(np.isnan(want))
        if r["r"] is not None:
            assert math.isclose(r["r"], want, abs_tol=1e-9)
    strong = explore.strong_pairs(explore.correlations(df, columns)).collect()
    assert [(r["feature_a"], r["feature_b"]) for r in strong] == [("c1", "c0")]


def test_skewness_equals_pandas(mixed):
    pdf, df = mixed
    for r in explore.adjusted_skewness(df, ["c0", "c2"]).collect():
        assert math.isclose(r["skewness"], pdf[r["column"]].skew(), rel_tol=1e-9)


def test_skewness_without_spread_or_rows(mixed):
    _, df = mixed
    assert explore.adjusted_skewness(df, ["c3"]).first()["skewness"] in (None, 0.0)
    assert explore.adjusted_skewness(df.limit(2), ["c0"]).first()["skewness"] is None
    assert explore.adjusted_skewness(df.limit(0), ["c0"]).first()["skewness"] is None


def test_histogram_equals_numpy(mixed, spark):
    pdf, df = mixed
    tenths = pd.DataFrame({"t": np.arange(0, 1001) / 10})
    for name, values, frame in (("c0", pdf["c0"], df), ("c2", pdf["c2"].dropna(), df), ("t", tenths["t"], spark.createDataFrame(tenths))):
        counts, edges = np.histogram(values, bins=50)
        got = explore.histogram(frame, [name], 50).orderBy("bin").collect()
        assert [r["n"] for r in got] == counts.tolist()
        assert np.allclose([r["lower"] for r in got], edges[:-1])
    flat = explore.histogram(df, ["c3"], 4).orderBy("bin").collect()
    assert [r["n"] for r in flat] == np.histogram(np.full(400, 1.5), bins=4)[0].tolist()


def test_box_statistics(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", 7.0)], "g string, v double")
    got = {r["class"]: r for r in explore.box_statistics(df, ["v"], "g").collect()}
    a = got["a"]
    assert (a["n"], a["q25"], a["q50"], a["q75"], a["whisker_low"], a["whisker_high"], a["n_outliers"]) == (5, 2, 3, 4, 1, 4, 1)
    assert got["b"]["n_outliers"] == 0


def test_density_equals_the_kernel_sum(mixed):
    pdf, df = mixed
    got = explore.density(df, ["c0"], "g", grid=20).collect()
    for g in ("a", "b"):
        x = pdf[pdf["g"] == g]["c0"].to_numpy()
        h = x.std(ddof=1) * len(x) ** -0.2
        points = np.linspace(x.min() - 2 * h, x.max() + 2 * h, 20)
        want = np.exp(-0.5 * ((points[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
        mine = sorted((r["point"], r["x"], r["density"]) for r in got if r["class"] == g)
        assert np.allclose([m[1] for m in mine], points) and np.allclose([m[2] for m in mine], want)
    coarse = explore.density(df, ["c0"], "g", grid=20, bins=1000)
    exact = {(r["class"], r["point"]): r["density"] for r in got}
    assert max(abs(r["density"] - exact[(r["class"], r["point"])]) for r in coarse.collect()) < 1e-3


def test_density_of_several_columns_with_far_values(spark):
    """Moments of cells against the kernel sum itself, far tails and copies included."""
    rng = np.random.default_rng(8)
    data = {"a": rng.normal(size=500), "b": np.concatenate([rng.standard_t(1.5, 480), np.full(20, 3.0)]), "c": rng.integers(0, 4, 500) * 1.0}
    pdf = pd.DataFrame({"g": np.where(np.arange(500) % 5 == 0, "p", "q"), **data})
    pdf.loc[7, "a"] = np.nan
    got = explore.density(spark.createDataFrame(pdf).repartition(6), ["a", "b", "c"], "g", grid=200).collect()
    assert len(got) == 3 * 2 * 200
    for g in ("p", "q"):
        for c in data:
            x = pdf[pdf["g"] == g][c].dropna().to_numpy()
            h = x.std(ddof=1) * len(x) ** -0.2
            mine = sorted((r["point"], r["x"], r["density"]) for r in got if r["class"] == g and r["column"] == c)
            points = np.array([m[1] for m in mine])
            want = np.exp(-0.5 * ((points[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
            assert np.abs(np.array([m[2] for m in mine]) - want).max() < 1e-11 / h


def test_density_without_a_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0), ("c", float("inf")), ("c", 1.0), ("d", 1.0), ("d", 2.0)], "g string, v double")
    assert {r["class"] for r in explore.density(df, ["v"], "g", grid=4).collect()} == {"d"}


def test_violin_has_quartiles(mixed):
    pdf, df = mixed
    row = explore.violin(df, ["c0"], "g", grid=5).where("class = 'a'").first()
    assert math.isclose(row["q50"], pdf[pdf["g"] == "a"]["c0"].median())


def test_cross_tab(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 2), (None, 1)], "r string, c long")
    assert {tuple(r) for r in explore.cross_tab(df, "r", "c").collect()} == {("a", 2, 1), ("b", 0, 1)}
    pct = {(r["row"], r["col"]): r["pct"] for r in explore.cross_tab_percent(df, "r", "c").collect()}
    assert math.isclose(pct[("a", 1)], 200 / 3) and pct[("b", 2)] == 100.0
    with pytest.raises(ValueError, match="cross_counts"):
        explore.cross_tab(df, "r", "c", max_columns=1)


def test_sparse_indicators(spark):
    df = spark.createDataFrame([(float(i == 0), float(i < 50)) for i in range(200)], "k_1 double, k_2 double")
    assert [(r["column"], r["n"]) for r in explore.indicator_counts(df, ["k_1", "k_2"]).collect()] == [("k_2", 50.0), ("k_1", 1.0)]
    got = explore.sparse_indicators(df, ["k_1", "k_2"]).collect()
    assert [(r["column"], r["is_extreme"]) for r in got] == [("k_1", True)]


def test_importance_ranking(spark):
    df = spark.createDataFrame([(0, "a", 0.2), (1, "b", 0.0), (2, "c", 0.2)], "ordinal int, feature string, importance double")
    got = explore.importance_ranking(df, 0.1, 2).collect()
    assert [(r["feature"], r["decision"]) for r in got] == [("a", "keep"), ("c", "keep")]
