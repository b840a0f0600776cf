"""Multinomial boosting against the same rule in numpy, row by row of the definition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelframe.operators import boosting, evaluate, train

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def noisy(spark):
    """400 rows of three classes that the features tell apart in part; few distinct values."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        a, b, c = int(rng.integers(0, 9)), int(rng.integers(0, 5)), int(rng.integers(0, 4))
        y = (0 if a < 3 else 1 if a + b < 8 else 2) if rng.random() < 0.8 else int(rng.integers(0, 3))
        rows.append((i, 10 + y, float(a), float(b), float(c)))
    return rows, spark.createDataFrame(rows, "id long, label long, a double, b double, c double").repartition(5).cache()


def brute(rows, rounds, depth, eta=0.3, l2=1.0, least=1.0):
    """Margins after some rounds: every cut between distinct values is tried at every node."""
    x, y = np.array([r[2:] for r in rows]), np.array([r[1] - 10 for r in rows])
    margin = np.zeros((len(y), 3))
    gain_of = lambda g, h: g * g / (h + l2)

    def grow(mine, g, h, left):
        value = -eta * g[mine].sum() / (h[mine].sum() + l2)
        best = None
        if left:
            for f in range(x.shape[1]):
                for cut in np.unique(x[mine, f])[1:]:
                    low, high = mine[x[mine, f] < cut], mine[x[mine, f] >= cut]
                    if min(h[low].sum(), h[high].sum()) < least:
                        continue
                    gain = 0.5 * (gain_of(g[low].sum(), h[low].sum()) + gain_of(g[high].sum(), h[high].sum()) - gain_of(g[mine].sum(), h[mine].sum()))
                    if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, low, high)
        if best is None:
            return [(mine, value)]
        return grow(best[1], g, h, left - 1) + grow(best[2], g, h, left - 1)

    for _ in range(rounds):
        e = np.exp(margin)
        p = e / e.sum(axis=1, keepdims=True)
        step = np.zeros_like(margin)
        for c in range(3):
            for mine, value in grow(np.arange(len(y)), p[:, c] - (y == c), 2 * p[:, c] * (1 - p[:, c]), depth):
                step[mine, c] = value
        margin += step
    return margin


@pytest.mark.parametrize(("rounds", "depth"), [(1, 1), (1, 3), (4, 2)])
def test_margins_follow_the_definition(noisy, rounds, depth):
    rows, df = noisy
    model = boosting.fit_boosting(df, "label", FEATURES, rounds=rounds, max_depth=depth, max_bins=256)
    got = {r["id"]: r["margin"] for r in model.margins(df, FEATURES).collect()}
    expected = brute(rows, rounds, depth)
    assert max(abs(np.array(got[r[0]]) - expected[i]).max() for i, r in enumerate(rows)) < 1e-6


def test_partitions_and_passes_do_not_matter(noisy, monkeypatch):
    _, df = noisy
    grow = dict(label="label", features=FEATURES, rounds=3, max_depth=3)
    table = lambda model: sorted(tuple(r) for r in model.nodes.collect())
    one = table(boosting.fit_boosting(df.repartition(1), **grow))
    assert table(boosting.fit_boosting(df.repartition(9), **grow)) == one
    monkeypatch.setattr(boosting, "CELLS_PER_PASS", 40)
    monkeypatch.setattr(boosting, "NODES_PER_BROADCAST", 20)
    many = boosting.fit_boosting(df, **grow)
    assert table(many) == one and len(list(many._groups())) > 1


def test_passes_of_a_round_do_not_depend_on_the_number_of_classes(spark, monkeypatch):
    passes = []
    for name in ("step", "binned", "histogram"):
        real = getattr(boosting._Booster, name)
        monkeypatch.setattr(boosting._Booster, name, lambda self, *a, real=real, name=name: (passes.append(name), real(self, *a))[1])
    for k in (2, 7):
        passes.clear()
        df = spark.range(300).selectExpr(f"id % {k} AS label", "CAST(id % 50 AS double) AS x", "CAST(id % 7 AS double) AS z")
        boosting.fit_boosting(df, "label", ["x", "z"], rounds=3, max_depth=3)
        assert passes.count("binned") == 1 and passes.count("step") == 2 and passes.count("histogram") == 3 * 2


def test_it_learns_reloads_and_ignores_rows_without_a_label(noisy, spark, tmp_path):
    _, df = noisy
    more = df.unionAll(df.limit(5).withColumn("label", F.lit(None).cast("long")))
    model = train.train("multinomial_boosting", more, "label", FEATURES, {"rounds": 5, "max_depth": 3}, "id")
    scored = model.predict(df)
    assert evaluate.model_metrics(scored.withColumn("model", F.lit("m"))).first()["accuracy"] > 0.8
    model.save(str(tmp_path / "m"))
    again = train.Trained.load(str(tmp_path / "m")).predict(df)
    assert {(r["id"], r["prediction"]) for r in again.collect()} == {(r["id"], r["prediction"]) for r in scored.collect()}


def test_odd_tables(spark):
    same = spark.createDataFrame([(1, 2.0)] * 6, "label long, x double")
    assert boosting.fit_boosting(same, "label", ["x"], rounds=2).predict(same, ["x"]).where("prediction = 1").count() == 6
    flat = spark.createDataFrame([(i % 2, 1.0) for i in range(11)], "label long, x double")
    assert boosting.fit_boosting(flat, "label", ["x"], rounds=2).predict(flat, ["x"]).where("prediction = 0").count() == 11
    with pytest.raises(ValueError, match="no classes"):
        boosting.fit_boosting(flat.limit(0), "label", ["x"])
    with pytest.raises(Exception, match="missing values"):
        boosting.fit_boosting(spark.createDataFrame([(0, None), (1, 2.0)], "label long, x double"), "label", ["x"], rounds=1)
    with pytest.raises(ValueError, match="max_bins"):
        boosting.fit_boosting(flat, "label", ["x"], max_bins=1000)
