import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelframe.operators import evaluate, extra_trees, resample, train

FEATURES = ["x", "y", "noise"]
PARAMS = {
    "logistic_regression": {"maxIter": 50, "regParam": 0.001},
    "decision_tree": {"maxDepth": 4},
    "random_forest": {"numTrees": 10, "seed": 1},
    "extra_trees": {"n_trees": 10, "max_depth": 6},
    "boosted_trees": {"maxIter": 3, "maxDepth": 2},
    "knn": {"k": 3},
}


@pytest.fixture(scope="module")
def parts(separable):
    return separable.where("id % 4 <> 0").cache(), separable.where("id % 4 = 0").cache()


@pytest.mark.parametrize("kind", list(PARAMS))
def test_each_kind_learns_and_reloads(parts, tmp_path, kind):
    learn, check = parts
    model = train.train(kind, learn, "label", FEATURES, PARAMS[kind], "id")
    scored = model.predict(check)
    assert set(scored.columns) == {*check.columns, "prediction"}
    macro = evaluate.model_metrics(scored.withColumn("model", F.lit(kind))).first()["macro_f1"]
    assert macro > 0.9
    model.save(str(tmp_path / kind))
    again = train.Trained.load(str(tmp_path / kind)).predict(check)
    assert {(r["id"], r["prediction"]) for r in again.collect()} == {(r["id"], r["prediction"]) for r in scored.collect()}


def test_importances_sum_to_one_and_selection_keeps_order(parts):
    learn, _ = parts
    table = train.forest_importances(learn, "label", FEATURES, n_trees=10, max_depth=5)
    rows = table.orderBy("ordinal").collect()
    assert math.isclose(sum(r["importance"] for r in rows), 1.0) and [r["feature"] for r in rows] == FEATURES
    chosen = train.select_features(table, 0.2)
    names = train.selected_names(chosen)
    assert "noise" not in names and names == [f for f in FEATURES if f in names]
    assert [r["feature"] for r in train.dropped_features(chosen).collect()] == sorted(set(FEATURES) - set(names))
    assert train.apply_selection(learn, names, ["id"]).columns == ["id", *names]


def test_importances_of_an_array_of_features(parts):
    learn, _ = parts
    packed = learn.select("id", "label", F.array("x", "y", "noise").alias("v"))
    rows = train.importances(train.train("decision_tree", packed, "label", "v", {"maxDepth": 3})).collect()
    assert [r["feature"] for r in rows] == ["v[0]", "v[1]", "v[2]"] and math.isclose(sum(r["importance"] for r in rows), 1.0)


def tree_rows(forest, spark):
    return {tuple(r[:5]) + tuple(r["counts"]) for r in forest.table(spark).collect()}


def test_extra_trees_do_not_depend_on_partitions_or_passes(spark, parts, monkeypatch):
    learn, _ = parts
    grow = dict(label="label", features=FEATURES, n_trees=3, max_depth=5)
    one = extra_trees.fit_extra_trees(learn.repartition(1), **grow)
    many = extra_trees.fit_extra_trees(learn.repartition(9), **grow)
    assert tree_rows(one, spark) == tree_rows(many, spark)
    monkeypatch.setattr(extra_trees, "CELLS_PER_PASS", 40)
    split = extra_trees.fit_extra_trees(learn, **grow)
    paths = lambda forest: sorted((t, f.feature[i], f.threshold[i]) for t, f in enumerate(forest.trees) for i in range(len(f.feature)))
    assert paths(one) == paths(split)


def test_extra_trees_counts_and_limits(spark, parts):
    learn, _ = parts
    forest = extra_trees.fit_extra_trees(learn, "label", FEATURES, n_trees=2, max_depth=3)
    for tree in forest.trees:
        assert sum(tree.counts[0]) == learn.count()
        for i, child in enumerate(tree.child):
            if child >= 0:
                both = np.array(tree.counts[child]) + np.array(tree.counts[child + 1])
                assert both.tolist() == tree.counts[i] and min(sum(tree.counts[child]), sum(tree.counts[child + 1])) > 0
    stump = extra_trees.fit_extra_trees(learn, "label", FEATURES, n_trees=1, max_depth=0)
    assert stump.predict(learn, FEATURES).select("prediction").distinct().collect()[0][0] == 1


def test_extra_trees_scoring_in_groups(spark, parts, monkeypatch):
    learn, check = parts
    forest = extra_trees.fit_extra_trees(learn, "label", FEATURES, n_trees=4, max_depth=3)
    whole = forest.predict(check, FEATURES).select("id", "prediction").collect()
    monkeypatch.setattr(extra_trees, "NODES_PER_BROADCAST", 5)
    assert len(list(forest._groups())) == 4
    assert set(forest.predict(check, FEATURES).select("id", "prediction").collect()) == set(whole)


def test_reads_of_a_level_do_not_depend_on_the_trees(spark, parts, monkeypatch):
    """Each level writes its rows once and counts once, for 3 trees as for 40; the table of nodes may be written in parts."""
    learn, _ = parts
    calls = []
    for name in ("move", "counts", "ranges"):
        real = getattr(extra_trees._Grower, name)
        monkeypatch.setattr(extra_trees._Grower, name, lambda self, *a, real=real, name=name: (calls.append(name), real(self, *a))[1])
    grown = {}
    for n_trees in (3, 40):
        calls.clear()
        grown[n_trees] = extra_trees.fit_extra_trees(learn, "label", FEATURES, n_trees=n_trees, max_depth=4)
        assert (calls.count("move"), calls.count("counts"), calls.count("ranges")) == (4, 4, 0)
    monkeypatch.setattr(extra_trees, "NODES_PER_WRITE", 10)
    again = extra_trees.fit_extra_trees(learn, "label", FEATURES, n_trees=3, max_depth=4)
    assert tree_rows(again, spark) == tree_rows(grown[3], spark) and len(grown[40].trees) == 40


def test_a_hundred_deep_trees(spark):
    """Noisy classes that take many nodes: the forest holds every row in each tree and beats one stump."""
    df = spark.range(6000).selectExpr("id", "rand(1) AS a", "rand(2) AS b", "rand(3) AS c", "rand(4) AS u").cache()
    df = df.selectExpr("id", "a", "b", "c", "CASE WHEN u < 0.1 THEN id % 3 ELSE CAST(a * 3 AS long) END AS label")
    forest = extra_trees.fit_extra_trees(df, "label", ["a", "b", "c"], n_trees=100, max_depth=12, max_features=2)
    nodes = forest.table(spark)
    leaves = nodes.where("child < 0").groupBy("tree").agg(F.sum(F.aggregate("counts", F.lit(0.0), lambda s, n: s + n)).alias("n"))
    assert {r["n"] for r in leaves.collect()} == {6000.0} and leaves.count() == 100 and nodes.count() > 20_000
    scored = forest.predict(df, ["a", "b", "c"])
    assert scored.where("label = prediction").count() > 5400


def test_constant_features_cannot_be_cut(spark):
    df = spark.createDataFrame([(i % 2, 1.0) for i in range(10)], "label long, x double")
    forest = extra_trees.fit_extra_trees(df, "label", ["x"], n_trees=2, max_depth=3)
    assert all(t.child == [-1] for t in forest.trees)


def test_folds_are_even_in_each_class(separable):
    dealt = train.stratified_folds(separable, "label", "id", 3)
    sizes = {}
    for r in dealt.groupBy("label", "fold").count().collect():
        sizes.setdefault(r["label"], []).append(r["count"])
    assert sizes == {1: [60] * 3, 2: [30] * 3, 3: [10] * 3}


def test_drawn_params():
    trials = train.draw_params({"a": [1, 2], "b": (1, 3), "c": (0.0, 1.0)}, 5, seed=3)
    assert trials == train.draw_params({"a": [1, 2], "b": (1, 3), "c": (0.0, 1.0)}, 5, seed=3)
    assert len(trials) == 5 and all(t["a"] in (1, 2) and 1 <= t["b"] <= 3 and 0 <= t["c"] <= 1 for t in trials)
    assert train.draw_params({"a": [1, 2], "b": (1, 2)}, 5) == [{"a": a, "b": b} for a in (1, 2) for b in (1, 2)]
    space = {"a": list(range(12)), "b": (1, 10)}
    assert len({tuple(t.items()) for t in train.draw_params(space, 119)}) == 119


def test_ranges_of_one_point_end():
    assert train.draw_params({"a": (0.1, 0.1)}, 2) == [{"a": 0.1}]
    narrow = train.draw_params({"a": (0.1, math.nextafter(0.1, 1))}, 5)
    assert 1 <= len(narrow) <= 2
    assert len(train.draw_params({"a": (0.1, 0.1), "b": (0.0, 1.0)}, 3)) == 3


def test_trials_scored_together_equal_single_ones(parts, monkeypatch):
    learn, _ = parts
    monkeypatch.setattr(train, "SCORED_AT_ONCE", 2)
    dealt = train.stratified_folds(learn, "label", "id", 2)

    def alone(kind, params):
        scores = []
        for fold in (0, 1):
            fitted = train.train(kind, dealt.where(F.col("fold") != fold).drop("fold"), "label", FEATURES, params, "id")
            scored = fitted.predict(dealt.where(F.col("fold") == fold)).withColumn("model", F.lit("m"))
            scores.append(evaluate.model_metrics(scored).first()["macro_f1"])
        return sum(scores) / 2

    for kind, space in (("decision_tree", {"maxDepth": [1, 2, 4]}), ("knn", {"k": [1, 4, 30], "block_rows": [64]})):
        _, _, _, trials = train.search(kind, learn, "label", "id", FEATURES, space, n_trials=3, folds=2)
        for r in trials.collect():
            params = {name: int(v) for name, v in r["params"].items()}
            assert abs(r["cv_macro_f1"] - alone(kind, params)) < 1e-12


def test_search_refits_the_best_setting(parts):
    learn, check = parts
    grow = lambda part: resample.smote(part, "id", "label", FEATURES, {3: 40}, k=3)
    model, params, score, trials = train.search(
        "decision_tree", learn, "label", "id", FEATURES, {"maxDepth": [1, 4]}, n_trials=2, folds=2, prepare=grow
    )
    rows = {r["params"]["maxDepth"]: r["cv_macro_f1"] for r in trials.collect()}
    assert params == {"maxDepth": 4} and rows["4"] == score > rows["1"]
    assert model.predict(check).where("label = prediction").count() > 65


def test_search_keeps_synthetic_rows_out_of_validation(parts):
    learn, _ = parts
    grown = resample.smote(learn, "id", "label", FEATURES, {3: 60}, k=3)
    dealt = train.stratified_folds(grown, "label", "id", 2)
    assert dealt.count() == grown.count()
    strays = dealt.where("is_synthetic").select(F.col("base_id").alias("b"), F.col("fold").alias("f")).join(dealt.where("NOT is_synthetic"), F.col("b") == F.col("id"))
    assert strays.where("f <> fold").count() == 0
    _, _, score, _ = train.search("decision_tree", grown, "label", "id", FEATURES, {"maxDepth": [4]}, n_trials=1, folds=2)
    assert score > 0.9


def test_search_may_prepare_the_whole_table_first(parts):
    learn, _ = parts
    seen = []

    def grow(part):
        seen.append(part.count())
        return resample.smote(part, "id", "label", FEATURES, {3: 60}, k=3)

    _, _, score, _ = train.search(
        "decision_tree", learn, "label", "id", FEATURES, {"maxDepth": [4]}, n_trials=1, folds=2, prepare=grow, prepare_first=True
    )
    assert seen == [learn.count()] and score > 0.9
