import math

import pytest

from labelframe.operators import evaluate


@pytest.fixture(scope="module")
def predictions(spark):
    """Class 3 is never predicted, class 4 never true."""
    pairs = [(1, 1)] * 4 + [(1, 2)] + [(2, 2)] * 3 + [(2, 4)] + [(3, 1)] * 2
    return spark.createDataFrame([("m", a, b) for a, b in pairs], "model string, label long, prediction long")


def test_confusion_matrix_is_complete(predictions):
    cells = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion_matrix(predictions).collect()}
    assert len(cells) == 16 and cells[(1, 1)] == 4 and cells[(3, 1)] == 2 and cells[(4, 4)] == 0
    fixed = evaluate.confusion_matrix(predictions, by=["model"], classes=[1, 2, 3, 4, 5])
    assert fixed.count() == 25


def test_report_has_zero_where_nothing_can_be_divided(predictions):
    for matrix in (evaluate.confusion_counts(predictions), evaluate.confusion_matrix(predictions)):
        got = {r["class"]: r for r in evaluate.class_report(matrix).collect()}
        assert math.isclose(got[1]["precision"], 4 / 6) and math.isclose(got[1]["recall"], 4 / 5)
        assert math.isclose(got[1]["f1"], 8 / 11) and got[1]["support"] == 5
        assert (got[3]["precision"], got[3]["recall"], got[3]["f1"], got[3]["support"]) == (0.0, 0.0, 0.0, 2)
        assert (got[4]["precision"], got[4]["recall"], got[4]["support"]) == (0.0, 0.0, 0)


def test_averages(predictions):
    report = evaluate.class_report(evaluate.confusion_counts(predictions))
    f1 = {1: 8 / 11, 2: 6 / 8, 3: 0.0, 4: 0.0}
    assert math.isclose(evaluate.macro_average(report).first()["macro_f1"], sum(f1.values()) / 4)
    assert math.isclose(evaluate.weighted_average(report).first()["weighted_f1"], (f1[1] * 5 + f1[2] * 4) / 11)
    assert math.isclose(evaluate.accuracy(predictions).first()["accuracy"], 7 / 11)
    row = evaluate.model_metrics(predictions).first()
    assert math.isclose(row["macro_f1"], sum(f1.values()) / 4) and math.isclose(row["accuracy"], 7 / 11)


def test_missing_prediction_counts_as_wrong(spark):
    df = spark.createDataFrame([("m", 1, 1), ("m", 1, None)], "model string, label long, prediction long")
    assert evaluate.accuracy(df).first()["accuracy"] == 0.5
    row = evaluate.class_report(evaluate.confusion_counts(df)).first()
    assert (row["recall"], row["precision"], row["support"]) == (0.5, 1.0, 2)


def test_ranking_breaks_ties_by_list_order(spark):
    metrics = spark.createDataFrame([("a", 0.5), ("b", 0.9), ("c", 0.9)], "model string, macro_f1 double")
    ranked = evaluate.rank_models(metrics, ["c", "b", "a"]).orderBy("rank").collect()
    assert [(r["model"], r["is_champion"]) for r in ranked] == [("c", True), ("b", False), ("a", False)]


def test_delta_to_a_missing_baseline(spark):
    metrics = spark.createDataFrame([("a", 0.5), ("b", 0.75)], "model string, macro_f1 double")
    stored = spark.createDataFrame([("b", 0.5)], "model string, macro_f1 double")
    got = {r["model"]: (r["baseline"], r["delta"]) for r in evaluate.against_baselines(metrics, stored).collect()}
    assert got == {"a": (0.0, 0.5), "b": (0.5, 0.25)}
