import numpy as np
import pytest
from pyspark.sql import functions as F

from labelframe.functions import formulas
from labelframe.operators import expect
from labelframe.plans import stages

NAMES = {1: "low", 2: "mid", 3: "high"}


@pytest.fixture(scope="module")
def raw(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(400):
        c = 1 if i % 10 < 6 else 2 if i % 10 < 9 else 3
        height = float(rng.normal(1000 * c, 100))
        angle = int(360 if i % 50 == 0 else rng.integers(0, 360))
        rows.append((i, height, angle, int(rng.integers(0, 90)), int(c if rng.random() < 0.8 else 4), NAMES[c]))
    rows.append((400, 99999.0, 10, 10, 1, "low"))
    return spark.createDataFrame(rows, "id long, height double, angle long, slope long, area long, kind string")


def test_raw_table_to_champion(raw):
    learn, check = stages.clean_and_split(
        raw, "id", "kind", NAMES, {"height": (0, 9000), "angle": (0, 359)}, [("angle", 360, 0)]
    )
    assert learn.count() == 320 and check.count() == 80
    sine, cosine = formulas.circular(F.col("angle"))
    parts = stages.build_features(
        learn, check, "id", "kind",
        {"angle_sin": sine, "angle_cos": cosine, "steep": formulas.product(F.col("height"), F.col("slope"))},
        drop=["angle"], categorical=["area"],
    )
    assert parts.quant == ["height", "slope", "angle_sin", "angle_cos", "steep"]
    assert parts.indicators == ["area_1", "area_2", "area_3", "area_4"]
    grown = stages.balance(parts, {3: 60}, k=3)
    expect.require(expect.class_targets_met(parts.train, grown.train, "kind", {3: 60}))
    chosen = stages.select(grown, threshold=0.01, n_trees=10, max_depth=5)
    assert "height" in chosen.quant and set(chosen.features) <= set(parts.features)
    scaled, params = stages.scale(chosen)
    assert params.count() == len(chosen.quant)
    models, predictions, ranking = stages.train_and_rank(
        scaled, ["decision_tree", "knn"], {"decision_tree": {"maxDepth": 4}, "knn": {"k": 3}}
    )
    best = ranking.where("is_champion").first()
    assert set(models) == {"decision_tree", "knn"} and predictions.count() == 160 and best["macro_f1"] > 0.9


def test_unknown_label_stops_the_first_stage(raw):
    with pytest.raises(ValueError, match="high"):
        stages.clean_and_split(raw, "id", "kind", {1: "low", 2: "mid"}, {})
