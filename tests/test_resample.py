import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelframe.operators import profile, resample

FEATURES = ["x", "y", "noise"]
TARGETS = {2: 120, 3: 70}


@pytest.fixture(scope="module")
def grown(separable):
    return resample.smote(separable, "id", "label", FEATURES, TARGETS, k=5, seed=1).cache()


def test_targets_are_reached_and_others_untouched(separable, grown):
    sizes = {r["class"]: r["count"] for r in profile.class_distribution(grown, "label").collect()}
    assert sizes == {1: 180, 2: 120, 3: 70}
    real = grown.where("NOT is_synthetic").select("id", "label", *FEATURES)
    assert real.exceptAll(separable.select("id", "label", *FEATURES)).count() == 0


def test_new_rows_lie_between_their_row_and_a_near_one_of_the_class(separable, grown):
    pdf = separable.toPandas().set_index("id")
    for r in grown.where("is_synthetic").collect():
        base = pdf.loc[r["base_id"]]
        mates = pdf[(pdf["label"] == r["label"]) & (pdf.index != r["base_id"])]
        dist = np.sqrt(((mates[FEATURES] - base[FEATURES]) ** 2).sum(axis=1))
        near = mates.loc[dist.sort_values(kind="stable").index[:5], FEATURES].to_numpy()
        start = base[FEATURES].to_numpy(dtype=float)
        step = np.array([r[f] for f in FEATURES]) - start
        on_a_line = [
            np.allclose(step, g * (n - start), atol=1e-9)
            for n in near
            for g in [float(step @ (n - start) / ((n - start) @ (n - start)))]
            if -1e-9 <= g < 1
        ]
        assert any(on_a_line)


def test_same_rows_under_any_partitioning(separable, grown):
    want = set(grown.collect())
    for n in (1, 16):
        again = resample.smote(separable.repartition(n), "id", "label", FEATURES, TARGETS, k=5, seed=1)
        assert set(again.collect()) == want


def test_seed_changes_the_rows(separable, grown):
    other = resample.smote(separable, "id", "label", FEATURES, TARGETS, k=5, seed=2)
    assert other.exceptAll(grown).count() > 0


def test_plan(separable):
    got = {r["class"]: (r["n"], r["target"], r["to_add"]) for r in resample.oversampling_plan(separable, "label", {3: 50}).collect()}
    assert got == {1: (180, 180, 0), 2: (90, 90, 0), 3: (30, 50, 20)}


@pytest.mark.parametrize(
    "targets, message", [({2: 10}, "more than its target"), ({9: 10}, "has no rows"), ({3: 40}, "need 31")]
)
def test_bad_targets(separable, targets, message):
    k = 30 if "need" in message else 5
    with pytest.raises(ValueError, match=message):
        resample.smote(separable, "id", "label", FEATURES, targets, k=k)


def test_class_of_k_plus_one_rows_is_enough(separable):
    six = separable.where("label = 1 OR id IN (9, 19, 29, 39, 49, 59)")
    assert resample.smote(six, "id", "label", FEATURES, {3: 40}, k=5).where("is_synthetic").count() == 34


def test_reached_target_adds_nothing(separable):
    out = resample.smote(separable, "id", "label", FEATURES, {3: 30})
    assert out.count() == 300 and out.where("is_synthetic").count() == 0


def test_copies_in_a_class(spark):
    """Half of the class is one repeated row; every new row still has a neighbour."""
    rows = [(i, 1, 1.0 if i % 2 else float(i)) for i in range(60)] + [(100 + i, 0, 0.0) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, label long, x double")
    out = resample.smote(df, "id", "label", ["x"], {1: 200}, k=3)
    assert out.where("label = 1").count() == 200
    assert out.where(F.col("is_synthetic") & F.col("x").isNull()).count() == 0


def test_new_ids_are_unique_for_numbers_and_text(separable, grown):
    assert grown.select("id").distinct().count() == grown.count()
    assert grown.where("NOT is_synthetic AND base_id <> id").count() == 0
    named = separable.withColumn("id", F.concat(F.lit("row"), F.col("id")))
    twice = resample.smote(named, "id", "label", FEATURES, {3: 40}, k=5)
    twice = resample.smote(twice.drop("base_id", "synthetic_no", "is_synthetic"), "id", "label", FEATURES, {3: 50}, k=5)
    assert twice.select("id").distinct().count() == twice.count() == 320


@pytest.mark.parametrize("digits", [1, 2, 3, 4, 5])
def test_rows_are_numbered_in_the_order_of_their_digests(spark, digits):
    df = spark.range(700).selectExpr("id", "CASE WHEN id % 7 < 5 THEN 'a' ELSE 'b' END AS c")
    rows = resample.number_rows(df, "c", "id", 42, "test", digits).collect()
    for c in "ab":
        mine = [r["id"] for r in sorted((r for r in rows if r["c"] == c), key=lambda r: r["idx"])]
        assert sorted(r["idx"] for r in rows if r["c"] == c) == list(range(len(mine)))
        assert mine == sorted(mine, key=lambda i: (hashlib.md5(f"42-test-{i}".encode()).hexdigest(), i))
