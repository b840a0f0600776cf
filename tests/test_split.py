import math

import pytest
from pyspark.sql import functions as F

from labelframe.operators import split
from labelframe.operators.resample import number_rows


@pytest.fixture(scope="module")
def rows(spark):
    """One class holds two thirds of the rows, one holds a single row."""
    label = F.when(F.col("id") % 3 < 2, "big").when(F.col("id") == 998, "lone").otherwise("small")
    return spark.range(1001).withColumn("label", label)


def test_counts_are_exact(rows):
    out = split.stratified_split(rows, "label", "id", 0.2)
    counts = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    assert sum(n for (_, s), n in counts.items() if s == "test") == math.ceil(0.2 * 1001)
    for c, n in sizes.items():
        assert abs(counts.get((c, "test"), 0) - 0.2 * n) < 1


def test_split_does_not_depend_on_partitions(rows):
    seen = [
        {(r["id"], r["split"]) for r in split.stratified_split(rows.repartition(n), "label", "id").collect()}
        for n in (1, 4, 16)
    ]
    assert seen[0] == seen[1] == seen[2]


def test_narrowing_the_digits_gives_the_same_split(rows):
    whole = split.stratified_split(rows, "label", "id", 0.3)
    narrow = split.stratified_split(rows, "label", "id", 0.3, small=0)
    assert whole.exceptAll(narrow).count() == 0


def test_string_ids_and_seeds(rows):
    named = rows.withColumn("id", F.concat(F.lit("r"), "id"))
    a = split.stratified_split(named, "label", "id", 0.5, seed=1)
    b = split.stratified_split(named, "label", "id", 0.5, seed=2)
    assert a.where("split = 'test'").count() == b.where("split = 'test'").count() == 501
    assert a.exceptAll(b).count() > 0


def test_missing_label_is_refused(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, label string")
    with pytest.raises(ValueError, match="missing"):
        split.stratified_split(df, "label", "id")


def test_too_many_classes_are_refused(rows, monkeypatch):
    monkeypatch.setattr(split, "MAX_CLASSES", 10)
    with pytest.raises(ValueError, match="classes"):
        split.stratified_split(rows, "id", "id")


def test_repeated_ids_are_refused(rows):
    with pytest.raises(ValueError, match="unique"):
        split.stratified_split(rows.unionAll(rows.limit(1)), "label", "id")


def test_split_leaves_the_table_in_place(rows):
    plan = split.stratified_split(rows, "label", "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_allocation_prefers_large_parts_then_small_labels():
    assert split.allocate({"a": 3, "b": 3, "c": 4}, 0.5) == {"a": 2, "b": 1, "c": 2}
    assert split.allocate({"a": 1}, 0.2) == {"a": 1}


def test_numbers_run_without_gaps(rows):
    for digits in (1, 3):
        out = number_rows(rows.repartition(7), "label", "id", 42, "t", digits)
        for r in out.groupBy("label").agg(F.min("idx"), F.max("idx"), F.count_distinct("idx"), F.count("*")).collect():
            assert (r[1], r[2] + 1, r[3]) == (0, r[4], r[4])
    one = {(r["id"], r["idx"]) for r in number_rows(rows, "label", "id", 42, "t", 1).collect()}
    assert one == {(r["id"], r["idx"]) for r in number_rows(rows, "label", "id", 42, "t", 3).collect()}
