import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.operators import neighbors, resample


def brute(queries, candidates, k, group=False, exclude_self=False):
    """(id, rank, neighbour) by (squared distance, id)."""
    out = set()
    for qid, qg, qv in queries:
        found = sorted(
            (float(((np.array(qv) - np.array(cv)) ** 2).sum()), cid)
            for cid, cg, cv in candidates
            if (not group or cg == qg) and not (exclude_self and cid == qid)
        )
        out |= {(qid, i + 1, c) for i, (_, c) in enumerate(found[:k])}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, g, [float(x) for x in v]) for i, g, v in rows], "id long, g string, v array<double>")


def found(df):
    return {(r["id"], r["rank"], r["neighbour"]) for r in df.collect()}


@pytest.fixture(scope="module")
def lumpy():
    """A third of the rows are copies of one vector, the rest lie in clusters and on a grid."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(360):
        if i % 3 == 0:
            v = [2.0, 2.0, 2.0]
        elif i % 3 == 1:
            v = rng.normal(size=3) + 10 * rng.integers(0, 3)
        else:
            v = rng.integers(0, 3, size=3)
        rows.append((i, "ab"[i % 2], v))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 8, "query_rows": 5}, {"block_rows": 40, "query_rows": 1000}])
def test_equals_brute_force(spark, lumpy, sizes):
    df = frame(spark, lumpy)
    got = neighbors.nearest(df, df, "id", "v", k=4, group="g", exclude_self=True, **sizes)
    assert found(got) == brute(lumpy, lumpy, 4, group=True, exclude_self=True)


def test_other_queries_and_small_candidate_sets(spark, lumpy):
    few = [r for r in lumpy if r[0] < 7]
    far = [(1000 + i, "z", [1e3 * i, 0.0, -5.0]) for i in range(20)]
    got = neighbors.nearest(frame(spark, far), frame(spark, few), "id", "v", k=9, block_rows=4)
    assert found(got) == brute(far, few, 9)
    assert got.count() == 20 * 7


def test_pruning_keeps_far_cells_closed(spark):
    """Well separated clusters: after the home block almost nothing is searched again."""
    rng = np.random.default_rng(4)
    rows = [(i, "a", rng.normal(size=2) + 1000.0 * (i % 8)) for i in range(800)]
    df = frame(spark, rows)
    got = neighbors.nearest(df, df, "id", "v", k=3, exclude_self=True, block_rows=100)
    assert found(got) == brute(rows, rows, 3, exclude_self=True)
    left = df.select(F.lit("").alias("grp"), "id", F.col("v").alias("vec"), F.lit(None).cast("int").alias("carried"))
    index = neighbors._Index(left, "bigint", "int", 4, 42, 100)
    homes = index.homes(left).cache()
    best = index.search(homes, left, 1000).cache()
    assert homes.count() == 800 and index.open(index.bounds(left, homes, best)).count() < 800 * 8


def test_result_does_not_depend_on_partitions(spark, lumpy):
    df = frame(spark, lumpy)
    runs = [found(neighbors.nearest(df.repartition(n), df.repartition(n), "id", "v", k=3, block_rows=32)) for n in (1, 5)]
    assert runs[0] == runs[1]


def test_missing_values_are_refused(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None)], "id long, x double")
    with pytest.raises(Exception, match="missing values"):
        neighbors.nearest(df, df, "id", ["x"], k=1).collect()


def test_no_candidates(spark):
    df = spark.createDataFrame([(1, 1.0)], "id long, x double")
    assert neighbors.nearest(df, df.limit(0), "id", ["x"], k=1).count() == 0
    assert neighbors.nearest(df.limit(0), df, "id", ["x"], k=1).count() == 0


def test_smallest_label_wins_a_tied_vote(spark):
    near = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (2, 1, 3)], "id long, rank int, y long")
    assert {tuple(r) for r in neighbors.vote(near, "y").collect()} == {(1, 3), (2, 3)}
    each = neighbors.vote_each(near, "y", [1, 2])
    assert {tuple(r) for r in each.collect()} == {(1, 1, 5), (2, 1, 3), (1, 2, 3), (2, 2, 3)}


def test_classify(separable):
    test, train = separable.where("id % 4 = 0"), separable.where("id % 4 <> 0")
    out = neighbors.classify(train, test, "id", "label", ["x", "y"], k=5)
    assert out.count() == 75 and out.where("label = prediction").count() >= 74


@pytest.mark.parametrize("rounds", [(1,), (1, 2, 3), (2, 500)])
def test_rounds_do_not_change_the_result(spark, lumpy, monkeypatch, rounds):
    monkeypatch.setattr(neighbors, "ROUNDS", rounds)
    df = frame(spark, lumpy)
    got = neighbors.nearest(df, df, "id", "v", k=4, group="g", exclude_self=True, block_rows=8)
    assert found(got) == brute(lumpy, lumpy, 4, group=True, exclude_self=True)


def test_few_probes_find_most_neighbours(spark):
    rng = np.random.default_rng(6)
    rows = [(i, "a", rng.normal(size=4) + 4 * rng.integers(0, 4, 4)) for i in range(1500)]
    df = frame(spark, rows)
    exact = brute(rows, rows, 5)
    ids = {(q, n) for q, _, n in exact}
    shares = []
    for probes in (1, 12):
        got = {(q, n) for q, _, n in found(neighbors.nearest(df, df, "id", "v", k=5, block_rows=64, probes=probes))}
        shares.append(len(got & ids) / len(ids))
    assert shares[0] < shares[1] and shares[1] > 0.9


def test_repeated_candidate_ids_are_refused(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "id long, x double")
    with pytest.raises(ValueError, match="unique"):
        neighbors.nearest(df, df, "id", ["x"], k=1)


def test_labels_come_with_the_neighbours_and_text_ids_are_ordered(spark):
    rows = [("b", 1.0, 7), ("a", 1.0, 8), ("c", 2.0, 9)]
    df = spark.createDataFrame(rows, "id string, x double, y long")
    got = neighbors.nearest(df, df, "id", ["x"], k=2, exclude_self=True, carry="y")
    assert {tuple(r) for r in got.collect()} == {
        ("a", 1, "b", 0.0, 7), ("a", 2, "c", 1.0, 9), ("b", 1, "a", 0.0, 8),
        ("b", 2, "c", 1.0, 9), ("c", 1, "a", 1.0, 8), ("c", 2, "b", 1.0, 7),
    }


def test_blocks_stay_small_when_the_directory_is_full(spark, lumpy, monkeypatch):
    monkeypatch.setattr(neighbors, "MAX_RINGS", 4)
    df = frame(spark, lumpy)
    got = neighbors.nearest(df, df, "id", "v", k=3, block_rows=16)
    assert found(got) == brute(lumpy, lumpy, 3)
    rows = df.select(F.lit("").alias("grp"), "id", F.col("v").alias("vec"), F.lit(None).cast("int").alias("carried"))
    index = neighbors._Index(rows, "bigint", "int", 3, 42, 16)
    rings = index.groups[""]["rings"]
    assert len(rings) <= len(np.unique(rings[:, 0])) + 4 and rings[:, 4].max() > 1
    assert index.blocks.groupBy("block").count().agg(F.max("count")).first()[0] <= 48


@pytest.mark.parametrize("exclude_self", [False, True])
def test_parts_of_large_rings_are_exact_and_prune(spark, monkeypatch, exclude_self):
    """Weakly clustered vectors and few rings: parts in reach are visited, the others are not."""
    monkeypatch.setattr(neighbors, "MAX_RINGS", 3)
    monkeypatch.setattr(neighbors, "MAX_PIVOTS", 1)
    monkeypatch.setattr(neighbors, "TASK_BLOCKS", 2)
    rng = np.random.default_rng(9)
    rows = [(i, "a", rng.normal(size=3) + rng.integers(0, 6, 3)) for i in range(1200)]
    df = frame(spark, rows)
    got = neighbors.nearest(df, df, "id", "v", k=4, block_rows=25, exclude_self=exclude_self)
    assert found(got) == brute(rows, rows, 4, exclude_self=exclude_self)
    left = df.select(F.lit("").alias("grp"), "id", F.col("v").alias("vec"), F.lit(None).cast("int").alias("carried"))
    index = neighbors._Index(left, "bigint", "int", 4, 42, 25)
    assert index.parts is not None and index.blocks.groupBy("block").count().agg(F.max("count")).first()[0] < 100
    homes = index.homes(left).cache()
    best = index.search(homes, left, 1000).cache()
    blocks = index.blocks.select("block").distinct().count()
    visits = index.open(index.bounds(left, homes, best)).count()
    assert homes.count() == 1200 and visits < 0.5 * 1200 * blocks


def test_votes_on_an_oversampled_table_equal_brute_force(spark):
    """Overlapping classes, so that a wrong vote shows."""
    rng = np.random.default_rng(12)
    rows = [(i, int(i % 4 == 0), float(rng.normal(0.7 * (i % 4 == 0))), float(rng.normal())) for i in range(160)]
    df = spark.createDataFrame(rows, "id long, label long, x double, y double")
    learn, check = df.where("id < 100"), df.where("id >= 100")
    grown = resample.smote(learn, "id", "label", ["x", "y"], {1: 75}, k=5).cache()
    assert grown.select("id").distinct().count() == grown.count() == 150
    got = {r["id"]: r["prediction"] for r in neighbors.classify(grown, check, "id", "label", ["x", "y"], k=5).collect()}
    held = sorted((r["id"], r["label"], r["x"], r["y"]) for r in grown.collect())
    for i, _, x, y in rows[100:]:
        near = sorted(((x - a) ** 2 + (y - b) ** 2, j, c) for j, c, a, b in held)[:5]
        votes = [c for _, _, c in near]
        assert got[i] == max(sorted(set(votes)), key=votes.count)


def test_queries_are_not_sent_through_the_driver(spark, lumpy):
    """Joins by the id of a query shuffle both sides, however small."""
    df = frame(spark, lumpy)
    left = materialize(df.select(F.lit("").alias("grp"), "id", F.col("v").alias("vec"), F.lit(None).cast("int").alias("carried")))
    index = neighbors._Index(left, "bigint", "int", 3, 42, 16)
    homes = materialize(index.homes(left))
    search = index.search(homes, left, 1000)
    bounds = index.bounds(left, homes, materialize(search))
    for made in (search, bounds, index.open(materialize(bounds))):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [coalesce(id#" in plan and "BroadcastHashJoin [coalesce(id#" not in plan, plan


class Captured:
    """Stands in for a frame and keeps the function that it is given."""

    def where(self, _):
        return self

    def mapInPandas(self, run, _):
        self.run = run
        return self


def test_a_worker_holds_little_whatever_the_directory():
    rng = np.random.default_rng(8)
    v, pivots = rng.normal(size=(10_000, 64)), rng.normal(size=(256, 64))
    index = object.__new__(neighbors._Index)
    index.id_type, index.one_type, index.keep = "bigint", "struct<neighbour: bigint, carried: int>", 5
    rings = np.array([(c, 6.0, 14.0, c, 1, 40) for c in range(256)], dtype=float)
    index.groups = {"": {"pivots": pivots, "rings": rings}}
    asked = pd.DataFrame({"id": np.arange(len(v)), "grp": "", "vec": list(v), "kth": 8.0, "home": 0, "ids": None})
    tracemalloc.start()
    rows = sum(len(b) for b in index._place(Captured()).run(iter([asked])))
    placed = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    visits = sum(len(b) for b in index._visits(Captured(), lambda part, info: neighbors._open_rings(part, info, 5, 0, 8)).run(iter([asked])))
    opened = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    top = neighbors._top(v[:8192], np.full(8192, np.inf), v[:2048], np.ones(2048, int), np.arange(2048), 5)
    searched = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 10_000 and visits == 80_000 and len(top[0]) == 8192 * 5
    assert max(placed, opened, searched) < 60e6, (placed, opened, searched)
