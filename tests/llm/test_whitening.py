"""Whitened embeddings against the eigenvectors of a dense covariance."""

import numpy as np
import pytest
from corpus_cases import DATA
from labelframe.llm import queries, whitening

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def brute(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100000
    n, sums = len(x), x.sum(axis=0)
    rows = (n * x - sums) / n
    _, s, right = np.linalg.svd(rows, full_matrices=False)
    e = s**2 / n
    z = rows @ right[:k].T / np.sqrt(e[:k])
    return n, [sum(int(v) ** 2 for v in r) for r in (n * x - sums)], z, e[:k] / e.sum(), e


def compare(rows, ids, vectors, k=8, close=1e-8):
    n, deviation, z, explained, _ = brute(vectors, k)
    assert len(rows) == len(ids) * k
    got = {(r.vec_id, r.component): r for r in rows}
    signs = [np.sign(sum(got[i, c].whitened * z[at, c - 1] for at, i in enumerate(ids))) for c in range(1, k + 1)]
    for at, i in enumerate(ids):
        for c in range(1, k + 1):
            r = got[i, c]
            assert (r.n, r.deviation) == (n, deviation[at]) and r.identity_error < 1e-9
            assert abs(r.whitened * signs[c - 1] - z[at, c - 1]) < close
            assert abs(r.explained - explained[c - 1]) < 1e-12


def test_whole_table(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    kept = df.collect()
    out = queries.op12_whitening(spark, DATA)
    assert out.columns == COLUMNS
    compare(out.collect(), [r.vec_id for r in kept], [r.embedding for r in kept])


def frame(spark, vectors, ids=None):
    rows = list(zip(ids or range(len(vectors)), [None if v is None else [None if c is None else float(c) for c in v] for v in vectors]))
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_fewer_steps_than_dimensions_where_the_spectrum_allows(spark):
    rng = np.random.default_rng(5)
    data = rng.standard_normal((400, 48)) * np.array([30.0, 20, 12, 8, *[0.5] * 44])
    df = frame(spark, data.tolist()).repartition(5)
    compare(whitening.whiten(df, components=4).collect(), list(range(400)), data, 4, 1e-7)
    vectors = whitening.grid(df)
    x = np.floor(1024 * data).astype(np.int64) + 100000
    made = whitening.bidiagonalise(vectors, 48, whitening.centred(400, x.sum(axis=0)), 4)
    assert 4 < made.steps < 30
    assert abs(made.v.T @ made.v - np.eye(made.steps)).max() < 1e-12
    u = ((400 * x - x.sum(axis=0)) / 400) @ made.w
    assert abs(u.T @ u - np.eye(made.steps)).max() < 1e-9  # the left side is orthogonal though it is never stored


def test_equal_eigenvalues_and_few_directions(spark):
    axes = np.vstack([np.eye(6), -np.eye(6)]) / 4  # all directions alike
    rows = whitening.whiten(frame(spark, axes.tolist()), components=6).collect()
    z = np.zeros((12, 6))
    for r in rows:
        z[r.vec_id, r.component - 1] = r.whitened
        assert abs(r.explained - 1 / 6) < 1e-9 and r.identity_error < 1e-9
    assert abs(z.T @ z / 12 - np.eye(6)).max() < 1e-9
    line = [[0.5 * i, 1.0 * i, 0, 0] for i in range(5)]
    rows = whitening.whiten(frame(spark, line)).collect()
    assert {r.component for r in rows} == {1} and all(abs(r.explained - 1) < 1e-12 for r in rows)
    twins = [[3.0, 0, 0, 0], [-3.0, 0, 0, 0], [0, 3.0, 0, 0], [0, -3.0, 0, 0], [0, 0, 1.0, 0], [0, 0, -1.0, 0]]
    rows = whitening.whiten(frame(spark, twins)).collect()
    assert sorted({(r.component, round(r.explained, 9)) for r in rows}) == [(1, round(9 / 19, 9)), (2, round(9 / 19, 9)), (3, round(1 / 19, 9))]


def test_odd_rows_are_left_out_and_repeats_count(spark):
    rng = np.random.default_rng(3)
    good = rng.standard_normal((30, 5)).tolist()
    odd = [None, [None, 1, 2, 3, 4], [float("nan"), 1, 2, 3, 4], [float("inf"), 1, 2, 3, 4], [1, 2, 3, 4, float("-inf")]]
    df = frame(spark, good + odd + good[:10], [*range(30), *range(100, 105), *range(200, 210)])
    rows = whitening.whiten(df.selectExpr("*", "1 AS x", "'a' AS id", "2 AS n", "vec_id AS component")).collect()
    compare(rows, [*range(30), *range(200, 210)], good + good[:10], 5)
    unnamed = frame(spark, good, [None, None, *range(28)])
    assert sum(r.vec_id is None for r in whitening.whiten(unnamed).collect()) == 10


def test_tables_without_a_spread(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [])).columns == COLUMNS
    assert whitening.whiten(frame(spark, [None, [None]])).collect() == []
    assert whitening.whiten(frame(spark, [[1.0, 2.0]])).collect() == []
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 7)).collect() == []
    assert whitening.whiten(frame(spark, [[], []])).collect() == []
    with pytest.raises(ValueError, match="of 1 and of 2"):
        whitening.whiten(frame(spark, [[1.0], [1.0, 2.0]]))


def test_deviations_beyond_a_long_are_null(spark):
    far = [[2.0**31, 0], [-(2.0**31), 0], [0.0, 1.0]]
    rows = whitening.whiten(frame(spark, far)).collect()
    assert {r.vec_id: r.deviation is None for r in rows} == {0: True, 1: True, 2: False}
