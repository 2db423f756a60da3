"""Whitening against plain numpy on every row."""

import math

import numpy as np
import pytest

from drumlin.llm import whitening
from drumlin.llm.queries import op13_whitening
from tests.llm.frames import plain

SCHEMA = "vec_id long, embedding array<float>"
SF_DIR = "/root/testdata/sf0.001"


def brute(vectors, components=32):
    x = np.floor(64 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), [sum(int(v) for v in column) for column in x.T]
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    y = np.array([[(n * int(v) - s) / n for v, s in zip(row, sums, strict=True)] for row in x])
    covariance = y.T @ y / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions[:, ::-1]
    z = y @ directions / np.sqrt(np.maximum(values, 1e-300))
    return n, deviation, z[:, :components], (values / np.trace(covariance))[:components]


def check(got, ids, vectors):
    n, deviation, z, explained = brute(vectors)
    k = z.shape[1]
    found = {}
    for r in got:
        found.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(found) == sorted(ids) and all(sorted(x) == list(range(1, k + 1)) for x in found.values())
    mine = np.array([[found[i][c + 1].whitened for c in range(k)] for i in ids])
    sign = np.sign((mine * z).sum(axis=0))
    assert np.allclose(mine, z * sign, atol=1e-6)
    for at, i in enumerate(ids):
        assert {r.n for r in found[i].values()} == {n}
        assert {r.deviation for r in found[i].values()} == {deviation[at]}
        assert np.allclose([found[i][c + 1].explained for c in range(k)], explained, rtol=1e-9)
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9
    assert np.abs(mine.T @ mine / n - np.eye(k)).max() < 1e-9


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [r for r in rows if r.embedding and all(v is not None and math.isfinite(v) for v in r.embedding)]
    got = op13_whitening(spark, SF_DIR).collect()
    check(got, [r.vec_id for r in rows], [r.embedding for r in rows])


def test_frequent_vectors_weigh_by_count(spark):
    random = np.random.default_rng(3)
    some = random.normal(size=(20, 4)).astype(np.float32).tolist()
    vectors = [some[0]] * 40 + some
    frame = spark.createDataFrame(list(enumerate(vectors)), SCHEMA).repartition(5)
    check(whitening.whitened(frame).collect(), list(range(60)), vectors)
    # Weights of one: the fit is that of the distinct vectors.
    once = whitening.whitened(frame, weights=whitening.ONES).collect()
    each = whitening.whitened(spark.createDataFrame(list(enumerate(some)), SCHEMA)).collect()
    want = {r.component: (r.n, r.whitened, r.explained) for r in each if r.vec_id == 7}
    for r in once:
        if r.vec_id == 47:
            assert (r.n, r.whitened, r.explained) == pytest.approx(want[r.component])


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0, -2.0]), (2, [0.25, -1.0, 3.0]), (2, [0.25, -1.0, 3.0]), (None, [1.5, 0.0, 0.0]), (9, [1.0, 9.0, 2.0])]
    odd = [(3, None), (4, [nan, 1.0, 1.0]), (5, [inf, 1.0, 1.0]), (6, [None, 1.0, 1.0]), (7, []), (8, [1.0, 2.0]), (10, [3e38, 1.0, 1.0])]
    frame = spark.createDataFrame(good + odd, SCHEMA).selectExpr("*", "'x' as n", "1 as dim", "2 as h1", "3 as component")
    got = whitening.whitened(frame).collect()
    # A single vector of its length, and an empty one, have no component.
    assert {r.vec_id for r in got} == {1, 2, None, 9} and {r.n for r in got} == {5}
    assert sum(r.vec_id == 2 for r in got) == 2 * sum(r.vec_id == 1 for r in got)
    assert plain(whitening.whitened(frame.limit(0))) == []
    assert plain(whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA))) == []


def test_large_entries_stay_exact(spark):
    vectors = [[1e12, 1.0], [3e12, 2.0], [-5e11, 4.0], [2e12, -3.0]]
    n, deviation, _, _ = brute(vectors)
    assert max(deviation) >= 2**63
    got = whitening.whitened(spark.createDataFrame(list(enumerate(vectors)), SCHEMA)).collect()
    assert {(r.vec_id, r.deviation) for r in got} == {(i, x if x < 2**63 else None) for i, x in enumerate(deviation)}
    small = [[1e5, 1.0], [3e5, 2.0], [-5e4, 4.0], [2e5, -3.0]]
    n, deviation, _, _ = brute(small)
    got = whitening.whitened(spark.createDataFrame(list(enumerate(small)), SCHEMA)).collect()
    assert {(r.vec_id, r.deviation) for r in got} == set(enumerate(deviation))
