"""Whitening against numpy's singular vectors of all vectors, exact deviations, and vectors that are hard to factor."""

import math
import os

import numpy as np
import pytest

from aerocube.llm import queries, whitening

D = "/root/testdata/sf0.001"


def plain(vectors):
    """n, exact deviations' parts, components and eigenvalues by a singular value decomposition of all vectors."""
    x = np.floor(256 * np.asarray(vectors, float)).astype("int64")
    u = np.unique(x, axis=0)
    y = u - u.mean(0)
    _, s, axes = np.linalg.svd(y)
    e = np.zeros(x.shape[1])
    e[: len(s)] = np.where(s > 1e-13 * s.max(), s, 0) ** 2 / len(u)
    return x, u, axes.T, e


def check(got, ids, vectors, most=4):
    x, u, v, e = plain(vectors)
    n, s = len(u), [int(c) for c in u.sum(0)]
    k = min(most, x.shape[1])
    rows = sorted(((r["vec_id"], r["component"]), r) for r in got)
    assert [key for key, _ in rows] == sorted((i, c + 1) for i in ids for c in range(k))
    by_id = dict(zip(ids, x, strict=True))
    for c in range(k):
        own = [r for _, r in rows if r["component"] == c + 1]
        assert all(r["n"] == n and r["deviation"] == sum((n * int(a) - b) ** 2 for a, b in zip(by_id[r["vec_id"]], s, strict=True)) for r in own)
        if e[c] == 0:
            assert all(r["whitened"] is None and not r["explained"] for r in own)
            continue
        want = np.array([(by_id[r["vec_id"]] - u.mean(0)) @ v[:, c] / math.sqrt(e[c]) for r in own])
        have = np.array([r["whitened"] for r in own])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-8
        assert all(abs(r["explained"] / (e[c] / e.sum()) - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in own)


def run(spark, rows, most=4):
    df = spark.createDataFrame([(i, None if v is None else [float(c) if c is not None else None for c in v], 1) for i, v in rows], "vec_id long, embedding array<float>, x int").repartition(3)
    return whitening.whiten(df, "vec_id", "embedding", most).collect()


def test_plain(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 6)) * [3, 2, 1, 0.5, 0.2, 0.1]).astype("float32")
    rows = [*enumerate(vectors), (1000, vectors[3]), (1001, vectors[3]), (1002, [None] * 6), (1003, None), (1004, [math.nan] + [0] * 5), (1005, [math.inf] * 6)]
    check(run(spark, rows), [*range(300), 1000, 1001], [*vectors, vectors[3], vectors[3]])


def test_hard_to_factor(spark):
    """One direction a million times as long as another, dependent and constant dimensions, fewer vectors than dimensions."""
    rng = np.random.default_rng(6)
    z = rng.normal(size=(200, 3)) * [4000, 1, 0.01]
    check(run(spark, list(enumerate(z.astype("float32")))), range(200), z.astype("float32"))
    dependent = np.round(rng.normal(size=(200, 2)) * 64) / 64
    dependent = np.column_stack([dependent, dependent.sum(1), np.full(200, 0.5)])
    check(run(spark, list(enumerate(dependent))), range(200), dependent)
    few = np.round(rng.normal(size=(3, 5)) * 64) / 64
    check(run(spark, list(enumerate(few))), range(3), few)


def test_small(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []
    one = run(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (None, [0.5, 1.0])])
    assert len(one) == 6 and all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None and r["identity_error"] is None for r in one)
    short = run(spark, [(1, [0.5]), (2, [0.5, 1.0]), (3, []), (4, [-1.0, 0.25])])
    check(short, [1, 2, 3, 4], [[0.5, 0], [0.5, 1], [0, 0], [-1, 0.25]])
    large = run(spark, [(1, [1e9, 0.0]), (2, [-1e9, 0.0]), (3, [0.0, 1.0])])
    assert {(r["vec_id"], r["deviation"]) for r in large if r["component"] == 1} == {(1, None), (2, None), (3, 4 * 256**2)}


@pytest.mark.skipif(not os.path.isdir(D), reason="no tables")
def test_op12(spark):
    rows = spark.read.parquet(f"{D}/embeddings.parquet").collect()
    check(queries.QUERIES["op12_whitening"](spark, D).collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])
