"""Hard negatives against brute force: all anchors, positives and windows, with ties, copies, hot vectors and bounds that prune."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerocube.llm import hard_negatives as hn


def brute(rows, anchors, low=30, high=90):
    """rows: distinct (id, label, x)."""
    out, dims = [], max((len(x) for _, _, x in rows), default=0)
    x = np.zeros((len(rows), dims), "int64")
    for k, r in enumerate(rows):
        x[k, : len(r[2])] = r[2]
    scores = x @ x.T
    for a, (i, label, _) in enumerate(rows):
        if not anchors(i):
            continue
        order = sorted((k for k in range(len(rows)) if k != a), key=lambda k: (-scores[a, k], rows[k][0]))
        for p in [k for k in order if rows[k][1] == label][:5]:
            s, mine = int(scores[a, p]), scores[a].tolist()
            fits = [k for k in order if rows[k][1] != label and low * s <= 100 * mine[k] <= high * s][:10]
            out += [(i, rows[p][0], n + 1, rows[k][0], s, int(scores[a, k])) for n, k in enumerate(fits)]
    return sorted(out)


def run(spark, rows, every=10):
    df = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], l, "x", 0) for i, v, l in rows], "vec_id long, embedding array<float>, label int, need string, cell int").repartition(3)
    return sorted(map(tuple, hn.mine(df, "vec_id", "embedding", "label", F.col("vec_id") % every == 0).collect()))


def wholes(v):
    return tuple(int(math.floor(256 * float(np.float32(c)))) for c in v)


@pytest.fixture
def narrow(monkeypatch):
    """Small cells, blocks and rounds, so that small tables have many."""
    for name, value in {"CELL": 4, "BLOCK": 8, "SHELF": 2, "GROUP": 4, "FIRST": 2, "MORE": 2, "SAMPLE": 200}.items():
        monkeypatch.setattr(hn, name, value)


def test_clustered(spark, narrow):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 8)) * 2
    rows = [(i, (centres[i % 12] + rng.normal(size=8) * 0.2).round(2), int(rng.integers(3))) for i in range(400)]
    rows += [(400 + i, rows[5][1], i % 3) for i in range(60)]  # a hot vector, so ties
    rows = [(i, v.tolist(), l) for i, v, l in rows]
    assert run(spark, rows) == brute([(i, l, wholes(v)) for i, v, l in rows], lambda i: i % 10 == 0)


def test_walks_are_pruned(spark, narrow):
    """Walks hand out all cells by falling bound, no vector's score is above its cell's, and certified ones end early."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 6)) * 500
    x = (centres[rng.integers(30, size=600)] + rng.normal(size=(600, 6)) * 5).astype("int64")
    df = spark.createDataFrame([(i, i % 2, v.tolist()) for i, v in enumerate(x)], "vec_id long, label long, x array<long>")
    index, cells, blocks = hn.build(df)
    held = {}
    for r in blocks.collect():
        for one in r["rows"]:
            held[one["vec_id"]] = r["cell"]
    assert len(held) == 600 and sum(index.counts) == 600
    for a in (0, 17):
        walk = list(hn.visits(index, x[a].astype(float)))
        bound = {c: b for b, c in walk}
        assert len(bound) == len(walk) == len(index.counts) and all(p >= q for (p, _), (q, _) in zip(walk, walk[1:]))
        assert all(x[a] @ x[k] <= bound[held[k]] for k in range(600))
        best = sorted((x[a] @ x[k] for k in range(600)), reverse=True)[10]
        assert sum(b >= best for b, _ in walk) < len(walk) / 2


def test_edges(spark, narrow):
    rng = np.random.default_rng(9)
    good = [(i, rng.normal(size=4).round(2).tolist(), int(rng.integers(4))) for i in range(40)]
    bad = [(50, None, 1), (60, [1.0, None, 1, 1], 1), (70, [math.nan] * 4, 1), (80, [math.inf, 0, 0, 0], 1), (90, [1.0] * 4, None), (None, [1.0] * 4, 1)]
    odd = [(100, [], 1), (110, [2.0], 2), (120, [1.0] * 6, 1), (130, [1.0] * 6, 9)]
    other = [(0, [0.5, 0.25, 1.0, 1.0], 2)]  # shares an id
    rows = good + odd + other
    assert run(spark, rows + bad + good[:7] * 3) == brute([(i, l, wholes(v)) for i, v, l in rows], lambda i: i % 10 == 0)
    assert run(spark, []) == [] and run(spark, bad) == [] and run(spark, [(0, [1.0], 1)]) == []
    assert run(spark, [(i, [], 0) for i in range(3)] + [(i, [], 1) for i in range(3, 5)]) == brute([(i, int(i > 2), ()) for i in range(5)], lambda i: i % 10 == 0)


def test_large_scores(spark):
    """Beyond 53 bits."""
    rows = [(i, [2.0**20 + 8 * i, -(2.0**20) + i], i % 2) for i in range(30)]
    assert run(spark, rows) == brute([(i, l, wholes(v)) for i, v, l in rows], lambda i: i % 10 == 0)
