"""Near-duplicates against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from aerocube.llm import near_dup


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def brute_components(docs, k, percent=80):
    sets = {i: shingles(t, k) for i, t in docs}
    ids, parent = sorted(sets), {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def cloud(seed, copies=150, words=120):
    """Copies of one text with few to many words changed, chains of drifting copies, short texts, a shared passage."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    base, docs = [word() for _ in range(words)], []
    for _ in range(copies):
        t = list(base)
        for _ in range(r.randint(0, 12)):
            t[r.randrange(len(t))] = word()
        docs.append(t[: len(t) - r.choice([0, 0, 0, 5, 15])])
    chain = list(base)
    for _ in range(40):
        chain = [*chain[r.randint(1, 4) :], word(), word()]
        docs.append(list(chain))
    passage = base[:40]
    docs += [passage + [word() for _ in range(r.randint(0, 80))] for _ in range(60)]
    docs += [[r.choice(["x", "y", "z"]) for _ in range(r.randint(0, 9))] for _ in range(40)]
    docs += [list(docs[r.randrange(len(docs))]) for _ in range(60)]
    r.shuffle(docs)
    return [(i * 3, " ".join(d).title() if i % 5 else " ".join(d)) for i, d in enumerate(docs)]


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 4, 80), (2, 5, 80), (3, 4, 50)])
def test_components_equal_brute_force(spark, seed, k, percent):
    docs = cloud(seed)
    got = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), words=k, similarity=percent / 100).collect()
    want = brute_components(docs, k, percent)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingles(t, k)) for i, t in docs}
    assert {r["doc_id"] for r in got if r["kept"]} == set(want.values())


def test_connected_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)]
    got = {x["id"]: x["component"] for x in near_dup.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = {x: find(x) for x in list(parent)}
    assert {x: c for x, c in want.items() if x in got and x != c} == {x: c for x, c in got.items() if x != c}
    assert all(x in got for x, c in want.items() if x != c)


def test_sketches_estimate(spark):
    """Sketches of pairs near the threshold pass, of unlike ones don't."""
    import numpy as np

    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base), " ".join([*base[:360], *[f"o{i}" for i in range(40)]]), " ".join([*base[:120], *[f"p{i}" for i in range(280)]])]
    with np.errstate(over="ignore"):
        rows = [(i, near_dup._sketched(s, *near_dup.band_plan(0.8))[3].tolist()) for i, s in enumerate(near_dup.shingle_sets(texts, 4))]
    s = spark.createDataFrame(rows, "id int, s array<long>")
    pairs = s.alias("x").join(s.alias("y"), F.expr("x.id < y.id")).select(F.expr("x.id as a"), F.expr("y.id as b"), near_dup._alike(F.col("x.s"), F.col("y.s"), 0.8).alias("ok")).collect()
    assert {(p["a"], p["b"]): p["ok"] for p in pairs} == {(0, 1): True, (0, 2): False, (1, 2): False}
