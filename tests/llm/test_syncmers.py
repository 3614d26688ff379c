"""Fingerprints, neighbours and likenesses against plain Python."""

import random
import re

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from aerocube.llm import queries, syncmers as S
from tests.test_oracle import D

M = (1 << 32) - 1


def murmur(longs, seed=42):
    """Murmur3 of longs, one after the other, as Spark's hash()."""

    def mix(h, k):
        k = k * 0xCC9E2D51 & M
        k = (k << 15 | k >> 17) & M
        h ^= k * 0x1B873593 & M
        return ((h << 13 | h >> 19) & M) * 5 + 0xE6546B64 & M

    h = seed
    for x in longs:
        x &= (1 << 64) - 1
        h = mix(mix(h, x & M), x >> 32) ^ 8
        h = (h ^ h >> 16) * 0x85EBCA6B & M
        h = (h ^ h >> 13) * 0xC2B2AE35 & M
        h ^= h >> 16
    return h


def tokens(text):
    out = []
    for run in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        out += [run[i : min(i + 4, 16)] for i in range(0, min(len(run), 16), 4)] + list(run[16:])
    return out


def signed(x, bits):
    return x - (1 << bits) if x >= 1 << (bits - 1) else x


def brute(text, k=S.K):
    h = [signed(xxhash.xxh64_intdigest(t.encode(), seed=42), 64) for t in tokens(text)]
    if len(h) < k:
        return [(signed(murmur(h), 32), 0)] if h else []
    return [(signed(murmur(h[i : i + k]), 32), i) for i in range(len(h) - k + 1) if min(h[i], h[i + k - 1]) <= min(h[i + 1 : i + k - 1])]


def brute_likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    la, lb = a[-1][1], b[-1][1]
    a, b = ({w: min(p for x, p in s if x == w) for w, _ in s} for s in (a, b))
    moved = sorted(b[w] - a[w] for w in set(a) & set(b))
    slack, d = max(S.SLACK, min(la, lb) // 10), lb - la
    n = max((sum(min(0, d) - slack <= m <= max(0, d) + slack for m in moved), sum(abs(m - moved[len(moved) // 2]) <= slack for m in moved)), default=0)
    return (n / len(a) + n / len(b)) / 2


def string(found):
    return " ".join(str((w << 32) + p) for w, p in found)


def texts():
    r = random.Random(5)
    words = lambda n: " ".join("".join(r.choice("abcdefghié") for _ in range(r.randint(1, 9))) for _ in range(n))
    long = "".join(r.choice("你好世界一二三四五六七八九十𝒳") for _ in range(400))
    a, b = words(300), words(300)
    return [None, "", " \n", "one", "two words", a, f"{a} {b}", f"{b} {a}", f"{words(20)} {a}", a.replace(a[700:760], ""), long, "x" + long, "same " * 200, a]


def test_anchors_and_likeness_equal_brute_force(spark):
    made = texts()
    rows = spark.createDataFrame(list(enumerate(made)), "i int, t string").select("i", "t", S.anchors(F.col("t")).alias("a"))
    got = {r["i"]: r["f"] for r in rows.select("i", S.fingerprint(F.col("a")).alias("f")).collect()}
    assert got == {i: string(brute(t)) for i, t in enumerate(made)}
    pairs = rows.select(F.col("i").alias("x"), F.col("a").alias("xa")).join(rows.select(F.col("i").alias("y"), F.col("a").alias("ya")), F.col("x") <= F.col("y"))
    found = {(r["x"], r["y"]): r["s"] for r in pairs.select("x", "y", S.likeness(S.placed(F.col("xa")), S.placed(F.col("ya"))).alias("s")).collect()}
    for (x, y), s in found.items():
        assert s == pytest.approx(brute_likeness(brute(made[x]), brute(made[y]))), (x, y)
    assert found[5, 13] == 1 and found[5, 8] > 0.9 and found[5, 9] > 0.9 and found[10, 11] > 0.9
    assert found[6, 7] < 0.6  # passages that changed places match in part


def test_neighbours(spark):
    """Ranges of any size, string ids, ids that very many rows share, and rows without one."""
    r = random.Random(2)
    rows = [(r.choice([None, 5, *range(60)]), f"text {r.randrange(40)}") for _ in range(300)] + [(5, f"t{i}") for i in range(200)] + [(None, f"n{i}") for i in range(100)]
    for kind, cast in (("long", lambda i: i), ("string", lambda i: None if i is None else f"k{i:03}")):
        data = [(cast(i), t) for i, t in rows]
        df = spark.createDataFrame(data, f"key {kind}, body string").repartition(5)
        hashes = {t: ~signed(xxhash.xxh64_intdigest(t.encode(), seed=42), 64) for t in {t for _, t in rows}}
        order = sorted(data, key=lambda x: (x[0] is not None, x[0] if x[0] is not None else type(cast(1))(), hashes[x[1]]), reverse=True)
        want = sorted([(a, b) for a, b in zip(order, [*order[1:], order[0]], strict=True)], key=str)
        for size in (500, 10**9):
            got = S.with_next(df, "key", "body", size).collect()
            assert sorted([((x["id"], x["text"]), (x["next_id"], x["next_text"])) for x in got], key=str) == want
            assert all([(v >> 32, v & (2**31 - 1)) for v in x["found"]] == brute(x["text"]) for x in got[:50])
            assert all({v >> 32 for v in x["next_placed"]["once"]} == {w for w, _ in brute(x["next_text"])} for x in got[:50])
    one = S.with_next(df.limit(1), "key", "body").collect()
    assert len(one) == 1 and one[0]["text"] == one[0]["next_text"]
    assert S.with_next(df.filter("1 = 0"), "key", "body").count() == 0


def test_query_equals_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{D}/documents.parquet' ORDER BY doc_id DESC").fetchall()
    got = {r["doc_id"]: r for r in queries.QUERIES["op2_syncmers"](spark, D).collect()}
    assert len(got) == len(docs)
    for k, (i, text) in enumerate(docs):
        then = docs[(k + 1) % len(docs)][1]
        edited = text[: len(text) - len(text) // 3] + then[: len(text) // 3]
        own, new, other = brute(text), brute(edited), brute(then)
        assert (got[i]["fingerprint"], got[i]["edited_fingerprint"]) == (string(own), string(new))
        assert (got[i]["near_edited"], got[i]["near_next"]) == (pytest.approx(brute_likeness(own, new)), pytest.approx(brute_likeness(own, other)))
