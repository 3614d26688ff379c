"""Whole queries against plain Python, on tables where every part of a method decides something."""

import hashlib
import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from aerocube.llm import near_dup, queries, url_filter
from tests.llm.test_brute_force import brute_components, shingles
from tests.llm.test_edges import brute_repeats, brute_targets
from tests.test_oracle import D, rows as plain_rows

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def trials(rows):
    """Prior trials from (n, k, prior)."""
    rows = [r for r in rows if r[0] > 0]
    more = sum(n * (n - 1) * p * (1 - p) for n, _, p in rows)
    if not more:
        return 999.0
    spread = (sum((k - n * p) ** 2 for n, k, p in rows) - sum(n * p * (1 - p) for n, _, p in rows)) / more
    return 1 / min(max(spread, 0.001), 0.5) - 1


def over(mean, n):
    return mean - 1.645 * math.sqrt(max(mean * (1 - mean), 0) / (n + 1)) > 0.5


def base_failed(text):
    words = (text or "").encode().split()
    return len(words) < 50 or 100 * brute_repeats(words) > 50 * len(words)


def rule_failed(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    return base_failed(text) or 10 * sum(map((text or "").count, "#*$%&|<>")) > sum(len(w.decode()) for w in words) or 10 * (len(lines) - len(set(lines))) > 3 * len(lines)


def bad_hosts(docs):
    n, k = Counter(s for _, _, _, s, _ in docs), Counter(s for _, t, _, s, _ in docs if rule_failed(t))
    prior = sum(k.values()) / len(docs)
    m = trials([(n[s], k[s], prior) for s in n])
    return {s for s in n if over((prior * m + k[s]) / (n[s] + m), n[s] + m) and 2 * k[s] > n[s]}


def n_copies(docs):
    size = {d[0]: len((d[1] or "").encode().split()) for d in docs}
    total, of = Counter(), defaultdict(lambda: Counter())
    place = lambda i: int(hashlib.md5(str(i).encode()).hexdigest()[:9], 16)
    for d in docs:
        total[d[3]] += size[d[0]]
        of[d[3]][place(d[0])] += size[d[0]]
    out = {}
    targets = brute_targets(dict(total))
    for s, target in targets.items():
        once = int(target // total[s]) if total[s] else 0
        left, lower, taken = target - once * total[s], 0, 0
        for h in sorted(h for h, w in of[s].items() if w):
            if taken + of[s][h] > left:
                lower = h + 1 if of[s][h] < 2 * (left - taken) else h
                break
            taken += of[s][h]
        out |= {d[0]: once + (place(d[0]) < lower) for d in docs if d[3] == s}
    return out, targets


def corpus(seed=9):
    """Sources of which one is bad as a whole and one has no name; copies; texts that fail by words, symbols or lines."""
    r = random.Random(seed)
    words = lambda n: " ".join(f"{r.choice('abcdefghij')}{r.randrange(500)}" for _ in range(n))
    texts = [words(r.randint(30, 120)) for _ in range(160)]
    texts += [f"{texts[r.randrange(160)]} tail" for _ in range(70)] + ["", None, "same words " * 60]
    docs = [(i, t, "en", [None, "a", "b", "c"][r.randrange(4)], 0) for i, t in enumerate(texts)]
    bad = [(1000 + i, words(60) + (" #" * 60 if i % 5 else "") if i % 2 else "x", "en", "bad", 0) for i in range(120)]
    lines = [(2000 + i, "\n".join(["one line of these words"] * 3 + [words(30) for _ in range(5)]), "en", "lines", 0) for i in range(20)]
    return docs + bad + lines


@pytest.fixture
def tables(spark, tmp_path):
    spark.createDataFrame(corpus(), DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_op7(spark, tables):
    docs = corpus()
    bad = bad_hosts(docs)
    assert bad == {"bad"}
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_host_rules"](spark, tables).collect()}
    assert {i: r["base_failed"] for i, r in got.items()} == {d[0]: base_failed(d[1]) for d in docs}
    assert {i: r["kept"] for i, r in got.items()} == {d[0]: not base_failed(d[1]) and d[3] not in bad for d in docs}
    assert sum(not r["kept"] and not r["base_failed"] for r in got.values()) > 20
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{tables}/documents.parquet/*.parquet'")
    assert plain_rows(duck.sql(queries.ORACLE_SQL["op7_host_rules"]).df()) == plain_rows(queries.QUERIES["op7_host_rules"](spark, tables).toPandas())


def test_hosts_are_condemned_by_their_own_failures(spark):
    from aerocube.llm import quality

    rows = [(i, i % 10 > 0, f"s{i % 7}") for i in range(700)] + [(1000 + i, False, "good") for i in range(3)]
    judged = spark.createDataFrame(rows, "doc_id long, failed boolean, source string")
    assert {r["of"] for r in quality.bad_hosts(judged).collect()} == {f"s{i}" for i in range(7)}


def test_op8(spark, tables):
    docs = corpus()
    copies, targets = n_copies(docs)
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_mix_sources"](spark, tables).collect()}
    assert {i: r["taken"] for i, r in got.items()} == {d[0]: len((d[1] or "").encode().split()) * copies[d[0]] for d in docs}
    assert all(r["target"] == pytest.approx(targets[d[3]]) for d in docs for r in [got[d[0]]])


def test_op1(spark, tables):
    got = {r["doc_id"]: r for r in queries.QUERIES["op1_jump_shards"](spark, tables).collect()}
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def shard(key, shards):
        at, i = 0, 1
        seed = xxhash.xxh64_intdigest(str(key).encode(), seed=42)
        while True:
            low = (xxhash.xxh64_intdigest(struct.pack("<i", i), seed=seed) >> 33) + 1
            to = math.floor((at + 1) * float(1 << 31) / low)
            if to >= shards:
                return at
            at, i = to, i + 1

    parts, by = 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), defaultdict(list)
    for i, text, *_ in corpus():
        raw = (text or "").encode()
        part = signed(xxhash.xxh64_intdigest(struct.pack("<q", zlib.crc32(raw)), seed=xxhash.xxh64_intdigest(str(i).encode(), seed=42))) % parts
        assert (got[i]["size"], got[i]["text_crc32"], got[i]["shard"], got[i]["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), shard(i, 8), shard(i, 9))
        by[got[i]["shard"]].append((part, i))
    for s, of in by.items():
        assert {i: n for n, (_, i) in enumerate(sorted(of))} == {i: r["slot"] for i, r in got.items() if r["shard"] == s}


def test_jumps_past_the_first(spark):
    """Keys that still jump after the first few jumps get the shard that all their jumps lead to."""
    from aerocube.llm.sharding import jump_shard

    ids = spark.range(3000)
    few, all_ = (ids.select(jump_shard(F.col("id"), 5000, n).alias("s")).collect() for n in (3, 5000))
    assert few == all_ and len(set(few)) > 1500


def site():
    """Hosts with good, bad and no outcomes, below good and bad domains and suffixes: (page_id, url, bad or None)."""
    r = random.Random(4)
    out = []
    for suffix, rate in (("xyz", 0.995), ("abc", 0.02), ("mix", 0.5)):
        for d in range(12):
            worst = 0.98 if (suffix, d) == ("abc", 0) else rate
            for h in range(5):
                out += [(f"http://h{h}.d{d}.{suffix}/p{i}", int(r.random() < worst) if h and d != 11 else None) for i in range(r.randint(1, 60))]
    out += [("http://single.xyz/", 0), ("no url", 1), (None, 1), ("http://bad.example.net/de/8", None)]
    return [(i, u, b) for i, (u, b) in enumerate(out)]


def test_op9(spark, tmp_path):
    pages = site()
    spark.createDataFrame([(i, u, "") for i, u, _ in pages], "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(i, 1 - b, 0) for i, _, b in pages if b is not None], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    host = lambda u: u.split("://")[1].split("/")[0] if u and "://" in u else ""
    levels = {"host": defaultdict(lambda: [0, 0]), "domain": defaultdict(lambda: [0, 0]), "suffix": defaultdict(lambda: [0, 0])}
    up = {}
    for _, u, b in pages:
        h = host(u)
        names = {"host": h, "domain": ".".join(h.split(".")[-2:]), "suffix": h.split(".")[-1]}
        up |= {("host", h): names["domain"], ("domain", names["domain"]): names["suffix"]}
        for level, name in names.items():
            levels[level][name][0] += b is not None
            levels[level][name][1] += b or 0
    n, k = (sum(x[j] for x in levels["suffix"].values()) for j in (0, 1))
    mean, prior = {}, {s: k / n for s in levels["suffix"]}
    for level in ("suffix", "domain", "host"):
        of = levels[level]
        if level != "suffix":
            prior = {s: mean[up[level, s]] for s in of}
        m = trials([(*of[s], prior[s]) for s in of])
        mean = {s: (prior[s] * m + of[s][1]) / (of[s][0] + m) for s in of}
    blocked = {h for h in levels["host"] if h and over(mean[h], levels["host"][h][0] + m)}
    got = {r["page_id"]: r for r in queries.QUERIES["op9_url_reputation"](spark, str(tmp_path)).collect()}
    assert {i: r["verdict"] for i, r in got.items() if r["rule"] is None} == {i: "block" if host(u) in blocked else "allow" for i, u, _ in pages if got[i]["rule"] is None}
    assert "h0.d0.xyz" in blocked and "h0.d11.xyz" in blocked  # no outcomes, but a bad domain; no outcomes, but a bad suffix
    assert "h0.d0.abc" in blocked and not any(h.endswith(f".d{d}.abc") for h in blocked for d in range(1, 12))
    duck = duckdb.connect()
    for t in ("pages", "labels"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert plain_rows(duck.sql(url_filter.ORACLE).df()) == plain_rows(queries.QUERIES["op9_url_reputation"](spark, str(tmp_path)).toPandas())


def test_pipeline(spark, tables):
    from tokenizers import Tokenizer

    docs = corpus()
    got = corpus_pipeline.run(spark, tables).collect()
    bad = bad_hosts(docs)
    left = [x for x in docs if not base_failed(x[1]) and x[3] not in bad]
    components = brute_components([(x[0], x[1]) for x in left], 5)
    left = [x for x in left if components[x[0]] == x[0]]
    copies, _ = n_copies(left)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((x[0], tokenizer.encode(x[1], add_special_tokens=False).ids) for x in left for _ in range(copies[x[0]]))
    assert sorted((x["doc_id"], list(x["ids"])) for x in got) == want and len(want) > 20
    sha = lambda ids: hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert all(x["n_tokens"] == len(x["ids"]) and x["decoded_sha256"] == sha(list(x["ids"])) for x in got)


def test_links_of_documents(spark):
    """Texts whose id is divisible by 20 against all: every link lies within a component."""
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{D.replace('0.001', '0.01')}/documents.parquet'").fetchall()
    got = {r["doc_id"]: r["component_id"] for r in queries.QUERIES["op10_near_duplicates"](spark, D.replace("0.001", "0.01")).collect()}
    sets = {i: shingles(t, 4) for i, t in docs}
    n = 0
    for a in sets:
        for b in sets if a % 20 == 0 and sets[a] else ():
            if a != b and 100 * min(len(sets[a]), len(sets[b])) >= 80 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    n += 1
                    assert got[a] == got[b]
    assert n > 5


def test_band_plans():
    assert near_dup.band_plan(0.8) == (47, 5)
    for s in (0.3, 0.5, 0.7, 0.8, 0.9, 0.99, 1.0):
        bands, rows = near_dup.band_plan(s)
        assert (1 - s**rows) ** bands <= 1e-8
    with pytest.raises(ValueError, match="similarity"):
        near_dup.band_plan(0.0)
