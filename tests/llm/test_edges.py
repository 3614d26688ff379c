"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for each operator and stage."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aerocube.llm import bpe, chat, html_text, licenses, mixing, near_dup, quality, sharding, syncmers, url_filter

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i % 9973}x{i}" for i in range(150_000))
GOOD = " ".join(f"good{i}" for i in range(80))
EXTRA = "quality string, copies int, component int, rep int, size int, shard int, key int, part int, hash int, bad int, `count` int, range int, x int"
ROWS = [
    (1, GOOD, "en", "a", 3), (1, GOOD, "en", "a", 3), (2, GOOD, None, None, None), (3, None, "en", "a", 0), (4, "", "en", "b", 0), (5, " \n\t ", "en", None, 3),
    (6, LONG, "en", "b", 1), (None, GOOD, "en", "a", 3), (None, None, None, None, None), (7, "x" * 300_000, "en", "c", 1), (8, "é 你好 <|endoftext|> 𝒳 \x0b \x00 end", "fr", "c", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    made = spark.createDataFrame([(*r, "q", 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12) for r in ROWS], f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")
    return made.repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("1 = 0")


def test_sharding(docs, none):
    got = sharding.assign_shards(docs, "doc_id", "text", 4).collect()
    assert len(got) == len(ROWS)
    for s in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert {r["size"] for r in got if r["text_crc32"] == 0} == {1}
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) == 1 and all(r["grown_shard"] in (r["shard"], 4) for r in got)
    assert sharding.assign_shards(none, "doc_id", "text", 4).count() == 0


def test_jumps_equal_a_loop(spark):
    """The shard among n + 1 differs only towards n, and shards are even."""
    ids = spark.range(20_000)
    got = ids.select(*[sharding.jump_shard(F.col("id"), n).alias(f"s{n}") for n in (1, 7, 8, 9)]).toPandas()
    assert (got.s1 == 0).all()
    for n in (7, 8):
        moved = got[got[f"s{n}"] != got[f"s{n + 1}"]]
        assert (moved[f"s{n + 1}"] == n).all() and abs(len(moved) / len(got) - 1 / (n + 1)) < 0.02
    assert got.s8.value_counts().between(2200, 2800).all()


def test_syncmers(docs, none):
    rows = syncmers.with_next(docs, "doc_id", "text", 1000).collect()
    assert len(rows) == len(ROWS)
    assert {(r["id"], r["next_id"]) for r in rows if r["id"] in (8, 7, 3, 2)} == {(8, 7), (7, 6), (3, 2), (2, 1)}
    assert [r["next_id"] for r in rows if r["id"] is None and r["next_id"]] == [8]
    assert all(bool(r["found"]) == bool(r["text"].split()) for r in rows)
    assert syncmers.with_next(none, "doc_id", "text").count() == 0


def test_anchors_are_context_free(spark):
    """Anchors inside a passage don't depend on what surrounds it."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [passage, f"some words before {passage} and some after", passage[::-1]]
    a, b, c = ({x >> 32 for x in r["a"]} for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", syncmers.anchors(F.col("t")).alias("a")).collect())
    assert a <= b and not a & c


def test_chat(spark):
    said = ["a # ## ### \\ \\\\ </turn> <next/>\n", None, "", "#" * 9, "\\### x: </turn>\n"]
    rows = [(c, t, r, x) for c in (1, None) for t, (r, x) in enumerate(zip(["user", "assistant", "assistant", "we:ird\\# role", None], said, strict=True))]
    rows += [(2, None, "assistant", "late"), (2, 1, "assistant", "b"), (2, 1, "assistant", "a"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (4, 0, "user", LONG)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)).withColumn("turns", F.lit(2))
    made = chat.format_chats(df).withColumn("back", chat.parse_chat(F.col("formatted"))).collect()
    alone = sorted((r["back"][0]["role"], r["back"][0]["text"]) for r in made if r["conv_id"] is None)
    assert alone == sorted((r or "", x or "") for c, _, r, x in rows if c is None)  # a row without a conversation is one
    got = {r["conv_id"]: r for r in made if r["conv_id"] is not None}
    assert len(got) == 4 and len(made) == 9
    assert [(r["role"], r["text"]) for r in got[1]["back"]] == [(r or "", x or "") for _, _, r, x in rows[:5]]
    assert [r["text"] for r in got[2]["back"]] == ["late", "a", "b"] and [r["text"] for r in got[3]["back"]] == ["same", "same"]
    for r in got.values():
        learnt = [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss"]]
        assert len(learnt) == sum(x["role"] == "assistant" for x in r["back"])
    assert got[4]["back"][0]["text"] == LONG
    many = spark.range(3000).select(F.lit(9).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t#"), F.col("id")).alias("text"))
    r = chat.format_chats(many).first()
    assert [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss"]] == [f"t#{i}" for i in range(3000) if i % 3]
    assert chat.format_chats(df.filter("1 = 0")).count() == 0


def test_bpe_equals_the_library(docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    encoded = bpe.encode(docs, "doc_id", "text", PATH, block=100_000)
    got = encoded.collect()
    want = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids) for r in ROWS]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], list(r["ids"])) for r in got), key=key) == sorted(want, key=key)
    assert all(r["decoded"] == tokenizer.decode(list(r["ids"]), skip_special_tokens=False) for r in got)
    again = bpe.decode(encoded.filter("size(ids) < 1000").withColumnRenamed("decoded", "was"), "ids", PATH).collect()
    assert len(again) == len(ROWS) - 2 and all(r["decoded"] == r["was"] for r in again)
    assert bpe.encode(none, "doc_id", "text", PATH).count() == 0 and bpe.decode(none.select(F.array(F.lit(1)).alias("ids")), "ids", PATH).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="decoder"):
        bpe.checked_pieces(public_tokenizers.path("byte_bpe_50k.json"))


def test_groups_of_blocks(docs, monkeypatch):
    """Blocks that don't share a table of words give the same."""
    want = sorted((r["doc_id"] or 0, r["decoded"]) for r in bpe.encode(docs, "doc_id", "text", PATH).collect())
    monkeypatch.setattr(bpe, "SHARING", 2)
    assert sorted((r["doc_id"] or 0, r["decoded"]) for r in bpe.encode(docs, "doc_id", "text", PATH, block=1000).collect()) == want


def test_decode_skips_unknown(spark):
    df = spark.createDataFrame([([320, 10**6, -1],), (None,), ([],)], "ids array<int>")
    assert sorted(r["decoded"] for r in bpe.decode(df, "ids", PATH).collect()) == ["", "", "a</w>"]


def test_html(spark):
    shell = "<html><body><nav>home about</nav>{}<footer>foot</footer></body></html>"
    article = "<article><h1>T &amp; U</h1><p>one <b>t</b>wo<br>three<div class='comments'>c</div><form>f</form><aside>s</aside></article>"
    menu = "<div><p>this menu line is on every page of the whole site today</p></div>"
    pages = [(1, "h", shell.format(article)), (2, "h", None), (3, None, ""), (1, "h", shell.format(article)), (4, "g", "<p>" + "w " * 200_000), (5, "h", "<div class=ad>x<article>in"), (6, "h", "<p>a</p><!-- <p>no</p> --><script>'</p>'</script><style>p{}</style>")]
    pages += [(10 + i, "h", f"{menu}<p>{'abcdefgh'[i] * 9} has its own words on page {i} and more {i * 77}</p>") for i in range(4)] + [(20, "other", menu)]
    df = spark.createDataFrame(pages, "page_id long, host string, html string").withColumn("text", F.lit("old")).withColumn("key", F.lit(1)).withColumn("runs", F.lit(1)).withColumn("shared", F.lit(1))
    for most in (100, 0):  # broadcast and shuffled
        got = html_text.extract_text(df, F.col("host"), most_broadcast=most)
        assert got.columns == ["page_id", "host", "html", "key", "runs", "shared", "text"]
        text = {r["page_id"]: r["text"] for r in got.collect()}
        assert got.count() == len(pages)
        assert text[1] == "T & U\none two three" and text[2] == text[3] == "" and text[5] == "in" and text[6] == "a"
        assert len(text[4]) == 399_999
        assert text[10] == "aaaaaaaaa has its own words on page 0 and more 0" and text[20].startswith("this menu")
    assert html_text.extract_text(df.filter("1 = 0"), F.col("host")).count() == 0


@pytest.mark.parametrize(("page", "text"), [
    ("<nav>n</nav><article><h1>T</h1><p>one <b>two<br>three<p>four</article><footer>f</footer>", "T\none two three\nfour"),
    ('<p>real main text here</p><script>var t="<article>x</article>"</script>', "real main text here"),
    ("<p>real main text here</p><!-- <article> -->", "real main text here"),
    ("<form action=x><nav>n</nav><h1>T</h1><p>some words of the page here</p><div class=comments>c</div></form>", "T\nsome words of the page here"),
    ('<form><div class="search-layout"><article>body<p class="notice">of note</p><div class=notice>cookie</div></article></div></form>', "body\nof note"),
    ("<main><h1>T</h1><article>a</article><p>b</p></main>", "T\na\nb"),
    ("<aside><article>teaser</article></aside><p>loose text that is long</p>", "loose text that is long"),
    ("<article>a<article class=comment>c</article>b</article>", "a\nb"),
    ("<nav>x<p>main words here", "x\nmain words here"),
    ("<head><title>t</title><meta x><p>body", "body"),
    ('<p>foo <span class="ad">ad</span> bar</p>', "foo bar"),
    ("<article><header><h1>T</h1></header><p>x</article>", "T\nx"),
    ("<header>x</header><p>abc", "abc"),
    ("<ul><li class=ad>x<li>y</ul>", "y"),
    ("<b>" * 50_000 + "<p>" * 50_000 + "</i>" * 50_000 + "<div class=ad>" * 20_000 + "x", "x"),
])
def test_structure(page, text):
    assert html_text.unique_text(page, []) == text


def test_licenses(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [("a/LICENSE", mit), ("a/b/LICENSE", gpl), ("a/x", "code"), ("a/b/c/y", "code"), ("z/w", "code"), ("z/own", f"long {GOOD}\n{mit}"), (None, None), ("a/x", "code"), ("q", ""), ("a/long", LONG), ("r/two", f"{gpl}\n{mit}"), ("r/sub/f", "x")]
    df = spark.createDataFrame(rows, "path string, text string").withColumn("score", F.lit("old")).withColumn("line", F.lit(1)).withColumn("files", F.lit(1))
    got = licenses.scan_licenses(df)
    assert sorted(got.columns) == sorted(["path", "text", "line", "files", "license", "score", "origin", "license_dir"])
    out = {r["path"]: (r["license"], r["origin"], r["license_dir"]) for r in got.collect()}
    assert got.count() == len(rows)
    assert out["a/LICENSE"] == ("MIT", "own", None) and out["a/x"] == ("MIT", "inherited", "a") and out["a/b/c/y"] == ("GPL-3.0", "inherited", "a/b")
    assert out["z/w"] == (None, None, None) and out["z/own"] == ("MIT", "own", None) and out[None] == (None, None, None)
    assert out["r/two"][0] == "GPL-3.0" and out["r/sub/f"] == ("GPL-3.0", "inherited", "r")
    assert licenses.scan_licenses(df.filter("1 = 0")).count() == 0


def brute_score(lines, templates):
    """TF-IDF cosine of distinct lines (line, files) to templates, by hand."""
    import math
    import re
    from collections import Counter

    every = [(x, n) for x, n in lines] + [(t, 1) for _, t in templates]
    terms = {x: Counter(re.findall(r"[a-z0-9]+", x.lower())) for x, _ in every}
    n = sum(k for _, k in every)
    df = Counter()
    for x, k in every:
        for t in terms[x]:
            df[t] += k
    weigh = lambda x: {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in terms[x].items()}
    norm = lambda w: math.sqrt(sum(v * v for v in w.values()))
    out = {}
    for x, _ in lines:
        w = weigh(x)
        scores = [(-round(sum(v * weigh(t).get(k, 0) for k, v in w.items()) / (norm(w) * norm(weigh(t)) or 1), 6), name) for name, t in templates]
        out[x] = min(scores)
    return out


def test_license_scores_equal_brute_force(spark):
    lines = [("Released under the MIT license", 3), ("Copyright 2020 someone else entirely", 2), ("Licensed under CC BY 4.0", 1), ("licensed under the apache license version 2", 7)]
    got = {r["line"]: (-r["score"], r["license"]) for r in licenses.score_lines(spark.createDataFrame(lines, "line string, files long")).collect()}
    want = {x: s for x, s in brute_score(lines, licenses.TEMPLATES).items() if -s[0] >= licenses.LEAST}
    assert {x: (pytest.approx(s[0], abs=2e-6), s[1]) for x, s in want.items()} == got


def test_quality(docs, none):
    got = quality.judge(docs)
    assert got.columns == docs.columns and got.count() == len(ROWS)
    by = {(r["doc_id"], r["text"]): r["quality"] for r in got.collect()}
    assert by[(3, None)]["n_words"] == by[(4, "")]["n_words"] == by[(5, " \n\t ")]["n_words"] == 0 and by[(4, "")]["base_failed"]
    assert by[(1, GOOD)]["kept"] and by[(6, LONG)]["n_words"] == 150_000 and by[(6, LONG)]["kept"]
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r["quality"] for r in kept.collect()} == {"q"}
    assert quality.keep_good(none).count() == 0


def brute_repeats(words):
    from collections import Counter

    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    return len({i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)})


def test_figures_equal_brute_force(spark):
    texts = ["a b c a b c d", "a a a a", "x y", "one two three\n\n \none two three\n# $", "a b c\x0bd e f\x1cg a b c", ("p q r s " * 50).strip(), ""]
    got = [r["q"] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(quality.figures(F.col("t")).alias("q")).collect()]
    for t, q in zip(texts, got, strict=True):
        words = t.encode().split()
        assert (q["n_words"], q["n_repeat_words"]) == (len(words), brute_repeats(words))
        assert q["word_chars"] == sum(len(w.decode()) for w in words)
    assert got[3]["n_dup_lines"] == 1 and got[3]["n_symbols"] == 2


def test_a_bad_host_goes(spark):
    rows = [(i, "few words", "bad") for i in range(300)] + [(1000, GOOD, "bad")] + [(2000 + i, GOOD, "fine") for i in range(300)] + [(3000, "few words", "fine")]
    kept = {r["doc_id"] for r in quality.keep_good(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert kept == {2000 + i for i in range(300)}


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing(spark, docs, none):
    for sizes in ({"a": 10, "b": 1000, None: 3, "": 50, "ä": 7}, {"a": 0, "b": 0}, {"x": 5}):
        rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
        assert got == pytest.approx(brute_targets(sizes))
    got = mixing.copies(docs, "doc_id", "text", "source")
    assert got.count() == len(ROWS) and got.filter("copies < 0 or copies > 3").count() == 0
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == got.agg(F.sum("copies")).first()[0]
    assert mixing.mix(none).count() == 0


def test_mix_comes_near_its_targets(spark):
    rows = spark.range(6000).select("id", F.repeat(F.lit("w "), (F.col("id") % 50 + 1).cast("int")).alias("text"), F.when(F.col("id") % 3 != 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("source"))
    got = mixing.copies(rows.withColumnRenamed("id", "doc_id"), "doc_id", "text", "source")
    again = mixing.copies(rows.withColumnRenamed("id", "doc_id").repartition(7), "doc_id", "text", "source")
    assert sorted(map(tuple, got.select("id", "copies").collect())) == sorted(map(tuple, again.select("id", "copies").collect()))
    per = got.groupBy("target", "source_size").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 50 for r in per)


def test_urls(spark):
    urls = ["http://WWW.Example.com/en/7?x", "https://a.net/de/8", "https://b.example.net/de/8#y", "no scheme", None, "", "x://", "ftp://org/es/", "http://notexample.com/en/7", "http://h.org/x://y/es/", "http://a.com/en"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0])], "page_id long, url string").withColumn("host", F.lit(1)).withColumn("n", F.lit(2))
    none = spark.createDataFrame([], "id long, bad int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df, "page_id", "url", none).collect()}
    assert url_filter.filter_urls(df, "page_id", "url", none).count() == len(urls) + 1
    assert got[0] == ("www.example.com", "/en/7", "example.com/en/7", "allow") and got[1][2:] == ("net/de/", "allow") and got[2][2:] == ("example.net/de/8", "block")
    assert got[3] == got[4] == got[5] == ("", "", None, "allow") and got[7][2:] == ("org/es/", "block") and got[8][2:] == ("com/en/", "block") and got[10][2] is None
    assert got[9] == ("h.org", "/x://y/es/", None, "allow")
    bad = spark.createDataFrame([(i, 1) for i in range(100, 160)] + [(None, 1), (100, None)] + [(200 + i, 0) for i in range(60)], "id long, bad int")
    pages = spark.createDataFrame([(i, "http://spam.xyz/") for i in range(100, 161)] + [(200 + i, f"http://fine{i % 20}.abc/") for i in range(60)] + [(300, "http://new.abc/"), (301, "http://new.spam.xyz/")], "page_id long, url string")
    verdicts = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(pages, "page_id", "url", bad).collect()}
    assert verdicts[160] == verdicts[301] == "block" and verdicts[204] == verdicts[300] == "allow"  # new ones by domain and suffix
    assert url_filter.filter_urls(df.filter("1 = 0"), "page_id", "url", none).count() == 0


def test_near_duplicates(spark, docs, none):
    got = near_dup.near_duplicates(docs)
    assert got.count() == len(ROWS)
    by = {r["doc_id"]: r for r in got.filter("doc_id is not null").collect()}
    assert by[1]["component_id"] == by[2]["component_id"] == 1 and by[1]["kept"] and not by[2]["kept"]
    assert all(by[i]["n_shingles"] == 0 and by[i]["kept"] and by[i]["component_id"] == i for i in (3, 4, 5))
    assert all(r["component_id"] is None and r["kept"] for r in got.filter("doc_id is null").collect())
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8]
    assert near_dup.near_duplicates(none).count() == 0 and near_dup.keep_one(none).count() == 0


def test_stages_take_it_all(spark, docs, none):
    for rows in (docs, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, "").columns == rows.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, rows, "").count() == rows.count()


def test_digests_are_lowercase_hex(spark):
    assert spark.range(1).select(F.sha2(F.lit("a"), 256).alias("x")).first()["x"] == hashlib.sha256(b"a").hexdigest()


def test_listed_suffixes(spark):
    hosts = spark.createDataFrame([(h,) for h in ("a.b.co.uk", "co.uk", "x.uk", "b.com", "", "www.city.kawasaki.jp")], "host string")
    listed = spark.createDataFrame([(s,) for s in ("co.uk", "uk", "kawasaki.jp", "co.uk")], "suffix string")
    got = {r["host"]: (r["suffix"], r["domain"]) for r in url_filter.with_domains(hosts, listed).collect()}
    assert got == {"a.b.co.uk": ("co.uk", "b.co.uk"), "co.uk": ("co.uk", "co.uk"), "x.uk": ("uk", "x.uk"), "b.com": ("com", "b.com"), "": ("", ""), "www.city.kawasaki.jp": ("kawasaki.jp", "city.kawasaki.jp")}
    assert {r["domain"] for r in url_filter.with_domains(hosts).collect()} == {"co.uk", "x.uk", "b.com", "", "kawasaki.jp"}


def test_targets_of_many_sources(spark):
    """The level found by sums over sorted parts, against filling up one source after the other."""
    sizes = [(f"s{i:04d}", (i * 7919) % 500 + (50_000 if i == 17 else 0)) for i in range(800)] + [(None, 3), ("empty", 0)]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, size long").repartition(5)).collect()}
    order = sorted((s for s, _ in sizes), key=lambda s: (s is None, s or ""))
    weight, cap = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, {s: 3.0 * n for s, n in sizes}
    left, open_ = float(sum(n for _, n in sizes)), set(order)
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > cap[s]}
        if not full:
            break
        left, open_ = left - sum(cap[s] for s in full), open_ - full
    assert all(abs(got[s] - (weight[s] * level if s in open_ else cap[s])) < 1e-6 * (1 + got[s]) for s in order)
