"""The caller's columns may have any name: each operator gets a column for every name that its module writes."""

import inspect
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aerocube.llm import bpe, common, html_text, licenses, mixing, near_dup, quality, sentence_pieces, url_filter, whitening

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = " ".join(f"word{i}" for i in range(70))


def named(df, *modules):
    """df with further columns, and the values of these."""
    known = {c.lower() for c in df.columns}
    names = {n.lower() for m in (*modules, common) for n in re.findall(r'"(_*[A-Za-z][A-Za-z_0-9]*)"', inspect.getsource(m))} - known
    names |= {f"__{n}" for n in names} - known
    names = sorted(names)
    return df.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)]), {n: k for k, n in enumerate(names)}


def same(got, want, *without):
    rows = got.collect()
    assert rows and all(r[n] == k for r in rows for n, k in want.items() if n not in without)
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, WORDS, "a"), (2, WORDS + " x", "a"), (3, WORDS.replace("word", "w"), "b"), (3, WORDS.replace("word", "w"), "b"), (3, "some other " + WORDS, "b"), (None, WORDS, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_quality(docs):
    df, want = named(docs, quality)
    assert len(same(quality.keep_good(df), want)) == 6
    assert all(r["quality"]["kept"] for r in same(quality.judge(df), want, "quality"))


def test_near_dup(docs):
    df, want = named(docs, near_dup)
    assert sorted(str(r["doc_id"]) for r in same(near_dup.keep_one(df), want)) in (["1", "3", "None"], ["1", "None"])


def test_mixing(docs):
    df, want = named(docs, mixing)
    assert set(mixing.mix(df).columns) == set(df.columns)
    same(mixing.mix(df), want)


def test_pipeline(docs, spark):
    df, want = named(docs, quality, near_dup, mixing)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, "")
        assert same(df, want), name


def test_licenses(spark):
    df, want = named(spark.createDataFrame([("a/LICENSE", "Released under the MIT License."), ("a/x", "y")], "path string, text string"), licenses)
    got = same(licenses.scan_licenses(df), want, "license", "score", "origin", "license_dir")
    assert {r["license"] for r in got} == {"MIT"}


def test_html(spark):
    menu = "<div><p>this menu line is on every page of the whole site today</p></div>"
    pages = [(i, "h", f"{menu}<p>{'abcdefgh'[i] * 9} has its own words on page {i} and more {i * 77}</p>") for i in range(4)]
    df, want = named(spark.createDataFrame(pages, "page_id long, site string, page string"), html_text)
    for most in (100, 0):
        got = same(html_text.extract_text(df, F.col("site"), page="page", most_broadcast=most), want, "text")
        assert all(r["text"].startswith("abcdefgh"[r["page_id"]]) for r in got)


def test_decode(spark):
    df, want = named(spark.createDataFrame([([320],)], "ids array<int>"), bpe)
    assert same(bpe.decode(df, "ids", public_tokenizers.path("word_bpe_49k.json")), want, "decoded")[0]["decoded"] == "a</w>"


def test_others(docs, spark):
    df, _ = named(docs, near_dup, mixing, bpe, sentence_pieces, url_filter)
    assert near_dup.near_duplicates(df).count() == mixing.copies(df, "doc_id", "text", "source").count() == 6
    assert sentence_pieces.encode(df, "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model")).count() == 6
    assert bpe.encode(df, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json")).count() == 6
    vectors, _ = named(spark.createDataFrame([(1, [0.5, 1.0]), (2, [1.0, 0.5])], "vec_id long, embedding array<double>"), whitening)
    assert whitening.whiten(vectors, "vec_id", "embedding").count() == 4
