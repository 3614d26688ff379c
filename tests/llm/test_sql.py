"""Queries with SQL against DuckDB; the others against brute force on the smallest tables."""

import hashlib
import os

import duckdb
import pytest

from aerocube.llm import queries

from tests.test_oracle import D, TABLES, rows

pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    got, want = queries.QUERIES[name](spark, D).toPandas(), duck.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op2(spark, duck):
    docs = duck.sql("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id DESC").fetchall()
    want = {i: (len(t), sha(t[: len(t) - len(t) // 3] + docs[(k + 1) % len(docs)][1][: len(t) // 3])) for k, (i, t) in enumerate(docs)}
    got = queries.QUERIES["op2_syncmers"](spark, D).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == want
    same = {}
    for r in got:
        assert same.setdefault(dict(docs)[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert sum(r["near_edited"] > 0.4 > r["near_next"] for r in got) > 0.95 * len(got)


def test_op5(spark, duck):
    """Every article of these pages, rid of its tags by another way."""
    import html
    import re

    got = {r["page_id"]: r["text"] for r in queries.QUERIES["op5_html_text"](spark, D).collect()}
    for page, raw in duck.sql("SELECT page_id, html FROM pages").fetchall():
        article = raw[raw.index("<article>") + 9 : raw.index("</article>")]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("<h1>|</h1>|<p>|</p>", article)]
        assert got[page] == "\n".join(filter(None, parts))


def test_op1_and_op8(spark, duck):
    got = queries.QUERIES["op1_jump_shards"](spark, D).toPandas()
    assert len(got) == duck.sql("SELECT count(*) FROM documents").fetchall()[0][0] and (got.groupby("shard").slot.max() + 1 == got.groupby("shard").size()).all()
    mixed = queries.QUERIES["op8_mix_sources"](spark, D).toPandas()
    assert mixed.taken.le(3 * mixed["size"]).all() and abs(mixed.taken.sum() - mixed["size"].sum()) < 0.1 * mixed["size"].sum()


def test_op6(spark):
    got = queries.QUERIES["op6_license_scan"](spark, D).toPandas()
    assert set(got.origin.dropna()) <= {"own", "inherited"} and (got.license.isna() == got.origin.isna()).all()
