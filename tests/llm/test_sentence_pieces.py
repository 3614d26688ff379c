"""SentencePiece encoding against the library itself, spans against the texts, and a character map grafted onto the model."""

import hashlib
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerocube.llm import queries
from aerocube.llm import sentence_pieces as sp

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
D = "/root/testdata/sf0.001"
ODD = ["", " ", "   ", "a", " a", "a ", "  two   spaces  ", "\n\n", "a\nb\tc\r", "▁", "x▁▁y ▁ z", "<s></s><unk><0x41>", "é 你好 𝒳 🏳️‍🌈", "\x00 nul \x00", " ", "hello world " * 3000, "无" * 5000, " " * 700, "�﻿"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ours(texts, model, end_id=True):
    return sp._encoded(texts, sp._Runs(model), end_id)


def test_odd_texts(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (1, " ")]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, id string, ids int").repartition(2)
    got = sp.encode(df, "doc_id", "text", PATH).withColumn("decoded", sp.decode(F.col("ids"), PATH)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = ODD[r["doc_id"]] if r["doc_id"] is not None else ""
        assert r["ids"] == library.encode(text, add_eos=True) and r["decoded"] == library.decode(r["ids"])
        raw = text.encode()
        assert b"".join(raw[a:b] for a, b in zip(r["begins"], r["ends"])) == raw
    assert sp.encode(df.filter("1 = 0"), "doc_id", "text", PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁\nabtheing.,0129é你"), st.characters(exclude_categories=["Cs"]))))
def test_any_text(text):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids, begins, ends = ours([text], sp._model(PATH))[0]
    assert ids.tolist() == library.encode(text, add_eos=True)
    assert b"".join(text.encode()[a:b] for a, b in zip(begins, ends)) == text.encode()


def test_character_map():
    """The model with the compiled map of a normaliser that the library brings along."""
    spec = sentencepiece.SentencePieceNormalizer(rule_name="nfkc").serialized_model_proto()
    compiled = dict(sp._fields(dict(sp._fields(spec))[3]))[2]
    parts = list(sp._fields(open(PATH, "rb").read()))
    size, head = len(compiled), b"\x12"
    while size > 127:
        head, size = head + bytes([size & 127 | 128]), size >> 7
    normal = b"\x0a\x04nfkc" + head + bytes([size]) + compiled + b"\x18\x01\x20\x00\x28\x01"
    data = b"".join(sp._message(k, v) for k, v in parts if k != 3) + sp._message(3, normal)
    library, model = sentencepiece.SentencePieceProcessor(model_proto=data), sp.Model(data)
    texts = [*ODD, "ﬁne ㌔グラム ①② Å é ＡＢＣ　x ½", "ｶﾞｷﾞ 한글 한", "…‥ ™ ﷺ", " a b"]
    for text, (ids, begins, ends) in zip(texts, ours(texts, model)):
        assert ids.tolist() == library.encode(text, add_eos=True), text
        assert all(a <= b for a, b in zip(begins, ends)) and (not text or max(ends) == len(text.encode()))
    ids, begins, ends = ours(["a ㌔b"], model, end_id=False)[0]
    spans = {"a ㌔b".encode()[a:b].decode() for a, b in zip(begins, ends)}
    assert "㌔" in "".join(spans) and spans <= {"", "a", " ", " ㌔", "㌔", "b", "㌔b"}


def test_decode_any_ids(spark, library):
    lists = [[1, 259, 2], [3 + 0xC3], [3 + 0xC3, 3 + 0xA9], [3 + 0xE4, 3 + 0xBD, 300], [], [2], [0, 300], [3 + 0x20, 259]]
    rows = spark.createDataFrame([(x,) for x in [*lists, None]], "ids array<int>").coalesce(1)
    got = [r[0] for r in rows.select(sp.decode(F.col("ids"), PATH)).collect()]
    assert got == [*(library.decode(x) if x else "" for x in lists), ""]


@pytest.mark.skipif(not os.path.isdir(D), reason="no tables")
def test_op13(spark, library):
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_sentence_pieces"](spark, D).collect()}
    docs = spark.read.parquet(f"{D}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, r = library.encode(d["text"] or "", add_eos=True), got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
