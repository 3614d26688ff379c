"""The whole license scan, inheritance included, against a plain scan of each file."""

import math
import random
from collections import Counter, defaultdict

import duckdb
import pytest
import regex

from aerocube.llm import licenses as L, queries
from tests.test_oracle import D


def words(text):
    return len(regex.findall(r"[^\x20\x09-\x0D]+", text))


def terms(text):
    return Counter(regex.findall("[a-z0-9]+", text.lower()))


def split(pattern, text):
    return regex.split(pattern, text)


def units(text):
    """(kind, unit) of the lines and sentences that may name a license."""
    joined = [regex.sub(L.WRAP, " ", x).strip(" ") for x in split(L.GAP, text)]
    found = [(0, x.strip(" ")) for x in text.split("\n")] + [(1, x) for p in joined for x in split(L.SENTENCE, p)]
    return [(k, x) for k, x in found if regex.search(L.HEADER, x)]


def blocks(text):
    paragraphs, lines = split(L.GAP, text), text.split("\n")
    named = [i for i, p in enumerate(paragraphs) if regex.search(L.HEADER, p)]
    middle = "\n\n".join(paragraphs[named[0] : named[-1] + 1]) if named else ""
    code = next((i for i, x in enumerate(lines) if regex.search(L.NOT_COMMENT, x)), None)
    opening = "\n".join(lines[:code]) if code is not None else ""
    comment = regex.search(r"(?s)\A(?:#![^\n]*\n)?\s*/\*(.*?)\*/", text)
    found = [(2, text), (3, middle), (4, comment[1] if comment else ""), (5, opening)]
    return [(k, x) for k, x in found if regex.search(L.HEADER, x) and (k == 2 or x != text)]


def cosine(a, b, weight):
    norm = lambda t: math.sqrt(sum((n * weight(x)) ** 2 for x, n in t.items()))
    dot = sum(n * weight(x) * b[x] * weight(x) for x, n in a.items() if x in b)
    return round(dot / (norm(a) * norm(b)), 6) if dot else 0.0


def scan(files):
    """(license, score, origin, license_dir) of each file (path, text)."""
    hits = {p: t for p, t in files if t is not None and regex.search(L.HEADER, t)}
    weight = Counter()  # lines count as often as files hold them, each file's once
    for t in hits.values():
        weight.update({x for _, x in units(t)})
    known = [(name, terms(t)) for name, t in L.TEMPLATES]
    df = Counter()
    for line, n in weight.items():
        df.update({t: n for t in terms(line)})
    for _, t in known:
        df.update(dict.fromkeys(t, 1))
    total = sum(weight.values()) + len(known)
    idf = lambda t: math.log((1 + total) / (1 + df[t])) + 1
    full = [(name, terms(t)) for name, t in L.FULL_TEXTS]
    full_df = Counter(t for _, c in full for t in c)
    full_idf = lambda t: math.log((1 + len(full)) / (1 + full_df[t])) + 1
    own, holds = {}, defaultdict(list)
    for path, text in hits.items():
        found = defaultdict(lambda: [0, []])
        for kind, unit in units(text):
            best = min(((-cosine(terms(unit), t, idf), name) for name, t in known), default=(0, ""))
            if best[0] <= -L.LEAST:
                found[kind][0] += words(unit)
                found[kind][1].append(best)
        for kind, unit in blocks(text):
            best = min((-cosine(terms(unit), t, full_idf), name) for name, t in full)
            if best[0] <= -L.LEAST:
                found[kind][0] += words(unit)
                found[kind][1].append(best)
        for name in regex.findall(L.SPDX, text):
            found[6][1].append((-1.0, name))
        if found:
            own[path] = min(b for _, bs in found.values() for b in bs)
            named = regex.search(L.NAMED, path) and not regex.search(L.CODE, path)
            if named or max(n for n, _ in found.values()) >= L.SHARE * words(text):
                holds[path.rpartition("/")[0]].append(own[path])
    out = {}
    for path, _ in files:
        if path in own:
            out[path] = (own[path][1], -own[path][0], "own", None)
            continue
        at = path.rpartition("/")[0]
        while at not in holds and at:
            at = at.rpartition("/")[0]
        best = min(holds[at]) if at in holds else None
        out[path] = (best[1], -best[0], "inherited", at) if best else (None, None, None, None)
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for p, (name, score, origin, at) in want.items():
        r = got[p]
        assert (r["license"], r["origin"], r["license_dir"]) == (name, origin, at), p
        assert (r["score"] is None) == (score is None) and (score is None or r["score"] == pytest.approx(score, abs=2e-6)), p


def test_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, source, text FROM '{D}/documents.parquet'").fetchall()
    path = lambda i, s: "/".join([s if s is not None else "none", str(i // 1000), str(i // 100)][: i % 3 + 1] + [f"{i}.txt"])
    got = {r["path"]: r for r in queries.QUERIES["op6_license_scan"](spark, D).collect()}
    same(got, scan([(path(i, s), t) for i, s, t in docs]))


def test_trees(spark):
    """License files, headers and prose at all depths: texts that are whole, cut, wrapped, among others or only named."""
    r = random.Random(8)
    full = dict(L.FULL_TEXTS)
    prose = lambda n: " ".join(r.choice(["alpha", "beta", "gamma", "delta", "license", "code"]) for _ in range(n))
    made = []
    for i in range(120):
        folder = "/".join(f"d{r.randrange(3)}" for _ in range(r.randint(0, 4)))
        text = full[r.choice(["MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "Unlicense"])]
        kind = r.randrange(7)
        body = [prose(40), text, f"/*\n{text}\n*/\n\nint x;\n", "\n".join(f"# {x}" for x in text.split("\n")) + "\n\nx = 1\n", f"{prose(60)}. Released under the MIT License. {prose(9)}", "SPDX-License-Identifier: Apache-2.0\n" + prose(30), f"{prose(80)}\n\n{text}\n\n{prose(50)}"][kind]
        name = r.choice(["LICENSE", "COPYING.txt", "a.c", "b.py", "readme.md"]) if kind else "z.txt"
        made.append((f"{folder}/{i}/{name}" if r.random() < 0.5 and folder else f"{i}-{name}" if not folder else f"{folder}/{name}-{i}", body))
    files = list({f"t/{p}": (f"t/{p}", t) for p, t in made}.values()) + [("t/d0/none", None), ("t/d1/empty", ""), ("other/plain", "words"), ("alone", "words")]
    got = {x["path"]: x for x in L.scan_licenses(spark.createDataFrame(files, "path string, text string").repartition(3)).collect()}
    want = scan(files)
    same(got, want)
    assert {v[2] for v in want.values()} == {"own", "inherited", None}
