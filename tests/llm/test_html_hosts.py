"""What a host repeats, against all runs counted one by one."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from aerocube.llm import html_text as H


def brute(pages):
    """The text of each page (id, host, html): each run of RUN tokens of each distinct stream is counted."""
    seen = defaultdict(set)
    for _, host, page in pages:
        for part, s in enumerate(H.streams(H.blocks(page))):
            if len(s) >= H.RUN:
                seen[host, part].add(tuple(s))
    windows = lambda s: {s[i : i + H.RUN] for i in range(len(s) - H.RUN + 1)}
    bad = {}
    for k, of in seen.items():
        n = Counter(w for s in of for w in windows(s))
        bad[k] = {w for w, c in n.items() if c >= H.LEAST and c > H.SHARE * len(of)}
    out = {}
    for i, host, page in pages:
        found = H.blocks(page)
        kind = H.BODY if any(k == H.BODY for k, _ in found) else H.LOOSE
        part = int(kind != H.BODY)
        tokens = tuple(H.streams(found)[part])
        gone = {i + j for i in range(len(tokens) - H.RUN + 1) if tokens[i : i + H.RUN] in bad.get((host, part), ()) for j in range(H.RUN)}
        lines, at, size, left = [], 0, 0, 0
        for k, text in found:
            if (k == H.BODY) != (kind == H.BODY):
                continue
            words = text.split(" ")
            if k == kind:
                keep = [w for j, w in enumerate(words) if at + j not in gone]
                size, left = size + len(words), left + len(keep)
                lines += [" ".join(keep)] if keep else []
            at += len(words)
        if (kind == H.BODY and 2 * left < size) or (kind == H.LOOSE and 0 < left < H.RUN):
            lines = [text for k, text in found if k == kind]
        out[i] = "\n".join(lines)
    return out


def site(seed, pages=240):
    """Hosts of one to a hundred pages, with and without article elements: menus, lines within articles, quotes, copies."""
    r = random.Random(seed)
    words = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(n))
    menus = {h: [words(r.randint(8, 30)) for _ in range(4)] for h in range(7)}
    lines = {h: words(14) for h in range(7)}
    quote, out, texts = words(40), [], []
    for i in range(pages):
        h = min(int(r.expovariate(0.6)), 6)
        text = [words(r.randint(3, 60)) for _ in range(r.randint(1, 4))]
        if texts and r.random() < 0.25:
            text = [*r.choice(texts), *([words(2)] if r.random() < 0.5 else [])]
        if r.random() < 0.2:
            text.insert(0, quote)
        texts.append(text)
        if r.random() < 0.8:
            text = [*text, lines[h]]
        body = "".join(f"<p>{p}</p>" for p in text)
        menu = "".join(f"<div>{m}</div>" for m in menus[h] if r.random() < 0.8)
        shape = r.choice(["<article>{b}</article>{m}", "{m}<div>{b}</div>", "<nav>{m}</nav><main>{b}</main>", "<nav>{m}</nav>{b}"])
        out.append((i, f"h{h}.example.org", shape.format(b=body, m=menu)))
    return out


def test_texts_equal_brute_force(spark):
    for seed in (1, 2):
        pages = site(seed)
        got = H.extract_text(spark.createDataFrame(pages, "page_id long, host string, html string").repartition(3), F.col("host"))
        want = brute(pages)
        assert {r["page_id"]: r["text"] for r in got.collect()} == want
        plain = {i: H.unique_text(p, []) for i, _, p in pages}
        changed = [i for i in want if want[i] != plain[i]]
        assert 40 < len(changed) < len(pages)


def test_a_carried_article_stays(spark):
    """Pages of a host that differ in a date only keep their article, marked or not; a menu goes."""
    r = random.Random(3)
    words = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    article, menu = words(80), words(12)
    pages = [(i, "a.org", f"<div>{menu}</div><article><p>{article}</p><p>day {i}</p></article>") for i in range(6)]
    pages += [(10 + i, "b.org", f"<p>{article}</p><p>day {i}</p>") for i in range(2)] + [(20 + i, "b.org", f"<div>{menu}</div><p>{words(50)}</p>") for i in range(5)]
    got = {x["page_id"]: x["text"] for x in H.extract_text(spark.createDataFrame(pages, "page_id long, host string, html string"), F.col("host")).collect()}
    assert all(got[i] == f"{article}\nday {i}" for i in range(6)) and all(got[10 + i] == f"{article}\nday {i}" for i in range(2))
    assert all(menu not in got[20 + i] and len(got[20 + i].split()) == 50 for i in range(5))
