"""License scans: units of a text against templates by TF-IDF cosine, then inheritance along directories.

Units are lines and sentences that may name a license, scored against names and notices, and blocks (the whole text,
its opening comment, all from the first to the last paragraph that may name one), scored against full license texts
with weights that come from those, so that a block needs nothing but its own row. SPDX identifiers are read as they stand. DataFrame functions only. Each distinct unit is scored once,
whatever the number of files that carry it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import all_but, n_words, work_table

#: License ids and the sentences that name them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "Released under the GNU General Public License, version 2."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."),
    ("ISC", "ISC License"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Full license texts by id.
FULL_TEXTS = [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
HEADER = r"(?i)licen[sc]|copyright|spdx|redistribut|permission is hereby|public domain"
TERM = r"([a-z0-9]+)"
LEAST, SHARE = 0.8, 0.5
#: Between paragraphs: lines without a letter or digit, so comment marks don't hide a blank line.
GAP = r"\n[^\p{L}\p{N}]*\n"
WRAP, SENTENCE = r"\n[^\p{L}\p{N}\n]*", r"(?<=[.!?])\s+(?=[\"'(<]?\p{Lu})"
NOT_COMMENT = r"^[ \t]*(?!//|#|/\*|\*|--|;|%|<!--|\"\"\"|dnl\b|rem\b)[^\s]"
_ID = r"\(*[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?\)*"
SPDX = rf"(?i)SPDX-License-Identifier:[ \t]*({_ID}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_ID})*)"
#: Names of license files: LICENSE, COPYING.LESSER, MIT-LICENSE, LICENSE-APACHE.md, NOTICE.txt, but no code.
NAMED = r"(?i)(?:^|/)(?:[a-z0-9.]+[-_])?(?:licen[sc]es?|copying|notice|unlicen[sc]e)(?:[-_.][a-z0-9.+_-]*)?$"
CODE = r"(?i)\.(?:py|pyi|js|mjs|ts|tsx|jsx|c|h|cc|cpp|hpp|cs|java|kt|scala|go|rs|rb|php|pl|sh|swift|sql|r|m|json|xml|ya?ml|toml|css|html?)$"


def text_units(text: Column) -> Column:
    """The units of a text that may name a license, as (kind, unit): 0 lines, 1 sentences, across line ends."""
    joined = F.transform(F.split(text, GAP), lambda x: F.trim(F.regexp_replace(x, WRAP, " ")))
    kinds = [F.transform(F.split(text, "\n"), F.trim), F.flatten(F.transform(joined, lambda x: F.split(x, SENTENCE)))]
    return F.concat(*[F.transform(F.filter(k, lambda x: x.rlike(HEADER)), lambda x, n=n: F.struct(F.lit(n).alias("kind"), x.alias("unit"))) for n, k in enumerate(kinds)])


def text_blocks(text: Column) -> Column:
    """The blocks of a text that may be a license text, as (kind, unit): 2 the whole, and if they are less, 3 from the
    first to the last paragraph that may name one, 4 the opening block comment, 5 the opening comment lines."""
    paragraphs, lines = F.split(text, GAP), F.split(text, "\n")
    named = F.transform(paragraphs, lambda x: x.rlike(HEADER))
    first, last = F.array_position(named, True), F.size(named) - F.array_position(F.reverse(named), True) + 1
    middle = F.array_join(F.slice(paragraphs, F.greatest(first, F.lit(1)).cast("int"), F.greatest(last - first + 1, F.lit(0)).cast("int")), "\n\n")
    code = F.array_position(F.transform(lines, lambda x: x.rlike(NOT_COMMENT)), True)
    opening = F.array_join(F.slice(lines, F.lit(1), F.greatest(code - 1, F.lit(0)).cast("int")), "\n")
    comment = F.regexp_extract(text, r"(?s)\A(?:#![^\n]*\n)?\s*/\*(.*?)\*/", 1)
    found = F.array(*[F.struct(F.lit(n + 2).alias("kind"), c.alias("unit")) for n, c in enumerate((text, middle, comment, opening))])
    return F.filter(found, lambda x: x["unit"].rlike(HEADER) & ((x["kind"] == 2) | (x["unit"] != text)))


def score_lines(lines: DataFrame, templates=TEMPLATES, least: float = LEAST, text: str = "line") -> DataFrame:
    """(line, license, score) for each distinct line of lines (line, files) that is near enough to a template.

    text: the column of the words, if line is a key for it.

    Weights are term count times ln((1 + n) / (1 + files with the term)) + 1, n being all lines and templates, each
    as often as files have it. The best template wins; ties go to the license id that sorts first.
    """
    spark = lines.sparkSession
    known = spark.createDataFrame([(name, str(i), line) for i, (name, line) in enumerate(templates)], "license string, line string, text string")
    own = lines.select("line", F.lit(None).cast("string").alias("license"), F.col(text).alias("text"), F.col("files").cast("double").alias("files"))
    every = own.unionByName(known.withColumn("files", F.lit(1.0)))
    terms = every.select("line", "license", "files", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(1))).alias("term"))
    terms = terms.groupBy("line", "license", "files", "term").agg(F.count("*").cast("double").alias("tf"))
    n = every.agg(F.coalesce(F.sum("files"), F.lit(0.0))).first()[0]  # one number
    idf = terms.groupBy("term").agg((F.log((1 + F.lit(n)) / (1 + F.sum("files"))) + 1).alias("idf"))
    weighed = terms.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = weighed.groupBy("line", "license").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("norm"))
    # the templates are a fixed list, so their terms are too
    shared = F.broadcast(weighed.filter("license is not null").select("term", "license", F.col("line").alias("template"), F.col("w").alias("tw")))
    dots = weighed.filter("license is null").drop("license").join(shared, "term").groupBy("line", "license", "template").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    tnorms = F.broadcast(norms.filter("license is not null").select("license", F.col("line").alias("template"), F.col("norm").alias("tn")))
    scored = dots.join(norms.filter("license is null").select("line", "norm"), "line").join(tnorms, ["license", "template"])
    scored = scored.withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("tn")), 6)).filter(F.col("score") >= least)
    best = scored.groupBy("line").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
    return best.select("line", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))


def term_counts(text: Column) -> Column:
    """(term, tf) of the distinct terms of a text, in its own row: the lengths of the runs of the sorted terms."""
    terms = F.sort_array(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(1)))
    starts = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
    runs = lambda s, b: F.transform(b, lambda i, k: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(b, k + 1), F.size(s)) - i).cast("double").alias("tf")))
    once = lambda c, f: F.get(F.transform(F.array(c), f), F.lit(0))  # noqa: E731  # a lambda's variable is evaluated once
    return once(terms, lambda s: F.when(F.size(s) > 0, once(starts(s), lambda b: runs(s, b))))


def score_blocks(texts: DataFrame, full=FULL_TEXTS, least: float = LEAST) -> DataFrame:
    """(key, kind, words, license, s) of the blocks of texts (key, text) that are near enough to a full text.

    Weights as in score_lines, but counted over the full texts alone; terms that are in none of them weigh most.
    """
    counts = [(name, Counter(re.findall(TERM, text.lower()))) for name, text in full]
    df = Counter(term for _, c in counts for term in c)
    idf = {term: math.log((1 + len(counts)) / (1 + k)) + 1 for term, k in df.items()}
    norms = [math.sqrt(sum((tf * idf[t]) ** 2 for t, tf in c.items())) for _, c in counts]
    # None for the block's own square, then each full text that has the term
    rows = [(t, w, [(None, 0.0)] + [(name, c[t] * w / norm) for (name, c), norm in zip(counts, norms, strict=True) if t in c]) for t, w in idf.items()]
    known = texts.sparkSession.createDataFrame(rows, "term string, idf double, of array<struct<license: string, tw: double>>")
    # outer, as for others Spark adds filters that compute the arrays again
    # words and terms are made before the rows are, else Spark would count the words again for each term
    made = F.transform(text_blocks(F.col("text")), lambda u: F.struct(u["kind"].alias("kind"), n_words(u["unit"]).alias("words"), term_counts(u["unit"]).alias("terms")))
    found = texts.select("key", F.explode_outer(made).alias("u"))
    terms = found.select("key", "u.kind", "u.words", F.explode_outer("u.terms").alias("t"))
    terms = terms.select("key", "kind", "words", "t.term", "t.tf").join(F.broadcast(known), "term", "left")  # a fixed table
    w = F.col("tf") * F.coalesce("idf", F.lit(math.log(1 + len(counts)) + 1))
    parts = terms.select("key", "kind", "words", w.alias("w"), F.explode_outer("of").alias("of"))
    parts = parts.groupBy("key", "kind", "words", F.col("of.license").alias("license")).agg(F.sum(F.col("w") * F.when(F.col("of.license").isNull(), F.col("w")).otherwise(F.col("of.tw"))).alias("v"))
    best = parts.groupBy("key", "kind", "words").agg(F.sqrt(F.max(F.when(F.col("license").isNull(), F.col("v")))).alias("norm"), F.min(F.when(F.col("license").isNotNull(), F.struct((-F.col("v")).alias("v"), "license"))).alias("b"))
    return best.select("key", "kind", "words", F.col("b.license").alias("license"), F.round(F.col("b.v") / F.col("norm"), 6).alias("s")).filter(F.col("s") <= -least)


def parent(path: Column) -> Column:
    """The directory of a path, '' for one without."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def ancestors(directory: Column) -> Column:
    """A directory and all above it, down to ''."""
    parts = F.split(directory, "/")
    own = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    return F.array_distinct(F.concat(F.array(F.lit("")), own))


def score_units(texts: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """(key, kind, words, license, s) of the units of texts (key, text, files) that are near enough to a template; s is
    minus the score. Units go by their MD5, so that long ones travel once."""
    found = texts.select("key", "files", F.explode(text_units(F.col("text"))).alias("u"))
    found = work_table(found.select("key", "files", F.md5("u.unit").alias("line"), "u.kind", n_words(F.col("u.unit")).alias("words"), F.col("u.unit").alias("text")))
    once = found.groupBy("key", "line").agg(F.first("files").alias("files"))
    counted = once.groupBy("line").agg(F.sum("files").alias("files"))
    counted = work_table(counted.join(found.select("line", "text").dropDuplicates(["line"]), "line"))
    scored = score_lines(counted, templates, least, "text")
    return found.select("key", "line", "kind", "words").join(scored, "line").select("key", "kind", "words", "license", (-F.col("score")).alias("s"))


def scan_licenses(files: DataFrame, templates=TEMPLATES, least: float = LEAST, share: float = SHARE, full=FULL_TEXTS) -> DataFrame:
    """files (path, text, ...) with license, score, origin and license_dir.

    origin: `own` if one of the file's units matches a template or full text, or it has an SPDX identifier (score 1,
    its expression as written); the best counts, ties by license id. Else `inherited` from the license file in the
    nearest directory at or above; else null, as license, score and license_dir. A license file is one with an own
    license that is named like one (LICENSE, COPYING, NOTICE), or whose matching lines, sentences or block
    hold at least `share` of its words; of several in one directory the best match holds for it. A null path lies in the
    root; null and empty texts have no units; very long ones are scanned whole. Repeated rows are judged each. Columns of
    files, of any name, stay; those called like the four are replaced. An empty table gives no rows.
    """
    text, path = F.col("text").cast("string"), F.col("path")
    dir_, key = F.coalesce(parent(path), F.lit("")), F.md5(text)
    rows = files.select(F.struct("*").alias("row"), dir_.alias("dir"), key.alias("key"))  # the caller's names stay by themselves
    hit, named = text.rlike(HEADER), F.coalesce(path.rlike(NAMED) & ~path.rlike(CODE), F.lit(False))
    narrow = work_table(files.select(dir_.alias("dir"), named.alias("named"), F.when(hit, key).alias("key"), F.when(hit, text).alias("text")))
    lined = narrow.filter("key is not null")
    # a text's license depends on the text alone: score each distinct one once
    texts = lined.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("files"))
    texts = work_table(texts.withColumn("n_words", n_words(F.col("text"))))
    near = score_units(texts, templates, least).unionByName(score_blocks(texts, full, least))
    said = texts.select("key", F.explode(F.regexp_extract_all("text", F.lit(SPDX), F.lit(1))).alias("license"))
    said = said.select("key", F.lit(6).alias("kind"), F.lit(0).cast("long").alias("words"), "license", F.lit(-1.0).alias("s"))  # a tag speaks for its file only
    kinds = near.unionByName(said).groupBy("key", "kind").agg(F.sum("words").alias("words"), F.min(F.struct("s", "license")).alias("own"))
    groups = kinds.groupBy("key").agg(F.max("words").alias("words"), F.min("own").alias("own")).join(texts.select("key", "n_words"), "key")
    # written, so that Spark can broadcast a small side, or split a text or directory that very many files share
    groups = work_table(groups.select("key", "own", (F.col("words") >= share * F.col("n_words")).alias("mostly")))
    rows = rows.join(groups.select("key", "own"), "key", "left")
    holders = lined.select("dir", "key", "named").distinct().join(groups, "key").filter("named or mostly")
    holders = holders.groupBy("dir").agg(F.min("own").alias("held"))
    places = narrow.select("dir").distinct().select("dir", F.explode(ancestors(F.col("dir"))).alias("above"))
    near = places.join(holders.withColumnRenamed("dir", "above"), "above")
    near = work_table(near.groupBy("dir").agg(F.max(F.struct(F.length("above").alias("depth"), "above", "held")).alias("near")))
    rows = rows.join(near, "dir", "left")
    own, near_ = F.col("own").isNotNull(), F.col("near").isNotNull()
    held = F.coalesce("own", F.col("near.held"))
    return rows.select(
        *all_but("row", files, "license", "score", "origin", "license_dir"),
        held["license"].alias("license"),
        (-held["s"]).alias("score"),
        F.when(own, "own").when(near_, "inherited").alias("origin"),
        F.when(~own, F.col("near.above")).alias("license_dir"),
    )


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    """The documents as files of a tree: one to three directories deep, from source and doc_id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    deep = F.array(F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / 1000).cast("string"), F.floor(F.col("doc_id") / 100).cast("string"))
    path = F.concat_ws("/", F.slice(deep, F.lit(1), (F.col("doc_id") % 3 + 1).cast("int")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    got = scan_licenses(docs.select("doc_id", path.alias("path"), "text"))
    return got.select("doc_id", "path", "license", "score", "origin", "license_dir")
