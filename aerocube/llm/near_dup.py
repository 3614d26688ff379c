"""Near-duplicate documents: MinHash bands propose, odd sketches sieve, full shingle sets confirm.

1. Each text becomes the set of its word shingles (64-bit hashes). Texts with equal sets form a class, of which one goes on.
2. MinHash values of each class make bands, so that two sets of the wanted similarity share none once in 10^8 pairs (for
   0.8: 235 values in 47 bands of 5). The values are folded into an odd sketch, 1024 parity bits (Mitzenmacher, Pagh, Pham 2014): the XOR of two sketches has a bit
   for about each value that differs, so its population count estimates high similarities closely. Pairs whose
   estimate is 0.2 below the wanted similarity (over 7 deviations) are dropped.
3. What remains is confirmed on full sets. First each band's members are held against its smallest id; those confirmed share
   a component, and only pairs across components go on. In crowded bands an exact prefix filter finds them (see
   _crowded_pairs), so that no link between components is lost and no group's pairs are all formed.
4. Components of the confirmed links, by alternating large-star and small-star rounds (Kiveris et al. 2014).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held, remove, small, work_table

#: Bits of a sketch; MinHash values at most (more where even bands of one value need them); how seldom bands may miss a link.
BITS, VALUES, MISSED = 1024, 256, 1e-8
#: Of bands with at most so many members all pairs across components are formed.
CROWD = 16
ONE = np.uint64(0x9E3779B97F4A7C15)
#: Texts that are worked on at once hold so many bytes.
AT_ONCE = 2_000_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xCF1BBCDCB7A56463)
    return x ^ (x >> np.uint64(32))


def band_plan(similarity: float) -> tuple[int, int]:
    """(bands, rows): as many rows a band as VALUES allow."""
    plans = []
    for rows in range(1, 17):
        p = min(similarity, 1.0) ** rows
        bands = 1 if p >= 1 else int(np.ceil(np.log(MISSED) / np.log1p(-p))) if p > 0 else VALUES + 1
        plans.append((bands, rows))
    fit = [x for x in plans if x[0] * x[1] <= VALUES]
    if similarity <= 0 or not fit and plans[0][0] > 4 * VALUES:
        raise ValueError("bands can't find links of so low a similarity")
    return fit[-1] if fit else plans[0]


@functools.cache
def _hashes(values: int) -> tuple[np.ndarray, np.ndarray]:
    """What makes each of the hash functions."""
    with np.errstate(over="ignore"):
        keys = _mixed(np.arange(1, 2 * values + 1, dtype="uint64") * ONE)
    return keys[:values], keys[values:] | np.uint64(1)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """For each text its distinct shingles, as sorted 64-bit hashes. A-Z are lower-cased; a text with fewer words than
    a shingle has one, of all its words; one without words has none."""
    docs = [(t or "").encode().lower().split() for t in texts]
    lens = np.fromiter(map(len, docs), "int64", len(docs))
    flat = np.array([w for d in docs for w in d] or [b""], dtype=object)
    code, kinds = pd.factorize(flat)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, kinds), "uint64", len(kinds))[code]
    with np.errstate(over="ignore"):
        run = each.copy()
        for k in range(1, words):  # the hash of the words from here on
            run[:-k] = run[:-k] * ONE + each[k:]
        run = _mixed(run + np.uint64(words))
        out, at = [], 0
        for n in lens.tolist():
            if n >= words:
                out.append(np.unique(run[at : at + n - words + 1]))
            elif n:
                h = np.uint64(0)
                for x in each[at : at + n]:
                    h = h * ONE + x
                out.append(_mixed(np.array([h * ONE + np.uint64(n)])))
            else:
                out.append(run[:0])
            at += n
    return out


def min_values(shingles: np.ndarray, values: int) -> np.ndarray:
    """The least value of each of the hash functions."""
    xors, factors = _hashes(values)
    least = np.full(values, np.iinfo("uint64").max)
    for a in range(0, len(shingles), 512):
        np.minimum(least, ((shingles[a : a + 512, None] ^ xors) * factors).min(axis=0), out=least)
    return least


def _sketched(shingles: np.ndarray, bands: int, rows: int) -> tuple:
    """Two hashes of the set, its band keys, its odd sketch."""
    least = min_values(shingles, bands * rows)
    number = np.arange(bands * rows, dtype="uint64") * ONE
    sample = _mixed(least + number)
    keys = np.zeros(bands, "uint64")
    for column in sample.reshape(bands, rows).T:
        keys = _mixed(keys * ONE + column)
    odd = (np.bincount(sample & np.uint64(BITS - 1), minlength=BITS) & 1).astype("uint8")
    return shingles.sum(), np.bitwise_xor.reduce(_mixed(shingles)), keys.view("int64"), np.packbits(odd).view("int64")


def _by_size(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list]]:
    """Ids and texts, some megabytes at once."""
    for batch in batches:
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), dtype="int64"))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + AT_ONCE, "right")))
            yield batch.column("id").slice(a, b - a), batch.column("text").slice(a, b - a).to_pylist()
            a = b


def sketches(docs: DataFrame, words: int, similarity: float = 0.8) -> DataFrame:
    """(id, n, h1, h2, keys, sketch) for each row of docs (id, text); keys and sketch are null for an empty set."""
    bands, rows = band_plan(similarity)

    def work(batches):
        for ids, texts in _by_size(batches):
            sets = shingle_sets(texts, words)
            with np.errstate(over="ignore"):
                made = [_sketched(s, bands, rows) if len(s) else (np.uint64(0), np.uint64(0), None, None) for s in sets]
            h1, h2 = (np.array([m[k] for m in made], "uint64").view("int64") for k in (0, 1))
            lists = [pa.array([m[k] for m in made], pa.list_(pa.int64())) for k in (2, 3)]
            yield pa.record_batch([ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(h1), pa.array(h2), *lists], ["id", "n", "h1", "h2", "keys", "sketch"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(work, f"id {kind}, n long, h1 long, h2 long, keys array<long>, sketch array<long>")


def sets(docs: DataFrame, words: int) -> DataFrame:
    """(id, shingles) for each row of docs (id, text)."""

    def work(batches):
        for ids, texts in _by_size(batches):
            made = [s.view("int64") for s in shingle_sets(texts, words)]
            yield pa.record_batch([ids, pa.array(made, pa.list_(pa.int64()))], ["id", "shingles"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(work, f"id {kind}, shingles array<long>")


def _alike(a: Column, b: Column, similarity: float) -> Column:
    """Whether two odd sketches may belong to sets of the similarity, with a margin of 0.2."""
    differing = 2 * int(np.prod(band_plan(similarity))) * (1 - max(similarity - 0.2, 0.0))
    most = BITS / 2 * (1 - float(np.exp(-2 * differing / BITS)))
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x) <= int(np.ceil(most))


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for each id of edges (a, b): the smallest id that links reach.

    Large-star and small-star rounds until nothing changes; each round is checkpointed. Minima are summed up before
    the shuffle, and the joins have no aggregate above them, so Spark can split a hub's rows.
    """

    def star(pairs: DataFrame) -> DataFrame:  # links every larger neighbour of an id to the least one
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("least", "a").alias("b")).distinct()

    def state(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    pairs = held(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    before = state(pairs)
    while True:
        large = star(pairs)
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a > b")
        pairs = held(moved.union(least.select("a", F.col("least").alias("b"))).distinct())
        after = state(pairs)
        if after == before:
            return pairs.select(F.col("a").alias("id"), F.col("b").alias("component"))
        before = after


def _crowded_pairs(crowded: DataFrame, full: DataFrame, percent: int, passing: list[str]) -> DataFrame:
    """Pairs (a, b) of different components that hold all links among the members (rep, component) of crowded bands.

    A prefix filter: shingles are put in one order, rare ones (among these members) first. A set of n that is linked to a
    smaller one of m overlaps it in at least v = p (n + m) / (100 + p) shingles, so one of its first n - v + 1 shingles is
    among the smaller one's first m - 2 p m / (100 + p) + 1. The larger looks at each cell of sizes it may be linked to;
    shingles that one member alone has take places but needn't be looked up. Where members share most shingles but are too
    different to be linked, these first shingles are their own edits, so few meet. Of those that meet, one is
    always outside the place's largest component; only such pairs are formed.
    """
    docs = crowded.select(F.col("rep").alias("of"), "component").distinct()
    each = full.join(docs, "of").select("of", "component", "size", F.explode("shingles").alias("x"))
    common = each.groupBy("x").agg(F.count("*").alias("df"))
    several = F.collect_list(F.when(F.col("df") > 1, F.struct("df", "x")))
    order = work_table(each.join(common, "x").groupBy("of", "component", "size").agg(F.count_if(F.col("df") == 1).alias("alone"), F.sort_array(several).alias("shared")), passing)
    n, p = F.col("size"), F.lit(percent)
    up = lambda a, b: F.floor((a + b - 1) / b)  # noqa: E731  a / b, rounded up
    cell = lambda c: F.floor(F.ln(c) / float(np.log(1.02)))

    def first(rows: DataFrame, least_overlap: Column) -> DataFrame:
        take = F.greatest((n - least_overlap + 1 - F.col("alone")).cast("int"), F.lit(0))
        found = rows.select("cell", "of", "component", "size", "alone", F.posexplode(F.slice("shared", F.lit(1), take)["x"]).alias("i", "x"))
        return found.withColumn("at", F.col("alone") + F.col("i")).drop("alone", "i")

    smallest = F.greatest(up(p * n, F.lit(100)), F.lit(1))
    larger = order.withColumn("cell", F.explode(F.sequence(cell(smallest), cell(n))))
    low = F.greatest(smallest, F.floor(F.pow(F.lit(1.02), F.col("cell").cast("double")) - 1e-6))
    left = first(larger, up(p * (n + low), F.lit(100 + percent)))
    right = first(order.withColumn("cell", cell(n)), up(2 * p * n, F.lit(100 + percent)))
    sides = left.withColumn("large", F.lit(True)).unionByName(right.withColumn("large", F.lit(False)))
    sides = work_table(sides, passing)
    counts = sides.groupBy("cell", "x", "component").agg(F.count("*").alias("k"))
    mixed = counts.groupBy("cell", "x").agg(F.count("*").alias("several"), F.max_by("component", F.struct("k", "component")).alias("main")).filter("several > 1").drop("several")
    sides = work_table(sides.join(mixed, ["cell", "x"]), passing)
    name = lambda rows, k: rows.select("cell", "x", F.col("of").alias(k), F.col("component").alias(f"c{k}"), F.col("size").alias(f"n{k}"), F.col("at").alias(f"at{k}"), (F.col("component") == F.col("main")).alias(f"m{k}"))
    left, right = name(sides.filter("large"), "a"), name(sides.filter("not large"), "b")
    # by the first shingle that both have, what follows it holds the overlap
    linkable = F.expr(f"ca <> cb and (nb < na or (nb = na and b < a)) and {100 + percent} * least(na - ata, nb - atb) >= {percent} * (na + nb)")
    one = left.filter("not ma").join(right, ["cell", "x"]).filter(linkable).select("a", "b")
    other = left.filter("ma").join(right.filter("not mb"), ["cell", "x"]).filter(linkable).select("a", "b")
    return one.union(other)


def near_duplicates(docs: DataFrame, id_: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8, most_broadcast: int = 1_000_000) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of docs.

    Two texts are linked if the Jaccard similarity of their shingle sets is at least `similarity`; component_id is the
    smallest id that links reach, kept tells whether it is the row's own. Texts without words (null and empty ones too)
    have no shingles and are linked with nothing; very long ones are compared whole. Ids should be unique: rows that repeat
    an id and its text have the same result each; rows that repeat it with another text are judged by their own text, but
    where the id is the smallest of both texts' copies, what one is linked with holds for the other. Rows without an id aren't
    compared, have no component, and are kept. Equal similarities are no ties: every link counts. An empty table gives
    no rows; other columns, of any name, don't matter. most_broadcast: ids that are broadcast to fetch texts to confirm; more are
    shuffled.
    """
    percent = round(similarity * 100)
    base = docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    rows = work_table(sketches(base, words, similarity))
    key = ["n", "h1", "h2"]
    classes = work_table(rows.filter("n > 0 and id is not null").groupBy(*key).agg(F.min("id").alias("rep"), F.min_by(F.struct("keys", "sketch"), "id").alias("made")).select(*key, "rep", "made.*"))
    bands = classes.select(F.explode("keys").alias("key"), "rep")
    shared = bands.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    passing: list[str] = []  # tables that only lead to the links
    members = work_table(bands.join(shared, "key").select("key", "rep"), passing)
    drawn = small(work_table(members.select("rep").distinct(), passing), most_broadcast)
    texts = base.join(drawn, base["id"] == drawn["rep"], "left_semi")
    full = work_table(sets(texts, words).withColumnRenamed("id", "of").withColumn("size", F.size("shingles")), passing)
    sketch = classes.select(F.col("rep").alias("of"), "sketch")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are similar enough."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = pairs.join(sketch.withColumnsRenamed({"of": "a", "sketch": "sa"}), "a").join(sketch.withColumnsRenamed({"of": "b", "sketch": "sb"}), "b")
        pairs = work_table(pairs.filter(_alike(F.col("sa"), F.col("sb"), similarity)).select("a", "b").distinct(), passing)
        pairs = pairs.join(full.withColumnsRenamed({"of": "a", "shingles": "xa", "size": "na"}), "a")
        pairs = pairs.filter("na > 0").join(full.withColumnsRenamed({"of": "b", "shingles": "xb", "size": "nb"}), "b")
        pairs = pairs.filter((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
        both = F.size(F.array_intersect("xa", "xb"))
        return pairs.filter(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b").distinct()

    start = members.withColumn("component", F.col("rep"))
    centres = start.groupBy("key").agg(F.min("rep").alias("b"))  # the first of a group is often what the others were made from
    links = work_table(confirmed(start.join(centres, "key").filter("rep <> b").select(F.col("rep").alias("a"), "b")), passing)
    known = connected_components(links).withColumnRenamed("id", "rep")
    placed = work_table(members.join(known, "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component")), passing)
    mixed = placed.groupBy("key").agg(F.count("*").alias("together"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    across = work_table(placed.join(mixed.select("key", "together"), "key"), passing)
    few = across.filter(F.col("together") <= CROWD).select("key", "rep", "component")
    few = few.withColumnsRenamed({"rep": "a", "component": "ca"}).join(few.withColumnsRenamed({"rep": "b", "component": "cb"}), "key").filter("a < b and ca <> cb").select("a", "b")
    many = _crowded_pairs(across.filter(F.col("together") > CROWD), full, percent, passing)
    links = work_table(confirmed(few.union(many)).union(links), passing)
    found = connected_components(links)  # from here on a checkpoint, which needs none of these
    remove(docs.sparkSession, passing)
    found = classes.select(*key, "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left").select(*key, F.coalesce("component", "rep").alias("component_id"))
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    # texts without words have no class: a null key keeps them all out of one task
    rows = rows.select("id", "n", *[F.when(F.col("n") > 0, F.col(c)).alias(c) for c in ("h1", "h2")])
    return (
        rows.join(found, key, "left")
        .select(F.col("id").alias(id_), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), own).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_) == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, id_: str = "doc_id", text: str = "text", most_broadcast: int = 1_000_000, **options) -> DataFrame:
    """docs without the rows that near_duplicates() doesn't keep; of rows that repeat an id, the one with the least hash of
    its text and then of all its columns stays. Null and empty texts, and rows without an id, stay; very long texts are
    compared whole; columns, of any name, are as before; an empty table gives no rows."""
    judged = near_duplicates(docs, id_, text, most_broadcast=most_broadcast, **options)
    lost = work_table(judged.filter(~F.col("kept")).select(F.col(id_).alias("lost")).distinct())
    # the caller's columns in one, so that no name can meet one of these
    rows = docs.select(F.struct("*").alias("row"), F.col(id_).alias("of"), F.xxhash64(F.col(text)).alias("hash"))
    left = rows.join(small(lost, most_broadcast), F.col("of") == F.col("lost"), "left_anti")
    twice = work_table(rows.groupBy("of").count().filter("count > 1 and of is not null").select(F.col("of").alias("twice")))
    if twice.isEmpty():
        return left.select("row.*")
    again = small(twice, most_broadcast)
    once = left.join(again, F.col("of") == F.col("twice"), "left_anti").select("row")
    rest = left.join(again, F.col("of") == F.col("twice"), "left_semi")
    first = rest.groupBy("of").agg(F.min_by("row", F.struct("hash", F.xxhash64("row"))).alias("row")).select("row")
    return once.union(first).select("row.*")


def op10_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=4)
