"""Document fingerprints of closed syncmers, with DataFrame functions only.

Tokens are words, cut every 4 code points; from the 17th code point of an unspaced run on each code point is a token, so in
long runs nothing depends on where they begin. A window of K tokens is kept as an anchor if the token with the least hash is
its first or its last one. That depends on the window alone, so what stands around it changes nothing, and texts that share a
passage share its anchors, in the same order and at the same distances. About 2 in K windows are kept.

An anchor is a long: the window's hash in the upper 32 bits, its place among the text's tokens in the lower ones. Fingerprints
are matched by place: a common anchor counts if it stands about where the other text has it.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, work_table

# the last code point of all, which the class has anyway, makes Java look behind by code points instead of UTF-16 units
TOKEN = "((?<=[[^\\x20\\x09-\\x0D]\U0010FFFF]{16})[^\\x20\\x09-\\x0D]|[^\\x20\\x09-\\x0D]{1,4})"
K = 4
#: Tokens by which a place may be off: a tenth of the shorter text's, at least so many.
SLACK = 16
#: Bytes of text in a range of ids, and ranges at most, since each task holds the orders that cut them: beyond 1.6 TB of text
#: ranges grow instead.
RANGE, MOST_RANGES = 16_000_000, 100_000
_SIDE = 1 << 31  # marks the other text's anchors when both are sorted together


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once a row."""
    return F.transform(F.array(value), then)[0]


def _window(anchor: Column) -> Column:
    return F.shiftright(anchor, 32)


def _place(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit(_SIDE - 1))


def anchors(text: Column, k: int = K) -> Column:
    """The anchors of a text in its order, as array<long>; null and empty texts have none, a text of fewer than k
    tokens has one, of all of them. Very long texts are read whole."""

    def kept(h: Column) -> Column:
        def closed(i: Column) -> Column:
            inner = F.least(*[F.get(h, i + j) for j in range(1, k - 1)])
            return F.least(F.get(h, i), F.get(h, i + (k - 1))) <= inner

        def anchor(window: Column, place: Column) -> Column:
            return F.shiftleft(window.cast("long"), 32).bitwiseOR(place.cast("long"))

        windows = F.filter(F.sequence(F.lit(0), F.size(h) - k), closed)
        found = F.transform(windows, lambda i: anchor(F.hash(*[F.get(h, i + j) for j in range(k)]), i))
        return F.when(F.size(h) >= k, found).when(F.size(h) > 0, F.array(anchor(F.hash(h), F.lit(0)))).otherwise(F.array().cast("array<long>"))

    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(1))
    return _let(F.transform(tokens, lambda t: F.xxhash64(t)), kept)


def fingerprint(found: Column) -> Column:
    """Anchors as a string."""
    return F.array_join(found.cast("array<string>"), " ")


def placed(found: Column) -> Column:
    """What likeness() needs of a text's anchors, as (once, last): each window at its first place, sorted, and the last place."""
    first = lambda s: F.filter(s, lambda x, i: (i == 0) | (_window(x) != _window(F.get(s, i - 1))))
    last = F.coalesce(_place(F.get(found, F.size(found) - 1)), F.lit(0).cast("long"))
    return F.struct(_let(F.sort_array(found), first).alias("once"), last.alias("last"))


def likeness(a: Column, b: Column) -> Column:
    """The mean of the two shares of windows that match by place, of two texts' placed(); 1 if neither text has any, 0 if
    one has none.

    Windows count once, at their first place in each text; a common one is off by its place in b less that in a. With D
    for the difference of the texts' lengths, those match that are off by something between 0 and D (what was put in or
    taken out lies before some and not before others), or else those off by about the median (the text begins elsewhere),
    whichever are more; both within a slack. So passages that changed places match in part only.
    """

    def of(p: Column) -> Column:
        a, b = p["a"], p["b"]
        slack = F.greatest(F.lit(SLACK).cast("long"), (F.least(a["last"], b["last"]) / 10).cast("long"))
        low, high = F.least(F.lit(0).cast("long"), b["last"] - a["last"]) - slack, F.greatest(F.lit(0).cast("long"), b["last"] - a["last"]) + slack

        def off(both: Column) -> Column:
            moved = lambda x, i: F.when(_window(x) == _window(F.get(both, i - 1)), _place(x) - _place(F.get(both, i - 1)))
            return F.sort_array(F.filter(F.transform(both, moved), lambda d: d.isNotNull()))

        def matched(moved: Column) -> Column:
            middle = F.get(moved, F.floor(F.size(moved) / 2).cast("int"))
            return F.greatest(F.size(F.filter(moved, lambda x: x.between(low, high))), F.size(F.filter(moved, lambda x: F.abs(x - middle) <= slack)))

        both = F.sort_array(F.concat(a["once"], F.transform(b["once"], lambda x: x.bitwiseOR(F.lit(_SIDE)))))
        n, sa, sb = _let(_let(both, off), matched), F.size(a["once"]), F.size(b["once"])
        return F.when((sa == 0) & (sb == 0), F.lit(1.0)).when((sa == 0) | (sb == 0), F.lit(0.0)).otherwise((n / sa + n / sb) / 2)

    return _let(F.struct(a.alias("a"), b.alias("b")), of)


def _cuts(rows: DataFrame, order: Column, pieces: int) -> list:
    """About `pieces` orders that cut the rows into ranges of about equal numbers: one small row per range."""
    dealt = rows.select(order.alias("o")).repartitionByRange(pieces, "o")
    tops = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.max("o").alias("o"))
    found = {(r["id"], r["h"]) for r in tops.select("o.*").collect()}
    none, some = [c for c in found if c[0] is None], [c for c in found if c[0] is not None]
    return (sorted(none, key=lambda c: c[1]) + sorted(some))[:-1]


def _range_of(order: Column, cuts: list, kind: str) -> Column:
    """How many cuts lie below an order, by halving."""
    listed = F.from_json(F.lit(json.dumps([{"id": i, "h": h} for i, h in cuts])), f"array<struct<id:{kind},h:bigint>>")  # folded into a constant

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = F.get(listed, middle) < order
        return F.when(s["low"] >= s["high"], s).otherwise(
            F.struct(F.when(below, middle + 1).otherwise(s["low"]).alias("low"), F.when(below, s["high"]).otherwise(middle).alias("high"))
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(cuts).bit_length() + 1)), start, halve, lambda s: s["low"])


def with_next(docs: DataFrame, id_: str, text: str, range_bytes: int = RANGE) -> DataFrame:
    """(id, text, found, placed, next_id, next_text, next_placed) for each row of docs, in descending order of ids: its
    text and anchors, and what likeness() needs of it and of the following row.

    After the last row comes the first; rows of one id are ordered by their text's hash, null ids come last. Ids may be
    numbers or strings; null texts are empty; very long ones are read whole; other columns, of any name, don't matter; an
    empty table gives no rows. Rows are cut into ranges of about range_bytes of text at orders that a range partitioning of the ids
    finds, so ranges grow in number and not in size, and many rows of one id or none are cut too. Each range is
    sorted by itself and also gets a copy of the first row of the range below. Texts move once, anchors don't.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = F.struct(F.col("id"), F.bitwise_not(F.xxhash64("text")).alias("h"))
    orders = work_table(rows.select(order.alias("order"), F.octet_length("text").cast("long").alias("bytes")))  # without the texts
    size = orders.agg(F.sum("bytes")).first()[0] or 0  # one number
    cuts = _cuts(orders, F.col("order"), min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // range_bytes + 1), MOST_RANGES))
    ranged = _range_of(F.col("order"), cuts, rows.schema["id"].dataType.simpleString())
    rows = rows.withColumn("order", order).withColumn("range", ranged)
    firsts = work_table(orders.groupBy(ranged.alias("range")).agg(F.max("order").alias("first")))
    along = Window.orderBy("range")  # one row per range
    around = F.coalesce(F.lead("range").over(along), F.min("range").over(Window.partitionBy()))
    firsts = small(firsts.select("range", "first", around.alias("to")), 1_000_000)
    copies = rows.join(firsts, "range").filter(F.col("order") == F.col("first")).select("id", "text", "order", F.col("to").alias("range"))
    every = rows.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)))
    # sorted before anchors are made, so that neither exchange nor sort carries them
    # each range to a task of its own, not by a hash, which would give some tasks several
    dealt = every.repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions("range", "copy", F.desc("order")).withColumn("found", anchors(F.col("text")))
    dealt = dealt.withColumn("placed", placed(F.col("found")))
    down = Window.partitionBy("range").orderBy("copy", F.desc("order"))
    following = [F.lead(c).over(down).alias(f"next_{c}") for c in ("id", "text", "placed")]
    return dealt.select("id", "text", "found", "placed", "copy", *following).filter(~F.col("copy")).drop("copy")


def op2_syncmers(spark, sf_dir: str) -> DataFrame:
    rows = with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    rows = rows.select(F.col("id").alias("doc_id"), n.cast("long").alias("n_chars"), edited.alias("edited"), "found", "placed", "next_placed")
    rows = rows.select("*", anchors(F.col("edited")).alias("new"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("found")).alias("fingerprint"), fingerprint(F.col("new")).alias("edited_fingerprint"),
        likeness(F.col("placed"), placed(F.col("new"))).alias("near_edited"), likeness(F.col("placed"), F.col("next_placed")).alias("near_next"),
    )
