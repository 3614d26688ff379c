"""Mixing sources to target weights by hash thresholds.

A document's hash (36 bits of the MD5 of its id) decides alone whether it gets one more copy: those below its source's
threshold do. Thresholds come from histograms of words by source and 12 bits of the hash: where the running sum crosses
the budget, only that bucket is divided further, by the next 12 bits, three times. Nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, small, work_table

WEIGHTS, MOST, BITS, LEVELS = (5, 2, 1), 3, 12, 3


def _running(rows: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """rows with the sums of some columns over all rows that come before in an order, under the names given.

    Rows are sorted over all tasks; each task sums its own, and what lies before a task's rows is a sum of one number
    per task."""
    placed = work_table(rows.orderBy(*order).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    parts = placed.groupBy("part").agg(*[F.sum(c).alias(n) for c, n in sums.items()])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    parts = parts.select("part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_0") for n in sums.values()])
    own = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.join(F.broadcast(parts), "part")
    return placed.select(*rows.columns, *[(F.col(f"{n}_0") + F.coalesce(F.sum(c).over(own), F.lit(0))).alias(n) for c, n in sums.items()])


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size); a null source is one of its own, last.

    All sizes are shared by weight; what a target has over `most` times its source is shared among the others by
    weight, again and again. This ends where the level t solves sum(min(most * size, weight * t)) = total: sources in
    order of most * size / weight fill up one after the other.
    """
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = _running(rows.withColumn("one", F.lit(1)), [F.asc_nulls_last("source")], {"one": "nth"})
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    rows = rows.withColumn("weight", F.get(kinds, (F.col("nth") % len(weights)).cast("int"))).withColumn("cap", F.col("source_size") * float(most))
    rows = work_table(rows.select("source", "source_size", "weight", "cap"))
    all_ = rows.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()  # one row
    rows = _running(rows, [F.col("cap") / F.col("weight"), F.asc_nulls_last("source")], {"cap": "filled", "weight": "shut"})
    level = (F.lit(all_["size"] or 0) - F.col("filled")) / (F.lit(all_["weight"] or 0.0) - F.col("shut"))
    # the first source whose cap the level doesn't reach tells the level of all; later ones would have a lower one
    level = rows.agg(F.max(F.when(level * F.col("weight") <= F.col("cap"), level))).first()[0]  # one row
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level or 0.0))
    return rows.select("source", "source_size", target.alias("target"))


def _hash(id_: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(id_.cast("string"), F.lit(""))), 1, BITS * LEVELS // 4), 16, 10).cast("long")


def thresholds(rows: DataFrame, weights=WEIGHTS, most: int = MOST, most_sources: int = 100_000) -> DataFrame:
    """(source, source_size, target, once, lower) from a work_table (hash, size, source).

    A row of a source is taken `once` times, and once more if its hash is below `lower`."""
    targets = work_table(source_targets(rows, weights, most))
    once = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    # hashes below `lower` are taken; from there on `left` words are wanted, within the bucket `prefix`
    edge = targets.select("source", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("lower"), (F.col("target") - once * F.col("source_size")).alias("left"))
    for level in range(1, LEVELS + 1):
        rest = BITS * (LEVELS - level)
        edges = small(edge.withColumnRenamed("source", "of"), most_sources)
        inside = rows.filter("size > 0").join(edges, F.col("source").eqNullSafe(F.col("of"))).filter(F.shiftright("hash", rest + BITS) == F.col("prefix"))
        sums = inside.groupBy("source", "left", F.shiftright("hash", rest).alias("bucket")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("until", F.sum("words").over(run)).withColumn("before", F.col("until") - F.col("words"))
        crossed = sums.filter((F.col("before") <= F.col("left")) & (F.col("until") > F.col("left"))).select("source", F.col("bucket").alias("at"), "before", "words")
        joined = edge.withColumnRenamed("source", "of").join(crossed, F.col("source").eqNullSafe(F.col("of")), "left")
        left = F.col("left") - F.coalesce("before", F.lit(0))
        lower = F.when(F.col("at").isNotNull(), F.shiftleft("at", rest)).otherwise(F.col("lower"))
        if level == LEVELS:  # the last bucket is one hash value: taken too if that comes nearer
            lower = F.when(F.col("at").isNotNull() & (F.col("words") < 2 * left), F.col("at") + 1).otherwise(lower)
        edge = work_table(joined.select(F.col("of").alias("source"), F.coalesce("at", F.lit(-1).cast("long")).alias("prefix"), lower.alias("lower"), left.alias("left")))
    edge = edge.select(F.col("source").alias("of"), "lower")
    return work_table(targets.join(edge, F.col("source").eqNullSafe(F.col("of"))).select("source", "source_size", "target", once.alias("once"), "lower"))


def copies(docs: DataFrame, id_: str, text: str, source: str, weights=WEIGHTS, most: int = MOST, most_sources: int = 100_000) -> DataFrame:
    """(id, size, source_size, target, copies) for each row of docs; a row's words are taken `copies` times.

    size is the number of words; null and empty texts have none, very long ones are counted whole. Every row of a source is taken target / source_size
    times rounded down, and rows whose hash lies below the source's threshold once more, so that the words taken come
    within one hash value (a document) of the target. Rows with the same id share their hash and so their fate; a null
    id hashes like an empty one. Sources up to most_sources are broadcast, more are shuffled. Reruns agree. An empty
    table gives no rows; other columns don't matter.
    """
    rows = work_table(docs.select(F.col(id_).alias("id"), n_words(F.col(text)).alias("size"), F.col(source).alias("source"), _hash(F.col(id_)).alias("hash")))
    plan = thresholds(rows.drop("id"), weights, most, most_sources).withColumnRenamed("source", "of")
    extra = (F.col("hash") < F.col("lower")).cast("long")
    return rows.join(small(plan, most_sources), F.col("source").eqNullSafe(F.col("of"))).select("id", "size", "source_size", "target", (F.col("once") + extra).alias("copies"))


def mix(docs: DataFrame, id_: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, most: int = MOST, most_sources: int = 100_000) -> DataFrame:
    """docs with each row as often as copies() says, maybe not at all; columns, of any name, as before.

    Null, empty and very long texts, rows of one id and empty tables: as there. The text is only read: its words are counted in
    one pass, and in another each row is repeated where it lies."""
    rows = work_table(docs.select(n_words(F.col(text)).alias("size"), F.col(source).alias("source"), _hash(F.col(id_)).alias("hash")))
    plan = thresholds(rows, weights, most, most_sources).select(F.col("source").alias("of"), "once", "lower")
    own = F.col("once") + (F.col("hash") < F.col("lower")).cast("long")
    made = docs.select(F.struct("*").alias("row"), F.col(source).alias("source"), _hash(F.col(id_)).alias("hash")).join(small(plan, most_sources), F.col("source").eqNullSafe(F.col("of")))
    return made.select("row", F.explode(F.array_repeat(F.lit(0), own.cast("int")))).select("row.*")


def op8_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return copies(docs, "doc_id", "text", "source").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )
