"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A key's jumps are a pseudo-random sequence that depends on the key alone; its shard among n is the last jump
below n. So going from n to n + 1 shards moves only keys whose next jump is n, and those into shard n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, work_table

#: Jumps that are made before asking whether a key has more: it has ln(shards) on average.
JUMPS = 64


def jump_shard(key: Column, shards: int, jumps: int = JUMPS) -> Column:
    """The shard (0 to shards - 1) of a key.

    Each jump at least adds one, so `shards` jumps are enough. The first `jumps` are made for all keys, the others only
    for a key that is still jumping. A null key is a key like any other.
    """
    key = F.coalesce(key.cast("string"), F.lit("\0null"))

    def jump(state: Column, i: Column) -> Column:
        low = F.shiftrightunsigned(F.xxhash64(key, i), 33).cast("double") + 1
        reach = F.floor((state["at"] + 1) * F.lit(float(1 << 31)) / low).cast("long")
        on = reach < shards
        return F.when(state["open"] & on, F.struct(reach.alias("at"), F.lit(True).alias("open"))).otherwise(
            F.struct(state["at"].alias("at"), F.lit(False).alias("open"))
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(True).alias("open"))
    first = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, jumps))), start, jump)
    if shards <= jumps:
        return first["at"].cast("int")
    rest = F.sequence(F.lit(jumps + 1), F.lit(shards))
    return F.transform(F.array(first), lambda s: F.when(s["open"], F.aggregate(rest, s, jump)["at"]).otherwise(s["at"]))[0].cast("int")


def assign_shards(docs: DataFrame, key: str, text: str, shards: int, parts_per_shard: int | None = None, most_broadcast: int = 1_000_000) -> DataFrame:
    """Key, size, text_crc32, law, shard, slot, grown_shard for each row of docs.

    size: UTF-8 bytes of the text plus 1; a null text has no bytes. The law is `key`: key and shard count decide
    alone. slot numbers a shard's rows from 0 without gaps: rows are counted by shard and hash part, running sums
    of these few counts (shards x parts) give each part its first slot, and only within a part rows are sorted. The
    text itself is never shuffled. parts_per_shard: parts that a shard's rows are sorted in; by default four times
    the shuffle partitions, so that it follows the cluster's own setting. Null and repeated keys keep a row each, with a
    slot of its own, in no certain order among equal ones; very long texts are measured whole; other columns of docs, of any name, don't matter. An empty table gives no rows.
    """
    spark = docs.sparkSession
    parts = parts_per_shard or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        jump_shard(F.col(key), shards).alias("shard"),
        jump_shard(F.col(key), shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("\0null")), F.crc32(F.encode(body, "UTF-8"))), F.lit(parts)).cast("int").alias("part"),
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = rows.groupBy("shard", "part").agg(F.count("*").alias("n")).select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "part").orderBy(key, "text_crc32", "size")
    # firsts has shards x parts rows at most, whatever the input; it is counted before it is broadcast
    return (
        rows.withColumn("nth", F.row_number().over(within))
        .join(small(work_table(firsts), most_broadcast), ["shard", "part"])
        .select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("nth") - 1).alias("slot"), "grown_shard")
    )


def op1_jump_shards(spark, sf_dir: str) -> DataFrame:
    return assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text", 8)
