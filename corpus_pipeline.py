"""Documents to token ids: quality rules, near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; run() writes each result as Parquet and
reads it again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocube.llm import bpe, mixing, near_dup, quality
from aerocube.llm.common import free, work_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules go, and those of hosts most of whose documents fail.

    Null and empty texts have no words, so they go; very long ones are counted whole; a null source is a host of its own.
    Repeated rows count and stay each, there are no ties. An empty table gives no rows; other columns, of any name, stay."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (5-word shingles, similarity 0.8) the one with the smallest id stays.

    Texts without words (null and empty ones too) are linked with nothing and stay, as do rows without an id; very long texts
    are compared whole. Of rows that repeat an id one stays: the least by a hash of its text, then of all its columns. An
    empty table gives no rows; other columns, of any name, stay."""
    return near_dup.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are left out or repeated so that each source's words come near its target.

    Null and empty texts have no words and go with their hash; very long ones count whole; a null source is one of its own,
    last in order. Rows of one id, repeated ones too, share their hash and so their fate; a null id is hashed like an empty
    one. An empty table gives no rows; other columns, of any name, stay."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) for each row, repeated ones and rows without an id included.

    Null and empty texts have no ids; very long ones are encoded whole; no ties arise. An empty table gives no rows; other
    columns, of any name, don't matter."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    got = bpe.encode(docs, "doc_id", "text", path)
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality_rules), ("near-dedup", near_dedup), ("source mix", source_mix), ("token ids", token_ids)]

#: SQL can express neither the encoding nor the hash thresholds; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = work_table(stage(spark, docs, sf_dir))
        free(spark, docs)  # what the stage and those before it have written
    return docs
