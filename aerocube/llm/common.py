"""Small helpers that the operators share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Work tables of this process, as (catalog name or None, folder), until free() removes them.
_written: list[tuple[str | None, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir. Where that is unset, a temporary one in local mode (tests),
    an error on a cluster, whose executors wouldn't see it."""
    folder, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if not folder and known.isEmpty():
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="aerocube-")
    if known.isEmpty():
        context.setCheckpointDir(folder)
    return folder or known.get()


def work_table(df: DataFrame, among: list[str] | None = None) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: cuts lineage, survives lost executors. Its folder is added
    to `among`, for remove()."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((None, path))
    if among is not None:
        among.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Removes work tables that nothing reads any more."""
    for path in paths:
        _delete(spark, path)
    _written[:] = [w for w in _written if w[1] not in paths]


def bucket_table(df: DataFrame, column: str) -> DataFrame:
    """A work table in buckets of a column, as many as shuffle partitions; the catalog knows it until free() is called."""
    spark, name = df.sparkSession, f"work_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/tables/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, column).saveAsTable(name)
    _written.append((name, path))
    return spark.table(name)


def free(spark: SparkSession, *still_read: DataFrame) -> None:
    """Removes all work tables that operators have written but those that the given DataFrames read.

    For callers that have written out what the operators returned, such as between stages of a pipeline."""
    kept = [f for df in still_read for f in df.inputFiles()]
    for entry in list(_written):
        name, path = entry
        if any(path.rsplit("/", 1)[-1] in f for f in kept):
            continue
        if name:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        _delete(spark, path)
        _written.remove(entry)


def held(df: DataFrame) -> DataFrame:
    """checkpoint(), for the small tables of iterations."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: Bytes that a table which is broadcast may have in its files.
MOST_BYTES = 16_000_000


def small(df: DataFrame, rows: int, most_bytes: int = MOST_BYTES) -> DataFrame:
    """df marked for broadcast if it has at most so many rows and its files (columns that aren't read apart) so many
    bytes; beyond that Spark shuffles both sides.

    df should be cheap to read again (a work_table)."""
    fits = df.limit(rows + 1).count() <= rows and df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= most_bytes
    return F.broadcast(df) if fits else df


def all_but(row: str, df: DataFrame, *names: str) -> list[Column]:
    """The columns of df, which `row` holds as a struct, without those called like one of the names."""
    taken = {n.lower() for n in names}
    return [F.col(row)[c].alias(c) for c in df.columns if c.lower() not in taken]


def words_of(text: Column) -> Column:
    """The words of a text, as an array; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(text, 256)


def beta_trials(rows: DataFrame) -> float:
    """Prior trials of a beta-binomial, by moments: how much rates k / n spread around their priors beyond binomial
    noise, from rows (n, k, prior). Between 1 and 999; 999 where nothing tells."""
    pq = F.col("prior") * (1 - F.col("prior"))
    got = (
        rows.filter("n > 0")
        .agg(F.sum((F.col("k") - F.col("n") * F.col("prior")) ** 2).alias("seen"), F.sum(F.col("n") * pq).alias("noise"), F.sum(F.col("n") * (F.col("n") - 1) * pq).alias("more"))
        .first()  # one row
    )
    if not got["more"]:
        return 999.0
    return 1 / min(max((got["seen"] - got["noise"]) / got["more"], 0.001), 0.5) - 1
