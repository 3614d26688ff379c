"""Ingestion as Structured Streaming: files arrive, are identified, and what is new is appended once."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.folders import work_folder  # noqa: F401
from ..operators.ground import NATURAL_KEY, new_measurements
from ..sources.identify import file_inventory, identify


def watch_files(spark: SparkSession, folder: str, glob: str = "*", per_trigger: int = 1000) -> DataFrame:
    """A stream of files (path, modificationTime, length, content) that arrive in a folder tree."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_trigger).load(folder)


def identified(files: DataFrame) -> DataFrame:
    return identify(file_inventory(files))


#: Days of a batch up to which the store is pruned to them before the join.
MOST_DAYS = 1000


def stored(spark: SparkSession, store: str) -> DataFrame | None:
    """What a store holds, None if nothing was written to it yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/_SUCCESS")
    return spark.read.parquet(store) if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) else None


def append_new(stream: DataFrame, store: str, checkpoint: str, keys: list[str] = NATURAL_KEY, t: str = "t_start", seconds: int | None = None) -> StreamingQuery:
    """Appends to a Parquet store, partitioned by day, the stream's rows that it lacks.

    A batch is held against the store's rows of its own days only. Rows carry the number of their batch and the stream's
    checkpoint, so a batch that was written before a failure is found there and left alone when it is run again.
    seconds: how often to poll; None works off what is there and ends."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumns({"batch": F.lit(number).cast("long"), "source": F.lit(checkpoint), "day": F.to_date(t)})
        old = stored(spark, store)
        if old is None:
            rows = rows.dropDuplicates(keys)
        else:
            days = [r[0] for r in rows.select("day").distinct().limit(MOST_DAYS + 1).collect()]
            old = old if None in days or len(days) > MOST_DAYS else old.filter(F.col("day").isin(days))
            if not old.filter((F.col("source") == checkpoint) & (F.col("batch") == number)).isEmpty():
                return
            rows = new_measurements(rows, old, keys)
        rows.write.mode("append").partitionBy("day").parquet(store)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")).start()


def _committed(spark: SparkSession, ledger: str, entry: str):
    """The file system and path of a ledger's entry, and whether it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/{entry}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, path, files.exists(path)


def _commit(spark: SparkSession, ledger: str, entry: str, attempt: str) -> None:
    """Puts an entry that names an attempt into the ledger, unless another one is there. A file is written apart and renamed, so
    an entry is there as a whole or not at all."""
    files, path, _ = _committed(spark, ledger, entry)
    apart = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/_{attempt}")
    out = files.create(apart, True)
    out.write(bytearray(attempt.encode()))
    out.close()
    if not files.rename(apart, path):
        files.delete(apart, False)


def fan_out(stream: DataFrame, column: str, sinks: dict[str, str], ledger: str, checkpoint: str) -> StreamingQuery:
    """Writes each kind of row to its own Parquet folder, each batch exactly once and to all folders at once.

    A batch is written to folders of its own, one in each sink, named by the attempt; these become visible together, by a single
    entry of the ledger that is put there last. A batch that fails between two sinks leaves folders that no entry names,
    and is written anew; one that is run again after its entry was put there is left alone. Read sinks by fanned(). Rows of
    other kinds go nowhere. Streams that share a ledger are told apart by their checkpoints."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        entry = f"{hashlib.md5(checkpoint.encode()).hexdigest()}-{number}"
        if _committed(spark, ledger, entry)[2]:
            return
        attempt = f"{entry}-{uuid.uuid4().hex}"
        batch.persist()
        try:
            for kind, folder in sinks.items():
                batch.filter(F.col(column) == kind).write.parquet(f"{folder}/attempt={attempt}")
            _commit(spark, ledger, entry, attempt)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def fanned(spark: SparkSession, folder: str, ledger: str) -> DataFrame:
    """What a sink of fan_out() holds: the rows of the attempts that the ledger names."""
    named = spark.read.text(ledger).select(F.col("value").alias("attempt"))  # files that begin with _ aren't read
    return spark.read.parquet(folder).join(named, "attempt", "left_semi").drop("attempt")


def daily_chunks(stream: DataFrame, t: str, aggregate: Callable[[DataFrame], DataFrame], late: str = "1 day") -> DataFrame:
    """Per day of event time; days close once the watermark passes (the watermark is this library's own addition)."""
    windowed = stream.withColumn(t, F.col(t).cast("timestamp")).withWatermark(t, late)
    return aggregate(windowed.groupBy(F.window(t, "1 day")))
