"""Coverages as Parquet rasters by coverage and day, collection folders, and the catalog rows of what is published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_raster(cells: DataFrame, path: str, replace_days: bool = False) -> None:
    """cells (coverage_id, t, row, col, level_idx, value) by coverage and day: a row per pixel and time with its bands in level
    order, missing values as NULL. Readers that want one coverage or day read its folders only. What the path held is replaced, or
    of it only the coverages' days that are written."""
    bands = F.transform(F.sort_array(F.collect_list(F.struct("level_idx", "value"))), lambda x: x["value"])
    grid = cells.groupBy("coverage_id", F.to_date("t").alias("day"), "t", "row", "col").agg(F.sort_array(F.collect_list("level_idx")).alias("levels"), bands.alias("bands"))
    grid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if replace_days else "static").partitionBy("coverage_id", "day").parquet(path)


def read_raster(spark: SparkSession, path: str) -> DataFrame:
    """The cells that write_raster() wrote."""
    rows = spark.read.parquet(path)
    cells = rows.select("coverage_id", "t", "row", "col", F.explode(F.arrays_zip("levels", "bands")).alias("x"))
    return cells.select("coverage_id", "t", "row", "col", F.col("x.levels").alias("level_idx"), F.col("x.bands").alias("value"))


def scan_collection(spark: SparkSession, folder: str, glob: str = "*.tif") -> DataFrame:
    """(path, name, length, modified) of the files in a folder tree whose name fits; their content isn't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    return files.select("path", F.substring_index("path", "/", -1).alias("name"), "length", F.col("modificationTime").alias("modified"))


def publish(cells: DataFrame, folder: str, collection: DataFrame) -> DataFrame:
    """Writes a coverage's cells and returns its catalog row (collection: one row per coverage_id) with location, status, box
    in time and extremes, of what the folder then holds. Days that the folder has already are replaced, so a rerun changes
    nothing."""
    write_raster(cells, folder, replace_days=True)
    told = read_raster(cells.sparkSession, folder).join(collection.select("coverage_id"), "coverage_id", "left_semi").groupBy("coverage_id").agg(F.to_date(F.min("t")).alias("start_date"), F.to_date(F.max("t")).alias("end_date"), F.min("value").alias("min_value"), F.max("value").alias("max_value"))
    return collection.join(told, "coverage_id").withColumns({"location": F.lit(folder), "status": F.lit("processed")})
