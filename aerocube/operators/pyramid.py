"""Tiles that hold their pixels, and zoom levels made from finer ones.

A tile is one row with two arrays over its pixels, row by row: `totals`, missing where a pixel is blank, and `counts` of the values
behind them, so that coarser pixels are means of all values and not of means. Only tiles with a value exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 64


def _filled(found: Column, field: str, blank: Column, pixels: int) -> Column:
    """An array of so many entries from structs in the order of their offsets: gaps are filled with `blank`."""
    gap = lambda x, i: x["offset"] - F.coalesce(F.get(found, i - 1)["offset"], F.lit(-1)) - 1
    parts = F.transform(found, lambda x, i: F.concat(F.array_repeat(blank, gap(x, i)), F.array(x[field])))
    return F.concat(F.flatten(parts), F.array_repeat(blank, pixels - 1 - F.element_at(found, -1)["offset"]))


def pack(cells: DataFrame, keys: list[str], size: int = SIZE) -> DataFrame:
    """(*keys, tile_row, tile_col, totals, counts) of sparse cells (*keys, row, col, total, count), rows and columns from 0.

    Cells of one pixel are summed; a null total or a count of 0 is blank. A tile has size * size pixels at most."""
    own = cells.filter("total is not null and count > 0").groupBy(*keys, "row", "col").agg(F.sum("total").alias("total"), F.sum("count").alias("count"))
    offset = (F.col("row") % size * size + F.col("col") % size).cast("int")
    tile = [F.floor(F.col(c) / size).cast("int").alias(f"tile_{c}") for c in ("row", "col")]
    tiles = own.groupBy(*keys, *tile).agg(F.array_sort(F.collect_list(F.struct(offset.alias("offset"), F.col("total").cast("double").alias("total"), F.col("count").cast("long").alias("count")))).alias("found"))
    totals = _filled(F.col("found"), "total", F.lit(None).cast("double"), size * size)
    return tiles.select(*keys, "tile_row", "tile_col", totals.alias("totals"), _filled(F.col("found"), "count", F.lit(0).cast("long"), size * size).alias("counts"))


def unpack(tiles: DataFrame, keys: list[str], size: int = SIZE) -> DataFrame:
    """The cells (*keys, row, col, total, count) that tiles hold; pack() gives these back."""
    each = tiles.select(*keys, "tile_row", "tile_col", F.posexplode(F.arrays_zip("totals", "counts")).alias("offset", "x")).filter("x.totals is not null")
    place = lambda tile, within: (F.col(tile) * size + within).cast("int")
    return each.select(*keys, place("tile_row", F.floor(F.col("offset") / size)).alias("row"), place("tile_col", F.col("offset") % size).alias("col"), F.col("x.totals").alias("total"), F.col("x.counts").alias("count"))


def coarser(tiles: DataFrame, keys: list[str], size: int = SIZE) -> DataFrame:
    """The level above: a pixel for four, of which those that are blank don't count."""
    half = lambda c: F.floor(F.col(c) / 2).cast("int")
    return pack(unpack(tiles, keys, size).withColumns({"row": half("row"), "col": half("col")}), keys, size)


def build(cells: DataFrame, folder: str, keys: list[str], levels: int = 11, size: int = SIZE) -> None:
    """Writes the tiles of all levels to a Parquet folder, partitioned by `level` from 0, the finest. Cells are read once; each level
    is made from the one below as it was written, so lost executors cost no more than a level."""
    spark: SparkSession = cells.sparkSession
    for level in range(levels):
        tiles = pack(cells, keys, size) if level == 0 else coarser(spark.read.parquet(f"{folder}/level={level - 1}"), keys, size)
        tiles.write.parquet(f"{folder}/level={level}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All tiles with their level."""
    return spark.read.parquet(folder)


def values(tiles: DataFrame) -> DataFrame:
    """tiles with `pixels`: the mean of each pixel's values, missing where it is blank."""
    return tiles.withColumn("pixels", F.zip_with("totals", "counts", lambda t, n: F.try_divide(t, n)))
