"""Exact nearest neighbours at any distance, by descent through cells of space.

Points lie on the unit sphere in space, where poles and the date line are nothing special. Space is halved along each axis
level by level, until no cell has many sources, wherever they crowd; a cell of sources is looked into only if its nearest corner
could be nearer to the target than a source that is known in some other cell. Each level is a join of targets with the cells
they still consider.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_m
from ..functions.values import num
from ..functions.folders import work_folder

PIXEL = ["dst_row", "dst_col"]
#: Levels that are taken at once, the level down to which a cell table has a small bound (8 ** 4 rows), the deepest level (cells of
#: 12 m), and sources of a cell that isn't divided further.
STRIDE, FIXED, DEEPEST, LEAF = 2, 4, 20, 32
AXES = "xyz"


def space(lat: Column, lon: Column) -> list[Column]:
    """The place on the unit sphere."""
    return [F.cos(F.radians(lat)) * F.cos(F.radians(lon)), F.cos(F.radians(lat)) * F.sin(F.radians(lon)), F.sin(F.radians(lat))]


def _cell(x: Column, level: int) -> Column:
    return F.least(F.floor((x + 1) * num(2.0 ** (level - 1))), F.lit((1 << level) - 1)).cast("long")


def _level(finest: DataFrame, level: int) -> DataFrame:
    """(nx, ny, nz, n, one): the cells of a level with their numbers of sources and the place of one."""
    return finest.groupBy(*[F.shiftright(f"f{a}", DEEPEST - level).alias(f"n{a}") for a in AXES]).agg(F.sum("n").alias("n"), F.min("one").alias("one"))


def _cells_of(source: DataFrame) -> tuple[DataFrame, int]:
    """The deepest cells (fx, fy, fz, n, one) that have sources, and the first level at which no cell has more than LEAF of them (the
    deepest, if there is none)."""
    places = source.select(*[p.alias(f"s{a}") for a, p in zip(AXES, space(F.col("lat"), F.col("lon")), strict=True)])
    finest = places.groupBy(*[_cell(F.col(f"s{a}"), DEEPEST).alias(f"f{a}") for a in AXES]).agg(F.count("*").alias("n"), F.min(F.struct(*[f"s{a}" for a in AXES])).alias("one"))
    if source.limit(LEAF + 1).count() <= LEAF:
        return finest, STRIDE
    spark = source.sparkSession
    folder = f"{work_folder(spark)}/cells-{uuid.uuid4().hex}"
    finest.write.parquet(folder)
    finest = spark.read.parquet(folder)
    most = [_level(finest, level).agg(F.lit(level).alias("level"), F.max("n").alias("n")) for level in range(STRIDE, DEEPEST, STRIDE)]
    fits = functools.reduce(DataFrame.unionByName, most).filter(F.col("n") <= LEAF).agg(F.min("level")).first()[0]  # one row
    return finest, fits or DEEPEST


def nearest_pixels(target: DataFrame, source: DataFrame) -> DataFrame:
    """(dst_row, dst_col, src_row, src_col, dist_m) for each pixel of target (dst_row, dst_col, lat, lon), from source
    (src_row, src_col, lat, lon); ties go to the larger (row, col). Without sources there are no rows.

    A target meets the sources of a few cells, which have LEAF at most unless sources stand within metres of each other. The
    cells of a large source are written to the shared folder once, and all levels are made from there."""
    axes = AXES
    finest, depth = _cells_of(source)
    points = source.select("src_row", "src_col", F.col("lat").alias("slat"), F.col("lon").alias("slon"), *[p.alias(f"s{a}") for a, p in zip(axes, space(F.col("lat"), F.col("lon")), strict=True)])
    points = points.withColumns({f"c{a}": _cell(F.col(f"s{a}"), depth) for a in axes})
    looking = target.select(*PIXEL, "lat", "lon", *[p.alias(f"t{a}") for a, p in zip(axes, space(F.col("lat"), F.col("lon")), strict=True)], *[F.lit(0).cast("long").alias(f"c{a}") for a in axes])
    of_pixel = Window.partitionBy(*PIXEL)
    for level in range(STRIDE, depth + 1, STRIDE):
        cells = _level(finest, level)
        cells = cells.select(*[F.shiftright(f"n{a}", STRIDE).alias(f"c{a}") for a in axes], *[f"n{a}" for a in axes], "one")
        met = looking.join(F.broadcast(cells) if level <= FIXED else cells, [f"c{a}" for a in axes])
        width = 2.0 ** (1 - level)
        low = lambda a: F.col(f"n{a}") * num(width) - 1
        out = lambda a: F.greatest(num(0), low(a) - F.col(f"t{a}"), F.col(f"t{a}") - low(a) - num(width))
        near = sum((F.pow(out(a), 2) for a in axes), num(0))
        known = sum((F.pow(F.col(f"t{a}") - F.col(f"one.s{a}"), 2) for a in axes), num(0))
        met = met.withColumn("near", near).withColumn("best", F.min(known).over(of_pixel))
        looking = met.filter(F.col("near") <= F.col("best") * (1 + 1e-9) + 1e-15).select(*PIXEL, "lat", "lon", *[f"t{a}" for a in axes], *[F.col(f"n{a}").alias(f"c{a}") for a in axes])
    met = looking.join(points, [f"c{a}" for a in axes]).withColumn("dist_m", haversine_m(F.col("lat"), F.col("lon"), F.col("slat"), F.col("slon")))
    best = met.groupBy(*PIXEL).agg(F.min(F.struct("dist_m", (-F.col("src_row")).alias("r"), (-F.col("src_col")).alias("c"))).alias("b"))
    return best.select(*PIXEL, (-F.col("b.r")).alias("src_row"), (-F.col("b.c")).alias("src_col"), F.col("b.dist_m").alias("dist_m"))


def within_own_threshold(mapping: DataFrame, source: DataFrame) -> DataFrame:
    """Pixels that are nearer than their source pixel's own `threshold`."""
    return mapping.join(source.select("src_row", "src_col", "threshold"), ["src_row", "src_col"]).filter(F.col("dist_m") < F.col("threshold")).select(*PIXEL, "src_row", "src_col", "dist_m")
