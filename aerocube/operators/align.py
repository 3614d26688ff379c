"""Two coverages on one grid: both are brought by nearest neighbours to the finer one's step on the box that is asked for."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH, haversine_m
from ..functions.values import num
from .nearest import PIXEL
from .regrid import apply_map, grid_size, target_grid


class Grid(NamedTuple):
    """A regular grid by its north-western pixel's place, size and step in degrees."""

    north: float
    west: float
    rows: int
    columns: int
    step: float


class Box(NamedTuple):
    north: float
    west: float
    south: float
    east: float


def _beside(position: Column, size: int) -> list[Column]:
    """The places on both sides of a position in a row of so many, and both its ends."""
    inside = lambda c: F.greatest(F.least(c, F.lit(size - 1)), F.lit(0)).cast("int")
    return [inside(F.floor(position)), inside(F.ceil(position)), F.lit(0), F.lit(size - 1)]


def nearest_cells(places: DataFrame, grid: Grid) -> DataFrame:
    """places (lat, lon, ...) with the pixel of a regular grid that is nearest to each: src_row, src_col and dist_m; ties go to the
    larger row and column.

    In arithmetic: on any parallel the nearest pixel is that with the nearest longitude, turns counted. Along its meridian the
    cosine of the distance is a sine of the latitude, so the nearest row lies next to that sine's top, or is an end of the grid.
    Among these few candidates the distance decides. Next to a pole, where pixels of a row coincide, a whole row is looked at."""
    lat, lon = F.col("lat"), F.col("lon")
    at_lat, at_lon = lambda r: num(grid.north) - r * num(grid.step), lambda c: num(grid.west) + c * num(grid.step)
    beside = [c for turn in (-360, 0, 360) for c in _beside((lon + turn - grid.west) / grid.step, grid.columns)]
    # a column each, so that what is used more than once is worked out once
    found = places.withColumn("cols", F.array_distinct(F.array(*beside)))
    found = found.withColumn("top", F.degrees(F.atan2(F.sin(F.radians(lat)), F.cos(F.radians(lat)) * F.array_max(F.transform("cols", lambda c: F.cos(F.radians(lon - at_lon(c))))))))
    found = found.withColumn("rows", F.array(*_beside((grid.north - F.col("top")) / grid.step, grid.rows)))
    polar = F.greatest(F.abs(lat), F.abs(at_lat(F.col("rows")[0])), F.abs(at_lat(F.col("rows")[1]))) > 89.99
    found = found.withColumns({"cols": F.when(polar, F.sequence(F.lit(0), F.lit(grid.columns - 1))).otherwise(F.col("cols")), "rows": F.array_distinct("rows")})
    pixel = lambda r, c: F.struct(haversine_m(lat, lon, at_lat(r), at_lon(c)).alias("dist_m"), (-r).alias("r"), (-c).alias("c"))
    best = F.array_min(F.transform("cols", lambda c: F.array_min(F.transform("rows", lambda r: pixel(r, c)))))
    found = found.withColumn("best", F.explode(F.array(best)))  # a step of its own: filters on the distance don't repeat all this
    return found.select(*[F.col(c) for c in places.columns], (-F.col("best.r")).alias("src_row"), (-F.col("best.c")).alias("src_col"), F.col("best.dist_m").alias("dist_m"))


def _mean_gap(grid: Grid) -> float:
    """The mean distance of a pixel to its right neighbour: all of a row are alike."""
    half = [math.cos(math.radians(grid.north - r * grid.step)) * math.sin(math.radians(grid.step) / 2) for r in range(grid.rows)]
    return math.fsum(2 * EARTH * math.atan2(abs(h), math.sqrt(max(1 - h * h, 0))) for h in half) / grid.rows


def grid_map(spark, grid: Grid, box: Box, step: float) -> DataFrame:
    """Which pixel of a grid each pixel of the box takes: the nearest, if it is nearer than that pixel's right neighbour (or
    than twice the mean distance, where the neighbour is nearer than the mean). Depends on the grids alone, so one map serves
    all times and levels; it is arithmetic, without a search or shuffle. A grid of one column has no neighbours, so no pixel."""
    if grid.rows < 1 or grid.columns < 2:
        return spark.createDataFrame([], "dst_row int, dst_col int, src_row int, src_col int, dist_m double")
    target = target_grid(spark, box.north, box.west, *grid_size(*box, step), step)
    near = nearest_cells(target, grid).select(*PIXEL, "src_row", "src_col", "dist_m")
    lat, left = num(grid.north) - F.col("src_row") * num(grid.step), F.least(F.col("src_col"), F.lit(grid.columns - 2))
    gap = haversine_m(lat, num(grid.west) + left * num(grid.step), lat, num(grid.west) + (left + 1) * num(grid.step))
    mean = _mean_gap(grid)
    return near.filter(F.col("dist_m") < F.when(gap < mean, 2 * mean).otherwise(gap))


def align_two(a: DataFrame, a_grid: Grid, b: DataFrame, b_grid: Grid, box: Box, on: tuple[str, ...] = ("level_idx",)) -> DataFrame:
    """(dst_row, dst_col, *on, va, vb): both coverages (row, col, *on, value) where both have a pixel."""
    step = min(a_grid.step, b_grid.step)

    def side(cells: DataFrame, grid: Grid, name: str) -> DataFrame:
        cells = cells.select(F.col("row").alias("src_row"), F.col("col").alias("src_col"), *on, F.col("value").alias(name))
        return apply_map(grid_map(cells.sparkSession, grid, box, step), cells)

    return side(a, a_grid, "va").join(side(b, b_grid, "vb"), [*PIXEL, *on])


def add(aligned: DataFrame) -> DataFrame:
    """Sums; missing where either is."""
    return aligned.withColumn("value", F.col("va") + F.col("vb")).drop("va", "vb")


def subtract(aligned: DataFrame) -> DataFrame:
    return aligned.withColumn("value", F.col("va") - F.col("vb")).drop("va", "vb")
