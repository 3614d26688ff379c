"""Readers of swath formats up to their rasters: each file, or each slice of a file, on a grid of its own.

Rows come from whatever opened the container, as in decode. Pixels are corners of a regular grid over the swath's box; a pixel
takes the value of the nearest swath pixel within the format's reach, and is missing if there is none or if that is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_m
from ..functions.values import mask_equal, num
from ..operators.stats import right_distances
from ..operators.swath import level_rasters, nearest_in_reach, own_grids, pixels, rasters
from . import decode

SLICES = ["file", "slice"]


def monitor_rasters(cells: DataFrame, fill: float, scale: float, missing_place: float, product: str | None = None) -> DataFrame:
    """(file, slice, dst_row, dst_col, value) of the ozone monitor's cells (file, line, sample, lat, lon, seconds, value): slices of
    200 lines, steps of 0.1 degrees, 70 km."""
    rows = decode.ozone_monitor_swath(cells, fill, scale, missing_place, product, "file").withColumnsRenamed({"line": "src_row", "sample": "src_col"})
    return rasters(rows, own_grids(rows, SLICES, num(0.1), num(70_000)), SLICES, "value")


def column_rasters(samples: DataFrame, fill: float) -> DataFrame:
    """(file, slice, dst_row, dst_col, value) of column samples (file, nth, lat, lon, day, ms, value): slices of 1500 samples,
    steps of a quarter degree, 80 km."""
    rows = decode.swath_column(samples).withColumns({"value": mask_equal(F.col("value"), fill), "src_row": F.lit(0), "src_col": F.col("nth")})
    return rasters(rows, own_grids(rows, SLICES, num(0.25), num(80_000)), SLICES, "value")


def kernel_rasters(samples: DataFrame, fill: float = -9999.0) -> tuple[DataFrame, DataFrame]:
    """The column amounts (file, slice, dst_row, dst_col, value) and the averaging kernel (file, slice, dst_row, dst_col, level_idx,
    height in metres, value) of samples (file, nth, clock, lat, lon, value, kernel and heights in km, both by level).

    Steps and reach are a quarter degree and 60 km for one instrument, 0.1 degrees and 50 km for the others. The kernel is
    missing where the column amount is."""
    wide = F.startswith("file", F.lit("GOME2B-"))
    rows = decode.sulphur_kernel_swath(samples, fill).withColumns({"src_row": F.lit(0), "src_col": F.col("nth")})
    grids = own_grids(rows, SLICES, F.when(wide, 0.25).otherwise(0.1), F.when(wide, 60_000.0).otherwise(50_000.0))
    each = rows.select(*SLICES, "src_row", "src_col", F.posexplode(F.arrays_zip("heights", "kernel")).alias("level_idx", "x"))
    levels = each.select(*SLICES, "src_row", "src_col", "level_idx", (F.col("x.heights") * 1000).alias("height"), mask_equal(F.col("x.kernel"), fill).alias("value"))
    return rasters(rows, grids, SLICES, "value"), level_rasters(rows, levels, grids, SLICES, "value")


def depth_rasters(cells: DataFrame, scale: float, offset: float, missing_place: float = -999.0, fill: float = -9999.0) -> DataFrame:
    """(file, dst_row, dst_col, value) of the radiometer's depths or flags (file, row, col, lat, lon, value): steps of 0.05 degrees;
    a pixel of the swath reaches as far as its right neighbour, or twice the file's mean distance if that is farther."""
    rows = decode.radiometer_depth(cells.withColumn("value", mask_equal(F.col("value"), fill)), scale, offset, missing_place)
    rows = right_distances(rows, haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")), "file").withColumnsRenamed({"row": "src_row", "col": "src_col"})
    grids = own_grids(rows, ["file"], num(0.05))
    found = nearest_in_reach(rows, grids, ["file"], "threshold", "value").filter(F.col("dist_m") < F.col("threshold"))
    return pixels(grids, ["file"]).drop("lat", "lon").join(found.select("file", "dst_row", "dst_col", "value"), ["file", "dst_row", "dst_col"], "left")


def limb_rasters(cells: DataFrame, fill: float) -> DataFrame:
    """(file, dst_row, dst_col, level_idx, value) of limb scans (file, nth, level_idx, lat, lon, value): steps of half a degree,
    100 km. All levels go by the lowest level's map and are missing where that level is."""
    rows = decode.limb_profiles(cells, fill).withColumns({"src_row": F.lit(0), "src_col": F.col("nth")})
    ground = rows.filter("level_idx = 0")
    return level_rasters(ground, rows.select("file", "src_row", "src_col", "level_idx", "value"), own_grids(ground, ["file"], num(0.5), num(100_000)), ["file"], "value")


def sulphur_rasters(cells: DataFrame, fill: float, missing_place: float) -> DataFrame:
    """(file, dst_row, dst_col, value, quality) of the column swath's cells (file, line, sample, lat, lon, value, quality): steps of
    0.1 degrees, 60 km. The quality is missing where the column amount is."""
    rows = decode.sulphur_column_swath(cells, fill, missing_place).withColumnsRenamed({"line": "src_row", "sample": "src_col"})
    got = rasters(rows, own_grids(rows, ["file"], num(0.1), num(60_000)), ["file"], "value", "quality")
    return got.withColumn("quality", F.when(F.col("value").isNotNull(), mask_equal(F.col("quality"), fill)))
