"""Model readers as a whole: from cells as an opened container gives them to bands, heights and times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.meteo import GRAVITY, hybrid_pressure, hypsometric_height, wrf_height
from ..functions.times import mjd2000
from ..functions.values import concentration_scale
from ..operators.algebra import flip_lr, flip_ud, vertical_integral_rows


def stratosphere_analysis(cells: DataFrame, levels: int, rows: int, columns: int) -> tuple[DataFrame, DataFrame]:
    """The bands (file, t, band, row, col, value) and their mean heights (file, band, height) of cells (file, days, level_idx, row,
    col, ap, bp, p0, temperature, z, value).

    level_idx counts interfaces from the top, from 0 to levels; the last one has no layer below, so no value. Pressures are in the
    middle between interfaces, heights add up from the ground (z: the surface's geopotential). Both axes turn, bands count from
    the ground, days from 2000."""
    keys = ["file", "row", "col"]
    layers = hybrid_pressure(cells, keys, "level_idx", "ap", "bp", "p0").withColumn("terrain", F.col("z") / GRAVITY)
    band = (F.lit(levels) - F.col("level_idx")).cast("int").alias("band")
    heights = hypsometric_height(layers, keys, "level_idx", "temperature", "pressure", "p0", "terrain").groupBy("file", band).agg(F.avg("height").alias("height"))
    turned = flip_lr(flip_ud(layers.select("file", "days", band, "row", "col", "value"), rows), columns)
    return turned.select("file", mjd2000(F.col("days")).alias("t"), "band", "row", "col", "value"), heights


def dispersion(cells: DataFrame, rows: int) -> DataFrame:
    """(t, band, row, col, value) of a dispersion model's cells (date as YYYYMMDDHHMMSS, x, y, level_idx from 0, value): all available
    dates; x runs east and y north, so axes swap and rows turn; concentrations of sulphur become those of its dioxide."""
    t = F.to_timestamp("date", "yyyyMMddHHmmss").alias("t")
    return cells.select(t, (F.col("level_idx") + 1).cast("int").alias("band"), (F.lit(rows - 1) - F.col("y")).cast("int").alias("row"), F.col("x").cast("int").alias("col"), concentration_scale(F.col("value")).alias("value"))


def chemistry_column(cells: DataFrame, mapping: DataFrame) -> DataFrame:
    """(time, dst_row, dst_col, value): the vertical integral of a chemistry model's cells (time, level_idx, src_row, src_col, ph, phb,
    hgt, value) on the target grid.

    A level's height is the mean over its cells, at least 0; a column that misses a level is missing."""
    heights = cells.groupBy("time", "level_idx").agg(F.greatest(F.avg(wrf_height(F.col("ph"), F.col("phb"), F.col("hgt"))), F.lit(0.0)).alias("height"))
    columns = vertical_integral_rows(cells.join(heights, ["time", "level_idx"]), "time", "src_row", "src_col")
    return mapping.join(columns, ["src_row", "src_col"]).select("time", "dst_row", "dst_col", "value")
