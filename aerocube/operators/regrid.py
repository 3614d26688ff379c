"""Regridding: target grids, exact nearest neighbours within a threshold, tiles.

pixel_map (dst_row, dst_col, src_row, src_col, dist_m) is worked out once per pair of grids and applied to any time, level
or variable by an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import degree, haversine_m
from ..functions.values import num


def target_grid(spark, north: float, west: float, rows: int, columns: int, step: float) -> DataFrame:
    """(dst_row, dst_col, lat, lon): pixel corners from the north-west, row 0 north. Made in tasks, not on the driver."""
    cells = spark.range(rows * columns)
    row, col = F.floor(F.col("id") / columns).cast("int"), (F.col("id") % columns).cast("int")
    return cells.select(row.alias("dst_row"), col.alias("dst_col"), (num(north) - row * step).alias("lat"), (num(west) + col * step).alias("lon"))


def grid_size(north: float, west: float, south: float, east: float, step: float) -> tuple[int, int]:
    """Rows and columns of a box, cut to whole steps."""
    return int((north - south) / step), int((east - west) / step)


def auto_bbox(swath: DataFrame, *keys: str) -> DataFrame:
    return swath.groupBy(*keys).agg(F.max("lat").alias("north"), F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"))


def pixel_map(target: DataFrame, source: DataFrame, threshold_m: float) -> DataFrame:
    """For each target pixel its nearest source pixel, if nearer than the threshold; ties go to the larger (row, col).

    source: src_row, src_col, lat, lon. For thresholds that are small beside the earth (see nearest_pixels() for any
    distance): both sides meet in bins of the threshold's height; a target pixel looks into the bins around its own, more of them along a
    parallel the nearer the pole, so no pair in reach is missed. Near the date line bins wrap. A partial minimum
    is taken before the shuffle, so a pixel with many candidates is no burden.
    """
    size = degree(threshold_m) * 1.001
    bands = int(360 / size) + 1
    wrapped = lambda lon: F.pmod(lon + 180, num(360))
    s = source.select("src_row", "src_col", F.col("lat").alias("slat"), F.col("lon").alias("slon"))
    s = s.withColumn("yb", F.floor((F.col("slat") + 90) / size).cast("int")).withColumn("xb", F.floor(wrapped(F.col("slon")) / size).cast("int"))
    # how far a parallel's degrees must be searched, at the farther edge of the band; everywhere next to a pole
    edge = F.least(F.abs(F.col("lat")) + size, num(90))
    wide = F.when(edge >= 89.5, num(180)).otherwise(num(size * 1.01) / F.cos(F.radians(edge)))
    low, high = F.floor((wrapped(F.col("lon")) - wide) / size), F.floor((wrapped(F.col("lon")) + wide) / size)
    # the last bin is narrower, so around the date line one more is searched
    xs = F.array_distinct(F.transform(F.sequence(low - 1, F.least(high + 1, low + bands)), lambda x: F.pmod(x, F.lit(bands)).cast("int")))
    y = F.floor((F.col("lat") + 90) / size).cast("int")
    t = target.withColumn("yb", F.explode(F.sequence(y - 1, y + 1))).withColumn("xb", F.explode(xs))
    dist = haversine_m(F.col("lat"), F.col("lon"), F.col("slat"), F.col("slon"))
    met = t.join(s, ["yb", "xb"]).withColumn("dist_m", dist)
    best = F.min(F.struct("dist_m", (-F.col("src_row")).alias("r"), (-F.col("src_col")).alias("c")))
    out = met.filter(F.col("dist_m") < threshold_m).groupBy("dst_row", "dst_col").agg(best.alias("b"))
    return out.select("dst_row", "dst_col", (-F.col("b.r")).alias("src_row"), (-F.col("b.c")).alias("src_col"), F.col("b.dist_m").alias("dist_m"))


def apply_map(mapping: DataFrame, values: DataFrame, target: DataFrame | None = None, missing: float | None = None) -> DataFrame:
    """values (src_row, src_col, value) on the target grid; with a target, pixels without a source get `missing`."""
    out = mapping.join(values, ["src_row", "src_col"]).drop("src_row", "src_col", "dist_m")
    if target is None:
        return out
    out = target.select("dst_row", "dst_col").join(out, ["dst_row", "dst_col"], "left")
    return out if missing is None else out.withColumn("value", F.coalesce("value", num(missing)))


def regular_map(lat: Column, lon: Column, north: float, west: float, step: float) -> tuple[Column, Column]:
    """Nearest pixel of a regular grid: arithmetic, no search."""
    return F.floor((north - lat) / step + 0.5).cast("int"), F.floor((lon - west) / step + 0.5).cast("int")


def cut(cells: DataFrame, north: float, west: float, step: float, box_north: float, box_west: float, rows: int, columns: int) -> DataFrame:
    """The cells (row, col) of a box of a regular grid, counted from the box's north-western pixel: a filter and an offset."""
    top, left = int((north - box_north) / step + 0.5), int((box_west - west) / step + 0.5)
    inside = F.col("row").between(top, top + rows - 1) & F.col("col").between(left, left + columns - 1)
    return cells.filter(inside).withColumns({"row": F.col("row") - top, "col": F.col("col") - left})


def tiepoint_interp(ties: DataFrame, samples_per_tie: int, columns: int, value: str, longitude: bool = False) -> DataFrame:
    """A line's tie points (line, tie, value) densified to (line, col, value) between neighbours.

    Longitudes that cross the date line between two ties are interpolated the short way. Beyond the last tie the last
    pair is extended."""
    along = Window.partitionBy("line").orderBy("tie")
    t = ties.withColumn("next", F.lead(value).over(along)).filter(F.col("next").isNotNull())
    last = F.max("tie").over(Window.partitionBy("line"))
    t = t.withColumn("stop", F.when(F.col("tie") == last, F.lit(columns - 1)).otherwise((F.col("tie") + 1) * samples_per_tie - 1))
    t = t.withColumn("col", F.explode(F.sequence(F.col("tie") * samples_per_tie, F.col("stop"))))
    a, b = F.col(value), F.col("next")
    if longitude:
        crossing = F.abs(a - b) > 180
        a, b = F.when(crossing & (a < 0), a + 360).otherwise(a), F.when(crossing & (b < 0), b + 360).otherwise(b)
    out = a + (F.col("col") / samples_per_tie - F.col("tie")) * (b - a)
    out = F.when(out > 180, out - 360).otherwise(out) if longitude else out
    return t.filter(F.col("col") < columns).select("line", "col", out.alias(value))


def idw_fill(cells: DataFrame, rows: int, columns: int, window: int = 1) -> DataFrame:
    """All cells of a grid; those missing get their neighbours' mean, weighted by (1 - d / sum of d) / (n - 1).

    Each known cell is sent to the cells around it, so the work is linear in the cells. A cell without neighbours stays
    missing."""
    spark = cells.sparkSession
    known = cells.filter("value is not null")
    reach = F.sequence(F.lit(-window), F.lit(window))
    sent = known.withColumn("dr", F.explode(reach)).withColumn("dc", F.explode(reach)).filter("dr <> 0 or dc <> 0")
    sent = sent.select((F.col("row") + F.col("dr")).alias("row"), (F.col("col") + F.col("dc")).alias("col"), "value", F.sqrt((F.col("dr") ** 2 + F.col("dc") ** 2).cast("double")).alias("d"))
    # sum of v (1 - d / D) / (n - 1) = (sum v - sum v d / D) / (n - 1)
    got = sent.groupBy("row", "col").agg(F.count("*").alias("n"), F.sum("value").alias("sv"), F.sum("d").alias("sd"), F.sum(F.col("value") * F.col("d")).alias("svd"))
    filled = F.when(F.col("n") == 1, F.col("sv")).otherwise((F.col("sv") - F.try_divide("svd", "sd")) / (F.col("n") - 1))
    got = got.select("row", "col", filled.alias("filled"))
    every = spark.range(rows * columns).select(F.floor(F.col("id") / columns).cast("int").alias("row"), (F.col("id") % columns).cast("int").alias("col"))
    return every.join(known, ["row", "col"], "left").join(got, ["row", "col"], "left").select("row", "col", F.coalesce("value", "filled").alias("value"))


def add_tiles(cells: DataFrame, height: int, width: int) -> DataFrame:
    """cells with the fixed tile that holds each and `nth`, the tile's place in a serpentine walk along rows of tiles."""
    return cells.withColumn("tile_row", F.floor(F.col("row") / height).cast("int")).withColumn("tile_col", F.floor(F.col("col") / width).cast("int"))


def tile_walk(tiles: DataFrame, columns: int) -> DataFrame:
    """tiles with their place in a walk that goes east on even rows and west on odd ones."""
    along = F.when(F.col("tile_row") % 2 == 0, F.col("tile_col")).otherwise(columns - 1 - F.col("tile_col"))
    return tiles.withColumn("nth", F.col("tile_row") * columns + along)


def blank_counts(tiled: DataFrame, blank: float | None = None, *keys: str) -> DataFrame:
    """(*keys, tile_row, tile_col, n, n_blank): tiles with their numbers of pixels and of blank ones."""
    is_blank = F.col("value").isNull() if blank is None else F.col("value").isNull() | (F.col("value") == blank)
    return tiled.groupBy(*keys, "tile_row", "tile_col").agg(F.count("*").alias("n"), F.count_if(is_blank).alias("n_blank"))


def drop_blank_tiles(tiled: DataFrame, blank: float | None = None, *keys: str) -> DataFrame:
    """blank_counts() without the tiles that are blank all over."""
    return blank_counts(tiled, blank, *keys).filter("n_blank < n")


def allowed_tiles(tiles: DataFrame, allow: DataFrame) -> DataFrame:
    return tiles.join(allow.select("tile_row", "tile_col").distinct(), ["tile_row", "tile_col"], "left_semi")
