"""Rasters in UTM, one per zone, by nearest search in metres.

Pixels are regular in metres, so as on geographic grids a cell of points knows by arithmetic which pixels it reaches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import flat_m, haversine_m, lat_band, utm_forward, utm_zone
from ..functions.values import num
from .nearest import PIXEL
from .stats import right_distances
from .swath import CELL, SLACK, boxes_of, in_cells, needed, span
from .tiles import utm_step


def placed(swath: DataFrame, bands: bool = False, across: bool = False) -> DataFrame:
    """swath with `zone` (and the latitude's `band` if asked for), `easting` and `northing`; longitudes over 180 degrees turn.

    across: each point also in the zones beside its own, with `own` false there."""
    lon = F.when(F.col("lon") > 180, F.col("lon") - 360).otherwise(F.col("lon"))
    zone = utm_zone(lon)
    rows = swath.withColumns({"lon": lon, "home": zone, "band": lat_band(F.col("lat")) if bands else F.lit("")})
    beside = F.array(*[F.pmod(F.col("home") - 1 + k, F.lit(60)) + 1 for k in ((0, -1, 1) if across else (0,))])
    rows = rows.withColumn("zone", F.explode(beside))
    # in a zone beside, longitudes count from its own middle, the short way around
    east, north = utm_forward(F.col("lat"), F.col("lon"), F.col("zone"))
    return rows.withColumns({"easting": east, "northing": north, "own": F.col("zone") == F.col("home")}).drop("home")


def zone_grids(points: DataFrame, keys: list[str], step: float, reach_m: float | None = None) -> DataFrame:
    """(*keys, north, west, rows, columns, reach_m): the box of each zone's own points, its edges cut to whole steps towards zero;
    without reach_m the largest `threshold` of the zone's points."""
    reach = F.max("threshold") if reach_m is None else F.first(num(reach_m))
    cut = lambda c: (c / step).cast("long") * step
    boxes = points.filter("own").groupBy(*keys).agg(cut(F.max("northing")).alias("north"), cut(F.min("easting")).alias("west"), cut(F.min("northing")).alias("south"), cut(F.max("easting")).alias("east"), reach.alias("reach_m"))
    size = lambda a, b: ((F.col(a) - F.col(b)) / step).cast("int")
    return boxes.select(*keys, "north", "west", size("north", "south").alias("rows"), size("east", "west").alias("columns"), "reach_m")


def utm_rasters(swath: DataFrame, reach_m: float | None = None, least_step: float = 0.0, bands: bool = False, across: bool = False) -> DataFrame:
    """(zone, band, step, dst_row, dst_col, easting, northing, value): all pixels of a raster for each zone of a swath
    (row, col, lat, lon, value); those without a point in reach are missing. band is empty unless asked for.

    The step is the greatest power of ten that isn't over the swath's mean spacing, at least least_step. A pixel takes the value of
    the point that is nearest in metres, ties go to the larger row and column, if it is nearer than reach_m, or without it than
    the point's own threshold (its right neighbour's distance, or twice the mean where that is nearer). As zones have
    systems of their own, only the zone's own points count; with `across` points of the zones beside it are projected into it and
    count too, so that its edges have no gaps. Points without a place have no part."""
    keys = ["zone", "band"]
    rows = right_distances(swath.filter("lat is not null and lon is not null"), haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")))
    mean = rows.agg(F.first("mean_gap")).first()[0]  # one number
    step = utm_step(mean or 1.0, least_step)
    points = placed(rows, bands, across)
    grids = zone_grids(points, keys, step, reach_m)
    limit = F.col("threshold") if reach_m is None else num(reach_m)
    s = points.select(*keys, "row", "col", "easting", "northing", limit.alias("limit"), "value").join(grids, keys)
    wide = F.col("reach_m") / step
    s = in_cells(s, keys, (F.col("north") - F.col("northing")) / step, (F.col("easting") - F.col("west")) / step, wide)
    cells = boxes_of(s, keys, grids, "easting", "northing")
    cells = cells.withColumn("dst_row", F.explode(span((F.col("north") - F.col("high_northing")) / step - wide, (F.col("north") - F.col("low_northing")) / step + wide, F.col("rows"))))
    cells = cells.repartition(*keys, "dst_row").withColumn("y", F.col("north") - F.col("dst_row") * step)
    off = F.greatest(num(0), F.col("low_northing") - F.col("y"), F.col("y") - F.col("high_northing"))
    half = F.sqrt(F.greatest(F.pow("reach_m", 2) - F.pow(off, 2), num(0))) / step + SLACK
    cells = cells.withColumn("dst_col", F.explode(span((F.col("low_easting") - F.col("west")) / step - half, (F.col("high_easting") - F.col("west")) / step + half, F.col("columns"))))
    found = needed(cells, keys, lambda up, across: [up, across], ["northing", "easting"], [F.col("y"), F.col("west") + F.col("dst_col") * step], F.col("reach_m"))
    s = s.join(found, [*keys, *CELL]).withColumns({"y": F.col("north") - F.col("dst_row") * step, "x": F.col("west") + F.col("dst_col") * step})
    s = s.withColumn("dist_m", flat_m(F.col("x"), F.col("y"), F.col("easting"), F.col("northing"))).filter(F.col("dist_m") < F.col("reach_m"))
    best = F.min(F.struct("dist_m", (-F.col("row")).alias("r"), (-F.col("col")).alias("c"), "limit", "value")).alias("b")
    found = s.groupBy(*keys, *PIXEL).agg(best).filter("b.dist_m < b.limit").select(*keys, *PIXEL, "b.value")
    every = grids.filter("rows > 0 and columns > 0").withColumn("dst_row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).repartition(*keys, "dst_row")
    every = every.withColumn("dst_col", F.explode(F.sequence(F.lit(0), F.col("columns") - 1)))
    every = every.select(*keys, num(step).alias("step"), *PIXEL, (F.col("west") + F.col("dst_col") * step).alias("easting"), (F.col("north") - F.col("dst_row") * step).alias("northing"))
    return every.join(found, [*keys, *PIXEL], "left")
