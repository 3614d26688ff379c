"""Swaths brought each onto a grid of its own: as many grids as there are groups, in one job.

Targets are regular, so nothing is searched: sources are gathered in cells, a cell knows by arithmetic which target pixels lie
within its reach, and bounds from the box of its sources tell which of these could have their nearest source in it. Sources meet
these pixels only, some dozen each however far the reach and however many the sources; the nearest is a minimum that is
combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH, haversine_m
from ..functions.values import num
from .nearest import AXES, PIXEL, space
from .regrid import auto_bbox

#: What an index of rows or columns may be off by rounding.
SLACK = 1e-6
#: Sources that a cell has on average where they are many enough, and cells that a reach is long at most.
FULL, LONG = 8, 24
CELL = ["cell_row", "cell_col"]


def grids_of(boxes: DataFrame, keys: list[str], step: Column) -> DataFrame:
    """(*keys, north, west, rows, columns, step, ...) of boxes (*keys, north, west, south, east, ...), cut to whole steps."""
    size = lambda a, b: ((F.col(a) - F.col(b)) / F.col("step")).cast("int")
    return boxes.withColumn("step", step).withColumns({"rows": size("north", "south"), "columns": size("east", "west")}).drop("south", "east")


def own_grids(swath: DataFrame, keys: list[str], step: Column, reach_m: Column | None = None) -> DataFrame:
    """(*keys, north, west, rows, columns, step, reach_m): for each group of a swath (*keys, lat, lon) the grid over its
    pixels' box, cut to whole steps. Without reach_m it is the group's largest own `threshold`.

    step and reach_m are expressions over the keys. Groups without a place have no grid."""
    placed = swath.filter("lat is not null and lon is not null")
    boxes = auto_bbox(placed, *keys)
    if reach_m is None:
        boxes = boxes.join(placed.groupBy(*keys).agg(F.max("threshold").alias("reach_m")), keys)
    else:
        boxes = boxes.withColumn("reach_m", reach_m)
    return grids_of(boxes, keys, step)


def pixels(grids: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, dst_row, dst_col, lat, lon) of all grids: pixel corners from the north-west. Rows are dealt to tasks before they
    are filled, so that one large grid is no burden."""
    filled = grids.filter("rows > 0 and columns > 0").withColumn("dst_row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).repartition(*keys, "dst_row")
    filled = filled.withColumn("dst_col", F.explode(F.sequence(F.lit(0), F.col("columns") - 1)))
    return filled.select(*keys, *PIXEL, (F.col("north") - F.col("step") * F.col("dst_row")).alias("lat"), (F.col("west") + F.col("step") * F.col("dst_col")).alias("lon"))


def span(low: Column, high: Column, size: Column) -> Column:
    """The whole numbers from low to high that are places among `size`."""
    first, last = F.greatest(F.ceil(low - SLACK), F.lit(0)).cast("int"), F.least(F.floor(high + SLACK), size - 1).cast("int")
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def in_cells(sources: DataFrame, keys: list[str], row: Column, col: Column, reach: Column) -> DataFrame:
    """sources (*keys, rows, columns, ...) with CELL, the square of a few pixels of its grid that holds each.

    row, col: its place in pixels; reach: of the grid, in pixels. Where sources are dense a cell is a pixel wide."""
    number = sources.groupBy(*keys).agg(F.count("*").alias("number"))
    size = F.greatest(F.ceil(F.sqrt(F.greatest(F.col("rows"), F.lit(1)).cast("double") * F.greatest(F.col("columns"), F.lit(1)) * FULL / F.col("number"))), F.ceil(reach / LONG), F.lit(1))
    return sources.join(number, keys).withColumn("size", size).withColumns({"cell_row": F.floor(row / F.col("size")).cast("int"), "cell_col": F.floor(col / F.col("size")).cast("int")}).drop("number", "size")


def boxes_of(sources: DataFrame, keys: list[str], grids: DataFrame, across: str, up: str, *axes: str) -> DataFrame:
    """(*keys, *CELL, ends, low_ and high_ of each axis, the grid's columns): the box of each cell's sources, and its outermost ones
    along the two columns that place them, as an array of structs (up, across)."""
    box = [f(a).alias(f"{n}_{a}") for a in dict.fromkeys((across, up, *axes)) for n, f in (("low", F.min), ("high", F.max))]
    place = [F.col(up).alias("up"), F.col(across).alias("across")]
    ends = [f(F.struct(*p)) for f in (F.min, F.max) for p in (place, place[::-1])]
    return sources.groupBy(*keys, *CELL).agg(F.array(*[F.struct(e["up"].alias("up"), e["across"].alias("across")) for e in ends]).alias("ends"), *box).join(grids, keys)


def needed(met: DataFrame, keys: list[str], place, axes: list[str], at: list[Column], most: Column) -> DataFrame:
    """(*keys, *CELL, dst_row, dst_col): of pixels and cells that met, the cells that could hold the pixel's nearest source.

    at: the pixel's place along each axis of the cells' boxes, place: what gives it for a source's (up, across), most: the
    distance beyond which nothing counts. A cell is left out if its box is farther than a source of another one."""
    met = met.withColumns({f"at_{a}": c for a, c in zip(axes, at, strict=True)})
    here = [F.col(f"at_{a}") for a in axes]
    near = sum((F.pow(F.greatest(num(0), F.col(f"low_{a}") - x, x - F.col(f"high_{a}")), 2) for a, x in zip(axes, here, strict=True)), num(0))
    away = lambda e: sum((F.pow(x - y, 2) for x, y in zip(here, place(e["up"], e["across"]), strict=True)), num(0))
    far = F.least(*[away(F.get("ends", F.lit(k))) for k in range(4)])
    slack = lambda c: c * (1 + 1e-9) + 1e-15
    met = met.withColumn("near", near).filter(F.col("near") <= slack(F.pow(most, 2))).select(*keys, *CELL, *PIXEL, "near", far.alias("far"))
    met = met.withColumn("best", F.min("far").over(Window.partitionBy(*keys, *PIXEL)))
    return met.filter(F.col("near") <= slack(F.col("best"))).select(*keys, *CELL, *PIXEL)


def pairs_in_reach(swath: DataFrame, grids: DataFrame, keys: list[str], *carried: str) -> DataFrame:
    """(*keys, dst_row, dst_col, src_row, src_col, dist_m, *carried, ...): pixels with the sources that they have to be compared with, among
    them the nearest one and all as near as that."""
    grids = grids.select(*keys, "north", "west", "rows", "columns", "step", "reach_m")
    s = swath.select(*keys, "src_row", "src_col", F.col("lat").alias("slat"), F.col("lon").alias("slon"), *carried).filter("slat is not null and slon is not null").join(grids, keys)
    angle = F.least(F.col("reach_m") / EARTH, F.lit(3.2))
    wide = F.degrees(angle) / F.col("step")
    s = in_cells(s, keys, (F.col("north") - F.col("slat")) / F.col("step"), (F.col("slon") - F.col("west")) / F.col("step"), wide)
    cells = boxes_of(s.withColumns(dict(zip(AXES, space(F.col("slat"), F.col("slon")), strict=True))), keys, grids, "slon", "slat", *AXES)
    cells = cells.withColumn("dst_row", F.explode(span((F.col("north") - F.col("high_slat")) / F.col("step") - wide, (F.col("north") - F.col("low_slat")) / F.col("step") + wide, F.col("rows"))))
    cells = cells.repartition(*keys, "dst_row").withColumn("lat", F.col("north") - F.col("step") * F.col("dst_row"))
    # how many degrees of the row's parallel are in reach of the box: the distance's formula, solved for the longitude
    off = F.greatest(num(0), F.col("low_slat") - F.col("lat"), F.col("lat") - F.col("high_slat"))
    narrow = F.least(F.cos(F.radians("low_slat")), F.cos(F.radians("high_slat")))
    q = (F.pow(F.sin(F.least(angle / 2, F.lit(1.5707963))), 2) - F.pow(F.sin(F.radians(off) / 2), 2)) / (F.cos(F.radians("lat")) * narrow)
    cells = cells.withColumn("half", F.when(q.between(0, 0.999), F.degrees(2 * F.asin(F.sqrt(q)))).when(q < 0, num(0)).otherwise(num(180)))
    turned = [span((F.col("low_slon") + turn - F.col("half") - F.col("west")) / F.col("step"), (F.col("high_slon") + turn + F.col("half") - F.col("west")) / F.col("step"), F.col("columns")) for turn in (-360, 0, 360)]
    cells = cells.withColumn("dst_col", F.explode(F.array_distinct(F.concat(*turned)))).withColumn("lon", F.col("west") + F.col("step") * F.col("dst_col"))
    found = needed(cells, keys, space, list(AXES), space(F.col("lat"), F.col("lon")), 2 * F.sin(F.least(angle / 2, F.lit(1.5707963))))
    pairs = s.join(found, [*keys, *CELL])
    pairs = pairs.withColumns({"lat": F.col("north") - F.col("step") * F.col("dst_row"), "lon": F.col("west") + F.col("step") * F.col("dst_col")})
    return pairs.withColumn("dist_m", haversine_m(F.col("lat"), F.col("lon"), F.col("slat"), F.col("slon"))).filter(F.col("dist_m") < F.col("reach_m"))


def nearest_in_reach(swath: DataFrame, grids: DataFrame, keys: list[str], *carried: str) -> DataFrame:
    """(*keys, dst_row, dst_col, src_row, src_col, dist_m, *carried): for each pixel of each grid the nearest pixel of its own
    group's swath (*keys, src_row, src_col, lat, lon), if nearer than the grid's reach; ties go to the larger row and column.

    Exact everywhere: across the date line, where boxes are as wide as the earth, and at poles. Groups with a null key have none."""
    best = F.min(F.struct("dist_m", (-F.col("src_row")).alias("r"), (-F.col("src_col")).alias("c"), *carried)).alias("b")
    return pairs_in_reach(swath, grids, keys, *carried).groupBy(*keys, *PIXEL).agg(best).select(*keys, *PIXEL, (-F.col("b.r")).alias("src_row"), (-F.col("b.c")).alias("src_col"), F.col("b.dist_m").alias("dist_m"), *[F.col(f"b.{c}").alias(c) for c in carried])


def rasters(swath: DataFrame, grids: DataFrame, keys: list[str], *values: str) -> DataFrame:
    """(*keys, dst_row, dst_col, *values): all pixels of all grids; those without a source in reach are missing."""
    found = nearest_in_reach(swath, grids, keys, *values).select(*keys, *PIXEL, *values)
    return pixels(grids, keys).select(*keys, *PIXEL).join(found, [*keys, *PIXEL], "left")


def level_rasters(swath: DataFrame, levels: DataFrame, grids: DataFrame, keys: list[str], mask: str) -> DataFrame:
    """(*keys, dst_row, dst_col, level_idx, value) of levels (*keys, src_row, src_col, level_idx, value) by one map for all of
    them, at pixels whose source isn't missing `mask`."""
    found = nearest_in_reach(swath, grids, keys, mask).filter(F.col(mask).isNotNull())
    return found.select(*keys, *PIXEL, "src_row", "src_col").join(levels, [*keys, "src_row", "src_col"]).drop("src_row", "src_col")
