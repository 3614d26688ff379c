"""Where pixels lie: coordinate bands, control points, affine transforms, the date line."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import utm_inverse


#: Pixels that a task has on average at most.
TASK = 2_000_000


def swath_coords(values: DataFrame, latitudes: DataFrame, longitudes: DataFrame, on: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """values (row, col, value) with lat and lon from two bands (row, col, value) of the coordinates' file."""
    band = lambda df, name: df.select(*on, F.col("value").alias(name))
    return values.join(band(latitudes, "lat"), list(on)).join(band(longitudes, "lon"), list(on))


def control_points(lines: DataFrame) -> DataFrame:
    """(file, lon, lat, x, y) of the lines (file, line) of control point texts `lon lat x y`.

    Lines that begin with ; are comments; one with `; Zone Number: 33N` says that the first two numbers are UTM eastings and
    northings of that zone."""
    zone = F.regexp_extract("line", r"; Zone Number:\s*(\d+)", 1).try_cast("int")
    heads = lines.filter(F.col("line").contains("; Zone Number:")).groupBy("file").agg(F.max(zone).alias("zone"), F.max(F.trim("line").endswith("S")).alias("south"))
    cells = F.filter(F.split("line", r"\s+"), lambda x: x != "")
    number = lambda i: F.get(cells, i).try_cast("double")
    points = lines.filter(~F.startswith("line", F.lit(";")) & (F.trim("line") != "")).select("file", number(0).alias("a"), number(1).alias("b"), number(2).alias("x"), number(3).alias("y"))
    points = points.join(heads, "file", "left")
    lat, lon = utm_inverse(F.col("a"), F.col("b"), F.col("zone"), F.coalesce("south", F.lit(False)))
    flat = F.col("zone").isNull()
    return points.select("file", F.when(flat, F.col("a")).otherwise(lon).alias("lon"), F.when(flat, F.col("b")).otherwise(lat).alias("lat"), "x", "y")


def point_spacing(points: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, wide, high): how many columns and rows lie between neighbouring control points (*keys, row, col) of each grid, 0 where
    there are no gaps; the least distance along a row and along a column."""
    gap = lambda along, by: F.col(along) - F.lag(along).over(Window.partitionBy(*keys, by).orderBy(along)) - 1
    once = points.select(*keys, "row", "col").distinct()
    gaps = once.select(*keys, gap("col", "row").alias("wide"), gap("row", "col").alias("high"))
    return gaps.groupBy(*keys).agg(F.coalesce(F.min("wide"), F.lit(0)).alias("wide"), F.coalesce(F.min("high"), F.lit(0)).alias("high"))


def densify(points: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, row, col, lat, lon): all pixels of each grid (sizes: *keys, rows, columns) from its control points (*keys, row, col, lat,
    lon).

    The spacing of a grid's points is measured, and a pixel between them gets the mean of those within so many columns and
    rows, a point at distance d weighing (1 - d / sum of d) / (n - 1). Means are taken of directions on the sphere, so the date
    line and poles are as good as any other place. Each point is sent to the rows of pixels around it and spread over their columns
    there, so a pixel meets about four of them and no pixel is shuffled. Pixels without a point in reach are missing; of several points of one pixel the
    one with the greatest lat and lon counts."""
    known = points.filter("lat is not null and lon is not null").groupBy(*keys, "row", "col").agg(F.max(F.struct("lat", "lon")).alias("p")).select(*keys, "row", "col", "p.*")
    lat, lon = F.radians("lat"), F.radians("lon")
    near = known.join(point_spacing(known, keys), keys).join(sizes, keys).withColumns({"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)})
    around = lambda at, by, size: F.explode(F.sequence(F.greatest(F.col(at) - F.col(by), F.lit(0)).cast("int"), F.least(F.col(at) + F.col(by), F.col(size) - 1).cast("int")))
    sent = near.withColumn("to_row", around("row", "high", "rows")).select(*keys, "to_row", "columns", "row", "col", "wide", "lat", "lon", *"xyz")
    sizes = sizes.filter("rows > 0 and columns > 0")
    every = sizes.select(*keys, F.explode(F.sequence(F.lit(0), (F.col("rows") - 1).cast("int"))).alias("to_row"), "columns")
    # rows of pixels and the points that reach them meet before either is spread over columns
    number = sizes.agg(F.sum(F.col("rows").cast("long") * F.col("columns"))).first()[0] or 0
    dealt = max(int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")), number // TASK)
    met = every.unionByName(sent, allowMissingColumns=True).repartition(dealt, *keys, "to_row")
    alone = F.col("row").isNull()
    first, last = F.greatest(F.col("col") - F.col("wide"), F.lit(0)).cast("int"), F.least(F.col("col") + F.col("wide"), F.col("columns") - 1).cast("int")
    met = met.withColumn("to_col", F.explode(F.when(alone, F.sequence(F.lit(0), (F.col("columns") - 1).cast("int"))).otherwise(F.sequence(first, last))))
    d = F.sqrt(F.pow(F.col("to_row") - F.col("row"), 2) + F.pow(F.col("to_col") - F.col("col"), 2))
    # sum of v (1 - d / D) / (n - 1) = (sum v - sum v d / D) / (n - 1)
    sums = [F.sum(v).alias(v) for v in "xyz"] + [F.sum(F.col(v) * d).alias(f"{v}d") for v in "xyz"]
    own = (F.col("to_row") == F.col("row")) & (F.col("to_col") == F.col("col"))
    got = met.groupBy(*keys, F.col("to_row").alias("row"), F.col("to_col").alias("col")).agg(F.count("row").alias("n"), F.sum(d).alias("d"), F.count_if(alone).alias("pixels"), *[F.max(F.when(own, F.col(c))).alias(c) for c in ("lat", "lon")], *sums)
    mean = {v: F.when(F.col("n") == 1, F.col(v)).otherwise((F.col(v) - F.try_divide(f"{v}d", "d")) / (F.col("n") - 1)) for v in "xyz"}
    got = got.filter("pixels > 0").select(*keys, "row", "col", "lat", "lon", *[F.when(F.col("n") > 0, c).alias(v) for v, c in mean.items()])
    middle = {"lat": F.degrees(F.atan2(F.col("z"), F.sqrt(F.col("x") ** 2 + F.col("y") ** 2))), "lon": F.degrees(F.atan2("y", "x"))}
    return got.select(*keys, "row", "col", *[F.coalesce(c, m).alias(c) for c, m in middle.items()])


def dateline_shift(pixels: DataFrame, *keys: str) -> DataFrame:
    """pixels with lon between -180 and 180, and where a group's longitudes then span over 360 degrees the negative ones
    shifted east by 360."""
    lon = F.col("lon")
    rows = pixels.withColumn("lon", F.when(lon < -180, lon + 360).when(lon > 180, lon - 360).otherwise(lon))
    wide = rows.groupBy(*keys).agg((F.max("lon") - F.min("lon") > 360).alias("__wide"))
    rows = rows.join(wide.filter("__wide"), list(keys), "left") if keys else rows.crossJoin(F.broadcast(wide))  # one row
    return rows.withColumn("lon", F.when(F.col("__wide") & (lon < 0), lon + 360).otherwise(lon)).drop("__wide")


def affine_forward(col: Column, row: Column, transform: Column) -> tuple[Column, Column]:
    """(x, y) of a pixel's corner; transform: the six numbers x0, dx, rx, y0, ry, dy."""
    t = lambda i: F.get(transform, F.lit(i))
    return t(0) + col * t(1) + row * t(2), t(3) + col * t(4) + row * t(5)


def affine_inverse(x: Column, y: Column, transform: Column) -> tuple[Column, Column]:
    """(col, row), fractional, of a place; NULL for a transform that can't be inverted.

    Rounded at nine decimals, so that a pixel's corner gives the pixel's own numbers and not a hair less, which would be the
    pixel before."""
    t = lambda i: F.get(transform, F.lit(i))
    det = t(1) * t(5) - t(2) * t(4)
    dx, dy = x - t(0), y - t(3)
    return F.round(F.try_divide(dx * t(5) - dy * t(2), det), 9), F.round(F.try_divide(dy * t(1) - dx * t(4), det), 9)


def extent_pixels(text: Column) -> tuple[Column, Column]:
    """(columns, rows) of extents such as `600x400`; NULL for others."""
    number = lambda i: F.regexp_extract(text, r"^\s*(\d+)x(\d+)\s*$", i).try_cast("int")
    return number(1), number(2)


def extent(text: str) -> tuple[str, tuple[float, float]]:
    """What an extent option means: `600x400` are columns and rows, `35.5,18` the south-eastern corner's lat and lon."""
    if found := re.fullmatch(r"\s*(\d+)x(\d+)\s*", text):
        return "pixels", (int(found[1]), int(found[2]))
    lat, lon = text.split(",")
    return "corner", (float(lat), float(lon))
