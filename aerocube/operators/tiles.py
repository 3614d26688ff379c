"""Names, times and places of tiles, and rasters and tiles in UTM."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import lat_band, mgrs_digraph, utm_forward, utm_zone
from ..functions.times import line_time
from .nearest import nearest_pixels

TILE = 100


def place_name(lat: Column, lon: Column, decimals: int, prefix: str = "", suffix: str = "") -> Column:
    """`prefix45.25_-012.50suffix`: a tile's corner with so many decimals, the sign counted among the zeros."""
    return F.concat(F.lit(prefix), F.format_string(f"%06.{decimals}f_%07.{decimals}f", lat, lon), F.lit(suffix))


def zone_name(t: Column, zone: Column, prefix: str = "", suffix: str = "") -> Column:
    """`prefix20150601_101530_0001234suffix`: a tile's time and zone."""
    return F.concat(F.lit(prefix), F.date_format(t, "yyyyMMdd_HHmmss"), F.format_string("_%07d", zone), F.lit(suffix))


def tile_times(tiles: DataFrame, source: DataFrame, start: str, end: str, lines: int, tags: DataFrame | None = None) -> DataFrame:
    """tiles (tile_row, tile_col, lat, lon of the corner) with `t`, the time at the line of the nearest source pixel.

    start, end: UTC times of the first and the last of the lines; a pass may cross midnight. Rounded to seconds. tags: track tags
    (nth, line, src_row, src_col) of a raster that was cut from a longer pass; then only the tagged pixels count, of equally
    near ones the first, and the line is that of the pass."""
    named = {"tile_row": "dst_row", "tile_col": "dst_col"}
    if tags is not None:
        # numbered backwards, since ties go to the larger number
        source = tags.join(source, ["src_row", "src_col"]).select((-F.col("nth")).alias("src_row"), F.lit(0).alias("src_col"), "lat", "lon", "line")
    near = nearest_pixels(tiles.withColumnsRenamed(named), source).withColumnsRenamed({v: k for k, v in named.items()})
    if tags is not None:
        near = near.join(source.select("src_row", "line"), "src_row").drop("src_row").withColumnRenamed("line", "src_row")
    begin, finish = (F.unix_seconds(F.lit(x).cast("timestamp")) for x in (start, end))
    offset = line_time(begin % 86_400, finish % 86_400, F.col("src_row"), F.lit(lines)) - begin % 86_400
    offset = F.when(offset < 0, offset + 86_400).otherwise(offset)
    t = F.timestamp_seconds(begin + F.floor(offset + 0.5))
    return tiles.join(near.select("tile_row", "tile_col", t.alias("t")), ["tile_row", "tile_col"])


def tree_folder(lat: Column, lon: Column, t: Column) -> Column:
    """`+45.25/-012.50/2015`: folders by quarter degree, cut towards zero, and year; 180 degrees east are west."""
    quarter = lambda c: ((c * 100).cast("int") / 25).cast("int") * 25 / 100.0
    y, x = quarter(lat), quarter(lon)
    x = F.when(x == 180, F.lit(-180.0)).otherwise(x)
    signed = lambda v, n: F.when(v >= 0, F.concat(F.lit("+"), F.format_string(f"%0{n - 1}.2f", v))).otherwise(F.format_string(f"%0{n}.2f", v))
    return F.concat_ws("/", signed(y, 6), signed(x, 7), F.date_format(t, "yyyy"))


def utm_step(spacing_m: float, least: float = 0.0) -> float:
    """The greatest power of ten that isn't over the mean spacing of the pixels, at least `least`."""
    return max(10.0 ** math.floor(math.log10(max(math.floor(spacing_m), 1))), least)


def utm_raster(points: DataFrame, step: float) -> DataFrame:
    """(zone, row, col, value) of points (lat, lon, value): a raster for each zone, of which each pixel has the
    value of the point that is nearest to its middle; of equally near ones the southernmost, westernmost. Rows count
    from the equator."""
    east, north = utm_forward(F.col("lat"), F.col("lon"))
    rows = points.withColumns({"zone": utm_zone(F.col("lon")), "east": east, "north": north})
    row, col = F.floor(F.col("north") / step), F.floor(F.col("east") / step)
    off = F.pow(F.col("east") - (col + 0.5) * step, 2) + F.pow(F.col("north") - (row + 0.5) * step, 2)
    return rows.groupBy("zone", row.alias("row"), col.alias("col")).agg(F.min_by("value", F.struct(F.round(off, 3), "lat", "lon")).alias("value"))


#: Digits of a name's easting and northing by pixel size in metres.
DIGITS = {1000.0: 0, 100.0: 1, 10.0: 2, 1.0: 3}


def military_name(zone: Column, band: Column, easting: Column, northing: Column, step: float) -> Column:
    """`33TWN12`: zone, band, the 100 km square's letters and the first digits of what is left; easting and northing are those
    of the tile's south-western corner."""
    n = DIGITS.get(float(step), 5)
    digits = lambda v: F.substring(F.lpad(F.right(v.cast("long").cast("string"), F.lit(5)), 5, "0"), 1, n) if n else F.lit("")
    return F.concat(F.format_string("%02d", zone), band, mgrs_digraph(zone, easting, northing), digits(easting), digits(northing))


def military_tiles(pixels: DataFrame, step: float, blank: float | None = None) -> DataFrame:
    """Tiles of 100 by 100 pixels of pixels (zone, lat, easting, northing, value), with name, number of pixels and of blank
    ones and the mean of the others; tiles that are blank all over are left out. The band is that of the tile's least lat."""
    size = TILE * step
    west, south = F.floor(F.col("easting") / size) * size, F.floor(F.col("northing") / size) * size
    is_blank = F.col("value").isNull() if blank is None else F.col("value").isNull() | (F.col("value") == blank)
    tiles = pixels.groupBy("zone", west.alias("west"), south.alias("south")).agg(
        F.min("lat").alias("lat"), F.count("*").alias("n"), F.count_if(is_blank).alias("n_blank"), F.avg(F.when(~is_blank, F.col("value"))).alias("value")
    )
    return tiles.filter("n_blank < n").select(military_name(F.col("zone"), lat_band(F.col("lat")), F.col("west"), F.col("south"), step).alias("name"), "zone", "west", "south", "n", "n_blank", "value")
