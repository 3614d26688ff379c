"""Radar curtains: profiles along a track, cut into overlapping chunks with nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import mask_outside
from ..operators.algebra import chunk_overlap

#: Columns of a chunk, columns that it shares with the next, columns between nodes, and rows of the curtain.
SIZE, SHARED, NODE, BINS = 1000, 1, 10, 104


def chunked(profiles: DataFrame, size: int = SIZE) -> DataFrame:
    """profiles (file, ray, ...) by chunk, with `col`, the column within it; a ray that two chunks share is in both."""
    return chunk_overlap(profiles, "ray", size, SHARED).withColumn("col", (F.col("ray") - F.col("chunk") * (size - SHARED)).cast("int"))


def nodes(rays: DataFrame) -> DataFrame:
    """(file, chunk, columns, nodes) of chunked rays: every tenth column and the last one, as structs (col, lat, lon) in order. A chunk
    has a hundred or so."""
    ends = rays.groupBy("file", "chunk").agg(F.max("col").alias("end"))
    at = rays.join(ends, ["file", "chunk"]).filter((F.col("col") % NODE == 0) | (F.col("col") == F.col("end")))
    return at.groupBy("file", "chunk").agg((F.max("end") + 1).alias("columns"), F.sort_array(F.collect_list(F.struct("col", "lat", "lon"))).alias("nodes"))


def track(rays: DataFrame) -> DataFrame:
    """Chunked rays with the place of the track between nodes: straight between two of them, over the date line the short way."""
    at = rays.join(nodes(rays), ["file", "chunk"])
    nth = F.floor(F.col("col") / NODE).cast("int")
    at = at.withColumns({"a": F.get("nodes", nth), "b": F.coalesce(F.get("nodes", nth + 1), F.get("nodes", nth))}).drop("nodes", "columns")
    share = F.coalesce(F.try_divide(F.col("col") - F.col("a.col"), F.col("b.col") - F.col("a.col")), F.lit(0.0))
    step = F.col("b.lon") - F.col("a.lon")
    lon = F.col("a.lon") + share * F.when(step > 180, step - 360).when(step < -180, step + 360).otherwise(step)
    lon = F.when(lon > 180, lon - 360).when(lon < -180, lon + 360).otherwise(lon)
    return at.withColumns({"track_lat": F.col("a.lat") + share * (F.col("b.lat") - F.col("a.lat")), "track_lon": lon}).drop("a", "b")


def curtain(profiles: DataFrame, low: float, high: float, factor: float, bins: int = BINS, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """The pixels (file, chunk, row, col, value, track_lat, track_lon) and the chunks (file, chunk, columns, levels, nodes) of radar
    profiles (file, ray, lat, lon, values and heights by bin).

    Profiles stand side by side: a bin is a row, from the top, of which the first `bins` stay, a ray a column. Values outside the
    valid range are missing, others divided by the factor. levels: the mean height of each row over the chunk's columns, from
    the ground, where it isn't negative."""
    rays = chunked(profiles, size)
    cut = lambda c: F.slice(c, 1, bins)
    pixels = track(rays.withColumn("values", cut("values")).drop("heights")).select("file", "chunk", F.posexplode("values").alias("row", "raw"), "col", "track_lat", "track_lon")
    pixels = pixels.select("file", "chunk", "row", "col", (mask_outside(F.col("raw"), low, high) / factor).alias("value"), "track_lat", "track_lon")
    means = rays.select("file", "chunk", F.posexplode(cut("heights")).alias("row", "height")).groupBy("file", "chunk", "row").agg(F.avg("height").alias("height")).filter("height >= 0")
    levels = means.groupBy("file", "chunk").agg(F.transform(F.sort_array(F.collect_list(F.struct("row", "height")), asc=False), lambda x: x["height"]).alias("levels"))  # a row each
    return pixels, nodes(rays).join(levels, ["file", "chunk"], "left")
