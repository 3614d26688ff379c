"""Rasters in UTM, tiles that hold their pixels, and zoom levels."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.values import num
from ..operators import pyramid, utm
from ..streaming.ingest import work_folder
from .expressions import utm_sql
from .inputs import HAVERSINE, SAMPLES, r6, samples, table
from .registry import query

LEVELS = 11


def _cells(spark, d):
    """Coverages in cells of a degree: sums and counts of their samples."""
    s = samples(spark, d).select("coverage_id", F.floor(90 - F.col("lat")).cast("int").alias("row"), F.floor(F.col("lon") + 180).cast("int").alias("col"), "value")
    return s.groupBy("coverage_id", "row", "col").agg(F.sum("value").alias("total"), F.count("value").alias("count"))


_CELLS = f"WITH {SAMPLES}, c AS (SELECT coverage_id, CAST(floor(90 - lat) AS INT) AS row, CAST(floor(lon + 180) AS INT) AS col, sum(value) AS total, count(value) AS count FROM samples WHERE value IS NOT NULL GROUP BY ALL)"


@query(f"{_CELLS} SELECT coverage_id, row, col, round(total, 6) AS total, count FROM c")
def tile_pixels(spark, d):
    """Cells packed into tiles, and what the tiles hold."""
    tiles = pyramid.pack(_cells(spark, d), ["coverage_id"])
    return pyramid.unpack(tiles, ["coverage_id"]).withColumn("total", r6("total"))


@query(f"""{_CELLS}, p AS (SELECT coverage_id, CAST(l AS INT) AS level, row >> l AS r, col >> l AS c, sum(total) AS total, sum(count) AS n FROM c, range({LEVELS}) t(l) GROUP BY ALL)
SELECT coverage_id, level, r // 64 AS tile_row, c // 64 AS tile_col, count(*) AS n_pixels, sum(n) AS n, round(sum(total / n), 4) AS means, max(r % 64 * 64 + c % 64) AS last FROM p GROUP BY ALL""")
def tile_pyramid(spark, d):
    """Eleven zoom levels, each made from the one below: of each tile its pixels, the values behind them, and the sum of the means."""
    folder = f"{work_folder(spark)}/pyramid-{uuid.uuid4().hex}"
    pyramid.build(_cells(spark, d), folder, ["coverage_id"], LEVELS)
    tiles = pyramid.values(pyramid.read(spark, folder))
    there = F.filter(F.sequence(F.lit(0), F.size("pixels") - 1), lambda i: F.get("pixels", i).isNotNull())
    means = F.aggregate("pixels", num(0), lambda s, x: s + F.coalesce(x, num(0)))
    return tiles.select("coverage_id", "level", "tile_row", "tile_col", F.size(F.filter("pixels", lambda x: x.isNotNull())).cast("long").alias("n_pixels"), F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n"), F.round(means, 4).alias("means"), F.array_max(there).alias("last"))


def _strip(spark, d):
    """Events as a swath over the border of two zones, with a gap of a degree and some missing values."""
    k = F.col("event_id")
    line, sample = F.floor(k / 100), k % 100
    lat = num(45) + line * num(0.02) + (k * 7919 % 997) * num(0.00001)
    lon = num(4.2) + sample * num(0.037) + F.when(sample >= 60, num(1)).otherwise(num(0)) + (k * 7919 % 997) * num(0.00001)
    return table(spark, d, "events").select(line.cast("int").alias("row"), sample.cast("int").alias("col"), lat.alias("lat"), lon.alias("lon"), F.when(k % 97 != 0, F.col("value")).alias("value"))


_STRIP = "SELECT CAST(event_id // 100 AS INT) AS src_row, CAST(event_id % 100 AS INT) AS src_col, 45 + event_id // 100 * 0.02e0 + (event_id * 7919 % 997) * 0.00001e0 AS lat, 4.2e0 + event_id % 100 * 0.037e0 + CASE WHEN event_id % 100 >= 60 THEN 1e0 ELSE 0e0 END + (event_id * 7919 % 997) * 0.00001e0 AS lon, CASE WHEN event_id % 97 <> 0 THEN value END AS value FROM events"


@query(f"""WITH p AS ({utm_sql(_STRIP)}), p1 AS (SELECT *, lead(lat) OVER w AS slat, lead(lon) OVER w AS slon FROM p WINDOW w AS (PARTITION BY src_row ORDER BY src_col)), p2 AS (SELECT *, {HAVERSINE} AS gap0 FROM p1),
p3 AS (SELECT *, coalesce(gap0, lag(gap0) OVER (PARTITION BY src_row ORDER BY src_col)) AS gap, avg(gap0) OVER () AS mean FROM p2), s AS (SELECT *, CASE WHEN gap < mean THEN 2 * mean ELSE gap END AS threshold FROM p3),
g AS (SELECT zone, trunc(max(north) / 10000) * 10000 AS top, trunc(min(east) / 10000) * 10000 AS west, CAST((trunc(max(north) / 10000) - trunc(min(north) / 10000)) AS INT) AS h, CAST((trunc(max(east) / 10000) - trunc(min(east) / 10000)) AS INT) AS w FROM s GROUP BY zone),
px AS (SELECT *, west + dst_col * 10000e0 AS easting, top - dst_row * 10000e0 AS northing FROM (SELECT *, CAST(unnest(range(w)) AS INT) AS dst_col FROM (SELECT *, CAST(unnest(range(h)) AS INT) AS dst_row FROM g))),
n AS (SELECT px.zone, dst_row, dst_col, easting, northing, sqrt(power(east - easting, 2) + power(north - northing, 2)) AS dist, threshold, value FROM px JOIN s USING (zone)
  QUALIFY row_number() OVER (PARTITION BY px.zone, dst_row, dst_col ORDER BY dist, src_row DESC, src_col DESC) = 1)
SELECT zone, dst_row, dst_col, easting, northing, CASE WHEN dist < threshold THEN round(value, 6) END AS value FROM n""")  # fmt: skip
def utm_rasters(spark, d):
    """All pixels of two zones, steps of 10 km, each within its nearest point's own threshold."""
    return utm.utm_rasters(_strip(spark, d), least_step=10_000.0).select("zone", "dst_row", "dst_col", "easting", "northing", r6("value").alias("value"))
