"""Regridding, gap filling and tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..functions.values import num
from ..operators import nearest, regrid
from ..operators import swath as swaths
from ..operators.stats import right_distances
from .inputs import HAVERSINE, SAMPLES, SWATH, cells, cells_sql, r6, samples, swath, table
from .registry import query

NORTH, WEST, STEP, ROWS, COLS = 24.0, -18.0, 1.5, 20, 20
_TARGET = f"target AS (SELECT CAST(i // {COLS} AS INT) AS dst_row, CAST(i % {COLS} AS INT) AS dst_col, {NORTH}e0 - (i // {COLS}) * {STEP}e0 AS lat, {WEST}e0 + (i % {COLS}) * {STEP}e0 AS lon FROM range(0, {ROWS * COLS}) t(i))"
_NEAR = f"""WITH {SWATH}, {_TARGET}, n AS (SELECT *, row_number() OVER (PARTITION BY dst_row, dst_col ORDER BY dist, src_row DESC, src_col DESC) AS nth
  FROM (SELECT dst_row, dst_col, src_row, src_col, value, {HAVERSINE} AS dist FROM target, (SELECT src_row, src_col, lat AS slat, lon AS slon, value FROM swath)))"""


def _target(spark):
    return regrid.target_grid(spark, NORTH, WEST, ROWS, COLS, STEP)


def _map(spark, d, metres=150_000.0):
    return regrid.pixel_map(_target(spark), swath(spark, d), metres)


@query("""SELECT s_suppkey, CAST(r AS INT) AS dst_row, CAST(c AS INT) AS dst_col, s_suppkey % 140 - 60 - 0.25e0 * r AS lat, s_suppkey * 7 % 300 - 150 + 0.25e0 * c AS lon
FROM (SELECT *, unnest(range(CAST(trunc((s_suppkey % 5 * 0.4e0 + 0.3e0) / 0.25e0) AS INT))) AS r FROM supplier), range(CAST(trunc((s_suppkey % 3 * 0.7e0 + 0.6e0) / 0.25e0) AS INT)) t(c)""")
def regrid_bbox_ll(spark, d):
    """A grid for the box of each supplier, cut to whole steps."""
    k = F.col("s_suppkey")
    north, west = (k % 140 - 60).cast("double"), (k * 7 % 300 - 150).cast("double")
    boxes = table(spark, d, "supplier").select(k, north.alias("north"), west.alias("west"), (north - (k % 5 * num(0.4) + num(0.3))).alias("south"), (west + (k % 3 * num(0.7) + num(0.6))).alias("east"))
    return swaths.pixels(swaths.grids_of(boxes, ["s_suppkey"], num(0.25)), ["s_suppkey"])


@query(f"{_NEAR} SELECT dst_row, dst_col, value FROM n WHERE nth = 1 AND dist < 150000")
def regrid_nn(spark, d):
    return regrid.apply_map(_map(spark, d), swath(spark, d).select("src_row", "src_col", "value"))


@query(f"{_NEAR} SELECT dst_row, dst_col, src_row, src_col, round(dist, 2) AS dist_m FROM n WHERE nth = 1 AND dist < 60000")
def nn_threshold_custom(spark, d):
    return _map(spark, d, 60_000.0).withColumn("dist_m", F.round("dist_m", 2))


@query(f"{_NEAR} SELECT dst_row, dst_col, src_row, src_col, round(dist, 2) AS dist_m FROM n WHERE nth = 1")
def nn_index(spark, d):
    return nearest.nearest_pixels(_target(spark), swath(spark, d)).withColumn("dist_m", F.round("dist_m", 2))


@query(f"{_NEAR} SELECT dst_row, dst_col, CASE WHEN dist < 150000 THEN value ELSE 0 END AS value FROM n WHERE nth = 1")
def nn_missing(spark, d):
    return regrid.apply_map(_map(spark, d), swath(spark, d).select("src_row", "src_col", "value"), _target(spark), 0.0)


@query(
    f"""{_NEAR}, s AS (SELECT src_row, src_col, lat, lon, lead(lat) OVER w AS slat, lead(lon) OVER w AS slon FROM swath WINDOW w AS (PARTITION BY src_row ORDER BY src_col)),
g AS (SELECT src_row, src_col, CASE WHEN slat IS NOT NULL THEN {HAVERSINE} END AS own FROM s),
h AS (SELECT src_row, src_col, coalesce(own, lag(own) OVER (PARTITION BY src_row ORDER BY src_col)) AS gap, avg(own) OVER () AS mean FROM g)
SELECT dst_row, dst_col, src_row, src_col FROM n JOIN h USING (src_row, src_col) WHERE nth = 1 AND dist < CASE WHEN gap < mean THEN 2 * mean ELSE gap END"""
)
def nn_threshold(spark, d):
    s = right_distances(swath(spark, d).withColumnsRenamed({"src_row": "row", "src_col": "col"}), geo.haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")))
    source = s.withColumnsRenamed({"row": "src_row", "col": "src_col"})
    return nearest.within_own_threshold(nearest.nearest_pixels(_target(spark), source), source).select("dst_row", "dst_col", "src_row", "src_col")


@query(f"{_NEAR} SELECT dst_row, dst_col, level, value * level AS value FROM n, (SELECT unnest(range(1, 4)) AS level) WHERE nth = 1 AND dist < 150000")
def index_apply(spark, d):
    """One map, applied to several levels."""
    levels = swath(spark, d).withColumn("level", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(3).cast("long"))))
    return regrid.apply_map(_map(spark, d), levels.select("src_row", "src_col", "level", (F.col("value") * F.col("level")).alias("value")))


@query(f"WITH {SAMPLES} SELECT coverage_id, max(lat) AS north, min(lon) AS west, min(lat) AS south, max(lon) AS east FROM samples GROUP BY ALL")
def regrid_auto_bbox(spark, d):
    return regrid.auto_bbox(samples(spark, d), "coverage_id")


@query(f"WITH {SAMPLES} SELECT coverage_id, (floor(max(lat) * 4) + 1) / 4 AS north, floor(min(lon) * 4) / 4 AS west, floor(min(lat) * 4) / 4 AS south, (floor(max(lon) * 4) + 1) / 4 AS east FROM samples GROUP BY ALL")
def regrid_snap_bbox(spark, d):
    box, four = regrid.auto_bbox(samples(spark, d), "coverage_id"), F.lit(4)
    return box.withColumns({c: geo.grid_snap(F.col(c), four, up) for c, up in (("north", True), ("west", False), ("south", False), ("east", True))})


@query(f"WITH {SAMPLES}, {cells_sql('A', 'a')} SELECT row - 3 AS row, col - 12 AS col, level_idx, round(value, 6) AS value FROM a WHERE row BETWEEN 3 AND 8 AND col BETWEEN 12 AND 21")
def cut_only(spark, d):
    """A box of a grid that has the step already: cells are taken over and counted from the box's corner, without a search."""
    return regrid.cut(cells(spark, d, "A"), 90.0, -180.0, 10.0, 60.0, -60.0, 6, 10).withColumn("value", r6("value"))


_GAPS = f"WITH {SAMPLES}, g AS (SELECT * FROM (SELECT row, col, CASE WHEN (row * 7 + col * 3) % 5 < 2 THEN avg(value) END AS value FROM samples WHERE coverage_id = 'A' GROUP BY row, col) WHERE value IS NOT NULL)"


@query(
    f"""{_GAPS}, e AS (SELECT CAST(i // 36 AS INT) AS row, CAST(i % 36 AS INT) AS col FROM range(0, 648) t(i)),
n AS (SELECT e.row, e.col, g.value AS v, sqrt(CAST((e.row - g.row) * (e.row - g.row) + (e.col - g.col) * (e.col - g.col) AS DOUBLE)) AS dd FROM e JOIN g ON abs(e.row - g.row) <= 1 AND abs(e.col - g.col) <= 1 AND NOT (e.row = g.row AND e.col = g.col)),
f AS (SELECT row, col, CASE WHEN count(*) = 1 THEN sum(v) ELSE sum(v * (1 - dd / tot)) / (count(*) - 1) END AS filled FROM (SELECT *, sum(dd) OVER (PARTITION BY row, col) AS tot FROM n) GROUP BY row, col)
SELECT e.row, e.col, round(coalesce(g.value, filled), 5) AS value FROM e LEFT JOIN g ON e.row = g.row AND e.col = g.col LEFT JOIN f ON e.row = f.row AND e.col = f.col"""
)
def idw_fill(spark, d):
    """A grid with gaps."""
    grid = samples(spark, d).filter("coverage_id = 'A'").groupBy("row", "col").agg(F.avg("value").alias("value"))
    return regrid.idw_fill(grid.withColumn("value", F.expr("CASE WHEN (row * 7 + col * 3) % 5 < 2 THEN value END")), 18, 36).withColumn("value", F.round("value", 5))


@query(
    """WITH t AS (SELECT n_nationkey // 5 AS line, n_nationkey % 5 AS tie, CAST((n_nationkey * 97) % 360 - 180 AS DOUBLE) AS v FROM nation),
p AS (SELECT line, tie, v, lead(v) OVER (PARTITION BY line ORDER BY tie) AS w FROM t), x AS (SELECT unnest(range(0, 20)) AS col),
q AS (SELECT line, col, CASE WHEN abs(v - w) > 180 AND v < 0 THEN v + 360 ELSE v END AS a, CASE WHEN abs(v - w) > 180 AND w < 0 THEN w + 360 ELSE w END AS b, col / 4.0e0 - tie AS f FROM p, x
  WHERE w IS NOT NULL AND least(col // 4, 3) = tie)
SELECT line, col, round(CASE WHEN a + f * (b - a) > 180 THEN a + f * (b - a) - 360 ELSE a + f * (b - a) END, 6) AS lon FROM q"""
)
def tiepoint_interp(spark, d):
    k = F.col("n_nationkey")
    ties = spark.read.parquet(f"{d}/nation.parquet").select(F.floor(k / 5).alias("line"), (k % 5).cast("long").alias("tie"), ((k * 97) % 360 - 180).cast("double").alias("lon"))
    return regrid.tiepoint_interp(ties, 4, 20, "lon", longitude=True).withColumn("lon", r6("lon"))


_TILED = f"WITH {SAMPLES}, a AS (SELECT coverage_id, row, col, level_idx, avg(value) AS value FROM samples GROUP BY ALL), t AS (SELECT coverage_id, level_idx, row // 4 AS tile_row, col // 6 AS tile_col, value FROM a)"
LAYER = ["coverage_id", "level_idx"]


def _tiled(spark, d):
    """All levels of all coverages, in tiles of 4 by 6 cells."""
    return regrid.add_tiles(samples(spark, d).groupBy("coverage_id", "row", "col", "level_idx").agg(F.avg("value").alias("value")), 4, 6)


@query(f"{_TILED} SELECT coverage_id, level_idx, tile_row, tile_col, tile_row * 6 + CASE WHEN tile_row % 2 = 0 THEN tile_col ELSE 5 - tile_col END AS nth, count(*) AS n, round(avg(value), 6) AS value FROM t GROUP BY ALL")
def grid_tiles(spark, d):
    tiles = _tiled(spark, d).groupBy(*LAYER, "tile_row", "tile_col").agg(F.count("*").alias("n"), r6(F.avg("value")).alias("value"))
    return regrid.tile_walk(tiles, 6)


@query(f"{_TILED} SELECT coverage_id, level_idx, tile_row, tile_col, count(*) AS n, count(*) FILTER (WHERE value IS NULL OR value = 0) AS n_blank FROM (SELECT coverage_id, level_idx, tile_row, tile_col, CASE WHEN tile_row = 1 THEN 0 ELSE value END AS value FROM t) GROUP BY ALL HAVING count(*) FILTER (WHERE value IS NULL OR value = 0) < count(*)")
def tile_skip_blank(spark, d):
    return regrid.drop_blank_tiles(_tiled(spark, d).withColumn("value", F.when(F.col("tile_row") == 1, num(0)).otherwise(F.col("value"))), 0.0, *LAYER)


@query(f"{_TILED} SELECT DISTINCT coverage_id, level_idx, tile_row, tile_col FROM t WHERE tile_row = 2 OR (tile_row = 3 AND tile_col = 1)")
def good_tile_semi(spark, d):
    allow = spark.createDataFrame([(2, c) for c in range(6)] + [(3, 1), (9, 9)], "tile_row int, tile_col int")
    return regrid.allowed_tiles(_tiled(spark, d).select(*LAYER, "tile_row", "tile_col").distinct(), allow)


@query(f"{_TILED} SELECT coverage_id, level_idx, tile_row, tile_col, count(*) FILTER (WHERE value IS NULL OR value > 30) AS n_blank FROM t GROUP BY ALL")
def blank_count(spark, d):
    """Blank are missing values and those over 30."""
    return regrid.blank_counts(_tiled(spark, d).withColumn("value", F.when(F.col("value") <= 30, F.col("value"))), None, *LAYER).drop("n")
