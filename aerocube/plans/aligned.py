"""Two coverages of different grids (A in cells of 10 degrees, R in cells of 15) on a common one, and what is made of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import align, stats
from ..operators.align import Box, Grid
from .inputs import HAVERSINE, SAMPLES, r6, samples
from .registry import query

FINE, COARSE = Grid(90.0, -180.0, 18, 36, 10.0), Grid(90.0, -180.0, 12, 24, 15.0)
WORLD, EUROPE, TROPICS = Box(75.0, -170.0, -65.0, 150.0), Box(70.0, -12.0, 30.0, 38.0), Box(25.0, -62.0, -45.0, 98.0)


def gridded(spark, d, coverage: str, grid: Grid, *keys):
    """The mean of a coverage's samples per cell and keys."""
    s = samples(spark, d).filter(F.col("coverage_id") == coverage)
    row, col = F.floor((grid.north - F.col("lat")) / grid.step).cast("int"), F.floor((F.col("lon") - grid.west) / grid.step).cast("int")
    return s.groupBy(row.alias("row"), col.alias("col"), *keys).agg(F.avg("value").alias("value"))


def _both(spark, d, box: Box = WORLD, *keys):
    keys = keys or ("level_idx",)
    names = tuple(k if isinstance(k, str) else "day" for k in keys)
    return align.align_two(gridded(spark, d, "A", FINE, *keys), FINE, gridded(spark, d, "R", COARSE, *keys), COARSE, box, names)


def _cells_sql(name: str, coverage: str, g: Grid, keys: str, where: str) -> str:
    return f"""{name} AS (SELECT CAST(floor(({g.north}e0 - lat) / {g.step}e0) AS INT) AS src_row, CAST(floor((lon - {g.west}e0) / {g.step}e0) AS INT) AS src_col, {keys}, avg(value) AS value
  FROM samples WHERE coverage_id = '{coverage}' {where} GROUP BY ALL)"""


def _map_sql(name: str, g: Grid) -> str:
    return f"""{name}_p AS (SELECT CAST(i // {g.columns} AS INT) AS src_row, CAST(i % {g.columns} AS INT) AS src_col, {g.north}e0 - (i // {g.columns}) * {g.step}e0 AS lat,
  {g.west}e0 + (i % {g.columns}) * {g.step}e0 AS lon FROM range(0, {g.rows * g.columns}) t(i)),
{name}_s AS (SELECT *, lead(lat) OVER w AS slat, lead(lon) OVER w AS slon FROM {name}_p WINDOW w AS (PARTITION BY src_row ORDER BY src_col)),
{name}_g AS (SELECT src_row, src_col, CASE WHEN slat IS NOT NULL THEN {HAVERSINE} END AS own FROM {name}_s),
{name}_h AS (SELECT src_row, src_col, coalesce(own, lag(own) OVER (PARTITION BY src_row ORDER BY src_col)) AS gap, avg(own) OVER () AS mean FROM {name}_g),
{name}_n AS (SELECT *, row_number() OVER (PARTITION BY dst_row, dst_col ORDER BY dist, src_row DESC, src_col DESC) AS nth
  FROM (SELECT dst_row, dst_col, src_row, src_col, {HAVERSINE} AS dist FROM tg, (SELECT src_row, src_col, lat AS slat, lon AS slon FROM {name}_p))),
{name} AS (SELECT dst_row, dst_col, src_row, src_col FROM {name}_n JOIN {name}_h USING (src_row, src_col) WHERE nth = 1 AND dist < CASE WHEN gap < mean THEN 2 * mean ELSE gap END)"""


def _sql(then: str, box: Box = WORLD, keys: str = "level_idx", where: str = "") -> str:
    rows, columns = int((box.north - box.south) / 10), int((box.east - box.west) / 10)
    on = keys.rsplit(" ", 1)[-1]
    return f"""WITH {SAMPLES}, {_cells_sql("a", "A", FINE, keys, where)}, {_cells_sql("r", "R", COARSE, keys, where)},
tg AS (SELECT CAST(i // {columns} AS INT) AS dst_row, CAST(i % {columns} AS INT) AS dst_col, {box.north}e0 - (i // {columns}) * 10e0 AS lat, {box.west}e0 + (i % {columns}) * 10e0 AS lon FROM range(0, {rows * columns}) t(i)),
{_map_sql("ma", FINE)}, {_map_sql("mr", COARSE)},
va AS (SELECT dst_row, dst_col, {on}, value AS va FROM ma JOIN a USING (src_row, src_col)), vb AS (SELECT dst_row, dst_col, {on}, value AS vb FROM mr JOIN r USING (src_row, src_col)),
pair AS (SELECT * FROM va JOIN vb USING (dst_row, dst_col, {on})) {then}"""


STATS = "round(avg(d), 6) AS d_mean, round(stddev_pop(d), 6) AS d_std, round(min(d), 6) AS d_min, round(max(d), 6) AS d_max"
DAY = "CAST(t AS DATE) AS day"


def _stats(df):
    return df.withColumns({c: r6(c) for c in ("d_mean", "d_std", "d_min", "d_max")})


@query(_sql("SELECT dst_row, dst_col, level_idx, round(va, 6) AS va, round(vb, 6) AS vb FROM pair"))
def pixel_align(spark, d):
    return _both(spark, d).withColumns({"va": r6("va"), "vb": r6("vb")})


@query(_sql("SELECT dst_row, dst_col, src_row, src_col FROM mr", EUROPE))
def align_two(spark, d):
    """The map of the coarser grid onto the finer one's step."""
    return align.grid_map(spark, COARSE, EUROPE, FINE.step).select("dst_row", "dst_col", "src_row", "src_col")


@query(_sql("SELECT dst_row, dst_col, level_idx, round(va + vb, 6) AS value FROM pair"))
def add(spark, d):
    return align.add(_both(spark, d)).withColumn("value", r6("value"))


@query(_sql("SELECT dst_row, dst_col, level_idx, round(va - vb, 6) AS value FROM pair"))
def subtract(spark, d):
    return align.subtract(_both(spark, d)).withColumn("value", r6("value"))


@query(_sql("SELECT dst_row, dst_col, level_idx, round(va - vb, 6) AS value FROM pair", TROPICS))
def wps_coverage_difference(spark, d):
    return align.subtract(_both(spark, d, TROPICS)).withColumn("value", r6("value"))


@query(_sql(f"SELECT {STATS} FROM (SELECT va - vb AS d FROM pair WHERE level_idx = 1)"))
def difference_stats(spark, d):
    diff = align.subtract(_both(spark, d).filter("level_idx = 1")).withColumnRenamed("value", "d")
    return _stats(stats.difference_stats(diff))


@query(_sql(f"SELECT CAST(day AS VARCHAR) AS day, {STATS} FROM (SELECT day, va - vb AS d FROM pair) GROUP BY day", keys=DAY))
def daily_difference_stats(spark, d):
    diff = align.subtract(_both(spark, d, WORLD, F.to_date("t").alias("day"))).withColumnRenamed("value", "d")
    return _stats(stats.difference_stats(diff, "day")).withColumn("day", F.col("day").cast("string"))


_CLIP = "t >= TIMESTAMP '1996-03-01' AND t < TIMESTAMP '1997-03-01'"


@query(_sql(f"SELECT CAST(day AS VARCHAR) AS day, {STATS} FROM (SELECT day, va - vb AS d FROM pair) GROUP BY day", keys=DAY, where=f"AND {_CLIP}"))
def daily_pair(spark, d):
    """Days that both coverages have within a span of time: the earliest to the latest start, as requests ask for."""
    at = F.col("day").between(F.lit("1996-03-01").cast("date"), F.lit("1997-02-28").cast("date"))
    diff = align.subtract(_both(spark, d, WORLD, F.to_date("t").alias("day")).filter(at)).withColumnRenamed("value", "d")
    return _stats(stats.difference_stats(diff, "day")).withColumn("day", F.col("day").cast("string"))
