"""Swath formats up to their rasters: one large file and sixty small ones over `events`, some across the date line."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import num
from ..sources import swaths
from .inputs import HAVERSINE, r6, table
from .registry import query

#: Events as swath samples: file f, number n in the file, four samples a line with a gap in the middle.
_SAMPLES = """m AS (SELECT event_id AS k, value, event_id // 5 * 3 + event_id % 5 - 2 AS m FROM events),
p AS (SELECT k, value, CASE WHEN k % 5 < 2 THEN 0 ELSE 1 + m % 60 END AS f, CASE WHEN k % 5 < 2 THEN k // 5 * 2 + k % 5 ELSE m // 60 END AS n FROM m),
q AS (SELECT *, n // 4 AS line, n % 4 AS sample, (f * 37 % 130) - 65e0 + (n // 4 % 200) * 0.012e0 + (n % 4) * 0.03e0 + (k * 7919 % 997) * 0.00001e0 AS lat,
  CASE WHEN f % 20 = 19 THEN 178e0 ELSE (f * 53 % 340) - 170e0 END + (n % 4) * 0.31e0 + CASE WHEN n % 4 >= 2 THEN 1.9e0 ELSE 0e0 END + (n // 4 % 7) * 0.04e0 + (k * 7919 % 997) * 0.00001e0 AS lon0 FROM p),
places AS (SELECT *, CASE WHEN lon0 > 180 THEN lon0 - 360 ELSE lon0 END AS lon FROM q)"""


def _samples(spark, d):
    k = F.col("event_id")
    m = F.floor(k / 5) * 3 + k % 5 - 2
    big = k % 5 < 2
    rows = table(spark, d, "events").select(k.alias("k"), "value", F.when(big, 0).otherwise(1 + m % 60).alias("f"), F.when(big, F.floor(k / 5) * 2 + k % 5).otherwise(F.floor(m / 60)).alias("n"))
    n, f, jitter = F.col("n"), F.col("f"), (F.col("k") * 7919 % 997) * num(0.00001)
    line, sample = F.floor(n / 4), n % 4
    lat = (f * 37 % 130) - num(65) + (line % 200) * num(0.012) + sample * num(0.03) + jitter
    lon = F.when(f % 20 == 19, num(178)).otherwise((f * 53 % 340) - num(170)) + sample * num(0.31) + F.when(sample >= 2, num(1.9)).otherwise(num(0)) + (line % 7) * num(0.04) + jitter
    return rows.withColumns({"line": line, "sample": sample, "lat": lat, "lon": F.when(lon > 180, lon - 360).otherwise(lon)})


def _nearest(keys: str, step: str, reach: str) -> str:
    """From s (keys, src_row, src_col, slat, slon, ...): grids g, their pixels px, and n with each pixel's nearest source."""
    on = " AND ".join(f"px.{c.strip()} = s.{c.strip()}" for c in keys.split(","))
    own = ", ".join(f"px.{c.strip()}" for c in keys.split(","))
    return f"""g AS (SELECT {keys}, max(slat) AS north, min(slon) AS west, {step} AS step, CAST(trunc((max(slat) - min(slat)) / ({step})) AS INT) AS h, CAST(trunc((max(slon) - min(slon)) / ({step})) AS INT) AS w FROM s GROUP BY {keys}),
px AS (SELECT *, north - step * dst_row AS lat, west + step * dst_col AS lon FROM (SELECT *, CAST(unnest(range(w)) AS INT) AS dst_col FROM (SELECT *, CAST(unnest(range(h)) AS INT) AS dst_row FROM g))),
d AS (SELECT {own}, dst_row, dst_col, {reach} AS reach, {HAVERSINE} AS dist, s.* EXCLUDE ({keys}) FROM px JOIN s ON {on}),
n AS (SELECT *, dist < reach AS near FROM d QUALIFY row_number() OVER (PARTITION BY {keys}, dst_row, dst_col ORDER BY dist, src_row DESC, src_col DESC) = 1)"""


def _source(missing: str, select: str, where: str = "") -> str:
    return f"WITH {_SAMPLES}, c AS (SELECT *, CASE WHEN {missing} THEN NULL ELSE value END AS v FROM places), s AS (SELECT {select} FROM c {where})"


@query(f"""{_source("k % 97 = 0", "CAST(f AS VARCHAR) AS file, CAST(line // 200 AS INT) AS slice, line AS src_row, sample AS src_col, lat AS slat, lon AS slon, v * 0.5e0 AS value",
  "WHERE NOT EXISTS (SELECT 1 FROM places b WHERE b.k % 997 = 0 AND b.f = c.f AND b.line // 200 = c.line // 200 AND b.sample = c.sample)")},
{_nearest("file, slice", "0.1e0", "70000")} SELECT file, slice, dst_row, dst_col, CASE WHEN near THEN round(value, 6) END AS value FROM n""")  # fmt: skip
def read_aura_l2_rasters(spark, d):
    rows = _samples(spark, d)
    cells = rows.select(F.col("f").cast("string").alias("file"), "line", "sample", F.when(F.col("k") % 997 == 0, -999.0).otherwise(F.col("lat")).alias("lat"), "lon", F.col("line").cast("double").alias("seconds"), F.when(F.col("k") % 97 == 0, -1.0).otherwise(F.col("value")).alias("value"))
    return swaths.monitor_rasters(cells, -1.0, 0.5, -999.0).withColumn("value", r6("value"))


_TURNED = "CASE WHEN CASE WHEN lon < 0 THEN lon + 360 ELSE lon END >= 180 THEN CASE WHEN lon < 0 THEN lon + 360 ELSE lon END - 360 ELSE CASE WHEN lon < 0 THEN lon + 360 ELSE lon END END"


@query(f"""{_source("k % 97 = 0", f"CAST(f AS VARCHAR) AS file, n // 1500 AS slice, 0 AS src_row, n AS src_col, lat AS slat, {_TURNED} AS slon, v AS value")},
{_nearest("file, slice", "0.25e0", "80000")} SELECT file, slice, dst_row, dst_col, CASE WHEN near THEN round(value, 6) END AS value FROM n""")
def read_gome_l2_rasters(spark, d):
    rows, lon = _samples(spark, d), F.col("lon")
    samples = rows.select(F.col("f").cast("string").alias("file"), F.col("n").alias("nth"), "lat", F.when(lon < 0, lon + 360).otherwise(lon).alias("lon"), F.lit(20_000).alias("day"), (F.col("n") * 100).alias("ms"), F.when(F.col("k") % 97 == 0, -9999.0).otherwise(F.col("value")).alias("value"))
    return swaths.column_rasters(samples, -9999.0).withColumn("value", r6("value"))


_KERNEL = f"""{_source("k % 97 = 0", "f AS file, n // CASE WHEN f % 2 = 0 THEN 1500 ELSE 4000 END AS slice, 0 AS src_row, n AS src_col, lat AS slat, lon AS slon, v AS value, value AS raw")},
{_nearest("file, slice", "CASE WHEN file % 2 = 0 THEN 0.25e0 ELSE 0.1e0 END", "CASE WHEN px.file % 2 = 0 THEN 60000 ELSE 50000 END")}"""


def _kernel(spark, d):
    f = F.col("f")
    file = F.concat(F.when(f % 2 == 0, "GOME2B").otherwise("OMI"), F.lit("-SO2-"), f.cast("string"), F.lit("-20150603_v1.h5"))
    heights, kernel = F.array(*[num(x) + f * num(0.01) for x in (1.5, 3.0, 5.5)]), F.array(*[F.col("value") * num(0.5) + i for i in range(3)])
    samples = _samples(spark, d).select(file.alias("file"), F.col("n").alias("nth"), F.lit(101_500_000).alias("clock"), "lat", "lon", F.when(F.col("k") % 97 == 0, -9999.0).otherwise(F.col("value")).alias("value"), heights.alias("heights"), kernel.alias("kernel"))
    return swaths.kernel_rasters(samples)


@query(f"{_KERNEL} SELECT file, slice, dst_row, dst_col, CASE WHEN near THEN round(value, 6) END AS value FROM n")
def read_bira_rasters(spark, d):
    return _kernel(spark, d)[0].select(F.get(F.split("file", "-"), F.lit(2)).cast("long").alias("file"), F.col("slice").cast("long").alias("slice"), "dst_row", "dst_col", r6("value").alias("value"))


@query(f"""{_KERNEL}, l(level_idx, base) AS (VALUES (0, 1.5e0), (1, 3e0), (2, 5.5e0)) SELECT file, slice, dst_row, dst_col, level_idx, round((base + file * 0.01e0) * 1000, 6) AS height, round(raw * 0.5e0 + level_idx, 6) AS value
FROM n, l WHERE near AND value IS NOT NULL""")
def read_bira_kernels(spark, d):
    got = _kernel(spark, d)[1]
    return got.select(F.get(F.split("file", "-"), F.lit(2)).cast("long").alias("file"), F.col("slice").cast("long").alias("slice"), "dst_row", "dst_col", "level_idx", r6("height").alias("height"), r6("value").alias("value"))


@query(f"""{_source("k % 97 = 0", "f AS file, line AS src_row, sample AS src_col, lat, lon, 0.001e0 * (v - 7) AS value", "WHERE f % 10 <> 7").replace("s AS (SELECT f", "s0 AS (SELECT f")},
s1 AS (SELECT *, lead(lat) OVER w AS slat, lead(lon) OVER w AS slon FROM s0 WINDOW w AS (PARTITION BY file, src_row ORDER BY src_col)), s2 AS (SELECT *, {HAVERSINE} AS own FROM s1),
s3 AS (SELECT *, coalesce(own, lag(own) OVER (PARTITION BY file, src_row ORDER BY src_col)) AS gap, avg(own) OVER (PARTITION BY file) AS mean FROM s2),
s AS (SELECT file, src_row, src_col, lat AS slat, lon AS slon, value, CASE WHEN gap < mean THEN 2 * mean ELSE gap END AS threshold FROM s3),
{_nearest("file", "0.05e0", "threshold")} SELECT file, dst_row, dst_col, CASE WHEN near THEN round(value, 6) END AS value FROM n""")
def read_mod04_rasters(spark, d):
    f, n = F.col("f"), F.col("n")
    name = F.concat(F.lit("MOD04_L2.A2015"), F.lpad((f + 1).cast("string"), 3, "0"), F.lit(".1205."), f.cast("string"))
    cells = _samples(spark, d).select(name.alias("file"), F.col("line").alias("row"), F.col("sample").alias("col"), F.when((f % 10 == 7) & (n == 3), -999.0).otherwise(F.col("lat")).alias("lat"), "lon", F.when(F.col("k") % 97 == 0, -9999.0).otherwise(F.col("value")).alias("value"))
    return swaths.depth_rasters(cells, 0.001, 7.0).withColumns({"file": F.get(F.split("file", r"\."), F.lit(3)).cast("long"), "value": r6("value")})


@query(f"""{_source("k % 97 = 0", "CAST(f AS VARCHAR) AS file, 0 AS src_row, n AS src_col, lat AS slat, lon + 180 - 180 AS slon, v, value AS raw, k")}, {_nearest("file", "0.5e0", "100000")}
SELECT file, dst_row, dst_col, CAST(level_idx AS INT) AS level_idx, CASE WHEN level_idx = 0 OR k % 89 <> 0 THEN round(raw + level_idx, 6) END AS value FROM n, range(3) l(level_idx) WHERE near AND v IS NOT NULL""")
def read_osiris_rasters(spark, d):
    levels = _samples(spark, d).withColumn("level_idx", F.explode(F.array(*map(F.lit, range(3)))))
    lost = F.when(F.col("level_idx") == 0, F.col("k") % 97 == 0).otherwise(F.col("k") % 89 == 0)
    cells = levels.select(F.col("f").cast("string").alias("file"), F.col("n").alias("nth"), "level_idx", "lat", (F.col("lon") + 180).alias("lon"), F.when(lost, -9999.0).otherwise(F.col("value") + F.col("level_idx")).alias("value"))
    return swaths.limb_rasters(cells, -9999.0).withColumn("value", r6("value"))


@query(f"""{_source("k % 97 = 0", "f AS file, line AS src_row, sample AS src_col, lat AS slat, lon AS slon, v AS value, k % 100 / 100e0 AS quality", "WHERE sample < CASE WHEN f % 7 = 3 THEN 2 ELSE 3 END")},
{_nearest("file", "0.1e0", "60000")} SELECT file, dst_row, dst_col, CASE WHEN near THEN round(value, 6) END AS value, CASE WHEN near AND value IS NOT NULL THEN round(quality, 6) END AS quality FROM n""")
def read_sentinel_rasters(spark, d):
    f, sample = F.col("f"), F.col("sample")
    cells = _samples(spark, d).select(
        F.concat(F.lit("S5P_NRTI_L2__SO2____20180807T224727_20180807T234211_"), f.cast("string"), F.lit("_01.nc")).alias("file"), "line", "sample", F.when((f % 7 == 3) & (sample >= 2), -9.0).otherwise(F.col("lat")).alias("lat"), "lon",
        F.when(F.col("k") % 97 == 0, -1.0).otherwise(F.col("value")).alias("value"), (F.col("k") % 100 / num(100)).alias("quality"),
    )
    got = swaths.sulphur_rasters(cells, -1.0, -9.0)
    return got.select(F.get(F.split("file", "_"), F.lit(10)).cast("long").alias("file"), "dst_row", "dst_col", r6("value").alias("value"), r6("quality").alias("quality"))
