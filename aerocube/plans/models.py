"""Model and curtain readers as a whole, over `events` and `nation`."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import num
from ..operators import nearest, regrid
from ..sources import curtains, models
from .ingest import STAMP, _show
from .inputs import HAVERSINE, SWATH, r6, swath, table
from .registry import query

_LAYERS = """c AS (SELECT event_id // 2000 AS file, event_id % 5 AS l, event_id // 5 % 20 AS col, event_id // 100 % 20 AS row, event_id % 5 * 20 + 1 AS ap, event_id % 5 * 0.2e0 AS bp, 1000 + event_id // 5 % 50 AS p0, 200 + value / 10 AS t, event_id // 5 % 30 * 10e0 AS z, value FROM events),
p AS (SELECT *, (ap + lead(ap) OVER w) * 0.5e0 + (bp + lead(bp) OVER w) * 0.5e0 * p0 AS p FROM c WINDOW w AS (PARTITION BY file, row, col ORDER BY l)), m AS (SELECT * FROM p WHERE p IS NOT NULL)"""


def _stratosphere(spark, d):
    k = F.col("event_id")
    cells = table(spark, d, "events").select(
        F.floor(k / 2000).alias("file"), (num(5000.25) + F.floor(k / 2000)).alias("days"), (k % 5).alias("level_idx"), (F.floor(k / 100) % 20).cast("int").alias("row"), (F.floor(k / 5) % 20).cast("int").alias("col"), (k % 5 * 20 + 1).cast("double").alias("ap"),
        (k % 5 * num(0.2)).alias("bp"), (F.floor(k / 5) % 50 + 1000).cast("double").alias("p0"), (200 + F.col("value") / 10).alias("temperature"), (F.floor(k / 5) % 30 * num(10)).alias("z"), "value",
    )
    return models.stratosphere_analysis(cells, 4, 20, 20)


@query(f"""WITH {_LAYERS} SELECT file, {STAMP.format("TIMESTAMP '2000-01-01' + to_hours(CAST(24 * (5000 + file) + 6 AS INT))")} AS t, CAST(4 - l AS INT) AS band, CAST(19 - row AS INT) AS row, CAST(19 - col AS INT) AS col, round(value, 6) AS value FROM m""")
def read_bascoe_bands(spark, d):
    return _stratosphere(spark, d)[0].select("file", _show("t").alias("t"), "band", "row", "col", r6("value").alias("value"))


@query(f"""WITH {_LAYERS}, s AS (SELECT *, lag(t) OVER w AS t2, lag(p) OVER w AS p2 FROM m WINDOW w AS (PARTITION BY file, row, col ORDER BY l DESC)),
h AS (SELECT *, sum(CASE WHEN t2 IS NULL THEN z / 9.80665e0 + t * ln(p0 / p) * 287.053e0 / 9.80665e0 ELSE 0.5e0 * (t2 + t) * ln(p2 / p) * 287.053e0 / 9.80665e0 END) OVER (PARTITION BY file, row, col ORDER BY l DESC) AS h FROM s)
SELECT file, CAST(4 - l AS INT) AS band, round(avg(h), 3) AS height FROM h GROUP BY ALL""")
def read_bascoe_heights(spark, d):
    return _stratosphere(spark, d)[1].select("file", "band", F.round("height", 3).alias("height"))


@query(f"""SELECT {STAMP.format("TIMESTAMP '2015-06-01' + to_hours(CAST(event_id // 1000 AS INT))")} AS t, CAST(event_id // 250 % 4 + 1 AS INT) AS band, CAST(9 - event_id // 25 % 10 AS INT) AS row, CAST(event_id % 25 AS INT) AS col, round(value * 3.2e0, 6) AS value FROM events""")
def read_flexpart_bands(spark, d):
    k = F.col("event_id")
    start = F.unix_seconds(F.lit("2015-06-01").cast("timestamp"))
    date = F.date_format(F.timestamp_seconds(start + F.floor(k / 1000) * 3600), "yyyyMMddHHmmss")
    cells = table(spark, d, "events").select(date.alias("date"), (k % 25).alias("x"), (F.floor(k / 25) % 10).alias("y"), (F.floor(k / 250) % 4).alias("level_idx"), "value")
    return models.dispersion(cells, 10).select(_show("t").alias("t"), "band", "row", "col", r6("value").alias("value"))


@query(f"""WITH {SWATH}, tg AS (SELECT i // 4 AS dst_row, i % 4 AS dst_col, 10e0 - (i // 4) * 5 AS lat, -10e0 + (i % 4) * 5 AS lon FROM range(0, 16) t(i)),
n AS (SELECT dst_row, dst_col, src_row, src_col, row_number() OVER (PARTITION BY dst_row, dst_col ORDER BY {HAVERSINE}, src_row DESC, src_col DESC) AS nth FROM tg, (SELECT src_row, src_col, lat AS slat, lon AS slon FROM swath)),
c AS (SELECT src_row, src_col, h, l, CASE WHEN (src_row + src_col + h) % 4 = 0 AND l = 1 THEN NULL ELSE value + h * 10 + l END AS value, ((l * 900 + value + h * 7e0 + l * 100e0) / 9.81e0 - value / 10) AS z FROM swath, range(3) a(h), range(3) b(l)),
z AS (SELECT h, l, greatest(avg(z), 0) AS z FROM c GROUP BY h, l), t AS (SELECT h, l, z - coalesce(lag(z) OVER (PARTITION BY h ORDER BY l), 0) AS thick FROM z),
v AS (SELECT src_row, src_col, h, CASE WHEN count(value) = 3 THEN sum(value * thick) END AS value FROM c JOIN t USING (h, l) GROUP BY ALL)
SELECT CAST(dst_row AS INT) AS dst_row, CAST(dst_col AS INT) AS dst_col, CAST(h AS INT) AS time, round(value, 4) AS value FROM n JOIN v USING (src_row, src_col) WHERE nth = 1""")
def read_wrfchem_columns(spark, d):
    """The integral over three levels for three hours, by one map."""
    s = swath(spark, d)
    mapping = nearest.nearest_pixels(regrid.target_grid(spark, 10.0, -10.0, 4, 4, 5.0), s).drop("dist_m")
    cube = s.withColumn("time", F.explode(F.array(*map(F.lit, range(3))))).withColumn("level_idx", F.explode(F.array(*map(F.lit, range(3)))))
    h, l, v = F.col("time"), F.col("level_idx"), F.col("value")
    lost = ((F.col("src_row") + F.col("src_col") + h) % 4 == 0) & (l == 1)
    cube = cube.select("time", "level_idx", "src_row", "src_col", (l * 900 + v + h * num(7)).alias("ph"), (l * num(100)).alias("phb"), (v / 10).alias("hgt"), F.when(~lost, v + h * 10 + l).alias("value"))
    return models.chemistry_column(cube, mapping).select("dst_row", "dst_col", "time", F.round("value", 4).alias("value"))


_RAYS = """r AS (SELECT event_id % 3 AS file, event_id // 3 AS ray, -60 + event_id // 3 * 0.01e0 AS lat, CASE WHEN event_id % 3 = 0 THEN CASE WHEN 175 + event_id // 3 * 0.02e0 > 180 THEN 175 + event_id // 3 * 0.02e0 - 360 ELSE 175 + event_id // 3 * 0.02e0 END ELSE event_id // 3 * 0.02e0 END AS lon, value FROM events),
k AS (SELECT *, ray - chunk * 999 AS col FROM r, range(0, 40) t(chunk) WHERE ray BETWEEN chunk * 999 AND chunk * 999 + 999), e AS (SELECT file, chunk, max(col) AS last FROM k GROUP BY ALL)"""


def _curtain(spark, d):
    """Three tracks, one of which crosses the date line; five bins, of which four stay."""
    k, ray = F.col("event_id"), F.floor(F.col("event_id") / 3)
    lon = ray * num(0.02)
    values = F.array(*[F.col("value") + b * 10 for b in range(5)])
    heights = F.array(*[num(900) - b * 300 + ray % 7 - F.when(k % 3 == 1, 20).otherwise(0) for b in range(5)])
    east = F.when(num(175) + lon > 180, num(175) + lon - 360).otherwise(num(175) + lon)
    rays = table(spark, d, "events").select((k % 3).alias("file"), ray.alias("ray"), (num(-60) + ray * num(0.01)).alias("lat"), F.when(k % 3 == 0, east).otherwise(lon).alias("lon"), values.alias("values"), heights.alias("heights"))
    return curtains.curtain(rays, 20.0, 480.0, 100.0, bins=4)


@query(f"""WITH {_RAYS}, x AS (SELECT k.*, least(col // 10 * 10 + 10, last) AS nb, col // 10 * 10 AS na FROM k JOIN e USING (file, chunk)),
y AS (SELECT x.*, a.lat AS la, a.lon AS oa, b.lat AS lb, b.lon AS ob, CASE WHEN nb > na THEN (x.col - na) / CAST(nb - na AS DOUBLE) ELSE 0 END AS share FROM x JOIN k a ON a.file = x.file AND a.chunk = x.chunk AND a.col = na JOIN k b ON b.file = x.file AND b.chunk = x.chunk AND b.col = nb),
w AS (SELECT *, oa + share * CASE WHEN ob - oa > 180 THEN ob - oa - 360 WHEN ob - oa < -180 THEN ob - oa + 360 ELSE ob - oa END AS o FROM y)
SELECT file, chunk, CAST(b AS INT) AS row, CAST(col AS INT) AS col, CASE WHEN value + b * 10 BETWEEN 20 AND 480 THEN round((value + b * 10) / 100, 6) END AS value, round(la + share * (lb - la), 6) AS track_lat, round(CASE WHEN o > 180 THEN o - 360 WHEN o < -180 THEN o + 360 ELSE o END, 6) AS track_lon FROM w, range(4) t(b)""")
def read_cloudsat_curtain(spark, d):
    return _curtain(spark, d)[0].withColumns({c: r6(c) for c in ("value", "track_lat", "track_lon")})


@query(f"""WITH {_RAYS}, h AS (SELECT file, chunk, b, avg(900 - b * 300 + ray % 7 - CASE WHEN file = 1 THEN 20 ELSE 0 END) AS h FROM k, range(4) t(b) GROUP BY ALL)
SELECT file, chunk, last + 1 AS columns, last // 10 + 1 + CASE WHEN last % 10 > 0 THEN 1 ELSE 0 END AS n_nodes, (SELECT count(*) FROM h WHERE h.file = e.file AND h.chunk = e.chunk AND h >= 0) AS n_levels, (SELECT round(min(h), 4) FROM h WHERE h.file = e.file AND h.chunk = e.chunk AND h >= 0) AS lowest FROM e""")
def read_cloudsat_chunks(spark, d):
    return _curtain(spark, d)[1].select("file", "chunk", F.col("columns").cast("long").alias("columns"), F.size("nodes").cast("long").alias("n_nodes"), F.size("levels").cast("long").alias("n_levels"), F.round(F.get("levels", F.lit(0)), 4).alias("lowest"))
