"""Coordinates, tiles, UTM rasters, raster files and requests."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import geo, values
from ..functions.times import line_stamp
from ..operators import coords, regrid, subset, tiles
from ..operators.swath import pixels
from ..sources import rasters
from ..streaming.ingest import work_folder
from .expressions import SLAT, SLON, _at, _on_lines, utm_sql
from .ingest import STAMP, _show
from .inputs import HAVERSINE, SAMPLES, SWATH, cells, r6, samples, swath, table
from .registry import query


def _lines_sql(columns: str) -> str:
    return f"SELECT l_orderkey, l_linenumber, {columns} FROM (SELECT *, {SLAT} AS lat, {SLON} AS lon FROM lineitem)"


@query("SELECT n_nationkey // 5 AS row, n_nationkey % 5 AS col, CAST(n_nationkey AS DOUBLE) AS value, n_nationkey * 1.7e0 - 20 AS lat, n_nationkey * 2.0e0 AS lon FROM nation")
def swath_coords(spark, d):
    k = F.col("n_nationkey")
    band = lambda c: table(spark, d, "nation").select(F.floor(k / 5).alias("row"), (k % 5).alias("col"), c.cast("double").alias("value"))
    return coords.swath_coords(band(k), band(k * F.lit(1.7) - 20), band(k * 2))


@query("SELECT CAST(o_orderkey % 360 - 180 AS DOUBLE) AS lon, CAST(o_orderkey % 90 AS DOUBLE) AS lat, CAST(o_custkey AS DOUBLE) AS x, CAST(o_orderkey AS DOUBLE) AS y FROM orders")
def pts_coords(spark, d):
    k = F.col("o_orderkey")
    text = F.concat_ws(" ", (k % 360 - 180).cast("string"), (k % 90).cast("string"), F.col("o_custkey").cast("string"), k.cast("string"))
    lines = table(spark, d, "orders").select(F.lit("f").alias("file"), F.explode(F.array(F.lit("; map (x,y), image (x,y)"), text)).alias("line"))
    return coords.control_points(lines).drop("file")


@query("SELECT event_id, CAST(CASE WHEN event_id % 500 - 250 < -180 THEN event_id % 500 + 110 WHEN event_id % 500 - 250 > 180 THEN event_id % 500 - 610 ELSE event_id % 500 - 250 END AS DOUBLE) AS lon FROM events")
def dateline_shift(spark, d):
    return coords.dateline_shift(table(spark, d, "events").select("event_id", (F.col("event_id") % 500 - 250).cast("double").alias("lon")))


@query(_lines_sql("round(10 + l_linenumber * 0.5e0 + l_suppkey * 0.1e0, 6) AS x, round(60 + l_linenumber * 0.2e0 - l_suppkey * 0.5e0, 6) AS y, CAST(l_linenumber AS DOUBLE) AS col, CAST(l_suppkey AS DOUBLE) AS row"))
def affine_coords(spark, d):
    """Pixels to places, and back."""
    transform = F.array(*map(F.lit, (10.0, 0.5, 0.1, 60.0, 0.2, -0.5)))
    x, y = coords.affine_forward(F.col("l_linenumber").cast("double"), F.col("l_suppkey").cast("double"), transform)
    col, row = coords.affine_inverse(x, y, transform)
    return _on_lines(spark, d, x=r6(x), y=r6(y), col=col, row=row)


@query("""SELECT s_suppkey, CAST(r AS INT) AS dst_row, CAST(c AS INT) AS dst_col, s_suppkey % 140 - 60 - 0.5e0 * r AS lat, s_suppkey * 7 % 300 - 150 + 0.5e0 * c AS lon
FROM (SELECT *, unnest(range(s_suppkey % 4 + 1)) AS r FROM supplier), range(s_suppkey % 7 + 2) t(c)""")
def regrid_bbox_px(spark, d):
    """A grid of so many columns and rows for each supplier, from extents as text."""
    k = F.col("s_suppkey")
    columns, rows = coords.extent_pixels(F.concat((k % 7 + 2).cast("string"), F.lit("x"), (k % 4 + 1).cast("string")))
    grids = table(spark, d, "supplier").select(k, (k % 140 - 60).cast("double").alias("north"), (k * 7 % 300 - 150).cast("double").alias("west"), columns.alias("columns"), rows.alias("rows"), F.lit(0.5).alias("step"))
    return pixels(grids, ["s_suppkey"])


@query(_lines_sql("'t_' || printf('%06.2f', lat / 4) || '_' || printf('%07.2f', lon / 4) || '.tif' AS name"))
def tile_names(spark, d):
    lat, lon = _at()
    return _on_lines(spark, d, name=tiles.place_name(lat / 4, lon / 4, 2, "t_", ".tif"))


@query("SELECT event_id, 't' || strftime(ts, '%Y%m%d_%H%M%S') || '_' || printf('%07d', user_id) AS name FROM events")
def tile_zone_names(spark, d):
    return table(spark, d, "events").select("event_id", tiles.zone_name(F.col("ts"), F.col("user_id"), "t").alias("name"))


_QUARTER = "CAST(trunc(CAST(trunc({} / 7 * 100) AS INT) / 25.0e0) AS INT) * 25 / 100e0"


@query(
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN y >= 0 THEN '+' || printf('%05.2f', y) ELSE printf('%06.2f', y) END || '/' || CASE WHEN x >= 0 THEN '+' || printf('%06.2f', x) ELSE printf('%07.2f', x) END
  || '/' || strftime(l_shipdate, '%Y') AS folder FROM (SELECT *, {_QUARTER.format(SLAT)} AS y, {_QUARTER.format(SLON)} AS x FROM lineitem)"""
)
def tile_tree(spark, d):
    lat, lon = _at()
    return _on_lines(spark, d, folder=tiles.tree_folder(lat / 7, lon / 7, F.col("l_shipdate")))


@query(
    f"""WITH {SWATH}, tg AS (SELECT i // 4 AS tile_row, i % 4 AS tile_col, 20e0 - (i // 4) * 10 AS lat, -15e0 + (i % 4) * 10 AS lon FROM range(0, 16) t(i)),
n AS (SELECT tile_row, tile_col, src_row, row_number() OVER (PARTITION BY tile_row, tile_col ORDER BY {HAVERSINE}, src_row DESC, src_col DESC) AS nth FROM tg, (SELECT src_row, src_col, lat AS slat, lon AS slon FROM swath))
SELECT CAST(tile_row AS INT) AS tile_row, CAST(tile_col AS INT) AS tile_col, {STAMP.format("TIMESTAMP '2015-06-01 23:50:00' + to_seconds(CAST(floor(src_row * 1201 / 5e0 + 0.5) AS INT))")} AS t FROM n WHERE nth = 1"""
)
def tile_time(spark, d):
    """A pass over midnight."""
    grid = regrid.target_grid(spark, 20.0, -15.0, 4, 4, 10.0).withColumnsRenamed({"dst_row": "tile_row", "dst_col": "tile_col"})
    return tiles.tile_times(grid, swath(spark, d), "2015-06-01 23:50:00", "2015-06-02 00:10:01", 5).select("tile_row", "tile_col", _show("t").alias("t"))


@query(
    f"""WITH r AS (SELECT *, CAST(floor(north / 100000) AS BIGINT) AS row, CAST(floor(east / 100000) AS BIGINT) AS col FROM ({utm_sql(f"SELECT lat, lon, max(value) AS value FROM (SELECT {SLAT} AS lat, {SLON} AS lon, l_quantity AS value FROM lineitem) GROUP BY lat, lon")})),
n AS (SELECT *, row_number() OVER (PARTITION BY zone, row, col ORDER BY round(power(east - (col + 0.5e0) * 100000, 2) + power(north - (row + 0.5e0) * 100000, 2), 3), lat, lon) AS nth FROM r)
SELECT zone, row, col, value FROM n WHERE nth = 1"""
)
def utm_output(spark, d):
    """A raster per UTM zone, of the greatest power of ten below the points' spacing."""
    lat, lon = _at()
    points = table(spark, d, "lineitem").groupBy(lat.alias("lat"), lon.alias("lon")).agg(F.max("l_quantity").alias("value"))
    return tiles.utm_raster(points, tiles.utm_step(111_195.0))


_BANDS = "CASE " + " ".join(f"WHEN lat >= {s} THEN '{b}'" for b, s in reversed(geo.SOUTH_BANDS + geo.NORTH_BANDS)) + " END"


@query(
    f"""WITH t AS (SELECT l_linenumber AS zone, floor((l_partkey % 700 + 100) * 1000 / 100000e0) * 100000 AS west, floor((l_suppkey % 900) * 1000 / 100000e0) * 100000 AS south, min(l_suppkey % 80) AS lat, count(*) AS n,
  count(*) FILTER (WHERE l_quantity = 1) AS n_blank, round(avg(CASE WHEN l_quantity <> 1 THEN l_quantity END), 6) AS value FROM lineitem GROUP BY ALL)
SELECT printf('%02d', zone) || {_BANDS} || substr('{geo.COLUMN_LETTERS}', CAST(8 * ((zone - 1) % 3) + west // 100000 AS INT), 1) || substr('{geo.ROW_LETTERS}', CAST((1 + 5 * ((zone - 1) % 2) + south // 100000) % 20 + 1 AS INT), 1) AS name,
  n, n_blank, value FROM t WHERE n_blank < n"""
)
def mgrs_tiles(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_linenumber").alias("zone"), (F.col("l_suppkey") % 80).alias("lat"), ((F.col("l_partkey") % 700 + 100) * 1000.0).alias("easting"), ((F.col("l_suppkey") % 900) * 1000.0).alias("northing"), F.col("l_quantity").alias("value")
    )
    return tiles.military_tiles(rows, 1000.0, 1.0).select("name", "n", "n_blank", r6("value").alias("value"))


_ASKED = utm_sql("SELECT DISTINCT lat, lon FROM samples WHERE lon BETWEEN 6 AND 12")


@query(f"""WITH {SAMPLES}, u AS ({_ASKED}), a AS (SELECT coverage_id, lon AS x, lat AS y, value FROM samples WHERE (coverage_id = 'A' AND lon BETWEEN -20 AND 40 AND lat BETWEEN 10 AND 60) OR (coverage_id = 'R' AND lon BETWEEN 100 AND 170.5)
UNION ALL SELECT coverage_id, east, north, value FROM samples JOIN u USING (lat, lon) WHERE coverage_id = 'N' AND lon BETWEEN 6 AND 11.9 AND lat BETWEEN -30 AND 60)
SELECT coverage_id, count(*) AS n, round(sum(value), 4) AS s, round(avg(x), 4) AS x, round(avg(y), 4) AS y FROM a GROUP BY ALL""")
def wcs_get_coverage_xml(spark, d):
    """Three requests as XML texts, one of which limits longitudes only and one asks for UTM."""
    texts = [
        subset.coverage_request("A", -20.0, 40.0, 10.0, 60.0), subset.coverage_request("R", 100.0, 170.5, -90.0, 90.0).replace("<wcs:TrimLow>-90.0</wcs:TrimLow>", ""),
        subset.coverage_request("N", 6.0, 11.9, -30.0, 60.0, output_crs="http://www.opengis.net/def/crs/EPSG/0/32632"),
    ]
    requests = subset.parse_requests(spark.createDataFrame([(t,) for t in texts], "xml string"))
    got = subset.answer_requests(samples(spark, d), requests)
    return got.groupBy("coverage_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("s"), F.round(F.avg("x"), 4).alias("x"), F.round(F.avg("y"), 4).alias("y"))


_GRIDDED = f"WITH {SAMPLES}, g AS (SELECT coverage_id, date_trunc('month', t) AS t, row, col, level_idx, avg(value) AS value FROM samples GROUP BY ALL)"


def _monthly(spark, d):
    return samples(spark, d).groupBy("coverage_id", F.date_trunc("month", "t").alias("t"), "row", "col", "level_idx").agg(F.avg("value").alias("value"))


@query(f"{_GRIDDED} SELECT coverage_id, {STAMP.format('t')} AS t, row, col, level_idx, round(value, 6) AS value FROM g")
def write_geotiff(spark, d):
    """Rasters written by coverage and day, one band per level, and read again."""
    path = f"{work_folder(spark)}/raster-{uuid.uuid4().hex}"
    rasters.write_raster(_monthly(spark, d), path)
    return rasters.read_raster(spark, path).select("coverage_id", _show("t").alias("t"), "row", "col", "level_idx", r6("value").alias("value"))


@query(f"{_GRIDDED} SELECT coverage_id, 'unit ' || coverage_id AS measurement_unit, strftime(min(t), '%Y-%m-%d') AS start_date, strftime(max(t), '%Y-%m-%d') AS end_date, round(min(value), 6) AS min_value, round(max(value), 6) AS max_value, 'processed' AS status FROM g GROUP BY coverage_id")
def upload_collection(spark, d):
    path = f"{work_folder(spark)}/collection-{uuid.uuid4().hex}"
    known = spark.createDataFrame([(c, f"unit {c}") for c in "ANR"], "coverage_id string, measurement_unit string")
    got = rasters.publish(_monthly(spark, d), path, known)
    days = {c: F.date_format(c, "yyyy-MM-dd") for c in ("start_date", "end_date")}
    return got.drop("location").withColumns(days | {c: r6(c) for c in ("min_value", "max_value")})


@query("SELECT DISTINCT CAST(c_nationkey AS INT) AS nth, 'txt' AS kind FROM customer")
def scan_collection_dir(spark, d):
    """A folder tree with a text file for each nation among other files."""
    path = f"{work_folder(spark)}/scan-{uuid.uuid4().hex}"
    rows = table(spark, d, "customer").select(F.col("c_nationkey").alias("nth"), F.col("c_name").alias("value")).repartition("nth")
    rows.write.partitionBy("nth").text(f"{path}/text")
    rows.write.partitionBy("nth").parquet(f"{path}/other")
    found = rasters.scan_collection(spark, path, "*.txt").filter("length > 0")
    return found.select(F.regexp_extract("path", r"/nth=(\d+)/", 1).cast("int").alias("nth"), F.substring_index("name", ".", -1).alias("kind"))


@query(_lines_sql("CASE " + " ".join(f"WHEN lat >= {s} THEN {s}" for b, s in reversed(geo.SOUTH_BANDS + geo.NORTH_BANDS)) + " END AS degree"))
def lat_band_degree(spark, d):
    return _on_lines(spark, d, degree=geo.band_degree(geo.lat_band(_at()[0])))


@query("SELECT l_orderkey, l_linenumber, CAST(length(rtrim(split_part(printf('%.12f', l_discount), '.', 2), '0')) AS INT) AS digits FROM lineitem")
def decimal_digits(spark, d):
    return _on_lines(spark, d, digits=values.decimal_digits(F.col("l_discount")))


@query("SELECT l_orderkey, l_linenumber, round(sqrt(power(l_suppkey - l_partkey, 2) + power(l_linenumber - l_quantity, 2)), 6) AS m FROM lineitem")
def output_meters(spark, d):
    return _on_lines(spark, d, m=r6(geo.flat_m(F.col("l_partkey"), F.col("l_quantity"), F.col("l_suppkey"), F.col("l_linenumber"))))


@query(
    f"""WITH {SWATH}, tg AS (SELECT i // 4 AS tile_row, i % 4 AS tile_col, 20e0 - (i // 4) * 10 AS lat, -15e0 + (i % 4) * 10 AS lon FROM range(0, 16) t(i)),
n AS (SELECT tile_row, tile_col, src_row * 7 + 3 AS line, row_number() OVER (PARTITION BY tile_row, tile_col ORDER BY {HAVERSINE}, src_row * 5 + src_col) AS nth FROM tg, (SELECT src_row, src_col, lat AS slat, lon AS slon FROM swath WHERE (src_row * 5 + src_col) % 3 = 0))
SELECT CAST(tile_row AS INT) AS tile_row, CAST(tile_col AS INT) AS tile_col, {STAMP.format("TIMESTAMP '2015-06-01 23:50:00' + to_seconds(CAST(floor(line * 1201 / 50e0 + 0.5) AS INT))")} AS t FROM n WHERE nth = 1"""
)
def tile_time_tags(spark, d):
    """Every third pixel is tagged with its line in a longer pass."""
    grid = regrid.target_grid(spark, 20.0, -15.0, 4, 4, 10.0).withColumnsRenamed({"dst_row": "tile_row", "dst_col": "tile_col"})
    nth = F.col("src_row") * 5 + F.col("src_col")
    tags = swath(spark, d).filter(nth % 3 == 0).select(nth.alias("nth"), (F.col("src_row") * 7 + 3).alias("line"), "src_row", "src_col")
    return tiles.tile_times(grid, swath(spark, d), "2015-06-01 23:50:00", "2015-06-02 00:10:01", 50, tags).select("tile_row", "tile_col", _show("t").alias("t"))


@query("SELECT event_id, strftime(TIMESTAMP '2015-12-31 23:50:00' + to_seconds(CAST(floor((event_id % 200) * 1203 / 200e0 + 0.5) AS INT)), '%Y%m%d_%H%M%S') AS dated, strftime(TIMESTAMP '2015-12-31 23:50:00' + to_seconds(CAST(floor((event_id % 200) * 1203 / 200e0 + 0.5) AS INT)), '%H%M%S') AS clock FROM events")
def line_stamps(spark, d):
    """Times of lines as texts, of a pass over the turn of the year."""
    line = F.col("event_id") % 200
    return table(spark, d, "events").select("event_id", line_stamp(F.lit("2015:12:31:23:50:00"), F.lit("2016:01:01:00:10:03"), line, F.lit(200)).alias("dated"), line_stamp(F.lit("23:50:00"), F.lit("00:10:03"), line, F.lit(200)).alias("clock"))


_POINTS = """q AS (SELECT event_id % 3 AS kind, event_id // 288 * 3 + event_id % 3 AS file, event_id % 288 // 3 AS n FROM events), s AS (SELECT *, [1, 5, 10][kind + 1] AS sp FROM q),
pt AS (SELECT file, sp, n // 12 * sp AS row, n % 12 * sp AS col FROM s), pts AS (SELECT *, radians(40 + row * 0.02e0) AS la, radians(179.2e0 + col * 0.03e0) AS lo FROM pt),
sz AS (SELECT DISTINCT file, sp, 7 * sp + 1 AS h, 11 * sp + 1 AS w FROM pt), px AS (SELECT file, sp, r, c FROM (SELECT *, unnest(range(h)) AS r FROM sz), range(111) t(c) WHERE c < w),
m AS (SELECT px.file, r, c, la, lo, sqrt(power(row - r, 2) + power(col - c, 2)) AS d FROM px LEFT JOIN pts ON pts.file = px.file AND row BETWEEN r - (px.sp - 1) AND r + px.sp - 1 AND col BETWEEN c - (px.sp - 1) AND c + px.sp - 1),
t AS (SELECT *, count(la) OVER w AS n, sum(d) OVER w AS t FROM m WINDOW w AS (PARTITION BY file, r, c)), v AS (SELECT *, CASE WHEN n = 1 THEN 1 ELSE (1 - d / t) / (n - 1) END AS g FROM t),
x AS (SELECT file, r, c, sum(g * cos(la) * cos(lo)) AS x, sum(g * cos(la) * sin(lo)) AS y, sum(g * sin(la)) AS z FROM v GROUP BY ALL)"""


@query(f"WITH {_POINTS} SELECT file, CAST(r AS INT) AS row, CAST(c AS INT) AS col, round(degrees(atan2(z, sqrt(x * x + y * y))), 6) AS lat, round(degrees(atan2(y, x)), 6) AS lon FROM x")
def gcp_coords(spark, d):
    """Grids whose control points stand 1, 5 or 10 pixels apart and cross the date line: the place of every pixel."""
    k = F.col("event_id")
    rows = table(spark, d, "events").select((F.floor(k / 288) * 3 + k % 3).alias("file"), F.get(F.array(*map(F.lit, (1, 5, 10))), (k % 3).cast("int")).alias("sp"), F.floor(k % 288 / 3).alias("n"))
    row, col, lon = (F.floor(F.col("n") / 12) * F.col("sp")).cast("int"), (F.col("n") % 12 * F.col("sp")).cast("int"), F.col("col") * values.num(0.03) + values.num(179.2)
    points = rows.select("file", "sp", row.alias("row"), col.alias("col")).withColumns({"lat": F.col("row") * values.num(0.02) + 40, "lon": F.when(lon > 180, lon - 360).otherwise(lon)})
    sizes = rows.select("file", (7 * F.col("sp") + 1).alias("rows"), (11 * F.col("sp") + 1).alias("columns")).distinct()
    return coords.densify(points, sizes, ["file"]).withColumns({"lat": r6("lat"), "lon": r6("lon")})
