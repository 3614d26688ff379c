"""Loads, readers, identification and streams, on files made from the star schema's rows."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ground
from ..sources import ground as readers
from ..sources import identify, records
from ..streaming import ingest as streams
from . import fixtures
from .inputs import MEASUREMENTS, STATIONS, measurements, r6, stations, table
from .registry import query

STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _show(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _keyed(spark, d):
    m = measurements(spark, d)
    return m.select("id", F.col("stations_id").alias("station"), "product", "value", F.col("t").alias("t_start"), F.col("t").alias("t_end"))


@query(f"WITH {MEASUREMENTS} SELECT min(id) AS id FROM measurements WHERE id % 3 <> 0 GROUP BY stations_id, product, value, t HAVING count(*) > 0")
def duplicate_antijoin(spark, d):
    """All rows arrive, one twice, where every third is stored already."""
    m = _keyed(spark, d)
    got = ground.new_measurements(m.unionByName(m.filter("id % 5 = 0")), m.filter("id % 3 = 0"))
    return got.select("id")


@query("SELECT p_brand AS name, row_number() OVER (ORDER BY substr(md5(p_brand), 1, 3), p_brand) + 100 AS id FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand <> 'Brand#1' AND p_brand NOT LIKE '%3%')")
def dim_antijoin(spark, d):
    brands = table(spark, d, "part").select(F.col("p_brand").alias("name"))
    known = brands.filter("name = 'Brand#1' or name like '%3%'").distinct().withColumn("id", F.lit(1))
    return ground.new_dimension_rows(brands, known, "name", 100).select("name", F.col("id").cast("long").alias("id"))


@query(f"WITH {STATIONS} SELECT name, CASE WHEN id % 2 = 0 OR id >= 20 THEN id + 1000 ELSE id END AS id, CASE WHEN id % 2 = 0 OR id >= 20 THEN height + 1 ELSE height END AS height FROM stations")
def upsert_station(spark, d):
    s = stations(spark, d).select("name", "id", "height")
    incoming = s.filter("id % 2 = 0 or id >= 20").select("name", (F.col("id") + 1000).alias("id"), (F.col("height") + 1).alias("height"))
    return ground.upsert_stations(s.filter("id < 20"), incoming)


@query(f"WITH {STATIONS} SELECT o_orderkey, name FROM orders JOIN stations ON o_orderkey % 25 = id")
def station_code_lookup(spark, d):
    known = stations(spark, d).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("station_code"), "name")
    rows = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("S"), (F.col("o_orderkey") % 25).cast("string")).alias("station_code"))
    return ground.station_lookup(rows, known).select("o_orderkey", "name")


def _eea_lines(spark, d):
    value = F.when(F.col("event_id") % 97 != 0, F.col("value")).otherwise(-1.0)
    text = F.concat(F.date_format("ts", "yyyyMMdd HHmmss"), F.lit("  "), value.cast("string"))
    return table(spark, d, "events").select(F.concat(F.lit("STATION"), F.lpad((F.col("user_id") % 25).cast("string"), 2, "0"), F.lit("_x.txt")).alias("name"), text.alias("line"))


@query(f"SELECT 'STATION' || lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS station_code, {STAMP.format('ts')} AS t, CASE WHEN event_id % 97 <> 0 THEN round(value, 6) END AS value FROM events")
def read_eea(spark, d):
    return readers.parse_air_quality(_eea_lines(spark, d)).select("station_code", _show("t").alias("t"), r6("value").alias("value"))


@query(f"SELECT event_type AS station, CAST(user_id AS DOUBLE) AS longitude, {STAMP.format('ts')} AS t, round(value, 6) AS value FROM events")
def read_aeronet(spark, d):
    e = table(spark, d, "events")
    head = F.concat(F.lit("a\nb\nLocation="), F.col("event_type"), F.lit(",long="), F.col("user_id").cast("string"), F.lit(",lat=2.5,elev=7\nd\ne\n"))
    row = F.concat(F.date_format("ts", "dd:MM:yyyy,HH:mm:ss"), F.lit(",3,4,5,6,7,8,"), F.col("value").cast("string"), F.lit(",10\n"))
    got = readers.parse_aeronet(e.select(F.concat(head, row).alias("text")))
    return got.select("station", "longitude", _show("t_start").alias("t"), r6("value").alias("value"))


@query("SELECT 'C' || n_nationkey AS station_code, replace(n_name, '_', ' ') AS name, CAST(n_nationkey AS DOUBLE) AS latitude, CASE WHEN n_nationkey % 2 = 0 THEN 0 ELSE CAST(n_nationkey AS DOUBLE) * 2 END AS longitude, 5.5e0 AS height FROM nation")
def read_station_list(spark, d):
    k = F.col("n_nationkey")
    line = F.concat(F.lit("C"), k.cast("string"), F.lit(" "), F.replace("n_name", F.lit(" "), F.lit("_")), F.lit(", "), k.cast("string"), F.lit(" "), F.when(k % 2 == 0, "").otherwise((k * 2).cast("string")), F.lit(" 5.5"))
    return readers.parse_station_list(table(spark, d, "nation").select(line.alias("line")))


@query("SELECT n_name AS name, CAST(i AS BIGINT) AS profile, round(n_nationkey / 10e0, 6) AS latitude, round(CASE WHEN n_nationkey * 10 > 180 THEN n_nationkey * 10 - 360 ELSE n_nationkey * 10 END, 6) AS longitude, CAST(j * i AS DOUBLE) AS ozone_density FROM nation, (SELECT unnest(range(1, 3)) AS i), (SELECT unnest(range(1, 4)) AS j)")
def read_lidar_bira(spark, d):
    """Per nation a file of two profiles with three levels each."""
    k = F.col("n_nationkey")
    head = F.concat_ws(" ", F.lit("1 2 2015 3 4 5 6 7 8 9"), k.cast("string"), (k * 100).cast("string"), F.lit("12 13"))
    data = lambda i, j: F.lit(f"{j} {i * j} 2 3 4 5 6 {900 - 100 * j} 8 9")
    lines = F.concat(F.array_repeat(F.lit("preamble"), 41), F.array(*[x for i in (1, 2) for x in (head, *[data(i, j) for j in (1, 2, 3)])]))
    rows = table(spark, d, "nation").select(F.col("n_name").alias("name"), F.posexplode(lines).alias("nth", "line")).withColumn("nth", F.col("nth") + 1)
    return readers.parse_lidar_ozone(rows).select("name", "profile", r6("latitude").alias("latitude"), r6("longitude").alias("longitude"), "ozone_density")


@query(f"SELECT event_type AS station, {STAMP.format('ts')} AS t, event_type AS product, CASE WHEN event_id % 97 <> 0 THEN round(value, 6) END AS value FROM events")
def read_ground_xml(spark, d):
    """Written as XML, one element per station and day, and read again."""
    e = table(spark, d, "events")
    at = F.col("ts").cast("timestamp")
    rows = e.select(F.col("event_type").alias("station"), F.lit(1.0).alias("longitude"), F.lit(2.0).alias("latitude"), F.lit(3.0).alias("height"), at.alias("t_start"), at.alias("t_end"), F.col("event_type").alias("product"), F.when(F.col("event_id") % 97 != 0, F.col("value")).alias("value"))
    path = f"{streams.work_folder(spark)}/xml-{uuid.uuid4().hex}"
    readers.write_ground_xml(rows, path)
    return readers.read_ground_xml(spark, path).select("station", _show("t_start").alias("t"), "product", r6("value").alias("value"))


def _polarimeter(spark, d, land: bool):
    """Events as records, a hundred to a file; in each file those after the fiftieth begin a byte early."""
    k, big = F.col("event_id"), lambda x, n: F.unhex(F.lpad(F.hex(x), 2 * n, "0"))
    i, zeros = k % 100 + 1, lambda n: F.unhex(F.repeat(F.lit("00"), n))
    depths = [big(k * 7 % 30_000, 2), zeros(12)] if land else [zeros(10), big(k * 7 % 30_000, 2), big(k * 11 % 30_000, 2)]
    record = F.concat(big(i + 1, 4), big(F.lit(24), 2), big(k % 1000 * 3, 2), big(k % 1000 * 5, 2), *depths, F.when(i == 50, zeros(3)).otherwise(zeros(4)))
    files = table(spark, d, "events").groupBy(F.floor(k / 100).alias("file")).agg(F.array_sort(F.collect_list(F.struct(i.alias("i"), record.alias("record")))).alias("all"))
    body = F.aggregate("all", F.unhex(F.lit("")), lambda s, x: F.concat(s, x["record"]))
    content = F.concat(zeros(52), big(F.size("all").cast("long"), 4), big(F.lit(28), 4), zeros(120), body)
    return records.read_polarimeter(files.select(F.concat(F.lit("P3L2-"), F.col("file").cast("string")).alias("path"), content.alias("content")), land=land)


@query("""SELECT 'P3L2-' || event_id // 100 AS path, event_id % 100 + 2 AS record, event_id % 1000 * 3 AS line, event_id % 1000 * 5 AS "column", round((event_id * 7 % 30000) * 0.002e0, 6) AS aot_865, round((event_id * 11 % 30000) * 0.002e0, 6) AS aot_670,
  round(90 - (event_id % 1000 * 3 - 0.5e0) / 6, 6) AS lat FROM events""")
def read_parasol_sea(spark, d):
    return _polarimeter(spark, d, False).select("path", "record", "line", "column", r6("aot_865").alias("aot_865"), r6("aot_670").alias("aot_670"), r6("lat").alias("lat"))


@query("SELECT 'P3L2-' || event_id // 100 AS path, event_id % 100 + 2 AS record, event_id % 1000 * 3 AS line, round((event_id * 7 % 30000) * 0.002e0, 6) AS aot FROM events")
def read_parasol_land(spark, d):
    return _polarimeter(spark, d, True).select("path", "record", "line", r6("aot").alias("aot"))


#: Formats of files that lack their first item: those that fit two rules keep the other one's, those without items their own.
_WITHOUT = {"wrf_so2": "wrf_ash3d", "mod04": "mod04", "cams": "macc"}


def _lacking(m) -> str | None:
    return m[0] if not m[5] else _WITHOUT.get(m[0]) if m in fixtures.FILES[-3:] else None


def _quoted(x) -> str:
    return "CAST(NULL AS VARCHAR)" if x is None else repr(x)


@query("SELECT event_id, CASE WHEN event_id % 7 = 3 THEN lacking ELSE format END AS format FROM events JOIN (VALUES " + ", ".join(f"({i}, {_quoted(m[0])}, {_quoted(_lacking(m))})" for i, m in enumerate(fixtures.FILES)) + f") f(nth, format, lacking) ON event_id % {len(fixtures.FILES)} = nth")
def identify_formats(spark, d):
    """Each event a file of some format, near misses and files that fit two included; every seventh lacks its first item."""
    kinds = spark.createDataFrame([(i, *m[1:]) for i, m in enumerate(fixtures.FILES)], "nth int, name string, text string, head binary, container string, items array<string>, attributes array<string>")
    files = table(spark, d, "events").select("event_id", (F.col("event_id") % len(fixtures.FILES)).cast("int").alias("nth")).join(F.broadcast(kinds), "nth")  # a fixed table
    files = files.withColumn("items", F.when(F.col("event_id") % 7 == 3, F.slice("items", 2, 1000)).otherwise(F.col("items")))
    return identify.identify(files).select("event_id", "format")


@query("SELECT b || '-' || o_orderkey AS bundle, path FROM orders JOIN (VALUES " + ", ".join(f"({i}, {b!r}, {p!r})" for i, (b, (_, left)) in enumerate(fixtures.BUNDLES.items()) for p in left) + f") f(nth, b, path) ON o_orderkey % {len(fixtures.BUNDLES)} = nth")
def read_zip(spark, d):
    """Each order a bundle; what is left of it without side files."""
    kinds = spark.createDataFrame([(k, b, i, p) for k, (b, (names, _)) in enumerate(fixtures.BUNDLES.items()) for i, p in enumerate(names)], "kind int, b string, nth int, path string")
    orders = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % len(fixtures.BUNDLES)).cast("int").alias("kind"))
    return identify.product_files(orders.join(F.broadcast(kinds), "kind").select(F.concat_ws("-", "b", F.col("o_orderkey").cast("string")).alias("bundle"), "nth", "path")).select("bundle", "path")


def _stream_table(spark, d, twice: bool):
    """Measurements arrive as Parquet files, are appended where new, twice if asked."""
    made = f"{streams.work_folder(spark)}/ingest-{uuid.uuid4().hex}"
    m = spark.read.parquet(f"{d}/events.parquet")
    for k in range(1 + twice):
        source = spark.readStream.schema(m.schema).option("pathGlobFilter", "events.parquet").option("recursiveFileLookup", "true").parquet(d)
        rows = source.select(F.col("event_id").alias("id"), (F.col("user_id") % 25).alias("station"), F.col("event_type").alias("product"), "value", F.col("ts").alias("t_start"), F.col("ts").alias("t_end"))
        streams.append_new(rows, made, f"{made}-state-{k}").awaitTermination()
    return spark.read.parquet(made)


_STORED = "SELECT station, product, count(*) AS n, round(sum(value), 4) AS s FROM (SELECT DISTINCT user_id % 25 AS station, event_type AS product, value, ts FROM events) GROUP BY ALL"


@query(_STORED)
def poll_loop(spark, d):
    return _stream_table(spark, d, False).groupBy("station", "product").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("s"))


@query(_STORED)
def idempotent_ingest(spark, d):
    return _stream_table(spark, d, True).groupBy("station", "product").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("s"))


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, round(sum(value), 4) AS s FROM events GROUP BY 1")
def daily_chunking(spark, d):
    got = table(spark, d, "events").groupBy(F.window("ts", "1 day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("s"))
    return got.select(F.to_date("window.start").cast("string").alias("day"), "n", "s")


@query("SELECT event_type AS product, count(*) AS n, round(sum(value), 4) AS s FROM events GROUP BY 1")
def fan_out(spark, d):
    """A stream of events, written by kind to folders of their own, and what these hold."""
    made = f"{streams.work_folder(spark)}/fan-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("recursiveFileLookup", "true").parquet(d)
    sinks = {k: f"{made}/{k}" for k in ("click", "view", "purchase", "signup", "error")}
    streams.fan_out(source, "event_type", sinks, f"{made}/ledger", f"{made}-state").awaitTermination()
    found = [streams.fanned(spark, folder, f"{made}/ledger").select(F.lit(k).alias("product"), "value") for k, folder in sinks.items()]
    return functools.reduce(DataFrame.unionByName, found).groupBy("product").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("s"))
