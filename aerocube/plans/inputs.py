"""The library's tables as projections of the star schema's, for Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def samples(spark: SparkSession, d: str) -> DataFrame:
    """Coverages A, N and R: one sample per line item; its value is missing for every 31st part."""
    lon = (F.col("l_partkey") % 360).cast("double") - 179.5
    lat = (F.col("l_suppkey") % 180).cast("double") - 89.5
    return table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("coverage_id"), F.col("l_shipdate").alias("t"), lon.alias("lon"), lat.alias("lat"),
        F.floor((90 - lat) / 10).cast("int").alias("row"), F.floor((lon + 180) / 10).cast("int").alias("col"), F.col("l_linenumber").alias("level_idx"),
        F.when(F.col("l_partkey") % 31 != 0, F.col("l_quantity")).alias("value"),
    )


SAMPLES = """samples AS (SELECT l_returnflag AS coverage_id, l_shipdate AS t, CAST(l_partkey % 360 AS DOUBLE) - 179.5 AS lon, CAST(l_suppkey % 180 AS DOUBLE) - 89.5 AS lat,
  CAST(floor((90 - (CAST(l_suppkey % 180 AS DOUBLE) - 89.5)) / 10) AS INT) AS row, CAST(floor((CAST(l_partkey % 360 AS DOUBLE) + 0.5) / 10) AS INT) AS col, l_linenumber AS level_idx,
  CASE WHEN l_partkey % 31 <> 0 THEN l_quantity END AS value FROM lineitem)"""


def cells(spark: SparkSession, d: str, coverage: str) -> DataFrame:
    """A coverage gridded: the mean per cell and level."""
    s = samples(spark, d).filter(F.col("coverage_id") == coverage)
    return s.groupBy("row", "col", "level_idx").agg(F.avg("value").alias("value"))


def cells_sql(coverage: str, name: str) -> str:
    return f"{name} AS (SELECT row, col, level_idx, avg(value) AS value FROM samples WHERE coverage_id = '{coverage}' GROUP BY ALL)"


def stations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    return table(spark, d, "nation").select(
        k.cast("long").alias("id"), F.col("n_name").alias("name"), (k * 7 - 80).cast("double").alias("latitude"), (k * 14 - 170).cast("double").alias("longitude"), (k * 10).cast("double").alias("height")
    )


STATIONS = "stations AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(n_nationkey * 7 - 80 AS DOUBLE) AS latitude, CAST(n_nationkey * 14 - 170 AS DOUBLE) AS longitude, CAST(n_nationkey * 10 AS DOUBLE) AS height FROM nation)"


def products(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, "click", "DU"), (1, "view", "DU"), (2, "purchase", "ppb"), (3, "signup", "ppb"), (4, "logout", "%"), (5, "add_to_cart", "%")], "id long, product string, measurement_unit string")


PRODUCTS = "products(id, product, measurement_unit) AS (VALUES (0, 'click', 'DU'), (1, 'view', 'DU'), (2, 'purchase', 'ppb'), (3, 'signup', 'ppb'), (4, 'logout', '%'), (5, 'add_to_cart', '%'))"


def measurements(spark: SparkSession, d: str) -> DataFrame:
    """One measurement per event; its value is missing for every 97th."""
    return table(spark, d, "events").select(
        F.col("event_id").alias("id"), (F.col("user_id") % 25).alias("stations_id"), F.col("event_type").alias("product"), F.col("ts").cast("timestamp").alias("t"), "user_id",
        F.when(F.col("event_id") % 97 != 0, F.col("value")).alias("value"),
    )


MEASUREMENTS = "measurements AS (SELECT event_id AS id, user_id % 25 AS stations_id, event_type AS product, ts AS t, user_id, CASE WHEN event_id % 97 <> 0 THEN value END AS value FROM events)"


def observations(spark: SparkSession, d: str) -> DataFrame:
    """Ground observations: purchases."""
    m = measurements(spark, d).filter("product = 'purchase'")
    return m.select(
        F.col("id").alias("obs_id"), F.col("t").alias("t_start"), F.col("t").alias("t_end"), (F.col("user_id") * F.lit(2.4) - 180).alias("lon"), (F.col("user_id") % 120 - 60).cast("double").alias("lat"), "value"
    )


OBSERVATIONS = "obs AS (SELECT id AS obs_id, t AS t0, t AS t1, user_id * CAST(2.4 AS DOUBLE) - 180 AS lon, CAST(user_id % 120 - 60 AS DOUBLE) AS lat, value FROM measurements WHERE product = 'purchase')"


def coverage_points(spark: SparkSession, d: str) -> DataFrame:
    """A coverage near the observations: views."""
    m = measurements(spark, d).filter("product = 'view'")
    lon = F.col("user_id") * F.lit(2.4) - 180 + (F.col("id") % 7 - 3) * F.lit(0.3)
    lat = (F.col("user_id") % 120 - 60) + (F.col("id") % 5 - 2) * F.lit(0.3)
    return m.select("t", lon.alias("lon"), lat.alias("lat"), "value", (F.col("id") % 4).cast("int").alias("level_idx"))


COVERAGE_POINTS = """cov AS (SELECT t, user_id * CAST(2.4 AS DOUBLE) - 180 + (id % 7 - 3) * CAST(0.3 AS DOUBLE) AS lon,
  (user_id % 120 - 60) + (id % 5 - 2) * CAST(0.3 AS DOUBLE) AS lat, value, CAST(id % 4 AS INT) AS level_idx FROM measurements WHERE product = 'view')"""


def profiles(spark: SparkSession, d: str) -> DataFrame:
    """Profiles of 64 levels, thicker with height; the third value is missing for every 50th."""
    levels = F.transform("embedding", lambda x, i: F.when((F.col("vec_id") % 50 != 0) | (i != 2), x.cast("double")))
    heights = F.transform("embedding", lambda x, i: (250 * (i + 1) + 5 * i * i).cast("double"))
    return table(spark, d, "embeddings").select("vec_id", levels.alias("values"), heights.alias("heights"))


PROFILES = """levels AS (SELECT vec_id, i AS level_idx, CAST(250 * i + 5 * (i - 1) * (i - 1) AS DOUBLE) AS height,
  CASE WHEN vec_id % 50 <> 0 OR i <> 3 THEN CAST(embedding[i] AS DOUBLE) END AS value FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"""


def collections(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("SO2_"), F.col("o_orderkey").cast("string"), F.lit("_v1_tif")).alias("coverage_id"), F.col("o_custkey").alias("uploaded_by"), F.col("o_orderstatus").alias("access"),
        F.col("o_orderpriority").alias("ipr"), F.col("o_orderdate").alias("start_date"), F.concat(F.lit("name "), F.col("o_orderkey").cast("string")).alias("name"), (F.col("o_orderkey") % 5).alias("use_case_id"), F.col("o_totalprice").alias("price"),
    )


COLLECTIONS = """collections AS (SELECT o_orderkey AS id, 'SO2_' || o_orderkey || '_v1_tif' AS coverage_id, o_custkey AS uploaded_by, o_orderstatus AS access, o_orderpriority AS ipr,
  o_orderdate AS start_date, 'name ' || o_orderkey AS name, o_orderkey % 5 AS use_case_id, o_totalprice AS price FROM orders)"""


def swath(spark: SparkSession, d: str) -> DataFrame:
    """A 5 by 5 swath of sources on a slant, one pixel per nation."""
    k = F.col("n_nationkey")
    return table(spark, d, "nation").select(
        F.floor(k / 5).cast("int").alias("src_row"), (k % 5).cast("int").alias("src_col"), (k * F.lit(1.7) - 20).alias("lat"), ((k * 7 % 25) * F.lit(1.3) - 15).alias("lon"), (k * 10).cast("double").alias("value")
    )


SWATH = "swath AS (SELECT CAST(n_nationkey // 5 AS INT) AS src_row, CAST(n_nationkey % 5 AS INT) AS src_col, n_nationkey * CAST(1.7 AS DOUBLE) - 20 AS lat, (n_nationkey * 7 % 25) * CAST(1.3 AS DOUBLE) - 15 AS lon, CAST(n_nationkey * 10 AS DOUBLE) AS value FROM nation)"
#: Metres between (lat, lon) and (slat, slon).
_A = "power(sin(radians(slat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(slat)) * power(sin(radians(slon - lon) / 2), 2)"
HAVERSINE = f"2 * 6372795.477598e0 * atan2(sqrt({_A}), sqrt(greatest(1 - ({_A}), 0)))"
