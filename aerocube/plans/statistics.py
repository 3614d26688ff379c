"""Averages and difference statistics of coverages and stations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geo import haversine_m
from ..operators import catalog, ground, stats, subset
from ..sources.records import dateline_bbox as lon_range
from .inputs import HAVERSINE, MEASUREMENTS, PRODUCTS, SAMPLES, STATIONS, SWATH, measurements, products, r6, samples, stations, swath, table
from .registry import query

STAT = "round(min({0}), 6) AS v_min, round(max({0}), 6) AS v_max, round(avg({0}), 6) AS v_mean, round(stddev_pop({0}), 6) AS v_std"


def _rounded(df, *columns):
    return df.withColumns({c: r6(c) for c in columns})


@query(f"WITH {SAMPLES} SELECT coverage_id, round(avg(value), 6) AS value FROM samples GROUP BY ALL")
def spatial_average(spark, d):
    return _rounded(stats.average(samples(spark, d), "coverage_id"), "value")


@query(f"WITH {SAMPLES} SELECT coverage_id, row, col, level_idx, round(avg(value), 6) AS value FROM samples GROUP BY ALL")
def temporal_average(spark, d):
    return _rounded(stats.temporal_average(samples(spark, d)), "value")


@query(f"WITH {SAMPLES} SELECT coverage_id, {STAT.format('value')} FROM samples GROUP BY ALL")
def global_min_max(spark, d):
    return _rounded(stats.band_statistics(samples(spark, d), "coverage_id"), "v_min", "v_max", "v_mean", "v_std")


@query(f"WITH {SAMPLES} SELECT min(value) AS v FROM samples")
def min_data(spark, d):
    return stats.band_statistics(samples(spark, d)).select(F.col("v_min").alias("v"))


@query(f"WITH {SAMPLES} SELECT max(value) AS v FROM samples")
def max_data(spark, d):
    return stats.band_statistics(samples(spark, d)).select(F.col("v_max").alias("v"))


@query(f"WITH {SAMPLES} SELECT round(stddev_pop(value), 6) AS v FROM samples")
def std(spark, d):
    return stats.band_statistics(samples(spark, d)).select(r6("v_std").alias("v"))


@query(f"WITH {SAMPLES} SELECT coverage_id, level_idx, {STAT.format('value')} FROM samples GROUP BY ALL")
def band_statistics(spark, d):
    return _rounded(stats.band_statistics(samples(spark, d), "coverage_id", "level_idx"), "v_min", "v_max", "v_mean", "v_std")


@query("SELECT l_linenumber, l_orderkey, l_partkey, l_suppkey, l_quantity, round(l_quantity - (regr_slope(l_extendedprice, l_quantity) OVER w * l_quantity + regr_intercept(l_extendedprice, l_quantity) OVER w) / 1000, 4) AS residual FROM lineitem WINDOW w AS (PARTITION BY l_linenumber)")
def ols_fit(spark, d):
    fit = stats.ols_fit(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", "l_linenumber")
    return fit.select("l_linenumber", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", F.round(F.col("l_quantity") - F.col("fitted") / 1000, 4).alias("residual"))


@query(f"WITH {SAMPLES} SELECT level_idx, greatest(round(avg(value - level_idx * 6), 6), 0) AS height FROM samples GROUP BY ALL")
def level_mean_height(spark, d):
    return _rounded(stats.level_mean_height(samples(spark, d).withColumn("height", F.col("value") - F.col("level_idx") * 6), "level_idx"), "height")


@query(f"WITH {SAMPLES} SELECT col // 5 AS chunk, row, round(avg(value - 25), 6) AS value FROM samples GROUP BY ALL HAVING avg(value - 25) >= 0")
def chunk_row_means(spark, d):
    return _rounded(stats.chunk_row_means(samples(spark, d).withColumn("value", F.col("value") - 25), 5), "value")


@query("SELECT user_id, event_id // 200 AS slice, round(avg(value), 6) AS t_mean, arg_min(value, event_id) AS t_first, arg_max(value, event_id) AS t_last FROM events GROUP BY ALL")
def slice_time_avg(spark, d):
    return _rounded(stats.slice_stats(table(spark, d, "events"), "user_id", "event_id", "value", 200), "t_mean")


@query("SELECT user_id % 25 AS station, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, round(avg(value - 50), 6) AS value FROM events WHERE event_id % 97 <> 0 AND value - 50 >= 0 GROUP BY ALL")
def daily_station_average(spark, d):
    rows = measurements(spark, d).select(F.col("stations_id").alias("station"), "t", (F.col("value") - 50).alias("value"))
    return _rounded(stats.daily_station_average(rows, "station"), "value").withColumn("day", F.col("day").cast("string"))


@query(
    f"""WITH {SWATH}, s AS (SELECT src_row, src_col, lat, lon, lead(lat) OVER w AS slat, lead(lon) OVER w AS slon FROM swath WINDOW w AS (PARTITION BY src_row ORDER BY src_col)),
g AS (SELECT src_row, src_col, CASE WHEN slat IS NOT NULL THEN {HAVERSINE} END AS own FROM s),
h AS (SELECT *, coalesce(own, lag(own) OVER (PARTITION BY src_row ORDER BY src_col)) AS gap, avg(own) OVER () AS mean FROM g)
SELECT src_row AS row, src_col AS col, round(gap, 2) AS gap, round(CASE WHEN gap < mean THEN 2 * mean ELSE gap END, 2) AS threshold FROM h"""
)
def nearest_threshold_stats(spark, d):
    s = swath(spark, d).withColumnsRenamed({"src_row": "row", "src_col": "col"})
    got = stats.right_distances(s, haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")))
    return got.select("row", "col", F.round("gap", 2).alias("gap"), F.round("threshold", 2).alias("threshold"))


@query(f"WITH {SAMPLES} SELECT coverage_id, CASE WHEN min(lon) * max(lon) < 0 AND max(lon) - min(lon) > 270 THEN min(lon) FILTER (WHERE lon > 0) ELSE min(lon) END AS lon_min, CASE WHEN min(lon) * max(lon) < 0 AND max(lon) - min(lon) > 270 THEN max(lon) FILTER (WHERE lon < 0) ELSE max(lon) END AS lon_max FROM samples GROUP BY coverage_id")
def dateline_bbox(spark, d):
    return lon_range(samples(spark, d), "coverage_id")


@query(f"WITH {MEASUREMENTS}, {STATIONS}, {PRODUCTS} SELECT m.id, s.name AS station, p.measurement_unit, s.latitude, m.value FROM measurements m JOIN stations s ON m.stations_id = s.id JOIN products p ON m.product = p.product WHERE s.latitude BETWEEN -30 AND 60 AND p.measurement_unit = 'ppb' AND m.value IS NOT NULL")
def star_join(spark, d):
    m = measurements(spark, d).join(products(spark).select(F.col("id").alias("observed_field"), "product"), "product").drop("product")
    got = ground.star_join(m.filter("value is not null").withColumnRenamed("id", "mid"), stations(spark, d), products(spark))
    got = subset.subset_bbox(got.withColumnsRenamed({"latitude": "lat", "longitude": "lon"}), (-180, 180), (-30, 60))
    return subset.like_product(got, "ppb", "%").select(F.col("mid").alias("id"), "station", "measurement_unit", F.col("lat").alias("latitude"), "value")


@query(f"WITH {MEASUREMENTS}, {PRODUCTS} SELECT m.id, product, value FROM measurements m JOIN products p USING (product) WHERE measurement_unit LIKE 'DU' AND product LIKE '%i%'")
def like_product(spark, d):
    """Measurements of the products whose unit and name fit two patterns."""
    m = measurements(spark, d).select("id", "product", "value").join(products(spark).drop("id"), "product")
    return subset.like_product(m, "DU", "%i%").select("id", "product", "value")


@query("SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'DU' WHEN 1 THEN 'ppb' ELSE '%' END AS measurement_unit, 'A' || (o_orderkey % 3) AS application FROM orders")
def coverage_attr_lookup(spark, d):
    attributes = spark.createDataFrame([("0", "DU", "A0"), ("1", "ppb", "A1"), ("2", "%", "A2")], "coverage_id string, measurement_unit string, application string")
    k = F.col("o_orderkey")
    got = ground.coverage_attributes(table(spark, d, "orders").select(k.alias("id"), (k % 3).cast("string").alias("coverage_id")), attributes)
    return got.select("id", "measurement_unit", "application")


@query(f"WITH {SAMPLES} SELECT coverage_id, count(*) AS n, round(sum(value), 6) AS s FROM samples WHERE lon BETWEEN -20 AND 40 AND lat BETWEEN 10 AND 60 GROUP BY ALL")
def subset_bbox(spark, d):
    got = subset.subset_bbox(samples(spark, d), (-20, 40), (10, 60))
    return got.groupBy("coverage_id").agg(F.count("*").alias("n"), r6(F.sum("value")).alias("s"))


@query("SELECT event_id FROM events WHERE ts <= TIMESTAMP '2024-01-10' AND ts + INTERVAL 6 HOUR >= TIMESTAMP '2024-01-08'")
def subset_time_overlap(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("t_start"))
    return subset.subset_time_overlap(e.withColumn("t_end", F.col("t_start") + F.expr("interval 6 hours")), "2024-01-08", "2024-01-10").select("event_id")


@query(f"WITH {SAMPLES} SELECT row, col, level_idx, count(*) AS n, round(avg(value), 6) AS value FROM samples WHERE coverage_id = 'A' AND lon BETWEEN -60 AND 60 AND lat BETWEEN -30 AND 30 AND t BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31' GROUP BY ALL")
def wcs_get_coverage(spark, d):
    s = samples(spark, d).withColumn("t_start", F.col("t").cast("timestamp")).withColumn("t_end", F.col("t_start"))
    got = subset.get_coverage(s, "A", subset.Subset((-60, 60), (-30, 30), "1996-01-01", "1998-12-31"))
    return got.groupBy("row", "col", "level_idx").agg(F.count("*").alias("n"), r6(F.avg("value")).alias("value"))


@query("SELECT event_id FROM events WHERE value BETWEEN 20 AND 40 AND user_id BETWEEN 10 AND 100")
def range_filters(spark, d):
    return subset.range_filters(table(spark, d, "events"), "value:40,20;user_id:10,100").select("event_id")


@query("SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-12'")
def download_limits(spark, d):
    return subset.downloads(table(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp")), "2024-01-02", "2024-01-12").select("event_id")


@query(f"WITH {SAMPLES} SELECT coverage_id, count(DISTINCT (row, col)) = 1 AS same_bbox FROM samples GROUP BY ALL")
def same_bbox_stack(spark, d):
    s = samples(spark, d)
    box = s.select("coverage_id", *[F.col(c).alias(n) for c, n in (("row", "north"), ("col", "west"), ("row", "south"), ("col", "east"))])
    return catalog.same_bbox(box, "coverage_id")
