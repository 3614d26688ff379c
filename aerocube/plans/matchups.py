"""Matchups of observations and points with coverages, and the service requests built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matchup, subset
from .inputs import COVERAGE_POINTS, MEASUREMENTS, OBSERVATIONS, SAMPLES, STATIONS, coverage_points, observations, r6, samples, stations, table
from .registry import query


_MATCHED = f"""WITH {MEASUREMENTS}, {OBSERVATIONS}, {COVERAGE_POINTS}
SELECT obs_id, round(max(obs.value), @r) AS ground, round(avg(cov.value), @r) AS cover, round(max(obs.value) - avg(cov.value), @r) AS d, count(*) AS n FROM obs JOIN cov
ON cov.lon BETWEEN obs.lon - @d AND obs.lon + @d AND cov.lat BETWEEN obs.lat - @d AND obs.lat + @d AND cov.t BETWEEN t0 - INTERVAL @m MINUTE AND t1 + INTERVAL @m MINUTE GROUP BY obs_id"""


def _shown(got, digits: int):
    return got.select("obs_id", *[F.round(c, digits).alias(c) for c in ("ground", "cover", "d")], "n")


@query(_MATCHED.replace("@d", "1").replace("@m", "60").replace("@r", "6"))
def ground_coverage_matchup(spark, d):
    return _shown(matchup.ground_coverage_matchup(observations(spark, d), coverage_points(spark, d)), 6)


@query(_MATCHED.replace("@d", "20").replace("@m", "2880").replace("@r", "9"))
def dense_matchup(spark, d):
    """Within 20 degrees and two days, so that an observation meets many samples."""
    return _shown(matchup.dense_matchup(observations(spark, d), coverage_points(spark, d), 20.0, 2880.0), 9)


@query(
    f"""WITH {MEASUREMENTS}, {OBSERVATIONS}, {COVERAGE_POINTS}, s AS (SELECT obs_id AS site_id, lon, lat, CAST(t0 AS DATE) AS period FROM obs)
SELECT site_id, level_idx, round(avg(value), 6) AS value, count(*) AS n FROM s JOIN cov ON period = CAST(cov.t AS DATE)
AND cov.lon BETWEEN s.lon - 1.1e0 AND s.lon + 1.1e0 AND cov.lat BETWEEN s.lat - 1.1e0 AND s.lat + 1.1e0 GROUP BY site_id, level_idx"""
)
def lidar_model_profile(spark, d):
    sites = observations(spark, d).select(F.col("obs_id").alias("site_id"), "lon", "lat", F.to_date("t_start").alias("period"))
    got = matchup.footprint_profile(sites, coverage_points(spark, d).withColumn("period", F.to_date("t")))
    return got.select("site_id", "level_idx", r6("value").alias("value"), "n")


_CELL = "CAST(floor((longitude + 180) / 10) AS INT) AS col, CAST(floor((90 - latitude) / 10) AS INT) AS row"


def _points(spark, d):
    points = stations(spark, d).select(F.col("id").alias("point_id"), F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    return matchup.point_to_cell(points, -180.0, 10.0, 90.0, -10.0, 18, 36)


@query(f"WITH {STATIONS} SELECT id AS point_id, row, col FROM (SELECT id, {_CELL} FROM stations) WHERE row BETWEEN 0 AND 17 AND col BETWEEN 0 AND 35")
def point_to_cell(spark, d):
    return _points(spark, d).select("point_id", "row", "col")


_AT = f"p AS (SELECT id AS point_id, {_CELL} FROM stations), c AS (SELECT coverage_id, row, col, level_idx, CAST(CAST(t AS DATE) AS VARCHAR) AS t, avg(value) AS value FROM samples GROUP BY ALL)"


@query(f"WITH {STATIONS}, {SAMPLES}, {_AT} SELECT point_id, coverage_id, level_idx, t, round(value, 6) AS value FROM p JOIN c USING (row, col)")
def wps_values_through_time(spark, d):
    c = samples(spark, d).groupBy("coverage_id", "level_idx", "row", "col", F.to_date("t").cast("string").alias("t")).agg(r6(F.avg("value")).alias("value"))
    return matchup.values_through_time(_points(spark, d), c, "level_idx")


@query(f"WITH {STATIONS}, {SAMPLES}, {_AT} SELECT point_id, coverage_id, t, CAST(row_number() OVER (PARTITION BY point_id, coverage_id, t ORDER BY level_idx) - 1 AS INT) AS level, round(value, 6) AS value FROM p JOIN c USING (row, col)")
def wps_volume_pixel_values(spark, d):
    c = samples(spark, d).groupBy("coverage_id", "row", "col", "level_idx", F.to_date("t").cast("string").alias("t")).agg(F.avg("value").alias("value"))
    from ..operators.algebra import stack_bands

    stacks = stack_bands(c, "coverage_id", "row", "col", "t")
    return matchup.volume_values(_points(spark, d), stacks).withColumn("value", r6("value"))


@query("SELECT event_type AS identifier, strftime(ts, '%Y-%m-%d %H:%M:%S') AS starttime, event_id FROM events WHERE ts <= TIMESTAMP '2024-01-05' AND ts + INTERVAL 1 HOUR >= TIMESTAMP '2024-01-04'")
def wps_get_time_data(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("identifier"), F.col("ts").cast("timestamp").alias("t_start"), "event_id")
    got = subset.subset_time_overlap(e.withColumn("t_end", F.col("t_start") + F.expr("interval 1 hour")), "2024-01-04", "2024-01-05")
    return got.orderBy("t_start").select("identifier", F.date_format("t_start", "yyyy-MM-dd HH:mm:ss").alias("starttime"), "event_id")


@query("SELECT event_id, epoch(date_trunc('second', ts)) AS epoch, value FROM events WHERE event_type IN ('view', 'click') AND ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-09'")
def wps_retrieve_data(spark, d):
    e = table(spark, d, "events").filter(F.col("event_type").isin("view", "click")).withColumn("t", F.col("ts").cast("timestamp"))
    return subset.downloads(e, "2024-01-03", "2024-01-09").select("event_id", F.unix_seconds("t").cast("double").alias("epoch"), "value")


@query("SELECT event_id, value FROM events WHERE event_type = 'view' AND value BETWEEN 10 AND 90 AND user_id BETWEEN 5 AND 50")
def wps_retrieve_filtered(spark, d):
    return subset.range_filters(table(spark, d, "events").filter("event_type = 'view'"), "value:90,10;user_id:5,50").select("event_id", "value")


_RUN = "WHERE coverage_id = 'A' AND lon BETWEEN -60 AND 60 AND lat BETWEEN -30 AND 30 AND t BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'"


@query(f"WITH {SAMPLES} SELECT 'spatialAverage' AS process, NULL AS row, NULL AS col, round(avg(value), 6) AS value FROM samples {_RUN} UNION ALL SELECT 'temporalAverage', row, col, round(avg(value), 6) FROM samples {_RUN} GROUP BY row, col")
def wps_pep_process(spark, d):
    """The two averages by name, over one request."""
    s = samples(spark, d).withColumn("t_start", F.col("t").cast("timestamp")).withColumn("t_end", F.col("t_start"))
    got = subset.get_coverage(s, "A", subset.Subset((-60, 60), (-30, 30), "1996-01-01", "1998-12-31"))
    mean, nowhere = r6(F.avg("value")).alias("value"), F.lit(None).cast("int")
    spatial = got.agg(mean).select(F.lit("spatialAverage").alias("process"), nowhere.alias("row"), nowhere.alias("col"), "value")
    temporal = got.groupBy("row", "col").agg(mean).select(F.lit("temporalAverage").alias("process"), "row", "col", "value")
    return spatial.unionByName(temporal)
