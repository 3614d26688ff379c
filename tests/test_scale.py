"""What joins and searches meet, so that it grows no faster than their inputs."""

import os
import random

import pytest
from pyspark.sql import functions as F

from aerocube.functions.values import num
from aerocube.operators import coords, matchup, subset, swath
from aerocube.plans import registry

D = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dense_matchup_broadcasts_no_observations(spark):
    at = F.lit("2020-01-01").cast("timestamp")
    o = spark.range(5).select(F.col("id").alias("obs_id"), at.alias("t_start"), at.alias("t_end"), (F.col("id") * 20.0).alias("lon"), num(0).alias("lat"), num(1).alias("value"))
    c = spark.range(200).select(at.alias("t"), F.col("id").cast("double").alias("lon"), num(20).alias("lat"), F.col("id").cast("double").alias("value"))
    got = matchup.dense_matchup(o, c, 20.0, 60.0)
    assert "Broadcast" not in plan(got) and "Broadcast" not in plan(matchup.ground_coverage_matchup(o, c))
    want = {i: [x for x in range(200) if abs(x - i * 20) <= 20] for i in range(5)}  # samples on the edges of blocks count
    assert {r["obs_id"]: (r["n"], r["cover"]) for r in got.collect()} == {i: (len(v), sum(v) / len(v)) for i, v in want.items()}


def test_downloads_give_all_rows(spark):
    df = spark.range(50).withColumn("t", (F.lit("2020-01-01").cast("timestamp").cast("long") + F.col("id") * 50_000).cast("timestamp"))
    got = subset.downloads(df, "2020-01-01", "2020-03-01", most_days=15, most_rows=7).select("id", "t", "download.*").collect()
    assert sorted(r["id"] for r in got) == list(range(50))
    parts = {}
    for r in got:
        parts.setdefault((r["period"], r["part"]), []).append(r["t"])
    assert max(map(len, parts.values())) == 7 and all((max(x) - min(x)).days < 15 for x in parts.values())
    assert all(max(parts[a]) < min(parts[b]) for a, b in zip(sorted(parts), sorted(parts)[1:], strict=False))


def test_control_points_shuffle_no_pixels(spark):
    points = spark.createDataFrame([("a", r, c, 40.0 + r, 5.0 + c) for r in (0, 5, 10) for c in (0, 5, 10)] + [("b", 0, 0, 1.0, 2.0)], "k string, row int, col int, lat double, lon double")
    sizes = spark.createDataFrame([("a", 11, 11), ("b", 1, 3)], "k string, rows int, columns int")
    got = coords.densify(points, sizes, ["k"])
    assert not any("Exchange" in line and "to_col" in line for line in plan(got).splitlines())
    rows = {(r["k"], r["row"], r["col"]): (r["lat"], r["lon"]) for r in got.collect()}
    assert len(rows) == 124 and rows["a", 5, 10] == (45.0, 15.0) and rows["b", 0, 2] == (None, None)


@pytest.mark.skipif(not os.path.isdir(D), reason="no tables")
def test_vincenty_once_a_place(spark):
    assert "HashAggregate(keys=[lat" in plan(registry.QUERIES["vincenty_m"](spark, D)).replace("knownfloatingpointnormalized(normalizenanandzero(lat", "lat")


def test_sources_meet_few_pixels_however_far_the_reach(spark):
    rng = random.Random(3)
    rows = [("a", i // 50, i % 50, rng.uniform(10, 13), rng.choice((178.5, 180.5)) + rng.uniform(0, 1)) for i in range(3000)]
    s = spark.createDataFrame(rows, "k string, src_row int, src_col int, lat double, lon double")
    grids = swath.own_grids(s, ["k"], num(0.1), num(500_000.0))
    pairs = swath.pairs_in_reach(s, grids, ["k"]).count()
    assert pairs < 60 * len(rows)  # a grid has 850 pixels or so, all within reach of all sources
    pixels = swath.pixels(grids, ["k"]).withColumnsRenamed({"dst_row": "r", "dst_col": "c", "lat": "plat", "lon": "plon"})
    d = swath.haversine_m(F.col("plat"), F.col("plon"), F.col("lat"), F.col("lon"))
    best = pixels.crossJoin(s.drop("k")).groupBy("k", "r", "c").agg(F.min(F.struct(d.alias("d"), (-F.col("src_row")).alias("sr"), (-F.col("src_col")).alias("sc"))).alias("b"))
    want = {(x["k"], x["r"], x["c"]): (-x["b"]["sr"], -x["b"]["sc"], x["b"]["d"]) for x in best.collect()}
    got = {(x["k"], x["dst_row"], x["dst_col"]): (x["src_row"], x["src_col"], x["dist_m"]) for x in swath.nearest_in_reach(s, grids, ["k"]).collect()}
    assert got == want and len(got) > 700
