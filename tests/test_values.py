"""Golden values and properties of the expressions and operators."""

import pytest
from pyspark.sql import functions as F

from aerocube.functions import geo, meteo, times, values
from aerocube.operators import algebra, align, catalog, matchup, regrid, stats, subset


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("hpa", "height"), [(1000, 111.0233877377401), (500, 5957.38264921542), (5, 44799.7528162307)])
def test_baro_height(spark, hpa, height):
    assert one(spark, meteo.baro_height(F.lit(float(hpa)))) == pytest.approx(height, rel=1e-12)


def test_units_and_wraps(spark):
    assert one(spark, values.unit_conversion(F.lit(3.0), 4, 2)) == 20
    assert [one(spark, values.lon_wrap(F.lit(x))) for x in (270, 180, -10)] == [-90, 180, -10]
    assert one(spark, values.label_filename(F.lit("X_20150101.120000.tif"), "2D")) == "X_2D_20150101.120000.tif"
    assert one(spark, values.parse_options(F.lit("function=convert;gain=2"))) == {"function": "convert", "gain": "2"}
    assert one(spark, values.decimal_digits(F.lit(0.125))) == 3


def test_sentinels_are_null(spark):
    assert one(spark, values.mask_equal(F.lit(-9999.0), -9999)) is None
    assert one(spark, values.mask_outside(F.lit(5.0), 0, 4)) is None
    assert one(spark, values.mask_negative(F.lit(-1.0))) is None


def test_vincenty(spark):
    """The classical line from Flinders Peak to Buninyong, on WGS 84; coincident and antipodal points."""
    assert one(spark, geo.vincenty_m(*map(F.lit, (-37.95103341666667, 144.42486788888888, -37.65282113888889, 143.92649552777777)))) == pytest.approx(54972.271, abs=2e-3)
    assert one(spark, geo.vincenty_m(*map(F.lit, (10.0, 20.0, 10.0, 20.0)))) == 0
    assert one(spark, geo.vincenty_m(*map(F.lit, (0.0, 0.0, 0.5, 179.7)))) is None


def test_utm(spark):
    east, north = geo.utm_forward(F.lit(48.8582), F.lit(2.2945))
    assert one(spark, east) == pytest.approx(448251.8, abs=1)
    assert one(spark, north) == pytest.approx(5411932.7, abs=1)
    assert one(spark, geo.utm_zone(F.lit(2.2945))) == 31
    assert one(spark, geo.mgrs_digraph(F.lit(31), east, north)) == "DQ"


def test_zone_and_snap(spark):
    assert one(spark, geo.zone_id(F.lit(90.0), F.lit(-180.0), F.lit(0.1), F.lit(64), F.lit(64))) == 1
    assert [one(spark, geo.grid_snap(F.lit(x), F.lit(4), up)) for x, up in ((1.3, False), (1.3, True), (-1.3, False), (-1.3, True), (-2.0, False), (-2.0, True))] == [1.25, 1.5, -1.5, -1.25, -2.25, -2.0]


def test_sinusoidal(spark):
    assert one(spark, geo.sinusoidal_lat(F.lit(1))) == pytest.approx(89.9166666667)


def test_epochs(spark):
    assert str(one(spark, times.tai93(F.lit(86400.5)))) == "1993-01-02 00:00:00.500000"
    assert str(one(spark, times.year_day(F.lit("2016366")))) == "2016-12-31"
    assert one(spark, times.clock_ms(F.lit(123456789))) == pytest.approx(12 * 3600 + 34 * 60 + 56.789)


def profile(*v):
    return F.array(*[F.lit(x).cast("double") for x in v])


def test_vertical_integral(spark):
    assert one(spark, algebra.vertical_integral(profile(1, 2, 3), profile(10, 30, 60))) == 140
    assert one(spark, algebra.vertical_integral(profile(1, None, 3), profile(10, 30, 60))) is None


def test_difference_stats(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 5.0), (0, 2, None)], "row int, col int, value double")
    b = spark.createDataFrame([(0, 0, 0.0), (0, 1, 2.0), (0, 2, 7.0)], "row int, col int, value double")
    assert tuple(stats.difference_stats(stats.difference(a, b, ["row", "col"])).first()) == (2, 1, 1, 3)


def cube(spark):
    return spark.createDataFrame([(r, c, 1, float(r * 7 + c) if (r + c) % 4 else None) for r in range(5) for c in range(6)], "row int, col int, level_idx int, value double")


def test_algebra_laws(spark):
    a = cube(spark)
    both = a.withColumnsRenamed({"value": "va"}).withColumn("vb", F.col("va"))
    assert {r["value"] for r in align.subtract(both).collect()} == {0.0, None}
    assert {(r["row"], r["col"], r["value"]) for r in align.add(both).collect()} == {(r["row"], r["col"], r["value"] and 2 * r["value"]) for r in a.collect()}
    assert sorted(map(str, algebra.flip_ud(algebra.flip_ud(a, 5), 5).collect())) == sorted(map(str, a.collect()))


def test_chunks_share_columns(spark):
    got = algebra.chunk_overlap(spark.range(25).withColumnRenamed("id", "col"), "col", 10, 1).groupBy("chunk").agg(F.min("col"), F.max("col")).orderBy("chunk").collect()
    assert [tuple(r) for r in got] == [(0, 0, 9), (1, 9, 18), (2, 18, 24)]


def test_regrid_equals_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    source = [(i, 0, float(a), float(o)) for i, (a, o) in enumerate(zip(rng.uniform(60, 89.9, 300), rng.uniform(-180, 180, 300), strict=True))]
    target = [(i, 0, float(a), float(o)) for i, (a, o) in enumerate(zip(rng.uniform(60, 90, 200), rng.uniform(-180, 180, 200), strict=True))]
    s, t = spark.createDataFrame(source, "src_row int, src_col int, lat double, lon double"), spark.createDataFrame(target, "dst_row int, dst_col int, lat double, lon double")
    got = {r["dst_row"]: r["src_row"] for r in regrid.pixel_map(t, s, 300_000).collect()}

    def dist(a, b):
        p, q, d = np.radians(a[2]), np.radians(b[2]), np.radians(a[3] - b[3])
        x = np.sin((p - q) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(d / 2) ** 2
        return 2 * geo.EARTH * np.arcsin(np.sqrt(x))

    want = {}
    for x in target:
        d, i = min((dist(x, y), -y[0]) for y in source)
        if d < 300_000:
            want[x[0]] = -i
    assert got == want


def test_same_grid_is_identity(spark):
    t = regrid.target_grid(spark, 10.0, 0.0, 8, 8, 1.0)
    s = t.withColumnsRenamed({"dst_row": "src_row", "dst_col": "src_col"})
    assert regrid.pixel_map(t, s, 100_000).filter("dst_row <> src_row or dst_col <> src_col").count() == 0


def test_matchup_skips_missing_and_unmatched(spark):
    obs = spark.createDataFrame([(1, "2020-01-01 00:00:00", 0.0, 0.0, 5.0), (2, "2020-01-01 00:00:00", 50.0, 0.0, 5.0)], "obs_id int, t string, lon double, lat double, value double")
    obs = obs.select("obs_id", F.col("t").cast("timestamp").alias("t_start"), F.col("t").cast("timestamp").alias("t_end"), "lon", "lat", "value")
    cov = spark.createDataFrame([("2020-01-01 01:00:00", 1.0, -1.0, 3.0), ("2020-01-01 01:00:01", 0.0, 0.0, 100.0), ("2020-01-01 00:30:00", 0.5, 0.5, None)], "t string, lon double, lat double, value double")
    got = matchup.ground_coverage_matchup(obs, cov.withColumn("t", F.col("t").cast("timestamp"))).collect()
    assert [(r["obs_id"], r["cover"], r["d"], r["n"]) for r in got] == [(1, 3.0, 2.0, 2)]


def test_ranges_and_limits(spark):
    assert subset.parse_ranges("F:40,20;G:1,2") == {"F": (20, 40), "G": (1, 2)}
    df = spark.range(3).withColumn("t", F.lit("2020-01-05").cast("timestamp"))
    with pytest.raises(ValueError, match="days"):
        subset.check_download(df, "2020-01-01", "2020-02-01")
    with pytest.raises(ValueError, match="measurements"):
        subset.check_download(df, "2020-01-01", "2020-01-10", most_rows=2)


def test_states(spark):
    items = spark.createDataFrame([(1, "uploading"), (2, "processed"), (3, "Available")], "id int, status string")
    events = spark.createDataFrame([(1, "fetched"), (2, "load_failed"), (3, "fetched")], "id int, event string")
    assert dict(tuple(r) for r in catalog.advance(items, events).collect()) == {1: "processing", 2: "mwcs_Error", 3: "Available"}


def test_binned_join_is_no_nested_loop(spark):
    obs = spark.createDataFrame([(1, "2020-01-01", 0.0, 0.0, 5.0)], "obs_id int, t string, lon double, lat double, value double").withColumns({"t_start": F.col("t").cast("timestamp"), "t_end": F.col("t").cast("timestamp")})
    plan = matchup.ground_coverage_matchup(obs, obs.select(F.col("t_start").alias("t"), "lon", "lat", "value"))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nearest_at_any_distance(spark):
    """Far targets, poles, the date line, repeated and single sources: against all pairs."""
    import math
    import random

    from aerocube.operators import nearest

    r = random.Random(7)
    sources = [(i, 0, r.uniform(-5, 5), r.uniform(170, 190) - 360 * (r.random() < 0.5)) for i in range(60)] + [(60, 0, 89.9, 10.0), (61, 0, -90.0, 0.0), (62, 1, 3.0, 3.0), (63, 2, 3.0, 3.0)]
    targets = [(i, 0, r.uniform(-90, 90), r.uniform(-180, 180)) for i in range(80)] + [(80, 0, 90.0, -170.0), (81, 0, 0.0, 180.0), (82, 0, 3.0, 3.0)]

    def metres(a, b):
        (la, lo), (lb, lp) = (tuple(map(math.radians, x[2:])) for x in (a, b))
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
        return 2 * 6372795.477598 * math.atan2(math.sqrt(h), math.sqrt(max(1 - h, 0)))

    t = spark.createDataFrame(targets, "dst_row int, dst_col int, lat double, lon double")
    for known in (sources, sources[:1]):
        s = spark.createDataFrame(known, "src_row int, src_col int, lat double, lon double")
        got = {x["dst_row"]: x for x in nearest.nearest_pixels(t, s).collect()}
        assert len(got) == len(targets)
        for target in targets:
            best = min((metres(target, k), -k[0], -k[1]) for k in known)
            assert got[target[0]]["dist_m"] == pytest.approx(best[0], abs=1e-3)
            assert got[target[0]]["src_row"] == -best[1] or abs(metres(target, known[got[target[0]]["src_row"]]) - best[0]) < 1e-3
    assert got[82]["src_row"] == 0
    assert nearest.nearest_pixels(t, s.filter("1 = 0")).count() == 0


def test_utm_there_and_back(spark):
    from aerocube.functions import geo

    df = spark.createDataFrame([(47.3, 8.5), (-33.9, 18.4), (0.5, 3.0), (61.2, -149.9)], "lat double, lon double")
    east, north = geo.utm_forward(F.col("lat"), F.col("lon"))
    south = F.col("lat") < 0
    lat, lon = geo.utm_inverse(east, north + F.when(south, 10_000_000).otherwise(0), geo.utm_zone(F.col("lon")), south)
    for r in df.select("lat", "lon", lat.alias("a"), lon.alias("b")).collect():
        assert r["a"] == pytest.approx(r["lat"], abs=2e-4) and r["b"] == pytest.approx(r["lon"], abs=2e-4)


def test_control_points_in_utm(spark):
    from aerocube.operators import coords

    text = ["; Zone Number: 32N", "; map, image", "465005.35 5247096.0 10 20", "f"]
    got = coords.control_points(spark.createDataFrame([("a", x) for x in text[:3]], "file string, line string")).first()
    assert got["lon"] == pytest.approx(8.537, abs=0.01) and got["lat"] == pytest.approx(47.376, abs=0.01) and (got["x"], got["y"]) == (10, 20)


def test_a_batch_is_written_once(spark, tmp_path):
    """A stream that is run again from the same state, or whose state was lost, adds nothing."""
    from aerocube.streaming import ingest

    rows = spark.createDataFrame([(i % 5, "p", float(i), f"2024-01-0{i % 3 + 1} 00:00:00") for i in range(30)], "station int, product string, value double, t string")
    rows = rows.select("station", "product", "value", F.col("t").cast("timestamp").alias("t_start"), F.col("t").cast("timestamp").alias("t_end"))
    rows.union(rows).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    for state in ("a", "a", "b"):
        ingest.append_new(stream, f"{tmp_path}/store", f"{tmp_path}/{state}").awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/store").count() == 30
    assert ingest.stored(spark, f"{tmp_path}/none") is None
