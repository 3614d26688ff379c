"""Control points spread over grids, times of lines as text, requests with systems, curtains and models by hand."""

import math

import pytest
from pyspark.sql import functions as F

from aerocube.functions.times import line_stamp
from aerocube.operators import coords, subset
from aerocube.sources import curtains


def unit(lat, lon):
    a, o = math.radians(lat), math.radians(lon)
    return math.cos(a) * math.cos(o), math.cos(a) * math.sin(o), math.sin(a)


def plain_densify(points, rows, columns, wide, high):
    out = {}
    for r in range(rows):
        for c in range(columns):
            near = [(math.hypot(r - y, c - x), p) for (y, x), p in points.items() if abs(r - y) <= high and abs(c - x) <= wide]
            if (r, c) in points:
                out[r, c] = points[r, c]
                continue
            total = sum(d for d, _ in near)
            weighed = [(1 if len(near) == 1 else (1 - d / total) / (len(near) - 1), unit(*p)) for d, p in near]
            x, y, z = (sum(w * u[i] for w, u in weighed) for i in range(3))
            out[r, c] = (math.degrees(math.atan2(z, math.hypot(x, y))), math.degrees(math.atan2(y, x))) if near else None
    return out


def test_densify(spark):
    """Spacings of 1, 5 and 10 by 4, over the date line and at a pole; one grid with a single point."""
    grids = {"filled": (1, 1, 10, 20), "line": (5, 5, 10, 179.0), "pole": (10, 4, 88, 10), "one": (3, 3, 0, 0)}
    points = {k: {(y * high, x * wide): (min(float(lat) + y * (2 if k == "pole" else 0.5), 90.0), (float(lon) + x * (80 if k == "pole" else 0.6) + 180) % 360 - 180) for y in range(3) for x in range(4)} for k, (wide, high, lat, lon) in grids.items()}
    points["one"] = {(1, 1): (3.0, 4.0)}
    sizes = {"filled": (3, 4), "line": (12, 17), "pole": (9, 31), "one": (3, 3)}
    df = spark.createDataFrame([(k, r, c, *p) for k, own in points.items() for (r, c), p in own.items()] + [("one", 0, 0, None, 1.0)], "k string, row int, col int, lat double, lon double").repartition(3)
    got = coords.densify(df, spark.createDataFrame([(k, *s) for k, s in sizes.items()], "k string, rows int, columns int"), ["k"]).collect()
    assert len(got) == sum(a * b for a, b in sizes.values())
    for k, (wide, high, _, _) in grids.items():
        want = plain_densify(points[k], *sizes[k], *((wide - 1, high - 1) if k != "one" else (0, 0)))
        for r in got:
            if r["k"] == k:
                w = want[r["row"], r["col"]]
                assert (w is None and r["lat"] is None) or math.dist(unit(r["lat"], r["lon"]), unit(*w)) < 1e-9


def test_line_stamps(spark):
    rows = [("23:59:50", "00:00:10", 10, 20, "000000"), ("2016:02:28:23:59:58", "2016:02:29:00:00:02", 3, 4, "20160229_000001"), ("10:00:00", "10:00:07", 1, 2, "100004"), ("10:61:00", "10:00:07", 1, 2, None), ("today", "10:00:07", 1, 2, None), (None, "10:00:07", 1, 2, None)]
    df = spark.createDataFrame(rows, "a string, b string, line int, lines int, want string")
    assert all(r["got"] == r["want"] for r in df.select("want", line_stamp(F.col("a"), F.col("b"), F.col("line"), F.col("lines")).alias("got")).collect())


def test_requests_in_systems(spark):
    base, c = "http://www.opengis.net/def/crs/EPSG/0/", spark.createDataFrame([("c", 9.0, 0.0), ("c", 9.0, -10.0), ("c", 50.0, 0.0)], "coverage_id string, lon double, lat double")
    ask = lambda **more: subset.answer_requests(c, subset.parse_requests(spark.createDataFrame([(subset.coverage_request("c", 8.0, 10.0, -20.0, 5.0, **more),)], "xml string"))).orderBy("lat").collect()
    assert [(r["x"], r["y"]) for r in ask()] == [(9.0, -10.0), (9.0, 0.0)] == [(r["x"], r["y"]) for r in ask(output_crs=base + "4326")]
    north, south = ask(output_crs=base + "32632"), ask(output_crs=base + "32732")
    assert [round(r["x"]) for r in north] == [500_000] * 2 and round(north[1]["y"]) == 0 and round(south[0]["y"] - north[0]["y"]) == 10_000_000
    assert ask(subset_crs=base + "32632") == [] and [r["x"] for r in ask(output_crs=base + "3857")] == [None, None]


@pytest.mark.parametrize("n", [1, 9, 10, 11, 25])
def test_curtains(spark, n):
    """Chunks of 10 columns that share one; every column is in a chunk, the track meets its nodes."""
    rows = [("f", i, 10.0 + i, (179.0 + i * 0.3 + 180) % 360 - 180, [float(i), 500.0, -1.0], [300.0, 200.0, -5.0]) for i in range(n)]
    df = spark.createDataFrame(rows, "file string, ray int, lat double, lon double, values array<double>, heights array<double>")
    pixels, chunks = curtains.curtain(df, 0.0, 100.0, 2.0, bins=3, size=10)
    cells = {(r["chunk"], r["row"], r["col"]): r for r in pixels.collect()}
    assert {c * 9 + x for c, _, x in cells} == set(range(n)) and all((r["value"] == (c * 9 + x) / 2) if y == 0 else r["value"] is None for (c, y, x), r in cells.items())
    assert all(abs(r["track_lat"] - 10 - c * 9 - x) < 1e-9 and -180 <= r["track_lon"] <= 180 for (c, _, x), r in cells.items())
    for r in chunks.collect():
        assert [p["col"] for p in r["nodes"]] == sorted({0, r["columns"] - 1}) and r["levels"] == [200.0, 300.0] and r["columns"] <= 10


def test_publishing_again(spark, tmp_path):
    """A rerun replaces the days that it writes and leaves the others."""
    import datetime as dt

    from aerocube.sources import rasters

    cells = spark.createDataFrame([("a", dt.datetime(2024, 1, d), 0, c, 1, float(d * c)) for d in (1, 2) for c in (1, 2, 3)], "coverage_id string, t timestamp, row int, col int, level_idx int, value double")
    known, folder = spark.createDataFrame([("a", "unit")], "coverage_id string, measurement_unit string"), str(tmp_path / "c")
    for _ in range(2):
        got = rasters.publish(cells, folder, known).first()
    assert rasters.read_raster(spark, folder).count() == 6 and (got["min_value"], got["max_value"]) == (1.0, 6.0)
    got = rasters.publish(cells.filter("t = '2024-01-02'").withColumn("value", F.col("value") * 10), folder, known).first()
    assert rasters.read_raster(spark, folder).count() == 6 and (got["min_value"], got["max_value"], str(got["start_date"])) == (1.0, 60.0, "2024-01-01")
