"""Maps between regular grids against the search, swaths on their own grids, ids, events and tiles."""

import math
import random

import pytest
from pyspark.sql import functions as F

from aerocube.functions.geo import haversine_m
from aerocube.operators import align, ground, nearest, regrid, swath
from aerocube.operators.align import Box, Grid
from aerocube.operators.stats import right_distances

PAIRS = [(Grid(90.0, -180.0, 18, 36, 10.0), Box(75.0, -170.0, -65.0, 150.0), 10.0), (Grid(89.5, 100.0, 30, 20, 3.0), Box(90.0, -180.0, 20.0, 180.0), 17.0), (Grid(-60.0, 170.0, 11, 30, 2.5), Box(-55.3, -190.0, -89.7, -110.1), 2.9)]


def searched(spark, grid, box, step):
    pixels = regrid.target_grid(spark, *grid).withColumnsRenamed({"dst_row": "row", "dst_col": "col"})
    pixels = right_distances(pixels, haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))).withColumnsRenamed({"row": "src_row", "col": "src_col"})
    target = regrid.target_grid(spark, box.north, box.west, *regrid.grid_size(*box, step), step)
    return nearest.within_own_threshold(nearest.nearest_pixels(target, pixels), pixels)


def drawn(n):
    rng = random.Random(3)
    for _ in range(n):
        step = rng.uniform(2, 9)
        rows, columns = rng.randint(2, int(150 / step)), rng.randint(2, int(300 / step))
        north = rng.uniform(-80 + rows * step, 89)
        north2, west2 = rng.uniform(-40, 88), rng.uniform(-180, 60)
        yield Grid(north, rng.uniform(-180, 179), rows, columns, step), Box(north2, west2, north2 - rng.uniform(20, 40), west2 + rng.uniform(30, 110)), rng.uniform(2, 6)


@pytest.mark.parametrize(("grid", "box", "step"), [*PAIRS, *drawn(6)])
def test_maps_equal_the_search(spark, grid, box, step):
    rows = lambda df: {(r["dst_row"], r["dst_col"]): (r["src_row"], r["src_col"], round(r["dist_m"], 3)) for r in df.collect()}
    got, want = rows(align.grid_map(spark, grid, box, step)), rows(searched(spark, grid, box, step))
    # next to a pole pixels of a row coincide: there the distance tells, not the column
    assert got.keys() == want.keys() and all(got[k] == v or (got[k][2] == v[2] and abs(grid.north - v[0] * grid.step) > 89.9) for k, v in want.items())


def plain_distance(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    x = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6372795.477598 * math.atan2(math.sqrt(x), math.sqrt(max(1 - x, 0)))


def test_swaths_anywhere(spark):
    """Each group on its own grid: across the date line, at a pole, a single pixel, none with a place."""
    rng = random.Random(4)
    rows = [("line", 0, i, rng.uniform(-3, 3), (178 + rng.uniform(0, 4) + 180) % 360 - 180) for i in range(60)]
    rows += [("pole", 0, i, rng.uniform(84, 90), rng.uniform(-180, 180)) for i in range(80)]
    rows += [("one", 0, 0, 5.0, 5.0), ("lost", 0, 0, None, 5.0), (None, 0, 0, 1.0, 1.0)]
    s = spark.createDataFrame(rows, "k string, src_row int, src_col int, lat double, lon double").repartition(3)
    step = F.when(F.col("k") == "pole", 1.5).otherwise(0.5)
    grids = swath.own_grids(s, ["k"], step, F.when(F.col("k") == "line", 60_000.0).otherwise(200_000.0))
    got = {(r["k"], r["dst_row"], r["dst_col"]): (r["src_col"], round(r["dist_m"], 4)) for r in swath.nearest_in_reach(s, grids, ["k"]).collect()}
    want = {}
    for g in grids.filter("k is not null").collect():
        own = [r for r in rows if r[0] == g["k"] and r[3] is not None]
        for y in range(g["rows"]):
            for x in range(g["columns"]):
                d, c = min((plain_distance(g["north"] - y * g["step"], g["west"] + x * g["step"], r[3], r[4]), -r[2]) for r in own)
                if d < g["reach_m"]:
                    want[g["k"], y, x] = (-c, round(d, 4))
    assert got == want and {k for k, _, _ in want} == {"line", "pole"} and len(want) > 300
    assert swath.pixels(grids.filter("k is not null"), ["k"]).count() == sum(g["rows"] * g["columns"] for g in grids.filter("k is not null").collect())


def test_ids_without_gaps(spark):
    """The same for any order and partitions of the input, after the ids given, without gaps; known keys have none."""
    keys = [f"key {i * 7919 % 5000}" for i in range(5000)]
    df = spark.createDataFrame([(k,) for k in [*keys, *keys[:100]]] + [(None,)], "name string")
    known = spark.createDataFrame([("key 5",), ("key 7",)], "name string")
    got = {r["name"]: r["id"] for r in ground.new_dimension_rows(df.repartition(7), known, "name", 50).collect()}
    assert sorted(got.values()) == list(range(51, 51 + 4998)) and "key 5" not in got
    assert got == {r["name"]: r["id"] for r in ground.new_dimension_rows(df.orderBy("name"), known, "name", 50).collect()}


def test_crowded_sources(spark):
    """A third of all sources within a degree: cells are divided until none has many; the nearest is exact anywhere."""
    rng = random.Random(6)
    places = [(40 + rng.random(), 8 + rng.random()) for _ in range(20_000)] + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    source = spark.createDataFrame([(0, i, *p) for i, p in enumerate(places)], "src_row int, src_col int, lat double, lon double")
    finest, depth = nearest._cells_of(source)
    assert nearest._level(finest, depth).agg(F.max("n")).first()[0] <= nearest.LEAF and finest.agg(F.sum("n")).first()[0] == len(places)
    assert nearest._level(finest, depth - nearest.STRIDE).agg(F.max("n")).first()[0] > nearest.LEAF
    targets = [(40 + rng.random(), 8 + rng.random()) for _ in range(30)] + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(30)] + [(90.0, 0.0), (-90.0, 5.0), (0.0, 180.0)]
    got = nearest.nearest_pixels(spark.createDataFrame([(0, i, *t) for i, t in enumerate(targets)], "dst_row int, dst_col int, lat double, lon double"), source)
    want = {i: min(plain_distance(*t, *p) for p in places) for i, t in enumerate(targets)}
    assert {r["dst_col"]: round(r["dist_m"], 4) for r in got.collect()} == {i: round(d, 4) for i, d in want.items()}
    copies = spark.createDataFrame([(0, i, 1.0, 1.0) for i in range(100)], "src_row int, src_col int, lat double, lon double")
    assert nearest._cells_of(copies)[1] == nearest.DEEPEST
    assert nearest.nearest_pixels(spark.createDataFrame([(0, 0, 1.0, 2.0)], "dst_row int, dst_col int, lat double, lon double"), copies).first()["src_col"] == 99


def test_dense_matchups(spark):
    """The same as the matchup by samples, on samples that stand at cells' edges too."""
    import datetime as dt

    from aerocube.operators import matchup

    rng, begin = random.Random(8), dt.datetime(2024, 1, 1)
    cover = [(begin + dt.timedelta(minutes=rng.randrange(0, 600)), rng.choice((rng.uniform(-4, 4), rng.randrange(-16, 17) / 4)), rng.choice((rng.uniform(-4, 4), rng.randrange(-16, 17) / 4)), None if i % 50 == 0 else float(rng.randrange(100))) for i in range(3000)]
    obs = [(i, begin + dt.timedelta(minutes=rng.randrange(0, 600)), rng.choice((rng.uniform(-5, 5), float(rng.randrange(-4, 5)))), rng.uniform(-5, 5), None if i % 9 == 0 else 1.0 * i) for i in range(60)] + [(60, begin, 100.0, 0.0, 1.0)]
    c = spark.createDataFrame(cover, "t timestamp, lon double, lat double, value double")
    o = spark.createDataFrame([(i, t, t + dt.timedelta(minutes=i % 3 * 20), lon, lat, v) for i, t, lon, lat, v in obs], "obs_id int, t_start timestamp, t_end timestamp, lon double, lat double, value double")
    shown = lambda df: sorted((r["obs_id"], r["n"], r["ground"], None if r["cover"] is None else round(r["cover"], 9)) for r in df.collect())
    for degrees, minutes in ((1.0, 60.0), (2.5, 45.0)):
        got, want = shown(matchup.dense_matchup(o, c, degrees, minutes)), shown(matchup.ground_coverage_matchup(o, c, degrees, minutes))
        assert got == want and len(got) > 40
