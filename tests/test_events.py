"""Event sequences in batches and streams, fan-out with a sink that fails, uploads with several outputs, tiles and UTM rasters."""

import datetime as dt
import math
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from aerocube.operators import catalog, pyramid, utm
from aerocube.streaming import ingest

BEGIN = dt.datetime(2024, 1, 1)


def plain_fold(events):
    table = {(a, e): b for a, e, b in catalog.TRANSITIONS}
    status, path, rejected = "uploading", [("uploading", None)], []
    for t, e in sorted(set(events)):
        if to := table.get((status, e)):
            status = to
            path.append((to, t))
        else:
            rejected.append((t, e))
    return status, path, rejected


def shown(rows):
    return {r["id"]: (r["status"], [(p["status"], p["since"]) for p in r["path"]], [(x["t"], x["event"]) for x in r["rejected"]]) for r in rows}


def test_event_sequences(spark, tmp_path):
    """0 to 10 events an item, out of order and repeated; files that arrive one after the other give what one batch does."""
    rng = random.Random(2)
    names = [e for _, e, _ in catalog.TRANSITIONS]
    events = {i: [(BEGIN + dt.timedelta(minutes=rng.randrange(60)), rng.choice(names[:7] + ["fetched", "converted"])) for _ in range(i % 11)] for i in range(60)}
    rows = [(i, t, e) for i, own in events.items() for t, e in own]
    rows += rng.sample(rows, 40) + [(1, None, "fetched"), (2, BEGIN, None)]
    rng.shuffle(rows)
    items = spark.createDataFrame([(i, "uploading") for i in range(60)], "id long, status string")
    schema = "id long, t timestamp, event string"
    got = shown(catalog.follow(items, spark.createDataFrame(rows, schema)).collect())
    assert got == {i: plain_fold(own) for i, own in events.items()}
    for part in range(3):
        spark.createDataFrame(rows[part::3], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        ingest.append_new(stream, str(tmp_path / "store"), str(tmp_path / "state"), ["id", "t", "event"], "t").awaitTermination()
    assert shown(catalog.follow(items, ingest.stored(spark, str(tmp_path / "store"))).collect()) == got
    one = catalog.follow(items, spark.createDataFrame([(1, BEGIN, "fetched"), (1, BEGIN + dt.timedelta(seconds=90), "converted")], schema)).filter("id = 1").first()
    assert [p["seconds"] for p in one["path"]] == [None, 90, None]


def test_fan_out_fails_between_sinks(spark, tmp_path, monkeypatch):
    """The batch is written anew as a whole; what the failed attempt left isn't seen; a rerun after the entry changes nothing."""
    spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "kind string, v int").coalesce(1).write.parquet(str(tmp_path / "in"))
    sinks, ledger = {k: str(tmp_path / k) for k in "ab"}, str(tmp_path / "ledger")
    run = lambda state="state": ingest.fan_out(spark.readStream.schema("kind string, v int").parquet(str(tmp_path / "in")), "kind", sinks, ledger, str(tmp_path / state)).awaitTermination()
    write = DataFrameWriter.parquet

    def failing(self, path, *rest, **more):
        if f"{tmp_path}/b/" in path:
            raise OSError("the second sink is gone")
        return write(self, path, *rest, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)
    with pytest.raises(StreamingQueryException):
        run()
    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    assert spark.read.parquet(sinks["a"]).count() == 1 and not (tmp_path / "ledger").exists()
    run()
    assert spark.read.parquet(sinks["a"]).count() == 2  # the failed attempt's too
    seen = {k: [r["v"] for r in ingest.fanned(spark, folder, ledger).collect()] for k, folder in sinks.items()}
    assert seen == {"a": [1], "b": [2]}
    entry = next(p for p in (tmp_path / "ledger").iterdir() if not p.name.startswith((".", "_")))
    ingest._commit(spark, ledger, entry.name, "another")  # a writer that comes late
    assert seen == {k: [r["v"] for r in ingest.fanned(spark, folder, ledger).collect()] for k, folder in sinks.items()}
    for f in (tmp_path / "state" / "commits").iterdir():  # as if the driver died before the batch was marked as done
        f.unlink()
    run()
    assert spark.read.parquet(sinks["a"]).count() == 2
    run("other")
    assert ingest.fanned(spark, sinks["a"], ledger).count() == 2


def test_uploads_with_several_outputs(spark):
    uploads = spark.createDataFrame([(1, "n1", "c", "/u", "processed"), (2, "n2", "c", "/u", "processed"), (3, "n3", "c", "/u", "processed")], "id long, name string, coverage_id string, location string, status string")
    outputs = spark.createDataFrame([(1, "a_b_v_t", "/x"), (2, "a_b_v_t", "/x"), (2, "d_e_v_t", "/y"), (2, "d_e_v_t", "/y"), (9, "z_z_z_z", "/z")], "id long, coverage_id string, location string")
    got = sorted(map(tuple, catalog.fan_rows(uploads, outputs, 100, "done").collect()))
    assert got == [(1, "n1", "a_b_v_t", "/x", "done"), (2, "n2 d_e", "d_e_v_t", "/y", "done"), (3, "n3", "c", "/u", "processed"), (101, "n2 a_b", "a_b_v_t", "/x", "done")]


def test_tiles_hold_their_pixels(spark, tmp_path):
    """From cells to tiles and back is the identity; coarser pixels are means of all values below; empty tiles don't exist."""
    rng = random.Random(5)
    cells = {(rng.randrange(40), rng.randrange(70)): (rng.uniform(-5, 5), rng.randrange(1, 4)) for _ in range(300)} | {(1000, 2000): (7.0, 1)}
    df = spark.createDataFrame([("k", r, c, *v) for (r, c), v in cells.items()] + [("k", 3, 3000, None, 1), ("k", 4, 4000, 1.0, 0)], "k string, row int, col int, total double, count int")
    pyramid.build(df, str(tmp_path / "p"), ["k"], 4, 8)
    tiles = pyramid.values(pyramid.read(spark, str(tmp_path / "p")))
    for level in range(4):
        want = {}
        for (r, c), (t, n) in cells.items():
            key = (r >> level, c >> level)
            want[key] = (want.get(key, (0, 0))[0] + t, want.get(key, (0, 0))[1] + n)
        own = tiles.filter(F.col("level") == level)
        got = {(r["row"], r["col"]): (r["total"], r["count"]) for r in pyramid.unpack(own, ["k"], 8).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[x][0], want[x][0], abs_tol=1e-9) and got[x][1] == want[x][1] for x in want)
        rows = own.collect()
        assert {(t["tile_row"], t["tile_col"]) for t in rows} == {(r // 8, c // 8) for r, c in want} and all(len(t["pixels"]) == 64 for t in rows)
        assert all((t["pixels"][i] is not None) == ((t["tile_row"] * 8 + i // 8, t["tile_col"] * 8 + i % 8) in want) for t in rows for i in range(64))


def test_utm_edges(spark):
    """Pixels at a zone's edge find a nearer point of the zone beside it only if asked to look across; also over the date line."""
    points = [(0, 0, 45.0, 5.985, 1.0), (0, 1, 45.0, 6.015, 2.0), (1, 0, 45.06, 5.9, 3.0), (1, 1, 45.06, 6.001, 4.0), (2, 0, 44.9, 5.9, 5.0), (2, 1, 44.9, 6.1, 6.0), (3, 0, None, 1.0, 9.0)]
    df = spark.createDataFrame(points, "row int, col int, lat double, lon double, value double")
    alone, across = (utm.utm_rasters(df, 20_000.0, across=x).collect() for x in (False, True))
    assert len(alone) == len(across) > 10 and {r["zone"] for r in alone} == {31, 32}
    assert {r["value"] for r in alone if r["zone"] == 31} <= {1.0, 3.0, 5.0, None} and {r["value"] for r in across if r["zone"] == 31} & {2.0, 4.0, 6.0}
    turned = [(0, i, 10.0, 179.96 + 0.005 * i, 1.0) for i in range(4)] + [(1, 0, 10.1, 179.9, 3.0), (1, 1, 10.1, 179.905, 3.0), (1, 2, 10.1, 180.001, 4.0)]
    got = utm.utm_rasters(spark.createDataFrame(turned, "row int, col int, lat double, lon double, value double"), 50_000.0, across=True).collect()
    assert {r["value"] for r in got if r["zone"] == 60} & {2.0, 4.0}
    assert utm.utm_rasters(df.filter("1 = 0"), 1.0).count() == 0
