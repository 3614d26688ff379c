"""The arithmetic of format readers, on rows as an opened container would give them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.meteo import PROFILE_LEVELS
from ..operators import nearest, regrid
from ..sources import decode, ground
from .ingest import STAMP, _eea_lines, _show
from .inputs import HAVERSINE, PROFILES, SAMPLES, SWATH, profiles, r6, samples, swath, table
from .registry import query

_AT = STAMP.format


def _raw(fill: float):
    return F.when(F.col("event_id") % 97 != 0, F.col("value")).otherwise(fill)


@query(f"""SELECT event_id, event_id % 10 AS row, {_AT("TIMESTAMP '1900-01-01' + to_hours(1000000 + event_id)")} AS t,
  CASE WHEN event_id % 97 <> 0 THEN round(value * 0.5e0 + 3, 6) END AS value FROM events WHERE event_id % 10 < 9""")
def read_macc(spark, d):
    k = F.col("event_id")
    cells = table(spark, d, "events").select(k, (k % 10).alias("row"), (k + 1_000_000).alias("hours"), _raw(-32767.0).alias("value"))
    return decode.assimilation_column(cells, 10, 0.5, 3.0, -32767.0).select("event_id", "row", _show("t").alias("t"), r6("value").alias("value"))


@query(f"""SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_partkey % 360 > 180 THEN l_partkey % 360 - 360 ELSE l_partkey % 360 END AS DOUBLE) AS lon,
  CAST(CASE WHEN l_suppkey % 100 > 90 THEN l_suppkey % 100 - 180 ELSE l_suppkey % 100 END AS DOUBLE) AS lat, {_AT("TIMESTAMP '2015-06-01' + to_hours(l_linenumber)")} AS t, l_quantity AS value FROM lineitem""")
def read_cams(spark, d):
    cells = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_linenumber").alias("t_idx"), (F.col("l_partkey") % 360).cast("double").alias("lon"), (F.col("l_suppkey") % 100).cast("double").alias("lat"), F.col("l_quantity").alias("value")
    )
    return decode.air_quality_forecast(cells, "2015-06-01").select("l_orderkey", "l_linenumber", "lon", "lat", _show("t").alias("t"), "value")


@query("SELECT l_linenumber AS level_idx, round(greatest(avg((l_quantity * 10 + l_linenumber * 100) / 9.81e0 - l_suppkey % 50), 0), 6) AS height FROM lineitem GROUP BY ALL")
def read_wrfchem(spark, d):
    cells = table(spark, d, "lineitem").select(
        F.col("l_linenumber").alias("level_idx"), (F.col("l_quantity") * 10).alias("ph"), (F.col("l_linenumber") * 100).cast("double").alias("phb"), (F.col("l_suppkey") % 50).cast("double").alias("hgt")
    )
    return decode.model_level_heights(cells, "level_idx").select("level_idx", r6("height").alias("height"))


_LEVELS = ", ".join(f"{p}e0" for p in PROFILE_LEVELS)


@query(f"""WITH p AS (SELECT event_id, event_id % 20 AS level_idx, CASE WHEN event_id % 97 <> 0 THEN 250 + value / 10 END AS t, CAST(240 + event_id % 50 AS DOUBLE) AS td, list_value({_LEVELS})[event_id % 20 + 1] AS hpa FROM events),
h AS (SELECT *, 100 * exp(17.625e0 * (td - 273.15e0) / (243.04e0 + td - 273.15e0)) / exp(17.625e0 * (t - 273.15e0) / (243.04e0 + t - 273.15e0)) AS rh FROM p)
SELECT event_id, level_idx, round(-287.053e0 * 288.15e0 / 9.80665e0 * ln(hpa * 100 / 101325e0), 4) AS height, round(t, 6) AS temperature, CASE WHEN rh <= 200 THEN round(rh, 5) END AS rel_humidity FROM h""")
def read_mod07(spark, d):
    k = F.col("event_id")
    cells = table(spark, d, "events").select(k, (k % 20).alias("level_idx"), F.when(k % 97 != 0, 250 + F.col("value") / 10).otherwise(-1.0).alias("temperature"), (k % 50 + 240).cast("double").alias("dew_point"))
    got = decode.atmospheric_profile(cells)
    return got.select("event_id", "level_idx", F.round("height", 4).alias("height"), r6("temperature").alias("temperature"), F.round("rel_humidity", 5).alias("rel_humidity"))


@query(f"""SELECT event_id, {_AT("TIMESTAMP '2000-01-01' + to_hours(24 * 5000 + event_id * 6)")} AS t, value FROM events""")
def read_evdc(spark, d):
    rows = table(spark, d, "events").select("event_id", (F.col("event_id") * F.lit(0.25) + 5000).alias("days"), "value")
    return decode.station_column(rows).select("event_id", _show("t").alias("t"), "value")


@query(f"""SELECT event_id, event_id // 1500 AS slice, CAST(CASE WHEN event_id % 360 >= 180 THEN event_id % 360 - 360 ELSE event_id % 360 END AS DOUBLE) AS lon,
  {_AT("TIMESTAMP '1950-01-01' + to_hours(24 * (20000 + event_id % 100)) + to_hours(event_id % 24)")} AS t FROM events""")
def read_gome_l2(spark, d):
    k = F.col("event_id")
    rows = table(spark, d, "events").select(k, k.alias("nth"), (k % 360).cast("double").alias("lon"), (k % 100 + 20_000).alias("day"), (k % 24 * 3_600_000).alias("ms"))
    return decode.swath_column(rows).select("event_id", "slice", "lon", _show("t").alias("t"))


@query(f"WITH {SAMPLES} SELECT row, col, count(value) AS hits, round(avg(value), 6) AS value FROM samples WHERE value IS NOT NULL GROUP BY ALL")
def hit_mean(spark, d):
    return decode.hit_mean(samples(spark, d), "row", "col").withColumn("value", r6("value"))


_SWATH_CELLS = """c AS (SELECT event_id // 10 AS line, event_id % 10 AS sample, event_id // 2000 AS slice, CASE WHEN event_id % 997 = 0 THEN -999e0 ELSE CAST(event_id % 90 AS DOUBLE) END AS lat,
  CASE WHEN event_id % 97 <> 0 THEN (value + 10) * 0.5e0 END AS value FROM events),
g AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.slice = c.slice AND b.sample = c.sample AND b.lat = -999))"""


def _monitor(spark, d):
    k = F.col("event_id")
    by_wavelength = F.transform(F.sequence(F.lit(0), F.lit(13)), lambda i: F.when(k % 97 == 0, -1.0).otherwise(F.col("value") + i))
    cells = table(spark, d, "events").select(
        F.floor(k / 10).alias("line"), (k % 10).alias("sample"), F.when(k % 997 == 0, -999.0).otherwise((k % 90).cast("double")).alias("lat"), (k % 180).cast("double").alias("lon"),
        (F.floor(k / 10) * 2).cast("double").alias("seconds"), by_wavelength.alias("value"),
    )
    return decode.ozone_monitor_swath(cells, -1.0, 0.5, -999.0, "AOT451")


@query(f"WITH {_SWATH_CELLS} SELECT line, sample, slice, {_AT('TIMESTAMP %s + to_seconds(line * 2)' % repr('1993-01-01'))} AS t, round(value, 6) AS value FROM g")
def read_aura_l2(spark, d):
    return _monitor(spark, d).select("line", "sample", "slice", _show("t").alias("t"), r6("value").alias("value"))


@query(f"WITH {_SWATH_CELLS} SELECT slice, {_AT('TIMESTAMP %s + to_seconds(min(line) * 2)' % repr('1993-01-01'))} AS t_start, {_AT('TIMESTAMP %s + to_seconds(max(line) * 2)' % repr('1993-01-01'))} AS t_end, round(avg(line) * 2, 3) AS mean_s FROM g GROUP BY slice")
def read_aura_l2_slices(spark, d):
    got = decode.slice_times(_monitor(spark, d))
    mean = F.unix_micros("t_mean") / 1_000_000 - F.unix_seconds(F.lit("1993-01-01").cast("timestamp"))
    return got.select("slice", _show("t_start").alias("t_start"), _show("t_end").alias("t_end"), F.round(mean, 3).alias("mean_s"))


@query("SELECT event_id, CAST(17 - event_id % 18 AS INT) AS row, CASE WHEN event_id % 97 <> 0 THEN round(value, 6) END AS value FROM events")
def read_aura_l3(spark, d):
    cells = table(spark, d, "events").select("event_id", (F.col("event_id") % 18).alias("row"), _raw(-1e30).alias("value"))
    return decode.ozone_monitor_grid(cells, 18, -1e30).select("event_id", "row", r6("value").alias("value"))


@query("SELECT min(user_id * 2.0e0 - 100) AS west, max(user_id % 90 * 1.0e0) AS north, abs(max(user_id * 2.0e0) - min(user_id * 2.0e0)) / 36 AS width, abs(max(user_id % 90) - min(user_id % 90)) / 18.0e0 AS height FROM events")
def read_aura_l3_bounds(spark, d):
    places = table(spark, d, "events").select((F.col("user_id") * 2.0 - 100).alias("lon"), (F.col("user_id") % 90).cast("double").alias("lat"))
    return decode.grid_bounds(places, 18, 36)


_AREA = """m AS (SELECT event_id, event_id % 5 AS kind, CASE WHEN event_id % 5 IN (0, 1) THEN [500, 850, 1000][event_id % 3 + 1] ELSE 0 END AS level, event_id % 18 AS row, value, event_id % 48 AS hours FROM events),
a AS (SELECT *, CASE kind WHEN 0 THEN 'SPECIFICHUMIDITY' WHEN 1 THEN 'TEMPERATUREPROFILE' WHEN 2 THEN 'TEMPERATURESURFACE' WHEN 3 THEN 'SURFACEPRESSURE' END AS product FROM m WHERE kind < 4)"""
_AREA_OUT = f"""SELECT event_id, product, CAST(@row AS INT) AS row, CAST(dense_rank() OVER (PARTITION BY product ORDER BY level DESC) AS INT) AS band, {_AT("TIMESTAMP '2015-06-01 06:00:00' + to_hours(hours)")} AS t,
  round(CASE WHEN kind = 3 THEN value / 100 ELSE value END, 6) AS value, CASE WHEN level = 0 THEN 0 ELSE round(-287.053e0 * 288.15e0 / 9.80665e0 * ln(level * 100 / 101325e0), 4) END AS height FROM a"""


def _area_model(spark, d, file, hours_at: int, turn_rows: int | None):
    k = F.col("event_id")
    kind = (k % 5).cast("int")
    names = F.array(*map(F.lit, ("Specific humidity", "Temperature", "Temperature", "Surface pressure", "Wind")))
    cells = table(spark, d, "events").select(
        k, file.alias("file"), F.get(names, kind).alias("name"), F.when(kind < 2, "isobaricInhPa").otherwise("surface").alias("level_type"), (k % 18).alias("row"), "value",
        F.when(kind < 2, F.get(F.array(*map(F.lit, (500, 850, 1000))), (k % 3).cast("int"))).otherwise(0).alias("level"), F.lit("201506010600").alias("run"),
    )
    got = decode.band_numbers(decode.limited_area_model(cells, hours_at, turn_rows), "product")
    return got.select("event_id", "product", "row", "band", _show("t").alias("t"), r6("value").alias("value"), F.round("height", 4).alias("height"))


@query(f"WITH {_AREA} {_AREA_OUT.replace('@row', '17 - row')}")
def read_alaro(spark, d):
    return _area_model(spark, d, F.concat(F.lit("/in/ALARO_12_"), (F.col("event_id") % 48).cast("string"), F.lit(".grb")), 1, 18)


@query(f"WITH {_AREA} {_AREA_OUT.replace('@row', 'row')}")
def read_arome(spark, d):
    return _area_model(spark, d, F.concat(F.lit("/in/AROME_"), (F.col("event_id") % 48).cast("string"), F.lit("_12.grb")), 0, None)


@query(f"""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'GOME2B' ELSE 'OMI' END AS instrument, CAST(event_id // CASE WHEN event_id % 2 = 0 THEN 1500 ELSE 4000 END AS INT) AS slice,
  {_AT("TIMESTAMP '2015-06-03' + to_hours(event_id % 24) + to_minutes(event_id % 60) + to_seconds(event_id % 50)")} AS t, CASE WHEN event_id % 97 <> 0 THEN round(value, 6) END AS value FROM events""")
def read_bira(spark, d):
    k = F.col("event_id")
    clock = (k % 24) * 10_000_000 + (k % 60) * 100_000 + (k % 50) * 1_000 + k % 1000
    samples_ = table(spark, d, "events").select(k, F.concat(F.when(k % 2 == 0, "GOME2B").otherwise("OMI"), F.lit("-SO2-PBL-20150603_v1.h5")).alias("file"), k.alias("nth"), clock.alias("clock"), _raw(-9999.0).alias("value"))
    return decode.sulphur_kernel_swath(samples_).select("event_id", "instrument", "slice", _show("t").alias("t"), r6("value").alias("value"))


@query(f"""SELECT event_id, {_AT("TIMESTAMP '2015-01-01' + to_hours(24 * (user_id % 300)) + to_hours(user_id % 24) + to_minutes(5)")} AS t, round(0.001e0 * (value - 7), 6) AS value FROM events
  WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 211 = 0)""")
def read_mod04(spark, d):
    k, u = F.col("event_id"), F.col("user_id")
    file = F.concat(F.lit("MOD04_L2.A2015"), F.lpad((u % 300 + 1).cast("string"), 3, "0"), F.lit("."), F.lpad((u % 24).cast("string"), 2, "0"), F.lit("05."), u.cast("string"))
    cells = table(spark, d, "events").select(k, file.alias("file"), F.when(k % 211 == 0, -999.0).otherwise((k % 90).cast("double")).alias("lat"), F.lit(1.0).alias("lon"), "value")
    return decode.radiometer_depth(cells, 0.001, 7.0).select("event_id", _show("t").alias("t"), r6("value").alias("value"))


@query("SELECT event_id, CASE WHEN value BETWEEN 50 AND 400 AND 0.5e0 * (value - 60) >= 0 THEN round(0.5e0 * (value - 60), 6) END AS value FROM events")
def read_mod07_surface(spark, d):
    return decode.radiometer_surface(table(spark, d, "events").select("event_id", "value"), 0.5, 60.0, 50.0, 400.0).withColumn("value", r6("value"))


@query("SELECT event_id, CAST(event_id % 360 - 180 AS DOUBLE) AS lon, CASE WHEN event_id % 97 <> 0 THEN round(value, 6) END AS value FROM events")
def read_osiris(spark, d):
    cells = table(spark, d, "events").select("event_id", (F.col("event_id") % 360).cast("double").alias("lon"), _raw(-9999.0).alias("value"))
    return decode.limb_profiles(cells, -9999.0).select("event_id", "lon", r6("value").alias("value"))


@query("SELECT n_nationkey, n_nationkey * 7 - 80 - 0.5e0 AS north, n_nationkey * 14 - 170 - 0.5e0 AS west, 1.0e0 AS step FROM nation")
def read_scisat(spark, d):
    k = F.col("n_nationkey")
    return decode.occultation_profile(table(spark, d, "nation").select(k, (k * 7 - 80).alias("lat"), (k * 14 - 170).alias("lon"))).select("n_nationkey", "north", "west", "step")


@query(f"""WITH c AS (SELECT event_id, user_id, event_id // 10 % 5 AS line, event_id % 10 AS sample, value, CASE WHEN user_id % 3 > 0 AND event_id % 10 >= 4 + user_id % 5 THEN -9e0 ELSE 1e0 END AS lat FROM events),
e AS (SELECT user_id, coalesce(min(CASE WHEN lat = -9 THEN sample END), max(sample)) AS stop FROM c WHERE line = 0 GROUP BY user_id)
SELECT event_id, {_AT("TIMESTAMP '2018-08-07 22:47:27'")} AS t_start, {_AT("TIMESTAMP '2018-08-07 23:42:11'")} AS t_end, CASE WHEN event_id % 97 <> 0 THEN round(value, 6) END AS value FROM c JOIN e USING (user_id) WHERE sample < stop""")
def read_sentinel(spark, d):
    k, u = F.col("event_id"), F.col("user_id")
    cells = table(spark, d, "events").select(
        k, F.concat(F.lit("S5P_NRTI_L2__SO2____20180807T224727_20180807T234211_"), u.cast("string"), F.lit("_01.nc")).alias("file"), (F.floor(k / 10) % 5).alias("line"), (k % 10).alias("sample"),
        F.when((u % 3 > 0) & (k % 10 >= u % 5 + 4), -9.0).otherwise(1.0).alias("lat"), _raw(-1.0).alias("value"),
    )
    return decode.sulphur_column_swath(cells, -1.0, -9.0).select("event_id", _show("t_start").alias("t_start"), _show("t_end").alias("t_end"), r6("value").alias("value"))


_CHEMISTRY = f"""WITH {SWATH}, tg AS (SELECT i // 4 AS dst_row, i % 4 AS dst_col, 10e0 - (i // 4) * 5 AS lat, -10e0 + (i % 4) * 5 AS lon FROM range(0, 16) t(i)),
n AS (SELECT dst_row, dst_col, src_row, src_col, value, row_number() OVER (PARTITION BY dst_row, dst_col ORDER BY {HAVERSINE}, src_row DESC, src_col DESC) AS nth FROM tg, (SELECT src_row, src_col, lat AS slat, lon AS slon, value FROM swath))"""


@query(f"""{_CHEMISTRY} SELECT CAST(dst_row AS INT) AS dst_row, CAST(dst_col AS INT) AS dst_col, {_AT("TIMESTAMP '2015-06-01' + to_hours(h)")} AS t, CAST(3 - l AS INT) AS band, value + h * 10 + l AS value
  FROM n, (SELECT unnest(range(0, 3)) AS h), (SELECT unnest(range(0, 3)) AS l) WHERE nth = 1""")
def read_wrfchem_fields(spark, d):
    """One map for three hours and three levels."""
    s = swath(spark, d)
    mapping = nearest.nearest_pixels(regrid.target_grid(spark, 10.0, -10.0, 4, 4, 5.0), s).drop("dist_m")
    cube = s.withColumn("h", F.explode(F.array(*map(F.lit, range(3))))).withColumn("level_idx", F.explode(F.array(*map(F.lit, range(3)))))
    cube = cube.select("src_row", "src_col", "level_idx", F.format_string("2015-06-01_%02d:00:59", "h").alias("time"), (F.col("value") + F.col("h") * 10 + F.col("level_idx")).alias("value"))
    return decode.chemistry_field(cube, mapping, 3).withColumn("t", _show("t"))


@query(f"""SELECT 'STATION' || lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS station_code, {_AT("date_trunc('day', ts)")} AS t_start, {_AT("date_trunc('day', ts) + to_seconds(86399)")} AS t_end, 'SO2 Daily Average' AS product,
  round(avg(value), 5) AS value FROM events WHERE event_id % 97 <> 0 GROUP BY 1, date_trunc('day', ts)""")
def read_eea_average(spark, d):
    got = decode.daily_average(ground.parse_air_quality(_eea_lines(spark, d)), "station_code")
    return got.select("station_code", _show("t_start").alias("t_start"), _show("t_end").alias("t_end"), "product", F.round("value", 5).alias("value"))


@query(f"WITH {PROFILES} SELECT vec_id, count(*) AS n_levels, CASE WHEN count(value) = count(*) THEN round(sum(value), 3) END AS total FROM levels GROUP BY vec_id")
def read_lidar(spark, d):
    """Profiles with their sum, the optical depth of an extinction profile."""
    levels = profiles(spark, d).select("vec_id", F.explode(F.arrays_zip("heights", "values")).alias("x")).select("vec_id", F.col("x.heights").alias("height"), F.col("x.values").alias("value"))
    return decode.single_profile(levels, "vec_id").select("vec_id", F.size("levels").cast("long").alias("n_levels"), F.round("total", 3).alias("total"))
