"""Per-value expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, meteo, times, values
from .inputs import HAVERSINE, r6, table
from .registry import query

LINE = ["l_orderkey", "l_linenumber"]
#: Distinct places up to which what is worked out for them is broadcast.
PLACES = 200_000


def _lines(spark, d):
    return table(spark, d, "lineitem")


def _on_lines(spark, d, **columns):
    return _lines(spark, d).select(*LINE, *[c.alias(n) for n, c in columns.items()])


def _sql(**columns: str) -> str:
    return f"SELECT l_orderkey, l_linenumber, {', '.join(f'{c} AS {n}' for n, c in columns.items())} FROM lineitem"


Q = "CAST(l_quantity AS DOUBLE)"


@query(_sql(v=f"CASE WHEN {Q} <> 17 THEN {Q} END"))
def mask_equal(spark, d):
    return _on_lines(spark, d, v=values.mask_equal(F.col("l_quantity"), 17))


@query(_sql(v=f"CASE WHEN {Q} BETWEEN 10 AND 40 THEN {Q} END"))
def mask_outside(spark, d):
    return _on_lines(spark, d, v=values.mask_outside(F.col("l_quantity"), 10, 40))


@query(_sql(v=f"CASE WHEN {Q} - 25 >= 0 THEN {Q} - 25 END"))
def mask_negative(spark, d):
    return _on_lines(spark, d, v=values.mask_negative(F.col("l_quantity") - 25))


@query(_sql(v=f"CASE WHEN {Q} * 10 <= 200 THEN {Q} * 10 END"))
def mask_gt(spark, d):
    return _on_lines(spark, d, v=values.mask_above(F.col("l_quantity") * 10, 200))


@query("SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS v FROM lineitem WHERE l_quantity <> 17")
def drop_sentinel(spark, d):
    return mask_equal(spark, d).filter("v is not null")


@query(_sql(v=f"({Q} + 2) * 4"))
def unit_conversion(spark, d):
    return _on_lines(spark, d, v=values.unit_conversion(F.col("l_quantity"), 4, 2))


@query(_sql(a=f"round({Q} * 0.5e0 + 3, 6)", b=f"round(0.5e0 * ({Q} - 3), 6)"))
def scale_offset(spark, d):
    q = F.col("l_quantity")
    return _on_lines(spark, d, a=r6(values.scale_then_offset(q, 0.5, 3)), b=r6(values.offset_then_scale(q, 0.5, 3)))


@query(_sql(lon="CASE WHEN l_partkey % 360 > 180 THEN l_partkey % 360 - 360 ELSE l_partkey % 360 END", lat="CASE WHEN l_suppkey % 180 > 90 THEN l_suppkey % 180 - 180 ELSE l_suppkey % 180 END"))
def lon_wrap(spark, d):
    return _on_lines(spark, d, lon=values.lon_wrap(F.col("l_partkey") % 360), lat=values.lat_wrap(F.col("l_suppkey") % 180))


@query("SELECT event_id, round(value * 3.2e0, 6) AS v FROM events")
def concentration_scale(spark, d):
    return table(spark, d, "events").select("event_id", r6(values.concentration_scale(F.col("value"))).alias("v"))


_DAY = "strftime({}, '%Y-%m-%d %H:%M:%S')"


@query(
    f"""SELECT event_id, {_DAY.format("TIMESTAMP '1993-01-01' + to_seconds(event_id * 86)")} AS tai, {_DAY.format("TIMESTAMP '1900-01-01' + to_hours(event_id)")} AS h1900,
  {_DAY.format("TIMESTAMP '2000-01-01' + to_seconds(event_id * 21600)")} AS mjd, {_DAY.format("TIMESTAMP '1950-01-01' + to_days(CAST(event_id % 20000 AS INT)) + to_seconds(event_id % 86400)")} AS d1950,
  strftime(DATE '2015-01-01' + CAST(event_id % 365 AS INT), '%Y-%m-%d') AS yday FROM events"""
)
def epoch_decode(spark, d):
    e = F.col("event_id")
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    day = F.concat(F.lit("2015"), F.lpad((e % 365 + 1).cast("string"), 3, "0"))
    return table(spark, d, "events").select(
        "event_id", show(times.tai93(e * 86)).alias("tai"), show(times.hours_since_1900(e)).alias("h1900"), show(times.mjd2000(e / 4)).alias("mjd"),
        show(times.day_1950(e % 20000, e % 86400 * 1000)).alias("d1950"), F.date_format(times.year_day(day), "yyyy-MM-dd").alias("yday"),
    )


@query("SELECT event_id, round((event_id % 24) * 3600 + (event_id % 60) * 60 + event_id % 59 + (event_id % 1000) / 1000e0, 6) AS s, round((event_id % 1000) / 1000e0 * 24, 6) AS h FROM events")
def clock_decode(spark, d):
    e = F.col("event_id")
    stamp = ((e % 24) * 100 + e % 60) * 100 + e % 59
    return table(spark, d, "events").select("event_id", r6(times.clock_ms(stamp * 1000 + e % 1000)).alias("s"), r6(times.day_fraction_hours(e % 1000 / 1000 + 7)).alias("h"))


@query("SELECT event_id, round((86000 + (event_id % 200) * 1000 / 200e0) % 86400, 6) AS s FROM events")
def line_time(spark, d):
    return table(spark, d, "events").select("event_id", r6(times.line_time(F.lit(86000.0), F.lit(600.0), F.col("event_id") % 200, F.lit(200))).alias("s"))


@query("SELECT o_orderkey, 'X' || o_orderkey || '_2D_20150101.120000.tif' AS name FROM orders")
def label_filename(spark, d):
    name = F.concat(F.lit("X"), F.col("o_orderkey").cast("string"), F.lit("_20150101.120000.tif"))
    return table(spark, d, "orders").select("o_orderkey", values.label_filename(name, "2D").alias("name"))


@query("SELECT o_orderkey, 'SO2_' || o_orderkey AS dir FROM orders")
def coverage_dir(spark, d):
    name = F.concat(F.lit("SO2_"), F.col("o_orderkey").cast("string"), F.lit("_v1_tif"))
    return table(spark, d, "orders").select("o_orderkey", values.coverage_dir(name).alias("dir"))


@query("SELECT o_orderkey, 'convert' AS f, CAST(o_orderkey % 7 AS DOUBLE) AS gain, CAST(o_orderkey % 5 AS DOUBLE) AS off FROM orders")
def parse_options(spark, d):
    k = F.col("o_orderkey")
    text = F.concat(F.lit("function=convert;label=x;gain="), (k % 7).cast("string"), F.lit(";offset="), (k % 5).cast("string"))
    m = values.parse_options(text)
    return table(spark, d, "orders").select("o_orderkey", m["function"].alias("f"), m["gain"].cast("double").alias("gain"), m["offset"].cast("double").alias("off"))


@query("SELECT o_orderkey, CAST(o_orderkey % 24 AS INT) AS hour, strftime(DATE '2015-01-01' + CAST(o_orderkey % 28 AS INT), '%Y%m%d') AS day FROM orders")
def filename_fields(spark, d):
    k = F.col("o_orderkey")
    name = F.concat(F.lit("ALARO_"), F.date_format(F.date_add(F.lit("2015-01-01").cast("date"), (k % 28).cast("int")), "yyyyMMdd"), F.lit("_+"), F.lpad((k % 24).cast("string"), 3, "0"), F.lit(".grb"))
    return table(spark, d, "orders").select("o_orderkey", values.filename_hours(name).alias("hour"), values.filename_day(name).alias("day"))


@query("SELECT event_id, CAST(event_id AS DOUBLE) AS a, CAST(event_id % 10 AS DOUBLE) AS b, CAST(-user_id AS DOUBLE) AS c FROM events")
def vec_split(spark, d):
    e = F.col("event_id")
    text = F.concat(F.lit("{"), F.concat_ws(";", e.cast("string"), (e % 10).cast("string"), (-F.col("user_id")).cast("string")), F.lit("}"))
    v = values.vector_field(text)
    return table(spark, d, "events").select("event_id", F.get(v, 0).alias("a"), F.get(v, 1).alias("b"), F.get(v, 2).alias("c"))


P = "(l_quantity * 20)"
BARO = "CASE WHEN {0} = 0 THEN 0 ELSE -287.053e0 * 288.15e0 / 9.80665e0 * ln({0} * 100 / 101325e0) END"


@query(_sql(h=f"round({BARO.format(P)}, 6)"))
def baro_height(spark, d):
    return _on_lines(spark, d, h=r6(meteo.baro_height(F.col("l_quantity") * 20)))


@query(_sql(h=f"round((1 - power({P} / 1013.25e0, 0.190284e0)) * 145366.45e0 * 0.3048e0, 6)"))
def std_atm_altitude(spark, d):
    return _on_lines(spark, d, h=r6(meteo.std_atm_altitude(F.col("l_quantity") * 20)))


@query(f"SELECT event_id, CAST(event_id % 20 AS INT) AS level, round({BARO.format('p')}, 6) AS h FROM (SELECT event_id, [5, 10, 20, 30, 50, 70, 100, 150, 200, 250, 300, 400, 500, 620, 700, 780, 850, 920, 950, 1000][event_id % 20 + 1] AS p FROM events)")
def mod07_levels(spark, d):
    level = (F.col("event_id") % 20).cast("int")
    return table(spark, d, "events").select("event_id", level.alias("level"), r6(F.get(meteo.profile_heights(), level)).alias("h"))


@query(_sql(h="round((l_extendedprice + l_quantity * 100) / 9.81e0 - l_tax * 1000, 4)"))
def wrf_height(spark, d):
    return _on_lines(spark, d, h=F.round(meteo.wrf_height(F.col("l_extendedprice"), F.col("l_quantity") * 100, F.col("l_tax") * 1000), 4))


_SAT = "exp(17.625e0 * ({0} - 273.15e0) / (243.04e0 + {0} - 273.15e0))"
_RH = f"100 * {_SAT.format('(260 + l_quantity)')} / {_SAT.format('(270 + l_linenumber * 5)')}"


@query(_sql(rh=f"CASE WHEN {_RH} <= 200 THEN round({_RH}, 6) END"))
def rel_humidity(spark, d):
    return _on_lines(spark, d, rh=r6(meteo.rel_humidity(260 + F.col("l_quantity"), (270 + F.col("l_linenumber") * 5).cast("double"))))


@query(f"SELECT l_linenumber, round(min(x), 9) AS lo, round(max(x), 9) AS hi FROM (SELECT l_linenumber, 0.622e0 * e / (1000 - 0.378e0 * e) AS x FROM (SELECT l_linenumber, 6.1094e0 * {_SAT.format('(260 + l_quantity)')} AS e FROM lineitem)) GROUP BY l_linenumber")
def specific_humidity_range(spark, d):
    x = meteo.specific_humidity(260 + F.col("l_quantity"), F.lit(1000.0))
    return _lines(spark, d).groupBy("l_linenumber").agg(F.round(F.min(x), 9).alias("lo"), F.round(F.max(x), 9).alias("hi"))


_NEXT = "lead({0}) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber)"


@query(
    f"""SELECT l_orderkey, l_linenumber, round(p, 6) AS p FROM (SELECT *, (l_quantity + {_NEXT.format("l_quantity")}) * 0.5e0
  + (l_tax + {_NEXT.format("l_tax")}) * 0.5e0 * 1013.25e0 AS p FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity, l_tax, l_partkey, l_suppkey) = 1)) WHERE p IS NOT NULL"""
)
def hybrid_pressure(spark, d):
    got = meteo.hybrid_pressure(_layers(spark, d).withColumn("p0", F.lit(1013.25)), ["l_orderkey"], "l_linenumber", "l_quantity", "l_tax", "p0")
    return got.select(*LINE, r6("pressure").alias("p"))


def _layers(spark, d):
    """One line item per order and line number."""
    best = F.min(F.struct("l_quantity", "l_tax", "l_partkey", "l_suppkey")).alias("b")
    # dealt by order at once, so that the windows by order need no shuffle of their own
    return _lines(spark, d).repartition("l_orderkey").groupBy(*LINE).agg(best).select(*LINE, "b.*")


@query(
    """WITH x AS (SELECT l_orderkey, l_linenumber, 200 + l_quantity AS t, l_linenumber * 100 + l_tax AS p FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity, l_tax, l_partkey, l_suppkey) = 1),
y AS (SELECT *, lag(t) OVER w AS t2, lag(p) OVER w AS p2 FROM x WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber DESC))
SELECT l_orderkey, l_linenumber, round(sum(CASE WHEN t2 IS NULL THEN 50 + t * ln(1013.25e0 / p) * 287.053e0 / 9.80665e0 ELSE 0.5e0 * (t2 + t) * ln(p2 / p) * 287.053e0 / 9.80665e0 END)
  OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC), 4) AS h FROM y"""
)
def hypsometric_height(spark, d):
    rows = _layers(spark, d).select(*LINE, (200 + F.col("l_quantity")).alias("t"), (F.col("l_linenumber") * 100 + F.col("l_tax")).alias("p"), F.lit(1013.25).alias("p0"), F.lit(50.0).alias("z"))
    return meteo.hypsometric_height(rows, ["l_orderkey"], "l_linenumber", "t", "p", "p0", "z").select(*LINE, F.round("height", 4).alias("h"))




def _at():
    return (F.col("l_suppkey") % 160 - 80).cast("double"), (F.col("l_partkey") % 340 - 170).cast("double")


SLAT, SLON = "CAST(l_suppkey % 160 - 80 AS DOUBLE)", "CAST(l_partkey % 340 - 170 AS DOUBLE)"


@query(f"SELECT l_orderkey, l_linenumber, round({HAVERSINE}, 3) AS m FROM (SELECT l_orderkey, l_linenumber, {SLAT} AS lat, {SLON} AS lon, CAST(10 AS DOUBLE) AS slat, CAST(20 AS DOUBLE) AS slon FROM lineitem)")
def haversine_m(spark, d):
    lat, lon = _at()
    return _on_lines(spark, d, m=F.round(geo.haversine_m(lat, lon, F.lit(10.0), F.lit(20.0)), 3))


_VINCENTY = f"""WITH RECURSIVE u AS (SELECT DISTINCT {SLAT} AS lat, {SLON} AS lon FROM lineitem),
c AS (SELECT lat, lon, 1 / 298.257223563e0 AS f, 6378137e0 AS a, 6378137e0 * (1 - 1 / 298.257223563e0) AS b, radians(20e0 - lon) AS l,
  atan((1 - 1 / 298.257223563e0) * tan(radians(lat))) AS u1, atan((1 - 1 / 298.257223563e0) * tan(radians(10e0))) AS u2 FROM u),
it AS (SELECT lat, lon, 0 AS k, l AS lam, 1e0 AS moved FROM c UNION ALL
  SELECT lat, lon, k + 1, nxt, abs(nxt - lam) FROM (SELECT lat, lon, k, lam, l + (1 - cc) * f * az * (arc + cc * y * (mid + cc * x * (2 * mid * mid - 1))) AS nxt FROM (
    SELECT *, f / 16 * c2 * (4 + f * (4 - 3 * c2)) AS cc FROM (SELECT *, coalesce(x - 2 * sin(u1) * sin(u2) / nullif(c2, 0), 0) AS mid FROM (SELECT *, 1 - az * az AS c2 FROM (
      SELECT *, coalesce(cos(u1) * cos(u2) * sin(lam) / nullif(y, 0), 0) AS az, atan2(y, x) AS arc FROM (SELECT it.k, it.lam, c.*,
        sqrt(power(cos(u2) * sin(lam), 2) + power(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS y, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS x FROM it JOIN c USING (lat, lon) WHERE k < 20))))))),
m AS (SELECT lat, lon, CASE WHEN moved < 1e-9 THEN floor(b * big * (arc - small * y * (mid + small / 4 * (x * (2 * mid * mid - 1) - small / 6 * mid * (4 * y * y - 3) * (4 * mid * mid - 3)))) * 1000) / 1000 END AS m FROM (
  SELECT *, 1 + w / 16384 * (4096 + w * (w * (320 - 175 * w) - 768)) AS big, w / 1024 * (256 + w * (w * (74 - 47 * w) - 128)) AS small FROM (SELECT *, c2 * (a * a - b * b) / (b * b) AS w FROM (
    SELECT *, coalesce(x - 2 * sin(u1) * sin(u2) / nullif(c2, 0), 0) AS mid FROM (SELECT *, 1 - az * az AS c2 FROM (SELECT *, coalesce(cos(u1) * cos(u2) * sin(lam) / nullif(y, 0), 0) AS az, atan2(y, x) AS arc FROM (
      SELECT it.lam, it.moved, c.*, sqrt(power(cos(u2) * sin(lam), 2) + power(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS y, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS x FROM it JOIN c USING (lat, lon) WHERE k = 20)))))))
SELECT l_orderkey, l_linenumber, m FROM lineitem JOIN m ON lat = {SLAT} AND lon = {SLON}"""


@query(_VINCENTY)
def vincenty_m(spark, d):
    lat, lon = _at()
    rows = _on_lines(spark, d, lat=lat, lon=lon)
    places = rows.select("lat", "lon").distinct()
    metres = places.withColumn("m", geo.vincenty_m(F.col("lat"), F.col("lon"), F.lit(10.0), F.lit(20.0)))
    metres = F.broadcast(metres) if places.limit(PLACES + 1).count() <= PLACES else metres
    return rows.join(metres, ["lat", "lon"], "left").select(*LINE, "m")


@query(_sql(deg=f"round((degrees(atan2(sin(radians(20 - {SLON})) * cos(radians(10)), cos(radians({SLAT})) * sin(radians(10)) - sin(radians({SLAT})) * cos(radians(10)) * cos(radians(20 - {SLON})))) + 360) % 360, 6)"))
def bearing_deg(spark, d):
    lat, lon = _at()
    return _on_lines(spark, d, deg=r6(geo.bearing_deg(lat, lon, F.lit(10.0), F.lit(20.0)) % 360))


@query(_sql(lat="round(90 - (l_suppkey % 1080 + 0.5e0) / 6, 6)", lon="round(180 / round_even(1080 * cos(radians(90 - (l_suppkey % 1080 + 0.5e0) / 6)), 0) * (l_partkey % 2160 - 1079.5e0), 6)"))
def sinusoidal_latlon(spark, d):
    line, column = F.col("l_suppkey") % 1080 + 1, F.col("l_partkey") % 2160 + 1
    return _on_lines(spark, d, lat=r6(geo.sinusoidal_lat(line)), lon=r6(geo.sinusoidal_lon(line, column)))


_ZONE = f"CAST(CASE WHEN {SLON} < 0 THEN trunc((180 + {SLON}) / 6) + 1 ELSE trunc({SLON} / 6) + 31 END AS INT)"


def utm_sql(rows: str) -> str:
    """rows (lat, lon, ...) with zone, east and north."""
    return f"""SELECT *, 0.9996e0 * nu * (d * cos(phi) + power(d * cos(phi), 3) / 6 * (1 - t + c)) + 500000 AS east,
  0.9996e0 * (6378137e0 * (1 - n) * (1 - n * n) * (1 + 9 * n * n / 4 + 225 * power(n, 4) / 64) * (phi - (3 * n / 2 - 9 * power(n, 3) / 16) * sin(2 * phi) + (15 * n * n / 16 - 15 * power(n, 4) / 32) * sin(4 * phi)
    - 35 * power(n, 3) / 48 * sin(6 * phi) + 315 * power(n, 4) / 512 * sin(8 * phi)) + nu * sin(phi) * cos(phi) * d * d / 2 + nu * sin(phi) * power(cos(phi), 3) * power(d, 4) / 24 * (5 - t + 9 * c + 4 * c * c)) AS north
FROM (SELECT *, 6378137e0 / sqrt(1 - e2 * power(sin(phi), 2)) AS nu, power(tan(phi), 2) AS t, e2 / (1 - e2) * power(cos(phi), 2) AS c, radians(lon - (6 * zone - 183)) AS d
  FROM (SELECT *, radians(lat) AS phi, f * (2 - f) AS e2, f / (2 - f) AS n FROM (SELECT *, 1 / 298.257223563e0 AS f, CAST(CASE WHEN lon < 0 THEN trunc((180 + lon) / 6) + 1 ELSE trunc(lon / 6) + 31 END AS INT) AS zone FROM ({rows}))))"""


@query(f"SELECT l_orderkey, l_linenumber, round(east, 3) AS east, round(north, 3) AS north FROM ({utm_sql(f'SELECT l_orderkey, l_linenumber, {SLAT} AS lat, {SLON} AS lon FROM lineitem')})")
def utm_forward(spark, d):
    lat, lon = _at()
    east, north = geo.utm_forward(lat, lon)
    return _on_lines(spark, d, east=F.round(east, 3), north=F.round(north, 3))


@query(_sql(zone=_ZONE, band="CASE " + " ".join(f"WHEN {SLAT} >= {s} THEN '{b}'" for b, s in reversed(geo.SOUTH_BANDS + geo.NORTH_BANDS)) + " END", south=f"CASE WHEN {SLAT} < 0 THEN 'S' ELSE 'N' END"))
def utm_lon_zone(spark, d):
    lat, lon = _at()
    return _on_lines(spark, d, zone=geo.utm_zone(lon), band=geo.lat_band(lat), south=geo.hemisphere(geo.lat_band(lat)))


@query(
    _sql(
        square="""substr('ABCDEFGHJKLMNPQRSTUVWXYZ', CAST(8 * ((l_linenumber - 1) % 3) + l_partkey % 8 + 1 AS INT), 1) || substr('VABCDEFGHJKLMNPQRSTU', CAST((1 + 5 * ((l_linenumber - 1) % 2) + l_suppkey % 90) % 20 + 1 AS INT), 1)"""
    )
)
def mgrs_digraph(spark, d):
    east, north = (F.col("l_partkey") % 8 + 1) * 100_000.0 + 5, F.col("l_suppkey") % 90 * 100_000.0 + 5
    return _on_lines(spark, d, square=geo.mgrs_digraph(F.col("l_linenumber"), east, north))


_BELOW = f"CASE WHEN {SLAT} <= 0 THEN {SLAT} * 4 - 1 ELSE floor({SLAT} * 4) END"


@query(_sql(down=f"({_BELOW}) / 4", up=f"(({_BELOW}) + 1) / 4"))
def grid_snap(spark, d):
    lat, lon = _at()
    return _on_lines(spark, d, down=geo.grid_snap(lat, F.lit(4), False), up=geo.grid_snap(lat, F.lit(4), True))


@query(_sql(zone=f"CAST(trunc(floor((90 - {SLAT}) / 0.25e0 * (360 / 0.25e0)) + (180 + {SLON}) / 0.25e0 + 1) AS INT)"))
def zone_id(spark, d):
    lat, lon = _at()
    step, size = F.lit(1 / 256), F.lit(64)
    return _on_lines(spark, d, zone=geo.zone_id(lat, lon, step, size, size))


@query(_sql(level="CAST(l_orderkey % 11 AS INT)", step="power(2e0, -(8 + l_orderkey % 11))"))
def zoom_step(spark, d):
    level = (F.col("l_orderkey") % 11).cast("int")
    return _on_lines(spark, d, level=level, step=geo.zoom_step(level))


@query(_sql(v="round(l_quantity + l_discount * (l_tax - l_quantity) + l_tax * (l_linenumber - l_quantity) + l_discount * l_tax * (l_quantity + l_quantity - l_linenumber - l_tax), 6)"))
def bilinear(spark, d):
    q, dd, t, n = (F.col(c) for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber"))
    return _on_lines(spark, d, v=r6(geo.bilinear(dd, t, q, t, n, q)))


@query(_sql(inside=f"{SLON} >= -60 AND {SLAT} >= -30 AND {SLON} < 60 - ({SLAT} + 30) AND {SLAT} < 30 + 0 * {SLON}"))
def point_in_polygon(spark, d):
    lat, lon = _at()
    corners = [(-60.0, -30.0), (60.0, -30.0), (0.0, 30.0), (-60.0, 30.0)]
    polygon = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in corners])
    return _on_lines(spark, d, inside=geo.point_in_polygon(lon, lat, polygon))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'available' WHEN o_orderkey % 3 = 1 THEN 'error' ELSE 'in-progress' END AS c FROM orders")
def status_class(spark, d):
    status = F.get(F.array(*map(F.lit, ("Available", "Sync_Error", "processing"))), (F.col("o_orderkey") % 3).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", values.status_class(status).alias("c"))
