"""What readers of gridded and swath formats do once a container is open: raw cells to values, times and places.

Rows come from whatever opened the container; sentinels become NULL here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.meteo import baro_height, profile_heights, rel_humidity, wrf_height
from ..functions.times import clock_ms, day_1950, hours_since_1900, mjd2000, tai93, year_day
from ..functions.values import lat_wrap, lon_wrap, mask_equal, mask_negative, mask_outside, num, offset_then_scale, scale_then_offset


def assimilation_column(cells: DataFrame, rows: int, scale: float, offset: float, fill: float) -> DataFrame:
    """Column amounts of the assimilation model (row, hours, value): the last row goes, hours count from 1900."""
    value = scale_then_offset(mask_equal(F.col("value"), fill), scale, offset)
    return cells.filter(F.col("row") < rows - 1).withColumns({"t": hours_since_1900(F.col("hours").cast("long")), "value": value})


def air_quality_forecast(cells: DataFrame, day: str) -> DataFrame:
    """Hourly concentrations (t_idx, lon, lat, value): time steps are hours of the day, longitudes run from 0 to 360."""
    start = F.unix_seconds(F.lit(day).cast("timestamp"))
    return cells.withColumns({"t": F.timestamp_seconds(start + F.col("t_idx") * 3600), "lon": lon_wrap(F.col("lon")), "lat": lat_wrap(F.col("lat"))})


def model_level_heights(cells: DataFrame, *keys: str) -> DataFrame:
    """Mean height over ground per level, at least 0, from (ph, phb, hgt)."""
    height = wrf_height(F.col("ph"), F.col("phb"), F.col("hgt"))
    return cells.groupBy(*keys).agg(F.greatest(F.avg(height), F.lit(0.0)).alias("height"))


def atmospheric_profile(cells: DataFrame) -> DataFrame:
    """The 20-level profile product (level_idx from 0, temperature, dew_point in K) with height and relative humidity."""
    kelvin, dew = mask_negative(F.col("temperature")), mask_negative(F.col("dew_point"))
    return cells.withColumns({"height": F.get(profile_heights(), F.col("level_idx").cast("int")), "temperature": kelvin, "rel_humidity": rel_humidity(dew, kelvin)})


def station_column(rows: DataFrame) -> DataFrame:
    """Ground columns (days, value): fractional days since 2000 as times."""
    return rows.withColumn("t", mjd2000(F.col("days").cast("double")))


def swath_lon(lon: Column) -> Column:
    """0..360 to -180..180, where 180 is -180."""
    return F.when(lon >= 180, lon - 360).otherwise(lon)


def swath_column(samples: DataFrame, per_slice: int = 1500) -> DataFrame:
    """Swath samples (nth, lon, day, ms, value) with their times and slices of so many samples."""
    return samples.withColumns({"t": day_1950(F.col("day"), F.col("ms")), "lon": swath_lon(F.col("lon")), "slice": F.floor(F.col("nth") / per_slice)})


def hit_mean(hits: DataFrame, *cell: str) -> DataFrame:
    """Per target cell the number of values that fell into it and their mean; cells without any are left out."""
    return hits.filter("value is not null").groupBy(*cell).agg(F.count("value").alias("hits"), F.avg("value").alias("value"))


#: Places (from 0) of the aerosol products' wavelengths, and lines of a slice.
WAVELENGTHS = {"AOT367": 1, "AOT388": 3, "AOT451": 10, "AOT483": 13}
SLICE_LINES = 200


def ozone_monitor_swath(cells: DataFrame, fill: float, scale: float, missing_place: float, product: str | None = None, *keys: str) -> DataFrame:
    """Swath cells (*keys, line, sample, lat, lon, seconds since 1993, value) with value, time and slice of 200 lines.

    For aerosol products value is an array by wavelength, of which the product names one. Columns of a slice in which a place
    is missing anywhere are left out of it."""
    raw = F.get("value", F.lit(WAVELENGTHS[product])) if product else F.col("value")
    value = mask_equal(raw, fill) * num(scale)
    rows = cells.withColumns({"value": value, "t": tai93(F.col("seconds")), "slice": F.floor(F.col("line") / SLICE_LINES).cast("int")})
    lost = (F.col("lat") == missing_place) | (F.col("lon") == missing_place)
    column = [*keys, "slice", "sample"]
    return rows.join(rows.filter(lost).select(*column).distinct(), column, "left_anti").drop("seconds")


def slice_times(rows: DataFrame, *keys: str) -> DataFrame:
    """First, mean and last time of each slice's lines."""
    seconds = F.unix_micros("t") / 1_000_000
    return rows.groupBy(*keys, "slice").agg(F.min_by("t", "line").alias("t_start"), F.max_by("t", "line").alias("t_end"), F.timestamp_seconds(F.avg(seconds)).alias("t_mean"))


def ozone_monitor_grid(cells: DataFrame, rows: int, fill: float) -> DataFrame:
    """Gridded cells (row, col, value): files begin in the south, so rows turn; the fill is missing."""
    return cells.withColumns({"row": (F.lit(rows - 1) - F.col("row")).cast("int"), "value": mask_equal(F.col("value"), fill)})


def grid_bounds(cells: DataFrame, rows: int, columns: int) -> DataFrame:
    """(west, north, width, height): the grid's corner and pixel size from its places' extremes."""
    size = lambda c, n: F.abs(F.max(c) - F.min(c)) / n
    return cells.agg(F.min("lon").alias("west"), F.max("lat").alias("north"), size("lon", columns).alias("width"), size("lat", rows).alias("height"))


#: The fields of the limited-area models, (name, type of level, product); hPa per Pa for pressures.
AREA_FIELDS = [
    ("Specific humidity", "isobaricInhPa", "SPECIFICHUMIDITY"),
    ("Temperature", "isobaricInhPa", "TEMPERATUREPROFILE"),
    ("Temperature", "surface", "TEMPERATURESURFACE"),
    ("Surface pressure", "surface", "SURFACEPRESSURE"),
]


def limited_area_model(messages: DataFrame, hours_at: int, turn_rows: int | None = None) -> DataFrame:
    """Cells (file, name, level_type, level, run, row, col, value) of the four products, with `product`, height and valid time
    `t`. Pressures are in hPa.

    run: YYYYMMDDHHMM. hours_at: which number of the file's name (from 0) counts the hours after the run. turn_rows: the number
    of rows, for a model whose messages begin in the south, so that its rows turn; the other's stay."""
    product = F.coalesce(*[F.when((F.col("name") == n) & (F.col("level_type") == kind), p) for n, kind, p in AREA_FIELDS])
    hours = F.get(F.regexp_extract_all(F.substring_index("file", "/", -1), F.lit(r"(\d+)"), F.lit(1)), F.lit(hours_at)).cast("long")
    run = F.unix_seconds(F.to_timestamp("run", "yyyyMMddHHmm"))
    out = messages.withColumn("product", product).filter("product is not null")
    return out.withColumns({
        "t": F.timestamp_seconds(run + hours * 3600),
        "value": F.when(F.col("product") == "SURFACEPRESSURE", F.col("value") / 100).otherwise(F.col("value")),
        "height": baro_height(F.col("level").cast("double")),
        "row": F.col("row").cast("int") if turn_rows is None else (F.lit(turn_rows - 1) - F.col("row")).cast("int"),
    })


def band_numbers(rows: DataFrame, *keys: str) -> DataFrame:
    """rows with `band` from 1: the message read last comes first."""
    levels = rows.select(*keys, "level").distinct()
    nth = levels.groupBy(*keys).agg(F.array_sort(F.collect_list("level")).alias("all"))  # some dozen levels a product
    return rows.join(nth, list(keys)).withColumn("band", F.size("all") - F.array_position("all", F.col("level")).cast("int") + 1).drop("all")


def sulphur_kernel_swath(samples: DataFrame, fill: float = -9999.0) -> DataFrame:
    """Samples (file, nth, clock as HHMMSSfff, value) with instrument, time and slice, from the file's name
    `INSTRUMENT-product-kind-YYYYMMDD_...`; slices have 1500 samples for one instrument and 4000 for the others."""
    part = lambda i: F.get(F.split("file", "-"), i)
    day = F.unix_seconds(F.to_timestamp(F.substring_index(part(3), "_", 1), "yyyyMMdd"))
    per_slice = F.when(part(0) == "GOME2B", 1500).otherwise(4000)
    return samples.withColumns({
        "instrument": part(0), "t": F.timestamp_seconds(day + F.floor(clock_ms(F.col("clock")))), "slice": F.floor(F.col("nth") / per_slice).cast("int"), "value": mask_equal(F.col("value"), fill),
    })


def radiometer_depth(cells: DataFrame, scale: float, offset: float, missing_place: float = -999.0) -> DataFrame:
    """Optical depths or flags (file, lat, lon, value) with time, from files `x.AYYYYDDD.HHMM...`: scale times (value minus
    offset). A file with any missing place is left out as a whole."""
    bad = cells.filter((F.col("lat") == missing_place) | (F.col("lon") == missing_place)).select("file").distinct()
    part = lambda i: F.get(F.split("file", r"\."), i)
    clock = part(2)
    start = F.unix_seconds(year_day(F.substring(part(1), 2, 7)).cast("timestamp"))
    t = F.timestamp_seconds(start + F.substring(clock, 1, 2).cast("long") * 3600 + F.substring(clock, 3, 2).cast("long") * 60)
    return cells.join(bad, "file", "left_anti").withColumns({"t": t, "value": offset_then_scale(F.col("value"), scale, offset)})


def radiometer_surface(cells: DataFrame, scale: float, offset: float, low: float, high: float) -> DataFrame:
    """Surface temperature or pressure (value): raw values outside the valid range and negative results are missing."""
    return cells.withColumn("value", mask_negative(offset_then_scale(mask_outside(F.col("value"), low, high), scale, offset)))


def limb_profiles(cells: DataFrame, fill: float) -> DataFrame:
    """Limb scans (nth, level_idx, lat, lon from 0 to 360, altitude, value): longitudes less 180, the fill is missing."""
    return cells.withColumns({"lon": F.col("lon") - 180, "value": mask_equal(F.col("value"), fill)})


def occultation_profile(levels: DataFrame) -> DataFrame:
    """One profile (lat, lon, level_idx, altitude, value) as a pixel of one degree around its place: north, west, step."""
    return levels.withColumns({"west": F.col("lon") - 0.5, "north": F.col("lat") - 0.5, "step": num(1.0)})


def sulphur_column_swath(cells: DataFrame, fill: float, missing_place: float) -> DataFrame:
    """Swath cells (file, line, sample, lat, lon, value, quality) with their file's times: the swath ends before the first
    sample whose place is missing in line 0, or if there is none before its last one. Times stand at fixed places of the
    file's name."""
    first = cells.filter(F.col("line") == 0).groupBy("file").agg(F.coalesce(F.min(F.when(F.col("lat") == missing_place, F.col("sample"))), F.max("sample")).alias("end"))
    at = lambda k: F.to_timestamp(F.substring("file", k, 15), "yyyyMMdd'T'HHmmss")
    out = cells.join(first, "file").filter(F.col("sample") < F.col("end")).drop("end")
    return out.withColumns({"t_start": at(21), "t_end": at(37), "value": mask_equal(F.col("value"), fill)})


def chemistry_field(cells: DataFrame, mapping: DataFrame, levels: int) -> DataFrame:
    """A field (time as text, level_idx from 0, src_row, src_col, value) on the target grid by one map for all times and
    levels, bands from the top down; seconds are cut."""
    t = F.date_trunc("minute", F.to_timestamp(F.regexp_replace("time", "_", " "), "yyyy-MM-dd HH:mm:ss"))
    out = mapping.join(cells, ["src_row", "src_col"])
    return out.select("dst_row", "dst_col", t.alias("t"), (F.lit(levels) - F.col("level_idx")).cast("int").alias("band"), "value")


def daily_average(rows: DataFrame, *keys: str) -> DataFrame:
    """Daily means of values that aren't missing, as observations that last from the day's first to its last second."""
    day = F.unix_seconds(F.date_trunc("day", "t"))
    means = rows.filter("value is not null").groupBy(*keys, day.alias("day")).agg(F.avg("value").alias("value"))
    return means.select(*keys, F.timestamp_seconds("day").alias("t_start"), F.timestamp_seconds(F.col("day") + 86_399).alias("t_end"), F.lit("SO2 Daily Average").alias("product"), "value")


def single_profile(levels: DataFrame, *keys: str) -> DataFrame:
    """A lidar profile's levels (height, value) as one row, with their sum, which is missing if a level is."""
    rows = F.sort_array(F.collect_list(F.struct("height", "value")))  # one profile's levels
    out = levels.groupBy(*keys).agg(rows.alias("levels"))
    return out.withColumn("total", F.aggregate("levels", num(0), lambda s, x: s + x["value"]))
