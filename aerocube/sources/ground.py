"""Readers and writers of ground observations: XML, sun-photometer, air-quality and lidar texts, station lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.meteo import std_atm_altitude
from ..functions.times import iso
from ..functions.values import lat_wrap, lon_wrap
from .schema import GROUND_XML


def read_ground_xml(spark: SparkSession, path: str, root: str = "EEA") -> DataFrame:
    """(station, longitude, latitude, height, t_start, t_end, product, value); N/A is missing."""
    return explode_ground(spark.read.schema(GROUND_XML).option("rowTag", root).xml(path))


def explode_ground(files: DataFrame) -> DataFrame:
    rows = files.select(F.col("siteName").alias("station"), F.col("siteLongitude").alias("longitude"), F.col("siteLatitude").alias("latitude"), F.col("siteElevation").alias("height"), F.explode("data").alias("d"))
    value = F.col("d.value").try_cast("double")
    return rows.select("station", "longitude", "latitude", "height", iso(F.col("d.timeStart")).alias("t_start"), iso(F.col("d.timeEnd")).alias("t_end"), F.col("d.field").alias("product"), value.alias("value"))


def write_ground_xml(rows: DataFrame, path: str, root: str = "EEA") -> None:
    """One element per station and day, with the day's observations in time order; a missing value is N/A. So no station's
    whole history meets in one row."""
    at = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    item = F.struct(at("t_start").alias("timeStart"), at("t_end").alias("timeEnd"), F.col("product").alias("field"), F.coalesce(F.col("value").cast("string"), F.lit("N/A")).alias("value"))
    files = rows.groupBy(F.col("station").alias("siteName"), F.col("longitude").alias("siteLongitude"), F.col("latitude").alias("siteLatitude"), F.col("height").alias("siteElevation"), F.to_date("t_start").alias("__day"))
    files.agg(F.sort_array(F.collect_list(item)).alias("data")).drop("__day").write.option("rootTag", "files").option("rowTag", root).mode("overwrite").xml(path)


def parse_aeronet(files: DataFrame) -> DataFrame:
    """Sun-photometer texts (text: the whole file) to observations: the header's third line, data from the sixth, column 9."""
    lines = F.split("text", "\r?\n")
    part = lambda i: F.trim(F.substring_index(F.get(F.split(F.get(lines, 2), ","), i), "=", -1))
    rows = files.select(part(0).alias("station"), part(1).try_cast("double").alias("longitude"), part(2).try_cast("double").alias("latitude"), part(3).try_cast("double").alias("height"), F.explode(F.slice(lines, F.lit(6), F.greatest(F.size(lines), F.lit(1)))).alias("line"))
    cells = F.split("line", ",")
    t = F.try_to_timestamp(F.concat_ws(" ", F.get(cells, 0), F.get(cells, 1)), F.lit("dd:MM:yyyy HH:mm:ss"))
    return rows.filter(F.trim("line") != "").select("station", "longitude", "latitude", "height", t.alias("t_start"), t.alias("t_end"), F.get(cells, 8).try_cast("double").alias("value"))


def parse_air_quality(lines: DataFrame) -> DataFrame:
    """Lines (name, line) of air-quality texts: station code from the file's name, time at fixed places, the value after
    two spaces; a negative one is missing."""
    line = F.col("line")
    value = F.get(F.split(line, "  "), 1).try_cast("double")
    t = F.try_to_timestamp(F.concat(F.substring(line, 1, 8), F.substring(line, 10, 6)), F.lit("yyyyMMddHHmmss"))
    return lines.filter(F.trim("line") != "").select(F.substring("name", 1, 9).alias("station_code"), t.alias("t"), F.when(value >= 0, value).alias("value"))


def parse_station_list(lines: DataFrame) -> DataFrame:
    """`code name lat lon height` lines: commas go, `_` is a space, blank numbers are 0."""
    parts = F.split(F.replace("line", F.lit(","), F.lit("")), " ")
    number = lambda i: F.coalesce(F.get(parts, i).try_cast("double"), F.lit(0.0))
    name = F.replace(F.get(parts, 1), F.lit("_"), F.lit(" "))
    return lines.filter(F.trim("line") != "").select(F.get(parts, 0).alias("station_code"), name.alias("name"), number(2).alias("latitude"), number(3).alias("longitude"), number(4).alias("height"))


def parse_lidar_ozone(lines: DataFrame) -> DataFrame:
    """Numbered lines (name, nth from 1, line) of ozone lidar texts: 41 lines of preamble, then profiles of a header line of
    14 numbers and data lines of 10. A running count of header lines tells profiles apart."""
    fields = F.filter(F.split("line", r"\s+"), lambda x: x != "")
    rows = lines.filter("nth > 41").withColumn("f", F.transform(fields, lambda x: x.try_cast("double"))).withColumn("is_head", (F.size("f") == 14).cast("int"))
    by_file = Window.partitionBy("name").orderBy("nth")
    rows = rows.withColumn("profile", F.sum("is_head").over(by_file))
    get = lambda i: F.get(F.col("f"), i)

    def moment(hour: int) -> Column:
        return F.make_timestamp(*[get(i).cast("int") for i in (2, 3, 4, hour, hour + 1)], F.lit(0.0))

    own = Window.partitionBy("name", "profile")
    head = lambda c: F.max(F.when(F.col("is_head") == 1, c)).over(own)
    rows = rows.withColumns({"t_start": head(moment(5)), "t_end": head(moment(7)), "latitude": head(lat_wrap(get(10) / 10)), "longitude": head(lon_wrap(get(11) / 10))})
    return rows.filter("is_head = 0").select(
        "name", "profile", "t_start", "t_end", "latitude", "longitude", std_atm_altitude(get(7)).alias("height"),
        get(1).alias("ozone_density"), get(5).alias("ozone_ppmv"), get(7).alias("pressure"),
    )
