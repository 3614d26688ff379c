"""Space and time subsets, filters by ranges and options."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import utm_forward
from ..functions.values import num


@dataclass(frozen=True)
class Subset:
    """A coverage request: closed ranges; None doesn't filter. One time bound means that instant."""

    lon: tuple[float, float] | None = None
    lat: tuple[float, float] | None = None
    start: str | None = None
    end: str | None = None


def subset_bbox(df: DataFrame, lon: tuple[float, float], lat: tuple[float, float]) -> DataFrame:
    return df.filter(F.col("lon").between(*map(num, lon)) & F.col("lat").between(*map(num, lat)))


def subset_time_overlap(df: DataFrame, start: str, end: str, t_start: str = "t_start", t_end: str = "t_end") -> DataFrame:
    """Rows whose closed interval overlaps the closed interval asked for."""
    return df.filter((F.col(t_start) <= F.lit(end).cast("timestamp")) & (F.col(t_end) >= F.lit(start).cast("timestamp")))


def get_coverage(samples: DataFrame, coverage_id: str, subset: Subset) -> DataFrame:
    """The samples of a coverage within a subset; every condition reaches the scan."""
    out = samples.filter(F.col("coverage_id") == coverage_id)
    if subset.lon:
        out = out.filter(F.col("lon").between(*map(num, subset.lon)))
    if subset.lat:
        out = out.filter(F.col("lat").between(*map(num, subset.lat)))
    start, end = subset.start or subset.end, subset.end or subset.start
    if start:
        out = subset_time_overlap(out, start, end)
    return out


def like_product(df: DataFrame, unit: str, application: str) -> DataFrame:
    return df.filter(F.col("measurement_unit").like(unit) & F.col("product").like(application))


def parse_ranges(text: str) -> dict[str, tuple[float, float]]:
    """`Name:a,b;Name2:c,d` to ranges with their ends in order."""
    out = {}
    for part in filter(None, text.split(";")):
        name, _, ends = part.partition(":")
        low, high = sorted(float(x) for x in ends.split(","))
        out[name] = (low, high)
    return out


def range_filters(df: DataFrame, text: str) -> DataFrame:
    """All ranges of a filter string at once."""
    keep: Column = F.lit(True)
    for name, (low, high) in parse_ranges(text).items():
        keep = keep & F.col(name).between(num(low), num(high))
    return df.filter(keep)


def check_download(df: DataFrame, start: str, end: str, most_days: int = 15, most_rows: int = 432_000) -> DataFrame:
    """df within the interval; raises if the span or the number of rows is over the download limits."""
    span = df.sparkSession.sql("SELECT datediff(:e, :s) AS d", {"e": end, "s": start}).first()["d"]
    if span > most_days:
        raise ValueError(f"{span} days asked for; at most {most_days} can be downloaded at once")
    out = df.filter(F.col("t").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    if out.limit(most_rows + 1).count() > most_rows:
        raise ValueError(f"over {most_rows} measurements; narrow the selection")
    return out


def downloads(df: DataFrame, start: str, end: str, most_days: int = 15, most_rows: int = 432_000) -> DataFrame:
    """df within the interval, all of it, with `download`: the numbers (period, part) of as many downloads as keep each within the
    limits, in order of time.

    Rows are counted by hour and numbered within their hour, so no window but the hours' sees more than an hour. Where all
    fit one download, it is what check_download() gives."""
    at = lambda x: F.lit(x).cast("timestamp")
    hour = F.floor(F.unix_seconds("t") / 3600)
    rows = df.filter(F.col("t").between(at(start), at(end))).withColumns({"period": F.floor(F.datediff("t", at(start)) / most_days), "hour": hour})
    before = Window.partitionBy("period").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = rows.groupBy("period", "hour").agg(F.count("*").alias("n")).select("period", "hour", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rows = rows.join(hours, ["period", "hour"]).withColumn("nth", F.row_number().over(Window.partitionBy("period", "hour").orderBy("t")))
    part = F.floor((F.col("before") + F.col("nth") - 1) / most_rows)
    return rows.withColumn("download", F.struct("period", part.alias("part"))).drop("period", "hour", "before", "nth")


#: Element and attribute names of coverage requests, and the coordinate system of their limits.
REQUEST = """<wcs:GetCoverage service="WCS" version="2.0.0" xmlns:wcs="http://www.opengis.net/wcs/2.0"><wcs:CoverageId>{}</wcs:CoverageId><wcs:format>{}</wcs:format>{}{}</wcs:GetCoverage>"""
TRIM = """<wcs:DimensionTrim><wcs:Dimension crs="{}">{}</wcs:Dimension><wcs:TrimLow>{}</wcs:TrimLow><wcs:TrimHigh>{}</wcs:TrimHigh></wcs:DimensionTrim>"""
OUTPUT = "<wcs:OutputCrs>{}</wcs:OutputCrs>"
WGS84 = "http://www.opengis.net/def/crs/EPSG/0/4326"


def coverage_request(coverage: str, west: float, east: float, south: float, north: float, form: str = "image/tiff", output_crs: str | None = None, subset_crs: str = WGS84) -> str:
    """The XML text of a request for a coverage within a box."""
    escaped = coverage.replace("&", "&amp;").replace("<", "&lt;")
    trims = TRIM.format(subset_crs, "x", west, east) + TRIM.format(subset_crs, "y", south, north)
    return REQUEST.format(escaped, form, trims, OUTPUT.format(output_crs) if output_crs else "")


def parse_requests(requests: DataFrame) -> DataFrame:
    """(coverage_id, west, east, south, north, form, subset_crs, output_crs) of request texts (xml); what a text lacks is NULL."""
    text = lambda name: F.xpath_string("xml", F.lit(f"//*[name()='wcs:{name}']"))

    def limit(axis: str, end: str) -> Column:
        found = F.xpath_string("xml", F.lit(f"//*[name()='wcs:DimensionTrim'][*[name()='wcs:Dimension']='{axis}']/*[name()='wcs:Trim{end}']"))
        return found.try_cast("double")

    return requests.select(
        text("CoverageId").alias("coverage_id"), limit("x", "Low").alias("west"), limit("x", "High").alias("east"), limit("y", "Low").alias("south"), limit("y", "High").alias("north"), text("format").alias("form"),
        F.nullif(F.xpath_string("xml", F.lit("//*[name()='wcs:DimensionTrim'][1]/*[name()='wcs:Dimension']/@crs")), F.lit("")).alias("subset_crs"), F.nullif(text("OutputCrs"), F.lit("")).alias("output_crs"),
    )


#: Requests up to which they are broadcast.
FEW = 10_000


def answer_requests(samples: DataFrame, requests: DataFrame) -> DataFrame:
    """The samples of each request (see parse_requests) with x and y in the system that it asks for; a limit that is NULL doesn't limit.

    Systems are WGS 84 (EPSG 4326, or none named) and its UTM zones (EPSG 32601 to 32660 and 32701 to 32760); requests whose limits
    are in another system than WGS 84 have no answer, and in an unknown output system x and y are missing."""
    within = lambda c, low, high: F.coalesce(c >= F.col(low), F.lit(True)) & F.coalesce(c <= F.col(high), F.lit(True))
    code = lambda c: F.coalesce(F.regexp_extract(c, r"(\d+)$", 1).try_cast("int"), F.when(F.col(c).isNull(), 4326))
    asked = requests.withColumn("code", code("output_crs")).filter(code("subset_crs") == 4326)
    asked = F.broadcast(asked) if requests.limit(FEW + 1).count() <= FEW else asked
    met = samples.join(asked, "coverage_id").filter(within(F.col("lon"), "west", "east") & within(F.col("lat"), "south", "north"))
    zone, plain = F.col("code") % 100, F.col("code") == 4326
    metric = F.floor(F.col("code") / 100).isin(326, 327) & zone.between(1, 60)
    east, north = utm_forward(F.col("lat"), F.col("lon"), zone)
    south = F.when(F.col("code") >= 32_700, 10_000_000.0).otherwise(0.0)
    met = met.withColumns({"x": F.when(plain, F.col("lon")).when(metric, east), "y": F.when(plain, F.col("lat")).when(metric, north + south)})
    return met.drop("west", "east", "south", "north", "form", "subset_crs", "output_crs", "code")
