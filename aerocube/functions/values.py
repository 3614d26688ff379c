"""Masks, units and other per-value expressions. Missing data is NULL throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def num(x: float) -> Column:
    return F.lit(float(x))


def mask_equal(v: Column, sentinel: float) -> Column:
    """NULL where the value is the sentinel."""
    return F.nullif(v, num(sentinel))


def mask_outside(v: Column, low: float, high: float) -> Column:
    return F.when(v.between(num(low), num(high)), v)


def mask_negative(v: Column) -> Column:
    return F.when(v >= 0, v)


def mask_above(v: Column, most: float) -> Column:
    return F.when(v <= num(most), v)


def unit_conversion(v: Column, gain: float = 1.0, offset: float = 0.0) -> Column:
    return (v + num(offset)) * num(gain)


def scale_then_offset(v: Column, scale: float, offset: float) -> Column:
    """v * scale + offset, the convention of the assimilation model files."""
    return v * num(scale) + num(offset)


def offset_then_scale(v: Column, scale: float, offset: float) -> Column:
    """scale * (v - offset), the convention of the imaging radiometer's files."""
    return num(scale) * (v - num(offset))


def lon_wrap(lon: Column) -> Column:
    """0..360 to -180..180; 180 stays."""
    return F.when(lon > 180, lon - 360).otherwise(lon)


def lat_wrap(lat: Column) -> Column:
    return F.when(lat > 90, lat - 180).otherwise(lat)


def concentration_scale(v: Column) -> Column:
    """The dispersion model's mass to mixing ratio factor, 112 / 35."""
    return v * num(112 / 35)


def parse_options(text: Column) -> Column:
    """`k=v;k=v` as a map."""
    return F.str_to_map(text, F.lit(";"), F.lit("="))


def label_filename(name: Column, label: str) -> Column:
    """The label goes before the 19 characters of time stamp and suffix."""
    return F.concat(F.expr("''") if not label else F.left(name, F.length(name) - 19), F.lit(f"{label}_"), F.right(name, F.lit(19)))


def filename_hours(name: Column) -> Column:
    """Hours after the run in a forecast file's name, `..._+HHH.grb`."""
    return F.regexp_extract(name, r"\+(\d+)\.", 1).try_cast("int")


def filename_day(name: Column) -> Column:
    """The day YYYYMMDD in a file's name: its first eight digits in a row."""
    return F.nullif(F.regexp_extract(name, r"(\d{8})", 1), F.lit(""))


def coverage_dir(coverage_id: Column) -> Column:
    """The collection's directory: the id without its last two `_` parts."""
    parts = F.split(coverage_id, "_")
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 2, F.lit(0))), "_")


def vector_field(text: Column) -> Column:
    """`{a;b;c}` as an array of numbers; parts that are no numbers are NULL."""
    return F.transform(F.split(F.regexp_replace(text, r"[{}\s]", ""), ";"), lambda x: x.try_cast("double"))


def try_ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def status_class(status: Column) -> Column:
    """What a catalog status means to a reader."""
    return F.when(status == "Available", "available").when(status.contains("rror"), "error").otherwise("in-progress")


def decimal_digits(v: Column, most: int = 12) -> Column:
    """Significant decimals of a number, at most so many."""
    text = F.format_string(f"%.{most}f", v)
    return F.length(F.regexp_replace(F.substring_index(text, ".", -1), "0+$", ""))
