"""Format identification: 28 rules in order, the first that holds names the format.

A rule that can't be decided for a file (a part is missing) doesn't hold. Files are rows of an inventory: path, name,
text (of text files), head (first 64 bytes), container, items (variables and groups), attributes. The inventory of HDF, netCDF
and GRIB files comes from whatever library can open them; text and binary rules need the bytes alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_L2 = "/HDFEOS/SWATHS/{}/"
_SO2, _AER, _GRID = _L2.format("OMI Total Column Amount SO2"), _L2.format("ColumnAmountAerosol"), "/HDFEOS/GRIDS/OMI Total Column Amount SO2/Data Fields/"
_WRF = ["Times", "XLONG", "XLAT"]
_GRIB = ["Specific humidity@isobaricInhPa", "Temperature@isobaricInhPa", "Temperature@surface", "Surface pressure@surface"]
_LIDAR = ["StartDate", "StartTime_UT", "StopTime_UT", "Location", "Longitude_degrees_east", "Latitude_degrees_north", "Altitude_meter_asl", "EmissionWavelength_nm"]
#: What a file of each format must hold. (name, container, items, attributes)
CONTENTS = {
    "aura_l2_so2": ("hdf5", [_SO2 + x for x in ("Geolocation Fields/Latitude", "Geolocation Fields/Longitude", "Geolocation Fields/Time", "Data Fields/SO2indexP1")], ["InstrumentName", "ProcessLevel", "_FillValue", "MissingValue"]),
    "aura_l2_aerosol": ("hdf5", [_AER + x for x in ("Geolocation Fields/Latitude", "Geolocation Fields/Longitude", "Geolocation Fields/Time", "Data Fields/AerosolOpticalThicknessMW")], ["InstrumentName", "ProcessLevel", "_FillValue", "MissingValue"]),
    "aura_l3": ("hdf5", [_GRID + x for x in ("Latitude", "Longitude", "Time", "ColumnAmountSO2_PBL")], ["InstrumentName", "ProcessLevel", "StartUTC", "EndUTC", "GranuleYear", "GranuleMonth", "GranuleDay", "_FillValue"]),
    "bira": ("hdf5", ["latitude", "longitude", "Time", "SO2 vcd", "SO2 averaging kernel", "SO2 altitude grid"], []),
    "gome_l2": ("hdf5", ["/GEOLOCATION/LatitudeCentre", "/GEOLOCATION/LongitudeCentre", "/GEOLOCATION/Time", "/TOTAL_COLUMNS/SO2"], ["FillValue", "SatelliteID", "InstrumentID", "ProcessingLevel"]),
    "lidar_ext": ("netcdf", ["Altitude", "Extinction"], _LIDAR),
    "lidar_bsc": ("netcdf", ["Altitude", "Backscatter"], _LIDAR),
    "bascoe": ("netcdf", ["o3_vmr", "ap", "bp", "p0", "levelist", "time", "latitude", "longitude", "temperature", "z"], []),
    "wrf_so2": ("netcdf", ["so2", *_WRF, "PH", "PHB", "HGT"], []),
    "cams": ("netcdf", ["so2_conc", "latitude", "longitude", "time"], []),
    "macc": ("netcdf", ["time", "latitude", "longitude", "tcso2"], ["_FillValue", "add_offset", "scale_factor"]),
    "wrf_ash3d": ("netcdf", ["vash_al", *_WRF, "PH", "PHB", "HGT"], []),
    "wrf_ashcol": ("netcdf", ["vashcol_sat_col", *_WRF], []),
    "cloudsat": ("hdf4", ["Latitude", "Longitude", "start_time", "end_time", "Roll_offset.offset", "Radar_Reflectivity.valid_range", "Radar_Reflectivity.factor"], []),
    "evdc": ("hdf4", ["LATITUDE.INSTRUMENT", "LONGITUDE.INSTRUMENT", "ALTITUDE.INSTRUMENT"], ["DATA_LOCATION"]),
    "flexpart": ("directory", ["header"], []),
    "mod04": ("hdf4", ["Image_Optical_Depth_Land_And_Ocean", "Land_Ocean_Quality_Flag", "Latitude", "Longitude"], []),
    "mod07": ("hdf4", ["Skin_Temperature", "Surface_Pressure", "Retrieved_Moisture_Profile", "Retrieved_Temperature_Profile", "Latitude", "Longitude"], []),
    "alaro": ("grib", _GRIB, []),
    "arome": ("grib", _GRIB, []),
    "sentinel": ("hdf5", ["PRODUCT/latitude", "PRODUCT/longitude", "PRODUCT/so2_vertical_column", "PRODUCT/so2_slant_column_corrected", "PRODUCT/SUPPORT_DATA/DETAILED_RESULTS/processing_quality_flags"], ["_FillValue"]),
    "scisat": ("netcdf", ["ACE-FTS-v2.2/Data-L2_1km_grid/O3", "ACE-FTS-v2.2/Data-L2_1km_grid/z"], ["latitude", "longitude", "start_time", "end_time"]),
    "osiris": ("netcdf", ["ozone_concentration", "latitude", "longitude", "altitude"], []),
}
#: The order in which rules are tried.
ORDER = (
    "aura_l2_so2", "aura_l2_aerosol", "aura_l3", "bira", "gome_l2", "lidar_ext", "lidar_bsc", "bascoe", "wrf_so2", "cams", "macc", "wrf_ash3d",
    "wrf_ashcol", "aeronet", "cloudsat", "evdc", "flexpart", "mod04", "mod07", "eea", "lidar_bira", "alaro", "arome", "sentinel", "parasol_land",
    "parasol_sea", "scisat", "osiris",
)
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _lines(text: Column) -> Column:
    lines = F.split(text, "\r?\n")
    return F.when(F.element_at(lines, -1) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)


def _fields(line: Column) -> Column:
    return F.filter(F.split(line, r"\s+"), lambda x: x != "")


def _numbers(line: Column, counts: list[int]) -> Column:
    return F.size(_fields(line)).isin(counts) & F.forall(_fields(line), lambda x: x.rlike(NUMBER))


def rule(kind: str) -> Column:
    """Whether a file of the inventory is of a format."""
    name, text, head = F.col("name"), F.col("text"), F.col("head")
    if kind == "aeronet":
        labels = F.transform(F.split(F.get(F.split(text, "\n"), 2), ","), lambda x: F.substring_index(x, "=", 1))
        return F.slice(labels, 1, 4) == F.array(*map(F.lit, ("Location", "long", "lat", "elev")))
    if kind == "eea":
        return F.forall(_lines(text), lambda x: _numbers(x, [3]))
    if kind == "lidar_bira":
        rows = F.slice(_lines(text), F.lit(42), F.greatest(F.size(_lines(text)), F.lit(1)))
        return (F.size(rows) > 0) & F.forall(rows, lambda x: _numbers(x, [14, 10]))
    if kind in ("parasol_land", "parasol_sea"):
        surface = "L" if kind.endswith("land") else "O"
        return F.decode(F.substring(head, F.lit(37), F.lit(16)), "ISO-8859-1").rlike(rf"P[123]L[123]T{surface}G[1ABC][0-9]{{6}}[A-Z]D")
    container, items, attributes = CONTENTS[kind]
    holds = (F.col("container") == container) & (F.size(F.array_except(F.array(*map(F.lit, items)), "items")) == 0)
    if attributes:
        holds = holds & (F.size(F.array_except(F.array(*map(F.lit, attributes)), "attributes")) == 0)
    if kind in ("alaro", "arome"):
        holds = holds & name.startswith(kind.upper())
    if kind in ("lidar_ext", "lidar_bsc"):
        holds = holds & (F.substring(name, 14, 1) == kind[6])
    return holds


def identify(inventory: DataFrame) -> DataFrame:
    """inventory with `format`; null if no rule holds."""
    return inventory.withColumn("format", F.coalesce(*[F.when(rule(k), k) for k in ORDER]))


def file_inventory(files: DataFrame, containers: DataFrame | None = None) -> DataFrame:
    """The inventory of binaryFile rows (path, content): text and head.

    containers: (path, container, items, attributes) of the files that some library for HDF, netCDF or GRIB has opened. Such a
    library isn't part of this one; without that table the 23 rules on containers hold for no file."""
    content = F.col("content")
    if containers is not None:
        plain = file_inventory(files).drop("container", "items", "attributes")
        none = F.array().cast("array<string>")
        return plain.join(containers, "path", "left").withColumns({c: F.coalesce(c, none) for c in ("items", "attributes")})
    return files.select(
        "path",
        F.substring_index("path", "/", -1).alias("name"),
        F.try_validate_utf8(content.cast("string")).alias("text"),
        F.substring(content, F.lit(1), F.lit(64)).alias("head"),
        F.lit(None).cast("string").alias("container"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<string>").alias("attributes"),
    )


#: Names of the dispersion model's files, of which its directory is the product, and of the polarimeter's data
#: files, whose leader file ends in L instead of D.
DISPERSION = r"dates|header|receptor_conc|grid_conc_[0-9]{14}_[0-9]{3}"
POLARIMETER = r"P[123]L[123]T[BRLO]G[1ABC][0-9]{6}[A-Z]D"


def product_files(files: DataFrame) -> DataFrame:
    """(bundle, path) of the products among the files (bundle, nth, path) of unpacked bundles.

    A bundle with files of the dispersion model is one product, the directory of the first such file. Of others all files
    are, but for directories and for leader files whose data file is in the bundle too."""
    side = files.filter(F.col("path").rlike(DISPERSION))
    runs = side.groupBy("bundle").agg(F.min_by("path", "nth").alias("first")).select("bundle", F.regexp_extract("first", r"^(.*)/[^/]*$", 1).alias("path"))
    leaders = files.filter(F.col("path").rlike(POLARIMETER)).select("bundle", F.concat(F.expr("left(path, length(path) - 1)"), F.lit("L")).alias("path"))
    others = files.filter(~F.col("path").endswith("/")).join(runs.select("bundle"), "bundle", "left_anti").join(leaders, ["bundle", "path"], "left_anti")
    return runs.unionByName(others.select("bundle", "path"))
