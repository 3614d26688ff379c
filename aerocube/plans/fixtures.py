"""Files for the format rules, written by hand: one of each format, near misses, and files that fit two rules."""

SO2_SWATH, AEROSOL_SWATH, SO2_GRID = "/HDFEOS/SWATHS/OMI Total Column Amount SO2", "/HDFEOS/SWATHS/ColumnAmountAerosol", "/HDFEOS/GRIDS/OMI Total Column Amount SO2"
PLACES = ["/Geolocation Fields/Latitude", "/Geolocation Fields/Longitude", "/Geolocation Fields/Time"]
STATION = ["StartDate", "StartTime_UT", "StopTime_UT", "Location", "Longitude_degrees_east", "Latitude_degrees_north", "Altitude_meter_asl", "EmissionWavelength_nm"]
AREA = ["Specific humidity@isobaricInhPa", "Temperature@isobaricInhPa", "Temperature@surface", "Surface pressure@surface"]
MONITOR = ["InstrumentName", "ProcessLevel", "_FillValue", "MissingValue"]
GRANULE = ["InstrumentName", "ProcessLevel", "StartUTC", "EndUTC", "GranuleYear", "GranuleMonth", "GranuleDay", "_FillValue"]


def head(name: bytes) -> bytes:
    return b"\0" * 36 + name + b"\0" * 12


#: Fixed values: (expected format or None, name, text, head, container, items, attributes)
FILES = [
    ("aura_l2_so2", "a.he5", None, None, "hdf5", [SO2_SWATH + p for p in PLACES] + [SO2_SWATH + "/Data Fields/SO2indexP1"], MONITOR),
    ("aura_l2_aerosol", "a.he5", None, None, "hdf5", [AEROSOL_SWATH + p for p in PLACES] + [AEROSOL_SWATH + "/Data Fields/AerosolOpticalThicknessMW"], MONITOR),
    ("aura_l3", "a.he5", None, None, "hdf5", [SO2_GRID + "/Data Fields/" + x for x in ("Latitude", "Longitude", "Time", "ColumnAmountSO2_PBL")], GRANULE),
    ("bira", "b.h5", None, None, "hdf5", ["latitude", "longitude", "Time", "SO2 vcd", "SO2 averaging kernel", "SO2 altitude grid", "more"], []),
    ("gome_l2", "g.h5", None, None, "hdf5", ["/GEOLOCATION/LatitudeCentre", "/GEOLOCATION/LongitudeCentre", "/GEOLOCATION/Time", "/TOTAL_COLUMNS/SO2"], ["FillValue", "SatelliteID", "InstrumentID", "ProcessingLevel"]),
    ("lidar_ext", "0123456789abce.nc", None, None, "netcdf", ["Altitude", "Extinction"], STATION),
    ("lidar_bsc", "0123456789abcb.nc", None, None, "netcdf", ["Altitude", "Backscatter"], STATION),
    ("bascoe", "o.nc", None, None, "netcdf", ["o3_vmr", "ap", "bp", "p0", "levelist", "time", "latitude", "longitude", "temperature", "z"], []),
    ("wrf_so2", "w.nc", None, None, "netcdf", ["so2", "Times", "XLONG", "XLAT", "PH", "PHB", "HGT"], []),
    ("cams", "c.nc", None, None, "netcdf", ["so2_conc", "latitude", "longitude", "time"], []),
    ("macc", "m.nc", None, None, "netcdf", ["time", "latitude", "longitude", "tcso2"], ["_FillValue", "add_offset", "scale_factor"]),
    ("wrf_ash3d", "w.nc", None, None, "netcdf", ["vash_al", "Times", "XLONG", "XLAT", "PH", "PHB", "HGT"], []),
    ("wrf_ashcol", "w.nc", None, None, "netcdf", ["vashcol_sat_col", "Times", "XLONG", "XLAT"], []),
    ("aeronet", "a.lev20", "x\ny\nLocation=a,long=1,lat=2,elev=3\n", None, "text", [], []),
    ("cloudsat", "c.hdf", None, None, "hdf4", ["Latitude", "Longitude", "start_time", "end_time", "Roll_offset.offset", "Radar_Reflectivity.valid_range", "Radar_Reflectivity.factor"], []),
    ("evdc", "e.hdf", None, None, "hdf4", ["LATITUDE.INSTRUMENT", "LONGITUDE.INSTRUMENT", "ALTITUDE.INSTRUMENT"], ["DATA_LOCATION"]),
    ("flexpart", "run", None, None, "directory", ["header", "dates"], []),
    ("mod04", "m.hdf", None, None, "hdf4", ["Image_Optical_Depth_Land_And_Ocean", "Land_Ocean_Quality_Flag", "Latitude", "Longitude"], []),
    ("mod07", "m.hdf", None, None, "hdf4", ["Skin_Temperature", "Surface_Pressure", "Retrieved_Moisture_Profile", "Retrieved_Temperature_Profile", "Latitude", "Longitude"], []),
    ("eea", "e.txt", "1 2 3\n4 5.5 -6e1\n", None, "text", [], []),
    ("lidar_bira", "l.txt", "p\n" * 41 + " ".join("1" * 14) + "\n" + " ".join("2" * 10), None, "text", [], []),
    ("alaro", "ALARO_1_2.grb", None, None, "grib", AREA, []),
    ("arome", "AROME_1_2.grb", None, None, "grib", AREA, []),
    ("sentinel", "S5P.nc", None, None, "hdf5", ["PRODUCT/" + x for x in ("latitude", "longitude", "so2_vertical_column", "so2_slant_column_corrected", "SUPPORT_DATA/DETAILED_RESULTS/processing_quality_flags")], ["_FillValue"]),
    ("parasol_land", "p", None, head(b"P3L2TLGC001002AD"), "binary", [], []),
    ("parasol_sea", "p", None, head(b"P3L2TOGC001002AD"), "binary", [], []),
    ("scisat", "s.nc", None, None, "netcdf", ["ACE-FTS-v2.2/Data-L2_1km_grid/O3", "ACE-FTS-v2.2/Data-L2_1km_grid/z"], ["latitude", "longitude", "start_time", "end_time"]),
    ("osiris", "o.nc", None, None, "netcdf", ["ozone_concentration", "latitude", "longitude", "altitude"], []),
    # near misses: an item or attribute is absent, the container, the name or a number is another
    (None, "a.he5", None, None, "hdf5", [SO2_SWATH + p for p in PLACES[:2]] + [SO2_SWATH + "/Data Fields/SO2indexP1"], MONITOR),
    (None, "a.he5", None, None, "hdf5", [SO2_GRID + "/Data Fields/" + x for x in ("Latitude", "Longitude", "Time", "ColumnAmountSO2_PBL")], GRANULE[:-1]),
    (None, "b.nc", None, None, "netcdf", ["latitude", "longitude", "Time", "SO2 vcd", "SO2 averaging kernel", "SO2 altitude grid"], []),
    (None, "0123456789abcx.nc", None, None, "netcdf", ["Altitude", "Extinction"], STATION),
    (None, "0123456789abcb.nc", None, None, "netcdf", ["Altitude", "Extinction"], STATION),
    (None, "m.nc", None, None, "netcdf", ["time", "latitude", "longitude", "tcso2"], ["_FillValue", "add_offset"]),
    (None, "HARMONIE_1_2.grb", None, None, "grib", AREA, []),
    (None, "ALARO_1_2.grb", None, None, "grib", AREA[:3], []),
    (None, "run", None, None, "directory", ["dates"], []),
    (None, "a", "x\ny\nLocation=a,lat=2,long=1,elev=3\n", None, "text", [], []),
    (None, "e", "1 2 3\n4 5\n", None, "text", [], []),
    (None, "e", "1 2 3\n4 5 six\n", None, "text", [], []),
    (None, "l", "p\n" * 41, None, "text", [], []),
    (None, "l", "p\n" * 41 + " ".join("1" * 13), None, "text", [], []),
    (None, "p", None, head(b"P4L2TLGC001002AD"), "binary", [], []),
    (None, "p", None, head(b"P3L2TLGC001002AL"), "binary", [], []),
    (None, "n", "nothing known", b"\0" * 64, "text", [], []),
    # two rules at once: the earlier one names the format
    ("wrf_so2", "w.nc", None, None, "netcdf", ["so2", "vash_al", "Times", "XLONG", "XLAT", "PH", "PHB", "HGT"], []),
    ("mod04", "m.hdf", None, None, "hdf4", ["Skin_Temperature", "Surface_Pressure", "Retrieved_Moisture_Profile", "Retrieved_Temperature_Profile", "Image_Optical_Depth_Land_And_Ocean", "Land_Ocean_Quality_Flag", "Latitude", "Longitude"], []),
    ("cams", "c.nc", None, None, "netcdf", ["so2_conc", "tcso2", "latitude", "longitude", "time"], ["_FillValue", "add_offset", "scale_factor"]),
]

#: Bundles (bundle, names in their order), and what is left of each.
BUNDLES = {
    "plain": (["x/", "x/a.nc", "x/b.nc"], ["x/a.nc", "x/b.nc"]),
    "dispersion": (["readme", "run1/dates", "run1/header", "run1/grid_conc_20150601000000_001", "run1/receptor_conc"], ["run1"]),
    "grids": (["out/grid_conc_20150601000000_001", "out/grid_conc_20150601010000_001"], ["out"]),
    "no_grid": (["out/grid_conc_2015_001"], ["out/grid_conc_2015_001"]),
    "polarimeter": (["P3L2TLGC001002AD", "P3L2TLGC001002AL", "P3L2TOGC001002AL"], ["P3L2TLGC001002AD", "P3L2TOGC001002AL"]),
}
