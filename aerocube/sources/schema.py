"""Schemas of the library's tables, as DDL."""

STATION = "id long, name string, latitude double, longitude double, height double, station_code string"
PRODUCT = "id long, product string, measurement_unit string"
MEASUREMENT = "id long, stations_id long, observation_time_start timestamp, observation_time_end timestamp, observed_field long, value double"
COLLECTION = (
    "id long, location string, name string, source string, max_lat string, max_lon string, min_lat string, min_lon string, start_date date, end_date date, application string, "
    "measurement_unit string, `group` string, other_info string, uploaded_by long, status string, io string, coverage_id string, ipr string, access string, min_value string, max_value string"
)
GRANULE = (
    "granule_id long, coverage_id string, t_start timestamp, t_end timestamp, geotransform struct<x0: double, dx: double, rx: double, y0: double, ry: double, dy: double>, "
    "n_rows int, n_cols int, n_levels int, heights array<double>, global_min double, global_max double, tags map<string, string>"
)
SAMPLES = "coverage_id string, granule_id long, t_start timestamp, t_end timestamp, row int, col int, level_idx int, lat double, lon double, value double"
PROFILE = "station_id long, t_start timestamp, t_end timestamp, levels array<struct<level_idx: int, height_m: double, value: double>>"
PIXEL_MAP = "src_grid string, dst_grid string, dst_row int, dst_col int, src_row int, src_col int, dist_m double"
GROUND_XML = "siteName string, siteLongitude double, siteLatitude double, siteElevation double, data array<struct<timeStart: string, timeEnd: string, field: string, value: string>>"
