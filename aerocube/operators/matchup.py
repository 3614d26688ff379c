"""Matching observations and points to coverages.

Ranges are joined through bins: an observation goes to each bin of longitude, latitude and time that its tolerances touch,
a coverage sample lies in exactly one, and the exact ranges are checked on what meets. Spark so sees an equi-join.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bins(low: Column, high: Column, size: float) -> Column:
    return F.explode(F.sequence(F.floor(low / size), F.floor(high / size)))


def _in_reach(o: DataFrame, cover: DataFrame, degrees: float, seconds: float) -> DataFrame:
    """The coverage's samples within the box and span of all observations: plain comparisons that reach its scan."""
    far = o.agg(F.min("olon"), F.max("olon"), F.min("olat"), F.max("olat"), F.min("s0"), F.max("s1")).first()  # one row
    if far[0] is None or far[4] is None:
        return cover.filter(F.lit(False))
    at = lambda x: F.timestamp_micros(F.lit(int(x * 1_000_000))).cast(cover.schema["t"].dataType)
    inside = F.col("lon").between(far[0] - degrees, far[1] + degrees) & F.col("lat").between(far[2] - degrees, far[3] + degrees)
    return cover.filter(inside & F.col("t").between(at(far[4] - seconds - 1), at(far[5] + seconds + 1)))


def ground_coverage_matchup(obs: DataFrame, cover: DataFrame, degrees: float = 1.0, minutes: float = 60.0) -> DataFrame:
    """(obs_id, t_start, ground, cover, d, n) for each observation with coverage samples near in space and time.

    obs: obs_id, t_start, t_end, lon, lat, value. cover: t, lon, lat, value. All ranges are closed, longitudes don't
    wrap. An observation whose samples are all missing has a missing mean."""
    seconds, space = minutes * 60, max(degrees, 1.0)
    span = max(2 * seconds, 3600.0)
    s = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1e6
    o = obs.select("obs_id", "t_start", F.col("lon").alias("olon"), F.col("lat").alias("olat"), F.col("value").alias("ground"), s("t_start").alias("s0"), s("t_end").alias("s1"))
    cover = _in_reach(o, cover, degrees, seconds)
    o = o.withColumn("xb", _bins(F.col("olon") - degrees, F.col("olon") + degrees, 2 * space))
    o = o.withColumn("yb", _bins(F.col("olat") - degrees, F.col("olat") + degrees, 2 * space))
    o = o.withColumn("tb", _bins(F.col("s0") - seconds, F.col("s1") + seconds, span))
    c = cover.select("lon", "lat", "value", s("t").alias("s"))
    c = c.withColumns({"xb": F.floor(F.col("lon") / (2 * space)), "yb": F.floor(F.col("lat") / (2 * space)), "tb": F.floor(F.col("s") / span)})
    near = (
        F.col("lon").between(F.col("olon") - degrees, F.col("olon") + degrees)
        & F.col("lat").between(F.col("olat") - degrees, F.col("olat") + degrees)
        & F.col("s").between(F.col("s0") - seconds, F.col("s1") + seconds)
    )
    met = o.join(c.hint("merge"), ["xb", "yb", "tb"]).filter(near)  # exploded observations aren't to be broadcast
    out = met.groupBy("obs_id").agg(F.any_value("t_start").alias("t_start"), F.any_value("ground").alias("ground"), F.avg("value").alias("cover"), F.count("*").alias("n"))
    return out.withColumn("d", F.col("ground") - F.col("cover"))


def dense_matchup(obs: DataFrame, cover: DataFrame, degrees: float = 1.0, minutes: float = 60.0, parts: int = 4) -> DataFrame:
    """What ground_coverage_matchup() gives, for coverages that are dense beside the tolerances: with some dozen samples in a cube of
    one tolerance or more.

    Samples are summed by cells of a tolerance's `parts`-th part, once for all observations. An observation adds up the cells
    that lie within its box and span as wholes and looks at samples only in cells that its faces cut. Both sides meet in blocks
    of a tolerance: an observation goes to the blocks of time that it touches and stays in one block of space, cells and samples
    go to the blocks of space around theirs; so copies are counted in dozens, not in the cells of a box."""
    seconds, s = minutes * 60, lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1e6
    o = obs.select("obs_id", "t_start", F.col("lon").alias("olon"), F.col("lat").alias("olat"), F.col("value").alias("ground"), s("t_start").alias("s0"), s("t_end").alias("s1"))
    cover = _in_reach(o, cover, degrees, seconds).select("lon", "lat", "value", s("t").alias("s"))
    size = {"lon": degrees / parts, "lat": degrees / parts, "s": seconds / parts}
    cells = cover.withColumns({f"k_{c}": F.floor(F.col(c) / z) for c, z in size.items()})
    keys = [f"k_{c}" for c in size]
    sums = cells.groupBy(*keys).agg(F.sum("value").alias("v"), F.count("value").alias("n"), F.count("*").alias("m"))
    ends = {"lon": (F.col("olon") - degrees, F.col("olon") + degrees), "lat": (F.col("olat") - degrees, F.col("olat") + degrees), "s": (F.col("s0") - seconds, F.col("s1") + seconds)}
    whole = {c: (F.ceil(a / size[c] + 1e-9), F.floor(b / size[c] - 1e-9) - 1) for c, (a, b) in ends.items()}
    o = o.withColumns({f"low_{c}": a for c, (a, _) in whole.items()} | {f"high_{c}": b for c, (_, b) in whole.items()})
    blocks = lambda low, high: F.explode(F.sequence(F.floor(low - 1e-9), F.floor(high + 1e-9)))
    o = o.withColumns({"xb": F.floor(F.col("olon") / degrees), "yb": F.floor(F.col("olat") / degrees)}).withColumn("tb", blocks(*[x / seconds for x in ends["s"]]))

    def around(rows: DataFrame) -> DataFrame:
        for b, k in (("xb", F.col("k_lon")), ("yb", F.col("k_lat"))):
            rows = rows.withColumn(b, blocks(k / parts - 1, (k + 1) / parts + 1))
        return rows.withColumn("tb", F.floor(F.col("k_s") / parts))

    inside = functools.reduce(lambda x, y: x & y, [F.col(f"k_{c}").between(F.col(f"low_{c}"), F.col(f"high_{c}")) for c in size])
    exact = functools.reduce(lambda x, y: x & y, [F.col(c).between(*ends[c]) for c in size])
    # the size of exploded rows isn't known when a join is planned, so none of them is to be broadcast
    meet = lambda rows: o.join(around(rows).hint("merge"), ["xb", "yb", "tb"])
    full = meet(sums).filter(inside).select("obs_id", "t_start", "ground", "v", "n", "m")
    cut = meet(cells).filter(exact & ~inside).select("obs_id", "t_start", "ground", F.col("value").alias("v"), F.col("value").isNotNull().cast("long").alias("n"), F.lit(1).cast("long").alias("m"))
    out = full.unionByName(cut).groupBy("obs_id").agg(F.any_value("t_start").alias("t_start"), F.any_value("ground").alias("ground"), F.try_divide(F.sum("v"), F.sum("n")).alias("cover"), F.sum("m").alias("n"))
    return out.withColumn("d", F.col("ground") - F.col("cover"))


def footprint_profile(sites: DataFrame, cover: DataFrame, degrees: float = 1.1) -> DataFrame:
    """Per site, period and level the mean of the coverage's samples in the footprint: sites (site_id, lon, lat, period),
    cover (period, lon, lat, level_idx, value)."""
    size = 2 * degrees
    o = sites.select("site_id", "period", F.col("lon").alias("olon"), F.col("lat").alias("olat"))
    o = o.withColumn("xb", _bins(F.col("olon") - degrees, F.col("olon") + degrees, size)).withColumn("yb", _bins(F.col("olat") - degrees, F.col("olat") + degrees, size))
    c = cover.withColumns({"xb": F.floor(F.col("lon") / size), "yb": F.floor(F.col("lat") / size)})
    near = F.col("lon").between(F.col("olon") - degrees, F.col("olon") + degrees) & F.col("lat").between(F.col("olat") - degrees, F.col("olat") + degrees)
    return o.join(c.hint("merge"), ["period", "xb", "yb"]).filter(near).groupBy("site_id", "period", "level_idx").agg(F.avg("value").alias("value"), F.count("*").alias("n"))


def point_to_cell(points: DataFrame, x0: float, dx: float, y0: float, dy: float, rows: int, columns: int) -> DataFrame:
    """points (lon, lat) with the raster cell (row, col) that holds each; those outside are left out.

    The raster starts at (x0, y0) with steps dx and dy (negative where rows run south)."""
    out = points.withColumn("col", F.floor((F.col("lon") - x0) / dx).cast("int")).withColumn("row", F.floor((F.col("lat") - y0) / dy).cast("int"))
    return out.filter(F.col("row").between(0, rows - 1) & F.col("col").between(0, columns - 1))


def values_through_time(points: DataFrame, cells: DataFrame, *more: str) -> DataFrame:
    """Values of gridded coverages (coverage_id, row, col, t, value, *more) at points (point_id, row, col) over time."""
    return points.join(cells, ["row", "col"]).select("point_id", "coverage_id", *more, "t", "value")


def volume_values(points: DataFrame, stacks: DataFrame) -> DataFrame:
    """All levels at points: stacks has one array `bands` per cell and time."""
    return points.join(stacks, ["row", "col"]).select("point_id", "coverage_id", "t", F.posexplode("bands").alias("level", "value"))
