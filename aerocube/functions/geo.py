"""Distances, grids and map coordinates on the earth."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import num

EARTH = 6372795.477598
#: WGS 84
A, FLAT = 6378137.0, 1 / 298.257223563
B = A * (1 - FLAT)
E2 = FLAT * (2 - FLAT)
K0 = 0.9996


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres on a sphere."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return num(2 * EARTH) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, num(0))))


def flat_m(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Metres between points given in metres."""
    return F.sqrt(F.pow(x2 - x1, 2) + F.pow(y2 - y1, 2))


def vincenty_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, rounds: int = 20) -> Column:
    """Metres on the WGS 84 ellipsoid, to the millimetre below: the inverse method's iteration, a fixed number of rounds.

    Nearly antipodal points, for which the iteration doesn't settle, have no value."""
    u1, u2 = F.atan((1 - FLAT) * F.tan(F.radians(lat1))), F.atan((1 - FLAT) * F.tan(F.radians(lat2)))
    start = F.struct(F.sin(u1).alias("s1"), F.cos(u1).alias("c1"), F.sin(u2).alias("s2"), F.cos(u2).alias("c2"), F.radians(lon2 - lon1).alias("l"))

    def terms(g: Column, lam: Column) -> dict[str, Column]:
        y = F.sqrt(F.pow(g["c2"] * F.sin(lam), 2) + F.pow(g["c1"] * g["s2"] - g["s1"] * g["c2"] * F.cos(lam), 2))
        x = g["s1"] * g["s2"] + g["c1"] * g["c2"] * F.cos(lam)
        azimuth = F.coalesce(F.try_divide(g["c1"] * g["c2"] * F.sin(lam), y), num(0))
        cos2 = 1 - azimuth * azimuth
        middle = F.coalesce(x - F.try_divide(2 * g["s1"] * g["s2"], cos2), num(0))
        return {"y": y, "x": x, "arc": F.atan2(y, x), "az": azimuth, "cos2": cos2, "mid": middle}

    def let(g: Column, lam: Column, then) -> Column:  # each term is computed once
        t = terms(g, lam)
        return F.transform(F.array(F.struct(*[v.alias(k) for k, v in t.items()])), then)[0]

    def next_lambda(g: Column, lam: Column) -> Column:
        def of(t: Column) -> Column:
            c = num(FLAT / 16) * t["cos2"] * (4 + num(FLAT) * (4 - 3 * t["cos2"]))
            inner = t["mid"] + c * t["x"] * (2 * t["mid"] * t["mid"] - 1)
            return g["l"] + (1 - c) * num(FLAT) * t["az"] * (t["arc"] + c * t["y"] * inner)

        return let(g, lam, of)

    def distance(g: Column, lam: Column) -> Column:
        def of(t: Column) -> Column:
            u = t["cos2"] * num((A * A - B * B) / (B * B))
            big = 1 + u / 16384 * (4096 + u * (u * (320 - 175 * u) - 768))
            small = u / 1024 * (256 + u * (u * (74 - 47 * u) - 128))
            last = small / 6 * t["mid"] * (4 * t["y"] * t["y"] - 3) * (4 * t["mid"] * t["mid"] - 3)
            bend = small * t["y"] * (t["mid"] + small / 4 * (t["x"] * (2 * t["mid"] * t["mid"] - 1) - last))
            return F.floor(num(B) * big * (t["arc"] - bend) * 1000) / 1000

        return let(g, lam, of)

    def whole(g: Column) -> Column:
        zero = F.struct(g["l"].alias("lam"), num(1).alias("moved"))
        steps = F.aggregate(
            F.sequence(F.lit(1), F.lit(rounds)),
            zero,
            # what doesn't move any more stays, so further rounds cost nothing
            lambda s, _: F.when(s["moved"] == 0, s).otherwise(F.transform(F.array(next_lambda(g, s["lam"])), lambda n: F.struct(n.alias("lam"), F.abs(n - s["lam"]).alias("moved")))[0]),
        )
        return F.transform(F.array(steps), lambda s: F.when(s["moved"] < 1e-9, distance(g, s["lam"])))[0]

    return F.transform(F.array(start), whole)[0]


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing, 0 (north) to 360."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    angle = F.degrees(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)))
    return F.when(angle < 0, angle + 360).otherwise(angle)


def point_in_polygon(x: Column, y: Column, polygon: Column) -> Column:
    """Even-odd rule; polygon: array of (x, y) structs."""
    n = F.size(polygon)

    def crosses(i: Column) -> Column:
        p, q = F.get(polygon, i), F.get(polygon, (i + n - 1) % n)
        at = F.try_divide((q["x"] - p["x"]) * (y - p["y"]), q["y"] - p["y"]) + p["x"]
        return ((p["y"] > y) != (q["y"] > y)) & F.coalesce(x < at, F.lit(False))

    return F.size(F.filter(F.sequence(F.lit(0), n - 1), crosses)) % 2 == 1


def bilinear(wi: Column, wj: Column, v00: Column, v10: Column, v01: Column, v11: Column) -> Column:
    return v00 * (1 - wi) * (1 - wj) + v10 * wi * (1 - wj) + v01 * (1 - wi) * wj + v11 * wi * wj


def sinusoidal_lat(line: Column) -> Column:
    """Latitude of a line of the 18 km sinusoidal grid, counted from 1 at the north."""
    return 90 - (line - 0.5) / 6


def sinusoidal_lon(line: Column, column: Column) -> Column:
    cells = F.rint(1080 * F.cos(F.radians(sinusoidal_lat(line))))
    return F.try_divide(num(180), cells) * (column - 1080.5)


def grid_snap(coord: Column, step: Column, up: bool) -> Column:
    """The grid line at 1 / step degrees below (or above) a coordinate.

    A coordinate on a line belongs to the cell above it, but zero and negative whole degrees to the one below."""
    below = F.when((coord <= 0) & (coord == F.rint(coord)), coord * step - 1).otherwise(F.floor(coord * step))
    return (below + (1 if up else 0)) / step


def zone_id(lat: Column, lon: Column, step: Column, rows: Column, columns: Column) -> Column:
    """Number of the earth-fixed tile, from 1 at the north-west, casts truncate."""
    east = F.when(lon == 180, num(-180)).when(lon > 180, lon - 360).otherwise(lon)
    down = (90 - lat) / (step * rows) * (num(360) / (step * rows))
    return (F.floor(down) + (180 + east) / (step * columns) + 1).cast("int")


def zone_corner(zone: Column) -> tuple[Column, Column]:
    """North-west corner (lat, lon) of a zone of quarter degree tiles."""
    return 90 - F.floor((zone - 1) / 1440) * 0.25, (zone - 1) % 1440 * 0.25 - 180


def zoom_step(level: Column) -> Column:
    """Degrees per pixel of a zoom level."""
    return F.pow(num(2), -(8 + level.cast("double")))


def utm_zone(lon: Column) -> Column:
    return F.when(lon < 0, ((180 + lon) / 6).cast("int") + 1).otherwise((lon / 6).cast("int") + 31)


def utm_forward(lat: Column, lon: Column, zone: Column | None = None) -> tuple[Column, Column]:
    """Easting and northing (m, negative in the south) on WGS 84: transverse Mercator as a series in the distance from the
    central meridian, to the third power for the easting and the fourth for the northing. zone: that of the place unless
    given; one given is reached the short way around."""
    phi = F.radians(lat)
    off = lon - (6 * (utm_zone(lon) if zone is None else zone) - 183)
    d = F.radians(off if zone is None else F.when(off > 180, off - 360).when(off < -180, off + 360).otherwise(off))
    second = E2 / (1 - E2)
    nu = num(A) / F.sqrt(1 - E2 * F.pow(F.sin(phi), 2))
    t, c = F.pow(F.tan(phi), 2), second * F.pow(F.cos(phi), 2)
    n = FLAT / (2 - FLAT)
    # meridian arc by powers of the third flattening
    arc = num(A * (1 - n) * (1 - n * n) * (1 + 9 * n**2 / 4 + 225 * n**4 / 64)) * (
        phi
        - num(3 * n / 2 - 9 * n**3 / 16) * F.sin(2 * phi)
        + num(15 * n**2 / 16 - 15 * n**4 / 32) * F.sin(4 * phi)
        - num(35 * n**3 / 48) * F.sin(6 * phi)
        + num(315 * n**4 / 512) * F.sin(8 * phi)
    )
    east = num(K0) * nu * (d * F.cos(phi) + F.pow(d * F.cos(phi), 3) / 6 * (1 - t + c)) + 500_000
    north = num(K0) * (arc + nu * F.sin(phi) * F.cos(phi) * F.pow(d, 2) / 2 + nu * F.sin(phi) * F.pow(F.cos(phi), 3) * F.pow(d, 4) / 24 * (5 - t + 9 * c + 4 * c * c))
    return east, north


def utm_inverse(easting: Column, northing: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Latitude and longitude of UTM coordinates on WGS 84; in the south northings count from 10,000 km below the equator."""
    e1 = (1 - math.sqrt(1 - E2)) / (1 + math.sqrt(1 - E2))
    mu = (northing - F.when(south, num(10_000_000)).otherwise(num(0))) / num(K0 * A * (1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256))
    phi = (
        mu
        + num(3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu)
        + num(21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu)
        + num(151 * e1**3 / 96) * F.sin(6 * mu)
        + num(1097 * e1**4 / 512) * F.sin(8 * mu)
    )
    second = E2 / (1 - E2)
    root = 1 - E2 * F.pow(F.sin(phi), 2)
    nu, rho = num(A) / F.sqrt(root), num(A * (1 - E2)) / F.pow(root, 1.5)
    t, c, d = F.pow(F.tan(phi), 2), second * F.pow(F.cos(phi), 2), (easting - 500_000) / (nu * K0)
    lat = phi - nu * F.tan(phi) / rho * (
        F.pow(d, 2) / 2
        - F.pow(d, 4) / 24 * (5 + 3 * t + 10 * c - 4 * c * c - 9 * second)
        + F.pow(d, 6) / 720 * (61 + 90 * t + 298 * c + 45 * t * t - 252 * second - 3 * c * c)
    )
    lon = (d - F.pow(d, 3) / 6 * (1 + 2 * t + c) + F.pow(d, 5) / 120 * (5 - 2 * c + 28 * t - 3 * c * c + 8 * second + 24 * t * t)) / F.cos(phi)
    return F.degrees(lat), F.degrees(lon) + (6 * zone - 183)


#: Latitude bands of the military grid and the degree at which each begins.
SOUTH_BANDS = [("A", -90), ("C", -84), ("D", -72), ("E", -64), ("F", -56), ("G", -48), ("H", -40), ("J", -32), ("K", -24), ("L", -16), ("M", -8)]
NORTH_BANDS = [("N", 0), ("P", 8), ("Q", 16), ("R", 24), ("S", 32), ("T", 40), ("U", 48), ("V", 56), ("W", 64), ("X", 72), ("Z", 84)]


def lat_band(lat: Column) -> Column:
    """The band letter: the last that begins at or below the latitude."""
    band = F.lit("A")
    for letter, start in SOUTH_BANDS + NORTH_BANDS:
        band = F.when(lat >= start, letter).otherwise(band)
    return band


def band_degree(letter: Column) -> Column:
    """Where a band begins; -100 for no band's letter."""
    out = F.lit(-100)
    for name, start in SOUTH_BANDS + NORTH_BANDS:
        out = F.when(letter == name, start).otherwise(out)
    return out


def hemisphere(letter: Column) -> Column:
    return F.when(letter.isin([x for x, _ in SOUTH_BANDS]), "S").otherwise("N")


#: Letters of the 100 km squares' columns and rows.
COLUMN_LETTERS, ROW_LETTERS = "ABCDEFGHJKLMNPQRSTUVWXYZ", "VABCDEFGHJKLMNPQRSTU"


def mgrs_digraph(zone: Column, easting: Column, northing: Column) -> Column:
    """The two letters of a 100 km square; letters I and O are not used."""
    column = 8 * ((zone - 1) % 3) + (easting / 100_000).cast("int")
    row = (1 + 5 * ((zone - 1) % 2) + (northing / 100_000).cast("int")) % 20
    row = F.when(row < 0, row + 19).otherwise(row)
    return F.concat(F.substring(F.lit(COLUMN_LETTERS), column, F.lit(1)), F.substring(F.lit(ROW_LETTERS), row + 1, F.lit(1)))


def degree(metres: float) -> float:
    """Degrees of latitude that so many metres are."""
    return metres / (math.pi * EARTH / 180)
