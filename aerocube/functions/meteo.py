"""Heights, pressures and humidity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .values import num

#: Gas constant of dry air, standard temperature, gravity.
R_DRY, T_STANDARD, GRAVITY = 287.053, 288.15, 9.80665
#: Pressure levels (hPa) of the atmospheric profile product, top first.
PROFILE_LEVELS = [5, 10, 20, 30, 50, 70, 100, 150, 200, 250, 300, 400, 500, 620, 700, 780, 850, 920, 950, 1000]


def baro_height(hpa: Column) -> Column:
    """Height (m) of a pressure in an isothermal standard atmosphere; 0 for pressure 0."""
    return F.when(hpa == 0, num(0)).otherwise(num(-R_DRY * T_STANDARD / GRAVITY) * F.ln(hpa * 100 / num(101325)))


def profile_heights() -> Column:
    """Heights of the profile product's levels, as an array."""
    return F.array(*[baro_height(num(p)) for p in PROFILE_LEVELS])


def std_atm_altitude(hpa: Column) -> Column:
    """Altitude (m) of a pressure in the standard atmosphere."""
    return (1 - F.pow(hpa / num(1013.25), num(0.190284))) * num(145366.45) * num(0.3048)


def wrf_height(ph: Column, phb: Column, terrain: Column) -> Column:
    """Height over ground from perturbation and base geopotential."""
    return (ph + phb) / num(9.81) - terrain


def saturation(celsius: Column) -> Column:
    """Magnus: vapour pressure relative to that at 0 degrees."""
    return F.exp(num(17.625) * celsius / (num(243.04) + celsius))


def rel_humidity(dew_kelvin: Column, kelvin: Column) -> Column:
    """Relative humidity in percent; values over 200 are missing."""
    rh = 100 * saturation(dew_kelvin - num(273.15)) / saturation(kelvin - num(273.15))
    return F.when(rh <= 200, rh)


def specific_humidity(dew_kelvin: Column, hpa: Column) -> Column:
    """0.622 e / (p - 0.378 e) with e in hPa."""
    e = num(6.1094) * saturation(dew_kelvin - num(273.15))
    return num(0.622) * e / (hpa - num(0.378) * e)


def hybrid_pressure(df: DataFrame, keys: list[str], level: str, ap: str, bp: str, p0: str) -> DataFrame:
    """df with `pressure` at the middle of each layer; a column's last interface has no layer below and is left out."""
    w = Window.partitionBy(*keys).orderBy(level)
    nth = lambda c: F.lead(c).over(w)
    middle = (F.col(ap) + nth(ap)) * 0.5 + (F.col(bp) + nth(bp)) * 0.5 * F.col(p0)
    return df.withColumn("pressure", middle).filter(F.col("pressure").isNotNull())


def hypsometric_height(df: DataFrame, keys: list[str], level: str, temperature: str, pressure: str, surface_pressure: str, terrain: str) -> DataFrame:
    """df with `height`: from the lowest layer (highest level number) upward by the hypsometric equation."""
    up = Window.partitionBy(*keys).orderBy(F.desc(level))
    t, p = F.col(temperature), F.col(pressure)
    scale = num(R_DRY / GRAVITY)
    base = F.col(terrain) + t * F.ln(F.col(surface_pressure) / p) * scale
    step = 0.5 * (F.lag(t).over(up) + t) * F.ln(F.lag(p).over(up) / p) * scale
    thickness = F.coalesce(step, base)  # the first layer starts at the base
    return df.withColumn("step", thickness).withColumn("height", F.sum("step").over(up)).drop("step")
