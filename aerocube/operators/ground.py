"""Ground observations: the star join, and loads that may run twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits by which keys are dealt.
DIGITS = 3
NATURAL_KEY = ["station", "product", "value", "t_start", "t_end"]


def star_join(measurements: DataFrame, stations: DataFrame, products: DataFrame) -> DataFrame:
    """Measurements with their station's and product's columns. Spark broadcasts a dimension if its size allows."""
    out = measurements.join(stations.withColumnRenamed("id", "stations_id").withColumnRenamed("name", "station"), "stations_id")
    return out.join(products.withColumnRenamed("id", "observed_field"), "observed_field")


def coverage_attributes(coverages: DataFrame, catalog: DataFrame) -> DataFrame:
    """coverages with the unit and application that their catalog row names."""
    return coverages.join(catalog.select("coverage_id", "measurement_unit", "application"), "coverage_id")


def new_measurements(incoming: DataFrame, stored: DataFrame, keys: list[str] = NATURAL_KEY) -> DataFrame:
    """Incoming rows that neither the store nor an earlier incoming row has; missing values are equal to each other."""
    fresh = incoming.dropDuplicates(keys)
    old = stored.select(*[F.col(k).alias(f"old_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"old_{k}")) for k in keys]
    return fresh.join(old, same, "left_anti")


def numbered(rows: DataFrame, key: str, first_id: int, into: str = "id") -> DataFrame:
    """rows, one per key, with numbers after first_id.

    Numbers have no gaps and depend on the keys alone: keys are dealt into 16 ** DIGITS parts by the first digits of their MD5,
    and a key's number is what the parts before hold, plus its place in its own part. So a rerun, or another writer who finds the
    same keys new, gives the same numbers, and no task sees all keys."""
    rows = rows.withColumn("part", F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, DIGITS), 16, 10).cast("int"))
    counts = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per part
    nth = F.row_number().over(Window.partitionBy("part").orderBy(key))
    numbers = rows.select("*", nth.alias("nth")).join(F.broadcast(counts.select("part", before.alias("before"))), "part")
    return numbers.withColumn(into, F.lit(first_id) + F.col("before") + F.col("nth")).drop("part", "nth", "before")


def new_dimension_rows(incoming: DataFrame, dimension: DataFrame, key: str, first_id: int) -> DataFrame:
    """(id, key) of keys that the dimension lacks, with ids after first_id: those of numbered()."""
    fresh = incoming.select(key).filter(F.col(key).isNotNull()).distinct().join(dimension.select(key), key, "left_anti")
    return numbered(fresh, key, first_id)


def upsert_stations(stored: DataFrame, incoming: DataFrame, update: bool = True) -> DataFrame:
    """stored with the incoming stations by name: new ones added, known ones replaced if update. Of several incoming rows of one
    name the greatest by their columns counts."""
    cols = [c for c in stored.columns if c != "name"]
    new = incoming.groupBy("name").agg(F.max(F.struct(*cols)).alias("n")).select("name", *[F.col(f"n.{c}").alias(f"new_{c}") for c in cols])
    both = stored.withColumn("known", F.lit(True)).join(new, "name", "full_outer")
    pick = lambda c: F.coalesce(f"new_{c}", c) if update else F.when(F.col("known"), F.col(c)).otherwise(F.col(f"new_{c}"))
    return both.select("name", *[pick(c).alias(c) for c in cols])


def station_lookup(rows: DataFrame, stations: DataFrame) -> DataFrame:
    """rows with their station by code; raises if a code is unknown."""
    lost = rows.select("station_code").distinct().join(stations, "station_code", "left_anti").limit(5).collect()
    if lost:
        raise ValueError(f"unknown station codes: {[r['station_code'] for r in lost]}")
    return rows.join(stations, "station_code")
