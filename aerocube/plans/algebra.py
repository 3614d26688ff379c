"""Coverage arithmetic, vertical operators, overlays and species."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import algebra as ops
from .inputs import PROFILES, SAMPLES, cells, cells_sql, profiles, r6, samples, table
from .registry import query

AR = f"WITH {SAMPLES}, {cells_sql('A', 'a')}, {cells_sql('R', 'r')}"


def _out(df):
    return df.withColumn("value", r6("value"))


_PARTS = "p AS (SELECT vec_id, value * (height - coalesce(lag(height) OVER (PARTITION BY vec_id ORDER BY level_idx), 0)) AS part, value FROM levels)"


@query(f"WITH {PROFILES}, {_PARTS} SELECT vec_id, CASE WHEN count(part) = count(*) THEN round(sum(part), 3) END AS value FROM p GROUP BY vec_id")
def vertical_integral(spark, d):
    return profiles(spark, d).select("vec_id", F.round(ops.vertical_integral(F.col("values"), F.col("heights")), 3).alias("value"))


def _levels(spark, d):
    z = F.posexplode(F.arrays_zip("values", "heights"))
    return profiles(spark, d).select("vec_id", z.alias("i", "z")).select("vec_id", (F.col("i") + 1).alias("level_idx"), F.col("z.heights").alias("height"), F.col("z.values").alias("value"))


@query(f"WITH {PROFILES}, {_PARTS} SELECT vec_id, CASE WHEN count(part) = count(*) THEN round(sum(part), 3) END AS value FROM p GROUP BY vec_id")
def vertical_integral_cols(spark, d):
    return ops.vertical_integral_rows(_levels(spark, d), "vec_id").withColumn("value", F.round("value", 3))


@query(f"WITH {PROFILES}, {_PARTS} SELECT vec_id, CASE WHEN count(value) = count(*) THEN round(sum(value), 5) END AS value FROM p GROUP BY vec_id")
def aod_sum(spark, d):
    return profiles(spark, d).select("vec_id", F.round(ops.profile_sum(F.col("values")), 5).alias("value"))


@query(f"WITH {PROFILES} SELECT vec_id, level_idx, round(value / nullif(first_value(value) OVER (PARTITION BY vec_id ORDER BY level_idx), 0), 3) AS ratio FROM levels")
def vertical_ratio(spark, d):
    return ops.vertical_ratio(_levels(spark, d), "vec_id").select("vec_id", "level_idx", F.round("ratio", 3).alias("ratio"))


@query(f"WITH {PROFILES} SELECT vec_id, CAST(65 - level_idx AS INT) AS level_idx, round(value, 6) AS value FROM levels")
def level_reverse(spark, d):
    return _out(ops.level_reverse(_levels(spark, d), F.lit(64)).select("vec_id", "level_idx", "value"))


def _moved(sql_row: str, sql_col: str) -> str:
    return f"WITH {SAMPLES}, {cells_sql('A', 'a')} SELECT {sql_row} AS row, {sql_col} AS col, level_idx, round(value, 6) AS value FROM a"


@query(_moved("17 - row", "col"))
def flip_ud(spark, d):
    return _out(ops.flip_ud(cells(spark, d, "A"), 18))


@query(_moved("row", "35 - col"))
def flip_lr(spark, d):
    return _out(ops.flip_lr(cells(spark, d, "A"), 36))


@query(_moved("col", "row"))
def transpose(spark, d):
    return _out(ops.transpose(cells(spark, d, "A")))


@query(f"WITH {SAMPLES}, {cells_sql('A', 'a')} SELECT row, col, len(b) AS n_bands, round(b[1], 6) AS first, round(b[-1], 6) AS last FROM (SELECT row, col, list(value ORDER BY level_idx) AS b FROM a GROUP BY ALL)")
def stack_bands(spark, d):
    got = ops.stack_bands(cells(spark, d, "A"), "row", "col")
    return got.select("row", "col", F.size("bands").cast("long").alias("n_bands"), r6(F.element_at("bands", 1)).alias("first"), r6(F.element_at("bands", -1)).alias("last"))


@query(
    f"""WITH {SAMPLES}, {cells_sql('A', 'a')}, k AS (SELECT unnest(range(0, 5)) AS chunk)
SELECT chunk, row, col, level_idx FROM a, k WHERE col BETWEEN chunk * 9 AND chunk * 9 + 9"""
)
def chunk_overlap(spark, d):
    return ops.chunk_overlap(cells(spark, d, "A"), "col", 10, 1).select("chunk", "row", "col", "level_idx")


@query(f"{AR} SELECT row, col, level_idx, round(CASE WHEN r.value - 25 > 0 THEN r.value - 25 ELSE a.value END, 6) AS value FROM a LEFT JOIN r USING (row, col, level_idx)")
def positive_overlay(spark, d):
    source = cells(spark, d, "R").withColumn("value", F.col("value") - 25)
    return _out(ops.positive_overlay(cells(spark, d, "A"), source, ops.CELL))


@query(f"{AR} SELECT row, col, level_idx, round(CASE WHEN r.value - 30 > -9 AND r.value - 30 <= 5 THEN r.value - 30 ELSE a.value END, 6) AS value FROM a LEFT JOIN r USING (row, col, level_idx)")
def conditional_overlay(spark, d):
    source = cells(spark, d, "R").withColumn("value", F.col("value") - 30)
    return _out(ops.conditional_overlay(cells(spark, d, "A"), source, ops.CELL, -9, 5))


@query(f"{AR} SELECT row, col, level_idx, round(CASE WHEN level_idx = 1 AND r.value > 0 THEN r.value ELSE a.value END, 6) AS value FROM a LEFT JOIN r USING (row, col, level_idx)")
def pm_update(spark, d):
    """The model's ground level is replaced by the satellite's where that is positive."""
    return _out(ops.positive_overlay(cells(spark, d, "A"), cells(spark, d, "R").filter("level_idx = 1"), ops.CELL))


@query(f"WITH {SAMPLES}, {cells_sql('A', 'a')} SELECT row, col, CASE level_idx WHEN 5 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS level_idx, round(value, 6) AS value FROM a WHERE level_idx IN (5, 2, 3)")
def time_extract(spark, d):
    return _out(ops.time_extract(cells(spark, d, "A"), [5, 2, 3], "level_idx"))


_SPECIES = f"""WITH {SAMPLES}, s AS (SELECT coverage_id AS species, row, col, level_idx, sum(value) AS value FROM samples GROUP BY ALL),
total AS (SELECT row, col, sum(value) AS total FROM s WHERE level_idx = 1 GROUP BY ALL)"""


def _species(spark, d):
    s = samples(spark, d).groupBy(F.col("coverage_id").alias("species"), "row", "col", "level_idx").agg(F.sum("value").alias("value"))
    return s, s.filter("level_idx = 1").groupBy("row", "col").agg(F.sum("value").alias("value"))


@query(f"{_SPECIES} SELECT species, row, col, round(value / nullif(total, 0), 6) AS fraction FROM s JOIN total USING (row, col) WHERE level_idx = 1")
def species_fraction(spark, d):
    s, total = _species(spark, d)
    return ops.species_fraction(s.filter("level_idx = 1"), total, ["row", "col"]).select("species", "row", "col", r6("fraction").alias("fraction"))


@query(
    f"""{_SPECIES}, f AS (SELECT species, row, col, level_idx, value / nullif(total, 0) AS fraction, total, total * CAST(1 + (row + col) % 4 AS DOUBLE) AS new_total,
  value / nullif(first_value(value) OVER (PARTITION BY species, row, col ORDER BY level_idx), 0) AS ratio FROM s JOIN total USING (row, col))
SELECT species, row, col, level_idx, round(CASE WHEN level_idx = 1 THEN fraction * new_total ELSE ratio * CASE WHEN fraction * total * 2.5e0 > fraction * new_total THEN fraction * new_total ELSE fraction * total END END, 5) AS value FROM f"""
)
def species_rescale(spark, d):
    s, total = _species(spark, d)
    f = ops.species_fraction(s, total, ["row", "col"])
    up = Window.partitionBy("species", "row", "col").orderBy("level_idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    f = f.withColumn("ratio", F.try_divide("value", F.first("value").over(up))).withColumn("new_total", F.col("total") * (1 + (F.col("row") + F.col("col")) % 4).cast("double"))
    value = ops.species_rescale(F.col("fraction"), F.col("ratio"), F.col("level_idx") == 1, F.col("new_total"), F.col("total"), 2.5)
    return f.select("species", "row", "col", "level_idx", F.round(value, 5).alias("value"))


@query("SELECT n_nationkey // 5 AS row, CAST(round(sum(n_nationkey), 6) AS DOUBLE) AS value FROM nation GROUP BY ALL")
def pm_sum(spark, d):
    """Particulate totals are sums of their species."""
    return table(spark, d, "nation").groupBy(F.floor(F.col("n_nationkey") / 5).alias("row")).agg(F.sum("n_nationkey").cast("double").alias("value"))
