"""Coverage arithmetic, vertical operators and overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ["row", "col", "level_idx"]


def vertical_integral(values: Column, heights: Column) -> Column:
    """Sum of value times layer thickness over a profile's levels, the first from the ground; missing if any level is."""
    layers = F.transform(F.sequence(F.lit(0), F.size(heights) - 1), lambda i: F.get(heights, i) - F.coalesce(F.get(heights, i - 1), F.lit(0.0)))
    return F.aggregate(F.zip_with(values, layers, lambda v, h: v * h), F.lit(0.0), lambda s, x: s + x)


def vertical_integral_rows(df: DataFrame, *keys: str) -> DataFrame:
    """The same for rows (level_idx, height, value)."""
    up = Window.partitionBy(*keys).orderBy("height")
    part = F.col("value") * (F.col("height") - F.coalesce(F.lag("height").over(up), F.lit(0.0)))
    return df.withColumn("part", part).groupBy(*keys).agg(F.when(F.count("part") == F.count("*"), F.sum("part")).alias("value"))


def vertical_ratio(df: DataFrame, *keys: str) -> DataFrame:
    """Each level over the lowest one; nothing where that is 0 or missing."""
    up = Window.partitionBy(*keys).orderBy("level_idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn("ratio", F.try_divide("value", F.first("value").over(up)))


def profile_sum(values: Column) -> Column:
    """Sum over a profile; missing if any level is."""
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def level_reverse(df: DataFrame, levels: Column) -> DataFrame:
    """Levels counted from the other end; levels: how many there are, from 1."""
    return df.withColumn("level_idx", (levels + 1 - F.col("level_idx")).cast("int"))


def flip_ud(df: DataFrame, rows: int) -> DataFrame:
    return df.withColumn("row", F.lit(rows - 1) - F.col("row"))


def flip_lr(df: DataFrame, columns: int) -> DataFrame:
    return df.withColumn("col", F.lit(columns - 1) - F.col("col"))


def transpose(df: DataFrame) -> DataFrame:
    swapped = {"row": "col", "col": "row"}
    return df.select(*[F.col(c).alias(swapped.get(c, c)) for c in df.columns])


def stack_bands(df: DataFrame, *keys: str) -> DataFrame:
    """One row per pixel with its values in level order."""
    levels = F.sort_array(F.collect_list(F.struct("level_idx", "value")))
    return df.groupBy(*keys).agg(F.transform(levels, lambda x: x["value"]).alias("bands"))


def chunk_overlap(df: DataFrame, index: str = "col", size: int = 1000, overlap: int = 1) -> DataFrame:
    """Rows by chunk of so many columns that share `overlap` columns with the next; a shared column is in both."""
    step = size - overlap
    last = F.floor(F.col(index) / step)
    first = F.when((F.col(index) % step < overlap) & (last > 0), last - 1).otherwise(last)
    return df.withColumn("chunk", F.explode(F.sequence(first, last)))


def positive_overlay(target: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    """target with the source's values where those are positive."""
    merged = target.join(source.withColumnRenamed("value", "new"), on, "left")
    return merged.withColumn("value", F.coalesce(F.when(F.col("new") > 0, F.col("new")), F.col("value"))).drop("new")


def conditional_overlay(target: DataFrame, source: DataFrame, on: list[str], least: float = -9.0, most: float = 500.0) -> DataFrame:
    """target with the source's values where there are any, over `least` and not over `most`."""
    merged = target.join(source.withColumnRenamed("value", "new"), on, "left")
    good = (F.col("new") > least) & (F.col("new") <= most)
    return merged.withColumn("value", F.coalesce(F.when(good, F.col("new")), F.col("value"))).drop("new")


def time_extract(cube: DataFrame, steps: list[int], index: str = "t_idx") -> DataFrame:
    """Chosen time steps, counted anew in the order given."""
    new = F.array_position(F.array(*[F.lit(s) for s in steps]), F.col(index))
    return cube.filter(F.col(index).isin(steps)).withColumn(index, (new - 1).cast("int"))


def species_fraction(species: DataFrame, total: DataFrame, on: list[str]) -> DataFrame:
    """Each species' share of the total at the ground."""
    return species.join(total.select(*on, F.col("value").alias("total")), on).withColumn("fraction", F.try_divide("value", "total"))


def species_rescale(fraction: Column, ratio: Column, ground: Column, new_total: Column, old_total: Column, scale: float) -> Column:
    """A species after its total was replaced: fraction times the new total at the ground, and above it the level's
    ratio times a reference, which is the new ground value unless that exceeds `scale` times the old one (then the old)."""
    new, old = fraction * new_total, fraction * old_total
    reference = F.when(old * scale > new, new).otherwise(old)
    return F.when(ground, new).otherwise(ratio * reference)
