"""Averages and difference statistics. Missing values are skipped; deviations are those of a population."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Groups up to which their figures are broadcast.
FEW = 10_000


def add_cells(samples: DataFrame, size: float = 10.0) -> DataFrame:
    """samples with the north-up grid cell (row, col) that holds each."""
    return samples.withColumn("row", F.floor((90 - F.col("lat")) / size).cast("int")).withColumn("col", F.floor((F.col("lon") + 180) / size).cast("int"))


def average(df: DataFrame, *keys: str) -> DataFrame:
    """The mean of value by keys: none is the spatial average, cell and level the temporal one."""
    return df.groupBy(*keys).agg(F.avg("value").alias("value"))


def temporal_average(df: DataFrame) -> DataFrame:
    return average(df, "coverage_id", "row", "col", "level_idx")


def band_statistics(df: DataFrame, *keys: str) -> DataFrame:
    """Extremes, mean and population deviation of value by keys, without keys of all cells; missing values don't count."""
    return df.groupBy(*keys).agg(F.min("value").alias("v_min"), F.max("value").alias("v_max"), F.avg("value").alias("v_mean"), F.stddev_pop("value").alias("v_std"))


def difference(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Cells that both have, with d = a - b; missing in one is missing in d."""
    return a.withColumnRenamed("value", "va").join(b.withColumnRenamed("value", "vb"), on).withColumn("d", F.col("va") - F.col("vb"))


def difference_stats(diff: DataFrame, *keys: str) -> DataFrame:
    return diff.groupBy(*keys).agg(F.avg("d").alias("d_mean"), F.stddev_pop("d").alias("d_std"), F.min("d").alias("d_min"), F.max("d").alias("d_max"))


def slice_stats(df: DataFrame, key: str, index: str, t: str, size: int) -> DataFrame:
    """Mean, first and last time per slice of so many scan lines."""
    return df.groupBy(key, F.floor(F.col(index) / size).alias("slice")).agg(
        F.avg(t).alias("t_mean"), F.min_by(t, index).alias("t_first"), F.max_by(t, index).alias("t_last")
    )


def daily_station_average(rows: DataFrame, *keys: str) -> DataFrame:
    """Mean of the non-negative values per day."""
    return rows.filter("value >= 0").groupBy(*keys, F.to_date("t").alias("day")).agg(F.avg("value").alias("value"))


def level_mean_height(df: DataFrame, *keys: str) -> DataFrame:
    """Mean height per level, at least 0."""
    return df.groupBy(*keys).agg(F.greatest(F.avg("height"), F.lit(0.0)).alias("height"))


def chunk_row_means(df: DataFrame, chunk: int = 1000) -> DataFrame:
    """Mean height per chunk of columns and row, where that is not negative."""
    return df.groupBy(F.floor(F.col("col") / chunk).alias("chunk"), "row").agg(F.avg("value").alias("value")).filter("value >= 0")


def ols_fit(df: DataFrame, x: str, y: str, *keys: str) -> DataFrame:
    """df with `fitted`, the least squares line of y on x of its group.

    Groups are fitted by an aggregate and joined back; if the groups are few, which is counted, their lines are broadcast and
    the rows stay where they are."""
    keys = keys or ("__all",)
    df = df.withColumn("__all", F.lit(0)) if keys == ("__all",) else df
    line = df.groupBy(*keys).agg(F.regr_slope(y, x).alias("m"), F.regr_intercept(y, x).alias("q"))
    line = F.broadcast(line) if keys == ("__all",) or df.select(*keys).distinct().limit(FEW + 1).count() <= FEW else line
    return df.join(line, list(keys)).withColumn("fitted", F.col("m") * F.col(x) + F.col("q")).drop("__all")


def right_distances(df: DataFrame, distance: Column, *grid: str) -> DataFrame:
    """Swath pixels with `gap`, the distance to the right neighbour (the last of a line takes the one before it), and
    `threshold`: the gap, or twice the grid's mean gap where the gap is below the mean."""
    line = Window.partitionBy(*grid, "row").orderBy("col")
    df = df.withColumn("lat2", F.lead("lat").over(line)).withColumn("lon2", F.lead("lon").over(line)).withColumn("own", distance)
    df = df.withColumn("gap", F.coalesce("own", F.lag("own").over(line)))
    if grid:
        df = df.join(df.groupBy(*grid).agg(F.avg("own").alias("mean_gap")), list(grid))
    else:  # one row, so it is broadcast
        df = df.withColumn("g", F.lit(0)).join(F.broadcast(df.groupBy(F.lit(0).alias("g")).agg(F.avg("own").alias("mean_gap"))), "g").drop("g")
    return df.withColumn("threshold", F.when(F.col("gap") < F.col("mean_gap"), 2 * F.col("mean_gap")).otherwise(F.col("gap"))).drop("lat2", "lon2", "own")
