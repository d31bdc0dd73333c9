"""Ranks, top-k, rolling means and grid alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1..n within each group. Meant for result tables (one row per feature); order must break ties."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))


def top_k_within(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark limits each group before the shuffle as well."""
    return rank_within(df, groups, order, "__r").filter(F.col("__r") <= k).drop("__r")


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def smooth(df: DataFrame, groups: Sequence[str], order: str, value: str, window: int = 5) -> DataFrame:
    """Centred rolling mean over `window` rows, shorter at the ends; 1 or less leaves the series as it is."""
    if window <= 1:
        return df
    left = window // 2
    w = Window.partitionBy(*groups).orderBy(order).rowsBetween(-left, window - 1 - left)
    return df.withColumn(value, F.avg(value).over(w))


def align_to_grid(
    df: DataFrame, groups: Sequence[str], time: str, value: str, horizon: int, default: float = 0.0,
    before: float | None = None,
) -> DataFrame:
    """Step series on the minutes 0..horizon: last value at or before the minute, else the next one, else `default`.

    With `before`, that value holds from before the first minute on. The first row of a group brings the grid along, so
    the series is read once; series and grid are merged in windows over one partitioning. A group without rows has none.
    """
    own = F.struct(F.col(time).cast("double").alias("time"), F.col(value).cast("double").alias("v"), F.lit(0).alias("g"))
    minutes = F.transform(
        F.sequence(F.lit(0), F.lit(int(horizon))),
        lambda m: F.struct(m.cast("double").alias("time"), F.lit(None).cast("double").alias("v"), F.lit(1).alias("g")),
    )
    start = F.array(own) if before is None else F.array(
        own, F.struct(F.lit(-1.0).alias("time"), F.lit(float(before)).alias("v"), F.lit(0).alias("g"))
    )
    first = F.row_number().over(Window.partitionBy(*groups).orderBy(time)) == 1
    rows = df.select(*groups, F.when(first, F.concat(start, minutes)).otherwise(F.array(own)).alias("__rows"))
    merged = rows.select(*groups, F.inline("__rows"))
    w = Window.partitionBy(*groups).orderBy("time", "g").rowsBetween(Window.unboundedPreceding, 0)
    merged = merged.select(*groups, "time", "g", F.last("v", ignorenulls=True).over(w).alias("f"))
    back = Window.partitionBy(*groups).orderBy("time").rowsBetween(0, Window.unboundedFollowing)
    filled = F.coalesce(F.col("f"), F.first("f", ignorenulls=True).over(back), F.lit(default))
    return merged.filter("g = 1").select(*groups, "time", filled.alias(value))
