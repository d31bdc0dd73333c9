"""Unions, pivots, melts and set comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_tagged(frames: Mapping[str, DataFrame], tag: str = "city") -> DataFrame:
    """Union by column name, each part tagged with its key."""
    return reduce(DataFrame.unionByName, [df.withColumn(tag, F.lit(k)) for k, df in frames.items()])


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def count_pivot(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts by row value and column value, 0 where a pair is absent; values given, so no extra job."""
    counts = df.groupBy(row, column).agg(F.count("*").alias("n"))
    return counts.groupBy(row).pivot(column, list(values)).agg(F.first("n")).fillna(0, subset=list(values))


def mean_matrix(
    df: DataFrame, rows: Sequence[str], column: str, value: str, columns: Sequence[int], decimals: int = 2
) -> DataFrame:
    """Mean of a value by row keys and column, columns spread out (heatmap data)."""
    cells = df.filter(F.col(value).isNotNull()).groupBy(*rows, column).agg(F.round(F.avg(value), decimals).alias("m"))
    wide = cells.groupBy(*rows).pivot(column, list(columns)).agg(F.first("m"))
    return wide.select(*rows, *[F.col(str(c)).alias(f"{column}_{c}") for c in columns])


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def transpose(df: DataFrame, key: str, key_values: Sequence[str], name: str = "metric") -> DataFrame:
    """Summary with one row per key turned into one row per metric and one column per key."""
    metrics = [c for c in df.columns if c != key]
    long = df.select(key, *[F.col(c).cast("double").alias(c) for c in metrics]).unpivot(key, metrics, name, "v")
    return long.groupBy(name).pivot(key, list(key_values)).agg(F.first("v"))


def membership(a: DataFrame, b: DataFrame, key: str, a_only: str, b_only: str, both: str = "common") -> DataFrame:
    """Where each key occurs: in both sets, or in one only."""
    left = a.select(key).distinct().withColumn("in_a", F.lit(True))
    right = b.select(key).distinct().withColumn("in_b", F.lit(True))
    joined = left.join(right, key, "full_outer")
    category: Column = (
        F.when(F.col("in_a") & F.col("in_b"), F.lit(both)).when(F.col("in_a"), F.lit(a_only)).otherwise(F.lit(b_only))
    )
    return joined.select(key, category.alias("category"))
