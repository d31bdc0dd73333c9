"""Demand intensity: how many calls came in shortly before each incident.

Both operators count per second first, so their windows run over at most one row per second (and area).
The range window is cut into buckets of the frame length: a frame never reaches past the previous bucket, so
adding each row to its own and to the next bucket gives exact counts without one task holding a whole series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagline.functions.expressions import epoch_seconds

# Output columns and look-back seconds.
LOOKBACKS: Mapping[str, int] = {"calls_past_30min": 1800, "calls_past_60min": 3600}


def calls_per_second(
    df: DataFrame, time: str, keys: Sequence[str], lookbacks: Mapping[str, int], include_current: bool, weight: str | None = None
) -> DataFrame:
    """Counts over each look-back, one row per (keys, second). `weight` names the row counts of rows counted before."""
    span = max(lookbacks.values())
    last = 0 if include_current else -1
    counts = df.select(*keys, epoch_seconds(time).alias("__sec"), (F.col(weight) if weight else F.lit(1)).alias("__w")).groupBy(*keys, "__sec").agg(F.sum("__w").alias("__n"))
    home = F.floor(F.col("__sec") / span)
    # Rows without a time keep a bucket of their own, where a RANGE frame makes them peers of each other only.
    homes = F.when(home.isNull(), F.array(home)).otherwise(F.array(home, home + 1))
    # Dealt out before the hash is worked out, which would be the larger part of what a row takes on disk.
    spread = counts.select(*keys, "__sec", "__n", F.explode(homes).alias("__bucket")).repartition(*keys, "__bucket")
    # Sorting compares the first key's eight leading bytes before whole rows: a hash tells groups apart there, names rarely do.
    w = Window.partitionBy(F.xxhash64(*keys, "__bucket"), *keys, "__bucket").orderBy("__sec")
    windows = {c: F.sum("__n").over(w.rangeBetween(-s, last)) for c, s in lookbacks.items()}
    return (
        spread.select(*keys, "__sec", "__bucket", *[F.coalesce(e, F.lit(0)).alias(c) for c, e in windows.items()])
        .filter(home.eqNullSafe(F.col("__bucket")))
        .select(*keys, "__sec", *lookbacks)
    )


def _attach(df: DataFrame, time: str, keys: Sequence[str], counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    left = df.withColumn("__sec", epoch_seconds(time))
    right = counts.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__sec").alias("__s"), *columns)
    condition = F.col("__sec").eqNullSafe(F.col("__s"))
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return left.join(right, condition, "left").drop("__sec", "__s", *[f"__k_{k}" for k in keys])


def citywide_calls(df: DataFrame, time: str, lookbacks: Mapping[str, int] = LOOKBACKS, weight: str | None = None) -> DataFrame:
    """Calls in [t - lookback, t - 1 s] over the whole table."""
    counts = calls_per_second(df, time, [], lookbacks, include_current=False, weight=weight)
    return _attach(df, time, [], counts, list(lookbacks))


def area_calls(
    df: DataFrame, time: str, area: str, lookbacks: Mapping[str, int] = LOOKBACKS, weight: str | None = None
) -> DataFrame:
    """Other calls of the same area in [t - lookback, t], never below 0."""
    counts = calls_per_second(df, time, [area], lookbacks, include_current=True, weight=weight)
    other = [F.greatest(F.col(c) - 1, F.lit(0)).alias(c) for c in lookbacks]
    return _attach(df, time, [area], counts.select(area, "__sec", *other), list(lookbacks))
