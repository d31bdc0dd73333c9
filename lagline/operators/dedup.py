"""Deduplication with a repeatable survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by `order`, then by the remaining columns. NULL keys form one group.

    An aggregate rather than a window, so each task sends one candidate per key and a key that holds a large
    share of all rows is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = F.struct(*[F.col(c) for c in [*order, *rest]])
    first = df.groupBy(*keys).agg(F.min(ranked).alias("__first"))
    return first.select(*[F.col(c) if c in keys else F.col("__first")[c].alias(c) for c in df.columns])


def keep_first_within(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Streaming form: drop repeats of a key that arrive within the watermark delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
