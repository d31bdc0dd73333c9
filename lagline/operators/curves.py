"""Summaries of survival and hazard curves on the minute grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagline.operators.ranking import align_to_grid, smooth

# Fixed value: minutes reported in comparisons.
REPORT_MINUTES = (5, 10, 15, 30, 45, 60)


def on_grid(curve: DataFrame, keys: Sequence[str], horizon: int, value: str = "survival") -> DataFrame:
    """Survival step function at the minutes 0..horizon, 1 before the first time."""
    return align_to_grid(curve, keys, "time", value, horizon, 1.0, before=1.0)


def smoothed_hazard(hazard: DataFrame, keys: Sequence[str], horizon: int, value: str = "hazard", window: int = 5) -> DataFrame:
    return smooth(align_to_grid(hazard, keys, "time", value, horizon), keys, "time", value, window)


def _with_steps(curve: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Previous grid point and the ends of the grid beside every point."""
    order = Window.partitionBy(*keys).orderBy("time")
    every = Window.partitionBy(*keys)
    return curve.withColumns({
        "__t0": F.lag("time").over(order), "__s0": F.lag(value).over(order),
        "__lo": F.min("time").over(every), "__hi": F.max("time").over(every),
    })


def _median(value: str) -> Column:
    s, t, t0, s0 = F.col(value), F.col("time"), F.col("__t0"), F.col("__s0")
    cross = F.when((s == 0.5) | t0.isNull() | (s0 == s), t).otherwise(t0 + (0.5 - s0) * (t - t0) / (s - s0))
    first = F.min_by(F.when(s <= 0.5, cross), F.when(s <= 0.5, t))
    return F.coalesce(first, F.lit(float("nan"))).alias("median_survival_min")


def _values(value: str, times: Sequence[int]) -> list[Column]:
    clamp = lambda m: F.least(F.greatest(F.lit(float(m)), F.col("__lo")), F.col("__hi"))
    return [F.max(F.when(F.col("time") == clamp(m), F.col(value))).alias(f"S({m}m)") for m in times]


def median_interpolated(curve: DataFrame, keys: Sequence[str], value: str = "survival") -> DataFrame:
    """Time at which S crosses one half, linear between grid points; NaN if it never does."""
    return _with_steps(curve, keys, value).groupBy(*keys).agg(_median(value))


def values_at(curve: DataFrame, keys: Sequence[str], times: Sequence[int] = REPORT_MINUTES, value: str = "survival") -> DataFrame:
    """S at the report minutes, clamped to the grid, one column each."""
    return _with_steps(curve, keys, value).groupBy(*keys).agg(*_values(value, times))


def hazard_peak(hazard: DataFrame, keys: Sequence[str], value: str = "hazard") -> DataFrame:
    """Largest hazard and its earliest time."""
    best = F.min(F.struct((-F.col(value)).alias("h"), F.col("time").alias("t")))
    return hazard.groupBy(*keys).agg(best.alias("b")).select(
        *keys, F.col("b.t").alias("hazard_peak_time_min"), (-F.col("b.h")).alias("hazard_peak_magnitude")
    )


def sanity(curve: DataFrame, keys: Sequence[str], value: str = "survival", tolerance: float = 1e-10) -> DataFrame:
    """Start, end, monotony, range and completeness of a survival curve."""
    w = Window.partitionBy(*keys).orderBy("time")
    s = F.col(value)
    rows = curve.withColumn("__step", s - F.lag(value).over(w))
    bad = s.isNull() | F.isnan(s)
    return rows.groupBy(*keys).agg(
        F.min_by(value, "time").alias("start_value"),
        F.max_by(value, "time").alias("end_value"),
        F.coalesce(F.bool_and(F.col("__step") <= tolerance), F.lit(True)).alias("monotone"),
        F.bool_and((s >= 0) & (s <= 1)).alias("in_range"),
        F.bool_or(bad).alias("contains_nan"),
    )


def cross_city_summary(survival: DataFrame, hazard: DataFrame, a: str, b: str, key: str = "city") -> DataFrame:
    """One row per city, and a difference row (b minus a) that also holds the ratio of hazard peaks (a over b)."""
    keys = [key]
    summary = _with_steps(survival, keys, "survival").groupBy(key).agg(
        _median("survival"), *_values("survival", REPORT_MINUTES)
    )
    table = summary.join(hazard_peak(hazard, keys), keys)
    metrics = [c for c in table.columns if c != key]
    of = lambda city, c: F.max(F.when(F.col(key) == city, F.col(c)))
    none = F.lit(None).cast("double").alias("hazard_peak_ratio")
    ratio = (of(a, "hazard_peak_magnitude") / of(b, "hazard_peak_magnitude")).alias("hazard_peak_ratio")
    rows = [F.struct(F.lit(city).alias(key), *[of(city, c).alias(c) for c in metrics], none) for city in (a, b)]
    difference = [(of(b, c) - of(a, c)).alias(c) for c in metrics]
    rows.append(F.struct(F.lit(f"Difference ({b} - {a})").alias(key), *difference, ratio))
    return table.agg(F.array(*rows).alias("r")).select(F.inline("r"))
