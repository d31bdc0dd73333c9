"""Survival view, Kaplan-Meier estimates and binned hazards, for any number of strata in one job.

Durations carry two decimals and are censored at the horizon, so each stratum has a bounded number of distinct
times (6,000 at 60 minutes) however many rows it has. One grouped count collapses the rows to that risk table;
every window below runs on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagline.functions.expressions import CENSOR_MINUTES, THRESHOLDS

DURATION = "response_minutes"
EVENT = "event_indicator"
# Fixed value: decimals of the recorded minutes.
RESOLUTION = 2


def valid_rows(df: DataFrame, duration: str = DURATION, event: str = EVENT) -> DataFrame:
    t = F.col(duration)
    return df.where(F.col(event).isin(0, 1) & (t.isNull() | (t > 0)))


def censor_columns(horizon: float = CENSOR_MINUTES, duration: str = DURATION, event: str = EVENT) -> dict[str, Column]:
    """Uniform right censoring: unknown or later durations end at the horizon without an event."""
    t = F.col(duration)
    observed = F.coalesce((t <= horizon) & (F.col(event) == 1), F.lit(False))
    return {duration: F.coalesce(F.least(t, F.lit(float(horizon))), F.lit(float(horizon))), event: observed.cast("int")}


def survival_view(df: DataFrame, keep: Sequence[str], horizon: float = CENSOR_MINUTES) -> DataFrame:
    """Duration in (0, horizon], event in {0, 1}, and the columns to keep."""
    c = censor_columns(horizon)
    return valid_rows(df).select(*keep, *[e.alias(n) for n, e in c.items()])


def admin_censoring_report(
    df: DataFrame, keys: Sequence[str], predictors: Sequence[str], horizon: float = CENSOR_MINUTES
) -> DataFrame:
    """How many rows were censored and why, and how many the missing predictors cost, in one pass."""
    t = F.col(DURATION)
    known = F.lit(True)
    for p in predictors:
        known = known & F.col(p).isNotNull()
    count = lambda cond: F.count(F.when(cond, 1))
    return df.groupBy(*keys).agg(
        count(t.isNull()).alias("censored_from_null"),
        count(t > horizon).alias("censored_from_over"),
        count(~known).alias("dropped_missing_predictors"),
        count(known).alias("rows_final"),
        count(known & (t <= horizon) & (F.col(EVENT) == 1)).alias("events_final"),
    )


def risk_table(view: DataFrame, strata: Sequence[str]) -> DataFrame:
    """Per stratum and distinct time: events d, censored c, at risk n."""
    t = F.round(DURATION, RESOLUTION).alias("time")
    per_time = view.groupBy(*strata, t).agg(
        F.sum(F.col(EVENT)).cast("bigint").alias("d"), F.count("*").alias("__rows")
    )
    # Running sum from the latest time down; a frame to unbounded following would be quadratic.
    later = Window.partitionBy(*strata).orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, 0)
    return per_time.select(
        *strata, "time", "d", (F.col("__rows") - F.col("d")).alias("c"), F.sum("__rows").over(later).alias("n")
    )


def cumulative_product(factor: Column, window) -> Column:
    """Running product of factors in [0, 1]: exp of summed logs, and 0 from the first zero on."""
    logs = F.sum(F.when(factor > 0, F.log(factor)).otherwise(F.lit(0.0))).over(window)
    return F.when(F.min(factor).over(window) <= 0, F.lit(0.0)).otherwise(F.exp(logs))


def kaplan_meier(risk: DataFrame, strata: Sequence[str]) -> DataFrame:
    """S(t) at every distinct time."""
    w = Window.partitionBy(*strata).orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    return risk.withColumn("survival", cumulative_product(1 - F.col("d") / F.col("n"), w))


def _step_value(t: float) -> Column:
    """S at the last time not after t, 1 before the first."""
    return F.coalesce(F.max_by("survival", F.when(F.col("time") <= t, F.col("time"))), F.lit(1.0))


def _first_half() -> Column:
    """First time with S at or below one half, compared at nine decimals: an S of exactly one half carries noise."""
    return F.coalesce(F.min(F.when(F.round("survival", 9) <= 0.5, F.col("time"))), F.lit(float("inf")))


def survival_at(curve: DataFrame, strata: Sequence[str], times: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Step lookup: S at the last time not after each threshold (1 before the first), and its complement."""
    items = [
        F.struct(
            F.lit(float(t)).alias("threshold_min"),
            _step_value(t).alias("survival_prob"),
        )
        for t in times
    ]
    return (
        curve.groupBy(*strata).agg(F.array(*items).alias("__t"))
        .select(*strata, F.inline("__t"))
        .withColumn("prob_arrived", 1 - F.col("survival_prob"))
    )


def median_survival(curve: DataFrame, strata: Sequence[str]) -> DataFrame:
    """First time with S at or below one half; infinite when it is never reached."""
    return curve.groupBy(*strata).agg(_first_half().alias("median_survival"))


def validation(view: DataFrame, strata: Sequence[str], times: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Estimated S(t) beside the share of observed events later than t, with both medians.

    One aggregate over the curve: shares and the event median follow from its event counts.
    """
    curve = kaplan_meier(risk_table(view, strata), strata)
    d = F.col("d")
    items = [
        F.struct(
            F.lit(float(t)).alias("threshold_min"),
            _step_value(t).alias("survival_prob"),
            (F.sum(F.when(F.col("time") > t, d).otherwise(0)) / F.sum(d)).alias("empirical_survival"),
        )
        for t in times
    ]
    return curve.groupBy(*strata).agg(
        F.expr("percentile(time, 0.5, d)").alias("event_median"), _first_half().alias("median_survival"),
        F.array(*items).alias("__t"),
    ).select(*strata, "event_median", "median_survival", F.inline("__t"))


def binned_hazard(
    risk: DataFrame, strata: Sequence[str], width: float = 2.0, horizon: float = CENSOR_MINUTES
) -> DataFrame:
    """Per bin: at risk at its start, events inside, and their ratio.

    Bins cover [0, horizon); rows censored at the horizon stay at risk to the end. Empty bins are kept.
    """
    bins = int(round(horizon / width))
    b = F.floor(F.round(F.col("time") / width, 9)).cast("int")
    filled = risk.groupBy(*strata, b.alias("bin")).agg(F.sum("d").alias("events"), F.sum(F.col("d") + F.col("c")).alias("rows"))
    # A stratum has at most bins + 1 filled bins: kept as a map, they fill the grid without a join.
    found = filled.groupBy(*strata).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", F.struct("events", "rows").alias("s")))).alias("m")
    )
    grid = found.select(*strata, "m", F.explode(F.sequence(F.lit(0), F.lit(bins))).alias("bin"))
    later = Window.partitionBy(*strata).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    cell = F.try_element_at("m", F.col("bin"))
    at_risk = grid.select(*strata, "bin", cell["events"].alias("events"), cell["rows"].alias("rows")).select(
        *strata, "bin", F.coalesce("events", F.lit(0)).alias("events"),
        F.sum(F.coalesce("rows", F.lit(0))).over(later).alias("at_risk"),
    )
    return at_risk.filter(F.col("bin") < bins).select(
        *strata,
        (F.col("bin") * width).alias("bin_start"),
        ((F.col("bin") + 1) * width).alias("bin_end"),
        "at_risk",
        "events",
        F.when(F.col("at_risk") > 0, F.col("events") / F.col("at_risk")).alias("hazard"),
    )
