"""Next-day slots with historical demand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.operators.aggregates import mode_of

SLOT_HOURS = 24
# What an unseen slot gets when it is filled instead of skipped.
SLOT_DEFAULTS = {"calls_past_30min": 0.0, "calls_past_60min": 0.0, "unified_alarm_level": 1}


def future_slots(df: DataFrame, time: str = "incident_datetime", hours: int = SLOT_HOURS) -> DataFrame:
    """The next hourly timestamps after the latest incident, with hour and day of week."""
    last = df.agg(F.max(F.col(time).cast("timestamp")).alias("last"))
    step = F.explode(F.sequence(F.lit(1), F.lit(hours)))
    at = F.col("last") + F.make_dt_interval(F.lit(0), F.col("i"))
    return last.select("last", step.alias("i")).select(
        at.alias("forecast_timestamp"), F.hour(at).alias("hour"), F.dayofweek(at).alias("day_of_week")
    )


def history_profile(df: DataFrame) -> DataFrame:
    """Mean demand per hour and weekday beside the overall most frequent alarm level."""
    level = mode_of(df, [], "unified_alarm_level").select("unified_alarm_level").scalar()
    return (
        df.groupBy("hour", "day_of_week")
        .agg(F.avg("calls_past_30min").alias("calls_past_30min"), F.avg("calls_past_60min").alias("calls_past_60min"))
        .withColumn("unified_alarm_level", level)
    )


def slot_features(slots: DataFrame, profile: DataFrame, fill: bool = False) -> DataFrame:
    """Slots with their historical demand. Slots without history stay NULL, or get defaults with `fill`.

    The profile has at most 168 rows (hours of a week), so it is broadcast.
    """
    joined = slots.join(F.broadcast(profile), ["hour", "day_of_week"], "left")
    return joined.fillna(SLOT_DEFAULTS) if fill else joined
