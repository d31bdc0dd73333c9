"""Descriptive statistics of response times, service levels and areas.

Every report is one grouped pass; `keys` may name any number of grouping columns, so cities, areas and
categories go through the same code. Rows without a response time count for volume and not for times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagline.session import written

RESPONSE = "response_minutes"
FIVE = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
BUCKETS = 256  # value buckets of a group in which ranks are resolved


def completed(df: DataFrame, value: str = RESPONSE) -> DataFrame:
    return df.filter(F.col(value).isNotNull())


def share(part: Column, whole: Column, decimals: int = 2) -> Column:
    return F.round(part / whole * 100, decimals)


def frequency(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *columns)


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Pairwise equality of columns in which NULL equals NULL, so that no group is lost in a join."""
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of grouped results; a NULL group meets its counterpart."""
    other = right.withColumnsRenamed({k: f"__g{i}" for i, k in enumerate(keys)})
    names = [f"__g{i}" for i in range(len(keys))]
    return left.join(other, same(keys, names)).drop(*names)


def response_summary(df: DataFrame, keys: Sequence[str], decimals: int = 2) -> DataFrame:
    probs = {"median": 0.5, "p90": 0.9, "p95": 0.95}
    out = exact_percentiles(df, keys, RESPONSE, probs, nearest=True, extras={"mean": _mean(RESPONSE)})
    return out.select(*keys, *[F.round(c, decimals).alias(c) for c in ("mean", *probs)])


def percentile_table(df: DataFrame, keys: Sequence[str], value: str = RESPONSE) -> DataFrame:
    """p50, p75, p90, p95 per group, as values that occur."""
    return exact_percentiles(df, keys, value, {f"p{p}": p / 100 for p in (50, 75, 90, 95)}, nearest=True)


def approx_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], accuracy: int = 10_000
) -> DataFrame:
    """Percentiles from one bounded sketch per group; a value's rank is off by at most 1 / accuracy of the rows."""
    q = completed(df, value).groupBy(*keys).agg(F.percentile_approx(value, list(probs.values()), accuracy).alias("__q"))
    return q.select(*keys, *[F.col("__q")[i].alias(n) for i, n in enumerate(probs)])


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Non-NULL values with their count `n`; tasks combine before the shuffle, so hot groups shrink first."""
    return completed(df, value).groupBy(*keys, F.col(value).cast("double").alias(value)).agg(F.count("*").alias("n"))


def _mean(value: str) -> Column:
    """The mean of a value over counted rows; without any, NULL."""
    return F.sum(F.col(value) * F.col("n")) / F.sum(F.when(F.col(value).isNotNull(), F.col("n")))


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    weight: str | None = None,
    nearest: bool = False,
    extras: dict[str, Column] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Exact percentiles without ever gathering a group, interpolated or, if `nearest`, as the value of the nearest rank.

    `weight` names the row counts of rows counted before and written, as they are read several times; these may have
    further columns and a NULL value, which has no rank. `extras` are aggregates over the counted rows, `n` being their
    count, that are computed along.

    Equal values are counted first, in one pass whose result is kept, so no source is read twice. A group's range is cut
    into equal buckets; totals per bucket place each wanted rank in one, and ranks are resolved inside buckets, so a group
    holding most rows is worked on by as many tasks as it has buckets, whatever the scale of its values.
    """
    counts = written(value_counts(df, keys, value), "counts") if weight is None else df.withColumnRenamed(weight, "n")
    ends = counts.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / buckets
    at_bucket = F.when(width > 0, F.floor((F.col(value) - F.col("__lo")) / width)).otherwise(F.lit(0))
    counts = join_groups(counts, ends, keys).withColumns({
        "__b": F.when(F.col(value).isNotNull(), at_bucket), "__n": F.when(F.col(value).isNotNull(), F.col("n")).otherwise(0),
    }).drop("__lo", "__hi")
    per_bucket = counts.groupBy(*keys, "__b").agg(F.sum("__n").alias("__bn"))
    upto = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_bucket.select(
        *keys, "__b",
        F.coalesce(F.sum("__bn").over(upto), F.lit(0)).alias("__before"),
        F.sum("__bn").over(Window.partitionBy(*keys)).alias("__total"),
    )
    inside = Window.partitionBy(*keys, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = join_groups(counts, placed, [*keys, "__b"]).withColumn(
        "__from", F.col("__before") + F.coalesce(F.sum("__n").over(inside), F.lit(0))
    )

    def at(rank: Column) -> Column:
        covers = (F.col("__from") <= rank) & (rank < F.col("__from") + F.col("__n"))
        return F.max(F.when(covers, F.col(value)))

    picks, out = [], []
    for name, p in probs.items():
        if nearest:
            picks.append(at(F.greatest(F.ceil(F.lit(float(p)) * F.col("__total")) - 1, F.lit(0))).alias(name))
            out.append(F.col(name))
            continue
        pos = F.lit(float(p)) * (F.col("__total") - 1)
        picks += [
            at(F.floor(pos)).alias(f"__lo_{name}"),
            at(F.ceil(pos)).alias(f"__hi_{name}"),
            F.max(pos - F.floor(pos)).alias(f"__f_{name}"),
        ]
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out.append((lo + (hi - lo) * F.col(f"__f_{name}")).alias(name))
    more = [column.alias(name) for name, column in (extras or {}).items()]
    return ranked.groupBy(*keys).agg(*picks, *more).select(*keys, *out, *(extras or {}))


def skewness(df: DataFrame, keys: Sequence[str], value: str = RESPONSE, decimals: int = 4) -> DataFrame:
    return completed(df, value).groupBy(*keys).agg(F.round(F.skewness(value), decimals).alias("skewness"))


def outlier_profile(df: DataFrame, keys: Sequence[str], value: str = RESPONSE, decimals: int = 2) -> DataFrame:
    """Quartiles, 1.5 IQR fences, and how many rows lie outside."""
    counts = written(value_counts(df, keys, value), "counts")
    fences = exact_percentiles(counts, keys, value, {"q1": 0.25, "q3": 0.75}, weight="n", nearest=True)
    spread = F.col("q3") - F.col("q1")
    fences = fences.withColumns({"lower_bound": F.col("q1") - 1.5 * spread, "upper_bound": F.col("q3") + 1.5 * spread})
    v, n = F.col(value), F.col("n")
    bounds = ["q1", "q3", "lower_bound", "upper_bound"]
    return (
        join_groups(counts, fences, keys)
        .groupBy(*keys, *bounds)
        .agg(
            F.sum("n").alias("n_total"),
            F.sum(F.when(v < F.col("lower_bound"), n).otherwise(0)).alias("n_lower_outliers"),
            F.sum(F.when(v > F.col("upper_bound"), n).otherwise(0)).alias("n_upper_outliers"),
        )
        .withColumn("n_outliers", F.col("n_lower_outliers") + F.col("n_upper_outliers"))
        .withColumn("pct_outliers", share(F.col("n_outliers"), F.col("n_total"), decimals))
        .select(*keys, *[F.round(b, decimals).alias(b) for b in bounds],
                "n_total", "n_lower_outliers", "n_upper_outliers", "n_outliers", "pct_outliers")
    )


def threshold_risk(
    df: DataFrame, keys: Sequence[str], thresholds: Sequence[float], value: str = RESPONSE, decimals: int = 2
) -> DataFrame:
    """Per threshold: completed rows above it, all completed rows, and the share. One pass for all thresholds."""
    items = [
        F.struct(F.lit(float(t)).alias("threshold_min"), F.count(F.when(F.col(value) > t, 1)).alias("n_exceed"))
        for t in thresholds
    ]
    wide = completed(df, value).groupBy(*keys).agg(F.count("*").alias("n_total"), F.array(*items).alias("__t"))
    return wide.select(*keys, "n_total", F.inline("__t")).withColumn(
        "exceed_pct", share(F.col("n_exceed"), F.col("n_total"), decimals)
    )


def sla_breach(df: DataFrame, keys: Sequence[str], thresholds: Sequence[int] = (5, 8), decimals: int = 2) -> DataFrame:
    """Share of completed rows over each service threshold, one column per threshold."""
    v = F.col(RESPONSE)
    return completed(df).groupBy(*keys).agg(
        *[share(F.count(F.when(v > t, 1)), F.count("*"), decimals).alias(f"pct_over_{t}min") for t in thresholds]
    )


def delay_rate(
    df: DataFrame, keys: Sequence[str], label: str = "delay_indicator", decimals: int = 2, overall: bool = False
) -> DataFrame:
    """All, delayed and share of delayed rows per group; `overall` adds the sum of all groups under the key `all`."""
    parts = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(label).alias("d"), F.count(label).alias("k"))
    if overall:  # the total follows from the counted groups
        names = F.array(F.struct(*keys), F.struct(*[F.lit("all").alias(k) for k in keys]))
        parts = parts.select(F.explode(names).alias("__g"), "n", "d", "k").select("__g.*", "n", "d", "k")
        parts = parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "d", "k")])
    return parts.select(
        *keys, F.col("n").alias("total_incidents"), F.col("d").alias("delayed_incidents"),
        F.round(F.col("d") / F.col("k") * 100, decimals).alias("delay_percent"),
    )


def censoring_summary(df: DataFrame, keys: Sequence[str], event: str = "event_indicator", decimals: int = 2) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(
            F.count("*").alias("n_total"),
            F.count(F.when(F.col(event) == 1, 1)).alias("n_completed"),
            F.count(F.when(F.col(event) == 0, 1)).alias("n_censored"),
        )
        .withColumn("pct_censored", share(F.col("n_censored"), F.col("n_total"), decimals))
    )


def hourly_profile(df: DataFrame, keys: Sequence[str], decimals: int = 2) -> DataFrame:
    """Volume, mean, p90 and delay share by hour, from one pass over the rows."""
    groups = [*keys, "hour"]
    counts = df.groupBy(*groups, F.col(RESPONSE).cast("double").alias(RESPONSE)).agg(
        F.count("*").alias("n"), F.sum("delay_indicator").alias("__d"), F.count("delay_indicator").alias("__k")
    )
    counts = written(counts, "counts")
    extras = {"incident_volume": F.sum("n"), "avg_response": _mean(RESPONSE), "delay_percent": F.sum("__d") / F.sum("__k") * 100}
    out = exact_percentiles(counts, groups, RESPONSE, {"p90_response": 0.9}, weight="n", nearest=True, extras=extras)
    rounded = [F.round(c, decimals).alias(c) for c in ("avg_response", "p90_response", "delay_percent")]
    return out.select(*groups, "incident_volume", *rounded)


def response_by(df: DataFrame, keys: Sequence[str], p: float = 0.9, decimals: int = 2) -> DataFrame:
    """Completed rows, mean, median and one tail percentile per group."""
    tail = f"p{round(p * 100)}_response"
    extras = {"n_completed": F.sum("n"), "mean_response": _mean(RESPONSE)}
    out = exact_percentiles(df, keys, RESPONSE, {"median_response": 0.5, tail: p}, nearest=True, extras=extras)
    return out.select(*keys, "n_completed", *[F.round(c, decimals).alias(c) for c in ("mean_response", "median_response", tail)])


def area_volume(df: DataFrame, keys: Sequence[str], decimals: int = 2) -> DataFrame:
    missing = F.count(F.when(F.col(RESPONSE).isNull(), 1))
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n_total"), missing.alias("n_censored"), F.count(RESPONSE).alias("n_completed"))
        .withColumn("pct_censored", share(F.col("n_censored"), F.col("n_total"), decimals))
    )


def area_summary(df: DataFrame, keys: Sequence[str], p: float = 0.9, decimals: int = 2) -> DataFrame:
    """Volume of all rows beside response statistics of the completed ones.

    Rows are counted once by group and time, a missing time being one of them; areas without any completed row keep
    NULL statistics and a completed count of 0.
    """
    tail = f"p{round(p * 100)}_response"
    counts = written(df.groupBy(*keys, F.col(RESPONSE).cast("double").alias(RESPONSE)).agg(F.count("*").alias("n")), "counts")
    missing = F.col(RESPONSE).isNull()
    extras = {
        "n_total": F.sum("n"), "n_censored": F.sum(F.when(missing, F.col("n")).otherwise(0)),
        "n_completed": F.sum(F.when(missing, 0).otherwise(F.col("n"))), "mean_response": _mean(RESPONSE),
    }
    out = exact_percentiles(counts, keys, RESPONSE, {tail: p}, weight="n", nearest=True, extras=extras)
    return out.select(
        *keys, "n_total", "n_censored", "n_completed", F.round("mean_response", decimals).alias("mean_response"),
        F.round(tail, decimals).alias(tail), share(F.col("n_censored"), F.col("n_total"), decimals).alias("pct_censored"),
    )


def risk_score(area_stats: DataFrame, p: float = 0.9, decimals: int = 2) -> DataFrame:
    score = F.round(F.col("n_total") * F.col(f"p{round(p * 100)}_response"), decimals)
    return area_stats.withColumn("risk_score", score)


def rare_high_risk(stats: DataFrame, low: int = 100, high: int = 1000, p: float = 0.9) -> DataFrame:
    """Groups that are neither tiny nor common, riskiest first."""
    return stats.filter(F.col("n_completed").between(low, high)).orderBy(
        F.desc(f"p{round(p * 100)}_response"), F.desc("n_completed")
    )


def location_features(df: DataFrame, keys: Sequence[str], min_volume: int = 50, weight: str | None = None) -> DataFrame:
    """Risk and demand features per location, locations with too few completed rows left out.

    Rows are counted once by location and time with the sums of the other features, so that they are read and their
    demand is computed once, whatever is derived from the counts. A location may have NULL in any key. `weight` names the
    row counts of rows counted before.
    """
    n = F.col(weight) if weight else F.lit(1)
    level = F.col("unified_alarm_level")
    sums = {"mean_calls_30": F.col("calls_past_30min"), "mean_calls_60": F.col("calls_past_60min"), "mean_alarm_level": level}
    counts = completed(df).groupBy(*keys, F.col(RESPONSE).cast("double").alias(RESPONSE)).agg(
        F.sum(n).alias("n"), F.sum(F.when(level >= 3, n).otherwise(0)).alias("__high"),
        *[F.sum(c * n).alias(f"__s_{name}") for name, c in sums.items()],
        *[F.sum(F.when(c.isNotNull(), n)).alias(f"__c_{name}") for name, c in sums.items()],
    )
    counts = written(counts, "counts")
    extras = {"call_volume": F.sum("n"), "mean_response": _mean(RESPONSE)}
    extras |= {name: F.sum(f"__s_{name}") / F.sum(f"__c_{name}") for name in sums}
    extras["high_alarm_share"] = F.sum("__high") / F.sum("n")
    probs = {"median_response": 0.5, "p90_response": 0.9}
    out = exact_percentiles(counts, keys, RESPONSE, probs, weight="n", extras=extras)
    return out.filter(F.col("call_volume") >= min_volume)


def mean_of_area_means(df: DataFrame, city: str = "city", area: str = "location_area") -> DataFrame:
    """Unweighted mean over areas of their mean response, with area count, per city."""
    per_area = completed(df).groupBy(city, area).agg(F.avg(RESPONSE).alias("m"), F.count("*").alias("n"))
    return per_area.groupBy(city).agg(
        F.count("*").alias("areas"), F.sum("n").alias("n_completed"), F.avg("m").alias("mean_of_area_means")
    )


def summary_stats(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """min, mean, max per column."""
    return df.groupBy(*keys).agg(
        *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("mean", F.avg), ("max", F.max))]
    )


def demand_scenarios(df: DataFrame, keys: Sequence[str], features: Sequence[str], weight: str | None = None) -> DataFrame:
    """Low (P10) and high (P90) level of each demand feature, over rows where all features are known.

    `weight` names the row counts of rows counted before.
    """
    n = F.col(weight) if weight else F.lit(1)
    known = df.na.drop(subset=list(features)).select(*keys, n.alias("__n"), F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("level")) for f in features
    ]).alias("__f"))
    long = known.select(*keys, "__n", F.inline("__f"))
    probs = {"low_demand_p10": 0.1, "high_demand_p90": 0.9}
    kind = dict(long.dtypes)["level"]
    counts = long.groupBy(*keys, "feature", F.col("level").cast("double").alias("level")).agg(F.sum("__n").alias("n"))
    out = exact_percentiles(written(counts, "counts"), [*keys, "feature"], "level", probs, weight="n", nearest=True)
    return out.withColumns({name: F.col(name).cast(kind) for name in probs})


def correlation_pairs(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair over rows without NULLs, long form."""
    known = df.na.drop(subset=list(columns))
    items = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"))
        for i, a in enumerate(columns)
        for b in columns[i + 1:]
    ]
    return known.groupBy(*keys).agg(F.array(*items).alias("__c")).select(*keys, F.inline("__c"))


def box_stats(df: DataFrame, keys: Sequence[str], value: str = RESPONSE) -> DataFrame:
    """Five-number summary per group."""
    return exact_percentiles(df, keys, value, FIVE)


def histogram(df: DataFrame, keys: Sequence[str], value: str = RESPONSE, bins: int = 50) -> DataFrame:
    """Equal-width histogram per group between its own minimum and maximum, the maximum in the last bin."""
    rows = written(value_counts(df, keys, value), "counts").withColumnRenamed(value, "__v")
    ends = rows.groupBy(*keys).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    raw = F.when(width > 0, F.floor((F.col("__v") - F.col("__lo")) / width)).otherwise(F.lit(0))
    return (
        join_groups(rows, ends, keys)
        .select(*keys, F.least(raw, F.lit(bins - 1)).cast("int").alias("bin"), "n")
        .groupBy(*keys, "bin")
        .agg(F.sum("n").alias("n"))
    )


def mode_of(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent value per group; the smaller value wins a tie."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("n"))
    top = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(column).alias("v"))).alias("__b"))
    return top.select(*keys, F.col("__b.v").alias(column), (-F.col("__b.m")).alias("n"))


def mean_abs_importance(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Mean absolute value per feature column, ranked within each group."""
    wide = df.groupBy(*keys).agg(*[F.avg(F.abs(F.col(f).cast("double"))).alias(f) for f in features])
    long = wide.unpivot(list(keys), list(features), "feature", "mean_abs")
    w = Window.partitionBy(*keys).orderBy(F.desc("mean_abs"), "feature")
    return long.withColumn("rank", F.row_number().over(w))


def top_categories_by_magnitude(
    df: DataFrame, keys: Sequence[str], category: str, value: str, k: int
) -> DataFrame:
    """The k categories with the largest mean absolute value, with their five-number summary."""
    counts = written(value_counts(df.filter(F.col(category).isNotNull()), [*keys, category], value), "counts")
    strength = counts.groupBy(*keys, category).agg(
        (F.sum(F.abs(F.col(value)) * F.col("n")) / F.sum("n")).alias("mean_abs"), F.sum("n").alias("n")
    )
    w = Window.partitionBy(*keys).orderBy(F.desc("mean_abs"), category)
    top = strength.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    groups = [*keys, category]
    chosen = written(join_groups(counts, top.select(*groups), groups), "chosen")
    return join_groups(top, exact_percentiles(chosen, groups, value, FIVE, weight="n"), groups)


def gold_summary(silver: DataFrame, decimals: int = 2) -> DataFrame:
    """Counts, mean times and rescues by day, time of day, weekend flag and response band."""
    return silver.groupBy("day_of_week", "time_of_day", "is_weekend", "response_time_category").agg(
        F.count("*").alias("total_incidents"),
        F.round(F.avg("response_time_minutes"), decimals).alias("avg_response_time_minutes"),
        F.round(F.avg("incident_duration_minutes"), decimals).alias("avg_incident_duration_minutes"),
        F.count(F.when(F.col("persons_rescued") > 0, 1)).alias("incidents_with_rescues"),
        F.sum("persons_rescued").alias("total_persons_rescued"),
    )
