"""Registered descriptive queries: tails, service levels, areas, categories, temporal patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from lagline.functions import expressions as x
from lagline.operators import aggregates as agg
from lagline.plans.inputs import INC_SQL, MODEL_SQL, counted_model_ready, incidents, model_ready
from lagline.plans.registry import query

DONE = " WHERE response_minutes IS NOT NULL "


@query("ag_count_by", INC_SQL + "SELECT city, incident_category, unified_call_source, count(*) AS n FROM inc GROUP BY ALL")
def ag_count_by(spark, d):
    return agg.frequency(incidents(spark, d), "city", "incident_category", "unified_call_source")


@query(
    "ag_gold_summary",
    """WITH s AS (SELECT dayname(o_orderdate) AS day_of_week, dayofweek(o_orderdate) IN (0, 6) AS is_weekend,
      CASE WHEN l_partkey % 24 <= 5 THEN 'Night (12AM-6AM)' WHEN l_partkey % 24 <= 11 THEN 'Morning (6AM-12PM)'
        WHEN l_partkey % 24 <= 17 THEN 'Afternoon (12PM-6PM)' ELSE 'Evening (6PM-12AM)' END AS time_of_day,
      l_quantity AS m, CAST(date_diff('day', o_orderdate, l_shipdate) AS DOUBLE) AS dur, CAST(round(l_tax * 100) AS INTEGER) AS rescued
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT day_of_week, time_of_day, is_weekend, CASE WHEN m < 5 THEN 'Excellent (<5 min)' WHEN m < 10 THEN 'Good (5-10 min)'
        WHEN m < 15 THEN 'Fair (10-15 min)' ELSE 'Poor (>15 min)' END AS response_time_category,
      count(*) AS total_incidents, round(avg(m), 6) AS avg_response_time_minutes, round(avg(dur), 6) AS avg_incident_duration_minutes,
      count(*) FILTER (rescued > 0) AS incidents_with_rescues, CAST(sum(rescued) AS BIGINT) AS total_persons_rescued
    FROM s GROUP BY ALL""",
)
def ag_gold_summary(spark, d):
    from lagline.sources.tables import load

    li = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "l_tax")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    silver = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.date_format("o_orderdate", "EEEE").alias("day_of_week"),
        x.quarter_of_day(F.col("l_partkey") % 24, x.TIME_OF_DAY).alias("time_of_day"),
        x.is_weekend(F.dayofweek("o_orderdate")).alias("is_weekend"),
        x.response_band("l_quantity").alias("response_time_category"),
        F.col("l_quantity").alias("response_time_minutes"),
        F.datediff("l_shipdate", "o_orderdate").cast("double").alias("incident_duration_minutes"),
        F.round(F.col("l_tax") * 100).cast("int").alias("persons_rescued"),
    )
    return agg.gold_summary(silver, decimals=6)


@query(
    "ag_response_summary",
    INC_SQL + """SELECT city, round(avg(response_minutes), 6) AS mean, quantile_disc(response_minutes, 0.5) AS median,
      quantile_disc(response_minutes, 0.9) AS p90, quantile_disc(response_minutes, 0.95) AS p95 FROM inc""" + DONE + "GROUP BY city",
)
def ag_response_summary(spark, d):
    return agg.response_summary(incidents(spark, d), ["city"], decimals=6)


@query(
    "ag_percentiles",
    INC_SQL + "SELECT city, " + ", ".join(f"quantile_disc(response_minutes, {p / 100}) AS p{p}" for p in (50, 75, 90, 95))
    + " FROM inc" + DONE + "GROUP BY city",
)
def ag_percentiles(spark, d):
    return agg.percentile_table(incidents(spark, d), ["city"])


@query(
    "ag_exact_percentile",
    INC_SQL + """SELECT city, location_area, round(quantile_cont(response_minutes, 0.5), 6) AS median_response,
      round(quantile_cont(response_minutes, 0.9), 6) AS p90_response FROM inc""" + DONE + "GROUP BY ALL",
)
def ag_exact_percentile(spark, d):
    out = agg.exact_percentiles(
        incidents(spark, d), ["city", "location_area"], "response_minutes", {"median_response": 0.5, "p90_response": 0.9}
    )
    return out.withColumns({c: F.round(c, 6) for c in ("median_response", "p90_response")})


@query(
    "ag_skewness",
    INC_SQL + """SELECT city, round(avg(pow(response_minutes - m, 3)) / pow(avg(pow(response_minutes - m, 2)), 1.5), 6) AS skewness
    FROM inc JOIN (SELECT city, avg(response_minutes) AS m FROM inc GROUP BY 1) USING (city)""" + DONE + "GROUP BY city",
)
def ag_skewness(spark, d):
    return agg.skewness(incidents(spark, d), ["city"], decimals=6)


@query(
    "ag_iqr_outliers",
    INC_SQL + """, q AS (SELECT city, quantile_disc(response_minutes, 0.25) AS q1, quantile_disc(response_minutes, 0.75) AS q3
      FROM inc WHERE response_minutes IS NOT NULL GROUP BY 1),
    b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
    c AS (SELECT city, q1, q3, lo, hi, count(*) AS n_total, count(*) FILTER (response_minutes < lo) AS a,
      count(*) FILTER (response_minutes > hi) AS z FROM inc JOIN b USING (city) WHERE response_minutes IS NOT NULL GROUP BY ALL)
    SELECT city, q1, q3, round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound, n_total, a AS n_lower_outliers,
      z AS n_upper_outliers, a + z AS n_outliers, round((a + z) / n_total * 100, 6) AS pct_outliers FROM c""",
)
def ag_iqr_outliers(spark, d):
    return agg.outlier_profile(incidents(spark, d), ["city"], decimals=6)


@query(
    "ag_sla_breach",
    INC_SQL + """SELECT city, round(count(*) FILTER (response_minutes > 5) / count(*) * 100, 6) AS pct_over_5min,
      round(count(*) FILTER (response_minutes > 8) / count(*) * 100, 6) AS pct_over_8min FROM inc""" + DONE + "GROUP BY city",
)
def ag_sla_breach(spark, d):
    return agg.sla_breach(incidents(spark, d), ["city"], decimals=6)


@query(
    "ag_threshold_risk",
    INC_SQL + """SELECT city, threshold_min, count(*) FILTER (response_minutes > threshold_min) AS n_exceed, count(*) AS n_total,
      round(count(*) FILTER (response_minutes > threshold_min) / count(*) * 100, 6) AS exceed_pct
    FROM inc, (VALUES (8.0::DOUBLE), (10.0::DOUBLE)) t(threshold_min)""" + DONE + "GROUP BY ALL",
)
def ag_threshold_risk(spark, d):
    return agg.threshold_risk(incidents(spark, d), ["city"], (8, 10), decimals=6)


_DELAY = """count(*) AS total_incidents, CAST(sum(delay_indicator) AS BIGINT) AS delayed_incidents,
  round(avg(delay_indicator) * 100, 6) AS delay_percent FROM inc"""


@query(
    "ag_delay_rate",
    INC_SQL + f"SELECT city, {_DELAY} GROUP BY 1 UNION ALL SELECT 'all', {_DELAY}",
)
def ag_delay_rate(spark, d):
    return agg.delay_rate(incidents(spark, d), ["city"], decimals=6, overall=True)


@query(
    "ag_censoring",
    INC_SQL + """SELECT city, count(*) AS n_total, count(*) FILTER (event_indicator = 1) AS n_completed,
      count(*) FILTER (event_indicator = 0) AS n_censored, round(count(*) FILTER (event_indicator = 0) / count(*) * 100, 6) AS pct_censored
    FROM inc GROUP BY 1""",
)
def ag_censoring(spark, d):
    return agg.censoring_summary(incidents(spark, d), ["city"], decimals=6)


@query(
    "ag_hourly",
    INC_SQL + """SELECT city, hour, count(*) AS incident_volume, round(avg(response_minutes), 6) AS avg_response,
      quantile_disc(response_minutes, 0.9) AS p90_response, round(avg(delay_indicator) * 100, 6) AS delay_percent
    FROM inc GROUP BY ALL""",
)
def ag_hourly(spark, d):
    return agg.hourly_profile(incidents(spark, d), ["city"], decimals=6)


def _by(keys, p=90):
    return INC_SQL + f"""SELECT {keys}, count(*) AS n_completed, round(avg(response_minutes), 6) AS mean_response,
      quantile_disc(response_minutes, 0.5) AS median_response, quantile_disc(response_minutes, {p / 100}) AS p{p}_response
    FROM inc WHERE response_minutes IS NOT NULL GROUP BY ALL"""


@query("ag_weekend", _by("city, day_of_week IN (1, 7) AS is_weekend"))
def ag_weekend(spark, d):
    rows = incidents(spark, d).withColumn("is_weekend", x.is_weekend("day_of_week"))
    return agg.response_by(rows, ["city", "is_weekend"], decimals=6)


@query("ag_seasonal", _by("city, season"))
def ag_seasonal(spark, d):
    out = agg.response_by(incidents(spark, d), ["city", "season"], decimals=6)
    return out.orderBy("city", x.preferred_position("season", x.SEASON_LEVELS))


@query("ag_area_perf", _by("city, location_area", 95))
def ag_area_perf(spark, d):
    return agg.response_by(incidents(spark, d), ["city", "location_area"], p=0.95, decimals=6)


@query(
    "ag_area_volume",
    INC_SQL + """SELECT city, location_area, count(*) AS n_total, count(*) - count(response_minutes) AS n_censored,
      count(response_minutes) AS n_completed, round((count(*) - count(response_minutes)) / count(*) * 100, 6) AS pct_censored
    FROM inc GROUP BY ALL""",
)
def ag_area_volume(spark, d):
    return agg.area_volume(incidents(spark, d), ["city", "location_area"], decimals=6)


@query("ag_by_category", _by("city, unified_alarm_level"))
def ag_by_category(spark, d):
    return agg.response_by(incidents(spark, d), ["city", "unified_alarm_level"], decimals=6)


@query(
    "ag_location_features",
    MODEL_SQL + """SELECT city, location_area, count(*) AS call_volume, round(avg(response_minutes), 6) AS mean_response,
      round(avg(calls_past_30min), 6) AS mean_calls_30, round(avg(calls_past_60min), 6) AS mean_calls_60,
      round(avg(unified_alarm_level), 6) AS mean_alarm_level,
      round(avg(CASE WHEN unified_alarm_level >= 3 THEN 1 ELSE 0 END), 6) AS high_alarm_share,
      round(quantile_cont(response_minutes, 0.5), 6) AS median_response, round(quantile_cont(response_minutes, 0.9), 6) AS p90_response
    FROM mr WHERE response_minutes IS NOT NULL GROUP BY ALL HAVING count(*) >= 50""",
)
def ag_location_features(spark, d):
    rows = counted_model_ready(spark, d, ("location_area", "response_minutes", "unified_alarm_level"))
    out = agg.location_features(rows, ["city", "location_area"], weight="n")
    return out.withColumns({c: F.round(c, 6) for c, t in out.dtypes if t == "double"})


@query(
    "ag_city_area_mean",
    INC_SQL + """SELECT city, count(*) AS areas, CAST(sum(n) AS BIGINT) AS n_completed, round(avg(m), 6) AS mean_of_area_means FROM
      (SELECT city, location_area, avg(response_minutes) AS m, count(*) AS n FROM inc WHERE response_minutes IS NOT NULL GROUP BY ALL) GROUP BY 1""",
)
def ag_city_area_mean(spark, d):
    return agg.mean_of_area_means(incidents(spark, d)).withColumn("mean_of_area_means", F.round("mean_of_area_means", 6))


@query(
    "ag_risk_score",
    INC_SQL + """, s AS (SELECT city, location_area, count(*) AS n_total, quantile_disc(response_minutes, 0.9) AS p90_response FROM inc GROUP BY ALL)
    SELECT city, location_area, n_total, p90_response, round(n_total * p90_response, 6) AS risk_score FROM s""",
)
def ag_risk_score(spark, d):
    stats = agg.area_summary(incidents(spark, d), ["city", "location_area"], decimals=6)
    out = agg.risk_score(stats, decimals=6).select("city", "location_area", "n_total", "p90_response", "risk_score")
    return out.orderBy(F.desc("risk_score"))


@query("ag_rare_highrisk", "SELECT * FROM (" + _by("city, location_area") + ") WHERE n_completed BETWEEN 60 AND 500")
def ag_rare_highrisk(spark, d):
    stats = agg.response_by(incidents(spark, d), ["city", "location_area"], decimals=6)
    return agg.rare_high_risk(stats, 60, 500)


@query(
    "ag_summary_stats",
    INC_SQL + "SELECT city, " + ", ".join(
        f"min({c}) AS min_{c}, round(avg({c}), 6) AS mean_{c}, max({c}) AS max_{c}" for c in ("response_minutes", "hour")
    ) + " FROM inc GROUP BY 1",
)
def ag_summary_stats(spark, d):
    out = agg.summary_stats(incidents(spark, d), ["city"], ["response_minutes", "hour"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean_response_minutes", "mean_hour")})


@query(
    "ag_p10_p90",
    MODEL_SQL + " UNION ALL ".join(
        f"SELECT city, '{c}' AS feature, quantile_disc({c}, 0.1) AS low_demand_p10, quantile_disc({c}, 0.9) AS high_demand_p90 FROM mr GROUP BY 1"
        for c in ("calls_past_30min", "calls_past_60min")
    ),
)
def ag_p10_p90(spark, d):
    rows = counted_model_ready(spark, d, ("location_area",))
    return agg.demand_scenarios(rows, ["city"], ["calls_past_30min", "calls_past_60min"], weight="n")


_NUM = ("response_minutes", "hour", "calls_past_30min", "calls_past_60min")


@query(
    "ag_corr",
    MODEL_SQL + " UNION ALL ".join(
        f"SELECT city, '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM mr WHERE response_minutes IS NOT NULL GROUP BY 1"
        for i, a in enumerate(_NUM) for b in _NUM[i + 1:]
    ),
)
def ag_corr(spark, d):
    return agg.correlation_pairs(model_ready(spark, d), ["city"], _NUM).withColumn("r", F.round("r", 6))


@query(
    "ag_box_stats",
    INC_SQL + "SELECT city, incident_category, " + ", ".join(
        f"round(quantile_cont(response_minutes, {p}), 6) AS {n}" for n, p in agg.FIVE.items()
    ) + " FROM inc" + DONE + "GROUP BY ALL",
)
def ag_box_stats(spark, d):
    out = agg.box_stats(incidents(spark, d), ["city", "incident_category"])
    return out.withColumns({c: F.round(c, 6) for c in agg.FIVE})


@query(
    "ag_histogram",
    INC_SQL + """, e AS (SELECT city, min(response_minutes) AS lo, max(response_minutes) AS hi FROM inc GROUP BY 1)
    SELECT city, CAST(least(floor((response_minutes - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n
    FROM inc JOIN e USING (city)""" + DONE + "GROUP BY ALL",
)
def ag_histogram(spark, d):
    return agg.histogram(incidents(spark, d), ["city"])


@query(
    "ag_mode",
    INC_SQL + """SELECT city, unified_alarm_level, n FROM (SELECT city, unified_alarm_level, count(*) AS n FROM inc
      WHERE unified_alarm_level IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY city ORDER BY n DESC, unified_alarm_level) = 1""",
)
def ag_mode(spark, d):
    return agg.mode_of(incidents(spark, d), ["city"], "unified_alarm_level")


@query(
    "ag_top_categories_abs",
    INC_SQL + """, dv AS (SELECT city, location_area, response_minutes - 50 AS v FROM inc WHERE response_minutes IS NOT NULL),
    t AS (SELECT city, location_area, avg(abs(v)) AS mean_abs, count(*) AS n,
        row_number() OVER (PARTITION BY city ORDER BY avg(abs(v)) DESC, location_area) AS rank FROM dv GROUP BY city, location_area)
    SELECT city, location_area, round(mean_abs, 6) AS mean_abs, n, CAST(rank AS INTEGER) AS rank, """
    + ", ".join(n for n in agg.FIVE)
    + " FROM t JOIN (SELECT city, location_area, "
    + ", ".join(f"round(quantile_cont(v, {p}), 6) AS {n}" for n, p in agg.FIVE.items())
    + " FROM dv GROUP BY ALL) USING (city, location_area) WHERE rank <= 8",
)
def ag_top_categories_abs(spark, d):
    rows = incidents(spark, d).withColumn("v", F.col("response_minutes") - 50)
    out = agg.top_categories_by_magnitude(rows, ["city"], "location_area", "v", 8)
    return out.withColumns({c: F.round(c, 6) for c in ("mean_abs", *agg.FIVE)})
