"""Registered dedup, set, reshape, join, window and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lagline.operators import aggregates, dedup, drivers, forecast, ranking, reshape, sampling
from lagline.plans.inputs import (
    CITIES, FREIGHT_CALLS_SQL, FREIGHT_SQL, INC_SQL, WEB_CALLS_SQL, WEB_SQL, freight_incidents, freight_model_ready,
    incidents, web_incidents, web_model_ready,
)
from lagline.plans.registry import query
from lagline.sources.tables import load

LINE = ["l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "dd_single",
    """SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem) WHERE r = 1""",
)
def dd_single(spark, d):
    rows = dedup.keep_first(load(spark, d, "lineitem"), ["l_orderkey"], LINE)
    return rows.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))


@query(
    "dd_composite",
    """WITH a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS r FROM lineitem),
    b AS (SELECT *, row_number() OVER (PARTITION BY l_shipdate, l_suppkey, l_returnflag ORDER BY l_orderkey) AS q FROM a WHERE r = 1)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_shipdate FROM b WHERE q = 1""",
)
def dd_composite(spark, d):
    rows = load(spark, d, "lineitem").select("l_orderkey", *LINE, "l_returnflag", "l_shipdate")
    single = dedup.keep_first(rows, ["l_orderkey"], LINE)
    return dedup.keep_first(single, ["l_shipdate", "l_suppkey", "l_returnflag"], ["l_orderkey"])


@query(
    "dd_key_time",
    """SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_shipdate ORDER BY l_linenumber, l_partkey) AS r FROM lineitem) WHERE r = 1""",
)
def dd_key_time(spark, d):
    rows = load(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey")
    return dedup.keep_first(rows, ["l_orderkey", "l_shipdate"], ["l_linenumber", "l_partkey"])


@query("so_distinct", INC_SQL + "SELECT DISTINCT city, year, season FROM inc")
def so_distinct(spark, d):
    return reshape.distinct_values(incidents(spark, d), "city", "year", "season")


@query("so_union_by_name", INC_SQL + "SELECT city, incident_category, count(*) AS n FROM inc GROUP BY ALL")
def so_union_by_name(spark, d):
    parts = {
        c: f(spark, d).groupBy("incident_category").agg(F.count("*").alias("n"))
        for c, f in zip(CITIES, (web_incidents, freight_incidents))
    }
    return reshape.union_tagged(parts)


@query(
    "so_concat",
    INC_SQL + """SELECT 'season' AS stratification, season AS level, count(*) AS n FROM inc GROUP BY 2
    UNION ALL SELECT 'source', unified_call_source, count(*) FROM inc GROUP BY 2""",
)
def so_concat(spark, d):
    rows = incidents(spark, d)
    part = lambda name, c: rows.groupBy(F.col(c).alias("level")).agg(F.count("*").alias("n")).withColumn(
        "stratification", F.lit(name)
    )
    return reshape.stack([part("season", "season"), part("source", "unified_call_source")])


_TOP = "SELECT hour FROM inc WHERE city = '{}' GROUP BY 1 ORDER BY count(*) DESC, hour LIMIT 12"


@query(
    "so_feature_sets",
    INC_SQL + f""", a AS ({_TOP.format('web')}), b AS ({_TOP.format('freight')})
    SELECT hour, CASE WHEN hour IN (FROM a) AND hour IN (FROM b) THEN 'common'
      WHEN hour IN (FROM a) THEN 'web_only' ELSE 'freight_only' END AS category
    FROM (FROM a UNION FROM b)""",
)
def so_feature_sets(spark, d):
    """The busiest hours of either city."""
    counts = incidents(spark, d).groupBy("city", "hour").agg(F.count("*").alias("n"))
    web, freight = (ranking.top_n(counts.filter(F.col("city") == c), [F.desc("n"), F.col("hour")], 12) for c in CITIES)
    return reshape.membership(web, freight, "hour", "web_only", "freight_only")


@query(
    "rs_pivot",
    INC_SQL + """SELECT unified_call_source, count(*) FILTER (city = 'web') AS web, count(*) FILTER (city = 'freight') AS freight
    FROM inc GROUP BY 1""",
)
def rs_pivot(spark, d):
    return reshape.count_pivot(incidents(spark, d), "unified_call_source", "city", CITIES)


@query(
    "rs_heatmap",
    INC_SQL + "SELECT city, day_of_week, "
    + ", ".join(f"round(avg(response_minutes) FILTER (hour = {h}), 6) AS hour_{h}" for h in range(24))
    + " FROM inc WHERE response_minutes IS NOT NULL GROUP BY 1, 2",
)
def rs_heatmap(spark, d):
    return reshape.mean_matrix(incidents(spark, d), ["city", "day_of_week"], "hour", "response_minutes", range(24), decimals=6)


@query(
    "rs_melt",
    INC_SQL + """, s AS (SELECT city, round(avg(response_minutes), 6) AS mean_response, max(response_minutes) AS max_response FROM inc GROUP BY 1)
    SELECT city, 'mean_response' AS metric, mean_response AS minutes FROM s UNION ALL SELECT city, 'max_response', max_response FROM s""",
)
def rs_melt(spark, d):
    wide = incidents(spark, d).groupBy("city").agg(
        F.round(F.avg("response_minutes"), 6).alias("mean_response"), F.max("response_minutes").alias("max_response")
    )
    return reshape.melt(wide, ["city"], ["mean_response", "max_response"], "metric", "minutes")


@query(
    "rs_transpose",
    INC_SQL + " UNION ALL ".join(
        f"""SELECT '{f}_{c}' AS metric, CAST({f}({c}) FILTER (city = 'web') AS DOUBLE) AS web,
        CAST({f}({c}) FILTER (city = 'freight') AS DOUBLE) AS freight FROM inc"""
        for c in ("hour", "day_of_week", "month") for f in ("min", "max")
    ),
)
def rs_transpose(spark, d):
    stats = incidents(spark, d).groupBy("city").agg(
        *[f(c).alias(f"{n}_{c}") for c in ("hour", "day_of_week", "month") for n, f in (("min", F.min), ("max", F.max))]
    )
    return reshape.transpose(stats, "city", CITIES)


@query(
    "jn_left_area",
    INC_SQL + """, base AS (SELECT city, location_area, count(*) AS n_total, count(*) FILTER (response_minutes IS NULL) AS n_censored
      FROM inc GROUP BY ALL),
    resp AS (SELECT city, location_area, count(*) AS n_completed, round(avg(response_minutes), 6) AS mean_response,
      round(quantile_disc(response_minutes, 0.9), 6) AS p90_response FROM inc WHERE response_minutes IS NOT NULL GROUP BY ALL)
    SELECT city, location_area, n_total, n_censored, coalesce(n_completed, 0) AS n_completed, mean_response, p90_response,
      round(n_censored / n_total * 100, 6) AS pct_censored FROM base LEFT JOIN resp USING (city, location_area)""",
)
def jn_left_area(spark, d):
    return aggregates.area_summary(incidents(spark, d), ["city", "location_area"], decimals=6)


@query(
    "jn_inner_topn",
    INC_SQL + """SELECT city, incident_id, location_area FROM inc JOIN (SELECT city, location_area FROM inc GROUP BY city, location_area
      QUALIFY row_number() OVER (PARTITION BY city ORDER BY count(*) DESC, location_area) <= 10) USING (city, location_area)""",
)
def jn_inner_topn(spark, d):
    rows = incidents(spark, d).select("city", "incident_id", "location_area")
    counts = rows.groupBy("city", "location_area").agg(F.count("*").alias("n"))
    top = ranking.top_k_within(counts, ["city"], [F.desc("n"), F.col("location_area")], 10).select("city", "location_area")
    return rows.join(F.broadcast(top), ["city", "location_area"], "left_semi")  # ten rows a city


_SLOTS_SQL = """slots AS (SELECT m + to_hours(i) AS forecast_timestamp FROM
  (SELECT max(incident_datetime) AS m FROM web), generate_series(1, 24) AS g(i)),
slot AS (SELECT forecast_timestamp, CAST(hour(forecast_timestamp) AS INTEGER) AS hour,
  CAST(dayofweek(forecast_timestamp) + 1 AS INTEGER) AS day_of_week FROM slots)"""
_PROFILE_SQL = """profile AS (SELECT hour, day_of_week, avg(calls_past_30min) AS calls_past_30min, avg(calls_past_60min) AS calls_past_60min,
  (SELECT unified_alarm_level FROM web_calls WHERE unified_alarm_level IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
  AS unified_alarm_level FROM web_calls GROUP BY ALL)"""


@query(
    "jn_left_forecast",
    "WITH " + WEB_SQL + "," + WEB_CALLS_SQL + "," + _SLOTS_SQL + "," + _PROFILE_SQL + """
    SELECT forecast_timestamp, hour, day_of_week, unified_alarm_level, round(calls_past_30min, 6) AS calls_past_30min,
      round(calls_past_60min, 6) AS calls_past_60min FROM slot LEFT JOIN profile USING (hour, day_of_week)""",
)
def jn_left_forecast(spark, d):
    rows = web_model_ready(spark, d)
    joined = forecast.slot_features(forecast.future_slots(rows), forecast.history_profile(rows))
    return joined.select(
        F.col("forecast_timestamp").cast("timestamp_ntz").alias("forecast_timestamp"), "hour", "day_of_week",
        "unified_alarm_level", F.round("calls_past_30min", 6).alias("calls_past_30min"),
        F.round("calls_past_60min", 6).alias("calls_past_60min"),
    )


@query(
    "ml_future_slots",
    "WITH " + WEB_SQL + "," + _SLOTS_SQL + "SELECT * FROM slot",
)
def ml_future_slots(spark, d):
    slots = forecast.future_slots(web_incidents(spark, d))
    return slots.withColumn("forecast_timestamp", F.col("forecast_timestamp").cast("timestamp_ntz"))


@query(
    "ml_history_profile",
    "WITH " + WEB_SQL + "," + WEB_CALLS_SQL + "," + _PROFILE_SQL + """
    SELECT hour, day_of_week, unified_alarm_level, round(calls_past_30min, 6) AS calls_past_30min,
      round(calls_past_60min, 6) AS calls_past_60min FROM profile""",
)
def ml_history_profile(spark, d):
    p = forecast.history_profile(web_model_ready(spark, d))
    return p.withColumns({c: F.round(c, 6) for c in ("calls_past_30min", "calls_past_60min")})


# Unadjusted ratios per covariate level, in the layout of a hazard-ratio table. p is the bound exp(-z*z/2) on the
# two-sided normal tail.
_LEVELS = ("season", "day_of_week", "incident_category", "unified_alarm_level", "unified_call_source")
RATIO_SQL = INC_SQL + ", lv AS (" + " UNION ALL ".join(
    f"SELECT city, '{c}_' || CAST({c} AS VARCHAR) AS covariate, delay_indicator FROM inc WHERE {c} IS NOT NULL" for c in _LEVELS
) + """), o AS (SELECT city, avg(delay_indicator) AS base FROM inc GROUP BY 1),
hr AS (SELECT city, covariate, r / base AS hazard_ratio, ln(r / base) AS coef,
    exp(-(r - base) * (r - base) * n / (2 * base * (1 - base))) AS p
  FROM (SELECT city, covariate, avg(delay_indicator) AS r, count(delay_indicator) AS n FROM lv GROUP BY ALL) JOIN o USING (city)
  WHERE r > 0)
"""


def ratio_table(spark, d):
    rows = incidents(spark, d).select(
        "city", "delay_indicator",
        F.inline(F.array(*[F.struct(F.concat(F.lit(f"{c}_"), F.col(c).cast("string")).alias("covariate")) for c in _LEVELS])),
    )
    # A level set covers every row once, so the base rate follows from any one of them; seasons are never NULL.
    per = rows.filter("covariate IS NOT NULL").groupBy("city", "covariate").agg(
        F.sum("delay_indicator").alias("s"), F.count("delay_indicator").alias("n")
    )
    season = F.col("covariate").startswith("season_")
    base = per.groupBy("city").agg(
        (F.sum(F.when(season, F.col("s"))) / F.sum(F.when(season, F.col("n")))).alias("base")
    )
    r, b = F.col("s") / F.col("n"), F.col("base")
    return per.join(base, "city").filter(F.col("s") > 0).select(
        "city", "covariate", (r / b).alias("hazard_ratio"), F.log(r / b).alias("coef"),
        F.exp(-(r - b) * (r - b) * F.col("n") / (2 * b * (1 - b))).alias("p"),
    )


_BUCKET_SQL = """CASE WHEN covariate LIKE 'calls_past%' THEN 'Demand' WHEN covariate LIKE 'season%' OR covariate LIKE 'day_of_week%'
  THEN 'Temporal' WHEN covariate LIKE 'incident_category%' OR covariate LIKE 'unified_alarm_level%' THEN 'Incident/Severity'
  ELSE 'Other' END"""
_EFFECT_SQL = RATIO_SQL + f""", e AS (SELECT city, covariate, p, {_BUCKET_SQL} AS bucket,
  greatest(hazard_ratio, 1 / hazard_ratio) AS effect_size FROM hr)"""


@query(
    "ag_driver_strength",
    _EFFECT_SQL + """SELECT city, bucket, count(*) AS count, round(max(effect_size), 6) AS max_effect,
      round(median(effect_size), 6) AS median_effect, round(avg(effect_size) FILTER (r <= 5), 6) AS top5_mean
    FROM (SELECT *, row_number() OVER (PARTITION BY city, bucket ORDER BY effect_size DESC, covariate) AS r FROM e WHERE p < 0.5)
    GROUP BY ALL""",
)
def ag_driver_strength(spark, d):
    out = drivers.driver_strength(ratio_table(spark, d), ["city"], alpha=0.5)
    return out.withColumns({c: F.round(c, 6) for c in ("max_effect", "median_effect", "top5_mean")})


@query(
    "jn_left_bucket",
    _EFFECT_SQL + """, t AS (SELECT city, bucket, avg(effect_size) AS m FROM (SELECT *, row_number() OVER (
        PARTITION BY city, bucket ORDER BY effect_size DESC, covariate) AS r FROM e WHERE p < 0.05) WHERE r <= 3 GROUP BY ALL)
    SELECT city, bucket, count, round(max_effect, 6) AS max_effect, round(m, 6) AS top3_mean FROM (SELECT city, bucket, count(*) AS count,
      max(effect_size) AS max_effect FROM e GROUP BY ALL) LEFT JOIN t USING (city, bucket)""",
)
def jn_left_bucket(spark, d):
    hr = ratio_table(spark, d)
    stats = drivers.bucket_stats(drivers.effects(hr, None), ["city"])
    top = drivers.bucket_top_mean(drivers.effects(hr, 0.05), ["city"], 3)
    return stats.join(top, ["city", "bucket"], "left").select(
        "city", "bucket", "count", F.round("max_effect", 6).alias("max_effect"), F.round("top3_mean", 6).alias("top3_mean")
    )


FEATURES = ("response_minutes", "delay_indicator", "hour", "day_of_week", "month", "unified_alarm_level", "event_indicator")
RANK_SQL = INC_SQL + ", imp AS (SELECT city, feature, mean_abs, row_number() OVER (PARTITION BY city ORDER BY mean_abs DESC, feature) AS rank FROM (" + " UNION ALL ".join(
    f"SELECT city, '{f}' AS feature, avg(abs(CAST({f} AS DOUBLE))) AS mean_abs FROM inc GROUP BY 1" for f in FEATURES
) + "))"
_DRIVER_SQL = RANK_SQL + """, dt AS (SELECT CASE WHEN a AND b THEN 'common' WHEN a THEN 'web_specific' ELSE 'freight_specific' END AS category,
    feature, web_rank, freight_rank, va AS web_mean_abs, vb AS freight_mean_abs, web_rank - freight_rank AS rank_diff,
    abs(va - vb) AS abs_importance_diff, (va - vb) / (vb + 1e-9) * 100 AS importance_gap_pct, a AS in_web_top, b AS in_freight_top
  FROM (SELECT feature, CAST(w.rank AS INTEGER) AS web_rank, CAST(f.rank AS INTEGER) AS freight_rank, coalesce(w.mean_abs, 0) AS va,
      coalesce(f.mean_abs, 0) AS vb, coalesce(w.rank <= 4, false) AS a, coalesce(f.rank <= 4, false) AS b
    FROM (FROM imp WHERE city = 'web') w FULL JOIN (FROM imp WHERE city = 'freight') f USING (feature)) WHERE a OR b)
"""


def importances(spark, d):
    return aggregates.mean_abs_importance(incidents(spark, d), ["city"], FEATURES)


def _driver_table(spark, d):
    imp = importances(spark, d)
    web, freight = (imp.filter(F.col("city") == c) for c in CITIES)
    return drivers.driver_table(web, freight, *CITIES, top_n=4)


@query("ag_shap_importance", RANK_SQL + "SELECT city, feature, round(mean_abs, 6) AS mean_abs, CAST(rank AS INTEGER) AS rank FROM imp")
def ag_shap_importance(spark, d):
    return importances(spark, d).withColumn("mean_abs", F.round("mean_abs", 6))


@query(
    "ml_driver_table",
    _DRIVER_SQL + """SELECT * REPLACE (round(web_mean_abs, 6) AS web_mean_abs, round(freight_mean_abs, 6) AS freight_mean_abs,
      round(abs_importance_diff, 6) AS abs_importance_diff, round(importance_gap_pct, 4) AS importance_gap_pct) FROM dt""",
)
def ml_driver_table(spark, d):
    t = _driver_table(spark, d)
    six = ("web_mean_abs", "freight_mean_abs", "abs_importance_diff")
    return t.withColumns({**{c: F.round(c, 6) for c in six}, "importance_gap_pct": F.round("importance_gap_pct", 4)})


@query(
    "jn_full_drivers",
    _DRIVER_SQL + "SELECT category, feature, web_rank, freight_rank, in_web_top, in_freight_top FROM dt",
)
def jn_full_drivers(spark, d):
    return _driver_table(spark, d).select("category", "feature", "web_rank", "freight_rank", "in_web_top", "in_freight_top")


@query(
    "ml_driver_classes",
    _DRIVER_SQL + """SELECT feature, CASE WHEN abs(rank_diff) <= 1 THEN 'shared' WHEN importance_gap_pct > 50 THEN 'web_dominant'
      WHEN importance_gap_pct < -20 THEN 'freight_dominant' END AS driver_class,
      row_number() OVER (ORDER BY abs_importance_diff DESC, feature) = 1 AS top_divergence FROM dt""",
)
def ml_driver_classes(spark, d):
    return drivers.driver_classes(_driver_table(spark, d), *CITIES).select("feature", "driver_class", "top_divergence")


@query(
    "ml_demand_rank",
    RANK_SQL + """SELECT city, f.feature, CAST(rank AS INTEGER) AS rank, round(mean_abs, 6) AS mean_abs,
      CASE WHEN rank IS NULL THEN 'No' ELSE 'Yes' END AS present
    FROM (SELECT DISTINCT city FROM imp) CROSS JOIN (VALUES ('hour'), ('calls_past_30min')) f(feature) LEFT JOIN imp USING (city, feature)""",
)
def ml_demand_rank(spark, d):
    out = drivers.named_feature_ranks(importances(spark, d), "city", ["hour", "calls_past_30min"])
    return out.withColumn("mean_abs", F.round("mean_abs", 6))


@query(
    "wn_calls_citywide",
    "WITH " + WEB_SQL + "," + WEB_CALLS_SQL + "SELECT incident_id, calls_past_30min, calls_past_60min FROM web_calls",
)
def wn_calls_citywide(spark, d):
    return web_model_ready(spark, d).select("incident_id", "calls_past_30min", "calls_past_60min")


@query(
    "wn_calls_by_area",
    "WITH " + FREIGHT_SQL + "," + FREIGHT_CALLS_SQL + "SELECT incident_id, calls_past_30min, calls_past_60min FROM freight_calls",
)
def wn_calls_by_area(spark, d):
    return freight_model_ready(spark, d).select("incident_id", "calls_past_30min", "calls_past_60min")


@query("wn_row_rank", RATIO_SQL + "SELECT city, covariate, CAST(row_number() OVER (PARTITION BY city ORDER BY abs(coef) DESC, covariate) AS INTEGER) AS rank FROM hr")
def wn_row_rank(spark, d):
    order = [F.desc(F.abs("coef")), F.col("covariate")]
    return ranking.rank_within(ratio_table(spark, d), ["city"], order).select("city", "covariate", "rank")


@query(
    "wn_topk_group",
    INC_SQL + """SELECT city, location_area, incident_id, response_minutes FROM inc WHERE response_minutes IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY city, location_area ORDER BY response_minutes DESC, incident_id) <= 3""",
)
def wn_topk_group(spark, d):
    rows = incidents(spark, d).filter("response_minutes IS NOT NULL")
    rows = rows.select("city", "location_area", "incident_id", "response_minutes")
    order = [F.desc("response_minutes"), F.col("incident_id")]
    return ranking.top_k_within(rows, ["city", "location_area"], order, 3)


_DAY_SERIES_SQL = INC_SQL + """, s AS (SELECT city, hour, avg(response_minutes) AS m FROM inc GROUP BY ALL)"""


@query(
    "wn_smooth",
    _DAY_SERIES_SQL + """SELECT city, hour, round(avg(m) OVER (PARTITION BY city ORDER BY hour ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS m FROM s""",
)
def wn_smooth(spark, d):
    s = incidents(spark, d).groupBy("city", "hour").agg(F.avg("response_minutes").alias("m"))
    return ranking.smooth(s, ["city"], "hour", "m").withColumn("m", F.round("m", 6))


@query(
    "wn_ffill_align",
    INC_SQL + """, s AS (SELECT city, response_minutes AS t, avg(unified_alarm_level) AS v FROM inc WHERE response_minutes IS NOT NULL GROUP BY ALL),
    g AS (SELECT city, CAST(i AS DOUBLE) AS time FROM (SELECT DISTINCT city FROM inc), generate_series(0, 60) AS q(i)),
    a AS (SELECT g.city, g.time, (SELECT arg_max(v, t) FROM s WHERE s.city = g.city AND t <= g.time AND v IS NOT NULL) AS v FROM g)
    SELECT city, time, round(coalesce(v, first_value(v IGNORE NULLS) OVER (PARTITION BY city ORDER BY time
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0), 6) AS v FROM a""",
)
def wn_ffill_align(spark, d):
    s = incidents(spark, d).filter("response_minutes IS NOT NULL").groupBy("city", F.col("response_minutes").alias("time"))
    out = ranking.align_to_grid(s.agg(F.avg("unified_alarm_level").alias("v")), ["city"], "time", "v", 60)
    return out.withColumn("v", F.round("v", 6))


@query(
    "tk_topn",
    INC_SQL + """SELECT city, location_area, count(*) AS n FROM inc GROUP BY ALL ORDER BY n DESC, city, location_area LIMIT 20""",
)
def tk_topn(spark, d):
    counts = incidents(spark, d).groupBy("city", "location_area").agg(F.count("*").alias("n"))
    return ranking.top_n(counts, [F.desc("n"), F.col("city"), F.col("location_area")], 20)


# The samples' hash in SQL.
HASH_SQL = "md5('42|' || city || '|' || CAST(incident_id AS VARCHAR))"
_FRACTION_SQL = f"(CAST('0x' || substr({HASH_SQL}, 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"
KEYS = ["city", "incident_id"]


@query("sp_sample", INC_SQL + f"SELECT city, incident_id FROM inc WHERE {_FRACTION_SQL} < 0.2")
def sp_sample(spark, d):
    return sampling.sample_fraction(incidents(spark, d).select(*KEYS), 0.2, KEYS)


@query(
    "sp_split",
    INC_SQL + f"SELECT CASE WHEN {_FRACTION_SQL} < 0.8 THEN 'train' ELSE 'test' END AS part, city, incident_id FROM inc",
)
def sp_split(spark, d):
    train, test = sampling.split_train_test(incidents(spark, d).select(*KEYS), KEYS)
    return reshape.union_tagged({"train": train, "test": test}, "part")


@query(
    "sp_balanced",
    INC_SQL + f""", s AS (SELECT delay_indicator, count(*) AS n FROM inc WHERE delay_indicator IN (0, 1) GROUP BY 1)
    SELECT city, incident_id, delay_indicator FROM inc JOIN s USING (delay_indicator)
    WHERE {_FRACTION_SQL} < least((SELECT min(n) FROM s), 200000) / n""",
)
def sp_balanced(spark, d):
    rows = incidents(spark, d).select(*KEYS, "delay_indicator")
    return sampling.balanced_sample(rows, "delay_indicator", KEYS, max_per_class=200_000)


@query("sp_fixed_n", INC_SQL + f"SELECT city, incident_id FROM inc ORDER BY {HASH_SQL}, city, incident_id LIMIT 500")
def sp_fixed_n(spark, d):
    return sampling.fixed_size_sample(incidents(spark, d).select(*KEYS), 500, KEYS)
