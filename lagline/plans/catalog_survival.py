"""Registered survival queries."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import functions as F

from lagline.functions import expressions as x
from lagline.operators import aggregates as agg
from lagline.operators import cox, curves, drivers, logrank, survival
from lagline.operators.reshape import union_tagged
from lagline.plans.catalog_shapes import RANK_SQL, RATIO_SQL, importances, ratio_table
from lagline.plans.inputs import CITIES, INC_SQL, MODEL_SQL, counted_model_ready, freight_model_ready, incidents, model_ready, web_model_ready
from lagline.plans.registry import query
from lagline.session import work_dir
from lagline.sources import sinks

CITY = ["city"]
_STRATA_EXPR = {
    "hour_group": "CASE hour // 6 WHEN 0 THEN 'Night' WHEN 1 THEN 'Morning' WHEN 2 THEN 'Afternoon' ELSE 'Evening' END",
    "season": "season",
    "day_of_week_name": "dayname(incident_datetime)",
}
VIEW_SQL = INC_SQL + """, view AS (SELECT city, """ + ", ".join(f"{e} AS {c}" for c, e in _STRATA_EXPR.items()) + """,
  least(coalesce(response_minutes, 60), 60::DOUBLE) AS t, CASE WHEN response_minutes <= 60 THEN 1 ELSE 0 END AS e
  FROM inc WHERE response_minutes IS NULL OR response_minutes > 0)"""


def _km_sql(keys, source="view"):
    """Risk table and curve of a view with t and e, per key columns."""
    return f""", rt AS (SELECT {keys}, t AS time, d, m - d AS c, CAST(sum(m) OVER (PARTITION BY {keys} ORDER BY t DESC) AS BIGINT) AS n
      FROM (SELECT {keys}, t, CAST(sum(e) AS BIGINT) AS d, count(*) AS m FROM {source} GROUP BY ALL)),
    km AS (SELECT *, exp(sum(CASE WHEN d < n THEN ln(1 - d / n) ELSE 0 END) OVER w) * CASE WHEN max(d / n) OVER w >= 1 THEN 0 ELSE 1 END AS survival
      FROM rt WINDOW w AS (PARTITION BY {keys} ORDER BY time))"""


KM_SQL = VIEW_SQL + _km_sql("city")


def city_view(spark, d):
    rows = incidents(spark, d)
    strata = {"hour_group": x.quarter_of_day("hour"), "day_of_week_name": x.day_name("day_of_week")}
    return survival.survival_view(rows.withColumns(strata), ["city", "hour_group", "season", "day_of_week_name"])


def city_curve(spark, d):
    return survival.kaplan_meier(survival.risk_table(city_view(spark, d), CITY), CITY)


def rounded(df, decimals=6):
    return df.withColumns({c: F.round(c, decimals) for c, t in df.dtypes if t == "double"})


@query("sv_risk_table", KM_SQL + "SELECT city, time, d, c, n FROM rt")
def sv_risk_table(spark, d):
    return survival.risk_table(city_view(spark, d), CITY)


@query("sv_km", KM_SQL + "SELECT city, time, d, c, n, round(survival, 6) AS survival FROM km")
def sv_km(spark, d):
    return rounded(city_curve(spark, d))


@query("wn_cumprod", KM_SQL + "SELECT city, time, round(survival, 6) AS survival FROM km")
def wn_cumprod(spark, d):
    return rounded(city_curve(spark, d).select("city", "time", "survival"))


_LONG_SQL = VIEW_SQL + ", lv AS (" + " UNION ALL ".join(
    f"SELECT city, '{label}' AS stratification, {c} AS level, t, e FROM view" for c, label, _ in logrank.STRATA
) + ")" + _km_sql("city, stratification, level", "lv")


@query(
    "sv_km_stratified",
    _LONG_SQL + "SELECT city, stratification, level, time, d, n, round(survival, 6) AS survival FROM km",
)
def sv_km_stratified(spark, d):
    keys = ["city", "stratification", "level"]
    rows = logrank.strata_rows(city_view(spark, d), CITY)
    curve = survival.kaplan_meier(survival.risk_table(rows, keys), keys)
    return rounded(curve.select(*keys, "time", "d", "n", "survival"))


_AT_SQL = """, looked AS (SELECT city, CAST(th AS DOUBLE) AS threshold_min, coalesce((SELECT arg_max(survival, time) FROM km
  WHERE km.city = g.city AND time <= th), 1) AS s FROM (SELECT DISTINCT city FROM km) g, (VALUES (8), (10), (30), (60)) v(th))"""


@query(
    "sv_km_thresholds",
    KM_SQL + _AT_SQL + "SELECT city, threshold_min, round(s, 6) AS survival_prob, round(1 - s, 6) AS prob_arrived FROM looked",
)
def sv_km_thresholds(spark, d):
    return rounded(survival.survival_at(city_curve(spark, d), CITY))


@query(
    "sv_km_median",
    # Nothing is censored before the horizon, so S(t) is the exact share of rows past t.
    _LONG_SQL + """SELECT city, stratification, level, coalesce(min(time) FILTER (2 * (n - d) <= total), 'infinity'::DOUBLE) AS median_survival
    FROM (SELECT *, max(n) OVER (PARTITION BY city, stratification, level) AS total FROM rt) GROUP BY ALL""",
)
def sv_km_median(spark, d):
    keys = ["city", "stratification", "level"]
    rows = logrank.strata_rows(city_view(spark, d), CITY)
    return survival.median_survival(survival.kaplan_meier(survival.risk_table(rows, keys), keys), keys)


@query(
    "sv_km_validate",
    KM_SQL + _AT_SQL + """, ev AS (SELECT city, quantile_cont(t, 0.5) AS event_median FROM view WHERE e = 1 GROUP BY 1),
    med AS (SELECT city, coalesce(min(time) FILTER (2 * (n - d) <= total), 'infinity'::DOUBLE) AS m
      FROM (SELECT *, max(n) OVER (PARTITION BY city) AS total FROM rt) GROUP BY 1)
    SELECT city, threshold_min, round(s, 6) AS survival_prob, round(event_median, 6) AS event_median, round(m, 6) AS median_survival,
      round((SELECT avg(CASE WHEN t > threshold_min THEN 1 ELSE 0 END) FROM view WHERE view.city = looked.city AND e = 1), 6) AS empirical_survival
    FROM looked JOIN ev USING (city) JOIN med USING (city)""",
)
def sv_km_validate(spark, d):
    return rounded(survival.validation(city_view(spark, d), CITY))


@query(
    "sv_hazard_binned",
    KM_SQL + """SELECT *, round(events / at_risk, 6) AS hazard FROM (SELECT city, b * 2.0::DOUBLE AS bin_start, b * 2.0::DOUBLE + 2 AS bin_end, (SELECT count(*) FROM view v WHERE v.city = g.city AND t >= b * 2) AS at_risk,
      (SELECT count(*) FROM view v WHERE v.city = g.city AND e = 1 AND t >= b * 2 AND t < b * 2 + 2) AS events
      FROM (SELECT DISTINCT city FROM view) g, generate_series(0, 29) q(b))""",
)
def sv_hazard_binned(spark, d):
    return rounded(survival.binned_hazard(survival.risk_table(city_view(spark, d), CITY), CITY))


@query(
    "sv_logrank_2",
    VIEW_SQL + """, p AS (SELECT t, sum(e) AS d, count(*) AS m, sum(e) FILTER (city = 'web') AS da, count(*) FILTER (city = 'web') AS ma
      FROM view GROUP BY 1),
    r AS (SELECT t, d, coalesce(da, 0) AS da, sum(m) OVER (ORDER BY t DESC) AS n, sum(ma) OVER (ORDER BY t DESC) AS na FROM p),
    z AS (SELECT sum(da - na * d / n) AS z, sum(CASE WHEN n > 1 THEN d * (n - d) / (n - 1) * na / n * (n - na) / n ELSE 0 END) AS v FROM r)
    SELECT 'web' AS group_a, 'freight' AS group_b, round(z * z / v, 4) AS test_statistic,
      (SELECT count(*) FROM view WHERE city = 'web') AS n_a, (SELECT count(*) FROM view WHERE city = 'freight') AS n_b,
      (SELECT count(*) FROM view WHERE city = 'web' AND e = 1) AS events_a, (SELECT count(*) FROM view WHERE city = 'freight' AND e = 1) AS events_b
    FROM z""",
)
def sv_logrank_2(spark, d):
    out = logrank.two_sample(city_view(spark, d), [], "city", *CITIES, resolution=survival.RESOLUTION)
    return out.drop("p_value", "p_value_text").withColumn("test_statistic", F.round("test_statistic", 4))


@query("sv_logrank_2_p")
def sv_logrank_2_p(spark, d):
    return logrank.two_sample(city_view(spark, d), [], "city", *CITIES, resolution=survival.RESOLUTION)


@query("sv_logrank_k")
def sv_logrank_k(spark, d):
    return logrank.logrank(city_view(spark, d), CITY, "day_of_week_name", resolution=survival.RESOLUTION)


@query("sv_logrank_suite")
def sv_logrank_suite(spark, d):
    return logrank.logrank_suite(city_view(spark, d), CITY, resolution=survival.RESOLUTION)


@query(
    "sv_logrank_levels",
    INC_SQL + """, view AS (SELECT city, location_area AS level, round(least(coalesce(response_minutes, 60), 60::DOUBLE), 2) AS t,
      CASE WHEN response_minutes <= 60 THEN 1 ELSE 0 END AS e FROM inc WHERE response_minutes IS NULL OR response_minutes > 0),
    p AS (SELECT city, t, sum(e) AS d, count(*) AS m FROM view GROUP BY ALL),
    r AS (SELECT city, t, d, sum(m) OVER (PARTITION BY city ORDER BY t DESC) AS n FROM p),
    x AS (SELECT city, t, sum(d / n) OVER (PARTITION BY city ORDER BY t) AS expected FROM r)
    SELECT city, level, count(*) AS n, sum(e)::BIGINT AS events, round(sum(expected), 6) AS expected
    FROM view JOIN x USING (city, t) GROUP BY ALL""",
)
def sv_logrank_levels(spark, d):
    """Observed and expected events of every location, as the test over all locations of a city has them."""
    view = survival.survival_view(incidents(spark, d), ["city", "location_area"])
    placed = logrank.with_risk(logrank.event_counts(view, CITY, "location_area", survival.RESOLUTION), CITY)
    sums = logrank.level_sums(placed, CITY)
    return sums.select("city", "level", F.col("rows").cast("long").alias("n"), F.col("events").cast("long").alias("events"), F.round("expected", 6).alias("expected"))


# ---------------------------------------------------------------- design

_CAT = [c for c in cox.CATEGORICAL if c != "time_bin"]
DESIGN_SQL = MODEL_SQL + f""", cr AS (SELECT city, incident_id, least(coalesce(response_minutes, 60), 60::DOUBLE) AS time,
    CASE WHEN response_minutes <= 60 THEN 1 ELSE 0 END AS event, calls_past_30min, calls_past_60min,
    {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _CAT)},
    CASE hour // 6 WHEN 0 THEN 'Night' WHEN 1 THEN 'Morning' WHEN 2 THEN 'Afternoon' ELSE 'Evening' END AS time_bin
  FROM mr WHERE (response_minutes IS NULL OR response_minutes > 0) AND unified_alarm_level IS NOT NULL),
cl AS ({" UNION ALL ".join(f"SELECT city, incident_id, '{c}' AS column_name, {c} AS level FROM cr" for c in cox.CATEGORICAL)}),
cn AS (SELECT *, CAST(sum(ones) OVER (PARTITION BY city, column_name) AS BIGINT) AS n,
    row_number() OVER (PARTITION BY city, column_name ORDER BY ones DESC, level) = 1 AS is_reference
  FROM (SELECT city, column_name, level, count(*) AS ones FROM cl GROUP BY ALL)),
ir AS (SELECT city, column_name, level, ones, n, column_name || '_' || level AS covariate, is_reference,
    ones < greatest(50, n // 1000) OR ones > n - greatest(50, n // 1000) AS low_frequency,
    (ones / n) * (1 - ones / n) * n / (n - 1) < 1e-8 AS low_variance FROM cn)
"""


def design_rows(spark, d):
    return cox.cox_rows(model_ready(spark, d), keep=["city", "incident_id"], resolution=survival.RESOLUTION)


@query(
    "sv_design",
    DESIGN_SQL + """SELECT city, incident_id, covariate FROM cl JOIN ir USING (city, column_name, level)
    WHERE NOT is_reference AND NOT low_frequency AND NOT low_variance""",
)
def sv_design(spark, d):
    return cox.design_long(design_rows(spark, d), CITY, "incident_id")


@query("sv_drop_dummies", DESIGN_SQL + "SELECT * FROM ir")
def sv_drop_dummies(spark, d):
    return cox.indicator_report(cox.level_counts(design_rows(spark, d), CITY))


@query(
    "sv_drop_report",
    MODEL_SQL + """SELECT city, count(*) FILTER (response_minutes IS NULL) AS censored_from_null,
      count(*) FILTER (response_minutes > 60) AS censored_from_over, count(*) FILTER (unified_alarm_level IS NULL) AS dropped_missing_predictors,
      count(unified_alarm_level) AS rows_final, count(*) FILTER (unified_alarm_level IS NOT NULL AND response_minutes <= 60) AS events_final
    FROM mr WHERE response_minutes IS NULL OR response_minutes > 0 GROUP BY city""",
)
def sv_drop_report(spark, d):
    reports = {c: cox.drop_report(f(spark, d)) for c, f in zip(CITIES, (web_model_ready, freight_model_ready))}
    return union_tagged(reports)


@query(
    "dq_design_asserts",
    DESIGN_SQL + """SELECT city, count(*) FILTER (time IS NULL) AS null_duration, count(*) FILTER (time <= 0) AS non_positive_duration,
      count(*) FILTER (event NOT IN (0, 1)) AS event_not_binary, count(*) FILTER (time > 60) AS beyond_horizon,
      count(*) FILTER (time = 60 AND event = 1) AS event_at_horizon FROM cr GROUP BY 1""",
)
def dq_design_asserts(spark, d):
    return cox.design_violations(design_rows(spark, d), CITY)


@query(
    "sv_ref_row",
    DESIGN_SQL + """SELECT city, 'calls_past_30min' AS covariate, quantile_cont(calls_past_30min, 0.5)::DOUBLE AS median FROM cr GROUP BY 1
    UNION ALL SELECT city, 'calls_past_60min', quantile_cont(calls_past_60min, 0.5)::DOUBLE FROM cr GROUP BY 1
    UNION ALL SELECT city, covariate, CASE WHEN 2 * ones > n THEN 1 WHEN 2 * ones = n THEN 0.5 ELSE 0 END::DOUBLE FROM ir
    WHERE NOT is_reference AND NOT low_frequency AND NOT low_variance""",
)
def sv_ref_row(spark, d):
    """Median covariates of either city's design."""
    parts = {}
    for city, rows in zip(CITIES, (web_model_ready, freight_model_ready)):
        design = cox.build_design(rows(spark, d), resolution=survival.RESOLUTION)
        parts[city] = cox.reference_profile(design).unpivot([], design.names, "covariate", "median")
    return union_tagged(parts)


# ---------------------------------------------------------------- Cox

_READY = dict(zip(CITIES, (web_model_ready, freight_model_ready)))


@lru_cache(maxsize=8)
def _design(spark, d, city):
    return cox.build_design(_READY[city](spark, d), resolution=survival.RESOLUTION)


@lru_cache(maxsize=16)
def _model(spark, d, city):
    return cox.fit(_design(spark, d, city))


@lru_cache(maxsize=16)
def _concordance(spark, d, city):
    return cox.concordance(cox.scored_rows(_design(spark, d, city), _model(spark, d, city)))


@lru_cache(maxsize=16)
def _profile(spark, d, city):
    return cox.reference_profile(_design(spark, d, city)).first().asDict()


def _per_city(table):
    return union_tagged({c: table(c) for c in CITIES})


@query(
    "sv_null_likelihood",
    DESIGN_SQL + """, p AS (SELECT city, time, sum(event) AS d, count(*) AS m FROM cr GROUP BY ALL),
    r AS (SELECT city, d, sum(m) OVER (PARTITION BY city ORDER BY time DESC) AS n FROM p)
    SELECT city, round(-sum(ln(n - l)), 3) AS log_likelihood, count(*) AS events
    FROM (SELECT city, n, unnest(range(CAST(d AS BIGINT))) AS l FROM r WHERE d > 0) GROUP BY 1""",
)
def sv_null_likelihood(spark, d):
    """Efron log-likelihood of the model without effects, from the sums that a Newton step starts with."""
    def at_zero(city):
        design = _design(spark, d, city)
        p = len(design.names)
        value = design.scan().evaluate(np.zeros(p), np.zeros(p), np.ones(p))
        return spark.createDataFrame([(round(float(value.likelihood), 3), int(value.events))], "log_likelihood double, events bigint")

    return _per_city(at_zero)


@query("sv_cox_fit")
def sv_cox_fit(spark, d):
    """Both cities over the penalty grid, each fit starting from the previous one."""
    parts = []
    for city in CITIES:
        design = _design(spark, d, city)
        model = None
        for penalty in cox.PENALTIES:
            model = cox.fit(design, penalty, model)
            stats = cox.fit_statistics(spark, model, cox.concordance(cox.scored_rows(design, model)))
            parts.append(stats.withColumn("city", F.lit(city)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("sv_hr_table")
def sv_hr_table(spark, d):
    return _per_city(lambda c: cox.hazard_ratios(spark, _model(spark, d, c)))


@query("sv_fit_stats")
def sv_fit_stats(spark, d):
    return _per_city(lambda c: cox.fit_statistics(spark, _model(spark, d, c), _concordance(spark, d, c)))


@query("sv_ph_test")
def sv_ph_test(spark, d):
    return _per_city(lambda c: cox.ph_test(spark, _model(spark, d, c)))


@query("sv_baseline_hazard")
def sv_baseline_hazard(spark, d):
    return _per_city(lambda c: cox.baseline_hazard(spark, _model(spark, d, c)))


def _reference(profile_columns, model):
    values = dict(zip(model.names, profile_columns.values()))
    return {k: (0.0 if k in cox.DEMAND else v) for k, v in values.items()}


def _profile_curves(spark, d):
    """S(t) of the median incident without demand, per city."""
    def curves_of(city):
        model = _model(spark, d, city)
        return cox.scenario_curves(spark, model, {"reference": _reference(_profile(spark, d, city), model)})

    return _per_city(curves_of)


@query("sv_surv_profile")
def sv_surv_profile(spark, d):
    return _profile_curves(spark, d)


@query("sv_demand_scenario")
def sv_demand_scenario(spark, d):
    """Delay-risk curves at low (P10) and high (P90) demand, other covariates at their medians."""
    levels = {
        (r["city"], r["feature"]): (r["low_demand_p10"], r["high_demand_p90"])
        for r in agg.demand_scenarios(counted_model_ready(spark, d, ("location_area",)), CITY, cox.DEMAND, weight="n").collect()
    }
    parts = {}
    for city in CITIES:
        model, r = _model(spark, d, city), _profile(spark, d, city)
        base = _reference(r, model)
        profiles = {
            name: {**base, **{f: float(levels[city, f][i]) for f in cox.DEMAND}} for i, name in enumerate(("low", "high"))
        }
        parts[city] = cox.scenario_curves(spark, model, profiles)
    return union_tagged(parts)


@query("sv_cox_cross_city")
def sv_cox_cross_city(spark, d):
    """Survival and hazard summary of both fitted baselines with their difference."""
    curve = _profile_curves(spark, d)
    hazard = curves.smoothed_hazard(sv_baseline_hazard(spark, d), CITY, 60)
    return curves.cross_city_summary(curve, hazard, *CITIES)


@query("sv_cox_drivers")
def sv_cox_drivers(spark, d):
    return drivers.driver_strength(sv_hr_table(spark, d), CITY)


@query("sv_cox_importance")
def sv_cox_importance(spark, d):
    return drivers.feature_importance(sv_hr_table(spark, d), CITY, top=15)


@query("sv_demand_hr_cox")
def sv_demand_hr_cox(spark, d):
    stats = sv_fit_stats(spark, d).select("city", "n", "concordance_index")
    return drivers.demand_hazards(sv_hr_table(spark, d), stats, CITY)


@query("sink_coefs")
def sink_coefs(spark, d):
    """Save each city's model as tables and predict the reference curve from the saved tables."""
    parts = {}
    for city in CITIES:
        model, r = _model(spark, d, city), _profile(spark, d, city)
        folder = work_dir(spark, "cox")
        cox.save_tables(spark, model, folder)
        parts[city] = cox.saved_curves(spark, folder, {"reference": _reference(r, model)}, int(model.horizon))
    return union_tagged(parts)


@query(
    "sink_model_meta",
    MODEL_SQL + """SELECT city, count(*) FILTER (response_minutes IS NULL) AS censored_from_null,
      count(*) FILTER (response_minutes > 60) AS censored_from_over, count(unified_alarm_level) AS rows_final, 60.0::DOUBLE AS censor_time
    FROM mr WHERE response_minutes IS NULL OR response_minutes > 0 GROUP BY city""",
)
def sink_model_meta(spark, d):
    """Run metadata as JSON, read back."""
    path = work_dir(spark, "meta")
    parameters = {"censor_time": 60.0, "penalties": list(cox.PENALTIES), "numeric": list(cox.NUMERIC)}
    sinks.save_json(sinks.run_metadata(sv_drop_report(spark, d), parameters), path)
    meta = spark.read.json(path)
    return meta.select(
        "city", "censored_from_null", "censored_from_over", "rows_final", F.col("parameters.censor_time").alias("censor_time")
    )


# ---------------------------------------------------------------- summaries of curves, on the grid

GRID_SQL = KM_SQL + """, grid AS (SELECT city, CAST(i AS DOUBLE) AS time, coalesce((SELECT arg_max(survival, time) FROM km WHERE km.city = g.city
    AND km.time <= i), 1) AS survival FROM (SELECT DISTINCT city FROM km) g, generate_series(0, 60) q(i)),
hz AS (SELECT city, time, avg(h) OVER (PARTITION BY city ORDER BY time ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS hazard FROM (
    SELECT city, time, coalesce(h, first_value(h IGNORE NULLS) OVER (PARTITION BY city ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS h
    FROM (SELECT city, CAST(i AS DOUBLE) AS time, (SELECT arg_max(d / n, time) FROM km WHERE km.city = g.city AND km.time <= i) AS h
      FROM (SELECT DISTINCT city FROM km) g, generate_series(0, 60) q(i)))),
md AS (SELECT city, coalesce(arg_min(x, time) FILTER (survival <= 0.5), 'nan'::DOUBLE) AS median_survival_min FROM (SELECT city, time, CASE WHEN survival = 0.5 OR t0 IS NULL
    OR s0 = survival THEN time ELSE t0 + (0.5 - s0) * (time - t0) / (survival - s0) END AS x, survival FROM (SELECT *,
    lag(time) OVER (PARTITION BY city ORDER BY time) AS t0, lag(survival) OVER (PARTITION BY city ORDER BY time) AS s0 FROM grid)) GROUP BY 1),
pk AS (SELECT city, time AS hazard_peak_time_min, hazard AS hazard_peak_magnitude FROM hz QUALIFY row_number() OVER (PARTITION BY city ORDER BY hazard DESC, time) = 1),
va AS (SELECT city, """ + ", ".join(f'max(survival) FILTER (time = {m}) AS "S({m}m)"' for m in curves.REPORT_MINUTES) + " FROM grid GROUP BY 1)"


def grid_curve(spark, d):
    return curves.on_grid(city_curve(spark, d), CITY, 60)


def grid_hazard(spark, d):
    raw = city_curve(spark, d).select("city", "time", (F.col("d") / F.col("n")).alias("hazard"))
    return curves.smoothed_hazard(raw, CITY, 60)


@query(
    "dq_survival_sanity",
    GRID_SQL + """SELECT city, round(arg_min(survival, time), 6) AS start_value, round(arg_max(survival, time), 6) AS end_value,
      coalesce(bool_and(survival - p <= 1e-10), true) AS monotone, bool_and(survival BETWEEN 0 AND 1) AS in_range,
      bool_or(survival IS NULL) AS contains_nan
    FROM (SELECT *, lag(survival) OVER (PARTITION BY city ORDER BY time) AS p FROM grid) GROUP BY 1""",
)
def dq_survival_sanity(spark, d):
    return rounded(curves.sanity(grid_curve(spark, d), CITY))


@query("sv_median_interp", GRID_SQL + "SELECT city, round(median_survival_min, 6) AS median_survival_min FROM md")
def sv_median_interp(spark, d):
    return rounded(curves.median_interpolated(grid_curve(spark, d), CITY))


@query(
    "sv_surv_at_times",
    GRID_SQL + "SELECT city, " + ", ".join(f'round("S({m}m)", 6) AS "S({m}m)"' for m in curves.REPORT_MINUTES) + " FROM va",
)
def sv_surv_at_times(spark, d):
    return rounded(curves.values_at(grid_curve(spark, d), CITY))


@query(
    "sv_hazard_peak",
    GRID_SQL + "SELECT city, hazard_peak_time_min, round(hazard_peak_magnitude, 6) AS hazard_peak_magnitude FROM pk",
)
def sv_hazard_peak(spark, d):
    return rounded(curves.hazard_peak(grid_hazard(spark, d), CITY))


_METRICS = ["median_survival_min", "hazard_peak_time_min", "hazard_peak_magnitude", *[f"S({m}m)" for m in curves.REPORT_MINUTES]]


@query(
    "sv_cross_city_summary",
    GRID_SQL + ", su AS (FROM md JOIN pk USING (city) JOIN va USING (city)) SELECT city, "
    + ", ".join(f'round("{m}", 6) AS "{m}"' for m in _METRICS) + ", CAST(NULL AS DOUBLE) AS hazard_peak_ratio FROM su UNION ALL SELECT 'Difference (freight - web)', "
    + ", ".join(f"""round(max("{m}") FILTER (city = 'freight') - max("{m}") FILTER (city = 'web'), 6)""" for m in _METRICS)
    + ", round(max(hazard_peak_magnitude) FILTER (city = 'web') / max(hazard_peak_magnitude) FILTER (city = 'freight'), 6) FROM su",
)
def sv_cross_city_summary(spark, d):
    return rounded(curves.cross_city_summary(grid_curve(spark, d), grid_hazard(spark, d), *CITIES))


_NAMED = ("season_winter", "day_of_week_1")


@query(
    "sv_demand_hr",
    RATIO_SQL + f""", st AS (SELECT city, count(*) AS n FROM inc GROUP BY 1)
    SELECT city, covariate, round(coef, 6) AS coef, round(hazard_ratio, 6) AS hazard_ratio, n, 60.0::DOUBLE AS censor_time,
      CASE WHEN hazard_ratio < 1 THEN {"'" + x.HR_SLOWER + "'"} WHEN hazard_ratio > 1 THEN {"'" + x.HR_FASTER + "'"}
      ELSE {"'" + x.HR_NEUTRAL + "'"} END AS interpretation
    FROM hr JOIN st USING (city) WHERE covariate IN {_NAMED}""",
)
def sv_demand_hr(spark, d):
    stats = incidents(spark, d).groupBy("city").agg(F.count("*").alias("n"))
    return rounded(drivers.demand_hazards(ratio_table(spark, d).drop("p"), stats, CITY, _NAMED))


@query(
    "sv_feature_importance",
    RATIO_SQL + """SELECT * FROM (SELECT city, covariate, round(abs(coef), 6) AS importance,
      CAST(row_number() OVER (PARTITION BY city ORDER BY abs(coef) DESC, covariate) AS INTEGER) AS rank FROM hr) WHERE rank <= 15""",
)
def sv_feature_importance(spark, d):
    out = drivers.feature_importance(ratio_table(spark, d), CITY, top=15)
    return rounded(out.select("city", "covariate", "importance", "rank"))


@query(
    "sv_feature_presence",
    RATIO_SQL + "".join(RANK_SQL[len(INC_SQL):].rstrip()) + """
    SELECT c.city, """ + ", ".join(
        f"""CASE WHEN EXISTS (FROM {t} x WHERE x.city = c.city AND x.{col} = '{f}') THEN 'Yes' ELSE 'No' END AS {f}_in_{side}"""
        for side, t, col in (("survival", "hr", "covariate"), ("predictive", "imp", "feature")) for f in ("season_fall", "hour")
    ) + " FROM (SELECT DISTINCT city FROM inc) c",
)
def sv_feature_presence(spark, d):
    return drivers.feature_presence(ratio_table(spark, d), importances(spark, d), "city", ("season_fall", "hour"))
