"""Registered learning queries: classifiers, regressors, quantiles, forecast, attribution, clusters."""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lagline.operators import aggregates as agg
from lagline.operators import attribution, boosting, clusters, drivers, encoding, forecast, learning, onehot, quantile
from lagline.operators.reshape import stack, union_tagged
from lagline.operators.sampling import kept_split
from lagline.plans.inputs import CITIES, INC_SQL, MODEL_SQL, counted_model_ready, freight_model_ready, incidents, model_ready, web_model_ready
from lagline.plans.registry import query
from lagline.session import at_once, settle, stored, work_dir, written
from lagline.sources import sinks

ID = ["incident_id"]
FEATURES = [*learning.CATEGORICAL, *learning.NUMERIC]
CITY_ROWS = dict(zip(CITIES, (web_model_ready, freight_model_ready)))


def _cities(part):
    """A result per city, stacked under the column `city`."""
    return stack([part(city).withColumn("city", F.lit(city)) for city in CITIES])


def _cities_at_once(spark, part):
    """`_cities` where a part runs jobs of its own: those of both cities at the same time."""
    parts = dict(zip(CITIES, at_once(spark, part, CITIES)))
    return _cities(parts.get)


@lru_cache(maxsize=8)
def _labelled(spark, d, city):
    """Train and test rows with a known label, kept because every model reads them; unknown numbers are a value of their own."""
    rows = learning.keep_missing(CITY_ROWS[city](spark, d).filter("delay_indicator IS NOT NULL"), learning.NUMERIC)
    return kept_split(rows.select(*ID, learning.LABEL, *FEATURES), ID)


@lru_cache(maxsize=8)
def _onehot(spark, d, city):
    """The one-hot encoding, its scaler, and the vectors of train and test rows, which the classifiers on them share."""
    sides = _labelled(spark, d, city)
    encoding_ = onehot.fit(sides[0], learning.CATEGORICAL, learning.NUMERIC)
    train, test = (encoding_.vectors(rows, [*ID, learning.LABEL], "unscaled_features") for rows in sides)
    return encoding_, learning.train([learning.scaler()], train), train, test


@lru_cache(maxsize=32)
def _baseline(spark, d, kind, city):
    """A fitted classifier and its scored test rows, with the vectors that a query returns."""
    if kind == "Hashed Forest":
        train, test = _labelled(spark, d, city)
        first, encode = [], PipelineModel(learning.hashed(learning.CATEGORICAL, learning.NUMERIC, "error"))
        last = learning.wide_forest().on(encode).fit(train)
    else:
        encoding_, encode, train, test = _onehot(spark, d, city)
        first = [onehot.OneHotStage(encoding_, "unscaled_features")]
        logistic = kind == "Logistic Regression"
        last = learning.logistic().fit(encode.transform(train)) if logistic else learning.wide_forest(trees=100).on(encode).fit(train)
    model = PipelineModel([*encode.stages, last])  # on vectors, which the one-hot models' rows have already
    vectors = [] if kind == "Random Forest" else ["features"]
    return PipelineModel([*first, *model.stages]), stored(model.transform(test).select(*ID, learning.LABEL, *vectors, "rawPrediction", "probability", "prediction"), "scored")


def _baselines(spark, d, kinds, city):
    """Scored test rows by kind; the classifiers are fitted at the same time."""
    _labelled(spark, d, city)
    if "Hashed Forest" not in kinds:
        _onehot(spark, d, city)
    return dict(zip(kinds, at_once(spark, lambda kind: _baseline(spark, d, kind, city)[1], kinds)))


def _one_row(spark, name, values):
    keys = sorted(values)
    return spark.createDataFrame([(name, *[float(values[k]) for k in keys])], "model string, " + ", ".join(f"{k} double" for k in keys))


@query("ml_onehot_scale")
def ml_onehot_scale(spark, d):
    """The scaled vectors in sparse form: written out in full they grow with rows times levels."""
    vector = learning.sparse_vector("features", 6).alias("features")
    return _cities(lambda c: _baseline(spark, d, "Logistic Regression", c)[1].select("incident_id", vector))


@query("ml_hash_assemble")
def ml_hash_assemble(spark, d):
    filled = F.size(F.filter(learning.vector_to_array("features"), lambda v: v != 0))
    return _cities(lambda c: _baseline(spark, d, "Hashed Forest", c)[1].select("incident_id", filled.alias("non_zero")))


def _predictions(spark, d, kind):
    columns = ["incident_id", "delay_indicator", learning.positive_probability().alias("p"), "prediction"]
    return _cities_at_once(spark, lambda c: _baseline(spark, d, kind, c)[1].select(*columns))


@query("ml_logreg")
def ml_logreg(spark, d):
    return _predictions(spark, d, "Logistic Regression")


@query("ml_rf")
def ml_rf(spark, d):
    return _predictions(spark, d, "Random Forest")


@query(
    "ml_test_rows",
    MODEL_SQL + "SELECT city, count(*) AS n, CAST(sum(delay_indicator) AS BIGINT) AS delayed FROM mr WHERE delay_indicator IS NOT NULL GROUP BY 1",
)
def ml_test_rows(spark, d):
    """Train and test rows together are all labelled rows of a city, and all test rows get an attribution."""
    def count(city):
        train, test = _labelled(spark, d, city)
        explained = _explained(spark, d, city).select("incident_id", "delay_indicator")
        rows = train.select("incident_id", "delay_indicator").union(explained)
        return rows.agg(F.count("*").alias("n"), F.sum("delay_indicator").cast("long").alias("delayed"))

    return _cities(count)


@query("ml_eval_binary")
def ml_eval_binary(spark, d):
    kinds = ("Logistic Regression", "Random Forest")

    def table(city):
        scored = _baselines(spark, d, kinds, city)
        found = at_once(spark, lambda k: learning.ranking_quality(scored[k]), kinds)
        return stack([_one_row(spark, k, x) for k, x in zip(kinds, found)])

    return _cities_at_once(spark, table)


@query("ml_eval_multi")
def ml_eval_multi(spark, d):
    kinds = ("Random Forest", "Hashed Forest")

    def table(city):
        scored = _baselines(spark, d, kinds, city)
        return stack([_one_row(spark, k, learning.class_quality(scored[k])) for k in kinds])

    return _cities_at_once(spark, table)


@query("ag_confusion")
def ag_confusion(spark, d):
    return _cities(lambda c: learning.confusion(_baseline(spark, d, "Hashed Forest", c)[1]))


@query("ml_roc_curve")
def ml_roc_curve(spark, d):
    kinds = ("Logistic Regression", "Random Forest")

    def table(city):
        scored = _baselines(spark, d, kinds, city)
        curves = at_once(spark, lambda k: learning.roc_curve(scored[k]), kinds)
        return stack([curve.withColumn("model", F.lit(k)) for k, curve in zip(kinds, curves)])

    return _cities_at_once(spark, table)


@query("ml_compare")
def ml_compare(spark, d):
    kinds = ("Logistic Regression", "Random Forest")

    def table(city):
        scored = _baselines(spark, d, kinds, city)
        found = at_once(spark, lambda k: {**learning.ranking_quality(scored[k]), **learning.class_quality(scored[k])}, kinds)
        return learning.comparison(dict(zip(kinds, found)), spark)

    return _cities_at_once(spark, table)


@query("ml_importance")
def ml_importance(spark, d):
    def table(city):
        model, _ = _baseline(spark, d, "Random Forest", city)
        return learning.ranked_importance(spark, model.stages[-1], _onehot(spark, d, city)[0].names())

    return _cities_at_once(spark, table)


@query("sink_model")
def sink_model(spark, d):
    """Save a pipeline, load it again, and score the test rows with the loaded one."""
    def reloaded(city):
        path = work_dir(spark, "model")
        sinks.save_model(_baseline(spark, d, "Hashed Forest", city)[0], path)
        return learning.confusion(PipelineModel.load(path).transform(_labelled(spark, d, city)[1]))

    return _cities(reloaded)


@query("ml_transfer")
def ml_transfer(spark, d):
    return learning.transfer(web_model_ready(spark, d), freight_model_ready(spark, d), *CITIES, ID)


@lru_cache(maxsize=8)
def _tail(spark, d, city):
    rows = learning.keep_missing(CITY_ROWS[city](spark, d).filter("response_minutes IS NOT NULL"), learning.TAIL_FEATURES)
    train, test = kept_split(rows.select("incident_id", "response_minutes", *learning.TAIL_FEATURES), ID)
    counted = settle(learning.collapsed(train, learning.TAIL_FEATURES, "response_minutes"))
    model = learning.train([*learning.hashed([], learning.TAIL_FEATURES, "error"), learning.boosted(weight="n")], counted)
    return settle(model.transform(test).select("incident_id", "response_minutes", "prediction"))


@query("ml_gbt_reg")
def ml_gbt_reg(spark, d):
    return _cities(lambda c: _tail(spark, d, c))


@query("ml_eval_reg")
def ml_eval_reg(spark, d):
    return _cities(lambda c: learning.regression_quality(_tail(spark, d, c)))


@query("ag_tail_compare")
def ag_tail_compare(spark, d):
    return _cities(lambda c: learning.tail_comparison(_tail(spark, d, c)))


@lru_cache(maxsize=8)
def _forecaster(spark, d, city):
    """The fitted forest, the next day's slots, their history and the last incident, which both forecasts share. Rows of unknown level train, too."""
    rows = stored(CITY_ROWS[city](spark, d).select("incident_datetime", learning.LABEL, *learning.FORECAST_FEATURES), "history")
    known = rows.filter("delay_indicator IS NOT NULL")
    stages = [*learning.hashed([], learning.FORECAST_FEATURES, "error"), learning.forest(trees=20)]
    model = learning.train(stages, learning.keep_missing(known, learning.FORECAST_FEATURES))
    last = rows.agg(F.max("incident_datetime")).first()[0]
    return model, settle(forecast.future_slots(rows)), settle(forecast.history_profile(known)), last


def _forecast(spark, d, city, fill):
    """Delay risk of the next day's hours. The slots' level is the most frequent known one."""
    model, hours, profile, last = _forecaster(spark, d, city)
    slots = forecast.slot_features(hours, profile, fill)
    if not fill:
        slots = slots.where("calls_past_30min IS NOT NULL")
    return learning.forecast(model, learning.keep_missing(slots, learning.FORECAST_FEATURES), last).drop("forecast_generated_at")


@query("ml_forecast")
def ml_forecast(spark, d):
    """Slots without history are skipped."""
    return _cities(lambda c: _forecast(spark, d, c, fill=False))


@query("ml_forecast_fill")
def ml_forecast_fill(spark, d):
    """Slots without history get the default demand and level."""
    return _cities(lambda c: _forecast(spark, d, c, fill=True))


@query(
    "ml_forecast_slots",
    INC_SQL + """, k AS (SELECT DISTINCT city, hour, day_of_week FROM inc WHERE delay_indicator IS NOT NULL),
    s AS (SELECT city, latest, unnest(range(1, 25)) AS i FROM (SELECT city, max(incident_datetime) AS latest FROM inc GROUP BY 1)),
    f AS (SELECT s.city, latest + to_hours(i) AS t, k.city IS NOT NULL AS seen FROM s LEFT JOIN k
      ON k.city = s.city AND k.hour = hour(latest + to_hours(i)) AND k.day_of_week = dayofweek(latest + to_hours(i)) + 1)
    SELECT city, true AS filled, count(*) AS slots, min(t) AS first, max(t) AS last FROM f GROUP BY 1
    UNION ALL SELECT city, false, count(*), min(t), max(t) FROM f WHERE seen GROUP BY 1""",
)
def ml_forecast_slots(spark, d):
    """Which hours have a forecast: all of the next day with defaults, those with a history without."""
    at = F.col("forecast_timestamp")
    parts = []
    for filled, rows in ((True, ml_forecast_fill(spark, d)), (False, ml_forecast(spark, d))):
        risk = F.col("delay_risk_probability").between(0, 1)
        part = rows.where(risk).groupBy("city").agg(F.count("*").alias("slots"), F.min(at).alias("first"), F.max(at).alias("last"))
        parts.append(part.select("city", F.lit(filled).alias("filled"), "slots", "first", "last"))
    return stack(parts)


@query(
    "ag_confusion_totals",
    MODEL_SQL + """SELECT city, delay_indicator, count(*) AS n FROM mr WHERE delay_indicator IS NOT NULL
      AND ('0x' || left(md5('42|' || incident_id), 13))::BIGINT / 4503599627370496 >= 0.8 GROUP BY ALL""",
)
def ag_confusion_totals(spark, d):
    """Every test row is in one cell of the confusion table."""
    return ag_confusion(spark, d).groupBy("city", "delay_indicator").agg(F.sum("n").alias("n"))


def _only(rows, names):
    """The named columns in the order that they have, which decides how Spark deals rows out, and so what summaries hold."""
    return rows.select(*[c for c in rows.columns if c in names])


@lru_cache(maxsize=4)
def _quantiles(spark, d):
    """Boosted P90 and P95 of the test rows, the trees of both cities grown in the same passes."""
    def split(city):
        rows = _only(quantile.capped(CITY_ROWS[city](spark, d)), [*ID, "response_minutes", *FEATURES])
        return kept_split(learning.keep_missing(rows, learning.NUMERIC), ID)

    # A table each, so that the cities' rows stay in this order: residuals are summed up by block.
    train, test = (union_tagged(dict(zip(CITIES, side))) for side in zip(*map(split, CITIES)))
    found = quantile.boosted_quantiles(train, test, ["city"], learning.CATEGORICAL, learning.NUMERIC, "response_minutes", ID)
    return stored(found.select("city", *ID, "response_minutes", "pred_p90", "pred_p95"), "quantiles")


@query("ml_quantile")
def ml_quantile(spark, d):
    return _quantiles(spark, d).select("incident_id", "response_minutes", "pred_p90", "pred_p95", "city")


@query(
    "ml_quantile_rows",
    MODEL_SQL + """SELECT city, count(*) AS n FROM mr WHERE response_minutes > 0 AND response_minutes <= 180
      AND ('0x' || left(md5('42|' || incident_id), 13))::BIGINT / 4503599627370496 >= 0.8 GROUP BY 1""",
)
def ml_quantile_rows(spark, d):
    """Every held-out row has both predictions, unknown levels and numbers included."""
    found = _quantiles(spark, d).where("pred_p90 IS NOT NULL AND pred_p95 IS NOT NULL")
    return found.groupBy("city").agg(F.count("*").alias("n"))


@query("ml_quantile_quality")
def ml_quantile_quality(spark, d):
    return _cities(lambda c: quantile.quantile_quality(_quantiles(spark, d).where(F.col("city") == c)))


@query(
    "ml_pinball",
    INC_SQL + """, q AS (SELECT city, incident_category, quantile_disc(response_minutes, 0.9) AS p90 FROM inc WHERE response_minutes IS NOT NULL GROUP BY ALL)
    SELECT city, round(avg(greatest(0.9::DOUBLE * (response_minutes - p90), -0.1::DOUBLE * (response_minutes - p90))), 6) AS pinball_loss,
      round(avg(abs(response_minutes - p90)), 6) AS mae FROM inc JOIN q USING (city, incident_category) WHERE response_minutes IS NOT NULL GROUP BY 1""",
)
def ml_pinball(spark, d):
    """Loss of predicting every category's own P90."""
    counts = written(agg.value_counts(incidents(spark, d), ["city", "incident_category"], "response_minutes"), "counts")
    groups = ["city", "incident_category"]
    q = agg.exact_percentiles(counts, groups, "response_minutes", {"p90": 0.9}, weight="n", nearest=True)
    rows = agg.join_groups(counts, q, groups)
    e, n = F.col("response_minutes") - F.col("p90"), F.col("n")
    loss = F.greatest(F.lit(0.9) * e, F.lit(0.9 - 1) * e)
    return rows.groupBy("city").agg(
        F.round(F.sum(loss * n) / F.sum(n), 6).alias("pinball_loss"), F.round(F.sum(F.abs(e) * n) / F.sum(n), 6).alias("mae")
    )


@lru_cache(maxsize=4)
def _attributed(spark, d):
    """Boosted delay classifiers of both cities, grown in the same passes, and the attributions of their test rows."""
    rows = _only(model_ready(spark, d).filter("delay_indicator IS NOT NULL"), ["city", *ID, learning.LABEL, *FEATURES])
    train, test = kept_split(learning.keep_missing(rows, learning.NUMERIC), ID)
    means = encoding.known_means(train, ["city"], learning.CATEGORICAL, "delay_indicator", ID)
    parts = (train.withColumn("__own", F.lit(True)), test.withColumn("__own", F.lit(False)))
    known, fresh = (encoding.encoded(p, means, ["city"], learning.CATEGORICAL, ID, "__own").drop("__own") for p in parts)
    names = [*[f"enc_{c}" for c in learning.CATEGORICAL], *learning.NUMERIC]
    read = {"city", learning.LABEL, *names}
    model = boosting.fit(stored(known.select(*[c for c in known.columns if c in read]), "encoded"), ["city"], names, learning.LABEL, [boosting.Logistic()])
    keep = ["city", "incident_id", "delay_indicator", *FEATURES]
    return stored(attribution.attribute_margin(attribution.BoostedExplainer.of(model), fresh, ["city"], keep, FEATURES), "attributed")


def _explained(spark, d, city):
    return _attributed(spark, d).where(F.col("city") == city).drop("city")


def _ranking(spark, d, city):
    named = _explained(spark, d, city).select(*[F.col(f"phi_{n}").alias(n) for n in FEATURES])
    return agg.mean_abs_importance(named, [], FEATURES)


@query("ml_shap")
def ml_shap(spark, d):
    """Parts of the log odds of a delay, for every test row."""
    return _attributed(spark, d).drop("delay_indicator")


@query("ml_shap_importance")
def ml_shap_importance(spark, d):
    return _cities(lambda c: _ranking(spark, d, c))


@query("ml_shap_driver_table")
def ml_shap_driver_table(spark, d):
    """The cities' attribution rankings side by side, with the class of every leading feature."""
    table = drivers.driver_table(*[_ranking(spark, d, c) for c in CITIES], *CITIES, top_n=10)
    classes = drivers.driver_classes(table, *CITIES).select("feature", "driver_class", "top_divergence")
    return table.join(classes, "feature", "left")


@query("ml_shap_categories")
def ml_shap_categories(spark, d):
    return _cities(lambda c: agg.top_categories_by_magnitude(_explained(spark, d, c), [], "incident_category", "phi_incident_category", 8))


@query("ml_shap_case")
def ml_shap_case(spark, d):
    return _cities(lambda c: attribution.riskiest_case(_explained(spark, d, c), FEATURES, ID))


@query("tk_argmax")
def tk_argmax(spark, d):
    """The incident with the highest predicted delay probability."""
    best = F.min_by(F.struct("incident_id", "probability"), F.struct((-F.col("probability")).alias("p"), F.col("incident_id").alias("i")))
    return _cities(lambda c: _explained(spark, d, c).agg(best.alias("b")).select("b.*"))


@query("ml_dependence")
def ml_dependence(spark, d):
    return _cities(lambda c: attribution.dependence(_explained(spark, d, c), "calls_past_60min", "hour"))


@query(
    "ml_shap_sums",
    MODEL_SQL + "SELECT DISTINCT city, true AS adds_up, true AS in_range FROM mr WHERE delay_indicator IS NOT NULL",
)
def ml_shap_sums(spark, d):
    """Attributions and base value add up to the log odds, for every test row."""
    def check(city):
        rows = _explained(spark, d, city)
        total = sum((F.col(f"phi_{n}") for n in FEATURES), F.col("base_value"))
        return rows.agg(
            F.coalesce(F.max(F.abs(total - F.col("margin"))) < 1e-9, F.lit(True)).alias("adds_up"),
            F.coalesce(F.min(F.col("probability").between(0, 1)), F.lit(True)).alias("in_range"),
        )

    return _cities(check)


@query(
    "ml_quantile_order",
    MODEL_SQL + "SELECT DISTINCT city, true AS ordered FROM mr WHERE response_minutes > 0 AND response_minutes <= 180",
)
def ml_quantile_order(spark, d):
    """No predicted P90 is above its P95."""
    return _cities(lambda c: _quantiles(spark, d).where(F.col("city") == c).agg(F.min(F.col("pred_p90") <= F.col("pred_p95") + 1e-9).alias("ordered")))


_LOCATION = ("call_volume", "mean_response", "p90_response", "median_response", "mean_calls_30", "mean_calls_60", "mean_alarm_level", "high_alarm_share")


@lru_cache(maxsize=4)
def _locations(spark, d):
    rows = counted_model_ready(spark, d, ("location_area", "response_minutes", "unified_alarm_level"))
    features = agg.location_features(rows, ["city", "location_area"], weight="n")
    return settle(clusters.standardise(settle(features), _LOCATION))


@query("ml_kmeans")
def ml_kmeans(spark, d):
    return clusters.kmeans(_locations(spark, d)).select("city", "location_area", "cluster")


@query("ml_elbow")
def ml_elbow(spark, d):
    return clusters.elbow(_locations(spark, d))


@query("ml_pca")
def ml_pca(spark, d):
    coords, _ = clusters.principal_components(_locations(spark, d), _LOCATION)
    return coords.select("city", "location_area", "pc1", "pc2")


@query("ml_pca_loadings")
def ml_pca_loadings(spark, d):
    return clusters.principal_components(_locations(spark, d), _LOCATION)[1]


@query("ml_cluster_profile")
def ml_cluster_profile(spark, d):
    return clusters.cluster_profile(clusters.kmeans(_locations(spark, d)), _LOCATION)


@query("ml_cluster_top")
def ml_cluster_top(spark, d):
    return clusters.cluster_top(clusters.kmeans(_locations(spark, d)), ["city", "location_area"])
