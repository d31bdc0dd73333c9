from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from lagline.operators import attribution, clusters, forecast, learning, onehot, quantile


def rows(spark, n=400, seed=4):
    rng = np.random.default_rng(seed)
    kind, hour = rng.choice(["fire", "medical", "gas"], n), rng.integers(0, 24, n)
    y = (rng.random(n) < 0.2 + 0.5 * (kind == "gas") + 0.2 * (hour > 12)).astype(int)
    m = np.round(rng.exponential(5, n) + 10 * y + 1, 2)
    data = [(str(i), str(k), int(h), int(a), float(b)) for i, (k, h, a, b) in enumerate(zip(kind, hour, y, m))]
    return spark.createDataFrame(data, "incident_id string, kind string, hour int, delay_indicator int, response_minutes double")


@pytest.fixture(scope="module")
def scored(spark):
    df = rows(spark)
    model = learning.train([*learning.onehot_scaled(["kind"], ["hour"]), learning.logistic()], df)
    return model, model.transform(df).persist()


def test_class_quality_equals_the_evaluators(scored):
    _, pred = scored
    q = learning.class_quality(pred)
    names = {"accuracy": "accuracy", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall", "f1": "f1"}
    for ours, theirs in names.items():
        ev = MulticlassClassificationEvaluator(labelCol="delay_indicator", metricName=theirs)
        assert q[ours] == pytest.approx(ev.evaluate(pred))
    assert q["test_positive_rate"] == pytest.approx(pred.agg(F.avg("delay_indicator")).first()[0])


def test_roc_curve_area_equals_auc(scored):
    _, pred = scored
    pts = sorted((r["fpr"], r["tpr"]) for r in learning.roc_curve(pred, blocks=7).collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)
    area = sum((x1 - x0) * (y0 + y1) / 2 for (x0, y0), (x1, y1) in zip(pts, pts[1:]))
    assert area == pytest.approx(learning.ranking_quality(pred)["auc_roc"], abs=1e-6)


def test_importance_names_follow_the_vector(scored):
    _, pred = scored
    names = learning.feature_names(pred, "unscaled_features")
    assert len(names) == pred.first()["features"].size and names[-1] == "hour" and any("gas" in n for n in names)


def test_regression_quality(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 4.0)], "response_minutes double, prediction double")
    r = learning.regression_quality(df).first()
    assert r["rmse"] == pytest.approx((5 / 3) ** 0.5) and r["mae"] == 1.0 and r["r2"] == pytest.approx(1 - 5 / 14)


def tree_value(nodes, i, x, known):
    """Expected leaf value when only the features in `known` are seen: the textbook recursion."""
    n = nodes[i]
    if n["leftChild"] < 0:
        return n["impurityStats"][1] / sum(n["impurityStats"])
    split = n["split"]
    f, test = split["featureIndex"], split["leftCategoriesOrThreshold"]
    left = x[f] in test if split["numCategories"] != -1 else x[f] <= test[0]
    if f in known:
        return tree_value(nodes, n["leftChild"] if left else n["rightChild"], x, known)
    wl, wr = (sum(nodes[c]["impurityStats"]) for c in (n["leftChild"], n["rightChild"]))
    parts = [tree_value(nodes, n[c], x, known) for c in ("leftChild", "rightChild")]
    return (wl * parts[0] + wr * parts[1]) / (wl + wr)


def test_attributions_match_subset_enumeration(spark, tmp_path):
    df = rows(spark)
    ex = attribution.fit_explainer(df, ["kind"], ["hour"], trees=5, depth=4)
    nodes = attribution.forest_nodes(ex.pipeline.stages[-1], str(tmp_path / "forest"), spark)
    got = attribution.attribute(ex, df, ["incident_id"]).orderBy("incident_id").limit(25).collect()
    xs = {r["incident_id"]: r["features"].toArray() for r in ex.pipeline.transform(df).collect()}
    features = range(2)
    for r in got:
        x = xs[r["incident_id"]]
        value = lambda s: np.mean([tree_value(t, 0, x, s) for t in nodes.values()])
        for f, name in enumerate(ex.names):
            others = [g for g in features if g != f]
            phi = sum(
                factorial(k) * factorial(len(others) - k) / factorial(len(others) + 1) * (value({*s, f}) - value(set(s)))
                for k in range(len(others) + 1) for s in combinations(others, k)
            )
            assert r[f"phi_{name}"] == pytest.approx(phi, abs=1e-12)
        assert r["base_value"] == pytest.approx(value(set()))
        assert sum(r[f"phi_{n}"] for n in ex.names) + r["base_value"] == pytest.approx(r["probability"], abs=1e-12)
    case = attribution.riskiest_case(attribution.attribute(ex, df, ["incident_id"]), ex.names, ["incident_id"]).collect()
    best = max(attribution.attribute(ex, df, ["incident_id"]).collect(), key=lambda r: r["probability"])
    assert case[0]["probability"] == pytest.approx(best["probability"]) and len(case) == 2


def test_quantile_forest_orders_and_covers(spark):
    df = rows(spark, 2000)
    model = quantile.fit_quantile_forest(df, ["kind"], ["hour", "delay_indicator"], trees=8, depth=4)
    pred = quantile.predict_quantiles(model, df).persist()
    assert pred.filter("pred_p95 < pred_p90 OR pred_p90 IS NULL").count() == 0
    q = {r["quantile"]: r for r in quantile.quantile_quality(pred).collect()}
    assert 0.85 < q[0.9]["coverage"] < 0.97 and 0.9 < q[0.95]["coverage"] < 0.99
    flat = pred.agg(F.expr("percentile(response_minutes, 0.9)")).first()[0]
    worse = pred.agg(quantile.pinball("response_minutes", F.lit(flat), 0.9)).first()[0]
    assert q[0.9]["pinball_loss"] < worse


def test_pinball_by_hand(spark):
    df = spark.createDataFrame([(10.0, 8.0), (10.0, 12.0)], "y double, p double")
    assert df.agg(quantile.pinball("y", "p", 0.9)).first()[0] == pytest.approx((0.9 * 2 + 0.1 * 2) / 2)


def test_forecast_slots(spark):
    df = spark.createDataFrame([("2024-03-02 22:30:00",), ("2024-03-01 10:00:00",)], "t string").select(
        F.to_timestamp("t").alias("incident_datetime")
    )
    slots = forecast.future_slots(df).orderBy("forecast_timestamp").collect()
    assert len(slots) == 24 and str(slots[0]["forecast_timestamp"]) == "2024-03-02 23:30:00"
    assert (slots[0]["hour"], slots[0]["day_of_week"], slots[1]["day_of_week"]) == (23, 7, 1)
    known = spark.createDataFrame([(23, 7, 4, 9, 2), (23, 7, 6, 11, 2), (1, 1, 0, 0, 1)],
                                  "hour int, day_of_week int, calls_past_30min bigint, calls_past_60min bigint, unified_alarm_level int")
    profile = forecast.history_profile(known)
    plain = forecast.slot_features(forecast.future_slots(df), profile)
    assert plain.filter("calls_past_30min = 5 AND unified_alarm_level = 2").count() == 1
    assert plain.filter("calls_past_30min IS NULL").count() == 22
    filled = forecast.slot_features(forecast.future_slots(df), profile, fill=True)
    assert filled.filter("calls_past_30min = 0 AND unified_alarm_level = 1").count() == 22


def test_clusters(spark):
    rng = np.random.default_rng(0)
    data = [(f"a{i}", float(c + rng.normal(0, 0.1)), float(-c), 7.0) for i, c in enumerate(np.repeat([0, 10, 20], 8))]
    df = spark.createDataFrame(data, "area string, u double, v double, w double")
    z = clusters.standardise(df, ["u", "v", "w"])
    assert z.count() == 24
    groups = clusters.kmeans(z, 3).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in groups) == [8, 8, 8]
    cost = {r["k"]: r["inertia"] for r in clusters.elbow(z, [2, 3, 4]).collect()}
    assert cost[2] > cost[3] >= cost[4]
    coords, loadings = clusters.principal_components(z, ["u", "v", "w"])
    l = {r["feature"]: r["pc1"] for r in loadings.collect()}
    assert abs(l["u"]) == pytest.approx(0.7071, abs=1e-3) and l["w"] == pytest.approx(0, abs=1e-9)
    assert coords.agg(F.stddev_pop("pc1")).first()[0] == pytest.approx(2**0.5, rel=1e-2)


def test_boosting_on_collapsed_rows_equals_boosting_on_all(spark):
    """Weighted means per distinct features give the same splits and leaves as the rows themselves."""
    df = rows(spark, 600).withColumn("level", F.expr("CAST(incident_id AS INT) % 3")).drop("delay_indicator")
    counted = learning.collapsed(df, ["hour", "level"], "response_minutes")
    assert counted.count() == df.select("hour", "level").distinct().count() < 100 and counted.agg(F.sum("n")).first()[0] == 600
    stages = learning.hashed([], ["hour", "level"], "error")
    plain = learning.train([*stages, learning.boosted()], df).transform(df)
    ours = learning.train([*stages, learning.boosted(weight="n")], counted).transform(df)
    a, b = ([r[0] for r in m.orderBy("incident_id").select("prediction").collect()] for m in (plain, ours))
    assert b == pytest.approx(a, rel=1e-9)


def test_transfer_reads_its_training_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = rows(spark)
    watched = df.repartition(2).mapInArrow(counted, df.schema).withColumnRenamed("kind", "incident_category")
    found = learning.transfer(watched, df.withColumnRenamed("kind", "incident_category"), "a", "b", ["incident_id"]).collect()
    assert len(found) == 1 and found[0]["auc_roc"] > 0.6 and read.value == 400


@pytest.mark.parametrize("levels", [3, 40])
def test_one_hot_vectors_are_those_of_sparks_stages(spark, levels):
    """Sparse and dense ones, with missing and unknown levels, zeros and ties of levels; no schema has names of the slots."""
    data = [(i, f"k{i * i % levels}" if i % 7 else None, "ab"[i % 2], i % 5, i % 3 - 1) for i in range(200)]
    df = spark.createDataFrame(data, "incident_id int, kind string, side string, hour int, month int")
    unknown = spark.createDataFrame([(999, "never", "a", 0, 1), (1000, None, None, 0, 0)], df.schema)
    stages = learning.train(learning.onehot_scaled(["kind", "side"], ["hour", "month"]), df)
    plain = stages.transform(df.union(unknown))
    found = onehot.fit(df, ["kind", "side"], ["hour", "month"])
    own = found.vectors(df.union(unknown), ["incident_id"], "unscaled_features")
    assert "ml_attr" not in own.schema["unscaled_features"].metadata
    scaled = learning.train([learning.scaler()], found.vectors(df, ["incident_id"], "unscaled_features")).transform(own)
    columns = ["incident_id", "unscaled_features", "features"]
    got, want = (sorted(x.select(*columns).collect(), key=lambda r: r[0]) for x in (scaled, plain))
    assert [(r[0], type(r[1]), r[1], r[2]) for r in got] == [(r[0], type(r[1]), r[1], r[2]) for r in want]
    assert found.names() == learning.feature_names(plain, "unscaled_features")
