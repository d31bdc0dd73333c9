import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagline import session
from lagline.operators import aggregates as agg
from lagline.operators import dedup, demand, drivers, quality, ranking, reshape, sampling


def rand_events(n, seed, span=20_000, null_share=0.02, hot=0.4):
    """Times with ties and gaps; one area holds `hot` of all rows."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        t = None if r.random() < null_share else r.randrange(span)
        area = "hot" if r.random() < hot else f"a{r.randrange(6)}"
        rows.append((i, area, t))
    return rows


def test_demand_windows_match_brute_force(spark):
    rows = rand_events(600, 1)
    df = spark.createDataFrame(rows, "id int, area string, s int").withColumn("t", F.timestamp_seconds("s"))
    city = {r["id"]: r for r in demand.citywide_calls(df, "t").collect()}
    area = {r["id"]: r for r in demand.area_calls(df, "t", "area").collect()}
    assert len(city) == len(area) == len(rows)
    for i, a, t in rows:
        for col, back in demand.LOOKBACKS.items():
            if t is None:
                want_city = sum(u is None for _, _, u in rows)
                want_area = sum(u is None and b == a for _, b, u in rows) - 1
            else:
                want_city = sum(u is not None and t - back <= u <= t - 1 for _, _, u in rows)
                want_area = sum(u is not None and b == a and t - back <= u <= t for _, b, u in rows) - 1
            assert city[i][col] == want_city
            assert area[i][col] == want_area


def test_keep_first_is_repeatable_and_groups_nulls(spark):
    rows = [(None, 3, "c"), (None, 1, "b"), (1, 2, "a"), (1, 2, "A"), (2, 5, "z")]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    want = {(None, 1, "b"), (1, 2, "A"), (2, 5, "z")}
    for parts in (1, 4):
        got = dedup.keep_first(df.repartition(parts), ["k"], ["o"]).select("k", "o", "v").collect()
        assert {tuple(r) for r in got} == want


def test_exact_percentiles_with_a_hot_group(spark):
    rng = np.random.default_rng(3)
    groups = {"hot": rng.normal(50, 200, 900).round(1), "one": np.array([7.5]), "ties": np.array([1.0] * 5 + [9.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("hot", None)], "g string, v double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = {r["g"]: r for r in agg.exact_percentiles(df, ["g"], "v", probs).collect()}
    for g, vs in groups.items():
        for n, p in probs.items():
            assert got[g][n] == pytest.approx(np.percentile(vs, 100 * p))


def test_histogram_and_outliers_conserve_rows(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(101)] + [("b", 5.0), ("b", None)], "c string, response_minutes double")
    h = agg.histogram(df, ["c"], bins=10).collect()
    assert sum(r["n"] for r in h if r["c"] == "a") == 101 and max(r["bin"] for r in h) == 9
    assert [(r["bin"], r["n"]) for r in h if r["c"] == "b"] == [(0, 1)]
    out = {r["c"]: r for r in agg.outlier_profile(df, ["c"]).collect()}
    assert out["a"]["n_total"] == 101 and out["a"]["n_outliers"] == 0


def test_mode_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(2,), (2,), (1,), (1,), (None,), (None,), (None,)], "v int")
    assert agg.mode_of(df, [], "v").first() == (1, 2)


def test_expectations(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    rules = {"positive": "v > 0"}
    assert [r[0] for r in quality.expect_or_drop(df, rules).collect()] == [1]
    kept, report = quality.expect(df, rules)
    assert kept.count() == 3 and [tuple(r) for r in report.collect()] == [(3, "positive", 2)]
    with pytest.raises(ValueError):
        quality.require_two_classes(df.withColumn("y", F.lit(1)), "y")


def test_reshape(spark):
    df = spark.createDataFrame([("x", "a", 1), ("x", "b", 2), ("y", "a", 3)], "r string, c string, v int")
    assert {tuple(r) for r in reshape.count_pivot(df, "r", "c", ["a", "b"]).collect()} == {("x", 1, 1), ("y", 1, 0)}
    sets = reshape.membership(df.filter("c = 'a'"), df.filter("c = 'b'"), "r", "only_a", "only_b").collect()
    assert {tuple(r) for r in sets} == {("x", "common"), ("y", "only_a")}


def test_alignment_and_smoothing(spark):
    s = spark.createDataFrame([(2.5, 1.0), (4.0, 3.0)], "time double, h double")
    got = [r["h"] for r in ranking.align_to_grid(s, [], "time", "h", 6).orderBy("time").collect()]
    assert got == [1.0, 1.0, 1.0, 1.0, 3.0, 3.0, 3.0]
    sm = ranking.smooth(s, [], "time", "h", 5).orderBy("time").collect()
    assert [r["h"] for r in sm] == [2.0, 2.0]


def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    a = sampling.sample_fraction(df, 0.2, ["id"]).collect()
    b = sampling.sample_fraction(df.repartition(13), 0.2, ["id"]).collect()
    assert set(a) == set(b) and 800 < len(a) < 1200
    train, test = sampling.split_train_test(df, ["id"])
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0
    n = {r["y"]: r["count"] for r in sampling.balanced_sample(df, "y", ["id"]).groupBy("y").count().collect()}
    assert n[1] == 500 and 400 < n[0] < 600
    assert set(sampling.fixed_size_sample(df, 50, ["id"]).collect()) == set(sampling.fixed_size_sample(df.repartition(7), 50, ["id"]).collect())


def test_driver_table_and_classes(spark):
    a = spark.createDataFrame([(" Hour ", 0.5, 1), ("month", 0.1, 2), ("year", 0.01, 3)], "feature string, mean_abs double, rank int")
    b = spark.createDataFrame([("hour", 0.2, 1), ("area", 0.1, 2), ("month", 0.05, 3)], "feature string, mean_abs double, rank int")
    t = drivers.driver_table(a, b, "a", "b", top_n=2)
    rows = {r["feature"]: r for r in t.collect()}
    assert {k: r["category"] for k, r in rows.items()} == {"hour": "common", "month": "a_specific", "area": "b_specific"}
    assert rows["hour"]["importance_gap_pct"] == pytest.approx(150.0, rel=1e-6)
    assert rows["area"]["rank_diff"] is None and rows["area"]["a_mean_abs"] == 0.0
    classes = {r["feature"]: r for r in drivers.driver_classes(t, "a", "b").collect()}
    assert classes["hour"]["driver_class"] == "shared" and classes["hour"]["top_divergence"]
    assert classes["area"]["driver_class"] == "b_dominant"


def test_driver_strength_skips_unusable_ratios(spark):
    rows = [("season_winter", 0.8, 0.01), ("day_of_week_3", 1.5, 0.2), ("calls_past_30min", float("inf"), 0.0), ("day_of_week_2", 1.25, 0.001)]
    hr = spark.createDataFrame(rows, "covariate string, hazard_ratio double, p double").withColumn("city", F.lit("x"))
    out = drivers.driver_strength(hr, ["city"], alpha=0.05).collect()
    assert [(r["bucket"], r["count"], r["max_effect"], r["top5_mean"]) for r in out] == [("Temporal", 2, 1.25, 1.25)]


def test_nearest_rank_percentiles_of_more_values_than_any_sketch_holds(spark):
    n = 60_000
    df = spark.range(n).selectExpr("id % 7 AS g", "pow(id, 3) / 7 AS v", "id").withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    probs = {"a": 0.001, "b": 0.25, "c": 0.5, "d": 0.9999}
    got = {r["g"]: r for r in agg.exact_percentiles(df, ["g"], "v", probs, nearest=True, extras={"n": F.sum("n")}).collect()}
    for g in range(7):
        vs = [i**3 / 7 for i in range(n) if i % 7 == g]
        assert got[g or None]["n"] == len(vs)
        for name, p in probs.items():
            assert got[g or None][name] == vs[max(0, math.ceil(p * len(vs)) - 1)]
    close = {r["g"]: r for r in agg.approx_percentiles(df, ["g"], "id", probs, accuracy=1000).collect()}
    for g, r in close.items():
        size = got[g]["n"]
        assert all(abs(r[name] / 7 - p * size) <= size / 1000 + 1 for name, p in probs.items())


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 100.0), (3, 4.0), (3, None), (4, None)], "g int, v double")
    assert {(r["g"], r["n_total"]) for r in agg.outlier_profile(df, ["g"], "v").collect()} == {(None, 3), (3, 1)}
    bins = agg.histogram(df, ["g"], "v", 2).collect()
    assert {(r["g"], r["bin"], r["n"]) for r in bins} == {(None, 0, 2), (None, 1, 1), (3, 0, 1)}
    keys = spark.createDataFrame([(None, 1), (None, 2), (3, 3), (3, 4), (5, 5)], "k int, v int")
    assert sorted(r["v"] for r in quality.duplicate_sample(keys, ["k"]).collect()) == [1, 2]
    areas = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "g string, response_minutes double")
    assert {tuple(r) for r in agg.area_summary(areas, ["g"]).collect()} == {("a", 2, 1, 1, 1.0, 1.0, 50.0), ("b", 1, 1, 0, None, None, 100.0)}


def test_overall_rate_follows_from_the_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", None), ("b", 1)], "city string, delay_indicator int")
    got = {tuple(r) for r in agg.delay_rate(df, ["city"], overall=True).collect()}
    assert got == {("a", 2, 1, 50.0), ("b", 2, 1, 100.0), ("all", 4, 2, 66.67)}


def test_windows_of_calls_sort_by_a_number_first(spark):
    """Rows of one group stand together by a hash, which is compared faster than the names of areas."""
    rows = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP '2024-01-01 00:00:00'), ('a', TIMESTAMP '2024-01-01 00:10:00'), (NULL, NULL), (NULL, NULL) AS t(area, at)")
    counts = demand.calls_per_second(rows, "at", ["area"], demand.LOOKBACKS, include_current=True)
    assert [tuple(r) for r in counts.orderBy("__sec").select("area", "calls_past_30min", "calls_past_60min").collect()] == [(None, 2, 2), ("a", 1, 1), ("a", 2, 2)]
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(area" in plan


def test_a_kept_split_works_its_hash_out_once(spark):
    df = spark.range(2000).selectExpr("CAST(id AS string) AS id", "id % 3 AS v")
    for kept, plain in zip(sampling.kept_split(df, ["id"]), sampling.split_train_test(df, ["id"])):
        assert sorted(kept.collect()) == sorted(plain.collect()) and kept.columns == plain.columns
        own, *below = kept._jdf.queryExecution().optimizedPlan().treeString().split("InMemoryRelation")
        assert below and "md5" not in own


def test_a_balanced_sample_has_all_rows_of_the_smaller_class(spark):
    df = spark.range(420_000).withColumn("y", (F.col("id") % 2).cast("int"))
    assert sampling.balanced_sample(df, "y", ["id"]).count() == 420_000
    assert sampling.balanced_sample(df, "y", ["id"], max_per_class=1000).count() < 3000


def test_written_rows_leave_no_shuffle_files(spark):
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    before = spark.conf.get(session.FREE_SHUFFLES, None)
    at_first = files()
    assert session.written(spark.range(1000).groupBy(F.col("id") % 7).count(), "counts").count() == 7
    for _ in range(50):
        if files() <= at_first:
            break
        time.sleep(0.2)
    assert files() <= at_first and spark.conf.get(session.FREE_SHUFFLES, None) == before


def test_a_kept_split_takes_disk_once(spark, monkeypatch):
    """As a table; what is kept besides is in memory only."""
    monkeypatch.setattr(sampling, "stored", session.written)
    train, test = sampling.kept_split(spark.range(100).withColumn("x", F.lit("a")), ["id"])
    assert train.count() + test.count() == 100
    assert "StorageLevel(memory, " in train._jdf.queryExecution().optimizedPlan().treeString()
