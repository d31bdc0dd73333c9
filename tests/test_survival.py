import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagline.functions.distributions import chi2_tail
from lagline.operators import cox, curves, logrank, survival
from lagline.session import work_dir

SCHEMA = "g string, response_minutes double, event_indicator int"


def sample(n, seed, groups=("a", "b", "c"), censored=0.2):
    rng = np.random.default_rng(seed)
    g = rng.choice(groups, n, p=[0.6] + [0.4 / (len(groups) - 1)] * (len(groups) - 1))
    t = rng.exponential(30, n).round(1) + 0.1
    miss = rng.random(n) < censored
    return [(str(a), None if m else float(round(b, 1)), 0 if m else 1) for a, b, m in zip(g, t, miss)]


@pytest.fixture(scope="module")
def data(spark):
    rows = sample(400, 5)
    view = survival.survival_view(spark.createDataFrame(rows, SCHEMA), ["g"]).persist()
    return view, view.toPandas()


def brute_km(t, e, at):
    s = 1.0
    for u in np.unique(t[(e == 1) & (t <= at)]):
        s *= 1 - ((t == u) & (e == 1)).sum() / (t >= u).sum()
    return s


def test_censoring_rules_and_idempotence(spark):
    rows = [("a", None, 0), ("a", 70.0, 1), ("a", 60.0, 1), ("a", -1.0, 1), ("a", 5.0, 0), ("a", 5.0, None)]
    view = survival.survival_view(spark.createDataFrame(rows, SCHEMA), ["g"])
    got = sorted((r["response_minutes"], r["event_indicator"]) for r in view.collect())
    assert got == [(5.0, 0), (60.0, 0), (60.0, 0), (60.0, 1)]
    again = survival.survival_view(view, ["g"])
    assert sorted((r["response_minutes"], r["event_indicator"]) for r in again.collect()) == got


def test_km_matches_brute_force(data):
    view, pdf = data
    curve = survival.kaplan_meier(survival.risk_table(view, ["g"]), ["g"]).persist()
    at = {(r["g"], r["threshold_min"]): r["survival_prob"] for r in survival.survival_at(curve, ["g"]).collect()}
    medians = {r["g"]: r["median_survival"] for r in survival.median_survival(curve, ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        t, e = part["response_minutes"].to_numpy(), part["event_indicator"].to_numpy()
        for th in survival.THRESHOLDS:
            assert at[g, th] == pytest.approx(brute_km(t, e, th))
        below = [u for u in np.unique(t) if brute_km(t, e, u) <= 0.5 + 1e-9]
        assert medians[g] == (below[0] if below else math.inf)
    total = curve.agg(F.sum("d"), F.sum(F.col("d") + F.col("c"))).first()
    assert total[0] == pdf["event_indicator"].sum() and total[1] == len(pdf)


def test_binned_hazard_chains_to_survival(data):
    """Without censoring before the horizon, the bins' at-risk counts chain and give S(horizon)."""
    view, pdf = data
    rows = survival.binned_hazard(survival.risk_table(view, []), []).orderBy("bin_start").collect()
    assert len(rows) == 30 and rows[0]["at_risk"] == len(pdf)
    for a, b in zip(rows, rows[1:]):
        assert b["at_risk"] == a["at_risk"] - a["events"]
    alive = (rows[-1]["at_risk"] - rows[-1]["events"]) / len(pdf)
    t, e = pdf["response_minutes"].to_numpy(), pdf["event_indicator"].to_numpy()
    assert alive == pytest.approx(brute_km(t, e, 59.99))


def test_published_hazard_arithmetic():
    # Published values of two cities: at risk before the last bin, its events, all rows, and S(60).
    for at_risk, events, n, s60 in ((12499, 3, 361710, 0.034547), (372544, 0, 1283156, 0.290334)):
        assert (at_risk - events) / n == pytest.approx(s60, abs=1e-6)


def brute_logrank(t, e, g):
    levels = sorted(set(g))
    k = len(levels)
    z, v = np.zeros(k), np.zeros((k, k))
    for u in np.unique(t[e == 1]):
        n = (t >= u).sum()
        d = ((t == u) & (e == 1)).sum()
        ng = np.array([((t >= u) & (g == x)).sum() for x in levels])
        dg = np.array([((t == u) & (e == 1) & (g == x)).sum() for x in levels])
        z += dg - ng * d / n
        if n > 1:
            v += d * (n - d) / (n - 1) * (np.diag(ng / n) - np.outer(ng / n, ng / n))
    return float(z[:-1] @ np.linalg.inv(v[:-1, :-1]) @ z[:-1]), k - 1


def test_logrank_matches_brute_force(data):
    view, pdf = data
    t, e, g = (pdf[c].to_numpy() for c in ("response_minutes", "event_indicator", "g"))
    stat, df = brute_logrank(t, e, g)
    r = logrank.logrank(view, [], "g").first()
    assert (r["df"], r["test_statistic"]) == (df, pytest.approx(stat)) and r["p_value"] == pytest.approx(chi2_tail(stat, df))
    two = logrank.two_sample(view, [], "g", "a", "b").first()
    m = g != "c"
    assert two["test_statistic"] == pytest.approx(brute_logrank(t[m], e[m], g[m])[0])
    assert two["n_a"] + two["n_b"] == m.sum() and two["events_a"] + two["events_b"] == e[m].sum()
    single = logrank.logrank(view.withColumn("h", F.lit("x")), [], "h").first()
    assert single["test_statistic"] == 0.0 and single["p_value"] == 1.0
    tail = logrank.logrank(view, [], "g", alpha=1.1).first()["higher_risk_group_tail"]
    s60 = {x: brute_km(t[g == x], e[g == x], 60) for x in set(g)}
    assert s60[tail] == pytest.approx(max(s60.values()))
    assert logrank.logrank(view, [], "g", alpha=0.0).first()["higher_risk_group_tail"] is None


@pytest.mark.parametrize("size", [50_000, 40])
def test_logrank_over_many_levels(spark, monkeypatch, size):
    """Hundreds of levels with unrounded times, in one range of times and in many: as the dense matrices of one machine."""
    from functools import partial

    rng = np.random.default_rng(size)
    n = 1500
    g, city = rng.integers(0, 150, n).astype(str), rng.choice(["x", "y"], n)
    t = np.where(rng.random(n) < 0.3, rng.integers(1, 20, n), rng.exponential(9, n) + 0.01)
    e = rng.integers(0, 2, n)
    view = spark.createDataFrame([(float(a), int(b), str(c), str(k)) for a, b, c, k in zip(t, e, g, city)], "response_minutes double, event_indicator int, g string, city string")
    monkeypatch.setattr(logrank, "with_risk", partial(logrank.with_risk, size=size))
    found = {r["city"]: r for r in logrank.logrank(view, ["city"], "g", alpha=1.1).collect()}
    for c in "xy":
        m = city == c
        stat, df = brute_logrank(t[m], e[m], g[m])
        assert found[c]["df"] == df and found[c]["test_statistic"] == pytest.approx(stat, rel=1e-6)
        s60 = {x: brute_km(t[m & (g == x)], e[m & (g == x)], 60) for x in set(g[m])}
        assert s60[found[c]["higher_risk_group_tail"]] == pytest.approx(max(s60.values()), abs=1e-9)


def test_curve_summaries(spark):
    rows = [(0.0, 1.0), (1.0, 0.8), (2.0, 0.4), (3.0, 0.4)]
    curve = spark.createDataFrame(rows, "time double, survival double").withColumn("city", F.lit("x"))
    assert curves.median_interpolated(curve, ["city"]).first()["median_survival_min"] == pytest.approx(1.75)
    assert curves.values_at(curve, ["city"], [2, 60]).first()["S(60m)"] == 0.4
    ok = curves.sanity(curve, ["city"]).first()
    assert ok["monotone"] and ok["in_range"] and not ok["contains_nan"] and ok["start_value"] == 1.0
    rising = curve.withColumn("survival", F.col("time") / 10)
    assert not curves.sanity(rising, ["city"]).first()["monotone"]
    never = curve.withColumn("survival", F.lit(0.9))
    assert math.isnan(curves.median_interpolated(never, ["city"]).first()["median_survival_min"])


# ---------------------------------------------------------------- Cox


def cox_frame(spark, n=300, seed=9):
    rng = np.random.default_rng(seed)
    cat = rng.choice(["p", "q"], n)
    num = rng.integers(0, 12, n)
    t = (rng.exponential(20 / np.exp(0.5 * (cat == "q") - 0.05 * num), n)).round(0) + 1
    rows = [(float(a) if rng.random() > 0.15 else None, int(m), str(c), int(h)) for a, m, c, h in zip(t, num, cat, rng.integers(0, 24, n))]
    df = spark.createDataFrame(rows, "response_minutes double, calls int, kind string, hour int")
    return df.withColumn("event_indicator", F.col("response_minutes").isNotNull().cast("int"))


@pytest.fixture(scope="module")
def fitted(spark):
    design = cox.build_design(cox_frame(spark), ["calls"], ["kind", "time_bin"])
    return design, cox.fit(design, 0.1), design.rows.toPandas()


def efron_by_hand(t, e, w, z, beta):
    ll = float(((w * e)[:, None] * z).sum(axis=0) @ beta)
    r = w * np.exp(z @ beta)
    for u in np.unique(t[e == 1]):
        dead = (t == u) & (e == 1)
        d = int(w[dead].sum())
        ll -= sum(math.log(r[t >= u].sum() - k / d * r[dead].sum()) for k in range(d))
    return ll


def test_cox_likelihood_gradient_and_optimum(fitted):
    design, model, pdf = fitted
    t, e, w = (pdf[c].to_numpy(dtype=float) for c in ("time", "event", "w"))
    z = (pdf[design.columns].to_numpy() - model.mean) / model.scale
    beta = model.coef * model.scale
    n, lam = model.n, model.penalty
    assert n == w.sum()
    assert model.log_likelihood == pytest.approx(efron_by_hand(t, e, w, z, beta), rel=1e-10)
    f = lambda b: efron_by_hand(t, e, w, z, b) - n * lam / 2 * b @ b
    assert model.penalized == pytest.approx(f(beta), rel=1e-10)
    for i in range(len(beta)):
        step = np.zeros(len(beta))
        step[i] = 1e-4
        assert (f(beta + step) - f(beta - step)) / 2e-4 == pytest.approx(0, abs=1e-3)
        assert f(beta + 100 * step) < f(beta) and f(beta - 100 * step) < f(beta)
    curvature = (f(beta + step) - 2 * f(beta) + f(beta - step)) / 1e-8
    inverse = np.linalg.inv(model.covariance * np.outer(model.scale, model.scale))
    assert -curvature == pytest.approx(inverse[-1, -1], rel=1e-3)


def test_concordance_is_exact_in_any_blocking(spark):
    rng = np.random.default_rng(11)
    n = 500
    t, e, s = rng.integers(1, 40, n).astype(float), rng.integers(0, 2, n), rng.integers(0, 30, n) / 7
    s[: n // 3] = 1.0  # a third of the rows share one score
    df = spark.createDataFrame([(float(a), int(b), float(c), 1) for a, b, c in zip(t, e, s)], "time double, event int, score double, w int")
    num = den = 0.0
    for i in np.flatnonzero(e == 1):
        ok = (t > t[i]) | ((t == t[i]) & (e == 0))
        den += ok.sum()
        num += (s[i] > s[ok]).sum() + 0.5 * (s[i] == s[ok]).sum()
    for rows in (10_000, 40):
        assert cox.concordance(df, block_rows=rows) == pytest.approx(num / den, rel=1e-12)


@pytest.mark.parametrize("a,b,d", [(10.0, 3.0, 20_000), (5.0, 5.0, 30_000), (1e3, 999.9, 50_000), (5.0, 5.0, 4096), (5.0, 5.0, 4097), (2.0, 1.0, 4100), (5.0, 4.9, 9000), (3.0, 3.0, 1)])
def test_efron_sums_with_many_ties(a, b, d):
    x = np.arange(d) / d
    f = a - b * x
    want = [np.log(f).sum(), (1 / f).sum(), (x / f).sum(), (1 / f**2).sum(), (x / f**2).sum(), ((x / f) ** 2).sum()]
    assert cox.efron_sums(a, b, d) == pytest.approx(want, rel=1e-10)


def test_cox_tables(spark, fitted):
    design, model, pdf = fitted
    hr = {r["covariate"]: r for r in cox.hazard_ratios(spark, model).collect()}
    for name, r in hr.items():
        assert r["hr_lower_95"] < r["hazard_ratio"] < r["hr_upper_95"]
        assert r["hazard_ratio"] == pytest.approx(math.exp(r["coef"]))
    h = cox.baseline_hazard(spark, model).toPandas()
    risk = np.exp((pdf[design.columns].to_numpy() - model.mean) @ model.coef) * pdf["w"].to_numpy()
    for _, row in h.sample(5, random_state=1).iterrows():
        d = pdf["w"][(pdf["time"] == row["time"]) & (pdf["event"] == 1)].sum()
        assert row["hazard"] == pytest.approx(d / risk[(pdf["time"] >= row["time"]).to_numpy()].sum())
    curve = cox.scenario_curves(spark, model, {"low": {"calls": 0.0}, "high": {"calls": 11.0}})
    assert all(r["monotone"] and r["in_range"] for r in curves.sanity(curve, ["scenario"]).collect())
    folder = work_dir(spark, "cox")
    cox.save_tables(spark, model, folder)
    again = cox.saved_curves(spark, folder, {"low": {"calls": 0.0}, "high": {"calls": 11.0}}, 60)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, curve.collect()))
    assert cox.ph_test(spark, model).count() == len(model.names)
    median = cox.reference_profile(design).first()
    assert median["calls"] == np.median(np.repeat(pdf["x0"].to_numpy(), pdf["w"].to_numpy()))


@pytest.mark.parametrize("partitions", [1, 3, 9])
def test_scan_over_any_partitions(spark, partitions):
    """Unrounded and heavily tied times over few and many partitions, some times in several of them: as one sum by hand."""
    from lagline.operators.risk_scan import RiskScan

    rng = np.random.default_rng(partitions)
    n = 240
    t = np.where(rng.random(n) < 0.5, rng.exponential(9, n), rng.choice([2.0, 5.0, 60.0], n, p=[0.2, 0.2, 0.6]))
    rows = [(float(a), int(a < 60 and rng.random() < 0.8), int(w), float(x), float(i)) for a, w, x, i in zip(t, rng.integers(1, 4, n), rng.normal(size=n), rng.integers(0, 2, n))]
    df = spark.createDataFrame(rows, "time double, event int, w int, x0 double, x1 double")
    df = df.repartitionByRange(partitions, "time", F.xxhash64("x0")).sortWithinPartitions("time")
    scan = RiskScan(df, ["x0", "x1"], 1)
    assert len(scan.shared) <= 2 * partitions and (partitions < 9 or 60.0 in scan.shared)
    t, e, w, x0, x1 = (np.array(c, float) for c in zip(*rows))
    mean, scale = np.array([0.3, 0.5]), np.array([1.2, 0.5])
    z = (np.stack([x0, x1], axis=1) - mean) / scale
    for beta in (np.zeros(2), np.array([0.4, -0.7])):
        v = scan.evaluate(beta, mean, scale)
        f = lambda b: efron_by_hand(t, e, w, z, b)
        assert v.likelihood == pytest.approx(f(beta), rel=1e-11) and v.events == w[e == 1].sum()
        steps = np.eye(2) * 1e-4
        for i in range(2):
            assert v.gradient[i] == pytest.approx((f(beta + steps[i]) - f(beta - steps[i])) / 2e-4, rel=1e-5)
            for j in range(2):
                mixed = f(beta + steps[i] + steps[j]) - f(beta + steps[i] - steps[j]) - f(beta - steps[i] + steps[j]) + f(beta - steps[i] - steps[j])
                assert v.hessian[i, j] == pytest.approx(mixed / 4e-8, rel=1e-3, abs=1e-2)
        table = {r["time"]: (r["hazard"], r["cumulative_hazard"]) for r in scan.hazards(v, beta, mean, scale, spark).collect()}
        r, total = w * np.exp(z @ beta), 0.0
        assert sorted(table) == sorted(set(t))
        for u in sorted(set(t)):
            h = w[(t == u) & (e == 1)].sum() / r[t >= u].sum()
            total += h
            assert table[u] == (pytest.approx(h, rel=1e-10), pytest.approx(total, rel=1e-10))
    scan.release()


def test_schoenfeld_sums_by_hand(spark, fitted):
    """Without ties the test equals the textbook one on individual events."""
    rng = np.random.default_rng(2)
    n = 120
    rows = [(float(t) / 2 + 0.5, 1, int(c), "k", 3) for t, c in zip(rng.permutation(n), rng.integers(0, 5, n))]
    df = spark.createDataFrame(rows, "response_minutes double, event_indicator int, calls int, kind string, hour int")
    design = cox.build_design(df, ["calls"], ["kind"])
    m = cox.fit(design, 0.0)
    pdf = design.rows.toPandas().sort_values("time")
    x, t, e = pdf["x0"].to_numpy(), pdf["time"].to_numpy(), pdf["event"].to_numpy()
    r = np.exp(x * m.coef[0])
    seen = e == 1
    resid = np.array([x[i] - (x * r)[t >= t[i]].sum() / r[t >= t[i]].sum() for i in np.flatnonzero(seen)])
    g = np.arange(1, seen.sum() + 1) - (seen.sum() + 1) / 2
    v, d = m.covariance[0, 0], seen.sum()
    want = (g @ (d * resid * v)) ** 2 / (d * v * (g @ g))
    assert cox.ph_test(spark, m).first()["test_statistic"] == pytest.approx(want, rel=1e-6)


def test_a_broken_design_raises(spark, monkeypatch):
    rows = spark.createDataFrame([(5.0, 1, 1, 0, "a"), (None, 1, 0, 1, "b"), (7.0, 2, 0, 0, "a")], "time double, event int, n1 int, n2 int, c string")
    monkeypatch.setattr(cox, "cox_rows", lambda *a, **k: rows)
    with pytest.raises(ValueError, match="null_duration.*event_not_binary"):
        cox.build_design(rows, ["n1", "n2"], ["c"])


def test_design_partitions_hold_a_bounded_number_of_rows(spark):
    df = cox_frame(spark)
    one = cox.build_design(df, ["calls"], ["kind", "time_bin"])
    many = cox.build_design(df, ["calls"], ["kind", "time_bin"], part_rows=20)
    rows = many.rows.count()
    sizes = many.kept.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert rows == one.rows.count() > 100 and sizes.max() <= 60 and len(sizes) >= rows / 60
    assert cox.fit(many, 0.1).coef == pytest.approx(cox.fit(one, 0.1).coef, abs=1e-9)


def test_a_step_holds_no_products_of_all_rows():
    """A task's memory is its rows as they are kept, and sums per time; results do not depend on where steps begin."""
    import tracemalloc

    from lagline.operators import risk_scan

    class Here:
        """Partitions in this process."""

        def __init__(self, items):
            self.items = items

        def map(self, f):
            return Here([f(x) for x in self.items])

        def flatMap(self, f):
            return Here([y for x in self.items for y in f(x)])

        def collect(self):
            return self.items

    rng = np.random.default_rng(1)
    n, p = 60_000, 20
    time = np.sort(rng.integers(1, 40, n)).astype(float)
    values = time, rng.integers(0, 2, n).astype(np.int8), rng.integers(1, 3, n).astype(float), rng.normal(size=(n, 2)), rng.integers(0, 2, (n, p - 2)).astype(np.uint8)
    cut = int(np.searchsorted(time, 20.0)) + 100  # in the middle of a time, which two partitions share
    beta, mean, scale = rng.normal(size=p) / 10, np.full(p, 0.5), np.full(p, 2.0)

    def value(ends):
        scan = risk_scan.RiskScan.__new__(risk_scan.RiskScan)
        scan.parts = Here([(i, risk_scan.Part(*[v[a:b] for v in values])) for i, (a, b) in enumerate(zip([0, *ends], [*ends, n]))])
        scan.shared = np.array([20.0] if ends else [])
        return scan.evaluate(beta, mean, scale)

    tracemalloc.start()
    one = value([])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < n * p * 8  # less than one copy of the standardised covariates
    two = value([cut])
    assert one.likelihood == pytest.approx(two.likelihood, rel=1e-10)
    np.testing.assert_allclose(one.gradient, two.gradient, rtol=1e-8, atol=1e-6)
    np.testing.assert_allclose(one.hessian, two.hessian, rtol=1e-8, atol=1e-6)


def test_long_design_rows_are_not_shuffled(spark):
    """The kept indicators are broadcast, whatever the optimizer thinks of their size, and the rows are read back from a table."""
    rows = spark.range(2000).selectExpr("'a' AS city", "id", "CAST(id % 3 AS string) AS kind", "CAST(id % 2 AS string) AS side")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        long = cox.design_long(rows, ["city"], "id", ["kind", "side"])
        plan = long._jdf.queryExecution().executedPlan().toString()
        got = {r[0]: r[1] for r in long.groupBy("covariate").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [x for x in plan.splitlines() if "JoinExec" in x or "Join " in x]
    assert any("BroadcastHashJoin" in x and "column_name" in x for x in joins[:1])
    assert got == {"kind_1": 667, "kind_2": 666, "side_1": 1000}
