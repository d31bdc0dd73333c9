from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from lagline.operators import attribution, boosting, encoding, quantile


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 4000
    city = rng.choice(["a", "b"], n)
    u, v, w = rng.normal(size=n), rng.integers(0, 30, n).astype(float), rng.random(n)
    area = rng.integers(0, 200, n)
    lean = rng.normal(0, 1, 200)
    p = 1 / (1 + np.exp(-(u + (v > 20) * 1.5 * (city == "a") + lean[area] - 0.5)))
    y = (rng.random(n) < p).astype(int)
    minutes = np.round(1 + rng.exponential(3 + 4 * (v > 15) + 2 * np.abs(u)), 3)
    data = [(str(i), str(c), float(a), float(b) if k % 50 else None, float(e), str(s), int(t), float(m))
            for i, (c, a, b, e, s, t, m, k) in enumerate(zip(city, u, v, w, area, y, minutes, range(n)))]
    return spark.createDataFrame(data, "id string, city string, u double, v double, w double, area string, y int, minutes double").persist()


NAMES = ["u", "v", "w"]


def plain_codes(x, cuts):
    return np.array([0 if np.isnan(a) else 1 + int((cuts < a).sum()) for a in x])


def test_first_tree_is_the_exact_greedy_one(rows):
    """The first split of the first tree, by trying every feature and bin, and the Newton step of every leaf."""
    model = boosting.fit(rows, ["city"], NAMES, "y", [boosting.Logistic()], trees=1, depth=2, rate=1.0)
    assert model.groups == [("a",), ("b",)]
    for g, (city,) in enumerate(model.groups):
        own = rows.where(F.col("city") == city).toPandas()
        x = np.stack([plain_codes(own[n].to_numpy(), model.cuts[g][j]) for j, n in enumerate(NAMES)], axis=1)
        assert (model.codes(g, own[NAMES].to_numpy(dtype=float)) == x).all()
        y = own["y"].to_numpy()
        p = y.mean()
        grad, curve = p - y, np.full(len(y), p * (1 - p))
        score = lambda m: grad[m].sum() ** 2 / (curve[m].sum() + boosting.RIDGE)
        tree = model.trees[g][0][0]

        def best(mask):
            found = []
            for j in range(3):
                for cut in range(boosting.BINS):
                    left, right = mask & (x[:, j] <= cut), mask & (x[:, j] > cut)
                    if min(left.sum(), right.sum()) >= boosting.LEAST:
                        found.append((score(left) + score(right) - score(mask), j, cut))
            return max(found, key=lambda f: f[0])

        everything = np.ones(len(y), bool)
        gain, j, cut = best(everything)
        assert (tree.feature[1], tree.cut[1]) == (j, cut) and tree.cover[1] == len(y)
        nodes = tree.nodes(x)
        for node in np.unique(nodes):
            m = nodes == node
            assert tree.value[node] == pytest.approx(-grad[m].sum() / (curve[m].sum() + boosting.RIDGE)) and tree.cover[node] == m.sum()
        left = everything & (x[:, j] <= cut)
        assert tree.feature[2] == best(left)[1] and tree.cut[2] == best(left)[2]


def test_groups_do_not_mix_and_partitions_do_not_matter(rows):
    both = boosting.fit(rows.repartition(7), ["city"], NAMES, "y", [boosting.Logistic()], trees=7, depth=3)
    alone = boosting.fit(rows.where("city = 'b'").repartition(2), ["city"], NAMES, "y", [boosting.Logistic()], trees=7, depth=3)
    x = rows.where("city = 'b'").toPandas()[NAMES].to_numpy(dtype=float)
    assert np.allclose(both.margins(1, both.codes(1, x)), alone.margins(0, alone.codes(0, x)), atol=1e-9)


def test_boosting_learns(rows):
    model = boosting.fit(rows, ["city"], NAMES, "y", [boosting.Logistic()], trees=15, depth=3)
    scored = boosting.predict(model, rows.withColumn("extra", F.lit(1)), ["city"], ["margin"])
    loss = F.avg(F.log1p(F.exp(F.when(F.col("y") == 1, -F.col("margin")).otherwise(F.col("margin")))))
    base = rows.groupBy("city").agg(F.avg("y").alias("p")).collect()
    got = {r.city: r.l for r in scored.groupBy("city").agg(loss.alias("l")).collect()}
    assert all(got[r.city] < -(r.p * np.log(r.p) + (1 - r.p) * np.log(1 - r.p)) - 0.02 for r in base)
    lost = boosting.predict(model, rows.withColumn("city", F.lit("nowhere")), ["city"], ["margin"])
    assert lost.where("margin IS NOT NULL").count() == 0


def test_quantiles_beat_the_forest(rows):
    """Held-out pinball loss of boosted quantiles is not above that of a quantile forest; predictions do not cross."""
    train, test = rows.where("conv(id, 10, 10) % 5 > 0"), rows.where("conv(id, 10, 10) % 5 = 0")
    forest = quantile.fit_quantile_forest(train.fillna(-1), [], NAMES, "minutes", trees=20, depth=6)
    by_forest = quantile.predict_quantiles(forest, test.fillna(-1)).persist()
    boosted = quantile.boosted_quantiles(train, test, [], [], NAMES, "minutes", ["id"]).persist()
    assert boosted.where("pred_p90 > pred_p95 OR pred_p90 IS NULL").count() == 0 and boosted.count() == test.count()
    for q in quantile.QUANTILES:
        loss = lambda df: df.agg(quantile.pinball("minutes", f"pred_p{round(q * 100)}", q)).first()[0]  # noqa: E731,B023
        assert loss(boosted) <= loss(by_forest) * 1.005


def test_summaries():
    rng = np.random.default_rng(0)
    parts = [rng.exponential(size=n) for n in (10, 5000, 20_000)]
    whole = {}
    for x in parts:
        x = np.sort(x)
        boosting.merged(whole, {"k": boosting.compressed(x, np.ones(len(x)))})
    every = np.sort(np.concatenate(parts))
    for q in (0.5, 0.9, 0.99):
        at = np.searchsorted(every, boosting.summary_quantile(whole["k"], q)) / len(every)
        assert abs(at - q) < 0.003
    assert boosting.summary_quantile((np.array([1.0, 2.0, 3.0]), np.ones(3)), 0.5) == 2.0


def expected(tree, node, x, known):
    """Expected value of a tree when only the features in `known` are seen: the textbook recursion."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    children = (2 * node, 2 * node + 1)
    if f in known:
        return expected(tree, children[int(x[f] > tree.cut[node])], x, known)
    return sum(tree.cover[c] * expected(tree, c, x, known) for c in children) / tree.cover[node]


def test_attributions_are_shapley_values(rows):
    model = boosting.fit(rows, ["city"], NAMES, "y", [boosting.Logistic()], trees=4, depth=4)
    explainer = attribution.BoostedExplainer.of(model)
    some = rows.where("conv(id, 10, 10) < 12")
    got = attribution.attribute_margin(explainer, some, ["city"], ["id", "city", *NAMES], ["one", "two", "three"]).collect()
    assert len(got) == 12
    for r in got:
        g = model.groups.index((r.city,))
        x = model.codes(g, np.array([[np.nan if r[n] is None else r[n] for n in NAMES]], float))[0]
        value = lambda s: model.start[g, 0] + sum(expected(t, 1, x, s) for t in model.trees[g][0])  # noqa: E731,B023
        for f, name in enumerate(["one", "two", "three"]):
            others = [i for i in range(3) if i != f]
            phi = sum(
                factorial(k) * factorial(2 - k) / factorial(3) * (value({*s, f}) - value(set(s))) for k in range(3) for s in combinations(others, k)
            )
            assert r[f"phi_{name}"] == pytest.approx(phi, abs=1e-9)
        assert r.base_value == pytest.approx(value(set()), abs=1e-9) and r.margin == pytest.approx(value({0, 1, 2}), abs=1e-9)
        assert r.base_value + r.phi_one + r.phi_two + r.phi_three == pytest.approx(r.margin, abs=1e-9)
    case = attribution.riskiest_case(attribution.attribute_margin(explainer, some, ["city"], ["id"], NAMES), NAMES, ["id"]).collect()
    assert case[0].probability == pytest.approx(max(r.probability for r in got)) and len(case) == 3


def test_deep_paths(rows):
    """Depth 12 with many features on a path: the parts still add up, in time that does not double with each level."""
    wide = rows.select("id", "y", *[F.expr(f"hash(id, {i}) % 100 + y * {i % 3}").cast("double").alias(f"f{i}") for i in range(14)])
    names = [f"f{i}" for i in range(14)]
    model = boosting.fit(wide, [], names, "y", [boosting.Logistic(least=2)], trees=2, depth=12)
    explainer = attribution.BoostedExplainer.of(model)
    assert max(len(leaf[1]) for tree in explainer.leaves[0] for leaf in tree) >= 8
    got = attribution.attribute_margin(explainer, wide, [], ["id"], names)
    total = sum((F.col(f"phi_{n}") for n in names), F.col("base_value"))
    assert got.agg(F.max(F.abs(total - F.col("margin")))).first()[0] < 1e-9 and got.count() == wide.count()


def test_path_parts_against_patterns():
    rng = np.random.default_rng(1)
    for m in (1, 2, 5, 7):
        zeros, ones = rng.uniform(0.01, 1, m), rng.integers(0, 2, (6, m)).astype(float)
        got = attribution.path_parts(2.5, zeros, ones)
        for r, o in enumerate(ones):
            for i in range(m):
                others = [j for j in range(m) if j != i]
                product = lambda s: np.prod([o[j] if j in s else zeros[j] for j in others])  # noqa: E731,B023
                total = sum(factorial(k) * factorial(m - 1 - k) / factorial(m) * product(set(s)) for k in range(m) for s in combinations(others, k))
                assert got[r, i] == pytest.approx(2.5 * (o[i] - zeros[i]) * total, abs=1e-12)


def test_encoding(rows):
    """Level means in plain Python: training rows without their own fold, others with all; unknown and missing levels."""
    from collections import defaultdict

    train = rows.where("conv(id, 10, 10) % 5 > 0").withColumn("area", F.expr("CASE WHEN area = '3' THEN NULL ELSE area END"))
    means = encoding.level_means(train, ["city"], ["area", "w"], "y", ["id"])
    fold = F.pmod(F.xxhash64("id"), F.lit(encoding.FOLDS)).alias("fold")
    sums, city = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    data = train.select("id", "city", "area", "y", fold).collect()
    for r in data:
        for key in ((r.city, r.area), (r.city, r.area, r.fold)):
            sums[key][0] += r.y
            sums[key][1] += 1
        city[r.city][0] += r.y
        city[r.city][1] += 1
    got = encoding.encoded(train.withColumn("t", F.lit(True)), means, ["city"], ["area"], ["id"], "t").collect()
    whole = encoding.encoded(train, means, ["city"], ["area"], ["id"]).collect()
    folds = {r.id: r.fold for r in data}
    k = encoding.SMOOTHING
    assert len(got) == len(data) == len(whole)
    for found, own in ((got, True), (whole, False)):
        for r in found:
            s, n = sums[r.city, r.area]
            if own:
                s, n = s - sums[r.city, r.area, folds[r.id]][0], n - sums[r.city, r.area, folds[r.id]][1]
            assert r.enc_area == pytest.approx((s + k * city[r.city][0] / city[r.city][1]) / (n + k))
    lost = encoding.encoded(train.limit(3).withColumn("area", F.lit("new")), means, ["city"], ["area"], ["id"])
    assert [r.enc_area for r in lost.collect()] == [None] * 3


def test_each_column_of_means_is_joined_by_its_own_size(rows):
    """Means of a column with few levels are broadcast beside a column of many levels, which is not."""
    spark = rows.sparkSession
    train = rows.withColumn("kind", F.expr("CAST(CAST(id AS INT) % 4 AS STRING)"))
    means = encoding.known_means(train, ["city"], ["id", "kind"], "y", ["id"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        found = encoding.encoded(train, means, ["city"], ["id", "kind"], ["id"])
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
        joint = encoding.encoded(train, encoding.level_means(train, ["city"], ["id", "kind"], "y", ["id"]), ["city"], ["id", "kind"], ["id"])
        shown = ["id", *[F.round(f"enc_{c}", 9) for c in ("id", "kind")]]
        assert found.select(*shown).exceptAll(joint.select(*shown)).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cut_points_are_the_columns_own_quantiles(rows):
    """Also with no rows; every column of a group is a key of its own, so that tasks share the summaries."""
    got = boosting.cut_points(rows, ["city"], NAMES, [0.9], "minutes", bins=8)
    shares = [i / 8 for i in range(1, 8)]
    plain = rows.groupBy("city").agg(
        *[F.percentile_approx(n, shares, 10_000).alias(n) for n in NAMES], F.avg("minutes").alias("mean"), F.percentile_approx("minutes", 0.9, 10_000).alias("q")
    ).orderBy("city").collect()
    assert [r["city"] for r in got] == ["a", "b"] and boosting.cut_points(rows.where("false"), ["city"], NAMES, [], "minutes") == []
    for r, p in zip(got, plain):
        assert [r[f"c{i}"] for i in range(3)] == [p[n] for n in NAMES] and r["mean"] == pytest.approx(p["mean"]) and r["q"] == [p["q"]]


def test_rows_of_short_paths_are_attributed_without_sorting_them(monkeypatch):
    """A leaf's patterns are all worked out, rows only look theirs up; the parts are those of every row worked out by itself."""
    rng = np.random.default_rng(3)
    tree = boosting.Tree.empty(3)
    for node in range(1, 8):
        tree.feature[node], tree.cut[node], tree.cover[node] = node % 3, 4 + node, 64 >> (node.bit_length() - 1)
    tree.cover[8:], tree.value[8:] = [5, 11, 3, 13, 7, 9, 2, 14], rng.normal(size=8)
    model = boosting.Ensemble(["a", "b", "c"], [()], [boosting.Logistic()], [[np.arange(20.0)] * 3], np.zeros((1, 1)), [[[tree]]])
    explainer = attribution.BoostedExplainer.of(model)
    codes = rng.integers(0, 21, (500, 3)).astype(np.uint8)
    expected = np.zeros(codes.shape)
    for value, features, low, high, zeros in explainer.leaves[0][0]:
        own = codes[:, features].astype(int)
        expected[:, features] += attribution.path_parts(value, zeros, ((own > low) & (own <= high)).astype(float))

    def refuse(*_, **__):
        raise AssertionError("rows are sorted")

    monkeypatch.setattr(attribution.np, "unique", refuse)
    np.testing.assert_allclose(explainer.contributions(0, codes), expected, atol=1e-12)


def test_few_rounds_write_no_blocks(rows, monkeypatch):
    """Blocks are checkpointed where many rounds are to come, not shortly before the last."""
    saved = []
    monkeypatch.setattr(RDD, "checkpoint", lambda self: saved.append(self))
    model = boosting.fit(rows, ["city"], NAMES, "minutes", [boosting.Pinball(0.9)], trees=12, depth=2)
    assert len(model.trees[0][0]) == 12 and not saved
