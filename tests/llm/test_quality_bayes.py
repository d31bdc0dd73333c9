import math
from collections import defaultdict

import pytest

from lagline.llm.quality_bayes import Evidence, _strength, fit, judged


@pytest.fixture(scope="module")
def found(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return judged(docs, labels).join(labels, "doc_id").collect()


def test_agrees_with_labels(found):
    clean = [r for r in found if r.quality and not r.toxic]
    junk = [r for r in found if not r.quality]
    toxic = [r for r in found if r.toxic]
    assert sum(r.keep for r in clean) >= 0.99 * len(clean)
    assert sum(not r.keep for r in junk) >= 0.95 * len(junk)
    assert sum(not r.keep for r in toxic) >= 0.7 * len(toxic)  # 51 toxic texts to learn from
    assert all(0 <= r.quality_rate <= 1 and 0 <= r.toxic_prob <= 1 for r in found)


def test_shrinkage():
    assert _strength(0.5, 1e-9) > 1e5 and _strength(0.5, 0.05) == pytest.approx(4) and _strength(0.0, 0.1) == 1 and _strength(0.3, None) == 1


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(3, 1, 0), (7, 0, 1), (None, 1, 1), (8, None, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    got = judged(odd_docs, labels)
    assert got.count() == 11 and set(odd_docs.columns) - {"keep"} <= set(got.columns) and dict(got.dtypes)["keep"] == "boolean"
    assert judged(odd_docs, labels.limit(0)).where("keep").count() == 11
    assert judged(no_docs, labels).count() == 0


def test_plain_rates_and_posteriors(spark):
    """Site rates, their shrinkage and the posteriors, in plain Python from the evidence of the same classifier."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels)
    rows = docs.select("doc_id", "text", "source", "lang").collect()
    logit = lambda p: math.log(max(p, 1e-6) / max(1 - p, 1e-6))
    sites, want = [], {}
    for r in rows:
        source = r.source or ""
        host, _, rest = source.split("://", 1)[-1].partition("/")
        sites.append((host if r.source is not None else "", f"{rest.split('/')[0].split('?')[0].split('#')[0]}/{r.lang or ''}"))
    evidence = model.log_odds([r.text or "" for r in rows])
    for name in ("quality", "toxic"):
        prior = math.log(model.rates[name] / (1 - model.rates[name]))
        chance = [1 / (1 + math.exp(-(e + prior))) for e in evidence[name]]
        hosts, paths = defaultdict(lambda: [0.0, 0]), defaultdict(lambda: [0.0, 0])
        for (host, path), p in zip(sites, chance):
            for group in (hosts[host], paths[host, path]):
                group[0] += p
                group[1] += 1
        mean = sum(chance) / len(chance)

        def between(groups, level):
            parts = [(n, (hits / n - level(key)) ** 2 - level(key) * (1 - level(key)) / n) for key, (hits, n) in groups.items()]
            return sum(n * v for n, v in parts) / sum(n for n, _ in parts)

        k = _strength(mean, between(hosts, lambda _: mean))
        host_rate = {h: (hits + k * mean) / (n + k) for h, (hits, n) in hosts.items()}
        k = _strength(mean, between(paths, lambda key: host_rate[key[0]]))
        rate = {key: (hits + k * host_rate[key[0]]) / (n + k) for key, (hits, n) in paths.items()}
        for r, site, e in zip(rows, sites, evidence[name]):
            want[r.doc_id, name] = (rate[site], 1 / (1 + math.exp(-(e + logit(rate[site])))))
    got = judged(docs, labels, keep_columns=["doc_id"])
    assert got.columns == ["doc_id", "quality_prob", "toxic_prob", "quality_rate", "toxic_rate", "keep"]
    for r in got.collect():
        for name in ("quality", "toxic"):
            assert (r[f"{name}_rate"], r[f"{name}_prob"]) == pytest.approx(want[r.doc_id, name], rel=1e-6, abs=1e-9)
        assert r.keep == (want[r.doc_id, "quality"][1] >= 0.5 and want[r.doc_id, "toxic"][1] < 0.5)


def test_evidence_without_labels():
    assert Evidence().log_odds(["x", ""])["toxic"].tolist() == [0, 0]
