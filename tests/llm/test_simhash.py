import random

import numpy as np
import pytest
import xxhash

from lagline.llm.simhash import anchor_masks, components, fingerprint_of, forest, near_duplicates, close_pairs, representatives


def slow_fingerprint(text):
    w = text.encode().lower().split()
    grams = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(values, links):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {v: find(v) for v in values}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_anchors_cover():
    masks = anchor_masks()
    assert [len(m) for m in masks] == [2] + [17] * 31
    rng = random.Random(1)
    syndrome = lambda w: int(np.bitwise_xor.reduce([i for i in range(1, 32) if w >> (i - 1) & 1] or [0]))
    for _ in range(300):
        f = rng.getrandbits(32)
        g = f
        for b in rng.sample(range(32), rng.randrange(3)):
            g ^= 1 << b
        own = {f ^ m for m in masks[syndrome(f)]}
        assert all(syndrome(a) == 0 and (a ^ f).bit_count() <= 2 for a in own)
        assert own & {g ^ m for m in masks[syndrome(g)]}


@pytest.mark.parametrize("crowd,block", [(16, 1024), (1, 4), (10**6, 1024)])
def test_links_reach_the_same(spark, crowd, block):
    rng = random.Random(2)
    values = {0, (1 << 64) - 1}
    for _ in range(25):
        f = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 12])):
            values.add(f)
            for b in rng.sample(range(64), rng.choice([1, 3, 4, 5])):
                f ^= 1 << b
    values = sorted(values)
    prints = spark.createDataFrame([(signed(v),) for v in values], "_fp long")
    links = [(r.u, r.v) for r in close_pairs(prints, crowd, block).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in links)
    all_pairs = [(signed(a), signed(b)) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 4]
    own = [signed(v) for v in values]
    assert roots_of(own, links) == roots_of(own, all_pairs)


def test_forest_and_components(spark):
    prints = np.array([0, 0b1111, 0b11111111, 31 << 56, (31 << 56) | 3, 0xFFFF << 20], np.uint64)
    assert len(forest(prints)) == 3 and len(forest(prints[:0])) == 0
    chain = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 500), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 400: 400, 500: 400}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_documents_match_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    prints = [slow_fingerprint(r.text) for r in rows]
    assert prints == [fingerprint_of(r.text) for r in rows]
    ids = [r.doc_id for r in rows]
    links = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = roots_of(ids, links)
    got = near_duplicates(docs).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{f:016x}" for i, f in zip(ids, prints)}
    assert {r.doc_id: r.component_id for r in got} == want
    assert sorted(r.doc_id for r in representatives(docs).collect()) == sorted(set(want.values()))


def test_odd_rows(odd_docs, no_docs):
    got = near_duplicates(odd_docs).collect()
    assert len(got) == 11
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert len(zero) == 3 and {r.component_id for r in zero} == {0}
    assert {r.component_id for r in got if r.doc_id == 3} == {3}
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert near_duplicates(no_docs).count() == 0
    kept = representatives(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["0", "3", "None", *sorted({str(r.component_id) for r in got} - {"0", "3", "None"})])
    assert representatives(no_docs).count() == 0
