import hashlib
import random
import re

from lagline.llm.phrase_index import build_index, contamination, find_phrases

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def plain(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, names = set(), set()
        for item, body in items:
            b = words(body)
            for i in range(max(1, len(b) - window + 1) if b else 0):
                p = b[i : i + window]
                for at in range(len(w) - len(p) + 1):
                    if w[at : at + len(p)] == p:
                        hit |= set(range(at, at + len(p)))
                        names.add(str(item))
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_matches_plain_search(spark, make_docs):
    rng = random.Random(3)
    vocabulary = ["the", "of", "a", "Bé", "x1", "rare", "and", "UP"]
    texts = ["".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n"]) for _ in range(rng.randrange(0, 60))) for _ in range(120)]
    texts += [None, "", "...", texts[0], texts[0]]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 10, 12, 25])))) for i in range(40)]
    items += [(40, texts[5]), (41, None), (7, texts[6]), (40, texts[5])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = list(enumerate(texts))
    want = plain(rows, items, 4)
    for options in ({}, {"block_words": 60}):
        got = contamination(make_docs(rows), bench, window=4, **options).drop("n_near")
        assert sorted(map(tuple, got.collect()), key=repr) == want
    index = build_index(make_docs(rows), shard_bytes=300)
    assert index.select("shard").distinct().count() > 5
    hits = {r.doc_id: len({p for h in r.hits for p in range(h.start, h.end)}) for r in find_phrases(index, bench, 4).collect()}
    assert hits == {r[0]: r[2] for r in want}


def test_proximity(spark, make_docs):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    filler = " ".join(f"w{i}" for i in range(200))
    docs = make_docs([f"gamma x beta y alpha delta {filler}", f"alpha {filler} beta gamma delta", "nothing"])
    got = {r.doc_id: (r.contaminated, r.n_near) for r in contamination(docs, bench).collect()}
    assert got == {0: (False, 1), 1: (False, 0), 2: (False, 0)}


def test_proximity_ends_with_the_document_and_skips_unknown_words(spark, make_docs):
    rows = [(1, "alpha beta gamma nowhere"), (2, "alpha nowhere never"), (3, "delta"), (4, "nowhere")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    docs = make_docs(["x alpha beta", "gamma y delta", "gamma z z beta z alpha", "alpha alpha"])
    assert {r.doc_id: r.n_near for r in contamination(docs, bench).collect()} == {0: 0, 1: 1, 2: 1, 3: 0}


def test_proximity_matches_plain_search(spark, make_docs):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary[:50]) for _ in range(rng.randrange(0, 90))) for _ in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 9])))) for i in range(50)]
    often = {}
    for text in texts:
        for w in words(text):
            often[w] = often.get(w, 0) + 1
    want = {}
    for i, text in enumerate(texts):
        places, want[i] = words(text), 0
        for _, body in items:
            own = set(words(body))
            rare = sorted((w for w in own if w in often), key=lambda w: (often[w], w))[:3]
            spots = [p for p, w in enumerate(places) if rare and w == rare[0]]
            near = any(all(w in places[max(0, p - 6) : p + 7] for w in rare) for p in spots)
            want[i] += len(rare) >= min(3, len(own)) and near
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(make_docs(texts), bench, near_span=6)
    assert {r.doc_id: r.n_near for r in got.collect()} == want


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "two three"), (None, "five"), (2, None)], "item_id long, text string")
    got = contamination(odd_docs, bench).collect()
    assert len(got) == 11 and sorted(str(r.doc_id) for r in got if r.contaminated) == ["3", "3", "3", "None"]
    assert contamination(no_docs, bench).count() == 0
    assert not any(r.contaminated for r in contamination(odd_docs, bench.limit(0)).collect())
