import random
import re
import zlib
from collections import Counter

import pytest

from lagline.llm.spelling_variants import grouped, variants, vocabulary


def plain_words(texts):
    """Occurrences by the contract's rule, from (key, text)."""
    found = Counter()
    for key, text in texts:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words):
    out = {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        out[w] = [best if best and words[best] >= 10 * n else None, w, n, len(others)]
    for w, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {(w, form, root, n, k, words[form] if form else None) for w, (form, root, n, k) in out.items()}


def rows_of(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("shard", [100_000, 40])
def test_vocabulary_against_all_pairs(spark, shard):
    """Few letters and so crowded halves; with small shards most halves are split into parts and blocks."""
    rng = random.Random(shard)
    words = {"".join(rng.choices("abé", k=rng.randrange(7, 10))): int(10 ** rng.uniform(0.4, 4)) for _ in range(500)}
    words |= {"chained": 1, "chainec": 20, "chainee": 300, "chainer": 4000, "tiedone": 2, "tiedona": 40, "tiedonb": 40}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = grouped(df, shard=shard)
    assert rows_of(got) == plain(words) and got.count() == len(words)


def test_documents(make_docs):
    rng = random.Random(1)
    base = ["beginning", "Éclairage", "wonderful", "spelling", "grouping", "naïveté×÷", "Straße", "short"]
    texts = []
    for i in range(300):
        line = []
        for _ in range(rng.randrange(0, 40)):
            w = rng.choice(base)
            if rng.random() < 0.1:
                j = rng.randrange(len(w))
                w = rng.choice([w[:j] + w[j + 1 :], w[:j] + "x" + w[j:], w[:j] + "z" + w[j + 1 :], w.upper()])
            line.append(w)
        texts.append((rng.choice([None, i, 7]), rng.choice([" ", "-", "1"]).join(line)))
    texts.append((5, None))
    docs = make_docs(texts)
    words = plain_words(texts)
    assert {(r.word, r.n) for r in vocabulary(docs).collect()} == set(words.items())
    assert rows_of(variants(docs)) == plain(words) and any(r[1] for r in plain(words))


def test_odd_rows(odd_docs, no_docs, make_docs):
    assert variants(no_docs).count() == 0
    assert variants(make_docs([None, "", "a b c", "once upon"])).count() == 0
    got = rows_of(variants(odd_docs))
    texts = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert got == plain(plain_words(texts))
    long_ = "x" * 100_000
    assert {r[0] for r in rows_of(variants(make_docs([long_ + " " + long_])))} == set(plain_words([(0, long_ + " " + long_)]))
