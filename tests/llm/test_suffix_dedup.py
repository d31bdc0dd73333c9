import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lagline.llm.suffix_dedup import anchors, permuted_prefixes, repeated_begins, suffix_array, without_repeats


def plain(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raws for i in range(len(b) - length + 1))
    out = []
    for b in raws:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(200):
        k = rng.choice([1, 2, 3, 26, 250])
        t = [rng.randrange(k) for _ in range(rng.choice([1, 2, 3, 7, 40, 300]))] * rng.choice([1, 1, 3])
        text = np.array(t, np.uint16) + 1
        order = suffix_array(text, 257)
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        shared = permuted_prefixes(text, order, np.arange(len(t), 0, -1))
        for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
            n = 0
            while b + n < len(t) and a + n < len(t) and t[a + n] == t[b + n]:
                n += 1
            assert shared[b] == n


def test_every_string_has_its_anchor():
    raw = np.random.default_rng(2).integers(97, 100, 3000).astype(np.uint8)
    _, at, lo, hi = anchors(raw, 40, 8)
    assert lo[0] == 0 and hi[-1] == len(raw) - 40 and (lo[1:] == hi[:-1] + 1).all()
    assert (at >= hi).all() and (at + 8 <= lo + 40).all()
    assert anchors(raw[:39], 40, 8)[0].size == 0


@pytest.mark.parametrize("group", [256, 2])
def test_matches_plain_search(make_docs, group):
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdé ", k=150))
    noise = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    texts = [noise(rng.randrange(0, 150)) + passage[rng.randrange(40) : rng.randrange(90, 151)] + noise(rng.randrange(0, 90)) for _ in range(60)]
    texts += ["xy" * 120, "z" * 300, "z" * 61, None, "", texts[0], texts[0], passage, passage[:60], passage[:59], noise(400) * 2]
    want = plain(texts, 60)
    got = without_repeats(make_docs(texts), length=60, group=group, shard_bytes=3000).orderBy("doc_id").collect()
    assert [(*tuple(r)[1:5], bytes(r.kept)) for r in got] == want
    assert sum(w[1] > 0 for w in want) > 30


def test_strings_of_one_length(make_docs):
    # a string of exactly the length, and one byte less
    a, b = "".join(chr(97 + i * i % 23) for i in range(400)), "q"
    texts = [f"1{a}{b}", f"2{a}", f"3{a[1:]}4"]
    got = without_repeats(make_docs(texts)).orderBy("doc_id").collect()
    assert [r.n_removed for r in got] == [w[1] for w in plain(texts, 400)] and got[2].n_removed in (0, 399)


def test_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    got = without_repeats(odd_docs).collect()
    want = plain([r.text for r in rows], 400) if len(rows) < 5 else None
    assert want is None and len(got) == 11
    by = {(r.doc_id, r.n_bytes): r for r in got}
    assert by[(0, 0)].n_removed == 0 and by[(3, 14)].n_removed == 0
    assert all(r.n_removed > 0.99 * r.n_bytes for r in got if r.n_bytes > 10_000)
    assert without_repeats(no_docs).count() == 0
