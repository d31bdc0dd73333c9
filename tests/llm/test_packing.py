import random
import zlib

import numpy as np
import pytest

from lagline.llm.packing import Plan, packed_documents, pieces_of, tokenizer_path


def plain_ids(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    return [e.ids + [1] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, texts, capacity):
    """rows: (doc_id, piece, start, length, ids_crc32, sequence_id, offset); the number of sequences comes back."""
    ids = plain_ids(texts)
    per_doc, per_sequence = {}, {}
    for doc, piece, start, length, crc, sequence, offset in rows:
        own = ids[doc][start : start + length]
        assert len(own) == length and zlib.crc32(np.array(own, "<u4").tobytes()) == crc
        per_doc.setdefault(doc, []).append((piece, start, length))
        per_sequence.setdefault(sequence, []).append((offset, length))
    for doc, pieces in per_doc.items():
        assert [p for p, _, _ in sorted(pieces)] == list(range(len(pieces)))
        assert all(start == piece * capacity for piece, start, _ in pieces) and sum(n for _, _, n in pieces) == len(ids[doc])
        assert all(n == capacity for _, _, n in sorted(pieces)[:-1])
    for places in per_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(per_doc) == len(texts)
    return len(per_sequence), -(-sum(map(len, ids)) // capacity)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id")
    texts = [r.text for r in docs.collect()]
    used, bound = check([tuple(r) for r in packed_documents(docs).collect()], texts, 4096)
    assert used <= bound + 1


def test_texts_that_tokenizers_find_hard(make_docs):
    texts = ["", None, "it's  we'll\tI'd\nx", "é ́ x y z", "<|endoftext|> a<|startoftext|>b", "ΑΣ ΟΔΟΣ\u0085İ", "日本語 テスト 123", "\x0b\x0c\x1c\x1f a", "a" * 500, "ﬁ Å", "A,b.C'd 'LL x''s =\u0338 a\u0301! …!¿x «y» I\u0307z\u212a", "(1+2)=3;x_y-z\u00a0!a", "\u0301a \u0308, '", "</w> don't,stop \u2019s"]
    used, bound = check([tuple(r) for r in packed_documents(make_docs(texts), capacity=64).collect()], texts, 64)
    assert used <= bound + 2


def test_pieces_hold_the_ids(make_docs):
    texts = ["one two three " * 50, None]
    got = {(r.doc_id, r.piece): r.ids for r in pieces_of(make_docs(texts), tokenizer_path(), capacity=32).collect()}
    want = plain_ids(texts)
    assert [x for k in sorted(k for k in got if k[0] == 0) for x in got[k]] == want[0] and got[(1, 0)] == [1]


@pytest.mark.parametrize("seed", range(12))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 100, 1000])
    counts = {rng.randrange(1, capacity + 1): rng.choice([1, 3, 50, 10**6]) for _ in range(rng.randrange(1, 60))}
    plan = Plan(counts, capacity, rng.choice([1, 4, 32]))
    assert plan.used == counts
    runs, borders = {}, set()
    for length, first, n, sequence, each, offset in plan.rows:
        assert n > 0 and each > 0
        borders |= {sequence, sequence + n // each, sequence + -(-n // each)}
    cuts = sorted(borders | {0, plan.sequences})
    fill = dict.fromkeys(cuts[:-1], 0)
    by = {}
    for length, first, n, sequence, each, offset in plan.rows:
        by.setdefault(length, []).append((first, n))
        for at in cuts[:-1]:  # sequences between two borders are alike
            here = min(each, max(0, n - (at - sequence) * each)) if at >= sequence else 0
            if here:
                runs.setdefault(at, []).append((offset, here * length))
    for at, parts in runs.items():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= capacity
        fill[at] = end
    for length, parts in by.items():
        end = 0
        for first, n in sorted(parts):
            assert first == end
            end += n
        assert end == counts[length]
    total = sum(k * n for k, n in counts.items())
    assert plan.sequences * capacity >= total and len(plan.rows) < 20_000


def test_odd_rows(odd_docs, no_docs):
    got = packed_documents(odd_docs)
    assert got.where("length = 1").count() >= 3 and got.select("doc_id").distinct().count() == 9
    assert packed_documents(no_docs).count() == 0
