"""The stages, each on its own input, against plain versions of what they decide."""

import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from lagline.llm.simhash import fingerprint_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs.columns, docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "stage")
        out.append((name, docs.columns, docs.collect()))
    return out


def test_columns_and_order(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(columns == ["doc_id", "text", "lang", "source", "n_chars"] for _, columns, _ in stages[:5])


def test_quality_keeps_clean_documents(spark, stages):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1][2]}
    clean = [i for i, r in labels.items() if r.quality and not r.toxic]
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)
    assert sum(i in kept for i, r in labels.items() if not r.quality) <= 3


def test_one_of_each_group_stays(stages):
    rows = sorted(stages[1][2], key=lambda r: r.doc_id)
    prints = [fingerprint_of(r.text) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    assert {r.doc_id for r in stages[2][2]} == {rows[x].doc_id for x in root}


def test_decontamination(spark, stages):
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().lower())
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    dirty = lambda t: any(tuple(w[i : i + 10]) in windows for w in [words(t)] for i in range(len(w)))
    assert {r.doc_id for r in stages[3][2]} == {r.doc_id for r in stages[2][2] if not dirty(r.text)}


def test_secrets_go_and_documents_stay(stages):
    before, after = ({r.doc_id: r for r in stages[i][2]} for i in (3, 4))
    assert before.keys() == after.keys()
    changed = [i for i in before if before[i].text != after[i].text]
    assert changed and all(after[i].n_chars == len(after[i].text) for i in changed)
    assert not any(re.search(r"AKIA[A-Z0-9]{12}|[0-9a-f]{32}|password=\w{8}", r.text) for r in after.values())
    assert all(before[i] == after[i] for i in before if i not in set(changed))


def test_packing(stages):
    from tokenizers import Tokenizer

    from lagline.llm.packing import tokenizer_path
    import numpy as np

    tok = Tokenizer.from_file(tokenizer_path())
    ids = {r.doc_id: tok.encode(r.text, add_special_tokens=False).ids + [1] for r in stages[4][2]}
    pieces = stages[5][2]
    assert {r.doc_id for r in pieces} == ids.keys()
    assert all(zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for r in pieces)
    fill = Counter()
    for r in pieces:
        fill[r.sequence_id] += r.length
    total = sum(map(len, ids.values()))
    assert sum(fill.values()) == total and max(fill.values()) <= 4096 and len(fill) <= -(-total // 4096) + 2


def test_odd_rows(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd_docs, "/root/testdata/sf0.001")
        assert stage(spark, no_docs, "/root/testdata/sf0.001").count() == 0
        if name != "best-fit packing":
            assert got.columns == odd_docs.columns
        if name == "secret scans":
            assert got.count() == 11
        assert got.count() > 0
