from collections import Counter
from zlib import crc32

from lagline.llm.language_id import PROFILE, Classifier, grams_of, language_report, ranked


def plain_profile(texts):
    """The most frequent n-grams of one to three letters, in order, as strings; ties by the code points, aligned right."""
    counts = Counter()
    for text in texts:
        line = "".join(c if c.isalpha() else " " for c in text)
        line = "".join(c.lower() if len(c.lower()) == 1 else c for c in line)
        if not line.split():
            continue
        line = " " + " ".join(line.split()) + " "
        for n in (1, 2, 3):
            grams = (line[i : i + n] for i in range(len(line) - n + 1))
            counts.update(g for g in grams if g != " " and not (n == 3 and g[1] == " "))
    return sorted(counts, key=lambda g: (-counts[g], [ord(c) for c in g.rjust(3, "\0")]))[:PROFILE]


def plain_report(rows):
    texts = {}
    for key, text, lang in rows:
        if crc32(str(key).encode()) % 4 != 2 and lang is not None and text is not None:
            texts.setdefault(lang, []).append(text)
    ranks = {lang: {g: i for i, g in enumerate(plain_profile(t))} for lang, t in texts.items()}
    out = {}
    for key, text, _ in rows:
        own = plain_profile([text or ""])
        away = {lang: sum(abs(i - known[g]) if g in known else PROFILE for i, g in enumerate(own)) for lang, known in ranks.items()}
        best = min(sorted(away), key=away.get)
        out[key] = (best, 1 - away[best] / PROFILE / len(own)) if own else ("und", 0.0)
    return out


def test_plain_version(spark):
    """Profiles, ranks and distances of whole documents, learned and compared in plain Python."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect()] + [(10_001, "", "xx"), (10_002, None, "xx"), (10_003, "Ǆ ÉÀ İx 12 ß", "yy"), (10_004, "?!", None)]
    want = plain_report(rows)
    got = language_report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(want) and all((r.lang_pred, round(r.score, 9)) == (want[r.doc_id][0], round(want[r.doc_id][1], 9)) for r in got)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 200 and sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_profiles():
    codes, counts = grams_of("Ab, ab")
    text = {tuple(c for c in (code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF) if c): n for code, n in zip(codes.tolist(), counts.tolist())}
    assert text == {(97,): 2, (98,): 2, (32, 97): 2, (97, 98): 2, (98, 32): 2, (32, 97, 98): 2, (97, 98, 32): 2}
    assert len(ranked(codes, counts, 3)) == 3
    model = Classifier({"x": grams_of("aaa bbb")[0].tolist(), "a": grams_of("aaa bbb")[0].tolist()})
    assert model.predict("bbb")[0] == "a"  # a tie goes to the smaller name


def test_odd_rows(odd_docs, no_docs, make_docs):
    got = language_report(odd_docs).collect()
    assert len(got) == 11 and {r.lang_pred for r in got if r.doc_id in (0, 1, 2)} == {"und"}
    assert {r.lang_pred for r in got if r.doc_id == 3} == {"en"}
    assert language_report(no_docs).count() == 0
    assert {r.lang_pred for r in language_report(make_docs(["some text"], lang=None)).collect()} == {"und"}
