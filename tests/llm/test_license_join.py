from lagline.llm.license_join import license_report, notice_matches
from pyspark.sql import functions as F


def test_base_and_notices(make_docs):
    docs = make_docs([
        "CC-BY. cc by, All rights\nReserved", "cc byx; acc by", "released   under\tthe MIT License!", "released under the license",
        "General public\nlicense general public license", "LICENSED under the apache License; version 2.0 and more",
        "K cc by",  # the Kelvin sign is no letter A-Z
    ])
    found = license_report(docs).collect()
    assert {r.doc_id: r.n_words for r in found} == {0: 7, 1: 4, 2: 5, 3: 4, 4: 6, 5: 10, 6: 3}
    got = {r.doc_id: tuple(r)[2:] for r in found}
    assert got[0] == (3, 0, 4, "cc-by,reserved", "cc-by,reserved", 1.0)
    assert got[1] == (0, None, None, "", "", 0.0)
    assert got[2][:5] == (0, None, None, "", "mit") and got[2][5] == 1.0
    assert got[3] == (0, None, None, "", "mit", 0.8)
    assert got[4][:4] == (2, 0, 3, "gpl")
    assert got[5][4] == "apache-2.0"
    assert got[6][:3] == (1, 1, 1)


def test_join_is_exact(spark, make_docs):
    import random
    import re

    rng = random.Random(5)
    notices = [(f"n{i}", " ".join(rng.sample("abcdefghij", rng.randrange(1, 8)))) for i in range(15)]
    texts = ["\n".join(" ".join(rng.choices("abcdefghijklm", k=rng.randrange(0, 9))) for _ in range(5)) for _ in range(150)]
    df = make_docs(texts).select(F.col("doc_id").alias("key"), "text")
    got = {(r.key, r.label) for r in notice_matches(df, notices, 0.7).select("key", "label").collect()}
    step = max(len(body.split()) for _, body in notices)
    runs = lambda w: [w[i : i + 2 * step] for i in range(0, max(len(w) - step, 1), step)]
    want = {
        (i, n) for i, t in enumerate(texts) for run in runs(re.findall(r"\w+", t)) for n, body in notices
        if len(set(run) & set(body.split())) >= 0.7 * len(set(body.split())) - 1e-9
    }
    assert got == want and want


def test_wrapped_notices(make_docs):
    """A notice is found wherever its lines break, at any place of the text."""
    from lagline.llm.license_join import NOTICES

    texts, want = [], []
    for label, notice in NOTICES:
        words = notice.split()
        for lead in (0, 5, 16, 40):
            for cut in (len(words) // 2, len(words) - 2):
                texts.append("x " * lead + " ".join(words[:cut]) + "\n  * " + " ".join(words[cut:]) + " y" * lead)
                want.append(label)
    got = {r.doc_id: r for r in license_report(make_docs(texts)).collect()}
    assert all(want[i] in got[i].labels.split(",") and got[i].score == 1.0 for i in range(len(texts)))


def test_odd_rows(odd_docs, no_docs):
    got = license_report(odd_docs).collect()
    assert len(got) == 11 and all(r.n_base == 0 and r.labels == "" and r.score == 0 for r in got)
    assert license_report(no_docs).count() == 0
