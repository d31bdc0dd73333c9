import hashlib
import re

from pyspark.sql import functions as F

from lagline.llm.common import stored
from lagline.llm.secret_scan import RULES, Rule, candidates, postings, redacted, scan, secret_report

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
TEXTS = [
    'password = "abcdefgh"', "PassWord:'short'", "token=secret: abcdefghij", "api_key==12345678 apikey: zzzzzzzz1", "AKIA" + "A" * 12,
    "AKIA" + "B" * 11, "xAKIAAKIA1234567890", "f" * 32 + "g" + "0" * 31, "é日" * 3 + " secret=" + "x" * 9 + "😀 token='12345678'",
    "my password is 12345678", "passwd:" + "9" * 700, "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "zY" * 18, "AIza" + "x" * 35,
    "xoxb-1234567890ab", "http://user:pw@host/", "a" * 40 + " " + "deadbeef" * 4 + " token=" + "deadbeef" * 5, "secret=secret=secret=", None, "",
    "ſecret=abcdefghi", " ".join(["cafe" * 8] * 700),
]


def plain(text):
    text = text or ""
    found = []
    for kind, (pattern, group, least) in enumerate([(ASSIGN, 2, 8), (re.compile(r"AKIA[A-Z0-9]+"), 0, 16), (re.compile(r"[0-9a-f]+"), 0, 32)]):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(found)


def test_base_kinds(make_docs):
    names = ["assign", "access", "hex"]
    for r in secret_report(make_docs(TEXTS)).collect():
        want = plain(TEXTS[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in want) for i in range(3)], TEXTS[r.doc_id]
        line = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        base = [s for s in r.spans.split(",") if s.split(":")[0] in names]
        assert ",".join(base) == line


def test_added_kinds(make_docs):
    spans = {r.doc_id: r.spans for r in secret_report(make_docs(TEXTS)).collect()}
    assert spans[11] == "private_key:0:31" and spans[12] == "github:0:40" and spans[13] == "google:0:39"
    assert spans[14] == "slack:0:17" and spans[15].startswith("url_login:0:15")


def test_index_loses_no_match(make_docs):
    texts = make_docs([t or "" for t in TEXTS]).select(F.col("doc_id").alias("key"), "text")
    found = {r.key: set(r.kinds) for r in candidates(postings(texts)).collect()}
    for r in scan(make_docs(TEXTS)).collect():
        kinds = {RULES[s.kind].kind for s in r._spans if RULES[s.kind].branches()}
        assert kinds <= found.get(r.doc_id, set())
    assert 9 in found and "hex" not in set().union(*found.values())  # a word is a candidate, a rule without trigrams is not indexed


def test_boolean_queries():
    assert Rule("x", "ab(cde|fgh)", (("abcde", "abfgh"),)).branches() == [["abc", "bcd", "cde"], ["abf", "bfg", "fgh"]]
    assert Rule("x", "ab", (("ab",),)).branches() == [] and Rule("x", ".").branches() == []


def test_redaction(make_docs):
    rows = scan(make_docs(TEXTS)).select("doc_id", "text", redacted(F.col("text"), F.col("_spans")).alias("out")).collect()
    out = {r.doc_id: r.out for r in rows}
    assert out[0] == "[assign]\"" and out[9] == TEXTS[9] and out[8] == "é日" * 3 + " [assign]😀 [assign]'"
    assert out[16] == "[hex] [hex] [assign]" and out[18] is None


def test_many_secrets_in_one_text(spark, make_docs):
    """Fifty thousand secrets of one text, more than any block holds, among them spans that overlap."""
    parts = [("token=" if i % 7 == 0 else "") + f"{i:032x}" for i in range(50_000)]
    text = "é " + " ".join(parts)
    rows = stored(scan(make_docs([text])).select("text", "_spans"), "spans")
    out = rows.select(redacted(F.col("text"), F.col("_spans")).alias("out"), F.size("_spans").alias("n")).first()
    assert out.n == 50_000 + len(parts[::7])  # the assignment and the digits in it
    assert out.out == "é " + " ".join("[assign]" if i % 7 == 0 else "[hex]" for i in range(50_000))


def test_no_line_of_a_key_is_left(make_docs):
    lines = [c * 64 for c in "ABCDEFGHIJ"] + ["Klmn+/w="]
    body = "\n".join(lines)
    pgp = "PGP PRIVATE KEY BLOCK"
    keys = [f"-----BEGIN {k}-----\n{h}{body}\n-----END {k}-----" for k, h in [
        ("RSA PRIVATE KEY", ""), ("PRIVATE KEY", ""), (pgp, "Version: GnuPG v2\n\n"),
        ("RSA PRIVATE KEY", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-256-CBC,0A1B\n\n")]]
    keys += [keys[0].replace("\n", "\\n"), keys[0].replace("\n", " "), keys[0].replace("\n", "\r\n"), keys[0].replace("AAA", "AA\n") ]
    cut = [k[: k.index("\n-----END")] for k in keys[:4]]
    long_ = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(["Z" * 64] * 300)
    texts = [f"before\n{k}\nafter it, more" for k in keys + cut + [long_]]
    texts.append(f"{cut[0]}\nsome prose here\n{keys[1]} end")
    texts.append("-----BEGIN PRIVATE KEY----- opens a key")
    rows = stored(scan(make_docs(texts)).select("doc_id", "text", "_spans"), "spans").select("doc_id", redacted(F.col("text"), F.col("_spans")).alias("out")).collect()
    out = {r.doc_id: r.out for r in rows}
    assert [out[i] for i in range(len(texts) - 2)] == ["before\n[private_key]\nafter it, more"] * (len(texts) - 2)
    assert out[len(texts) - 2] == "[private_key]\nsome prose here\n[private_key] end"
    assert out[len(texts) - 1] == "[private_key] opens a key"


def test_long_logins_and_fine_grained_tokens(make_docs):
    pat = "github_pat_" + "aB3_" * 20 + "xy"
    texts = [f"https://u:{pat}@github.com", f"HTTPS://{'u' * 70}:{'p' * 300}@host/", pat, "https://host:80/a@b"]
    spans = {r.doc_id: r.spans for r in secret_report(make_docs(texts)).collect()}
    assert spans[0] == f"url_login:0:{len(texts[0]) - 10},github:10:{len(texts[0]) - 11}"
    assert spans[1] == f"url_login:0:{len(texts[1]) - 5}" and spans[2] == f"github:0:{len(pat)}" and spans[3] == ""


def test_sql_patterns_agree_where_keys_end():
    """The patterns that the SQL uses in place of the rules' own find the same, but for keys without an END line."""
    import duckdb

    from lagline.llm.oracles import SQL_PATTERNS

    key = lambda k, body: f"-----BEGIN {k}-----\n{body}\n-----END {k}-----"
    texts = [key("RSA PRIVATE KEY", "AAAA"), "x" + key("PRIVATE KEY", "-- -") + key("PGP PRIVATE KEY BLOCK", "b\nc") + " y",
             "ftp://a:b@c http://u:p q@x", "a://b:c@d ab://é:日@h", "ab://u\x0bx:p@h"]
    rules = {r.kind: r for r in RULES}
    simple = {"url_login": rules["url_login"].pattern.replace("++", "+"), "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----(?s:.*?)-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"}
    for kind, pattern in SQL_PATTERNS.items():
        for text in texts:
            got = duckdb.execute("SELECT regexp_extract_all(?, ?)", [text, pattern]).fetchone()[0]
            assert got == re.findall(simple[kind], text), (kind, text)


def test_odd_rows(odd_docs, no_docs):
    got = secret_report(odd_docs).collect()
    assert len(got) == 11 and all(r.spans == "" for r in got)
    assert scan(odd_docs).drop("_spans").columns == odd_docs.columns
    assert secret_report(no_docs).count() == 0
