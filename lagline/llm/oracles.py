"""SQL for DuckDB that gives the rows of the queries that SQL can express."""

from __future__ import annotations

import math

from lagline.llm.license_join import CONTAINMENT, NOTICES, PHRASES, longest, notice_words
from lagline.llm.secret_scan import RULES

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({ASCII_LOWER}, '{WORD}') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({ASCII_LOWER}, '{WORD}') AS w FROM benchmark),
win AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
place AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
hit AS (
    SELECT doc_id, i, s.n, item
    FROM place JOIN (SELECT DISTINCT n FROM win) s ON i + s.n - 1 <= len(w)
    JOIN win ON win.n = s.n AND win.phrase = array_to_string(w[i : i + s.n - 1], ' ')),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256
    FROM hit GROUP BY doc_id),
term AS (SELECT term, count(*) AS n FROM (SELECT unnest(w) AS term FROM d) GROUP BY term),
own AS (SELECT item, row_number() OVER () AS r, list_distinct(w) AS w FROM b WHERE len(w) > 0),
ranked AS (
    SELECT r, item, least(len(w), 3) AS need, term, row_number() OVER (PARTITION BY r ORDER BY n, term) AS k
    FROM (SELECT r, item, w, unnest(w) AS term FROM own) JOIN term USING (term)),
rare AS (SELECT * FROM ranked WHERE k <= need QUALIFY count(*) OVER (PARTITION BY r) = need),
spot AS (SELECT doc_id, i, term FROM (SELECT doc_id, i, w[i] AS term FROM place) WHERE term IN (SELECT term FROM rare)),
beside AS (
    SELECT s.doc_id, s.i, a.r, a.item, a.need, o.k
    FROM rare a JOIN spot s ON a.k = 1 AND s.term = a.term JOIN rare o ON o.r = a.r
    JOIN spot x ON x.doc_id = s.doc_id AND x.term = o.term AND abs(x.i - s.i) <= 30),
near AS (
    SELECT doc_id, count(DISTINCT item) AS n_near
    FROM (SELECT doc_id, item FROM beside GROUP BY doc_id, i, r, item, need HAVING count(DISTINCT k) = need) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
    coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
"""

_BASE = " UNION ALL ".join(
    f"SELECT doc_id, i, {_text(label)} AS label FROM place WHERE w[i : i + {len(p.split()) - 1}] = {p.split()}"
    for p, label in PHRASES.items()
)
_NOTICES = ", ".join(
    f"({_text(label)}, {notice_words(text)}, {math.ceil(CONTAINMENT * len(notice_words(text)) - 1e-9)})" for label, text in NOTICES
)
LICENSES = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({ASCII_LOWER}, '{WORD}') AS w FROM documents),
place AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
base AS ({_BASE}),
notice(label, own, need) AS (VALUES {_NOTICES}),
block AS (
    SELECT doc_id, list_distinct(w[i * {longest()} + 1 : (i + 2) * {longest()}]) AS w
    FROM (SELECT doc_id, w, unnest(range(0, greatest(ceil(len(w) / {longest()})::BIGINT - 1, 1))) AS i FROM d WHERE len(w) > 0)),
found AS (
    SELECT doc_id, label, len(list_intersect(w, own)) / len(own) AS share
    FROM block, notice WHERE len(list_intersect(w, own)) >= need),
counts AS (
    SELECT doc_id, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM base GROUP BY doc_id),
labels AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT doc_id, label FROM base UNION SELECT doc_id, label FROM found) GROUP BY doc_id),
shares AS (SELECT doc_id, max(share) AS share FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN labels USING (doc_id) LEFT JOIN shares USING (doc_id)
"""

TOP_K = """
WITH v AS (
    SELECT vec_id, row_number() OVER () AS own, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
    SELECT q.own, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.own <> q.own AND len(q.v) = len(c.v))
SELECT query_id, (row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM pair QUALIFY rank <= 10
"""

ARCHIVES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
last AS (SELECT body, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY body)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
    CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN last <> page_id THEN last END AS refers_to
FROM p LEFT JOIN last USING (body)
"""


# Rules whose patterns use what this engine lacks, for the texts where both find the same: no possessive quantifiers, and
# private keys that have an END line. Keys without one are compared with a plain version in the tests.
SQL_PATTERNS = {
    "private_key": r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----(?:-{0,4}[^-])*-----END [A-Z ]{0,40}PRIVATE KEY(?: BLOCK)?-----",
    "url_login": r"[A-Za-z][A-Za-z0-9+]{1,15}://[^\s\x0B:/@]+:[^\s\x0B:/@]+@",
}


def _spans(n: int) -> str:
    """Places of one rule's matches: the pieces between them and the matches take turns."""
    rule = RULES[n]
    pattern = _text(SQL_PATTERNS.get(rule.kind, rule.pattern))
    return f"""
    SELECT doc_id, {n} AS kind, {_text(rule.kind)} AS name, {rule.base} AS base,
        coalesce(list_sum(list_transform(gaps[:i], lambda x: length(x))), 0)
            + coalesce(list_sum(list_transform(whole[: i - 1], lambda x: length(x))), 0) AS start, length(whole[i]) AS size
    FROM (
        SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM (
            SELECT doc_id, string_split_regex(text, {pattern}) AS gaps, regexp_extract_all(text, {pattern}) AS whole,
                regexp_extract_all(text, {pattern}, {rule.group}) AS own
            FROM documents WHERE regexp_matches(text, {pattern})))
    WHERE length(own[i]) >= {rule.least}"""


SECRETS = f"""
WITH span AS ({" UNION ALL ".join(map(_spans, range(len(RULES))))}),
named AS (SELECT *, name || ':' || start::BIGINT || ':' || (start + size)::BIGINT AS place FROM span),
per AS (
    SELECT doc_id, count(*) FILTER (name = 'assign') AS n_assign, count(*) FILTER (name = 'access') AS n_access,
        count(*) FILTER (name = 'hex') AS n_hex, string_agg(place, ',' ORDER BY start, kind) FILTER (base) AS base,
        string_agg(place, ',' ORDER BY start, kind) AS spans
    FROM named GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
    coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN per USING (doc_id)
"""

# CRC-32 of a list of bytes, by a table that is made from its rule.
CRC_TABLE = "SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)"


def _bytes(text: str) -> str:
    return f"list_transform(range(1, strlen({text}) * 2, 2), lambda i: ('0x' || hex({text})[i : i + 1])::BIGINT)"


def _crc(values: str) -> str:
    return f"xor(list_reduce({values}, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295)"


def _edit(state: str, cost: str, letter: str, line: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {state}.r || {line}}}"


def _inserts(select: str) -> str:
    """The states s0 to s3 after any useful number of inserts."""
    user, assistant = "'user:' || chr(10)", "'assistant:' || chr(10)"
    return f"""
    SELECT * EXCLUDE (i2, i3), least(i2, {_edit("i3", "3", "I", user)}) AS j2, least(i3, {_edit("i2", "3", "I", assistant)}) AS j3 FROM (
        SELECT *, least(s2, {_edit("s0", "3", "I", user)}, {_edit("s1", "3", "I", user)}, {_edit("s3", "3", "I", user)}) AS i2,
            least(s3, {_edit("s2", "3", "I", assistant)}) AS i3 FROM ({select}))"""


_KEPT = "role || ':' || text || chr(10)"
_LOST = "{'c': 1000000000, 'a': '', 'r': ''}"


def _read(state: str, letter: str) -> str:
    """A row that is to be user or assistant: kept if it is one, else given that role."""
    name = {"u": "user", "a": "assistant"}[letter]
    kept, changed = _edit(state, "extra", "K", _KEPT), _edit(state, "3 + extra", "R", f"'{name}:' || text || chr(10)")
    return f"CASE WHEN gone THEN {_LOST} WHEN initial = '{letter}' THEN {kept} ELSE {changed} END"


CONVERSATIONS = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
raw AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc(_bytes("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))"))} % 20 AS kind
    FROM conversations, crc),
hurt AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM raw WHERE kind <> 0),
nth AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS nr FROM hurt),
flags AS (
    SELECT *, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last, left(role, 1) AS initial,
        left(role, 1) || coalesce(left(lead(role) OVER (PARTITION BY conv_id ORDER BY nr), 1), '') AS pair,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nr) > 1 AS again FROM nth),
faults AS (
    SELECT *, CASE WHEN last = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM flags),
lines AS (
    SELECT conv_id, nr, role, text, initial, coalesce(fault IN ('blank', 'duplicate'), false) AS gone,
        CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra FROM faults),
step AS (
    SELECT conv_id, 0::BIGINT AS nr, {{'c': 0, 'a': '', 'r': ''}} AS s0, {_LOST} AS s1, {_LOST} AS s2, {_LOST} AS s3 FROM (SELECT DISTINCT conv_id FROM hurt)
    UNION ALL
    SELECT conv_id, nr, {_edit("s0", "4", "D", "''")} AS s0,
        least({_edit("s1", "4", "D", "''")}, CASE WHEN NOT gone AND initial = 's' THEN {_edit("s0", "extra", "K", _KEPT)} ELSE {_LOST} END) AS s1,
        least({_edit("j2", "4", "D", "''")}, {_read("s0", "u")}, {_read("s1", "u")}, {_read("j3", "u")}) AS s2,
        least({_edit("j3", "4", "D", "''")}, {_read("j2", "a")}) AS s3
    FROM ({_inserts("SELECT step.conv_id, lines.nr, s0, s1, s2, s3, role, text, initial, gone, extra FROM step JOIN lines ON step.conv_id IS NOT DISTINCT FROM lines.conv_id AND lines.nr = step.nr + 1")})),
final AS (
    SELECT conv_id, least(s0, j3) AS best
    FROM ({_inserts("SELECT * FROM step QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY nr DESC) = 1")})),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (length(pair) = 2 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
    coalesce(best.a, '') AS audit, sha256(coalesce(best.r[: length(best.r) - 1], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts ON o.conv_id IS NOT DISTINCT FROM counts.conv_id LEFT JOIN final ON o.conv_id IS NOT DISTINCT FROM final.conv_id
"""

SPELLING = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
run AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents),
hashed AS (
    SELECT run, {_crc(_bytes("(coalesce(doc_id::VARCHAR, '') || ':' || run)"))} AS h, count(*) AS many
    FROM run, crc WHERE length(run) >= 7 GROUP BY ALL),
word AS (
    SELECT CASE WHEN h % 31 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, sum(many)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND n >= 2),
less AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word),
rest AS (SELECT word, n, i, word[: i - 1] || word[i + 1 :] AS rest FROM less),
near AS (
    SELECT a.word, b.word AS other, b.n FROM rest a JOIN rest b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM rest a JOIN word b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM rest a JOIN word b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS form, max(n) AS form_n FROM near GROUP BY word),
formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
    FROM word LEFT JOIN best USING (word)),
chain AS (
    SELECT word, word AS root FROM formed
    UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON chain.root = formed.word WHERE formed.form IS NOT NULL)
SELECT f.word, f.form, root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM formed f JOIN chain USING (word) JOIN formed last ON chain.root = last.word WHERE last.form IS NULL
"""

# For pages whose article is an <article> element of headings and paragraphs, and for the references that occur there.
ARTICLES = r"""
WITH body AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS body, row_number() OVER () AS nr FROM pages),
block AS (SELECT nr, unnest(string_split_regex(body, '</?(h1|p)>')) AS block, generate_subscripts(string_split_regex(body, '</?(h1|p)>'), 1) AS i FROM body),
plain AS (
    SELECT nr, i, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(block, '<[^>]*>', ' ', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS block
    FROM block),
texts AS (SELECT nr, string_agg(block, chr(10) ORDER BY i) AS text FROM plain WHERE block <> '' GROUP BY nr)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM body LEFT JOIN texts USING (nr)
"""
