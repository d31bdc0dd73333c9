"""Secret scans: an inverted index of the rules' trigrams picks the texts that each rule is tried on.

Every rule is a regular expression that is split into a few pieces: literals joined by OR and AND. From them a Boolean
trigram query is derived in disjunctive form: a text can only match if for one branch it holds all of its trigrams.
The index has a row per distinct trigram of the queries and text; postings are intersected by counting, per text and
branch, how many of its trigrams are present. Texts that satisfy no branch of a rule are not tried. Rules without a
mandatory trigram scan all texts.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import carried, full_text, restored

# Fixed values of the result's contract: the three base patterns, and the least length each match must have.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

# A key from its BEGIN line to the END line; where another line of dashes or none follows, over its headers and the base64
# after them. Only single characters are repeated without bound, as Java's matcher recurses on groups.
PRIVATE = r"PRIVATE KEY(?: BLOCK)?-----"
BASE64 = r"[A-Za-z0-9+/=\\]"
NEXT = rf"\s++(?:{BASE64}{{16,}}+|(?<=[\r\n][ \t]{{0,8}}){BASE64}++[ \t]*+(?:[\r\n]|\z))"
OPEN_KEY = rf"(?:\s*+[A-Za-z][A-Za-z-]*+: [^\r\n]*+){{0,8}}+(?s:.*?)(?!{BASE64})(?!{NEXT})"
PRIVATE_KEY = rf"-----BEGIN [A-Z ]{{0,40}}{PRIVATE}(?:(?>(?s:.*?)-----)END [A-Z ]{{0,40}}{PRIVATE}|{OPEN_KEY})"

SPANS = "array<struct<start:int,kind:int,end:int,own:int>>"
BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """A kind of secret.

    pattern: the regular expression, matched leftmost and without overlaps; matches whose `group` is shorter than
    `least` are dropped. needs: literals that every match holds, as a conjunction of disjunctions; empty for none.
    """

    kind: str
    pattern: str
    needs: tuple[tuple[str, ...], ...] = ()
    group: int = 0
    least: int = 1
    any_case: bool = False
    base: bool = False

    def branches(self) -> list[list[str]]:
        """The trigram query: alternatives, each a list of trigrams (in lower case) that must all be present."""
        found = []
        for choice in product(*self.needs):
            grams = sorted({x.lower()[i : i + 3] for x in choice for i in range(len(x) - 2)})
            if not grams:
                return []  # an alternative that any text satisfies: the rule scans fully
            found.append(grams)
        return found if self.needs else []


RULES = (
    Rule("assign", ASSIGN, (("password", "passwd", "secret", "token", "apikey", "api_key"),), 1, 8, True, True),
    Rule("access", r"AKIA[A-Z0-9]{12,}", (("AKIA",),), 0, 16, False, True),  # a run below 16 can't match later either
    Rule("hex", r"[0-9a-f]{32,}", (), 0, 32, False, True),  # runs are maximal, so the bound drops no more than a filter
    Rule("private_key", PRIVATE_KEY, (("-----BEGIN ",), ("PRIVATE KEY-----", "PRIVATE KEY BLOCK-----"))),
    Rule("github", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{36,}", (("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_"),)),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}", (("AIza",),)),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}", (("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"),)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", (("eyJ",), (".eyJ",))),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+]{1,15}://[^\s:/@]++:[^\s:/@]++@", (("://",),)),
)


def _class(chars: str) -> str:
    return "".join("\\" + c if c in "\\]^-[" else c for c in chars)


def gram_pattern(grams: list[str]) -> str:
    """A lookahead that captures, at any place of a text, the trigram that begins there if it is one of those given.

    Trigrams are arranged by their first and second letters, so that most places fail at the first comparison.
    """
    quote = lambda c: c if c.isalnum() else "\\" + c
    tree: dict[str, dict[str, str]] = {}
    for g in sorted(grams):
        seconds = tree.setdefault(g[0], {})
        seconds[g[1]] = seconds.get(g[1], "") + quote(g[2])
    words = [
        quote(a) + "(?:" + "|".join(f"{quote(b)}[{c}]" for b, c in seconds.items()) + ")" for a, seconds in tree.items()
    ]
    return f"(?=[{''.join(map(quote, tree))}])(?=({'|'.join(words)}))"


def postings(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The inverted index: a row (`gram`, `key`) for each of the rules' trigrams that a text holds, in any case.

    texts has `key` and `text`. Letters are compared in lower case, which can only add candidates.
    """
    grams = sorted({g for r in rules for branch in r.branches() for g in branch})
    if not grams:
        return texts.select(F.lit("").alias("gram"), "key").where("false")
    found = F.regexp_extract_all(F.lower("text"), F.lit(gram_pattern(grams)), F.lit(1))
    return texts.select("key", F.explode(F.array_distinct(found)).alias("gram")).select("gram", "key")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per text the rules it must be tried on: columns `key`, `kinds`. Postings are intersected branch by branch."""
    spark = index.sparkSession
    rows = [
        (g, f"{r.kind}/{n}", r.kind, len(branch))
        for r in rules for n, branch in enumerate(r.branches()) for g in branch
    ]
    terms = spark.createDataFrame(rows, "gram string, branch string, kind string, size int")
    met = index.distinct().join(F.broadcast(terms), "gram")  # as many rows as the rules have trigrams
    whole = met.groupBy("key", "kind", "branch").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
    return whole.where("n = size").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Places of a rule's matches: array of (start, kind's order, end), in code points.

    The pieces between the matches and the matches themselves take turns, so their lengths add up to the places.
    """
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    steps = F.transform(
        F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("gap"), whole.alias("len"), kept.alias("own")),
        lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["len"]).alias("len"), F.length(x["own"]).alias("own")),
    )
    return _bound(steps, lambda s: F.filter(_placed(s, order), lambda x: x["own"] >= rule.least))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is worked out once: an expression that a lambda refers to runs at each call."""
    return F.get(F.transform(F.array(value), use), 0)


def _placed(steps: Column, order: int) -> Column:
    """Places from the lengths of pieces and matches: running sums block by block, as one array that grows by a place at
    a time is copied at each step."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1)), F.lit(BLOCK))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins"))

    def enter(acc: Column, block: Column) -> Column:
        size = F.aggregate(block, F.lit(0), lambda n, x: n + x["gap"] + x["len"])
        return F.struct((acc["at"] + size).alias("at"), F.concat(acc["begins"], F.array(acc["at"])).alias("begins"))

    def whole(blocks: Column) -> Column:
        begins = F.aggregate(blocks, zero, enter, lambda acc: acc["begins"])
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), begins.alias("at")), lambda x: _places(x["b"], x["at"], order)))

    return _bound(F.transform(starts, lambda i: F.slice(steps, i, BLOCK)), whole)


def _places(block: Column, at: Column, order: int) -> Column:
    """The places of one block's matches, the first gap beginning at `at`."""
    empty = F.array().cast(SPANS)
    start = F.struct(at.alias("at"), empty.alias("found"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["len"]
        span = F.struct(begin.alias("start"), F.lit(order).alias("kind"), end.alias("end"), x["own"].alias("own"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(span)).alias("found"))

    return F.aggregate(block, start, step, lambda acc: acc["found"])


def scan(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with a column `_spans`: array of (start, kind, end), by start, then by the rules' order.

    Places count code points, ends are exclusive. Null and empty texts have no spans. Rows that repeat are scanned
    once each; rows of one text share candidates. A text with any number of matches keeps all of them.
    """
    body = F.col("_text")
    # texts that share a key share candidates, never results
    keyed = docs.select(carried(docs), full_text(text).alias("_text")).withColumn("_key", F.xxhash64(body))
    index = postings(keyed.select(F.col("_key").alias("key"), body.alias("text")), rules)
    tried = candidates(index, rules).select(F.col("key").alias("_key"), F.col("kinds").alias("_kinds"))
    out = keyed.join(tried, "_key", "left")
    parts = []
    none = F.array().cast(SPANS)
    for order, rule in enumerate(rules):
        found = _spans(body, rule, order)
        if rule.branches():
            found = F.when(F.array_contains("_kinds", rule.kind), found).otherwise(none)
        else:  # most texts have no match; they need no pieces
            found = F.when(body.rlike(rule.pattern), found).otherwise(none)
        parts.append(found)
    spans = F.transform(F.array_sort(F.concat(*parts)), lambda s: s.dropFields("own"))
    return restored(out, docs.columns, spans.alias("_spans"))


def described(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap are replaced together.

    A block of spans is cut from its own stretch of the text, so that the work does not grow with spans times length.
    """
    names = F.array(*[F.lit(f"[{r.kind}]") for r in rules])
    starts = F.sequence(F.lit(1), F.greatest(F.size(spans), F.lit(1)), F.lit(BLOCK))
    blocks = F.transform(starts, lambda i: F.slice(spans, i, BLOCK))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins"))

    def enter(acc: Column, block: Column) -> Column:
        reach = F.aggregate(block, acc["at"], lambda at, s: F.greatest(at, s["end"]))
        return F.struct(reach.alias("at"), F.concat(acc["begins"], F.array(acc["at"])).alias("begins"))

    ends = F.aggregate(blocks, zero, enter, lambda acc: F.concat(acc["begins"], F.array(acc["at"])))

    def cut(x: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

        def step(acc: Column, s: Column) -> Column:
            begin = s["start"] - x["base"]
            gap = F.substring(x["stretch"], acc["at"] + 1, F.greatest(begin - acc["at"], F.lit(0)))
            put = F.when(begin >= acc["at"], F.array(gap, F.element_at(names, s["kind"] + 1))).otherwise(F.array().cast("array<string>"))
            return F.struct(F.greatest(acc["at"], s["end"] - x["base"]).alias("at"), F.concat(acc["parts"], put).alias("parts"))

        return F.array_join(F.aggregate(x["spans"], empty, step, lambda acc: acc["parts"]), "")

    count = F.size(blocks)
    zipped = F.arrays_zip(blocks.alias("spans"), F.slice(ends, F.lit(1), count).alias("at"), F.slice(ends, F.lit(2), count).alias("end"))
    # the stretch is cut once a block, before the inner lambda refers to it
    stretches = F.transform(zipped, lambda x: F.struct(x["spans"].alias("spans"), x["at"].alias("base"), F.substring(text, x["at"] + 1, x["end"] - x["at"]).alias("stretch")))
    tail = F.substring(text, F.element_at(ends, -1) + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(F.transform(stretches, cut), ""), tail))


def secret_report(docs: DataFrame, text: str = "text", key: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: `doc_id`, `n_assign`, `n_access`, `n_hex`, `base_sha256`, `spans`."""
    found = scan(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "text", rules)
    base = [i for i, r in enumerate(rules) if r.base]
    of_kind = lambda i: F.filter("_spans", lambda s: s["kind"] == i)
    counts = [F.size(of_kind(i)).cast("long").alias(f"n_{rules[i].kind}") for i in base]
    own = F.filter("_spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id", *counts, F.sha2(described(own, rules), 256).alias("base_sha256"), described(F.col("_spans"), rules).alias("spans")
    )
