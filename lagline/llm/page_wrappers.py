"""HTML extraction: a wrapper per host, inferred from the host's pages, says which of a page's text slots are the article.

A wrapper is a regular expression without unions over tags and text: elements in order, each once, optional or repeated,
groups that are repeated as a whole, and slots for text. A page's own expression comes from its tokens: equal neighbours,
and runs of up to four items that follow each other again, become one repeated item or group. Expressions of one host are
aligned one after the other: what both have in common stays, a mismatch is resolved into a group where one side repeats
what the other has once, else into optional items. Equal expressions are aligned once.

Slots of a wrapper are judged by what all pages of the host have in them: where they stand, how much text and how much of
it in links, and whether the text is the same on all pages (then it belongs to the wrapper, not to the article). Pages are
read once; what they hold is written as slot numbers and texts, and the judgement is joined to them by host and expression.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import full_text, small_batches, stored

DEPTH = 150  # elements that lie deeper belong to the last one above
LONGEST = 4  # items of a group that repeats
SALTS = 64  # first round of alignment: expressions of a host are dealt to so many groups
PAGES = 3  # different pages on which equal text makes a slot part of the wrapper

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</[A-Za-z][^>]*+(?:>|\Z)"
    r"|<[A-Za-z](?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+(?:>|\Z)|<[A-Za-z][^>]*+(?:>|\Z)",
    re.S,
)
NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr picture q rp rt ruby s samp small "
    "source span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes".split())
FRAME = frozenset("html head body".split())
# an open element of the first kind ends where one of the second begins, unless one of the third stands between
ENDED = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "table tr"),
    "th": ("td th", "table tr"), "thead": ("thead tbody tfoot tr td th", "table"), "tbody": ("thead tbody tfoot tr td th", "table"),
    "tfoot": ("thead tbody tfoot tr td th", "table"), "option": ("option", "select datalist"), "optgroup": ("option optgroup", "select"),
}
ENDED = {name: (frozenset(a.split()), frozenset(b.split())) for name, (a, b) in ENDED.items()}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset("p li dt dd td th pre blockquote".split())

# What is no part of an article: elements, roles, and words of class names and ids.
OUTSIDE = frozenset("nav footer aside form noscript template svg button select object dialog menu canvas audio video map datalist fieldset".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar status".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored sponsors promo promos promotion cookie cookies "
    "consent gdpr notice notices notification notifications alert alerts popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social breadcrumb breadcrumbs menu menus nav navbar navigation topbar toolbar sidebar sidebars widget widgets related "
    "recommended recommendations comment comments commentlist disqus reply replies respond footer masthead pagination pager copyright disclaimer "
    "search searchbox".split()
)
HEADS = frozenset(("header",))
MARKED_WORDS = frozenset("article post entry story content main".split())


class Item:
    """An element, a group or a text slot of an expression. `into` is the item that it was merged into."""

    __slots__ = ("into", "items", "opt", "rep", "sym")

    def __init__(self, sym: str, items: list[Item] | None = None, rep: bool = False, opt: bool = False):
        self.sym, self.items, self.rep, self.opt, self.into = sym, items, rep, opt, None

    def final(self) -> Item:
        item = self
        while item.into is not None:
            item = item.into
        return item


TEXT, GROUP = "#", "("


def merge(a: Item, b: Item) -> None:
    """b becomes part of a."""
    b.into = a
    a.rep |= b.rep
    a.opt |= b.opt
    if a.items is not None:
        a.items = aligned(a.items, b.items)


def _shape(items: list[Item]) -> str:
    return GROUP + " ".join(x.sym for x in items)


def folded(items: list[Item]) -> list[Item]:
    """Repeats as one item: neighbours of one name first, then groups of two to four items."""
    out: list[Item] = []
    for item in items:
        if out and out[-1].sym == item.sym:
            merge(out[-1], item)
            out[-1].rep, out[-1].opt = True, out[-1].opt and item.opt
        else:
            out.append(item)
    for size in range(2, LONGEST + 1):
        if len(out) < 2 * size:
            break
        syms = [x.sym for x in out]
        made, at = [], 0
        while at < len(out):
            if at + 2 * size <= len(out) and syms[at : at + size] == syms[at + size : at + 2 * size]:
                group = Item(_shape(out[at : at + size]), out[at : at + size], True)
                at += size
                while syms[at : at + size] == [x.sym for x in group.items]:
                    for a, b in zip(group.items, out[at : at + size]):
                        merge(a, b)
                    at += size
                made.append(group)
            else:
                made.append(out[at])
                at += 1
        out = made
    return out


def _wrapped(items: list[Item], shapes: dict[str, int]) -> list[Item]:
    """Items with those runs as groups that the other side repeats."""
    out, at = [], 0
    while at < len(items):
        for shape, size in shapes.items():
            run = items[at : at + size]
            if len(run) == size and _shape(run) == shape:
                out.append(Item(shape, run))
                at += size
                break
        else:
            out.append(items[at])
            at += 1
    return out


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence, as pairs of places: the longest rising chain of matches."""
    places: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i, sym in enumerate(a):
        for j in places.get(sym, ()):
            k = bisect_left(ends, j)
            link = (i, j, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    chain, link = [], links[-1] if links else None
    while link:
        chain.append(link[:2])
        link = link[2]
    return chain[::-1]


def aligned(a: list[Item], b: list[Item]) -> list[Item]:
    """Two expressions as one that accepts what either does."""
    if [x.sym for x in a] != [x.sym for x in b]:
        shapes = {x.sym: len(x.items) for x in (*a, *b) if x.sym[0] == GROUP}
        if shapes:
            a, b = _wrapped(a, shapes), _wrapped(b, shapes)
    out: list[Item] = []
    i = j = 0
    for x, y in [*_common([x.sym for x in a], [y.sym for y in b]), (len(a), len(b))]:
        for item in (*a[i:x], *b[j:y]):
            item.opt = True
            out.append(item)
        if x < len(a):
            merge(a[x], b[y])
            out.append(a[x])
        i, j = x + 1, y + 1
    return out


def written(items: list[Item]) -> str:
    """An expression as text."""
    mark = lambda x: {(False, False): "", (True, False): "+", (False, True): "?", (True, True): "*"}[x.rep, x.opt]
    one = lambda x: "#" if x.sym == TEXT else f"({written(x.items)})" if x.sym[0] == GROUP else f"{x.sym}{{{written(x.items)}}}"
    return "".join(one(x) + mark(x) for x in items)


PIECE = re.compile(r"#|[^{}()#?*+]+\{|[({})?*+]")


def read(text: str) -> list[Item]:
    """An expression from its text."""
    stack: list[tuple[str, list[Item]]] = [("", [])]
    for piece in PIECE.findall(text):
        items = stack[-1][1]
        if piece == "#":
            items.append(Item(TEXT))
        elif piece in "?*+":
            items[-1].rep, items[-1].opt = piece in "*+", piece in "*?"
        elif piece in "})":
            sym, inner = stack.pop()
            stack[-1][1].append(Item(sym if sym else _shape(inner), inner))
        else:
            stack.append((piece[:-1], []))
    return stack[0][1]


def slots(items: list[Item]) -> list[Item]:
    """The text slots of an expression, in order."""
    out = []
    for x in items:
        if x.sym == TEXT:
            out.append(x)
        elif x.items:
            out += slots(x.items)
    return out


_CAMEL = re.compile(r"([a-z])([A-Z])")


def _tokens(value: str) -> list[str]:
    found = []
    for token in _CAMEL.sub(r"\1-\2", unescape(value)).lower().split():
        token = re.sub(r"[^a-z0-9_-]", "", re.sub(r"[0-9]+", "9", token))
        if token:
            found.append(token)
    return sorted(set(found))


def symbol(tag: str) -> tuple[str, str]:
    """Name of a tag, and the name that expressions have for the element: with role, classes and id, numbers as 9."""
    name = re.sub(r"[^a-z0-9:_-]", "", NAME.match(tag)[1].lower()) or "x"
    sym = name
    if " " in tag or "\n" in tag or "\t" in tag:
        found = {}
        for key, value in ATTRIBUTE.findall(tag[1 + len(name) :]):
            found.setdefault(key.lower(), value.strip("\"'"))
        if "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", "").lower()) or found.get("aria-hidden", "").lower() == "true":
            sym += "!"
        sym += "".join(f"@{t}" for t in _tokens(found.get("role", "")))
        sym += "".join(f".{t}" for t in _tokens(found.get("class", "")))
        sym += "".join(f":{t}" for t in _tokens(found.get("id", "")))
    return name, sym


def _words(sym: str) -> set[str]:
    """The words of an element's classes and id. What it says to have, or to lack, is not what it is."""
    found = set()
    for token in re.split(r"[.:]", re.sub(r"@[a-z0-9_-]*", "", sym))[1:]:
        parts = re.split(r"[-_]+", token)
        if parts[0] not in ("has", "with", "no", "without", "is", "js"):
            found.update((*parts, "".join(parts)))
    return found


def outside(sym: str) -> bool:
    """Whether an element is no part of an article, wherever it stands."""
    name = re.split(r"[.:@!]", sym)[0]
    roles = set(re.findall(r"@([a-z0-9_-]+)", sym))
    words = _words(sym)
    if name in OUTSIDE or "!" in sym or roles & OUTSIDE_ROLES:
        return True
    if name in ("article", "main") or roles & {"main", "article"}:
        return bool(words & {"comment", "comments", "reply", "ad", "ads", "advert", "related", "promo", "widget"})
    return bool(words & OUTSIDE_WORDS)


def head(sym: str) -> bool:
    return re.split(r"[.:@!]", sym)[0] in HEADS or bool(_words(sym) & HEADS)


def landmark(sym: str) -> str:
    """What an element claims to hold: article, main, marked (by a class or id) or nothing."""
    name = re.split(r"[.:@!]", sym)[0]
    if name == "article" or "@article" in sym:
        return "article"
    if name == "main" or "@main" in sym:
        return "main"
    return "marked" if _words(sym) & MARKED_WORDS else ""


class Page:
    """A page's expression, and its texts with the slots they fill."""

    def __init__(self, html: str, known: dict[str, tuple[str, str]]):
        self.root: list[Item] = []
        self.stack: list[tuple[str, Item | None]] = []
        self.runs: list[tuple[Item, str, int]] = []
        self.buffer: list[str] = []
        self.linked = 0
        self.links: list[bool] = []  # open anchors: whether they are muted
        self.muted: list[str] = []
        at = 0
        while True:
            m = TOKEN.search(html, at)
            self.put(html[at : m.start()] if m else html[at:])
            if not m:
                break
            at = m.end()
            tag = m[0]
            if tag[1] in "!?" or not tag.endswith(">"):
                continue  # a tag that the page breaks off in says nothing
            if tag not in known:
                if len(known) > 20_000:
                    known.clear()
                known[tag] = symbol(tag)
            name, sym = known[tag]
            if tag[1] == "/":
                self.close(name)
                continue
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
            self.open(name, sym)
        self.flush()
        while self.stack:
            self.pop()
        self.root = folded(self.root)
        number = {id(x): i for i, x in enumerate(slots(self.root))}
        self.text = written(self.root)
        self.found = [(number[id(item.final())], text, linked) for item, text, linked in self.runs]

    def put(self, text: str) -> None:
        if text and not self.muted:
            text = unescape(text) if "&" in text else text
            self.buffer.append(text)
            if self.links:
                self.linked += len(text)

    def container(self) -> list[Item]:
        for _, item in reversed(self.stack):
            if item is not None:
                return item.items
        return self.root

    def flush(self) -> None:
        """The text since the last block's border is a block."""
        text = " ".join("".join(self.buffer).split())
        if text:
            item = Item(TEXT)
            self.container().append(item)
            self.runs.append((item, text, min(self.linked, len(text))))
        self.buffer, self.linked = [], 0

    def pop(self) -> None:
        _, item = self.stack.pop()
        if item is not None:
            item.items = folded(item.items)

    def open(self, name: str, sym: str) -> None:
        if name in RAW or name in FRAME:
            if name in FRAME:
                self.flush()
            return
        if name in INLINE or name in ("input", "button"):
            if name == "br":
                self.put(" ")
            elif name == "img" or name in VOID:
                return
            elif self.muted or name == "button" or (sym != name and outside(sym)):
                self.muted.append(name)
            elif name == "a":
                self.links.append(True)
            return
        self.flush()
        self.links, self.muted = [], []
        if name in VOID:
            return
        if self.stack and self.stack[-1][0] == "p":
            self.pop()
        elif self.stack and name in HEADINGS and self.stack[-1][0] in HEADINGS:
            self.pop()
        if name in ENDED:
            over, border = ENDED[name]
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] in border:
                    break
                if self.stack[k][0] in over:
                    while len(self.stack) > k:
                        self.pop()
                    if name not in ("tr", "thead", "tbody", "tfoot", "optgroup"):
                        break
        item = None
        if len(self.stack) < DEPTH:
            item = Item(sym, [])
            self.container().append(item)
        self.stack.append((name, item))

    def close(self, name: str) -> None:
        if name in INLINE or name == "button":
            if name in self.muted:
                while self.muted.pop() != name:
                    pass
            elif name == "a" and self.links:
                self.links.pop()
            return
        self.flush()
        self.links, self.muted = [], []
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == name:
                while len(self.stack) > k:
                    self.pop()
                break


def chosen(items: list[Item], facts: dict[int, tuple[int, int, bool]]) -> list[int]:
    """The slots that are the article. facts: per slot the letters of its texts, those in links, whether all texts are one.

    An element that is called article or main holds it, if it has a fair part of the text; all of its slots that are not
    in something else are taken. Without one the deepest element that holds most of the text does, without the slots whose
    text is part of the wrapper, and those that are mostly links.
    """
    good: list[tuple[int, tuple[int, ...], set[str]]] = []
    count = 0
    claims: dict[int, str] = {}
    blocks: set[int] = set()  # what a page repeats, and single blocks, are in the article, not around it

    def walk(items: list[Item], path: tuple[int, ...], kinds: set[str], out: bool, top: bool) -> None:
        nonlocal count
        for x in items:
            if x.sym == TEXT:
                if not out and not (top and not kinds & {"article", "main"}):
                    good.append((count, path, kinds))
                count += 1
            elif x.sym[0] == GROUP:
                walk(x.items, path, kinds, out, top)
            else:
                claim = landmark(x.sym)
                claims[id(x)] = claim
                if x.rep or re.split(r"[.:@!]", x.sym)[0] in BLOCKS:
                    blocks.add(id(x))
                walk(x.items, (*path, id(x)), kinds | {claim} if claim else kinds, out or outside(x.sym), top or head(x.sym))

    walk(items, (), set(), False, False)
    mass = {k: max(0, facts[k][0] - 2 * facts[k][1]) if k in facts else 0 for k, _, _ in good}
    total = sum(mass.values())
    for kind in ("article", "main"):
        some = [k for k, _, kinds in good if kind in kinds]
        if some and (4 * sum(mass[k] for k in some) >= total):
            return some
    own = [(k, path) for k, path, _ in good if k not in facts or not (facts[k][2] or 2 * facts[k][1] > facts[k][0])]
    total = sum(mass[k] for k, _ in own)
    inside: dict[int, int] = {}
    for k, path in own:
        for x in path:
            inside[x] = inside.get(x, 0) + mass[k]
    best: tuple[int, ...] = ()
    for share, marked in ((0.6, True), (0.85, False)):
        for _, path in own:
            for depth in range(next((i for i, x in enumerate(path) if x in blocks), len(path)), 0, -1):
                if inside[path[depth - 1]] >= share * total and (not marked or claims[path[depth - 1]] == "marked"):
                    best = max(best, path[:depth], key=len)
                    break
        if best:
            break
    return [k for k, path in own if path[: len(best)] == best]


def host_of(url: Column) -> Column:
    """The host of an address, in lower case; empty where there is none."""
    return F.regexp_extract(F.lower(F.coalesce(url.cast("string"), F.lit(""))), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)


RUNS = "page_id string, url string, host string, form string, slots array<int>, texts array<string>, links array<int>"


def parsed(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """Pages as texts with slots of the page's own expression (`form`), written: see RUNS. A null html is empty."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), full_text(html).alias("html"))
    kinds = dict(rows.dtypes)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[str, str]] = {}
        for batch in batches:
            found = [Page(x, known) for x in batch["html"]]
            out = batch[["page_id", "url", "host"]].copy()
            out["form"] = [p.text for p in found]
            for i, name in enumerate(("slots", "texts", "links")):
                out[name] = [[run[i] for run in p.found] for p in found]
            yield out

    schema = RUNS.replace("page_id string, url string", f"page_id {kinds['page_id']}, url {kinds['url']}")
    out = rows.mapInPandas(parse, schema)
    return stored(out.withColumn("form_key", F.xxhash64("form", F.lit(1))).withColumn("form_id", F.concat_ws(":", F.xxhash64("form"), "form_key")).drop("form_key"), "parsed")


def inferred(forms: DataFrame) -> DataFrame:
    """One wrapper per host from `host` and `form`: columns `host`, `wrapper`. Expressions are aligned in their own order."""

    def align(group: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for text in sorted(set(group["form"])):
            items = read(text)
            whole = items if whole is None else aligned(whole, items)
        return pd.DataFrame({"host": group["host"][:1].values, "form": [written(whole)]})

    rows = forms.select("host", "form").distinct().withColumn("salt", F.pmod(F.xxhash64("form"), F.lit(SALTS)))
    first = rows.groupBy("host", "salt").applyInPandas(align, "host string, form string")
    return first.groupBy("host").applyInPandas(align, "host string, form string").withColumnRenamed("form", "wrapper")


def placed(forms: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Where the slots of each expression lie in its host's wrapper: `host`, `form_id`, `form`, `places`; -1 for nowhere."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for form, wrapper in zip(batch["form"], batch["wrapper"]):
                whole, items = read(wrapper), read(form)
                number = {id(x): i for i, x in enumerate(slots(whole))}
                mine = slots(items)
                aligned(whole, items)
                out.append([number.get(id(x.final()), -1) for x in mine])
            yield pd.DataFrame({"host": batch["host"], "form_id": batch["form_id"], "form": batch["form"], "places": out})

    return forms.join(wrappers, "host").mapInPandas(place, "host string, form_id string, form string, places array<int>")


def _judged(rows: DataFrame, expression: str) -> DataFrame:
    """Rows of (`host`, `form_id`, an expression, `facts`) with the chosen slots: `host`, `form_id`, `keep`."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, facts in zip(batch[expression], batch["facts"]):
                own = {int(f["slot"]): (int(f["letters"]), int(f["linked"]), bool(f["same"])) for f in facts}
                out.append(chosen(read(text), own))
            yield pd.DataFrame({"host": batch["host"], "form_id": batch["form_id"], "keep": out})

    return rows.mapInPandas(judge, "host string, form_id string, keep array<int>")


def decisions(runs: DataFrame) -> DataFrame:
    """For each host and expression the slots that are the article: `host`, `form_id`, `keep`."""
    forms = stored(runs.groupBy("host", "form_id").agg(F.first("form").alias("form")), "forms")
    wrappers = stored(inferred(forms), "wrappers")
    places = stored(placed(forms, wrappers), "places")
    each = runs.select("host", "form_id", F.xxhash64("texts").alias("page"), F.explode(F.arrays_zip("slots", "texts", "links")).alias("r"))
    text = F.xxhash64("r.texts")
    facts = each.groupBy("host", "form_id", F.col("r.slots").alias("slot")).agg(
        F.sum(F.length("r.texts")).alias("letters"), F.sum("r.links").alias("linked"), F.min(text).alias("low"), F.max(text).alias("high"),
        F.approx_count_distinct("page").alias("pages"),
    )
    facts = stored(facts, "facts")
    of_host = facts.join(places.select("host", "form_id", "places"), ["host", "form_id"]).groupBy("host", F.get("places", F.col("slot")).alias("slot")).agg(
        F.sum("letters").alias("letters"), F.sum("linked").alias("linked"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("pages").alias("pages")
    )
    same = ((F.col("low") == F.col("high")) & (F.col("pages") >= PAGES)).alias("same")
    listed = F.collect_list(F.struct("slot", "letters", "linked", "same")).alias("facts")
    of_host = of_host.select("host", "slot", "letters", "linked", same).groupBy("host").agg(listed)  # as many as the wrapper has slots
    main = _judged(wrappers.join(of_host, "host").withColumn("form_id", F.lit("")), "wrapper").select("host", F.col("keep").alias("main"))
    keep = F.filter(F.transform("places", lambda p, i: F.when(F.array_contains("main", p), i).otherwise(-1)), lambda i: i >= 0)
    kept = stored(places.join(main, "host").select("host", "form_id", "form", keep.alias("keep")), "kept")
    # pages of another build than most of their host are judged by themselves
    alone = facts.select("host", "form_id", "slot", "letters", "linked", F.lit(False).alias("same")).groupBy("host", "form_id").agg(listed)
    alone = _judged(kept.where(F.size("keep") == 0).drop("keep").join(alone, ["host", "form_id"]), "form")
    return kept.where(F.size("keep") > 0).select("host", "form_id", "keep").union(alone)


def main_texts(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """One row per page: `page_id`, `url`, `text` (the article's blocks, joined by line feeds), `n_chars` (its code points).

    Null and empty pages, and pages without an article, have the empty text. Pages without a host share one. Rows that
    repeat are reported as often as they stand there; an empty table gives none.
    """
    runs = parsed(pages, key, html, url)
    keep = stored(decisions(runs), "decisions")
    out = runs.join(keep, ["host", "form_id"], "left")
    blocks = F.filter(F.arrays_zip("slots", "texts"), lambda r: F.array_contains("keep", r["slots"]))
    text = F.coalesce(F.array_join(F.transform(blocks, lambda r: r["texts"]), "\n"), F.lit(""))
    return out.select("page_id", "url", text.alias("text")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
