"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate.

A conversation is sound if the initials of its roles read `(s?(ua)+)?`. Rows may be kept, given another role, deleted, and
empty turns may be inserted. Edits are steps in a lattice of (rows read, state of that expression); its cheapest path is
found by bidirectional Dijkstra: a forward heap from the first node and a reverse heap from the last ones meet, all
crossings of equal cost are finished, and of these the one with the least concatenated audit is taken.

A conversation may hold any part of all rows. So rows are put in order by ranges, not by conversation, and cut into blocks
of bounded length. Most conversations are one block. For others every block is searched between all pairs of states; a
block's costs, and how the audits of one entry rank by exit, are all that composing blocks needs, so blocks are composed
in groups of bounded number, level by level, and the states chosen at the top are handed down the same way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagline.llm.common import small_batches, stored

ROWS = 512  # rows of a block
FAN = 256  # blocks that are composed at a time

# Fixed values of the result's contract: costs, roles, and what damage is done to which rows.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}
DAMAGES = 20

# States of `(s?(ua)+)?`: nothing yet, after s, after u, after ua. What an inserted or changed row must be in each state.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = "uuau"
AFTER = (2, 2, 3, 2)
ENDS = (0, 3)
TAIL = {0: "", 3: "", 2: "I", 1: "II"}  # cheapest way to an end without rows

# A row's code: its role's initial (x for others), in upper case if it is truncated; - if it must be deleted.


def forward_steps(codes: str, at: int, state: int, tail: bool) -> Iterator[tuple[str, int, int, int]]:
    """Edits from a node: (letter, cost, place, state)."""
    if at < len(codes):
        code = codes[at]
        yield "D", DELETE, at + 1, state
        if code != "-":
            extra = TRUNCATED if code.isupper() else 0
            kept = STEPS.get((state, code.lower()))
            if kept is not None:
                yield "K", extra, at + 1, kept
            yield "R", REROLE + extra, at + 1, AFTER[state]
    if at < len(codes) or tail:
        yield "I", INSERT, at, AFTER[state]


def reverse_steps(codes: str, at: int, state: int, tail: bool) -> Iterator[tuple[str, int, int, int]]:
    """Edits into a node: (letter, cost, place and state that they come from)."""
    if at > 0:
        code = codes[at - 1]
        yield "D", DELETE, at - 1, state
        if code != "-":
            extra = TRUNCATED if code.isupper() else 0
            for before in range(4):
                if STEPS.get((before, code.lower())) == state:
                    yield "K", extra, at - 1, before
                if AFTER[before] == state:
                    yield "R", REROLE + extra, at - 1, before
    if at < len(codes) or tail:
        for before in range(4):
            if AFTER[before] == state:
                yield "I", INSERT, at, before


class Side:
    """One of the two searches: costs and least audits of its nodes, and which of them are settled."""

    def __init__(self, sources: list[tuple[int, int]], sign: int):
        self.sign = sign
        self.cost = {node: 0 for node in sources}
        self.audit = {node: "" for node in sources}
        self.heap = [(0, sign * node[0], node[1]) for node in sorted(sources)]
        self.settled: set[tuple[int, int]] = set()

    def least(self) -> float:
        """The least cost that is not settled; what is left of settled nodes in the heap goes."""
        while self.heap and (self.sign * self.heap[0][1], self.heap[0][2]) in self.settled:
            heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self) -> tuple[int, int]:
        _, place, state = heappop(self.heap)
        self.settled.add((self.sign * place, state))
        return self.sign * place, state

    def offer(self, node: tuple[int, int], cost: int, audit: str) -> None:
        """Nodes of equal cost are settled in the direction of travel, so all their audits are known by then."""
        known = self.cost.get(node)
        if known is None or cost < known:
            self.cost[node], self.audit[node] = cost, audit
            heappush(self.heap, (cost, self.sign * node[0], node[1]))
        elif cost == known and audit < self.audit[node]:
            self.audit[node] = audit


def cheapest(codes: str, entry: int = 0, exits: tuple[int, ...] = ENDS, tail: bool = True) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest edits from `entry` before the first row to one of `exits` after the last.

    Without `tail` nothing is inserted after the last row. None if there is no way.
    """
    ahead, back = Side([(0, entry)], 1), Side([(len(codes), state) for state in exits], -1)
    best = float("inf")
    while (near := ahead.least()) + (far := back.least()) <= best and near + far < float("inf"):
        if near <= far:
            node = ahead.settle()
            for letter, cost, *to in forward_steps(codes, *node, tail):
                ahead.offer(tuple(to), ahead.cost[node] + cost, ahead.audit[node] + letter)
        else:
            node = back.settle()
            for letter, cost, *to in reverse_steps(codes, *node, tail):
                back.offer(tuple(to), back.cost[node] + cost, letter + back.audit[node])
        if node in ahead.cost and node in back.cost:
            best = min(best, ahead.cost[node] + back.cost[node])
    if best == float("inf"):
        return None
    # a cheapest path has a step from a node settled ahead to one settled back, or one side has settled all of it
    found = [back.audit[n] for n in [(0, entry)] if n in back.settled and back.cost[n] == best]
    found += [ahead.audit[n] for n in ((len(codes), q) for q in exits) if n in ahead.settled and ahead.cost[n] == best]
    for node in ahead.settled:
        for letter, cost, *to in forward_steps(codes, *node, tail):
            far = tuple(to)
            if far in back.settled and ahead.cost[node] + cost + back.cost[far] == best:
                found.append(ahead.audit[node] + letter + back.audit[far])
    return int(best), min(found)


NONE = -1  # no way between two states


def searched(codes: str) -> tuple[list[int], list[int]]:
    """Of a block: costs from each entry to each exit, and the ranks of their audits among the exits of one entry.

    A block ends with its last row, so of two audits of one entry neither begins with the other: ranks decide which of
    two compositions has the lesser audit.
    """
    costs, ranks = [], []
    for entry in range(4):
        found = [cheapest(codes, entry, (leave,), False) for leave in range(4)]
        order = sorted(x[1] for x in found if x)
        costs += [x[0] if x else NONE for x in found]
        ranks += [order.index(x[1]) if x else NONE for x in found]
    return costs, ranks


def _through(a: tuple[list[int], list[int]], b_costs: list[int], entry: int, leave: int) -> tuple[int, int, int] | None:
    """The best state between two neighbours: (cost, rank of the first one's audit, state)."""
    ways = [
        (a[0][4 * entry + m] + b_costs[4 * m + leave], a[1][4 * entry + m], m)
        for m in range(4) if a[0][4 * entry + m] != NONE and b_costs[4 * m + leave] != NONE
    ]
    return min(ways) if ways else None


def composed(a: tuple[list[int], list[int]], b: tuple[list[int], list[int]]) -> tuple[list[int], list[int]]:
    """Costs and ranks of two neighbours as one block."""
    costs, ranks = [NONE] * 16, [NONE] * 16
    for entry in range(4):
        keys = {}
        for leave in range(4):
            way = _through(a, b[0], entry, leave)
            if way:
                costs[4 * entry + leave] = way[0]
                keys[leave] = (way[1], b[1][4 * way[2] + leave])
        order = sorted(set(keys.values()))
        for leave, key in keys.items():
            ranks[4 * entry + leave] = order.index(key)
    return costs, ranks


def handed_down(parts: list[tuple[list[int], list[int]]], entry: int, leave: int) -> list[tuple[int, int]]:
    """Entry and exit of each of the neighbours that were composed, for the entry and exit of the whole."""
    rest = [parts[-1][0]]
    for costs, _ in reversed(parts[:-1]):
        after = rest[-1]
        rest.append([
            min((costs[4 * q + m] + after[4 * m + r] for m in range(4) if costs[4 * q + m] != NONE and after[4 * m + r] != NONE), default=NONE)
            for q in range(4) for r in range(4)
        ])
    rest.reverse()
    out = []
    for i, part in enumerate(parts):
        to = leave if i == len(parts) - 1 else _through(part, rest[i + 1], entry, leave)[2]
        out.append((entry, to))
        entry = to
    return out


def _conv(key: Column) -> Column:
    return F.coalesce(F.concat(F.lit("c"), key.cast("string")), F.lit(""))


def damaged(conversations: DataFrame) -> DataFrame:
    """Fixed by the result's contract: the rows after damage that depends on conversation and turn. Nulls are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % DAMAGES
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("_kind"))
    body = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.where(F.col("_kind") != 0).select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), body.alias("text"), F.explode(copies)
    )
    return rows.drop("col")


def ordered(conversations: DataFrame) -> DataFrame:
    """The rows, written in order: `conv` (a text that names the conversation, null ones too), `pos`, `turn`, `role`, `text`.

    Rows of a conversation have consecutive `pos` within a task, by turn (nulls first), role and text; nulls are one
    space. Ranges are cut by the beginnings of the texts, so a conversation of any size spreads over many tasks.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(_conv(F.col("conv_id")).alias("conv"), "turn", text("role").alias("role"), text("text").alias("text"))
    rows = rows.withColumns({"_r": F.left("role", F.lit(16)), "_t": F.left("text", F.lit(32))})
    rows = rows.repartitionByRange("conv", F.col("turn").asc_nulls_first(), "_r", "_t").drop("_r", "_t")
    rows = rows.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    return stored(rows.withColumn("pos", F.monotonically_increasing_id()), "ordered")


def with_faults(rows: DataFrame) -> DataFrame:
    """Per row: `conv`, `pos`, `turn`, `initial`, its first `fault` (blank, duplicate, truncated or null) and its `code`."""
    last = F.right(F.rtrim("text", F.lit("\t\n\x0b\f\r ")), F.lit(1))
    name = F.substring(F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)), 1, 16)
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x")
    slim = rows.select(
        "conv", "pos", "turn", initial.alias("initial"), last.alias("last"), name.alias("name"),
    )
    slim = slim.withColumns({"blank": F.col("last") == "", "cut": ~F.col("last").isin(".", "!", "?")}).drop("last")
    # the first of equal rows, by its own place: places are met by one row each, however many rows are equal
    first = slim.where(~F.col("blank")).groupBy("conv", "name").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    out = slim.join(first, "pos", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    out = out.select("conv", "pos", "turn", "initial", fault.alias("fault"))
    code = F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    return out.withColumn("code", code)


def blocks_of(faults: DataFrame, size: int = ROWS) -> DataFrame:
    """Runs of up to `size` rows: `conv`, `nr` (in the conversation), `n_blocks`, `pos` of the first row, `codes`, and counts."""
    flat = lambda field: F.array_join(F.transform("rows", lambda r: r[field]), "")
    count = lambda kind: F.count_if(F.col("fault") == kind).alias(kind)
    runs = faults.groupBy("conv", F.expr(f"pos div {size}").alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "code", "initial"))).alias("rows"), count("blank"), count("duplicate"), count("truncated")
    )
    runs = runs.select("conv", F.col("rows")[0]["pos"].alias("pos"), flat("code").alias("codes"), flat("initial").alias("initials"), "blank", "duplicate", "truncated")
    mine = Window.partitionBy("conv").orderBy("pos")
    whole = Window.partitionBy("conv")
    runs = runs.withColumns({
        "nr": F.row_number().over(mine) - 1, "n_blocks": F.count(F.lit(1)).over(whole),
        "line": F.concat(F.coalesce(F.lag(F.right("initials", F.lit(1))).over(mine), F.lit("")), "initials"),
    })
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length("line") - 1, F.lit(1))), lambda i: F.substring("line", i, 2))
    illegal = F.size(F.filter(pairs, lambda p: (F.length(p) == 2) & ~p.isin("su", "ua", "au")))
    return runs.withColumn("illegal", illegal.cast("long")).drop("line", "initials")


MATRIX = "cost array<int>, rank array<int>"


def _matrices(blocks: DataFrame) -> DataFrame:
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple] = {}
        for batch in batches:
            found = []
            for codes in batch["codes"]:
                if codes not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[codes] = searched(codes)
                found.append(known[codes])
            yield pd.DataFrame({"conv": batch["conv"], "nr": batch["nr"], "cost": [x[0] for x in found], "rank": [x[1] for x in found]})

    return blocks.select("conv", "nr", "codes").mapInPandas(search, f"conv string, nr int, {MATRIX}")


def _parts(group: pd.DataFrame) -> list[tuple[list[int], list[int]]]:
    return [([int(x) for x in c], [int(x) for x in r]) for c, r in zip(group["cost"], group["rank"])]


def _choices(blocks: DataFrame, fan: int) -> DataFrame:
    """Entry, exit and tail of every block of the conversations that have more than one: `conv`, `nr`, `enter`, `leave`, `total`."""

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("nr")
        parts = _parts(group)
        whole = parts[0]
        for part in parts[1:]:
            whole = composed(whole, part)
        return pd.DataFrame({"conv": group["conv"][:1].values, "nr": [int(group["nr"].iloc[0]) // fan], "cost": [whole[0]], "rank": [whole[1]]})

    def top(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv, costs, ranks in zip(batch["conv"], batch["cost"], batch["rank"]):
                ways = [(costs[q] + INSERT * len(TAIL[q]), ranks[q], q) for q in range(4) if costs[q] != NONE]
                total, _, leave = min(ways)
                rows.append((conv, 0, 0, leave, int(total)))
            yield pd.DataFrame(rows, columns=["conv", "nr", "enter", "leave", "total"])

    def descend(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("nr")
        ways = handed_down(_parts(group), int(group["enter"].iloc[0]), int(group["leave"].iloc[0]))
        return pd.DataFrame({
            "conv": group["conv"].values, "nr": group["nr"].values, "enter": [a for a, _ in ways], "leave": [b for _, b in ways], "total": group["total"].values,
        })

    levels = [stored(_matrices(blocks), "matrices")]
    while (levels[-1].agg(F.max("nr")).first()[0] or 0) > 0:
        above = F.expr(f"int(nr div {fan})")
        levels.append(stored(levels[-1].groupBy("conv", above.alias("up")).applyInPandas(fold, f"conv string, nr int, {MATRIX}"), "composed"))
    chosen = levels.pop().mapInPandas(top, "conv string, nr int, enter int, leave int, total long")
    while levels:
        above = chosen.withColumnRenamed("nr", "up")
        met = levels.pop().withColumn("up", F.expr(f"int(nr div {fan})")).join(above, ["conv", "up"])
        chosen = stored(met.groupBy("conv", "up").applyInPandas(descend, "conv string, nr int, enter int, leave int, total long"), "chosen")
    return chosen


def audits(blocks: DataFrame, fan: int = FAN) -> DataFrame:
    """The cheapest edits, block by block: `conv`, `nr`, `pos`, `audit` (letters of the edits in order), `total` cost of the conversation."""

    def edit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple, tuple[int, str]] = {}
        for batch in batches:
            out = []
            for codes, enter, leave, last in zip(batch["codes"], batch["enter"], batch["leave"], batch["last"]):
                key = (codes, enter, leave, last)
                if key not in known:
                    if len(known) > 100_000:
                        known.clear()
                    if leave < 0:  # the whole conversation
                        known[key] = cheapest(codes)
                    else:
                        cost, audit = cheapest(codes, enter, (leave,), False)
                        known[key] = cost, audit + (TAIL[leave] if last else "")
                out.append(known[key])
            total = [a if t < 0 else t for (a, _), t in zip(out, batch["total"])]
            yield pd.DataFrame({"conv": batch["conv"], "nr": batch["nr"], "pos": batch["pos"], "audit": [x for _, x in out], "total": total})

    schema = "conv string, nr int, pos long, audit string, total long"
    last = (F.col("nr") == F.col("n_blocks") - 1).alias("last")
    one = blocks.where("n_blocks = 1").select("conv", "nr", "pos", "codes", last, *[F.lit(-1).alias(c) for c in ("enter", "leave")], F.lit(-1).cast("long").alias("total"))
    if blocks.where("n_blocks > 1").isEmpty():
        return one.mapInPandas(edit, schema)
    many = stored(blocks.where("n_blocks > 1").select("conv", "nr", "pos", "codes", last), "long")
    chosen = _choices(many, fan)
    rest = many.join(chosen, ["conv", "nr"]).select(*one.columns)
    return one.union(rest).mapInPandas(edit, schema)


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The rows after the edits, in order within each task: `conv`, `role`, `text`.

    A conversation's rows stream through one task in their order; none of them are held but the current block's audit.
    """
    small_batches(rows.sparkSession)
    events = edits.select("conv", "pos", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    both = rows.select("conv", "pos", F.lit(1).alias("kind"), "role", "text").union(events)
    both = both.repartition("conv").sortWithinPartitions("conv", "pos", "kind")

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, pieces, tail = None, 0, iter(()), ""
        for batch in batches:
            out: list[tuple[str, str, str]] = []
            for conv, kind, role, text in zip(batch["conv"], batch["kind"], batch["role"], batch["text"]):
                if kind == 0:  # a block's audit: inserts before each row and what becomes of it, and inserts at the end
                    state = state if conv == now else 0
                    now, body = conv, text.rstrip("I")
                    pieces, left, tail = iter(re.findall("I*[DKR]", body)), body.count("D") + body.count("K") + body.count("R"), text[len(body):]
                    continue
                piece = next(pieces)
                left -= 1
                for letter in piece + ("" if left else tail):
                    if letter == "D":
                        continue
                    if letter == "K":
                        out.append((conv, role, text))
                        state = STEPS[state, role[:1]]
                    else:
                        out.append((conv, NAMES[WANTED[state]], text if letter == "R" else ""))
                        state = AFTER[state]
            yield pd.DataFrame(out, columns=["conv", "role", "text"])

    return both.mapInPandas(apply, "conv string, role string, text string")


def digests(lines: DataFrame) -> DataFrame:
    """SHA-256 of `role:text`, joined by line feeds: `conv`, `digest`. The rows of a conversation follow each other in one task."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, running = None, None
        for batch in batches:
            out = []
            for conv, role, text in zip(batch["conv"], batch["role"], batch["text"]):
                if conv == now:
                    running.update(b"\n")
                else:
                    if running:
                        out.append((now, running.hexdigest()))
                    now, running = conv, sha256()
                running.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            yield pd.DataFrame(out, columns=["conv", "digest"])
        if running:
            yield pd.DataFrame([(now, running.hexdigest())], columns=["conv", "digest"])

    return lines.mapInPandas(digest, "conv string, digest string")


def conversation_report(conversations: DataFrame, changed: DataFrame | None = None, size: int = ROWS, fan: int = FAN) -> DataFrame:
    """One row per conversation of the first table: what is wrong with its rows in `changed` (the same by default), and the repair.

    Columns `conv_id`, `gaps`, `blank`, `duplicate`, `truncated`, `illegal`, `cost`, `audit`, `repaired_sha256`. A null
    conv_id is a conversation of its own; null turns come first and count for no gap; null roles and texts are one space;
    rows of one turn are taken by role and text. Without rows all counts are zero and the audit is empty.
    """
    rows = ordered(conversations if changed is None else changed)
    faults = stored(with_faults(rows), "faults")
    blocks = stored(blocks_of(faults, size), "blocks")
    edits = stored(audits(blocks, fan), "audits")
    digest = digests(repaired(rows, edits))
    turns = faults.groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    )
    counts = blocks.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    lines = edits.groupBy("conv").agg(
        F.first("total").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nr", "audit"))), lambda x: x["audit"]), "").alias("audit")
    )
    out = conversations.groupBy("conv_id").agg(F.lit(1)).select("conv_id", _conv(F.col("conv_id")).alias("conv"))
    for part in (turns, counts, lines, digest):
        out = out.join(part, "conv", "left")
    whole = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        "conv_id", *[whole(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
