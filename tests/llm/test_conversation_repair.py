import random
import re
from hashlib import sha256

import pytest

from lagline.llm.conversation_repair import AFTER, ENDS, NAMES, STEPS, WANTED, cheapest, composed, conversation_report, damaged, handed_down, searched

SCHEMA = "conv_id long, turn long, role string, text string, conv string, pos string, kind string"
SPACE = " \t\n\x0b\x0c\r"


def plain(codes):
    """(cost, least audit) by the recurrence over rows, every state's cheapest pair kept."""

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                best[AFTER[state]] = min(best.get(AFTER[state], (9e9, "")), (cost + 3, audit + "I"))
        return best

    best = {0: (0, "")}
    for code in codes:
        new = {}
        for state, (cost, audit) in inserted(best).items():
            ways = [(state, cost + 4, "D")]
            if code != "-":
                extra = 3 if code.isupper() else 0
                if (state, code.lower()) in STEPS:
                    ways.append((STEPS[state, code.lower()], cost + extra, "K"))
                ways.append((AFTER[state], cost + 3 + extra, "R"))
            for to, total, letter in ways:
                new[to] = min(new.get(to, (9e9, "")), (total, audit + letter))
        best = new
    return min(x for state, x in inserted(best).items() if state in ENDS)


def report(rows):
    """One conversation's expected row, from its rows in any order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, codes, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        body, first = text.rstrip(SPACE), role[:1] if role[:1] in tuple("sua") else "x"
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        codes += "-" if fault in ("blank", "duplicate") else first.upper() if fault else first
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = plain(codes)
    out, state, left = [], 0, list(rows)
    for letter in audit:
        _, role, text = (None, "", "") if letter == "I" else left.pop(0)
        if letter == "K":
            out.append(f"{role}:{text}")
            state = STEPS[state, role[:1]]
        elif letter != "D":
            out.append(f"{NAMES[WANTED[state]]}:{text}")
            state = AFTER[state]
    assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in out))
    return (gaps, *counts.values(), illegal, cost, audit, sha256("\n".join(out).encode()).hexdigest())


def test_search_is_exact():
    rng = random.Random(1)
    for _ in range(1500):
        codes = "".join(rng.choices("suaxSUAX-", weights=[1, 6, 6, 1, 1, 2, 2, 1, 3], k=rng.randrange(0, 14)))
        assert cheapest(codes) == plain(codes), codes


def test_blocks_compose():
    rng = random.Random(2)
    for _ in range(100):
        parts = ["".join(rng.choices("suaUA-x", k=rng.randrange(1, 5))) for _ in range(rng.randrange(2, 5))]
        found = [searched(p) for p in parts]
        whole = found[0]
        for f in found[1:]:
            whole = composed(whole, f)
        assert whole == searched("".join(parts)), parts
        for leave in range(4):
            if whole[0][leave] >= 0:
                ways = handed_down(found, 0, leave)
                cost, audit = cheapest("".join(parts), 0, (leave,), False)
                pieces = [cheapest(p, a, (b,), False) for p, (a, b) in zip(parts, ways)]
                assert audit == "".join(x[1] for x in pieces) and cost == sum(x[0] for x in pieces)


@pytest.mark.parametrize("size, fan", [(512, 256), (3, 2)])
def test_conversations(spark, size, fan):
    rng = random.Random(size)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.choice([0, 1, 2, 5, 9, 30])):
            turn = None if rng.random() < 0.05 else turn + (rng.random() < 0.1)
            role = rng.choices(["user", "assistant", "system", "tool", "users"], [6, 6, 1, 1, 1])[0]
            text = rng.choice(["Yes.", "No!", "A longer line\nof text?", "cut off", "", "  \t", "é. ", "one.", "two?\n", "three!"])
            rows += [(conv, turn, role, text, "x", "y", "z")] * rng.choices([1, 2], [9, 1])[0]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in conversation_report(df, size=size, fan=fan).collect()}
    want = {c: report([r[1:4] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want


def test_long_conversation(spark):
    """A conversation of many blocks and levels: as one search over all of its rows."""
    rng = random.Random(3)
    rows = [(7, i, rng.choices(["user", "assistant", "x"], [5, 5, 1])[0], rng.choice([f"{i}.", f"{i}", "", "same."])) for i in range(1500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = conversation_report(df, size=16, fan=4).collect()
    assert [tuple(r)[1:] for r in got] == [report([r[1:] for r in rows])]


def test_damage_and_odd_rows(spark):
    import zlib

    rows = [(c, t, "assistant", f"{c} {t}. Yes! No?") for c in (None, 1, 2) for t in (None, *range(20))]
    rows += [(9, 9, None, None)]
    got = {}
    for r in damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        bare = re.sub("[.!?]", "", text)
        want = {0: None, 1: [(role, "")], 2: [(role, bare)], 3: [(role, text)] * 2, 4: [("user", text)]}.get(kind, [(role, text)])
        assert got.get((c, t)) == want
    none = spark.createDataFrame([], SCHEMA)
    assert conversation_report(none, damaged(none)).count() == 0
    lost = spark.createDataFrame([(5, 1, "user", "Hi.", "", "", "")], SCHEMA)
    row = conversation_report(lost, none).first()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    long_ = spark.createDataFrame([(1, 1, "user", "w " * 500_000 + "."), (1, 2, "assistant", "ok.")], "conv_id long, turn long, role string, text string")
    assert conversation_report(long_).first().audit == "KK"
