import math
import random

from lagline.llm.ball_tree import nearest, top_k


def plain(rows, every, k):
    good = []
    for key, v in rows:
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((key, [math.floor(1024 * x) for x in v]))
    out = []
    for i, (q, v) in enumerate(good):
        if q % every == 0:
            dots = ((sum(a * b for a, b in zip(v, w)), c) for j, (c, w) in enumerate(good) if j != i and len(w) == len(v))
            scored = sorted((-max(-(2**63), min(2**63 - 1, s)), c) for s, c in dots)[:k]
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scored)]
    return sorted(out)


def test_matches_plain_search(spark):
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)]) for i in range(700)]
    rows += [(i, rows[3][1]) for i in range(700, 720)]  # ties
    rows += [(720, None), (730, [1.0, None, 0, 0, 0, 0]), (740, [math.nan] * 6), (750, [math.inf] * 6), (None, [1.0] * 6)]
    rows += [(760, [0.5, 0.5]), (770, [0.25, -1.0]), (780, []), (0, rows[0][1]), (790, [1e15, -1e15, 0.0, 0, 0, 0])]
    df = spark.createDataFrame([(k, v and [None if x is None else float(x) for x in v] if v else v) for k, v in rows], "vec_id long, embedding array<double>")
    want = plain(rows, 10, 4)
    got = nearest(df, 10, 4).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want


def test_waves_and_blocks(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(-9, 9)) for _ in range(4)]) for i in range(500)]
    df = spark.createDataFrame([(i, i, v) for i, v in rows], "row long, vec_id long, v array<double>")
    got = top_k(df, df.where("vec_id % 7 = 0"), 5, shard_rows=60, block_rows=20).collect()
    want = plain([(i, [x / 1024 for x in v]) for i, v in rows], 7, 5)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want
    assert nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), 10).count() == 0


def test_repeated_ids_and_clashing_names(spark):
    """Rows that share an id, a third of all of them, stay rows of their own; equal ones are ties."""
    rng = random.Random(3)
    rows = [(20 if i % 3 == 0 else i, [float(rng.randrange(-4, 4)) for _ in range(3)]) for i in range(90)]
    rows += [(20, rows[0][1]), (20, rows[0][1]), (40, [9.0, 9.0, 9.0]), (40, [-9.0, -9.0, -9.0])]
    names = ("row", "own", "own_row", "query_row", "query_id", "rank", "score", "v", "shard", "least")
    df = spark.createDataFrame([(k, v, *["x"] * len(names)) for k, v in rows], "vec_id long, embedding array<double>, " + ", ".join(f"{n} string" for n in names))
    got = nearest(df, 20, 5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 20, 5)
