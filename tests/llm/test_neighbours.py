import itertools
import math
import random

import numpy as np

from fathomline.llm.neighbours import fit, hilbert, search


def test_hilbert_visits_neighbouring_cells():
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        keys = hilbert(points, bits)
        assert sorted(keys.tolist()) == list(range(len(points)))
        path = points[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def brute(rows, every, k):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 12:
            ok[i] = np.array(v)
    out = set()
    for q in ok:
        if q % every == 0:
            s = sorted((-float((ok[i] * ok[q]).sum() / (np.sqrt((ok[i] ** 2).sum()) * np.sqrt((ok[q] ** 2).sum()))), i) for i in ok if i != q)
            out |= {(q, r + 1, i, round(-c, 12)) for r, (c, i) in enumerate(s[:k])}
    return out


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(4)
    return {(r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in search(df, **more).collect()}


def fixture(n):
    r = random.Random(6)
    centres = [[r.gauss(0, 1) for _ in range(12)] for _ in range(20)]
    rows = [(k, [c + r.gauss(0, 0.3) for c in centres[k % 20]]) for k in range(n)]
    rows += [(10_000 + k, centres[0]) for k in range(300)]  # one very common vector
    return [*rows, (50_000, None), (50_050, []), (50_100, [0.0] * 12), (50_150, [float("nan")] * 12), (50_200, [1.0, None] + [0.0] * 10), (50_250, [1.0] * 3), (None, [1.0] * 12), (0, rows[0][1])]


def test_recall(spark):
    rows = fixture(2500)
    want = brute(rows, 50, 5)
    got = run(spark, rows)
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_exact_where_windows_hold_all(spark):
    rows = fixture(60)
    assert run(spark, rows, ranges=1) == brute(rows, 50, 5)


def test_lengths_and_repeated_ids(spark):
    r = random.Random(13)
    vector = lambda n: [r.gauss(0, 1) for _ in range(n)]
    rows = [(k, vector(12)) for k in range(40)] + [(1000 + k, vector(7)) for k in range(0, 60, 10)] + [(k, vector(12)) for k in (3, 4, 5, 50, 50)]
    want = {}
    for q, a in rows:
        for i, b in rows:
            if q % 50 == 0 and i != q and len(a) == len(b):
                c = float((np.array(a) * b).sum() / (np.linalg.norm(a) * np.linalg.norm(b)))
                want[q, i] = max(c, want.get((q, i), -2.0))
    got = run(spark, rows)
    for q in {q for q, _ in want}:
        best = sorted((-c, i) for (p, i), c in want.items() if p == q)[:5]
        assert [(i, round(-c, 9)) for c, i in best] == [(i, round(c, 9)) for _, _, i, c in sorted(x for x in got if x[0] == q)]
    assert {x[0] for x in got} == {q for q, _ in want}


def test_few_and_none(spark):
    assert run(spark, []) == set()
    assert run(spark, [(0, [1.0] * 12)]) == set()
    assert run(spark, [(0, [1.0] * 12), (1, [1.0] * 12)]) == {(0, 1, 1, 1.0)}


def test_small_tables_are_seen_whole(spark):
    r = random.Random(9)
    for n in (3, 8, 18):
        rows = [(k * 50, [r.gauss(0, 1) for _ in range(12)]) for k in range(n)]
        assert run(spark, rows) == brute(rows, 50, 5)


def test_ranges_beside_a_hot_vector_hold_rows():
    r = np.random.default_rng(4)
    x = np.concatenate([np.tile(r.normal(size=12), (600, 1)), r.normal(size=(400, 12))])
    curves = fit(x, np.arange(1000), 1000, 4, 32, 5)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for o in range(4):
        at = curves.ranges(unit, o)
        assert set(at) == set(range(len(curves.parts[o])))
        hot = at[0]
        assert all(low <= hot < high for low, high in curves.spans[o][max(hot - 1, 0) : hot + 2])
