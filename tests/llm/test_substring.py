import hashlib
import random
from collections import Counter

import pytest

from fathomline.llm.substring import levels, remove_repeated_windows


def brute(rows, window):
    docs = [(d, (t or "").encode().split()) for d, t in rows]
    seen = Counter(tuple(w[i : i + window]) for _, w in docs for i in range(len(w) - window + 1))
    out = []
    for d, w in docs:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, window, base=9):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, found string").repartition(3)
    return sorted(map(tuple, remove_repeated_windows(df, window, base).collect()), key=str)


def test_levels():
    assert levels(35, 9) == [9, 18, 35]
    assert levels(7, 9) == [7]


@pytest.mark.parametrize("window,base", [(35, 9), (12, 3), (5, 9)])
def test_against_brute_force(spark, window, base):
    r = random.Random(window)
    word = lambda: r.choice("ab cde é fgh ij the of and".split()) + r.choice(["", "", str(r.randrange(40))])
    passage = [word() for _ in range(60)]
    rows = []
    for k in range(60):
        w = [word() for _ in range(r.randrange(1, 150))]
        if k % 3 == 0:
            at, a = r.randrange(len(w)), r.randrange(20)
            w[at:at] = passage[a : a + r.randrange(window - 2, 40 + window)]
        rows.append((k, r.choice([" ", "\n", "\t ", "\x0b"]).join(w)))
    rows += [(100, rows[3][1]), (100, rows[3][1]), (None, rows[6][1]), (101, None), (102, ""), (103, "aa " * 300), (104, " \n "), (105, " ".join(["x", "y"] * 200)), (106, "a b " * 50)]
    assert run(spark, rows, window, base) == brute(rows, window)


def test_empty_table(spark):
    assert run(spark, [], 35) == []
