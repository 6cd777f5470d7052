import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from fathomline.llm import ngram_lm as lm
from fathomline.llm.shared import settings


def tokens(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split() + [None]


def out(d):
    return d is not None and zlib.crc32(str(d).encode()) % 10 == 0


def brute(rows):
    """The same model, state by state, from plain dictionaries."""
    train = [tokens(t) for d, t in rows if not out(d)]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    p1 = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    least = max(2, int(n * lm.ARC_SHARE))
    within = lambda s: {w for w in c if c[w] >= max(2, n * s) and c[w] >= max(2, int(n * lm.WORD_SHARE))}
    in2, in3 = within(lm.BIGRAM_SHARE), within(lm.TRIGRAM_SHARE)
    c2 = Counter((a, b) for t in train for a, b in zip(t, t[1:]) if a in in2 and b in in2)
    c3 = Counter(g for t in train for g in zip(t, t[1:], t[2:]) if set(g) <= in3)
    c2 = {g: k for g, k in c2.items() if k >= least}
    c3 = {g: k for g, k in c3.items() if k >= least}

    def p2(w, a):
        if (a, w) in c2:
            return (c2[a, w] - lm.DISCOUNT) / c[a]
        seen = [b for x, b in c2 if x == a]
        return p1(w) * ((1 - sum(p2(b, a) for b in seen)) / (1 - sum(map(p1, seen))) if seen else 1)

    def p3(w, a, b):
        if (a, b, w) in c3:
            return (c3[a, b, w] - lm.DISCOUNT) / c2[a, b]
        seen = [z for x, y, z in c3 if (x, y) == (a, b)]
        return p2(w, b) * ((1 - sum(p3(z, a, b) for z in seen)) / (1 - sum(p2(z, b) for z in seen)) if seen else 1)

    result = []
    for d, text in rows:
        t = tokens(text)
        base = sum(math.log10(p1(w)) for w in t)
        score = sum(math.log10(p1(w) if i == 0 else p2(w, t[0]) if i == 1 else p3(w, t[i - 2], t[i - 1])) for i, w in enumerate(t))
        result.append((str(d), out(d), len(t), sum(c[w] > 0 for w in t), n, round(base, 6), round(score, 6)))
    return sorted(result)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, 1.0) for d, t in rows], "doc_id long, text string, score double").repartition(4)
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm.score_texts(df).collect())


@pytest.mark.parametrize("share", [2.0**-12, 0.004])
def test_against_brute_force(spark, monkeypatch, share):
    monkeypatch.setattr(lm, "ARC_SHARE", share)
    monkeypatch.setattr(lm, "WORD_SHARE", 0.002)
    r = random.Random(3)
    words = ["The", "the", "of", "É", "é", "to"] * 3 + [f"w{i}" for i in range(40)]
    rows = [(k, " ".join(r.choice(words) if r.random() < 0.9 else f"rare{r.randrange(200)}" for _ in range(r.randrange(30)))) for k in range(80)]
    rows += [(500, None), (501, ""), (None, "the of the"), (3, rows[3][1]), (3, rows[3][1]), (10, rows[3][1])]
    assert run(spark, rows) == brute(rows)


def test_a_state_sums_to_one():
    words = np.array([(int(k), n) for k, n in zip(lm.mix(np.arange(1, 6, dtype=np.uint64)), (50, 30, 20, 10, 5), strict=True)], lm.COUNTED)
    ids = np.arange(5)
    grams = np.array([(int(lm._key2(np.array([0]), np.array([w]))[0]), 8) for w in (1, 2)] + [(int(lm._key3(np.array([0]), np.array([1]), np.array([w]))[0]), 3) for w in (0, 2)], lm.COUNTED)
    total = 115 + 0.1 * (5 + 1)
    model = lm.build(words, 5, 5, grams, math.log10(total))
    for before in ([0], [0, 1], [3, 0]):
        stream = np.concatenate([words["key"][np.array([*before, w])] for w in ids] + [np.append(words["key"][np.array(before)], np.uint64(99))])
        first = np.arange(7) * (len(before) + 1)
        _, _, logs = model.run(stream, first)
        p = 10 ** logs[first[1:] - 1]
        p[-1] *= 0.1  # an unknown word: no count of its own
        assert abs(p.sum() - 1) < 1e-9


@pytest.mark.parametrize("share", [2.0**-19, 1.0])
def test_rare_repeated_n_grams_count(spark, monkeypatch, share):
    """No share of the corpus is asked of an n-gram; with 1.0 no weight is held by the tasks and all are looked up."""
    monkeypatch.setattr(lm, "GRAM_SHARE", share, raising=False)
    monkeypatch.setattr(lm, "WORD_SHARE", 2.0**-17 if share < 1 else 1.0)
    r = random.Random(5)
    rows = [(k, " ".join(f"w{r.randrange(400)}" for _ in range(60))) for k in range(400)]
    rows += [(k, f"{a} rare passage of five {b}") for k, a, b in ((1001, "x", "y"), (1002, "p", "q"), (1003, "x", "z"))]
    got = run(spark, rows)
    monkeypatch.setattr(lm, "WORD_SHARE", 0.0)
    monkeypatch.setattr(lm, "ARC_SHARE", 0.0)
    monkeypatch.setattr(lm, "BIGRAM_SHARE", 0.0)
    monkeypatch.setattr(lm, "TRIGRAM_SHARE", 0.0)
    assert got == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_slices_of_the_n_grams_share_them_out(spark):
    """Each slice sends a part of what is counted, and together they send all of it, once."""
    text = " ".join(f"w{k % 37} x{k}" for k in range(3000))
    batch = lm.pa.RecordBatch.from_pydict({"text": [text, text, None]})

    def sent(*slices):
        return Counter((kind, r) for out_ in lm._counts(8, *slices)([batch]) for kind, blob in zip(out_["kind"].to_pylist(), out_["blob"].to_pylist()) for r in np.frombuffer(blob, lm.GRAM).tolist())

    whole, parts = sent(), [sent(k, 4) for k in range(4)]
    assert sum(parts, Counter()) == whole and max(map(len, parts)) < 0.3 * len(whole)


def test_tables_of_n_grams_are_packed(spark, monkeypatch):
    """What lies on disk between the stages, in bytes of each n-gram that is kept; the score is that of all of them."""
    held = []

    def weighed(df):
        df = checkpointed(df)
        file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get().removeprefix("file:")
        held.append(sum(f.stat().st_size for f in Path(file).rglob("part-*")))
        return df

    checkpointed = lm.checkpointed
    monkeypatch.setattr(lm, "checkpointed", weighed)
    r = random.Random(7)
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(r.choices(words, k=400)) for _ in range(60)]
    rows = [(k, texts[k % 60]) for k in range(600) if not out(k)]
    run(spark, rows)
    train = [tokens(t) for _, t in rows]
    grams = len({g for t in train for n in (1, 2, 3) for g in zip(*(t[k:] for k in range(n)))})
    assert sum(held[: lm.COUNT_SLICES]) < 22 * grams


def test_an_n_gram_without_its_end_is_left_out():
    """Two n-grams that share a key may count as one seen twice, though the shorter ones were seen once."""
    low = np.array([(5, 0.5)], lm.LOW)
    tally = np.array([(9, 5, 2), (9, 7, 2)], lm.TALLY)
    batch = lm.pa.RecordBatch.from_pydict({"bucket": [0, 0], "kind": [0, 1], "blob": [low.tobytes(), tally.tobytes()]})
    sent = [r for b in lm._with_low(4)([batch]) for blob in b["blob"].to_pylist() for r in np.frombuffer(blob, lm.ARC).tolist()]
    assert sent == [(9, 5, 2, 0.5)]
    assert list(lm._with_low(4)([batch.slice(1)])) == []


def test_few_n_grams_are_dealt_by_few_tasks(spark, monkeypatch):
    """With many shuffle partitions a table of few n-grams is not cut into a blob for each task and bucket."""
    held = []

    def counted(df):
        df = checkpointed(df)
        held.append(df.count())
        return df

    checkpointed = lm.checkpointed
    monkeypatch.setattr(lm, "checkpointed", counted)
    r = random.Random(9)
    rows = [(k, " ".join(f"w{r.randrange(50)}" for _ in range(40))) for k in range(200)]
    with settings(spark, {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        assert run(spark, rows) == brute(rows)
    assert max(held[lm.COUNT_SLICES : lm.COUNT_SLICES + 2 * lm.ARC_SLICES]) <= 4 * 64


def test_a_count_of_one_is_not_sent():
    r = np.random.default_rng(5)
    left, right = r.integers(0, 1 << 63, (2, 50_000), dtype=np.uint64)
    n = np.where(r.random(50_000) < 0.9, 1, r.integers(2, 1 << 32, 50_000))
    record = lm._records(lm.GRAM, left=left, right=right, n=n)
    for chosen in (record, record[n == 1], record[n > 1], record[:1]):
        key = lm._keys(chosen, 3)
        by = np.argsort(key)
        rows = lm._dealt(key[by], chosen[by], 3, 200, single=True)
        ones = int((chosen["n"] == 1).sum())
        assert sum(map(len, rows["blob"].to_pylist())) == 16 * ones + 20 * (len(chosen) - ones) + 8 * rows.num_rows
        back = np.concatenate([x for _, _, x in lm._blobs([rows], {}, single=True)])
        assert back.dtype == lm.GRAM and sorted(back.tolist()) == sorted(chosen.tolist())


def test_requests_for_one_are_not_sent_with_a_count():
    key = np.array([7, 7, 7, 1 << 60, 9, 7], np.uint64)
    row = np.array([3, 3, -5, 4, 3, 3], np.int64)
    rows = lm._asked([(key[:3], row[:3]), (key[3:], row[3:])], 1)
    (found,) = (x.view(lm.ASKED) for _, _, x in lm._blobs([rows], {}, single=True))
    assert sum(x["n"] for x in found) == len(key) and len(rows["blob"][0].as_py()) == 8 + 16 * sum(found["n"] == 1) + 20 * sum(found["n"] > 1)
    assert {(k, r): int(found["n"][(found["key"] == k) & (found["row"] == r)].sum()) for k, r in zip(key.tolist(), row.tolist(), strict=True)} == {(7, 3): 3, (7, -5): 1, (1 << 60, 4): 1, (9, 3): 1}
