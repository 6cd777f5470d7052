import math
import random
import time

from fathomline.llm.toxicity import Model, _grouped, drop_toxic, score_toxicity, segments


def brute_segments(scores):
    """Ruzzo and Tompa's definition: take the best segment (shortest, leftmost), then look left and right of it."""
    out = []

    def solve(a, b):
        best = max(((round(sum(scores[i:j]), 9), i - j, -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return
        i = -best[2]
        j = i - best[1]
        solve(a, i)
        out.append((i, j, best[0]))
        solve(j, b)

    solve(0, len(scores))
    return out


def test_segments_are_all_maximal_segments():
    r = random.Random(8)
    for _ in range(300):
        n = r.randrange(1, 22)
        scores = [-0.37] * n
        places = sorted(r.sample(range(n), r.randrange(0, n + 1)))
        weights = [r.choice([1.13, 0.41, 2.71, -0.59]) for _ in places]
        for p, w in zip(places, weights, strict=True):
            scores[p] = w
        assert [(a, b, round(s, 9)) for a, b, s in segments(places, weights, -0.37)] == brute_segments(scores)


def corpus(n):
    r = random.Random(4)
    rows, labels = [], []
    for k in range(n):
        w = [f"w{r.randrange(300)}" for _ in range(r.randrange(20, 80))]
        if bad := k % 6 == 0:
            for _ in range(6):
                w.insert(r.randrange(len(w)), r.choice(["Vile", "rotten,", "nastyish", "nastyness", "nastyful"]))
        rows.append((k, " ".join(w), "x"))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_edges(spark):
    rows, labels = corpus(900)
    rows += [(5000, None, "x"), (5001, "", "x"), (None, "Vile rotten nastyness " * 4, "x"), (7, rows[7][1], "x"), (5002, "w1 " * 5000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    marks = spark.createDataFrame([*labels, (7, 1, 0), (8, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = score_toxicity(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {d: t for d, _, t in labels}
    held = [r for r in got if r.held_out and r.row.doc_id in truth]
    assert len(held) > 100 and sum(r.predicted == truth[r.row.doc_id] for r in held) >= 0.98 * len(held)
    by = {r.row.doc_id: r.predicted for r in got}
    assert (by[5000], by[5001], by[5002], by[None]) == (0, 0, 0, 1)
    kept = drop_toxic(docs, marks)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_texts_that_share_a_word_are_all_learnt_from(spark):
    r = random.Random(6)
    common = [f"c{k}" for k in range(200)]  # in every text, so that all have the same least word hash
    rows, labels = [], []
    for k in range(400):
        w = [*common, *(f"w{r.randrange(300)}" for _ in range(30))]
        if k % 4 == 0:
            w += ["vile", "rotten"]
        r.shuffle(w)
        rows.append((k, " ".join(w)))
        labels.append((k, int(k % 4 == 0)))
    rows += [(k + 1000, rows[k][1].upper() + " ") for k in range(400)]
    labels += [(k + 1000, t) for k, t in labels]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {row.row.doc_id: row.predicted for row in score_toxicity(docs, marks).collect()}
    truth = dict(labels)
    assert sum(got[d] == truth[d] for d in got) >= 0.98 * len(got)
    texts = docs.join(marks, "doc_id").select("text", "toxic").mapInArrow(_grouped, "text string, toxic int, kin long")
    assert texts.select("kin", "toxic").distinct().count() == 400


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in score_toxicity(docs, marks).collect()] == [0, 0]
    assert score_toxicity(docs.limit(0), marks).collect() == []
    assert math.isclose(Model().curve[0], -30)


def test_segments_take_linear_time():
    r = random.Random(6)
    took = []
    for n in (20_000, 200_000):
        places = [20 * k for k in range(n)]
        weights = [r.choice([0.5, 3.0, 25.0]) for _ in places]
        began = time.perf_counter()
        found = segments(places, weights, -0.9)
        took.append(time.perf_counter() - began)
        assert all(a < b for a, b, _ in found) and all(x[1] <= y[0] for x, y in zip(found, found[1:]))
    assert took[1] < 40 * max(took[0], 0.02)


def test_drop_toxic_with_clashing_names(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame([(d, t, d, "s", "c") for d, t, _ in rows], "doc_id long, text string, _id long, score string, `a.b` string")
    kept = drop_toxic(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == docs.columns and kept.where("_id <> doc_id OR score <> 's'").isEmpty()
