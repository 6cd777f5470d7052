import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from fathomline.llm import decontaminate
from fathomline.llm.decontaminate import drop_contaminated, mark_contamination
from fathomline.llm.shared import settings


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items, window=13):
    grams = {}
    for i, t in items:
        w = words(t)
        if not w:
            continue
        for k in range(max(len(w) - window + 1, 1)):
            grams.setdefault(tuple(w[k : k + window]), set()).update([] if i is None else [str(i)])
    out = []
    for d, t in rows:
        w = words(t)
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in grams:
                    hit |= set(range(k, k + n))
                    found |= grams[g]
        ids = sorted(found)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def fixture():
    r = random.Random(2)
    word = lambda: r.choice("The of É é straße a1 Σας x İy K k on at".split()) + r.choice(["", "", str(r.randrange(9))])
    items = [(k, " ".join(word() for _ in range(r.randrange(1, 40)))) for k in range(25)] + [(30, ""), (31, None), (None, "of at on"), (32, "..."), (3, "x y z zz zy")]
    rows = []
    for k in range(80):
        t = [word() for _ in range(r.randrange(0, 200))]
        if k % 2:
            b = (items[r.randrange(25)][1]).split()
            at = r.randrange(len(t) + 1)
            t[at:at] = b[r.randrange(len(b)) :] if k % 4 == 1 else b
        rows.append((k, r.choice([" ", ", ", "\n", "-"]).join(t)))
    return [*rows, (5, rows[5][1]), (5, "other text"), (None, rows[7][1]), (90, None), (91, ""), (92, "the of " * 4000)], items


def frames(spark, rows, items):
    return spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, known int").repartition(4), spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force_both_joins(spark, monkeypatch):
    rows, items = fixture()
    docs, bench = frames(spark, rows, items)
    for most in (1 << 20, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", most)
        got = sorted((tuple(r)[:6] for r in mark_contamination(docs, bench).collect()), key=str)
        assert got == brute(rows, items)


def test_drop_keeps_columns_and_clean_rows(spark):
    rows, items = fixture()
    docs, bench = frames(spark, rows, items)
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((x for x in rows if not brute([x], items)[0][5]), key=str)


def test_windows_of_an_item_without_id_count(spark):
    docs, bench = frames(spark, [(1, "a b c d"), (2, "x y")], [(None, "b c"), (4, "c d")])
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256) for r in mark_contamination(docs, bench).collect()}
    assert got == {1: (3, 1, hashlib.sha256(b"4").hexdigest()), 2: (0, 0, hashlib.sha256(b"").hexdigest())}


def test_a_text_of_a_megabyte_and_many_lengths(spark):
    r = random.Random(3)
    items = [(n, " ".join(f"q{n}x{j}" for j in range(n))) for n in range(1, 15)]
    long = [f"w{r.randrange(9000)}" for _ in range(180_000)]
    long[170_000:170_000] = items[9][1].split() + items[13][1].split()
    docs, bench = frames(spark, [(1, " ".join(long))], items)
    began = time.time()
    (row,) = mark_contamination(docs, bench).collect()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (180_024, 24, 2, False)
    assert time.time() - began < 60


def test_drop_with_clashing_names(spark):
    names = ["id", "hash", "row", "bad_id", "bad_hash", "known", "gram", "a.b"]
    rows = [(1, "one two three four", *names), (2, None, *names), (None, "five six", *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    bench = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    assert sorted(map(tuple, drop_contaminated(docs, bench).collect()), key=str) == sorted(rows[1:], key=str)


def test_empty_tables(spark):
    rows, items = fixture()
    docs, bench = frames(spark, rows, items)
    assert mark_contamination(docs.limit(0), bench).collect() == []
    assert not any(r.contaminated for r in mark_contamination(docs, bench.limit(0)).collect())


def test_the_sieve_takes_as_many_jobs_on_many_partitions(spark):
    _, items = fixture()
    _, bench = frames(spark, [(1, "a")], items)
    context, store = spark.sparkContext, spark.sparkContext._jsc.sc().statusStore()
    latest = lambda: max((store.jobsList(None).apply(k).jobId() for k in range(store.jobsList(None).size())), default=-1)
    taken = []
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}):
        grams = decontaminate.benchmark_windows(bench)
        for slots in (1 << 12, 1 << 17):
            context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
            began = latest()
            sieve = decontaminate._sieve(grams, list(range(1, 14)), slots)
            context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
            taken.append(latest() - began)
            slot = lambda r: F.expr(decontaminate._slot("w", "0", r, slots))  # noqa: B023, E731
            want = {x[0] for r in range(1, 14) for x in grams.where(f"length = {r}").select(F.split("gram", " ").alias("w")).select(slot(r)).distinct().collect()}
            assert len(sieve) == slots and {k for k, b in enumerate(sieve) if b} == want
    assert max(taken) < 10
