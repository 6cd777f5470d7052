import hashlib
import random
import re
import time

from fathomline.llm.pii import KINDS, find_pii, redact, summarise


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    text = text or ""
    spans = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            spans.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append((m.start(), 3, m.end()))
    spans.sort()
    return [sum(s[1] == k for s in spans) for k in range(4)] + [hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()], [f"{KINDS[k]}:{a}:{b}" for a, k, b in spans]


def fixture():
    r = random.Random(5)
    pieces = ["a@b.co%x@y.z", "é", "🙂", " ", "\n", "1.2.3.4.5", "256.1.1.1", "01.002.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (013) 555-9871", "+49 30 1234567 89", "+1.", "x@y", "@", "a.b@c-d.e.f.", "12", "3", "-", "token = \"" + "0a1b2c3d" * 5, "123-45-6789", "call (415) 555-2671", "word", "+", "..", "%"]
    return ["".join(r.choice(pieces) + r.choice(["", " ", ","]) for _ in range(r.randrange(25))) for _ in range(400)]


def test_base_spans_equal_plain_regex(spark):
    texts = [*fixture(), None, "", "a" * 60000, "1" * 60000, "1-" * 30000, "+1" + " " * 50000, "a.b" * 20000 + "@c.d", "\n"]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(None, "m@n.op", "y"), (0, texts[0], "x")], "doc_id long, text string, base string").select("doc_id", "text").repartition(4)
    rows = summarise(find_pii(df)).collect()
    assert len(rows) == len(texts) + 2
    for row in rows:
        counts, listed = brute("m@n.op" if row.doc_id is None else texts[row.doc_id])
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone, row.base_sha256] == counts
        every = row.spans.split(",") if row.spans else []
        assert set(listed) <= set(every)
        assert [x for x in every if x.split(":")[0] in KINDS[:4]] == listed


def test_further_kinds_are_learnt_and_redacted(spark):
    texts = [f"text {k} token = \"{k:08x}{'0a1b2c3d' * 4}\" end, mail me: u{k}@mail.example.com" for k in range(40)]
    found = find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = found.collect()
    assert all([KINDS[s["kind"]] for s in r.all_spans] == ["secret", "email"] for r in rows)
    assert {r.text for r in redact(found).collect()} == {f'text {k} <secret>" end, mail me: <email>' for k in range(40)}


def test_wide_candidates_are_told_apart(spark):
    """Planted secrets and numbers with and without a key word, among look-alikes that are no personal data."""
    r = random.Random(17)
    hexed = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    planted, rows = {}, []
    for k in range(300):
        kind = k % 6
        good = {0: f'token = "{hexed(40)}"', 1: "GB29 NWBK 6016 1331 9268 19", 2: f"ssn {r.randrange(100, 600)}-{r.randrange(10, 99)}-{r.randrange(1000, 9999)}", 3: f"call ({r.randrange(201, 780)}) {r.randrange(200, 999)}-{r.randrange(1000, 9999)}"}
        bad = {4: f"version-of-the-long-hyphenated-name-{r.randrange(9)}", 5: "GB30 NWBK 6016 1331 9268 19"}
        planted[k] = kind < 4
        rows.append((k, f"some words {good.get(kind) or bad[kind]} and more words"))
    found = find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {x.row.doc_id: bool(x.all_spans) for x in found}
    caught = [got[k] for k, y in planted.items() if y]
    assert sum(caught) >= 0.9 * len(caught) and not any(got[k] for k, y in planted.items() if not y)


def test_many_spans_in_a_megabyte(spark):
    text = " ".join(f"u{k}@mail{k}.example.com 123-45-{k % 9000 + 1000}" for k in range(26_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    found = find_pii(df)
    (row,) = summarise(found).collect()
    counts, listed = brute(text)
    assert len(text) > 1_000_000 and [row.n_email, row.n_ip, row.n_card, row.n_phone, row.base_sha256] == counts
    (clean,) = redact(found).collect()
    assert "@" not in clean.text and clean.text.count("<email>") == 26_000
    assert time.time() - began < 150


def test_clashing_names_stay(spark):
    names = ["base", "all_spans", "more", "voted", "row", "email", "listed", "a.b"]
    rows = [(1, "mail a.b@c.org now", *names), (2, None, *names), (3, "", *names), (1, "mail a.b@c.org now", *names)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = redact(find_pii(df))
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(d, t and t.replace("a.b@c.org", "<email>"), *x) for d, t, *x in rows], key=str)


def test_empty_table(spark):
    assert find_pii(spark.createDataFrame([], "doc_id long, text string")).collect() == []
