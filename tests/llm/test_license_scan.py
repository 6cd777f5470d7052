import random

import numpy as np
import pyarrow as pa

from fathomline.llm.license_scan import TEMPLATES, align, build_index, scan, scan_licenses, winnow


def test_winnow_leaves_no_window_without_a_fingerprint():
    g = np.array([random.Random(1).randrange(50) for _ in range(200)], np.uint64)
    picked = set(winnow(g, 4).tolist())
    assert all(picked & set(range(i, i + 4)) for i in range(197))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(row[j + 1], new[j], row[j] + (x == y)))
        row = new
    return row[-1]


def test_alignment_equals_longest_common_subsequence_within_a_wide_band():
    r = random.Random(2)
    for _ in range(60):
        a = np.array([r.randrange(6) for _ in range(r.randrange(1, 15))], np.uint64)
        b = np.array([r.randrange(6) for _ in range(r.randrange(1, 15))], np.uint64)
        n, start, end = align(a, b, 0, 40)
        assert n == lcs(a.tolist(), b.tolist()) and lcs(a.tolist(), b[start:end].tolist()) == n


def test_finds_every_template_whole_and_edited(spark):
    r = random.Random(3)
    rows, want = [], {}
    for k, (name, text) in enumerate(TEMPLATES.items()):
        words = text.split()
        for edit in range(3):
            w = list(words)
            if edit and len(w) > 20:
                for _ in range(len(w) // 20):
                    w[r.randrange(len(w))] = "changed"
            if edit == 2 and len(w) > 20:
                w.insert(r.randrange(len(w)), "more words here")
            before = " ".join(f"É{r.randrange(99)}" for _ in range(r.randrange(30)))
            d = 10 * k + edit
            rows.append((d, f"{before}\n{' '.join(w)}\nafter the end of it"))
            want[d] = name
    rows += [(900, None), (901, ""), (902, "licensed under the sun"), (None, TEMPLATES["MIT-line"]), (903, "\n".join([TEMPLATES["MIT-line"]] * 50))]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, spans string").repartition(3)
    texts = dict(rows)
    for x in scan_licenses(df).collect():
        if x.doc_id in want:
            assert want[x.doc_id] in x.licenses.split(",")
            for m in x.spans.split(","):
                name, a, b, share = m.rsplit(":", 3)
                if x.doc_id % 10 == 0 and name == want[x.doc_id]:
                    assert texts[x.doc_id][int(a) : int(b)].split()[0].strip("(\"") == TEMPLATES[name].split()[0] and float(share) == 1
        elif x.doc_id == 903:
            assert x.n_matches == 50
        elif x.doc_id is None:
            assert x.licenses == "MIT-line" and x.spans == "MIT-line:0:30:1.0000"
        else:
            assert x.n_matches == 0 and x.spans == ""


def test_matches_do_not_cross_texts():
    line = TEMPLATES["GPL-3.0-line"].split()
    texts = pa.array([" ".join(line[:6]), " ".join(line[6:])])
    assert scan(texts, build_index(TEMPLATES)) == [[], []]


def test_sister_licenses_and_many_matches():
    index = build_index(TEMPLATES)
    names = lambda text: {m[0] for m in scan(pa.array([text]), index)[0]}
    assert names(TEMPLATES["GPL-3.0"]) == {"GPL-3.0"} and names(TEMPLATES["AGPL-3.0"]) == {"AGPL-3.0"}
    assert {"BSD", "BSD-3-Clause-third", "BSD-disclaimer"} <= names(" ".join(TEMPLATES[n] for n in ("BSD", "BSD-3-Clause-third", "BSD-disclaimer")))
    assert len(scan(pa.array([" and ".join([TEMPLATES["MIT-line"]] * 3000)]), index)[0]) == 3000
