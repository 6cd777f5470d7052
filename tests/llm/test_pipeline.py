import random

import corpus_pipeline as cp


def test_each_stage_decides_on_its_own_input(spark, tmp_path):
    r = random.Random(11)
    text = lambda n: " ".join(f"w{r.randrange(4000)}" for _ in range(n))
    rows = [(k, text(60), "en", "s", 0) for k in range(300)]
    toxic = {k for k in range(0, 300, 5)}
    rows = [(k, t + " vile rotten nasty scummy" * 2 if k in toxic else t, *x) for k, t, *x in rows]
    rows += [(1000, rows[1][1], "en", "s", 0), (1001, rows[2][1] + " one more", "en", "s", 0), (1002, "mail me at a.b@c.org or +1 (013) 555-9871", "en", "s", 0), (1003, None, None, None, None)]
    bench = text(30)
    rows.append((1004, f"{text(20)} {bench}", "en", "s", 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k in toxic)) for k in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    schema, kept = docs.schema.names, []
    for k, (name, stage) in enumerate(cp.STAGES[:-1]):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.schema.names == schema, name
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({x.doc_id for x in docs.collect()})
    everyone = {x[0] for x in rows}
    assert kept[0] == everyone - toxic
    assert kept[1] == kept[0] - {1000, 1001}
    assert kept[2] == kept[3] == kept[1] - {1004}
    clean = {x.doc_id: x for x in docs.collect()}
    assert clean[1002].text == "mail me at <email> or <phone>" and clean[1002].n_chars == 29
    assert clean[1003].text is None and clean[1].text == rows[1][1]
    pieces = cp.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == kept[3] and all(p.offset + p.length <= 2048 for p in pieces)


def folder(spark, path, rows, extra=""):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + extra).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "some words of a test item")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_stages_keep_nulls_repeats_and_columns_of_any_name(spark, tmp_path):
    names = ["row", "id", "hash", "base", "voted", "more", "gone_id", "twice_id", "bad_id", "bad_hash", "score", "predicted", "_id", "x.y"]
    tail = ("en", None, 1, *names)
    text = "plain words that nobody else has written down here"
    rows = [(1, text, *tail), (1, text, *tail), (1, "another text under the same id, not like it at all", *tail), (2, None, *tail), (3, "", *tail), (None, "without any id but with words", *tail), (None, None, *tail)]
    docs = folder(spark, tmp_path, rows, "".join(f", `{n}` string" for n in names))
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).checkpoint()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names], name
    assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=str) == sorted({r[:2] for r in rows}, key=str)
    assert all(r["x.y"] == "x.y" and r["id"] == "id" for r in docs.collect())
    assert {p.doc_id for p in cp.STAGES[-1][1](spark, docs, str(tmp_path)).collect()} == {1, 2, 3, None}


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = folder(spark, tmp_path, [])
    for _, stage in cp.STAGES:
        assert stage(spark, docs, str(tmp_path)).collect() == []
