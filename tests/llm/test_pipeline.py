import random

import corpus_pipeline


def test_stages_on_a_small_corpus(spark, tmp_path):
    r = random.Random(7)
    word = lambda: "".join(r.choice(["the", "an", "er", "in", "or"]) for _ in range(2))
    line = lambda n: " ".join(word() for _ in range(n))
    shared = line(12)
    rows = [(k, "\n".join([line(20), line(25), line(15)]), "en", "s", 0) for k in range(150)]
    rows += [(200, f"{rows[3][1]} {word()}", "en", "s", 0), (201, rows[3][1], "en", "s", 0), (202, "§§x €€q ##z " * 30, "en", "s", 0)]
    rows += [(210 + k, "\n".join([line(20), shared, line(20)]), "en", "s", 0) for k in range(3)]
    rows += [(300, None, "en", "s", 0), (301, "", None, None, None), (None, line(20), "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(140)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at, held = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        at = spark.read.parquet(f"{tmp_path}/{k}")
        held.append(at.collect())
        assert k == 3 or at.columns == docs.columns
    good, lined, single, packed = held
    kept = {x.doc_id for x in good}
    assert 202 not in kept and {300, 301, None} <= kept and len(kept) > 145
    text = {x.doc_id: x.text for x in lined}
    assert text[201] == "" and text[200].startswith(rows[3][1].split("\n")[2])
    assert shared in text[210] and shared not in text[211] and shared not in text[212]
    assert all(x.n_chars == len(x.text) for x in lined if x.text is not None)
    assert {300, 301, None, 3} <= {x.doc_id for x in single}
    assert {x.doc_id for x in packed} == {x.doc_id for x in single}
    assert corpus_pipeline.ORACLE_SQL is None


def test_a_stage_gives_unused_heap_back(spark, tmp_path, monkeypatch):
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    docs = spark.createDataFrame([(1, "one two", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(corpus_pipeline.quality, "keep_good", lambda docs, labels: docs)
    monkeypatch.setattr(corpus_pipeline.linededup, "dedup", lambda docs, short: docs)
    monkeypatch.setattr(corpus_pipeline.jaccard, "keep_one", lambda docs: docs)
    for name in ("pieces", "pack"):
        monkeypatch.setattr(corpus_pipeline.packing, name, lambda docs, *_: docs)
    monkeypatch.setattr(corpus_pipeline, "cut", lambda docs, tag: docs)
    for name, stage in corpus_pipeline.STAGES:
        spark.range(0, 24, 1, 4).selectExpr("length(repeat('x', 150000000 + cast(id as int)))").collect()
        before = heap.totalMemory()
        stage(spark, docs, str(tmp_path))
        assert heap.totalMemory() < before - (1 << 29), name
