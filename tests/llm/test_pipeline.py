import random

from pyspark.sql import functions as F

import corpus_pipeline
from stayspark.llm import decontamination, jaccard, quality, toxicity


def test_stages_against_their_operators(spark, tmp_path):
    r = random.Random(3)
    words = ["".join(r.choices(["ri", "ver", "sto", "ne", "la", "mi"], k=r.randint(1, 3))) for _ in range(200)]
    rows, labels = [], []
    item = " ".join(r.choices(words, k=25))
    for k in range(120):
        own = r.choices(words, k=r.randint(20, 60))
        toxic, bad = k % 4 == 0, k % 5 == 0
        if toxic:
            own[3:3] = ["dumbhead", "blockhead"]
        if bad:
            own = [f"{w}###" for w in own]
        if k % 11 == 1:
            own[5:5] = item.split()
        rows.append((k, " ".join(own), "en", "s", 5))
        labels.append((k, int(not bad), int(toxic)))
        if k % 13 == 1:
            rows.append((500 + k, " ".join(own), "en", "t", 5))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0), (1, rows[1][1], "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        if name == "toxicity":
            want = {x["doc_id"] for x in toxicity.classify(now, marks).where("predicted = 0").collect()}
        elif name == "quality":
            want = {x["doc_id"] for x in quality.classify(now, marks).where("predicted = 1").collect()}
        elif name == "near_duplicates":
            want = {x["doc_id"] for x in jaccard.near_duplicates(now).where("component_id = doc_id").collect()}
        elif name == "decontamination":
            want = {x["doc_id"] for x in now.collect()} - {x["doc_id"] for x in decontamination.contaminated(now, bench).collect()}
        else:
            want = {x["doc_id"] for x in now.collect()}
        got = [x["doc_id"] for x in out.select("doc_id").collect()]
        assert set(got) == want, name
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == now.columns
            assert len(want) < now.count() or name == "decontamination"
            if k >= 2:
                assert len(got) == len(set(got))
            out.write.parquet(f"{tmp_path}/{name}")
            now = spark.read.parquet(f"{tmp_path}/{name}")


def test_empty_tables_and_clashing_columns(spark, tmp_path):
    extra = {k: F.lit(7) for k in ("_n", "_copy", "_found", "set_id", "component_id", "score", "predicted", "node", "at", "bucket", "data", "item_id")}
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(k, k % 2, int(k % 3 == 0)) for k in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one item of the benchmark with quite a few words in it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(k, f"text {k} of a few more plain words that are all alike", "en", "s", 5) for k in range(6)]
    rows += [(3, "another text under the same id as one above", None, None, None), (3, None, "en", "s", 0), (None, "no id", "en", "s", 0), (None, None, None, None, None), (9, "", "en", "s", 0)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema).withColumns(extra)
        for name, stage in corpus_pipeline.STAGES[2:]:
            out = stage(spark, docs, str(tmp_path))
            got = [tuple(r) for r in out.collect()]
            if name == "near_duplicates" and data:
                ids = [r[0] for r in got]
                assert ids.count(3) <= 1
                assert ids.count(None) == 2
                assert 9 in ids
            if name != "packing":
                assert out.columns == docs.columns
            elif data:
                assert len(got) >= len(data)
            if not data:
                assert got == []
