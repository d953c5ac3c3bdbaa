"""Each pipeline stage against its own check, on the smallest tables."""

import corpus_pipeline
from pyspark.sql import functions as F

from cinemetric.llm import simhash
from cinemetric.llm.shared import stored, work_dir

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    folder, kept = work_dir(spark, "test-pipeline"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), f"{folder}/{name}")
        kept[name] = (before, docs)
        if name != "pack":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = kept["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert after.join(before, ["doc_id", "text"]).count() == after.count()
    rate = lambda d, q: d.join(labels.filter(F.col("quality") == q), "doc_id").count()
    assert rate(after, 1) >= 0.97 * rate(before, 1) and rate(after, 0) <= 0.3 * max(1, rate(before, 0))
    before, after = kept["dedup"]
    groups = simhash.near_groups(before)
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in groups.collect()}
    before, after = kept["secrets"]
    assert before.count() == after.count() and after.filter(F.col("text").rlike('token = "[0-9a-f]{40}')).count() == 0
    assert after.exceptAll(before).count() == before.filter(F.col("text").rlike('token = "[0-9a-f]{40}')).count()
    before, after = kept["mix"]
    assert after.join(before, "doc_id", "left_anti").count() == 0
    assert after.groupBy("doc_id").count().filter("count > 3").count() == 0
    before, after = kept["pack"]
    tokens = after.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("e"))
    assert tokens.filter("n <> e or n > 2048").count() == 0
    assert after.filter("start = 0").count() == before.count()


def test_dedup_decides_by_row(spark):
    text = lambda k: " ".join(f"w{k}x{i * i * 7 + k}" for i in range(60))
    rows = [
        (None, text(1)), (7, text(1)),  # a null id beside an id: the id stays
        (None, text(2)),  # unique, without id
        (None, text(3)), (None, text(3)), (None, text(3).upper()),  # copies without any id: one stays
        (1, text(4)), (2, text(4)), (2, text(5)), (9, text(5)),  # id 2 names its second group
        (4, text(6)), (4, text(6)),  # a row twice
        (None, None), (None, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_key", F.lit("clash")).repartition(4)
    after = corpus_pipeline.dedup_stage(spark, docs, SF)
    assert after.columns == docs.columns
    kept = [(r.doc_id, (r.text or "").lower()) for r in after.collect()]
    want = [(7, text(1)), (None, text(2)), (None, text(3)), (1, text(4)), (2, text(5)), (4, text(6)), (None, "")]
    assert sorted(kept, key=str) == sorted(want, key=str)
