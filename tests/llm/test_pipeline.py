"""Stages of the pipeline: columns, decisions and their effect."""

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    clean = docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SF).cache()
        if i < 4:
            assert made.columns == columns
        if name == "quality_rules":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            assert made.join(labels, "doc_id").where("quality = 0").count() == 0 and made.count() > 0.6 * clean
        if name == "simhash_near_dedup":
            assert made.select("text").distinct().count() == made.count() < docs.count()
        if name == "suffix_array_dedup":
            assert made.count() == docs.count() and made.where(F.char_length("text") != F.col("n_chars")).count() == 0
        docs = made
    sizes = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 1024


def test_odd_documents_pass_every_stage(spark, documents, nothing):
    for table in (documents, nothing):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:4]:
            docs = stage(spark, docs, SF).cache()
            assert docs.columns == table.columns
        assert corpus_pipeline.STAGES[4][1](spark, docs, SF).count() >= docs.count()
