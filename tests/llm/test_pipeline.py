import corpus_pipeline
from pyspark.sql import functions as F

from lodestar.llm import near_dedup, packing, quality, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_stages_agree_with_operators(spark, given):
    docs, _ = given
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = {r.doc_id for r in quality.score_quality(docs, labels).where("predicted = 1").collect()}
    first = docs.where(F.col("doc_id").isin(list(good)))
    bad = {r.doc_id for r in toxicity.score_toxicity(first, labels).where("predicted = 1").collect()}
    second = first.where(~F.col("doc_id").isin(list(bad)))
    kept = {r.class_id for r in near_dedup.near_classes(second).collect()}
    third = second.where(F.col("doc_id").isin(list(kept)))
    want = {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in packing.token_pieces(third).collect()}
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)


def test_stages_keep_columns_and_take_odd_documents(spark, odd, nothing):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "toxicity", "near_duplicates", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd, FOLDER)
        if name != "packing":
            assert got.columns == odd.columns
        assert got.count() > 0
        assert stage(spark, nothing, FOLDER).count() == 0
