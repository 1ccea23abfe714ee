"""The pipeline's stages, one after the other, against the operators' plain meaning."""

import corpus_pipeline
from talkscout.llm import neardup, quality, toxicity
from talkscout.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "near duplicates", "packing"]
    clean = {r.doc_id for r in toxicity.scores(docs, toxicity.train(docs, labels)).where("predicted = 0").collect()}
    good = {r.doc_id for r in quality.quality_report(docs).where("kept").collect()}
    left = docs.where(docs.doc_id.isin(*(clean & good)))
    first = {r.doc_id for r in neardup.near_duplicates(left).where("kept").collect()}
    now = docs
    for (name, stage), want in zip(corpus_pipeline.STAGES, (clean, clean & good, first), strict=False):
        now = stage(spark, now, SF_DIR)
        assert now.columns == docs.columns and now.schema == docs.schema, name
        assert {r.doc_id for r in now.select("doc_id").collect()} == want, name
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == first


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in QUERIES) for i in range(1, 11))
