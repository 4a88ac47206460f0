import corpus_pipeline
from tests.llm.support import documents


def test_stages_hand_over_documents(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(at))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        if at < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            assert docs.filter("n_chars <> length(text)").count() == 0
    assert counts == sorted(counts, reverse=True) and counts[1] < counts[0] and counts[-1] > counts[0] / 2
    assert docs.filter("not round_trip or n_tokens <> size(ids)").count() == 0
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r.doc_id, r.n_tokens) for r in whole.collect()) == sorted((r.doc_id, r.n_tokens) for r in docs.collect())


def test_stages_take_awkward_and_no_documents(spark, sf_dir, tmp_path):
    for name, rows in (("awkward", None), ("none", [])):
        docs = documents(spark, rows)
        for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{name}{at}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
