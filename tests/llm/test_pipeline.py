import os

import pytest

import corpus_pipeline

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_stages_keep_the_columns_and_whole_sequences(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, DATA))
        assert docs.columns == columns
        assert name == "mixing" or docs.count() <= before
        before = docs.count()
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert sum(r.piece == 0 for r in rows) == before


def test_stages_handle_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows, an empty table and columns called like the operators' own."""
    text = "some words of one document that are told once more below"
    own = [(i, t, "en", s, len(t or ""), "mine") for i, t, s in ((1, text, "a"), (1, text, "a"), (2, None, None), (3, "", "b"), (None, "no id here at all", "b"), (4, text + " x", None), (5, "w " * 9000, "c"))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, doc string"
    df = spark.createDataFrame(own, schema)
    for c in ("size", "target", "taken", "row", "key", "copy", "place", "label", "score", "h"):
        df = df.withColumn(c, df["doc"])
    spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.staged(stage(spark, docs, str(tmp_path)))
            assert docs.columns == df.columns and docs.filter("doc != 'mine' or size != 'mine' or target != 'mine'").isEmpty()
        rows = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert sum(r.piece == 0 for r in rows) == docs.count()
