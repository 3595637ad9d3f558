import corpus_pipeline
from tests.helpers import SF


def test_stages_keep_columns_and_rows(spark):
    out = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert set(docs.columns) <= set(out.columns)
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert 0 < len(ids) == len(set(ids)) <= docs.count()
    assert out.where("NOT round_trip").isEmpty()
