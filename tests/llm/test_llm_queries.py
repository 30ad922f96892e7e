import pytest
from compare import both
from conftest import SMALL

from obsflow.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    got, want = both(queries.QUERIES[name](spark, SMALL), queries.ORACLE[name], SMALL)
    assert got == want


def test_language_accuracy_on_held_out_rows(spark):
    from pyspark.sql import functions as F

    got = queries.QUERIES["op6_language_id"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id")
    share = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share >= 0.95


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = corpus_pipeline.table(spark, SMALL, "documents")
    schema, seen = docs.schema, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), name)
        now = {r["doc_id"] for r in docs.collect()}
        assert docs.schema == schema and now <= seen and now
        seen = now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r["doc_id"] for r in packed.collect()} == seen
    assert corpus_pipeline.run(spark, SMALL).count() == packed.count()
