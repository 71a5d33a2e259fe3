import __spark_entry__
import corpus_pipeline
from stockweave.llm.queries import oracle_sql, queries


def test_every_operator_is_registered():
    names = set(queries())
    assert names <= set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
    assert set(oracle_sql()) <= names


def test_pipeline_stages_follow_each_other(spark, small, small_docs):
    docs, sizes = small_docs, [small_docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == small_docs.columns
        docs = spark.createDataFrame(docs.toPandas(), small_docs.schema)
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small).toPandas()
    assert set(packed["doc_id"]) == {r["doc_id"] for r in docs.collect()}


def test_pipeline_takes_an_empty_table(spark, small, small_docs):
    docs = small_docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame([], stage(spark, docs, small).schema)
    assert docs.count() == 0
