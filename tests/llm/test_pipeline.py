"""The pipeline and the registered queries on the driver's small tables."""

import pytest
from conftest import DATA
from llm_fixtures import rows_of

import corpus_pipeline
from tillroll.llm import queries

FOLDER = f"{DATA}/sf0.001"


def test_every_operator_is_registered():
    assert sorted(queries.queries(), key=lambda n: int(n[2:].split("_")[0]))[0].startswith("op1_")
    assert {int(n[2:].split("_")[0]) for n in queries.queries()} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_give_a_row_for_each_document(spark, name):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    rows = queries.queries()[name](spark, FOLDER).count()
    vectors = spark.read.parquet(f"{DATA}/sf0.001/embeddings.parquet").count()
    wanted = {"op7": None, "op13": None, "op11": 16 * vectors}.get(name.split("_")[0], documents)
    assert rows > 0 if wanted is None else rows == wanted


def test_stages_pass_on_what_they_keep(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, ids = docs.columns, set(rows_of(docs, "doc_id"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, FOLDER), "stage")
        left = set(rows_of(docs, "doc_id"))
        assert docs.columns == columns and left <= ids and left, name
        ids = left
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert set(rows_of(last, "doc_id")) == ids and rows_of(last.select("lossless").distinct()) == [(True,)]
    assert rows_of(corpus_pipeline.run(spark, FOLDER), "doc_id", "ids") == rows_of(last, "doc_id", "ids")


def test_empty_documents_go_through(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
