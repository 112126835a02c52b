"""The pipeline's stages, each on what the one before it kept, and the SQL of the queries that have one."""

import os

import duckdb
import pytest

import corpus_pipeline
from vaultline.llm import queries
from vaultline.llm.tables import table


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    result = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in result.select("doc_id").collect()} <= {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for view in ("documents", "pages"):
        connection.execute(f"create view {view} as select * from '{os.path.join(sf_dir, view)}.parquet'")
    frame = queries.QUERIES[name](spark, sf_dir)
    columns = ", ".join(frame.columns)
    wanted = connection.execute(f"select {columns} from ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, frame.collect()), key=repr) == sorted(wanted, key=repr)
