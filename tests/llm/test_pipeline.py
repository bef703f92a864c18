import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from traceops.llm import jaccard, queries
from traceops.llm.storage import checkpointed

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    want = con.sql(queries.ORACLES[name]).df()
    columns = sorted(want.columns)
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    assert sorted(got.columns) == columns
    as_rows = lambda frame: sorted(map(tuple, frame[columns].astype(str).values))
    assert as_rows(got) == as_rows(want)


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = [docs.count()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, SMALL))
        assert docs.columns == columns, name
        counts.append(docs.count())
        if name == "near_copies":
            groups = jaccard.jaccard_components(docs)
            assert groups.filter("doc_id != component_id").count() == 0
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    assert docs.filter(F.col("n_chars") != F.length("text")).count() == 0
    packed = corpus_pipeline.run(spark, SMALL)
    assert packed.select("doc_id").distinct().count() == counts[-1]


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0
