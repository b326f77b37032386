"""Registered queries on the driver's smallest tables: against their SQL where they have one, else against what their contract says."""

import os
import zlib

import duckdb
import pytest

import corpus_pipeline
from spendline.llm import queries

DIRECTORY = os.environ.get("SPENDLINE_TEST_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="driver tables not available")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIRECTORY}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, DIRECTORY)
    cursor = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[n] for n in names) for r in df.collect()) == sorted(cursor.fetchall())


def test_one_row_per_input_row(spark, duck):
    for name, table, key in (("op3_html", "pages", "page_id"), ("op6_toxicity", "documents", "doc_id"), ("op7_ngram_join", "documents", "doc_id"), ("op8_pii", "documents", "doc_id"),
                             ("op9_embedding_dedup", "embeddings", "vec_id"), ("op10_warc", "pages", "page_id")):
        want = sorted(x for x, in duck.execute(f"SELECT {key} FROM {table}").fetchall())
        rows = queries.QUERIES[name](spark, DIRECTORY).collect()
        assert sorted(r[key] for r in rows) == want, name
        if name == "op6_toxicity":
            assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, DIRECTORY).checkpoint()
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and now <= kept and (name != "line_dedup" or now == kept)
        kept = now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DIRECTORY).collect()
    assert {r.doc_id for r in packed} == kept and sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())
