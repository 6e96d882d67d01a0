"""Benchmark items without an id: op8 as its SQL, and the pipeline's stage."""

import duckdb

import corpus_pipeline
from skyscore.llm import decontaminate


def test_items_without_an_id_count(spark, tmp_path):
    duckdb.sql("""COPY (SELECT * FROM (VALUES (1, 'say the lonely words here', 'en'), (2, 'a b c', 'en'), (3, 'lonely', 'en'),
        (4, NULL, 'en'), (5, 'b lonely words a b', 'en')) t(doc_id, text, lang)) TO '%s/documents.parquet'""" % tmp_path)
    duckdb.sql("""COPY (SELECT * FROM (VALUES (CAST(NULL AS BIGINT), 'lonely words'), (7, 'a b'), (NULL, 'the lonely words'),
        (8, 'Lonely Words')) t(item_id, text)) TO '%s/benchmark.parquet'""" % tmp_path)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    want = {r[0]: tuple(r) for r in con.sql(decontaminate.SQL8).fetchall()}
    got = {r["doc_id"]: tuple(r) for r in decontaminate.op8(spark, str(tmp_path)).collect()}
    assert got == want
    assert (got[1][2], got[1][3], got[1][5]) == (3, 2, True)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    unnamed = spark.read.parquet(f"{tmp_path}/benchmark.parquet").filter("item_id is null")
    unnamed.write.parquet(f"{tmp_path}/only/benchmark.parquet")
    left = corpus_pipeline.decontaminated(spark, docs, f"{tmp_path}/only")
    assert {r["doc_id"] for r in left.collect()} == {2, 3, 4}
