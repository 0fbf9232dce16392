"""The queries that have SQL, and the pipeline, on the smallest tables."""

import duckdb
import pytest

from quillmill.llm.queries import ORACLES, QUERIES
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = [tuple(r[c] for c in want.columns) for r in QUERIES[name](spark, SF).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want.fetchall()))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [docs]
    for _, stage in corpus_pipeline.STAGES:
        rows.append(stage(spark, rows[-1], SF).cache())
    first, clean, one, safe, mixed, last = rows
    assert all(r.columns == docs.columns for r in rows[:5])
    toxic = {r[0] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").select("doc_id").collect()}
    gone = {r[0] for r in first.select("doc_id").subtract(clean.select("doc_id")).collect()}
    assert len(gone & toxic) >= 0.5 * len(toxic)
    assert one.count() == one.select("doc_id").distinct().count() == safe.count() <= clean.count()
    assert safe.where(r"text rlike 'AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}'").count() == 0
    assert mixed.select("doc_id").subtract(safe.select("doc_id")).count() == 0
    assert last.count() == mixed.count()
    assert last.select("decoded_sha256").distinct().count() == mixed.select("text").distinct().count()


def test_pipeline_writes_ids(spark):
    import hashlib

    import numpy as np

    import corpus_pipeline

    d = spark.createDataFrame([(1, "some words, and ids"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in dict(corpus_pipeline.STAGES)["bpe"](spark, d, SF).collect()}
    for i, t in ((1, b"some words, and ids"), (2, b"")):
        assert bytes(got[i]["decoded"]) == t
        assert len(got[i]["ids"]) == got[i]["n_tokens"]
        assert hashlib.sha256(np.array(got[i]["ids"], "<u4").tobytes()).hexdigest() == got[i]["ids_sha256"]
