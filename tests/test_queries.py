"""Every query with SQL against DuckDB, on the smallest tables."""

import re
import unicodedata

import duckdb
import pytest

from quillmill.plans import registry
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, db, name):
    df = registry.queries()[name](spark, SF)
    want = db.sql(registry.oracle_sql()[name])
    cols = want.columns
    assert sorted(cols) == sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    assert list(map(repr, got)) == list(map(repr, sorted(want.fetchall(), key=repr)))


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_runs(spark, name):
    assert registry.queries()[name](spark, SF).collect()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.queries()) <= set(__spark_entry__.queries())


def test_keyword_labels_of_all_documents(spark):
    from quillmill.plans.q_corpus import _COMMON

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = [(-1, None), (-2, ""), (-3, "Die Schüler — ein \u0130diot \U0001f600"), (-4, "thé Ｌicense"), (-5, "überdie y\u0301 copyrights")]
    at = f"{spark.conf.get('spark.checkpoint.dir')}/keywords"
    docs.unionByName(spark.createDataFrame(extra, docs.schema)).write.mode("overwrite").parquet(f"{at}/documents.parquet")
    want = []
    for i, t in [*map(tuple, docs.collect()), *extra]:
        low = unicodedata.normalize("NFKD", t or "").encode("ascii", "ignore").decode().lower()
        want.append((i, ",".join(sorted(k for k, w in _COMMON.items() if any(x in w for x in re.split("[^a-z0-9]", low))))))
    assert sorted(tuple(r) for r in registry.queries()["keyword_labels"](spark, at).collect()) == sorted(want)
