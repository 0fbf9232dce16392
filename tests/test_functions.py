"""Goldens of single operators."""

import pytest
from pyspark.sql import functions as F

from quillmill.functions import extract as X
from quillmill.functions import text as T
from quillmill.operators import corpus, gates, layout
from quillmill.sources.files import parse


@pytest.mark.parametrize(("n", "want"), [(0, 0), (1, 1), (320, 1), (321, 2), (560, 2), (561, 3), (600, 3), (840, 3), (841, 4)])
def test_chunk_counts(spark, n, want):
    d = spark.createDataFrame([(" ".join(["w"] * n),)], "text string")
    assert d.select(F.size(corpus.chunks(F.col("text")))).first()[0] == want


def test_chunk_sizes(spark):
    d = spark.createDataFrame([(" ".join(["w"] * 641),)], "text string")
    assert [len(c.split()) for c in d.select(corpus.chunks(F.col("text"))).first()[0]] == [320, 320, 81]


def test_repair_and_punctuation():
    assert T.repair_text("GrÃ¶ÃŸe") == "Größe"
    assert T.repair_text("Größe") == "Größe"


def test_fuzzy():
    table = {"bitcoin": "BTC", "eth": "ETH"}
    assert X.fuzzy("bitcoin", table) == "BTC"
    assert X.fuzzy("et", table) is None
    assert X.fuzzy("method", table) == "ETH"  # holds a key
    assert X.fuzzy("zzzzz", table) is None


@pytest.mark.parametrize(("n", "train", "eval_"), [(1, 1, 0), (2, 1, 1), (10, 9, 1), (11, 9, 2), (20, 18, 2)])
def test_split_sizes(spark, n, train, eval_):
    got = gates.split_train_eval(spark.range(n).withColumnRenamed("id", "k"), "k").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {k: v for k, v in (("train", train), ("eval", eval_)) if v}


def test_preserve(spark):
    cur = spark.createDataFrame([("a", "h1"), ("b", "h1"), ("c", "h2"), ("d", "h9"), ("e", None), ("f", None)], "id string, image_hash string")
    pri = spark.createDataFrame([("a", "h1"), ("d", "h3"), ("e", "h4"), ("x", "h2"), ("y", "h2")], "id string, image_hash string")
    got = {r["id"]: r["status"] for r in gates.preserve(cur, pri).collect()}
    assert got == {"a": "preserved", "b": "preserved", "c": "duplicate_image_hash", "d": "image_changed", "e": "missing_current_image", "f": "none"}


def test_box_merge_needs_second_pass():
    assert layout._merged([(0, 0, 10, 10), (30, 0, 40, 10), (5, 0, 35, 10)], 1, layout._NO_PAGE) == [(0, 0, 40, 10)]


def test_parsers():
    assert parse("a/x.json", b'[1, {"k": [true, null]}]')[1][3:5] == ("k[0]: True\nk[1]:", '{"k": [true, null]}')
    assert parse("x.json", b"{")[0][5]
    lines = parse("x.jsonl", b'\n{"a": 1}\nbad\n')
    assert [(r[2], r[3]) for r in lines] == [(1, "a: 1"), (2, "raw_line: bad")]
    assert parse("x.csv", b"a,b\n1\n1,2,3\n")[0][3] == "a: 1\nb:"
    assert parse("x.md", b"a\r\n\r\n\r\n\r\nb\xff")[0][3] == "a\n\nb"
    assert parse("x.bin", b"") == []
