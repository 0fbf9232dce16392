"""Decision messages: how often their record is worked out, and values of odd characters."""

from pyspark.sql import functions as F

from quillmill.operators import records
from quillmill.plans import registry
from tests.conftest import SF


def test_record_of_decision_examples_is_worked_out_once(spark):
    plan = registry.queries()["decision_examples"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_totalprice#") <= 6  # the last of the record's five fields: once, besides its scan and checks
    assert "ArrowEvalPython" not in plan


def test_nested_and_plain_records_give_the_same_messages(spark):
    d = spark.createDataFrame([("X", "long", "a b\u0085\n\"c\\"), ("X", None, ""), ("", "long", "n"), (None, None, None)], "symbol string, side string, notes string")
    r = records.normalize_columns({n: F.col(n) for n in d.columns})
    got = d.select(records.decision_messages(r).alias("a"), records.decision_messages(r, nested=False).alias("b")).collect()
    assert [g["a"] for g in got] == [g["b"] for g in got]
    assert [g["a"] is None for g in got] == [False, True, True, True]
    assert got[0]["a"][2]["content"] == '{\n  "action": "long",\n  "thesis": "a b\u0085\\n\\"c\\\\"\n}'
