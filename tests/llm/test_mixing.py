import re
from collections import Counter

from pyspark.sql import functions as F

from quillmill.llm import common, mixing

SCHEMA = "doc_id long, text string, lang string, source string"


def rows():
    out = [(i, "w " * (1 + i * 7 % 300), "en", "abc"[i % 3] if i % 7 else None) for i in range(400)]
    return out + [(900, None, "en", "a"), (901, " \n ", None, "d"), (5, "again and again", "en", "b"), (5, "again and again", "en", "b")]


def test_targets_are_met(spark):
    d = spark.createDataFrame(rows(), SCHEMA).withColumn("size", F.lit("clash"))
    got = mixing.mix(d, block=64).collect()
    assert len(got) == len(rows())
    size = Counter()
    for _, t, _, s in rows():
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    targets = {r["source_size"]: r["target"] for r in got}
    assert {r["source_size"] for r in got} == set(size.values())
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source_size"]] += r["taken"]
    assert all(abs(taken[k] - t) <= 1 for k, t in targets.items())
    again = mixing.mix(d, block=64).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_water_fill():
    assert mixing.water_fill([10, 10, 10], [5, 2, 1], 45, 2) == [20.0, 25 * 2 / 3, 25 / 3]
    assert mixing.water_fill([0, 4], [5, 1], 6, 2) == [0.0, 6.0]
    assert mixing.water_fill([], [], 0, 2) == []


def test_schedule_is_spread(spark):
    d = spark.createDataFrame([(i, i % 2 * 3 + 1, "ab"[i % 2]) for i in range(2000)], "doc_id long, size long, source string")
    plan = mixing.source_plan(d, (1, 1), 1.0, 2, 4)
    got = mixing.schedule(plan).orderBy("slot").collect()
    quota = {r["src"]: r["quota"] for r in plan.collect()}
    assert Counter(r["src"] for r in got) == quota
    share, seen = {s: q / len(got) for s, q in quota.items()}, Counter()
    for k, r in enumerate(got, 1):
        seen[r["src"]] += 1
        assert r["rank"] == seen[r["src"]] - 1
        assert all(abs(seen[s] - share[s] * k) < 6 for s in share)


def test_empty(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []


def test_queries_stay_small(spark):
    """The driver plans a query anew after each of its stages, and holds each broadcast table."""
    d = spark.createDataFrame(rows(), SCHEMA)
    for got, most in ((mixing.mix(d, block=64), 0), (mixing.mixed(d, block=64), 2)):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastExchange") <= most and plan.count("Window") <= 1, plan


def test_driver_is_trimmed(spark, monkeypatch):
    assert common.trim_driver(spark)  # the JVM here has the command
    seen = []
    monkeypatch.setattr(common, "trim_driver", seen.append)
    assert common.materialize(spark.range(3), "trimmed").count() == 3
    assert seen == [spark]
