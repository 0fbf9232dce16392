"""Mixing sources to target weights: a low-discrepancy source schedule over equal-token blocks.

1. Sizes are summed per source; targets are water-filled by weight under a cap of passes per source.
2. Slot ``k`` of the mix has the golden-ratio point ``frac((k + 1) * phi)``, mapped through the cumulative
   targets to a source. Slots are ranked per source; a source needs exactly ``quota`` slots, later ones are
   void, and the few a source lacks follow at the end of the schedule.
3. Each source's documents, in a seeded shuffled order, form one stream of words cut into equal blocks. Rank
   ``r`` of a source takes block ``r mod n_blocks`` (pass ``r div n_blocks``); the last one is cut to the target.
4. A document has taken the words by which its interval of the stream overlaps the blocks taken.

Rankings and stream offsets are two-level prefix sums: within chunks of about a thousand rows, then over the chunks'
totals, so that of a source that holds a third of all rows only a thousandth as many totals meet in one task. Texts are
read once, for their sizes, which are written as a table; only ids and sizes are shuffled. The turns of the blocks and the
streams are tables too: as one query they are planned anew after each of some thirty stages, out of the driver's memory.

Defined results: null source is a source of its own, last in order; null or wordless text has size 0 and takes
0; long texts are counted whole; repeated rows are documents of their own; an empty table gives an empty result; other
columns, whatever their names, are ignored by ``mix`` and kept by ``mixed``.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm.common import WORD, documents, materialize, row_key, spare_name, unsigned_hash

GOLDEN = (math.sqrt(5) - 1) / 2
#: Words in a block.
BLOCK = 2048
#: Targets are worked out on the driver: one number a source, refused beyond this many.
MAX_SOURCES = 100_000
_CHUNK = 1024
_CELLS = 1024


def water_fill(sizes: list[int], weights: list[float], total: float, passes: float) -> list[float]:
    """Share ``total`` by weight; who would pass ``passes`` times its size stops there, the excess is shared again."""
    target = [0.0] * len(sizes)
    open_ = [i for i, n in enumerate(sizes) if n > 0]
    left = float(total)
    while open_:
        w = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / w >= passes * sizes[i]]
        if not full:
            for i in open_:
                target[i] = left * weights[i] / w
            break
        for i in full:
            target[i] = float(passes * sizes[i])
        left = max(0.0, left - sum(target[i] for i in full))
        open_ = [i for i in open_ if i not in set(full)]
    return target


def source_plan(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), volume: float = 1.5, passes: int = 2, block: int = BLOCK) -> DataFrame:
    """One row per source: its index in order, number of documents, size, target, quota of slots, cumulative shares."""
    rows = docs.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; group them before mixing")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in rows]
    target = water_fill(sizes, [weights[i % len(weights)] for i in range(len(rows))], volume * sum(sizes), passes)
    out, low, all_ = [], 0.0, sum(target) or 1.0
    for i, r in enumerate(rows):
        words, size = round(target[i]), r["size"]
        blocks = -(-size // block)
        full, rest = divmod(words, size) if size else (0, 0)
        high = low + target[i] / all_
        out.append((i, r["source"], r["n"], size, target[i], words, blocks, full * blocks + -(-rest // block), low, high))
        low = high
    last = max((i for i, x in enumerate(out) if x[7]), default=-1)
    out = [(*x[:9], 2.0) if i == last else x for i, x in enumerate(out)]
    schema = {"src": pa.int32(), "source": pa.string(), "n": pa.int64(), "source_size": pa.int64(), "target": pa.float64(), "words": pa.int64(), "blocks": pa.int64(), "quota": pa.int64(), "low": pa.float64(), "high": pa.float64()}
    # from Arrow it is a relation that the driver has at hand; from rows each of its broadcasts would be a job over an RDD
    return docs.sparkSession.createDataFrame(pa.table({c: pa.array([x[i] for x in out], t) for i, (c, t) in enumerate(schema.items())}))


def schedule(plan: DataFrame) -> DataFrame:
    """The mix in order: ``slot, src, rank``, exactly ``quota`` slots for each source."""
    spark = plan.sparkSession
    total = plan.agg(F.sum("quota")).first()[0] or 0
    # a grid over [0, 1) turns the search for a point's source into an equi-join with at most sources + cells rows
    cells = F.explode(F.sequence(F.floor(F.col("low") * _CELLS), F.floor(F.least(F.col("high"), F.lit(1.0)) * _CELLS)))
    p = F.broadcast(plan.where("quota > 0").select("src", "low", "high", "quota", cells.alias("cell")))
    k = spark.range(total).withColumnRenamed("id", "slot")
    k = k.withColumn("u", (F.col("slot") + 1) * F.lit(GOLDEN) % F.lit(1.0)).withColumn("cell", F.floor(F.col("u") * _CELLS))
    hit = k.join(p, "cell").where("u >= low and u < high").drop("cell")
    hit = hit.withColumn("chunk", F.expr(f"slot div {_CHUNK * 16}"))
    counts = hit.groupBy("src", "chunk").agg(F.count(F.lit(1)).alias("c"))
    before = counts.withColumn("before", F.sum("c").over(Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("src", "chunk", F.coalesce("before", F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1
    ranked = hit.withColumn("inside", inside).join(before, ["src", "chunk"]).withColumn("rank", F.col("before") + F.col("inside"))
    on = ranked.where("rank < quota").select("slot", "src", "rank")
    have = counts.groupBy("src").agg(F.sum("c").alias("have"))
    late = F.broadcast(plan).join(have, "src", "left").where(F.coalesce("have", F.lit(0)) < F.col("quota"))
    late = late.select("src", F.explode(F.sequence(F.coalesce("have", F.lit(0)), F.col("quota") - 1)).alias("rank"))
    return on.unionByName(late.select((F.lit(total) + F.col("rank")).alias("slot"), "src", "rank"))


def _streams(docs: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """Each document's start in its source's shuffled stream of words."""
    p = F.broadcast(plan.select("src", "source", "source_size", "target", "n"))
    d = docs.join(p, docs["source"].eqNullSafe(p["source"])).select("doc_id", "size", "src", "source_size", "target", "n")
    d = d.withColumn("h", unsigned_hash(F.col("doc_id"), F.col("size"), seed=seed))
    d = d.withColumn("bucket", F.floor(F.col("h") * F.ceil(F.col("n") / F.lit(_CHUNK))).cast("int"))
    sums = d.groupBy("src", "bucket").agg(F.sum("size").alias("s"))
    sums = sums.withColumn("base", F.coalesce(F.sum("s").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    w = Window.partitionBy("src", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("inside", F.coalesce(F.sum("size").over(w), F.lit(0)))
    return d.join(sums.drop("s"), ["src", "bucket"]).withColumn("start", F.col("base") + F.col("inside")).drop("base", "inside", "h", "bucket", "n")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), volume: float = 1.5, passes: int = 2, block: int = BLOCK, seed: str = "mix") -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs`` (doc_id, source, text)."""
    return mix_sizes(materialize(docs.select("doc_id", "source", _size().alias("size")), "sizes"), weights, volume, passes, block, seed)


def _size():
    return F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")


def mix_sizes(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), volume: float = 1.5, passes: int = 2, block: int = BLOCK, seed: str = "mix") -> DataFrame:
    plan = source_plan(sized, weights, volume, passes, block)
    slots = schedule(plan)
    b = F.broadcast(plan.select("src", "blocks", "words", F.col("source_size").alias("of")))
    turns = slots.join(b, "src").withColumn("block", F.col("rank") % F.col("blocks"))
    reached = F.expr("rank div blocks") * F.col("of") + F.col("block") * block
    length = F.least(F.lit(block), F.col("of") - F.col("block") * block)
    turns = turns.withColumn("upto", F.least(length, F.col("words") - reached))
    # a block's turns: how often each of its words is taken; full turns and, at most once, a part from its start
    turns = materialize(turns.groupBy("src", "block").agg(F.collect_list("upto").alias("turns")), "turns")
    d = materialize(_streams(sized, plan, seed), "streams")
    some = d.where("size > 0")
    first, last = F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")
    parts = some.withColumn("block", F.explode(F.sequence(first, last))).join(turns.hint("merge"), ["src", "block"], "left")  # its file is far smaller than its rows, which must not be broadcast
    lo = F.greatest(F.lit(0).cast("long"), F.col("start") - F.col("block") * block)
    hi = F.least(F.lit(block).cast("long"), F.col("start") + F.col("size") - F.col("block") * block)
    taken = F.aggregate(F.coalesce("turns", F.array().cast("array<long>")), F.lit(0).cast("long"), lambda a, t: a + F.greatest(F.lit(0).cast("long"), F.least(hi, t) - lo))
    keys = ["src", "start", "doc_id", "size", "source_size", "target"]
    done = parts.withColumn("t", taken).groupBy(*keys).agg(F.sum("t").alias("taken"))
    none = d.where("size = 0").select(*keys, F.lit(0).cast("long").alias("taken"))
    return done.unionByName(none).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix as documents: each row of ``docs`` as often as the mix takes all its words, and, where the mix takes some of them
    once more, those: its first words, joined by one space. That is one document a source, the one at the end of its target.

    Documents without words stay, once: they weigh nothing. Identical rows share what they take.
    """
    key, t, n, k = (spare_name(docs, x) for x in ("key", "taken", "rows", "copy"))
    keyed = docs.withColumn(key, row_key("doc_id", "source", "text"))
    sized = materialize(keyed.select(F.col(key).alias("doc_id"), "source", _size().alias("size")), "sizes")
    taken = mix_sizes(sized, **how).groupBy("doc_id").agg(F.sum("taken").alias("t"), F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    # copies by their number of words; rows of one key are told apart by nothing, so all their copies are made of one of them
    size = F.greatest("size", F.lit(1))
    whole = F.array_repeat("size", F.expr("cast(t div greatest(size, 1) as int)"))
    copies = F.when(F.col("size") == 0, F.array_repeat("size", F.col("n").cast("int"))).otherwise(F.concat(whole, F.when(F.col("t") % size > 0, F.array(F.col("t") % size)).otherwise(F.array().cast("array<long>"))))
    plan = materialize(taken.select(F.col("doc_id").alias(key), copies.alias(t), F.col("n").alias(n), F.col("size").alias(k)), "copies").where(F.size(t) > 0)
    single = keyed.join(plan.where(F.col(n) == 1), key)
    double = keyed.join(plan.where(F.col(n) > 1), key).dropDuplicates([key])
    out = single.unionByName(double).withColumn(t, F.explode(t))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), F.lit(1), F.col(t).cast("int")), " ")
    return out.withColumn("text", F.when(F.col(t) < F.col(k), cut).otherwise(F.col("text"))).select(*docs.columns)


def op1_mix(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))
