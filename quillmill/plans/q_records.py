"""Queries over records, conversations, gates, batches and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.operators import gates, records
from quillmill.plans.registry import query
from quillmill.plans.tables import table, values


@query("flatten_props", "SELECT event_id, 'k: ' || json_extract_string(props, '$.k') AS lines FROM events")
def flatten_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.array_join(records.flatten_json(F.col("props")), "|").alias("lines"))


@query("flatten_nested")
def flatten_nested(spark, sf_dir):
    d = spark.createDataFrame([(1, '{"a": {"b": [1, 2.0, null, true]}, "c": {}}'), (2, "[]"), (3, '"x"'), (4, "bad"), (5, None)], "id int, payload string")
    return d.select("id", F.array_join(records.flatten_json(F.col("payload")), "|").alias("lines"))


@query("trade_candidates", """
SELECT event_id, event_type AS symbol, CASE WHEN value <> 0 THEN 35 ELSE 20 END / 100.0::DOUBLE AS confidence, true AS review_required FROM events WHERE CASE WHEN value <> 0 THEN 35 ELSE 20 END >= 35
""")
def trade_candidates(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    price = F.when(F.col("value").isNotNull(), F.when(F.col("value") == 0, F.lit("0.0")).otherwise(F.col("value").cast("string")))
    rec = F.map_filter(F.create_map(F.lit("symbol"), F.to_json(F.array(F.col("event_type"))), F.lit("entry"), price), lambda k, v: v.isNotNull())
    rec = F.transform_values(rec, lambda k, v: F.regexp_replace(v, r'^\[(.*)\]$', "$1"))
    got = records.trade_candidates(e, rec)
    return got.select("event_id", F.col("event_type").alias("symbol"), "confidence", "review_required")


_PAYLOADS = [
    (1, '{"symbol":"A","timeframe":"M5","direction":"long","entry":1.5,"thesis":"x","outcome":"win"}'), (2, '{"Ticker":"A","TF":"M5"}'), (3, '{"timeframe":"M5","entry":2}'),
    (4, '{"symbol":"A","direction":"short","entry":0}'), (5, '{"direction":"x","entry":1,"thesis":"t"}'), (6, '{"side":"buy","Side":"sell","symbol":"B","pnl":0}'), (7, "[]"), (8, "broken"), (9, '{"symbol":"","market":"M","tf":[]}'),
]


@query("record_confidence", "SELECT * FROM (" + values("id confidence", [(1, "1.0"), (2, "0.35"), (4, "0.4"), (5, "0.5"), (6, "0.4")]) + ")")
def record_confidence(spark, sf_dir):
    d = spark.createDataFrame(_PAYLOADS, "id int, payload string")
    return records.trade_candidates(d, records.normalize_record(F.col("payload"))).select("id", F.col("confidence").cast("string").alias("confidence"))


@query("decision_messages")
def decision_messages(spark, sf_dir):
    d = spark.createDataFrame(_PAYLOADS, "id int, payload string").withColumn("r", records.normalize_record(F.col("payload")))
    return d.select("id", F.to_json(records.decision_messages(F.col("r"))).alias("messages"))


@query("chat_validate", """
SELECT conv_id, count(*) AS n_messages, count(*) >= 2 AND bool_and(role IN ('system', 'user', 'assistant') AND coalesce(trim(text), '') <> '') AS valid FROM conversations GROUP BY conv_id
""")
def chat_validate(spark, sf_dir):
    c = gates.chats(table(spark, sf_dir, "conversations"))
    return c.select("conv_id", F.size("messages").cast("long").alias("n_messages"), gates.messages_valid(F.col("messages")).alias("valid"))


@query("example_errors", "SELECT * FROM (" + values("id errors", [(1, ""), (2, "invalid messages"), (3, "invalid messages"), (4, "missing id,invalid messages,missing metadata"), (5, "missing metadata.task_type,missing metadata.source_path")]) + ")")
def example_errors(spark, sf_dir):
    two = [("user", "a"), ("assistant", "b")]
    rows = [(1, "x", two, ("t", "p")), (2, "x", two[:1], ("t", "p")), (3, "x", [("user", "a"), ("bot", "b")], ("t", "p")), (4, " ", None, None), (5, "x", two, (" ", None))]
    d = spark.createDataFrame(rows, "id int, name string, messages array<struct<role:string,content:string>>, metadata struct<task_type:string,source_path:string>")
    return d.select("id", F.array_join(gates.example_errors(F.col("name"), F.col("messages"), F.col("metadata")), ",").alias("errors"))


@query("train_eval_split", """
WITH c AS (SELECT DISTINCT conv_id FROM conversations), r AS (SELECT conv_id, row_number() OVER (ORDER BY sha1('split::' || conv_id), conv_id) AS k, count(*) OVER () AS n FROM c)
SELECT conv_id, CASE WHEN k <= CASE WHEN n <= 1 THEN n ELSE greatest(1, n * 9 // 10) END THEN 'train' ELSE 'eval' END AS split FROM r
""")
def train_eval_split(spark, sf_dir):
    return gates.split_train_eval(table(spark, sf_dir, "conversations").select("conv_id").distinct(), "conv_id").select("conv_id", "split")


def _gated(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    a = {
        "pair_type": F.when(F.col("lang") != "es", "visual_asset"), "has_llm": F.col("n_chars") > 0, "review_required": F.col("toxic") == 1,
        "quality": F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low"), "confidence": F.lit(""), "caption": F.col("lang"),
        "summary": F.col("text"), "has_signal": F.col("n_chars") >= 100, "has_image": F.lit(True),
    }
    return d.select("doc_id", gates.export_reason(a).alias("reason"))


_GATE = """SELECT d.doc_id, CASE WHEN d.lang = 'es' OR d.lang IS NULL THEN 'not_visual_asset' WHEN NOT coalesce(d.n_chars > 0, false) THEN 'missing_llm_enrichment' WHEN l.toxic = 1 THEN 'review_required'
  WHEN l.quality = 0 THEN 'quality_below_medium' WHEN coalesce(d.text, '') = '' THEN 'missing_visual_summary' WHEN NOT coalesce(d.n_chars >= 100, false) THEN 'missing_visible_signal' ELSE 'ok' END AS reason
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""


@query("export_gate", _GATE)
def export_gate(spark, sf_dir):
    return _gated(spark, sf_dir)


@query("skip_histogram", f"SELECT reason, count(*) AS n FROM ({_GATE}) GROUP BY reason")
def skip_histogram(spark, sf_dir):
    return gates.histogram(_gated(spark, sf_dir), "reason")


@query("export_manifest")
def export_manifest(spark, sf_dir):
    m = gates.manifest(_gated(spark, sf_dir), "reason")
    return m.select("total", F.to_json("counts").alias("counts"))


@query("enrichment_jobs", """
WITH j AS (SELECT o_orderkey, o_custkey FROM orders o WHERE o_orderstatus = 'O' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')),
p AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS position FROM j)
SELECT o_orderkey, o_custkey, CAST(position AS INTEGER) AS position, position % 2 = 0 AS new_batch FROM p WHERE position < 5
""")
def enrichment_jobs(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey")
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    back = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    jobs = gates.enrichment_jobs(o, back, o.join(rich, "o_custkey", "left_semi"), "o_orderkey")
    return gates.batches(jobs, "o_custkey", ["o_orderkey"], 2, 5).select("o_orderkey", "o_custkey", "position", "new_batch")


@query("early_stop", """
WITH f AS (SELECT event_id, user_id, ts, event_type, max(CASE WHEN event_type = 'error' OR value > 95 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM events)
SELECT event_id, user_id, event_type FROM f WHERE coalesce(b, 0) = 0
""")
def early_stop(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return gates.stop_after_first(e, "user_id", ["ts", "event_id"], (F.col("event_type") == "error") | (F.col("value") > 95)).select("event_id", "user_id", "event_type")


@query("preserve_join", """
WITH cur AS (SELECT p_partkey AS id, CASE WHEN p_size % 7 <> 0 THEN p_brand || p_size END AS h FROM part), pri AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN p_brand || p_size ELSE p_brand || (p_size + 1) END AS h FROM part WHERE p_partkey % 2 = 0),
m AS (SELECT h, count(DISTINCT id) AS n, min(id) AS one FROM pri GROUP BY h)
SELECT c.id, CASE WHEN c.h IS NULL THEN CASE WHEN o.id IS NOT NULL THEN 'missing_current_image' ELSE 'none' END WHEN c.h = o.h OR m.n = 1 THEN 'preserved' WHEN m.n > 1 THEN 'duplicate_image_hash' WHEN o.id IS NOT NULL THEN 'image_changed' ELSE 'none' END AS status,
  CASE WHEN c.h = o.h THEN c.id WHEN m.n = 1 THEN m.one END AS prior_id
FROM cur c LEFT JOIN pri o ON o.id = c.id LEFT JOIN m ON m.h = c.h
""")
def preserve_join(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    key = lambda n: F.concat("p_brand", n.cast("string"))
    cur = p.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 7 != 0, key(F.col("p_size"))).alias("image_hash"))
    pri = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 3 == 0, key(F.col("p_size"))).otherwise(key(F.col("p_size") + 1)).alias("image_hash"))
    return gates.preserve(cur, pri)


@query("keyed_upsert", """
WITH u AS (SELECT o_custkey AS c_custkey, max_by(o_totalprice, o_orderkey) AS v FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, coalesce(u.v, c.c_acctbal) AS balance FROM customer c LEFT JOIN u USING (c_custkey) UNION ALL SELECT u.c_custkey, u.v FROM u WHERE u.c_custkey NOT IN (SELECT c_custkey FROM customer)
""")
def keyed_upsert(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    new = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("balance"), "o_orderkey")
    return gates.upsert(base, new, "c_custkey", "o_orderkey")


@query("annotation_quality", """
WITH a AS (SELECT d.doc_id, CASE WHEN lang = 'en' THEN 'BTCUSD' ELSE '' END AS symbol, n_chars % 2 AS tf, CASE WHEN n_chars % 3 = 0 THEN 'OKX' ELSE '' END AS venue, source AS ocr, lang AS context, coalesce(l.toxic = 1, false) AS review FROM documents d LEFT JOIN labels l USING (doc_id)),
r AS (SELECT *, list_filter([CASE WHEN review THEN 'auto_review_flag' END, CASE WHEN symbol = '' THEN 'missing_primary_symbol' END, CASE WHEN tf = 0 THEN 'missing_timeframe' END], lambda x: x IS NOT NULL) AS rs FROM a),
s AS (SELECT *, CAST(symbol <> '' AS INTEGER) + CAST(tf > 0 AS INTEGER) + CAST(venue <> '' AS INTEGER) + CAST(coalesce(ocr, '') <> '' AS INTEGER) + CAST(coalesce(context, '') <> '' AS INTEGER) + 1 - least(len(rs), 3) AS score FROM r)
SELECT doc_id, coalesce(array_to_string(rs, ','), '') AS reasons, CASE WHEN score >= 4 THEN 'high' WHEN score >= 2 THEN 'medium' ELSE 'low' END AS quality FROM s
""")
def annotation_quality(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    symbol, venue = F.when(F.col("lang") == "en", "BTCUSD").otherwise(""), F.when(F.col("n_chars") % 3 == 0, "OKX").otherwise("")
    frames = F.when(F.col("n_chars") % 2 == 1, F.array(F.lit("H1"))).otherwise(F.array().cast("array<string>"))
    reasons = gates.review_reasons(F.coalesce(F.col("toxic") == 1, F.lit(False)), F.lit("high"), F.lit("chart"), F.lit(0.9), F.lit("embedded_image"), F.col("source"), symbol, frames)
    d = d.withColumn("rs", reasons)
    return d.select("doc_id", F.array_join("rs", ",").alias("reasons"), gates.annotation_quality(symbol, frames, venue, F.col("source"), F.col("lang"), F.col("rs")).alias("quality"))


@query("source_files", "SELECT source AS tag, count(*) AS n FROM documents WHERE trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) <> '' GROUP BY source")
def source_files(spark, sf_dir):
    """Round trip of the file source: documents written as CSV files, read back as raw files, a document a record."""
    from quillmill.operators.corpus import document_rows
    from quillmill.sources import files

    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    root = f"{shared.rstrip('/')}/source-files-{spark.sparkContext.applicationId}"
    rows = document_rows(table(spark, sf_dir, "documents")).select("source_type", "text")
    # a file is read by one task: files of bounded size spread over all
    rows.write.mode("overwrite").option("header", "true").option("escape", '"').option("maxRecordsPerFile", 5_000).csv(root)
    got = files.read_documents(spark, root, "node")
    return got.groupBy(F.get_json_object("payload_json", "$.source_type").alias("tag")).agg(F.count(F.lit(1)).alias("n"))
