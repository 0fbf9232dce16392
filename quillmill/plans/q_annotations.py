"""Queries over annotations, grounded pairs and decision examples, on whole tables: every order stands for a picture.

The SQL states what must come out by tables of its own, typed from the pictures' making below, not from the package's vocabularies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.functions import text as T
from quillmill.operators import annotations, gates, pairs, records
from quillmill.plans.registry import query
from quillmill.plans.tables import table

#: A picture's header: instrument by order, timeframe by customer, venue by order.
_NAMES = (("Bitcoin / TetherUS", "BTCUSDT"), ("Ethereum / TetherUS", "ETHUSDT"), ("Gold / US Dollar", "XAUUSD"), ("Euro / US-Dollar", "EURUSD"))
_FRAMES = (("5m", "M5", "5"), ("1h", "H1", "1h"), ("15m", "M15", "15"))
_VENUES = ("BINANCE", "KRAKEN", "COINBASE")


def _pick(of: str, values) -> str:
    return f"CASE {of} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


_PARTS = f"""SELECT o_orderkey AS id, o_custkey, o_orderstatus AS status, {_pick('o_orderkey % 4', (n for n, _ in _NAMES))} AS name, {_pick('o_orderkey % 4', (s for _, s in _NAMES))} AS symbol,
  {_pick('o_custkey % 3', (t for t, _, _ in _FRAMES))} AS token, {_pick('o_custkey % 3', (f for _, f, _ in _FRAMES))} AS frame, {_pick('o_custkey % 3', (d for _, _, d in _FRAMES))} AS shown, {_pick('o_orderkey % 3', _VENUES)} AS venue FROM orders"""


def _pictures(spark, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.sql(_PARTS).withColumn("header", F.concat_ws(", ", "name", "token", "venue"))


@query("market_fields", f"""
SELECT id, CASE WHEN symbol <> 'EURUSD' THEN symbol END AS symbol, CASE symbol WHEN 'ETHUSDT' THEN 'Ethereum / TetherUS' WHEN 'BTCUSDT' THEN 'Bitcoin / TetherUS' WHEN 'XAUUSD' THEN 'Gold / US Dollar' END AS instrument, venue, frame AS frames FROM ({_PARTS})
""")
def market_fields(spark, sf_dir):
    p = _pictures(spark, sf_dir).select("id", F.lit("a note beside it").alias("context_text"), F.col("header").alias("ocr_text"), F.col("header").alias("combined_text"), F.lit("").alias("page_text"))
    got = annotations.market_fields(p)
    return got.select("id", F.col("primary_symbol").alias("symbol"), F.col("instrument_name").alias("instrument"), "venue", F.array_join("timeframes", ",").alias("frames"))


@query("grounded_pairs", f"""
SELECT id, symbol, name AS instrument, venue, frame AS frames, name || ' - ' || shown || ' - ' || venue AS visible_text, symbol || ' ' || frame || ' figure' AS caption,
  'Figure for ' || symbol || ' on ' || frame || '. Visible label text includes "' || name || ' - ' || shown || ' - ' || venue || '".' AS summary,
  CASE status WHEN 'F' THEN 'ok' WHEN 'O' THEN 'quality_below_medium' ELSE 'review_required' END AS reason FROM ({_PARTS})
""")
def grounded_pairs(spark, sf_dir):
    """Headers come as labels where the order is finished, else as OCR text that the fields rest on."""
    p, own = _pictures(spark, sf_dir), F.col("status") == "F"
    none = F.lit(None).cast("string")
    fields = F.struct(none.alias("primary_symbol"), F.when(~own, F.col("name")).alias("instrument_name"), F.when(~own, F.col("venue")).alias("venue"), F.when(~own, F.array("frame", F.lit("H4"))).alias("timeframes"))
    crop = F.struct(F.when(own, F.concat(F.lit("Asset type: figure\nVisible labels: "), F.col("header"))).alias("clean_text"), F.when(~own, F.col("header")).alias("ocr_text"), fields.alias("normalized_fields"))
    sources = F.struct(*(F.lit("ocr").alias(n) for n in ("instrument_name", "venue", "timeframes")))
    quality = F.struct(F.when(F.col("status") == "O", "low").otherwise("high").alias("annotation_quality"))
    reply = F.struct(F.lit("a potential move").alias("short_caption"), F.lit("high").alias("confidence"))
    a = p.select("id", F.lit("visual_asset").alias("pair_type"), F.lit("figure").alias("asset_type"), (F.col("status") == "P").alias("review_required"), F.struct(reply.alias("structured_response")).alias("llm_enrichment"),
                 F.struct(F.struct(crop.alias("visible_in_crop")).alias("observed"), F.struct(quality.alias("quality"), sources.alias("field_sources")).alias("provenance")).alias("target_json"))
    rows = pairs.with_response(a)
    r = F.col("response")
    return rows.select("id", r["primary_symbol"].alias("symbol"), r["instrument_name"].alias("instrument"), r["venue"].alias("venue"), F.array_join(r["timeframes"], ",").alias("frames"), r["visible_text"].alias("visible_text"),
                       r["short_caption"].alias("caption"), r["visual_summary"].alias("summary"), pairs.reason(rows).alias("reason"))


@query("decision_examples", """
WITH o AS (SELECT o_orderkey AS id, 'C' || o_custkey AS symbol, CASE o_orderstatus WHEN 'F' THEN 'long' WHEN 'O' THEN 'short' END AS direction, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS entry, o_orderpriority AS notes FROM orders),
p AS (SELECT *, '  "symbol": "' || symbol || '"' || coalesce(',' || chr(10) || '  "direction": "' || direction || '"', '') || coalesce(',' || chr(10) || '  "entry": "' || entry || '"', '') || ',' || chr(10) || '  "notes": "' || notes || '"' AS asked,
  coalesce('  "action": "' || direction || '",' || chr(10), '') || coalesce('  "entry": "' || entry || '",' || chr(10), '') || '  "thesis": "' || notes || '"' AS told FROM o)
SELECT id, CASE WHEN direction IS NOT NULL OR entry IS NOT NULL THEN 'Review this historical trade setup and state the intended decision.' || chr(10) || chr(10) || '{' || chr(10) || asked || chr(10) || '}' END AS prompt,
  CASE WHEN direction IS NOT NULL OR entry IS NOT NULL THEN '{' || chr(10) || told || chr(10) || '}' END AS reply FROM p
""")
def decision_examples(spark, sf_dir):
    """The order's end (its price) never reaches prompt or reply."""
    o = table(spark, sf_dir, "orders")
    fields = {
        "ticker": F.concat(F.lit("C"), F.col("o_custkey")), "side": F.create_map(F.lit("F"), F.lit("long"), F.lit("O"), F.lit("short"))[F.col("o_orderstatus")], "entry": F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey").cast("string")),
        "comment": F.col("o_orderpriority"), "pnl": F.col("o_totalprice").cast("string"),
    }
    m = records.decision_messages(records.normalize_columns(fields), nested=False)
    return o.select(F.col("o_orderkey").alias("id"), m.alias("m")).select("id", F.col("m")[1]["content"].alias("prompt"), F.col("m")[2]["content"].alias("reply"))


@query("page_fields", f"""
WITH a AS (SELECT o_custkey, symbol, frame, min(id) AS first FROM ({_PARTS}) GROUP BY ALL), s AS (SELECT o_custkey, symbol, min(first) AS f FROM a GROUP BY ALL), t AS (SELECT o_custkey, frame, min(first) AS f FROM a GROUP BY ALL)
SELECT c_custkey AS page, coalesce((SELECT string_agg(symbol, ',' ORDER BY f) FROM s WHERE s.o_custkey = c_custkey), '') AS symbols,
  coalesce((SELECT string_agg(frame, ',' ORDER BY f) FROM t WHERE t.o_custkey = c_custkey), CASE WHEN c_custkey % 3 = 1 THEN 'H1' ELSE '' END) AS frames,
  (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_assets FROM customer
""")
def page_fields(spark, sf_dir):
    """Pages are customers, their assets the orders."""
    c = table(spark, sf_dir, "customer")
    pages = c.select(F.col("c_custkey").alias("id"), F.lit("p").alias("source_pdf"), F.col("c_custkey").cast("int").alias("page_number"), F.when(F.col("c_custkey") % 3 == 1, "seen on 1h").otherwise("").alias("embedded_text"), F.lit("").alias("ocr_text"))
    p = _pictures(spark, sf_dir).select(F.lit("p").alias("source_pdf"), F.col("o_custkey").cast("int").alias("page_number"), F.col("id").alias("asset_index"), F.array("symbol").alias("symbols"), F.array("frame").alias("timeframes"))
    got = annotations.annotate_pages(pages, p)
    return got.select(F.col("id").alias("page"), F.array_join("symbols", ",").alias("symbols"), F.array_join("timeframes", ",").alias("frames"), F.col("asset_count").cast("long").alias("n_assets"))


@query("page_labels", """
WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS low, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r\\x0b\\x0c]+'), lambda x: x <> '')) AS n, lang FROM documents)
SELECT doc_id, CASE WHEN n < 25 THEN 'low' WHEN n < 120 THEN 'medium' ELSE 'high' END AS density, contains(low, 'entry') OR contains(low, 'stop') OR contains(low, 'tp') OR contains(low, 'target') AS levels,
  contains(low, 'pnl') OR contains(low, 'drawdown') OR contains(low, 'win rate') OR contains(low, 'profit factor') OR contains(low, 'sharpe') AS metrics,
  contains(low, 'strategy') OR contains(low, 'rules') OR contains(low, 'checklist') OR contains(low, 'criteria') AS rules,
  n < 25 OR low = '' OR contains(low, chr(195)) OR contains(low, chr(194)) OR contains(low, chr(65533)) OR contains(low, 'â€') OR contains(low, 'ï¿½') OR lang = 'de' AS review FROM d
""")
def page_labels(spark, sf_dir):
    """German documents stand for pages without timeframes. Artifacts are looked for in lower case, where accented capitals aren't taken for them."""
    d = table(spark, sf_dir, "documents")
    low, one, none = F.lower(F.coalesce("text", F.lit(""))), F.array(F.lit("x")), F.array().cast("array<string>")
    lab = annotations.labels(F.col("text"), one, one, F.lit(False))
    frames = F.when(F.col("lang") == "de", none).otherwise(one)
    review = gates.page_needs_review(F.coalesce("text", F.lit("")), lab["text_density"], F.lit("chart"), F.lit(0.5), low, one, frames, F.lit(1))
    return d.select("doc_id", lab["text_density"].alias("density"), lab["contains_trade_levels"].alias("levels"), lab["contains_performance_metrics"].alias("metrics"), lab["contains_strategy_rules"].alias("rules"), review.alias("review"))
