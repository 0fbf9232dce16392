"""Queries over grounded export, provenance and model replies, on inline rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.functions import export as E
from quillmill.plans.registry import query
from quillmill.plans.tables import table, values

_PHRASES = [(i, p) for i, p in enumerate(["Black candles", "a Short-Position box", "long tool", "r:r 2", "BOS at high", "order block", "FVG", "sweep of liquidity", "dotted current price", "support line", "vertical line", "diagonal line", "callout label", "price tag", "demand area", "range box", "London session", "circle", "arrow up", "shaded box", "price axis", "timeline", "watermark", "symbol label", "timeframe_label", "venue_label", "price_axis_or_scale", "nothing", "", "blurry text in context", "Blurred header", "cropped at the left", "indicator text"])]


def _case(column: str, table_: tuple, before: str = "") -> str:
    test = lambda marks: " OR ".join(f"contains({column}, '{m}')" for m in marks)
    return f"CASE {before} " + " ".join(f"WHEN {test(m)} THEN '{n}'" for n, m in table_) + " END"


_SKIP = "WHEN " + " OR ".join(f"contains(lower(phrase), '{m}')" for m in E.NOT_LIMITATIONS) + " THEN NULL"


@query("visual_elements", f"SELECT id, coalesce({_case('l', E.ELEMENTS)}, '') AS element, {_case('lower(phrase)', E.LIMITATIONS, _SKIP)} AS limitation FROM (SELECT *, replace(lower(phrase), '_', ' ') AS l FROM ({values('id phrase', _PHRASES)}))")
def visual_elements(spark, sf_dir):
    p = F.col("phrase")
    return spark.sql(values("id phrase", _PHRASES)).select("id", E.element(p).alias("element"), E.limitation(p).alias("limitation"))


_TOKENS = [(1, "Euro / US-Dollar - 5 - FXCM"), (2, "BTC 1h and 15 minutes, h4"), (3, "D1 w1 3mo 1mo"), (4, "no frame 77"), (5, "2 hours / 30m / 30m")]


@query("export_timeframes", "SELECT * FROM (" + values("id all_frames explicit shown venue", [(1, "M5", "", "5", "FXCM"), (2, "H1,M15,H4", "H1,H4", "1h/15/4h", ""), (3, "D1,W1,MN1", "D1,W1,MN1", "1d/1w/1mo", ""), (4, "", "", "", ""), (5, "M30", "M30", "30", "")]) + ")")
def export_timeframes(spark, sf_dir):
    d = spark.sql(values("id text", _TOKENS)).withColumn("f", E.timeframes_in(F.col("text")))
    return d.select("id", F.array_join("f", ",").alias("all_frames"), F.array_join(E.timeframes_in(F.col("text"), True), ",").alias("explicit"), F.array_join(F.transform("f", E.timeframe_shown), "/").alias("shown"), E.venue_in(F.col("text")).alias("venue"))


@query("field_sources", """
WITH d AS (SELECT doc_id, lang, lower(source) AS s, lower(lang || ' ' || source) AS c FROM documents)
SELECT doc_id, CASE WHEN contains(regexp_replace(c, '[^a-z0-9]', '', 'g'), lang) AND contains(s, lang) THEN 'context+ocr' WHEN contains(regexp_replace(c, '[^a-z0-9]', '', 'g'), lang) THEN 'context' WHEN contains(s, lang) THEN 'ocr' ELSE 'heuristic' END AS lang_source, 'context+ocr' AS source_source FROM d
""")
def field_sources(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    context = F.concat_ws(" ", "lang", "source")
    return d.select("doc_id", E.source_of(F.array("lang"), context, F.col("source")).alias("lang_source"), E.source_of(F.array("source"), context, F.col("source")).alias("source_source"))


@query("source_promotion", "SELECT * FROM (" + values("id source", [(1, "context+ocr_normalization"), (2, "ocr_normalization"), (3, "ocr"), (4, "missing"), (5, "context")]) + ")")
def source_promotion(spark, sf_dir):
    d = spark.sql(values("id source visible ocr", [(1, "context", "true", "x"), (2, "heuristic", "true", "x"), (3, "ocr", "true", "x"), (4, "missing", "true", "x"), (5, "context", "false", "x")]))
    return d.select("id", E.promoted(F.col("source"), F.col("visible") == "true", F.col("ocr")).alias("source"))


_REPLIES = [
    (1, 'Sure:\n```json\n{"short_caption": "a  chart", "confidence": "HIGH"}\n```'), (2, 'text {"short_caption": "braces } in", "key_visual_elements": ["x", "x", " "]} tail'), (3, '{"short_caption": "says "hi" there"}'),
    (4, "no json"), (5, "[1, 2]"), (6, None),
]


@query("model_replies", "SELECT * FROM (" + values("id short_caption confidence elements", [(1, "a  chart", "high", ""), (2, "braces } in", "medium", "x,x"), (3, 'says "hi" there', "medium", ""), (4, None, None, None), (5, None, None, None), (6, None, None, None)]) + ")")
def model_replies(spark, sf_dir):
    d = spark.createDataFrame(_REPLIES, "id int, reply string").withColumn("j", E.reply_json(F.col("reply"))).withColumn("d", E.description(F.col("j")))
    told = lambda c: F.when(F.col("j").startswith("{"), c)
    return d.select("id", told(F.col("d.short_caption")).alias("short_caption"), told(F.col("d.confidence")).alias("confidence"), told(F.array_join("d.key_visual_elements", ",")).alias("elements"))


@query("page_summaries", """
WITH c AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS t FROM documents),
s AS (SELECT doc_id, CASE WHEN regexp_matches(t, '[.!?] ') THEN regexp_extract(t, '^(.*?[.!?]) ', 1) ELSE t END AS one FROM c),
e AS (SELECT doc_id, CASE WHEN length(one) <= 180 THEN one ELSE rtrim(substr(one, 1, 177)) || '...' END AS x FROM s)
SELECT doc_id, 'trade journal | symbols: BTCUSD | timeframes: H1, M5' || CASE WHEN x <> '' THEN ' | ' || x ELSE '' END AS summary FROM e
""")
def page_summaries(spark, sf_dir):
    a = lambda *v: F.array(*map(F.lit, v))
    return table(spark, sf_dir, "documents").select("doc_id", E.summary(F.lit("trade_journal"), a("BTCUSD"), a("H1", "M5"), F.array().cast("array<string>"), F.col("text")).alias("summary"))


@query("upload_errors", "SELECT * FROM (" + values("id stop", [(1, "true"), (2, "false"), (3, "false")]) + ")")
def upload_errors(spark, sf_dir):
    d = spark.createDataFrame([(1, "Upload limit reached", ["a.png"]), (2, "upload limit", []), (3, "timeout", ["a.png"])], "id int, error string, attachments array<string>")
    return d.select("id", E.upload_unavailable(F.col("error"), F.col("attachments")).cast("string").alias("stop"))


@query("enrichment_apply", "SELECT * FROM (" + values("id outcome symbol venue frames reasons quality changed", [
    (1, "enriched", "EURUSD", "FXCM", "M5", "", "high", "primary_symbol,instrument_name,venue,symbols,timeframes"), (2, "enriched", "", "", "", "missing_primary_symbol,missing_timeframe,llm_confidence_medium,llm_reported_uncertainty", "low", ""),
    (3, "error", "BTCUSD", "", "H1", "", "", ""), (4, "none", "", "", "", "", "", "")]) + ")")
def enrichment_apply(spark, sf_dir):
    from quillmill.operators import enrich

    assets = spark.createDataFrame([
        (1, "chart", 0.9, ("high",), "EURUSD", None, None, None, [], []), (2, "figure", 0.9, ("high",), "", None, None, None, [], []), (3, "chart", 0.9, ("high",), "", "BTCUSD", None, None, ["BTCUSD"], ["H1"]), (4, "figure", 0.2, ("low",), "", None, None, None, None, None),
    ], "id int, asset_type string, page_type_confidence double, labels struct<text_density:string>, ocr_text string, primary_symbol string, instrument_name string, venue string, symbols array<string>, timeframes array<string>")
    results = spark.createDataFrame([
        (1, "ok", '{"short_caption": "EURUSD chart", "visible_text": "Euro / US-Dollar - 5 - FXCM", "confidence": "high"}', "p"), (2, "ok", '{"short_caption": "a picture", "limitations": ["text is illegible"], "confidence": "odd"}', "p"), (3, "error", None, "p"),
    ], "id int, status string, reply string, prompt string")
    got = enrich.apply(assets, results)
    text = lambda c: F.coalesce(c, F.lit(""))
    return got.select("id", "outcome", text(F.col("primary_symbol")).alias("symbol"), text(F.col("venue")).alias("venue"), text(F.array_join("timeframes", ",")).alias("frames"), text(F.array_join("review_reasons", ",")).alias("reasons"), text(F.col("annotation_quality")).alias("quality"), text(F.when(F.col("outcome") == "enriched", F.array_join("changed", ","))).alias("changed"))
