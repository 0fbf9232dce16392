"""Asset and page annotations: market fields, visibility, targets, review."""

import json

import pytest
from pyspark.sql import functions as F

from quillmill.functions import extract as X
from quillmill.functions import geometry as G
from quillmill.functions import text as T
from quillmill.functions import visible as V
from quillmill.operators import annotations as A
from quillmill.operators import layout, records

LABELS = "struct<contains_symbol:boolean,contains_timeframe:boolean,contains_trade_levels:boolean,contains_performance_metrics:boolean,contains_strategy_rules:boolean,likely_chart:boolean,text_density:string>"
ANNOTATION = (
    "id string, caption string, description string, context_heading string, context_text string, ocr_text string, primary_symbol string, instrument_name string, venue string, symbols array<string>, timeframes array<string>, "
    f"bias string, direction string, setup_status string, trade_levels map<string,string>, trading_concepts array<string>, trading_domains array<string>, asset_type string, page_type string, labels {LABELS}, source_pdf string, "
    "page_number int, asset_index int, asset_source string, extraction_methods array<string>, page_type_confidence double, review_required boolean"
)


def annotation(id_, context, ocr, symbol, name, symbols, frames, levels=None):
    labels = (True, True, False, False, False, True, "medium")
    return (id_, "c", "d", "h", context, ocr, symbol, name, "BINANCE", symbols, frames, None, None, None, levels or {}, [], [], "chart", "chart", labels, "p.pdf", 1, 1, "embedded_image", ["nearby_text", "ocr"], 0.5, False)


def test_targets_keep_what_the_crop_bears_out(spark):
    rows = [
        annotation("both", "kein Setup im M15. NAS100USDT steht weiter unten.", "Bitcoin / TetherUS, 15, BINANCE", "BTCUSDT", "Bitcoin / TetherUS", ["BTCUSDT", "NAS100USDT"], ["M15", "H1"], {"entry": "15", "stop_loss": "9"}),
        annotation("context", "the text beside speaks of NAS100USDT and H1", "Volume profile, H1, BINANCE", "NAS100USDT", "Nasdaq 100 / TetherUS", ["NAS100USDT"], ["H1"]),
        annotation("venue", "BTCUSDT on M15", "Bitcoin / TetherUS, 15, BIMANCE", "BTCUSDT", "Bitcoin / TetherUS", ["BTCUSDT"], ["M15"]),
        annotation("fuzzy", "a bearish hour", "Bitcon / TetherUS, 1h, BINANCE", "BTCUSDT", "Bitcoin / TetherUS", ["BTCUSDT"], ["H1"]),
        annotation("none", "", "", None, None, [], []),
    ]
    got = A.with_target(A.read_names(spark.createDataFrame(rows, ANNOTATION), ocr="ocr_text"))
    t = {r["id"]: r["target_json"].asDict(recursive=True) for r in got.collect()}
    shown = {k: v["observed"]["visible_in_crop"]["normalized_fields"] for k, v in t.items()}
    source = {k: v["provenance"]["field_sources"] for k, v in t.items()}
    assert shown["both"]["symbols"] == ["BTCUSDT"]
    assert shown["both"]["timeframes"] == ["M15"]
    assert t["both"]["derived"]["symbols"] == ["BTCUSDT", "NAS100USDT"]
    assert source["both"]["trade_levels"] == "regex_from_context+ocr"
    assert t["both"]["observed"]["visible_in_crop"]["trade_levels"] == {"entry": "15"}
    assert shown["context"] == {"primary_symbol": None, "instrument_name": None, "venue": "BINANCE", "symbols": [], "timeframes": ["H1"]}
    assert (source["context"]["primary_symbol"], source["context"]["instrument_name"]) == ("context", "symbol_lookup_from_context_symbol")
    assert (shown["venue"]["venue"], source["venue"]["venue"]) == ("BINANCE", "ocr_normalization")
    assert (shown["fuzzy"]["primary_symbol"], shown["fuzzy"]["symbols"], source["fuzzy"]["primary_symbol"]) == ("BTCUSDT", ["BTCUSDT"], "ocr_normalization")
    assert t["none"]["provenance"]["context_scope"] == "crop_only"
    assert t["none"]["description"]["limitations"] == ["missing_primary_symbol", "missing_timeframe"]
    crop = t["fuzzy"]["observed"]["visible_in_crop"]
    assert crop["clean_text"].split("\n")[:5] == ["Asset type: chart", "Instrument: BTCUSDT", "Instrument label: Bitcoin / TetherUS", "Venue: BINANCE", "Timeframes: H1"]
    assert t["fuzzy"]["description"]["visual_summary"].startswith("Chart crop showing BTCUSDT on H1. Visible instrument label maps to Bitcoin / TetherUS. Visible venue label: BINANCE.")
    assert crop["visual_elements"] == ["chart_panel", "symbol_label", "timeframe_label", "venue_label", "ocr_text_overlay", "price_axis_or_scale"]


def test_annotate_assets_from_texts(spark):
    rows = [
        (1, "Im M15 kein Setup. NAS100USDT steht spaeter.", "Bitcoin / TetherUS, 15, BINANCE\nentry 65.000 and more words here", "embedded_image"),
        (2, "", "", "text_gap"), (3, "win rate and profit factor are fine", None, "vector_drawing"),
    ]
    box = G.box(F.lit(0), F.lit(0), F.lit(300), F.lit(400))
    d = spark.createDataFrame(rows, "asset_index int, context_text string, ocr_raw string, asset_source string")
    d = d.select(F.lit("x").alias("id"), F.lit("p.pdf").alias("source_pdf"), F.lit(1).alias("page_number"), "*", box.alias("asset"), G.box(F.lit(0), F.lit(0), F.lit(600), F.lit(800)).alias("page"), F.lit("head").alias("context_heading"), F.lit(1).alias("paired_text_blocks"), F.lit("page says H4").alias("page_text"))
    got = {r["asset_index"]: r.asDict(recursive=True) for r in A.annotate_assets(d).collect()}
    one, two, three = (got[i] for i in (1, 2, 3))
    assert (one["symbols"], one["primary_symbol"], one["instrument_name"], one["venue"], one["timeframes"]) == (["BTCUSDT"], "BTCUSDT", "Bitcoin / TetherUS", "BINANCE", ["M15"])
    assert (one["asset_type"], one["setup_status"], one["trade_levels"]) == ("chart", "no_setup", {"entry": "65.000"})
    assert one["caption"].startswith("BTCUSDT M15 chart | no setup | BINANCE | ")
    assert one["description"].startswith("Trading chart for BTCUSDT on M15. Instrument label: Bitcoin / TetherUS. Venue: BINANCE. Context states that no setup was present. Mentioned levels: entry 65.000.")
    assert "Setup status: no setup\nLevels: entry 65.000\nContext note: Im M15 kein Setup." in one["clean_text"]
    assert one["extraction_methods"] == ["nearby_text", "ocr"]
    assert one["labels"]["is_large_visual"] is True
    assert one["asset_bbox_ratio"] == {"x0": 0.0, "y0": 0.0, "x1": 0.5, "y1": 0.5}
    assert (two["timeframes"], two["review_required"], two["combined_text"]) == (["H4"], True, "")
    assert (three["asset_type"], three["ocr_text"]) == ("performance_panel", "")


def test_annotate_pages(spark):
    pages = spark.createDataFrame([("a", "p.pdf", 1, "Im H1 waren wir heute bearish\nIm M15 kein Setup", "03.10.2024"), ("b", "p.pdf", 2, "", None)], "id string, source_pdf string, page_number int, embedded_text string, ocr_text string")
    assets = spark.createDataFrame([("p.pdf", 1, 2, ["ETHUSD"], ["M5"]), ("p.pdf", 1, 1, ["BTCUSDT"], ["H1"])], "source_pdf string, page_number int, asset_index int, symbols array<string>, timeframes array<string>")
    got = {r["id"]: r for r in A.annotate_pages(pages, assets).collect()}
    assert (got["a"]["symbols"], got["a"]["timeframes"], got["a"]["asset_count"]) == (["BTCUSDT", "ETHUSD"], ["H1", "M15", "M5"], 2)
    assert got["a"]["combined_text"] == "Im H1 waren wir heute bearish\nIm M15 kein Setup\n03.10.2024"
    assert got["a"]["target_json"]["labels"]["has_ocr_text"] is True
    assert (got["b"]["page_type"], got["b"]["review_required"], got["b"]["symbols"]) == ("unknown", True, [])


@pytest.mark.parametrize(("text", "want"), [
    ("i | oF | FY SD\nl i LY\nBitcoin / TetherUS, 15, BINANCE", ["BTCUSDT"]), ("Bitcoin Gold / Tether", ["BTCUSDT"]), ("$A $ABCDE $ABCDEF", ["A", "ABCDE"]), ("USDUSD and EURUSD", ["EURUSD", "USDUSD"]),
    ("ether moved up some dollars", ["ETHUSD"]), ("nothing", []), (None, []),
])
def test_symbols(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(X.symbols(F.col("t")).alias("s")).first()["s"] == want


def test_decision_messages_hold_no_hindsight(spark):
    payloads = [
        {"ticker": "BTCUSD", "side": "long", "entry": 5, "sl": "4", "notes": "why é", "result": "win", "pnl": 7, "end_time": "z", "setup": {"a": [1, {}], "b": ""}}, {"symbol": "X", "entry": "1", "comment": ""}, {"symbol": "X"}, {"symbol": "X", "direction": 0, "entry": 0},
        {"symbol": "X", "direction": "short", "tp": [1, 2]},
    ]
    d = spark.createDataFrame([(i, json.dumps(p, ensure_ascii=False)) for i, p in enumerate(payloads)], "i int, p string").withColumn("r", records.normalize_record(F.col("p")))
    got = {r["i"]: r["m"] for r in d.select("i", records.decision_messages(F.col("r")).alias("m")).collect()}
    assert [m["role"] for m in got[0]] == ["system", "user", "assistant"]
    prompt = {"symbol": "BTCUSD", "direction": "long", "entry": 5, "stop_loss": "4", "thesis": {"a": [1, {}], "b": ""}, "notes": "why é"}
    reply = {"action": "long", "entry": 5, "stop_loss": "4", "thesis": {"a": [1, {}], "b": ""}}
    assert got[0][1]["content"] == "Review this historical trade setup and state the intended decision.\n\n" + json.dumps(prompt, ensure_ascii=False, indent=2)
    assert got[0][2]["content"] == json.dumps(reply, ensure_ascii=False, indent=2)
    assert got[1][2]["content"] == json.dumps({"entry": "1"}, indent=2)
    assert got[2] is None
    assert got[3] is None
    assert got[4][2]["content"] == json.dumps({"action": "short", "take_profit": [1, 2]}, indent=2)


def test_boxes_merge_once_both_are_grown(spark):
    rows = [("a", 1, 0.0, 0.0, 10.0, 10.0), ("a", 1, 30.0, 0.0, 40.0, 10.0), ("a", 1, 69.0, 0.0, 90.0, 10.0)]
    d = spark.createDataFrame(rows, "source_pdf string, page_number int, x0 double, y0 double, x1 double, y1 double")
    assert [(r["x0"], r["x1"]) for r in layout.cluster_boxes(d).orderBy("cluster").collect()] == [(0.0, 40.0), (69.0, 90.0)]


def test_blocks_of_assets(spark):
    page = G.box(F.lit(0), F.lit(0), F.lit(600), F.lit(800))
    box = lambda df, name: df.select("*", G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias(name)).drop("x0", "y0", "x1", "y1")
    edges = "x0 double, y0 double, x1 double, y1 double"
    a = spark.createDataFrame([("p", 1, 0, 50.0, 150.0, 280.0, 300.0), ("p", 1, 1, 50.0, 400.0, 280.0, 550.0), ("p", 2, 0, 50.0, 600.0, 550.0, 780.0)], f"source_pdf string, page_number int, asset_index int, {edges}")
    b = spark.createDataFrame([
        ("p", 1, 0, "Title", 16.0, 50.0, 100.0, 280.0, 140.0), ("p", 1, 1, "title", 10.0, 50.0, 142.0, 280.0, 148.0), ("p", 1, 2, "between", 10.0, 50.0, 340.0, 280.0, 360.0),
        ("p", 2, 0, "far one", 10.0, 60.0, 10.0, 540.0, 30.0), ("p", 2, 1, "far two", 10.0, 60.0, 50.0, 540.0, 70.0), ("p", 2, 2, "far three", 10.0, 60.0, 90.0, 540.0, 99.0), ("p", 2, 3, "aside", 10.0, 560.0, 100.0, 590.0, 110.0),
    ], f"source_pdf string, page_number int, block_index int, text string, font double, {edges}")
    got = layout.assign_blocks(box(a, "asset").withColumn("page", page), box(b, "block")).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["page_number"], r["asset_index"], r["position"])):
        by.setdefault((r["page_number"], r["asset_index"]), []).append(r["text"])
    # one of the two titles stays; what lies between, as near to both, goes to the asset it stands above; page 2 falls back on the two nearest
    assert by == {(1, 0): ["Title"], (1, 1): ["between"], (2, 0): ["far two", "far three"]}


def test_candidates_of_pages(spark):
    page = G.box(F.lit(0), F.lit(0), F.lit(600), F.lit(800))
    pages = spark.createDataFrame([("p", i) for i in (1, 2, 3)], "source_pdf string, page_number int").withColumn("page", page)
    box = lambda rows: spark.createDataFrame(rows, "source_pdf string, page_number int, x0 double, y0 double, x1 double, y1 double").select("source_pdf", "page_number", G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("bbox"))
    images = box([("p", 1, 50.0, 50.0, 500.0, 400.0), ("p", 1, 0.0, 700.0, 20.0, 720.0)])
    drawings = box([("p", 1, 60.0, 60.0, 490.0, 390.0), ("p", 2, 50.0, 50.0, 300.0, 300.0), ("p", 2, 320.0, 50.0, 590.0, 300.0), ("p", 2, 0.0, 500.0, 100.0, 501.0)])
    blocks = box([("p", 3, 50.0, 50.0, 550.0, 100.0), ("p", 1, 50.0, 700.0, 550.0, 720.0)])
    got = {(r["page_number"], r["source"], r["own_image"], r["x0"], r["y1"]) for r in layout.discover_candidates(pages, images, drawings, blocks).collect()}
    assert got == {(1, "embedded_image+vector_drawing", False, 50.0, 400.0), (2, "vector_drawing", False, 50.0, 300.0), (3, "text_gap", False, 18.0, 779.0)}


def test_lines_of_ocr(spark):
    ocr = "TradingView.com published\nBitcoin / TetherUS, 15, BINANCE\n12:00 13:00 14:00 15:00\nBitcoin / TetherUS, 15, binance\nab\nA longer line of words\nand one more of these\nfourth line of words"
    got = spark.createDataFrame([(ocr,)], "t string").select(V.label_lines(F.col("t")).alias("l"), T.distinct_lines(F.split("t", "\n")).alias("d")).first()
    assert got["l"] == ["Bitcoin / TetherUS, 15, BINANCE", "A longer line of words", "and one more of these"]
    assert len(got["d"]) == 7
    assert spark.range(1).select(V.label_parts(F.lit("Euro / US-Dollar · 5 • FXCM + x - y")).alias("p")).first()["p"] == ["Euro / US-Dollar", "5", "FXCM", "x", "y"]
