"""Grounded training pairs."""

import json

import pytest
from pyspark.sql import functions as F

from quillmill.functions import export as E
from quillmill.operators import pairs

SCHEMA = """id string, pair_type string, asset_type string, page_type string, caption string, summary string, ocr_text string, primary_symbol string, instrument_name string, venue string, timeframes array<string>,
review_required boolean, labels struct<likely_chart:boolean>,
llm_enrichment struct<structured_response:struct<short_caption:string,visual_summary:string,visible_text:string,key_visual_elements:array<string>,limitations:array<string>,confidence:string>>,
target_json struct<
  description:struct<short_caption:string,visual_summary:string,key_visual_elements:array<string>,limitations:array<string>>,
  observed:struct<visible_in_crop:struct<ocr_text:string,clean_text:string,normalized_fields:struct<primary_symbol:string,instrument_name:string,venue:string,symbols:array<string>,timeframes:array<string>>,visual_elements:array<string>>>,
  provenance:struct<quality:struct<annotation_quality:string>,field_sources:struct<primary_symbol:string,instrument_name:string,venue:string,symbols:string,timeframes:string>>>"""


def made(reply=None, clean="", tags=(), sources=None, fields=None, quality="high", **more):
    crop = {"clean_text": clean, "visual_elements": list(tags), "normalized_fields": fields, "ocr_text": more.pop("crop_ocr", None)}
    target = {"observed": {"visible_in_crop": crop}, "provenance": {"quality": {"annotation_quality": quality}, "field_sources": sources}}
    return {"pair_type": "visual_asset", "asset_type": "chart", "review_required": False, "llm_enrichment": reply and {"structured_response": reply}, "target_json": target} | more


LABEL = "Visible labels: Euro / US-Dollar, 5, FXCM"
CASES = {
    "conflict": made(
        {"short_caption": "EURUSD H1 bearish chart", "visual_summary": "A bearish EURUSD chart with highlighted BOS zones.", "visible_text": "Euro / US-Dollar, 1h, FXCM", "key_visual_elements": ["candlesticks", "price scale", "highlighted circles"],
         "limitations": ["annotation meaning is inferred rather than explicitly labeled", "exact price values are difficult to read precisely"], "confidence": "high"},
        "Asset type: chart\nTimeframes: H1\nVisible labels: Euro / US-Dollar - 5 - FXCM", ("generic_figure", "timeframe_label", "price_axis_or_scale"), asset_type="figure", page_type="unknown"),
    "bos": made({"short_caption": "BTCUSDT H1 chart with BOS label", "visual_summary": "BTCUSDT H1 candlestick chart with a visible BOS label.", "visible_text": "Bitcoin / TetherUS, 1h, BINANCE, BOS", "key_visual_elements": ["candlesticks", "BOS labels", "price scale"], "confidence": "high"},
                "Visible labels: Bitcoin / TetherUS, 1h, BINANCE, BOS", ("chart_panel",)),
    "price": made({"short_caption": "EURUSD M5 chart near 1.0850", "visual_summary": "EURUSD M5 candlestick chart with visible price action near 1.0850.", "key_visual_elements": ["candlesticks"], "confidence": "high"}, LABEL, ("chart_panel",)),
    "tool": made({"short_caption": "EURUSD M5 chart with short position risk/reward tool", "visual_summary": "EURUSD M5 candlestick chart with a visible short position risk/reward tool.", "key_visual_elements": ["candlesticks", "short position risk/reward tool"], "confidence": "medium"}, LABEL),
    "marker": made({"key_visual_elements": ["candlesticks", "vertical time marker", "price label"], "confidence": "high"}, LABEL),
    "ocr": made({"confidence": "high"}, "", (), {"instrument_name": "symbol_lookup_from_ocr_symbol", "venue": "ocr", "timeframes": "ocr_normalization"}, {"primary_symbol": "BTCUSDT", "instrument_name": "Bitcoin / TetherUS", "venue": "BINANCE", "timeframes": ["M15", "H4"]}, crop_ocr="TradingView Bitcoin / TetherUS, 15, BINANCE"),
    "context": made({"confidence": "high"}, "", (), {"instrument_name": "symbol_lookup_from_context_symbol", "venue": "context", "timeframes": "context"}, {"primary_symbol": "BTCUSDT", "venue": "BINANCE", "timeframes": ["M15"]}, crop_ocr="blurred", asset_type="figure"),
    "display": made({"confidence": "high"}, "", (), None, None, asset_type="unknown", page_type="strategy_note", primary_symbol="XAUUSD", ocr_text="gold / us dollar"),
    "low": made({"short_caption": "x", "confidence": "low"}, LABEL), "review": made({"confidence": "high"}, LABEL, review_required=True), "bare": made(None, LABEL), "medium": made({"confidence": "odd"}, LABEL, quality="low"), "page": made({"confidence": "high"}, LABEL, pair_type="page"),
}


@pytest.fixture(scope="module")
def got(spark):
    rows = [json.dumps({"id": k} | v) for k, v in CASES.items()]
    d = spark.createDataFrame([(r,) for r in rows], "j string").select(F.from_json("j", SCHEMA).alias("a")).select("a.*")
    rows = pairs.with_response(d)
    return {r["id"]: (r["reason"], json.loads(r["payload"])["response"]) for r in rows.select("id", pairs.reason(rows).alias("reason"), pairs.payload(F.col("response")).alias("payload")).collect()}


def test_header_wins_over_a_conflicting_reply(got):
    r = got["conflict"][1]
    assert [r[k] for k in ("asset_type", "primary_symbol", "instrument_name", "venue", "timeframes", "visible_text")] == ["chart", "EURUSD", "Euro / US-Dollar", "FXCM", ["M5"], "Euro / US-Dollar - 5 - FXCM"]
    assert r["instrument"] == {"primary_symbol": "EURUSD", "instrument_name": "Euro / US-Dollar", "venue": "FXCM", "timeframes": ["M5"]}
    assert r["short_caption"] == "Annotated EURUSD M5 chart with highlighted swing markers"
    assert r["visual_summary"] == 'Chart for EURUSD on M5. Visible elements include candlestick chart, price scale, and highlighted swing markers. Visible label text includes "Euro / US-Dollar - 5 - FXCM".'
    assert r["chart_content"]["visible_market_behavior"] == r["visual_summary"]
    assert (r["chart_content"]["chart_type"], r["chart_content"]["has_price_scale"], r["chart_content"]["has_time_axis"]) == ("candlestick", True, False)
    assert r["annotations"] == {"swing_markers": "highlighted local highs or lows visible in the chart crop"}
    assert r["visible_text_details"] == {"main_header": "Euro / US-Dollar - 5 - FXCM", "other_text_readability": "partially readable"}
    assert r["key_visual_elements"] == ["candlestick chart", "price scale", "highlighted swing markers", "timeframe label"]
    assert r["limitations"] == ["exact price values are difficult to read precisely"]
    assert r["confidence"] == {"overall": "high", "annotation_meaning": "medium", "exact_prices": "low", "symbol": "high", "timeframe": "high", "venue": "high"}


def test_grounded_replies_stay(got):
    bos, tool = got["bos"][1], got["tool"][1]
    assert "BOS label" in bos["key_visual_elements"]
    assert bos["chart_content"]["has_bos_label"] is True
    assert bos["annotations"]["bos_label"] == "visible BOS label or break-of-structure annotation"
    for k in ("bos", "price", "tool"):
        reply = CASES[k]["llm_enrichment"]["structured_response"]
        assert (got[k][1]["short_caption"], got[k][1]["visual_summary"]) == (reply["short_caption"], reply["visual_summary"])
    assert tool["chart_content"]["position_tool_direction"] == "short"
    assert tool["annotations"]["risk_reward_position_tool"] == "visible short position risk/reward tool with entry, risk, and reward regions"
    content = got["marker"][1]["chart_content"]
    assert (content["has_vertical_time_markers"], content["has_swing_markers"], content["has_text_annotations"]) == (True, False, True)
    assert set(got["marker"][1]["annotations"]) == {"vertical_time_markers", "text_annotations"}


def test_fields_without_a_header(got):
    r = got["ocr"][1]
    assert [r[k] for k in ("platform", "primary_symbol", "instrument_name", "venue", "timeframes")] == ["TradingView", "BTCUSDT", "Bitcoin / TetherUS", "BINANCE", ["M15"]]
    assert r["visual_summary"].startswith("TradingView chart for BTCUSDT on M15.")
    assert r["visible_text_details"]["watermark"] == "TradingView"
    bare = got["context"][1]
    assert "venue" not in bare
    assert "timeframes" not in bare
    assert bare["primary_symbol"] == "BTCUSDT" if "primary_symbol" in bare else True
    assert got["display"][1]["primary_symbol"] == "XAUUSD"
    assert got["display"][1]["instrument_name"] == "Gold / US Dollar"


def test_gates(got):
    assert {k: v[0] for k, v in got.items()} == {
        "conflict": "ok", "bos": "ok", "price": "ok", "tool": "ok", "marker": "ok", "ocr": "ok", "context": got["context"][0], "display": "ok", "low": "llm_confidence_low", "review": "review_required", "bare": "missing_llm_enrichment",
        "medium": "quality_below_medium", "page": "not_visual_asset",
    }


def test_symbols_of_names(spark):
    want = {"Euro / US-Dollar": "EURUSD", "euro / us dollar": "EURUSD", "EUR/USD": "EURUSD", "a BTCUSDT": "ABTCUSDT","BTCUSDT": "BTCUSDT", "Gold / Yen": "XAUJPY", "Solana / TetherUS": "SOLANA", "Apple": "", "": "", "XAG / Swiss Franc": "XAGCHF"}
    got = spark.createDataFrame([(k,) for k in want], "n string").select("n", pairs.symbol_of(F.col("n")).alias("s")).collect()
    assert {r["n"]: r["s"] for r in got} == want


def test_renormalize(spark):
    d = spark.createDataFrame([(json.dumps({"id": k} | CASES[k]),) for k in ("bos", "price")], "j string").select(F.from_json("j", SCHEMA).alias("a")).select("a.*")
    right = pairs.with_response(d).where("id = 'bos'").select("id", pairs.payload(F.col("response")).alias("payload")).first()["payload"]
    got = {r["id"]: r for r in pairs.renormalize(spark.createDataFrame([("bos", right), ("price", "{}"), ("gone", "{}")], "id string, payload string"), d).collect()}
    assert {k: (r["status"], r["changed"]) for k, r in got.items()} == {"bos": ("normalized", False), "price": ("normalized", True), "gone": ("missing_annotation", False)}


@pytest.mark.parametrize(("reply", "want"), [
    ('Sure {"a": {"b": [1]}} end', {"a": {"b": [1]}}), ('```json\n{"a": 1}\n```', {"a": 1}), ('text ```{"a": 2}```', {"a": 2}), ('{"a": "say "hi" there"}', {"a": 'say "hi" there'}), ('{"a": "x\r\ny"}', {"a": "x\ny"}),
    ('{"a": "brace } in"} tail', {"a": "brace } in"}), ("[1, 2]", [1, 2]), ('{"a": "tab\there"}', None), ("{broken", None), ("", None), (None, None), ('{ {"a": 1}', {"a": 1}), ('"quoted', None),
])
def test_replies(reply, want):
    got = E.parse_reply(reply)
    assert (json.loads(got) if got else None) == want
