"""Model descriptions: the prompt that asks for one, and its merging into an annotation with all that follows from it.

The reply is parsed by one Python pass (:func:`export.reply_json`); text repair is handed marked rows only; everything else is columns. Fields
that a table lacks count as null (:func:`pairs.at`), so early annotations without a target can be enriched, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import export as E
from quillmill.functions import text as T
from quillmill.functions import visible as V
from quillmill.functions import vocab
from quillmill.operators.gates import encoding_artifacts
from quillmill.operators.pairs import at

# Venues and timeframes that a reply may name, words of limitations that tell of uncertainty, and those that are minor.
VENUES = ("BINANCE", "BYBIT", "COINBASE", "FXCM", "KRAKEN", "OANDA", "OKX")
FRAMES = {
    "M1": "m1|1m|1 minute|1-minute", "M5": "m5|5m|5 minute|5-minute", "M15": "m15|15m|15 minute|15-minute", "M30": "m30|30m|30 minute|30-minute", "H1": "h1|1h|1 hour|1-hour", "H4": "h4|4h|4 hour|4-hour",
    "D1": "d1|1d|daily", "W1": "w1|1w|weekly",
}
BARE_FRAMES = {"1": "M1", "3": "M3", "5": "M5", "15": "M15", "30": "M30", "60": "H1", "240": "H4"}
COMPONENTS = {
    "aud": "AUD", "australian dollar": "AUD", "bitcoin": "BTC", "british pound": "GBP", "btc": "BTC", "cad": "CAD", "canadian dollar": "CAD", "chf": "CHF", "eur": "EUR", "euro": "EUR", "gbp": "GBP", "japanese yen": "JPY",
    "jpy": "JPY", "new zealand dollar": "NZD", "nzd": "NZD", "usd": "USD", "us dollar": "USD", "us-dollar": "USD", "yen": "JPY",
}
UNSURE = ("unclear", "unreadable", "illegible", "cropped", "difficult to verify", "inaccurate", "approximate", "partially")
MINOR = (
    "small text", "small interface text", "partially unreadable", "partially illegible", "cropped", "blurry", "image resolution", "not fully legible", "price values are unclear",
    "indicator details are not fully legible",
)
MINOR_IF_GROUNDED = ("distorted", "difficult to read", "difficult to verify", "symbol and timeframe text", "price labels", "interface elements", "ocr output")
METHOD = "chatgpt_browser_llm"
PROMPT_FIELDS = (
    "asset_type", "page_type", "summary", "description", "context_heading", "context_text", "ocr_text", "combined_text", "primary_symbol", "instrument_name", "venue", "timeframes", "bias", "direction", "setup_status",
    "trade_levels", "trading_concepts", "labels",
)
PROMPT_HEAD = """You are creating training-grade image descriptions for a LoRA or vision-language fine-tuning dataset.
The attached image is the primary source of truth.
Use the supplied OCR/context only when it clearly matches what is plausible in the image.
Do not hallucinate unreadable numbers, indicators, labels, or trading claims.
Write all natural-language fields in {language}.
Return JSON only. No markdown. No code fences.

{{
  "short_caption": "8-20 words",
  "visual_summary": "1-3 sentences, image-grounded only",
  "context_augmented_summary": "1-4 sentences, may use matching OCR/context",
  "key_visual_elements": ["element_1", "element_2"],
  "limitations": ["unclear_text", "cropped_axis"],
  "visible_text": "short literal transcription of the most legible visible text",
  "training_tags": ["chart", "candlesticks", "price_scale"],
  "confidence": "high|medium|low"
}}

Focus on what makes the image useful for training:
- visible chart structure, panels, axes, legend areas, candles, lines, annotations, arrows, highlighted zones
- name annotation types precisely: text labels, price labels, horizontal/vertical lines, trendlines, current-price lines, arrows, swing markers, range boxes, session boxes, supply/demand zones
- identify trading-platform drawing tools by function when visible, especially long/short position or risk/reward tools; do not reduce them to generic rectangles
- distinguish session/range overlays from trade planning tools with entry, stop-loss/risk, take-profit/reward, CRV, R:R, or diagonal connector lines
- visible symbol, timeframe, venue, labels, indicators, performance metrics, notes
- whether the crop looks like a trading chart, a performance panel, or another market-related figure
- for visible_text, copy one short contiguous snippet exactly as seen; do not join separate fragments with ellipses
- mention uncertainty explicitly in limitations when text or details are unreadable

Additional extracted context:
"""


def prompt(rows: DataFrame, language: str = "en") -> Column:
    """The prompt for each annotation: instructions, then its fields as JSON, texts repaired; fields without a value are null."""
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    value = lambda n: F.lit(None).cast("string") if n not in fields else T.repair(F.col(n)) if fields[n] == "string" else F.col(n)
    payload = F.to_json(F.struct(value("id").alias("annotation_id"), *(value(n).alias(n) for n in PROMPT_FIELDS)), {"ignoreNullFields": "false", "pretty": "true"})
    return F.concat(F.lit(PROMPT_HEAD.format(language="German" if language.strip().lower() == "de" else "English")), payload)


def prompt_hash(text: Column) -> Column:
    return F.substring(F.sha1(text), 1, 16)


# what a text names


def _has(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def plain(c: Column) -> Column:
    """Repaired, with plain punctuation, stripped; null is empty."""
    return T.strip(T.punctuation(T.repair(F.coalesce(c, F.lit("")))))


def symbol_candidates(text: Column) -> Column:
    """Forex codes parted by a slash, then side by side, then ...USD(T); each once."""
    codes = "|".join(vocab.FOREX_CODES)

    def found(up: Column) -> Column:
        slash = F.transform(F.regexp_extract_all(up, F.lit(rf"\b(?:{codes})\s*/\s*(?:{codes})\b"), F.lit(0)), lambda p: F.regexp_replace(p, r"[\s/]", ""))
        side = F.regexp_extract_all(up, F.lit(rf"\b((?:{codes})(?:{codes}))\b"), F.lit(1))
        return F.array_distinct(F.concat(slash, side, F.regexp_extract_all(up, F.lit(r"\b([A-Z]{2,10}USDT?)\b"), F.lit(1))))

    return T.let(F.upper(T.fold(F.coalesce(text, F.lit("")))), found)


def venue_candidates(text: Column) -> Column:
    return T.let(F.upper(T.fold(F.coalesce(text, F.lit("")))), lambda up: F.array_compact(F.array(*(F.when(F.contains(up, F.lit(v)), v) for v in VENUES))))


def frame_candidates(text: Column, bare: bool = False) -> Column:
    """Timeframes named; with ``bare`` also numbers that stand before a venue."""
    venues = "|".join(v.lower() for v in VENUES)

    def found(low: Column) -> Column:
        named = [F.when(low.rlike(rf"\b(?:{p})\b"), k) for k, p in FRAMES.items()]
        numbers = [F.when(low.rlike(rf"\b{n}\b(?=\s*[,/|+-]?\s*(?:{venues})\b)"), k) for n, k in BARE_FRAMES.items()] if bare else []
        return F.array_distinct(F.array_compact(F.array(*named, *numbers)))

    return T.let(V.ascii_low(text), found)


def instrument_name(visible: Column) -> Column:
    """What stands before the first timeframe, number or venue of a header (repaired already), if it is a pair of names; else empty."""
    cut = rf"(?i)\s*(?:,|-|\|)\s*(?:M\d+|H\d+|D1|W1|\d+|{'|'.join(VENUES)})\b"
    head = T.let(F.split(T.strip(T.punctuation(F.coalesce(visible, F.lit("")))), cut, 2)[0], lambda x: F.regexp_replace(x, r"^[ \-|,]+|[ \-|,]+$", ""))
    return T.let(head, lambda h: F.when((F.length(h) >= 5) & (F.length(h) - F.length(F.replace(h, F.lit("/"), F.lit(""))) == 1), h).otherwise(""))


def component(name: Column) -> Column:
    def code(label: Column) -> Column:
        bare = F.upper(F.replace(label, F.lit(" "), F.lit("")))
        known = [F.when(F.contains(label, F.lit(x)), COMPONENTS[x]) for x in sorted(COMPONENTS, key=len, reverse=True)]
        return F.coalesce(*known, F.when(bare.isin(*vocab.FOREX_CODES), bare), F.lit(""))

    return T.let(T.label(F.coalesce(name, F.lit(""))), code)


def symbol_of(name: Column) -> Column:
    """The first symbol in an instrument's name, else that of its two sides; else empty."""
    sides = F.filter(F.transform(F.split(F.coalesce(name, F.lit("")), r"(?U)\s*/\s*", 2), lambda x: T.strip(x)), lambda x: x != "")
    pair = T.let(F.transform(sides, component), lambda c: F.when((F.size(c) == 2) & ~F.array_contains(c, ""), F.array_join(c, "")))
    return F.coalesce(F.try_element_at(symbol_candidates(name), F.lit(1)), pair, F.lit(""))


# visible text


def line_score(line: Column, a: dict[str, Column]) -> Column:
    """How much of an annotation's header a line shows. ``a``: symbol, instrument, venue, frames."""
    up, low = F.upper(line), F.lower(line)
    one = lambda c, n: F.when(F.coalesce(c, F.lit(False)), n).otherwise(0)
    holds = lambda c: _has(c) & F.contains(up, F.upper(c))
    frames = F.transform(F.coalesce(a["frames"], V.none()), lambda f: F.upper(f))
    names = F.filter(F.split(F.lower(T.punctuation(F.coalesce(a["instrument"], F.lit("")))), r"\s+"), lambda w: F.length(w) >= 4)
    unit = lambda letter, after: F.exists(frames, lambda f: f.rlike(rf"^{letter}\d+$") & F.regexp_like(low, F.concat(F.lit(r"\b"), F.substring(f, 2, 9), F.lit(rf"{after}\b"))))
    return (
        one(holds(a["symbol"]), 4) + one(F.exists(names, lambda w: F.contains(low, w)), 3) + one(holds(a["venue"]), 2) + one(F.contains(line, F.lit("/")), 2) + one(F.exists(frames, lambda f: F.contains(up, f)), 2)
        + one(unit("H", "h"), 2) + one(unit("M", ""), 1) + one(F.contains(low, F.lit("bos")), 1) - one(F.contains(low, F.lit("freigegeben")), 2) - one(F.contains(low, F.lit("tradingview.com")), 1)
    )


def best_line(ocr: Column, a: dict[str, Column]) -> Column:
    """Of the lines of an OCR text (repaired already) of six characters or more the one of highest score, the first of equals; else the first line; else empty."""

    def pick(lines: Column) -> Column:
        ranked = F.filter(F.transform(lines, lambda x, i: F.struct(line_score(x, a).alias("s"), (-i).alias("i"), x.alias("x"))), lambda r: F.length(r["x"]) >= 6)
        return F.coalesce(F.array_max(ranked)["x"], F.try_element_at(lines, F.lit(1)), F.lit(""))

    return T.let(V.clean_lines(ocr), pick)


def visible_text(told: Column, best: Column) -> Column:
    """What the model read (repaired already) if it is one whole snippet, else the best line of the OCR text, else what the model read."""
    t = T.strip(F.coalesce(told, F.lit("")))
    whole = (t != "") & ~t.contains("...") & ~t.contains("…") & ~t.contains("\n")
    return F.when(whole, t).otherwise(F.coalesce(F.nullif(best, F.lit("")), t))


# merging


def _several(c: Column) -> Column:
    return F.filter(F.transform(F.coalesce(c, V.none()), lambda x: T.strip(x)), lambda x: x != "")


def backfill(rows: DataFrame) -> DataFrame:
    """``rows`` (id, primary_symbol, instrument_name, venue, symbols, timeframes, d: description) with what the description fills in.

    Own values stay, but for timeframes, where visible ones win; ``changed`` lists the fields that moved.
    """
    d = F.col("d")
    bundle = F.concat_ws("\n", *(F.nullif(plain(c), F.lit("")) for c in (d["visible_text"], d["short_caption"], d["context_augmented_summary"], d["visual_summary"], F.array_join(d["training_tags"], " "))))
    rows = rows.withColumn("__bundle", bundle).withColumn("__name", instrument_name(d["visible_text"]))
    rows = rows.withColumns({"__seen": frame_candidates(d["visible_text"], True), "__old_s": _several(F.col("symbols")), "__old_f": _several(F.col("timeframes")), "__sym": symbol_of(F.coalesce(F.nullif("__name", F.lit("")), "instrument_name"))})
    named = symbol_candidates(F.col("__bundle"))
    rows = rows.withColumn("__found", T.let(named, lambda s: F.when((F.col("__sym") != "") & ~F.array_contains(s, F.col("__sym")), F.concat(F.array("__sym"), s)).otherwise(s)))
    venues = T.let(venue_candidates(d["visible_text"]), lambda v: F.when(F.size(v) > 0, v).otherwise(venue_candidates(F.col("__bundle"))))
    keep = lambda name, other: F.when(_has(F.col(name)), F.col(name)).when(_has(other), other).otherwise(F.col(name))
    symbol, first = keep("primary_symbol", F.try_element_at("__found", F.lit(1))), F.col("__old_s")
    merged = T.let(F.array_distinct(F.concat(first, F.col("__found"))), lambda m: F.when(_has(symbol) & ~F.array_contains(m, symbol), F.concat(F.array(symbol), m)).otherwise(m))
    frames = F.when(F.size("__seen") > 0, F.col("__seen")).when(F.size("__old_f") > 0, F.col("__old_f")).otherwise(frame_candidates(F.col("__bundle")))
    new = {"primary_symbol": symbol, "instrument_name": keep("instrument_name", F.col("__name")), "venue": keep("venue", F.try_element_at(venues, F.lit(1))), "symbols": merged, "timeframes": frames}
    rows = rows.withColumns({f"__new_{k}": c for k, c in new.items()})
    old = {"symbols": first, "timeframes": F.col("__old_f")}
    moved = F.array_compact(F.array(*(F.when(~F.col(f"__new_{k}").eqNullSafe(old.get(k, F.col(k))), k) for k in new)))
    rows = rows.withColumn("changed", moved).drop(*new, "__bundle", "__name", "__seen", "__old_s", "__old_f", "__sym", "__found")
    return rows.withColumnsRenamed({f"__new_{k}": k for k in new})


def grounded(asset_type: Column, instrument: Column, venue: Column, frames: Column, symbol: Column, visible: Column | None = None, chart: Column | None = None) -> Column:
    """A chart whose header names instrument, venue, timeframe and symbol; ``visible``, the text the model read, fills in what the annotation lacks
    and has to be there; ``chart``: other signs of a chart."""
    is_chart = (F.lower(F.coalesce(asset_type, F.lit(""))) == "chart") | (F.lit(False) if chart is None else F.coalesce(chart, F.lit(False)))
    if visible is None:
        return is_chart & _has(instrument) & _has(venue) & V.some(frames) & _has(symbol)
    name = F.when(_has(instrument), instrument).otherwise(instrument_name(visible))
    where = _has(venue) | (F.size(venue_candidates(visible)) > 0)
    framed = V.some(frames) | (F.size(frame_candidates(visible, True)) > 0)
    return is_chart & _has(visible) & T.let(name, lambda n: (n != "") & (_has(symbol) | (symbol_of(n) != ""))) & where & framed


def _any(low: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(E._any(low, words), F.lit(False))


def uncertain(limitations: Column, confidence: Column, visible: Column, strong: Column) -> Column:
    """Does what the model doubts ask for review? Not where all of it is minor, nor with high confidence and visible text."""
    low = F.transform(F.filter(F.coalesce(limitations, V.none()), lambda x: T.strip(x) != ""), lambda x: F.lower(T.fold(T.punctuation(x))))

    def judged(items: Column) -> Column:
        told = F.exists(items, lambda x: _any(x, UNSURE))
        more = strong & confidence.isin("high", "medium")
        minor = F.forall(items, lambda x: _any(x, MINOR) | (more & _any(x, MINOR_IF_GROUNDED)))
        return told & ~((confidence == "high") & _has(visible)) & (~_has(visible) | ~minor)

    return T.let(low, judged)


def review(a: dict[str, Column]) -> tuple[Column, Column]:
    """Review reasons and quality after enrichment. ``a``: density, page_confidence, ocr, symbol, venue, frames, confidence, limitations, visible, strong."""
    strong = a["strong"]
    unsure = uncertain(a["limitations"], a["confidence"], a["visible"], strong)
    weak = F.coalesce((a["page_confidence"] < 0.45) & (a["confidence"] != "high") & ~strong, F.lit(False))
    framed, broken = V.some(a["frames"]), encoding_artifacts(a["ocr"])
    low = (a["confidence"] == "low") | ((a["confidence"] == "medium") & ~strong)
    reasons = F.array_compact(F.array(
        F.when(a["density"] == "low", "low_text_density"), F.when(weak, "low_page_type_confidence"), F.when(broken, "ocr_encoding_artifacts"), F.when(~_has(a["symbol"]), "missing_primary_symbol"),
        F.when(~framed, "missing_timeframe"), F.when(low, F.concat(F.lit("llm_confidence_"), a["confidence"])), F.when(unsure, "llm_reported_uncertainty"),
    ))
    one = lambda c, by=1: F.when(c, by).otherwise(0)
    score = one(_has(a["symbol"])) + one(framed) + one(_has(a["venue"])) + one(_has(a["visible"])) + one(a["confidence"] == "high") + one(a["confidence"] == "low", -1) + one(weak, -1) + one(broken, -1) + one(unsure, -1)
    quality = F.when((score >= 4) & (a["confidence"] != "medium"), "high").when(score >= 2, "medium").otherwise("low")
    return reasons, quality


def clean_text(d: Column, symbol: Column, frames: Column, venue: Column) -> Column:
    """The description's fields and the market fields as lines; absent ones leave no line."""
    line = lambda name, c: F.when(_has(c), F.concat(F.lit(f"{name}: "), c))
    texts = [line(n, d[k]) for n, k in (("Short caption", "short_caption"), ("Visual summary", "visual_summary"), ("Context-aware summary", "context_augmented_summary"), ("Visible text", "visible_text"))]
    rest = [
        line("Training tags", F.array_join(d["training_tags"], ", ")), line("Confidence", d["confidence"]), line("Limitations", F.array_join(d["limitations"], "; ")), line("Primary symbol", symbol),
        line("Timeframes", F.array_join(frames, ", ")), line("Venue", venue),
    ]
    return T.strip(F.concat_ws("\n", *texts, *rest))


def crop_text(existing: Column, a: dict[str, Column], visible: Column) -> Column:
    """A crop's lines of facts (made anew where there are none) with its visible labels replaced by the text the model read."""
    head = {"asset_type": F.coalesce(a["asset_type"], F.lit("unknown")), "symbol": a["symbol"], "instrument": a["instrument"], "venue": a["venue"], "frames": _several(a["frames"]), "ocr": F.lit(""), "levels": F.create_map().cast("map<string,string>")}
    have = F.when(T.strip(F.coalesce(existing, F.lit(""))) != "", existing).otherwise(V.clean_text(head, own=True))
    lines = F.filter(F.transform(F.split(have, "\n"), lambda x: T.strip(x)), lambda x: (x != "") & ~F.startswith(F.lower(x), F.lit("visible labels:")))
    return T.let(T.strip(F.coalesce(visible, F.lit(""))), lambda v: F.array_join(F.when(v != "", F.array_append(lines, F.concat(F.lit("Visible labels: "), v))).otherwise(lines), "\n"))


def apply(assets: DataFrame, results: DataFrame) -> DataFrame:
    """Assets with their model results (id, status, reply, prompt) merged; ``outcome`` says enriched, error or none.

    assets: id, asset_type, page_type_confidence, labels (with text_density), ocr_text, primary_symbol, instrument_name, venue, symbols, timeframes, caption,
    summary, description, extraction_methods and, where there is one, target_json. Of an enriched asset all that follows from its description is
    set anew: caption, summary, description, clean_text, market fields, methods, review, llm_enrichment, ``changed`` (market fields the model
    filled in), ``description_block``, ``crop_clean_text``, ``review_reasons`` and ``annotation_quality``, which make up its target.
    """
    r = results.withColumn("j", E.reply_json(F.col("reply"))).select("id", "status", "prompt", "reply", "j")
    j = assets.join(r, "id", "left").withColumn("d", E.description(F.col("j")))
    told = "target_json.description"
    good = F.coalesce((F.col("status") == "ok") & F.col("j").startswith("{"), F.lit(False))
    j = j.withColumn("outcome", F.when(good, "enriched").when(F.col("status").isNotNull(), "error").otherwise("none"))
    d = F.col("d")
    # an early target had its description as one text; then the annotation's own texts stand in for the block's
    block = {n: at(assets, f"{told}.{n}") for n in ("visual_summary", "context_augmented_summary")}
    legacy = at(assets, told) if dict(assets.select("target_json.*").dtypes if "target_json" in assets.columns else []).get("description") == "string" else F.lit(None).cast("string")
    j = j.withColumn("__caption", V.first_filled(d["short_caption"], at(assets, "caption"), at(assets, "summary")))
    j = j.withColumn("__visual", V.first_filled(d["visual_summary"], block["visual_summary"]))
    j = j.withColumn("__context", V.first_filled(d["context_augmented_summary"], block["context_augmented_summary"], legacy, at(assets, "description"), F.col("__visual")))
    either = lambda name: F.when(V.some(d[name]), d[name]).otherwise(_several(at(assets, f"{told}.{name}", "array<string>")))
    header = {"symbol": F.col("primary_symbol"), "instrument": F.col("instrument_name"), "venue": F.col("venue"), "frames": F.col("timeframes")}
    j = j.withColumn("__ocr", T.repair(at(assets, "ocr_text"))).withColumn("__best", best_line(F.col("__ocr"), header))
    j = j.withColumn("d", F.struct(
        F.col("__caption").alias("short_caption"), F.col("__visual").alias("visual_summary"), F.col("__context").alias("context_augmented_summary"), visible_text(d["visible_text"], F.col("__best")).alias("visible_text"),
        either("key_visual_elements").alias("key_visual_elements"), either("limitations").alias("limitations"), d["training_tags"].alias("training_tags"), d["confidence"].alias("confidence"),
    ))
    on = F.col("outcome") == "enriched"
    market = ("primary_symbol", "instrument_name", "venue", "symbols", "timeframes")
    j = j.withColumns({f"__was_{n}": F.col(n) for n in market})
    j = backfill(j)
    j = j.withColumns({n: F.when(on, F.col(n)).otherwise(F.col(f"__was_{n}")) for n in market}).drop(*(f"__was_{n}" for n in market))
    sign = at(assets, "labels.likely_chart", "boolean") | at(assets, "labels.contains_timeframe", "boolean") | (F.lower(at(assets, "page_type")) == "chart")
    j = j.withColumn("__strong", grounded(F.col("asset_type"), F.col("instrument_name"), F.col("venue"), F.col("timeframes"), F.col("primary_symbol"), d["visible_text"], sign))
    reasons, quality = review({
        "density": at(assets, "labels.text_density"), "page_confidence": at(assets, "page_type_confidence", "double"), "ocr": at(assets, "ocr_text"), "symbol": F.col("primary_symbol"), "venue": F.col("venue"), "frames": F.col("timeframes"),
        "confidence": d["confidence"], "limitations": d["limitations"], "visible": d["visible_text"], "strong": F.col("__strong"),
    })
    j = j.withColumns({"review_reasons": F.when(on, reasons), "annotation_quality": F.when(on, quality)})
    keep = lambda name, c: F.when(on, c).otherwise(at(assets, name))
    facts = {"asset_type": F.col("asset_type"), "symbol": F.col("primary_symbol"), "instrument": F.col("instrument_name"), "venue": F.col("venue"), "frames": F.col("timeframes")}
    j = j.withColumns({
        "caption": keep("caption", F.col("__caption")), "summary": keep("summary", V.first_filled(F.col("__visual"), F.col("__caption"))), "description": keep("description", V.first_filled(F.col("__context"), F.col("__visual"), F.col("__caption"))),
        "clean_text": keep("clean_text", F.coalesce(F.nullif(clean_text(d, F.col("primary_symbol"), F.col("timeframes"), F.col("venue")), F.lit("")), at(assets, "clean_text"))),
        "extraction_methods": F.when(on, V.with_method(at(assets, "extraction_methods", "array<string>"), METHOD)).otherwise(at(assets, "extraction_methods", "array<string>")),
        "review_required": F.when(on, F.size("review_reasons") > 0).otherwise(at(assets, "review_required", "boolean")),
        "description_block": F.when(on, F.struct(*(d[n].alias(n) for n in ("short_caption", "visual_summary", "context_augmented_summary", "key_visual_elements", "limitations")))),
        "crop_clean_text": F.when(on, crop_text(at(assets, "target_json.observed.visible_in_crop.clean_text"), facts, d["visible_text"])),
        "llm_enrichment": F.when(on, F.struct(prompt_hash(F.col("prompt")).alias("prompt_hash"), T.repair(F.col("reply")).alias("raw_response_text"), d.alias("structured_response"))),
    })
    return j.drop("j", "prompt", "reply", "status", "d", "__caption", "__visual", "__context", "__strong", "__ocr", "__best")


# What stays of an annotation's earlier enrichment when it is made anew.
PRESERVED = ("caption", "summary", "description", "clean_text", "extraction_methods", "primary_symbol", "instrument_name", "venue", "symbols", "timeframes", "review_required", "llm_enrichment")
PRESERVED_TEXTS = ("short_caption", "visual_summary", "context_augmented_summary", "key_visual_elements", "limitations")


def prior_work(written: DataFrame) -> DataFrame:
    """Annotations already written that are worth keeping: of visual assets, enriched, with an id and a picture (image_hash)."""
    return written.where((F.col("pair_type") == "visual_asset") & F.col("llm_enrichment").isNotNull() & (T.strip(F.coalesce("id", F.lit(""))) != "") & F.col("image_hash").isNotNull())


def preserve(current: DataFrame, prior: DataFrame) -> DataFrame:
    """``current`` (id, image_hash, the preserved fields, target: struct description, extraction_methods, quality, review) with earlier work taken
    over where the picture is the same, and ``status`` (as of :func:`gates.preserve`).

    Of a target, texts come from the earlier one, methods are united as far as they are a model's, quality and review are the earlier ones.
    """
    from quillmill.operators import gates

    status = gates.preserve(current.select("id", "image_hash"), prior.select("id", "image_hash"))
    old = prior.dropDuplicates(["id"]).select(F.col("id").alias("prior_id"), F.struct(*(F.col(n) for n in (*PRESERVED, "target") if n in prior.columns)).alias("__old"))
    j = current.join(status, "id", "left").join(old, "prior_id", "left")
    names = [n for n in PRESERVED if n in current.columns and n in prior.columns]
    took = F.col("__old").isNotNull()
    j = j.withColumns({n: F.when(took, F.col(f"__old.{n}")).otherwise(F.col(n)) for n in names})
    if "target" in current.columns and "target" in prior.columns:
        was, now = F.col("__old.target"), F.col("target")
        texts = F.struct(*(F.coalesce(was["description"][n], now["description"][n]).alias(n) for n in PRESERVED_TEXTS))
        theirs = F.filter(F.coalesce(was["extraction_methods"], V.none()), lambda m: F.contains(F.lower(m), F.lit("llm")))
        target = F.struct(
            texts.alias("description"), F.array_distinct(F.concat(F.coalesce(now["extraction_methods"], V.none()), theirs)).alias("extraction_methods"),
            F.coalesce(was["quality"], now["quality"]).alias("quality"), F.coalesce(was["review"], now["review"]).alias("review"),
        )
        j = j.withColumn("target", F.when(took & was.isNotNull(), target).otherwise(now))
    return j.drop("__old", "prior_id")
