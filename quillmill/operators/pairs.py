"""Strict training pairs: the response to a picture, grounded in what its header, OCR text and elements show.

An annotation table becomes pairs by stages of columns: grounded fields, elements and limitations, caption and summary, then the
response as one struct, whose absent parts are null and so leave no trace in JSON. No stage shuffles; nothing leaves the JVM.

An annotation: id, pair_type, asset_type, page_type, caption, summary, ocr_text, primary_symbol, instrument_name, venue, timeframes, review_required,
labels (with likely_chart), llm_enrichment (struct, with structured_response), target_json (struct as of ``annotations``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillmill.functions import export as E
from quillmill.functions import text as T
from quillmill.functions import visible as V
from quillmill.operators import gates

SCHEMA_VERSION, TASK = "1.1", "strict_image_to_json"
# Fixed value: the instruction that goes with every pair.
PROMPT = (
    "Analyze the attached trading-related image and return a concise JSON object using only directly visible evidence from the image crop. "
    "Preserve the structured response shape, separate clearly visible facts from uncertain interpretation, and omit fields that are not supported by the image."
)
GENERIC = "trading-related"


def at(df: DataFrame, path: str, kind: str = "string") -> Column:
    """A nested field, or a null of ``kind`` where the table has none: annotations come with and without enrichment."""
    schema = df.schema
    for name in path.split("."):
        if not isinstance(schema, StructType) or name not in schema.names:
            return F.lit(None).cast(kind)
        schema = schema[name].dataType
    return F.col(path).cast(kind)


def _list(df: DataFrame, path: str) -> Column:
    """A list of texts, collapsed, each once, blank ones dropped; empty where there is none."""
    clean = F.filter(F.transform(F.coalesce(at(df, path, "array<string>"), V.none()), T.collapse), lambda x: x != "")
    return F.array_distinct(clean)


# instruments


def component(name: Column) -> Column:
    """Code of one side of a pair: of the longest alias its label holds."""
    aliases = sorted(E.COMPONENTS, key=len, reverse=True)

    def code(label: Column) -> Column:
        bare = F.upper(F.replace(label, F.lit(" "), F.lit("")))
        return F.coalesce(*(F.when(F.contains(label, F.lit(x)), E.COMPONENTS[x]) for x in aliases), F.when(bare.isin(*E.COMPONENT_CODES), bare), F.lit(""))

    return T.let(T.label(F.coalesce(name, F.lit(""))), code)


_NAMES = {" ".join(re.findall("[a-z0-9]+", v.lower())): k for k, v in E.INSTRUMENTS.items()}


def symbol_of(name: Column) -> Column:
    """Symbol of an instrument's name: of its display name, of a code in it, or of its two sides; else empty."""

    def symbol(n: Column) -> Column:
        by_name = F.try_element_at(F.create_map(*(F.lit(x) for kv in _NAMES.items() for x in kv)), T.label(n))
        code = F.regexp_extract(F.upper(F.regexp_replace(T.fold(n), r"\s+", "")), r"\b([A-Z]{6}|[A-Z]{2,10}(?:USD|USDT))\b", 1)
        sides = F.filter(F.transform(F.split(n, r"(?U)\s*/\s*", 2), lambda x: T.strip(x)), lambda x: x != "")
        pair = T.let(F.transform(sides, component), lambda c: F.when((F.size(c) == 2) & ~F.array_contains(c, ""), F.array_join(c, "")))
        return F.coalesce(by_name, F.nullif(code, F.lit("")), pair, F.lit(""))

    return T.let(F.coalesce(name, F.lit("")), symbol)


def display_name(symbol: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in E.INSTRUMENTS.items() for x in kv))
    return F.coalesce(F.try_element_at(table, F.coalesce(symbol, F.lit(""))), F.lit(""))


def parsed_label(line: Column) -> Column:
    """Of the best candidate of a header line (candidates part at ``;``): struct instrument_name, venue, timeframes.

    Best: a slash or a venue counts two, a timeframe one; then the longest, then the first.
    """
    cands = F.filter(F.transform(F.split(F.coalesce(line, F.lit("")), ";"), V.label_text), lambda x: x != "")
    frames = lambda parts: F.filter(F.transform(parts, E.timeframe_of), lambda f: f != "")
    two = lambda c: F.when(c, 2).otherwise(0)
    score = lambda c: two(F.contains(c, F.lit("/"))) + two(E.venue_in(c) != "") + F.when(F.size(frames(V.label_parts(c))) > 0, 1).otherwise(0)
    ranked = F.transform(cands, lambda c, i: F.struct(score(c).alias("s"), F.length(c).alias("n"), (-i).alias("i"), c.alias("c")))

    def fields(best: Column, parts: Column) -> Column:
        rest = F.slice(parts, 2, 1000)
        venues = F.filter(F.transform(F.filter(rest, lambda p: E.timeframe_of(p) == ""), E.venue_in), lambda v: v != "")
        named = T.let(frames(rest), lambda n: F.when(F.size(n) > 0, n).otherwise(E.timeframes_in(best)))
        return F.struct(F.try_element_at(parts, F.lit(1)).alias("instrument_name"), F.coalesce(F.try_element_at(venues, F.lit(1)), E.venue_in(best)).alias("venue"), F.array_distinct(named).alias("timeframes"))

    return T.let(F.array_max(ranked)["c"], lambda best: T.let(V.label_parts(best), lambda parts: F.when(F.size(parts) > 0, fields(best, parts))))


# grounding


def frame_shown(frame: Column, *texts: Column) -> Column:
    return V.frame_shown(frame, F.concat_ws("\n", *(F.nullif(t, F.lit("")) for t in texts)), E.FRAME_NAMES, E.EXPORT_VENUES)


def symbol_shown(symbol: Column, *texts: Column) -> Column:
    """A symbol stands in a text, or in its own display name, blanks aside; or a text holds that name."""
    squeezed = lambda c: F.upper(F.regexp_replace(T.fold(F.coalesce(c, F.lit(""))), r"\s+", ""))
    every = F.concat_ws("\n", *(squeezed(t) for t in (*texts, display_name(symbol))))
    labels = F.concat_ws("\n", *(T.label(F.coalesce(t, F.lit(""))) for t in texts))
    code, name = squeezed(symbol), T.label(display_name(symbol))
    return T.let(code, lambda c: (c != "") & F.contains(every, c)) | T.let(name, lambda n: (n != "") & F.contains(labels, n))


def visible_text(raw: Column, instrument: Column, frames: Column, venue: Column, symbol: Column) -> Column:
    """``label - frames - venue`` where two of them are known, else the header as read."""
    name = F.coalesce(F.nullif(instrument, F.lit("")), symbol, F.lit(""))
    parts = F.filter(F.array(*(T.collapse(c) for c in (name, F.array_join(F.transform(F.slice(frames, 1, 2), E.timeframe_shown), "/"), F.coalesce(venue, F.lit(""))))), lambda p: p != "")
    return F.when(F.size(parts) >= 2, F.array_join(parts, " - ")).otherwise(V.label_text(raw))


def grounded(rows: DataFrame) -> DataFrame:
    """Adds ``g``: visible_text, primary_symbol, instrument_name, venue and timeframes as far as the picture shows them; texts absent are empty."""
    crop, reply, sources = "target_json.observed.visible_in_crop", "llm_enrichment.structured_response", "target_json.provenance.field_sources"
    rows = rows.withColumns({
        "__clean": V.first_filled(at(rows, f"{crop}.clean_text")), "__ocr": V.first_filled(at(rows, f"{crop}.ocr_text"), at(rows, "ocr_text")), "__reply": F.coalesce(at(rows, f"{reply}.visible_text"), F.lit("")),
    })
    rows = rows.withColumn("__label", V.first_filled(V.prefixed_line(F.col("__clean"), "visible labels:"), F.col("__reply"))).withColumn("__parsed", parsed_label(F.col("__label")))
    label, ocr, parsed = F.col("__label"), F.col("__ocr"), F.col("__parsed")
    own = lambda name: V.first_filled(at(rows, f"{crop}.normalized_fields.{name}"), at(rows, name))
    by_ocr = lambda name: F.coalesce(at(rows, f"{sources}.{name}").contains("ocr"), F.lit(False))
    seen = F.concat_ws("\n", T.label(label), T.label(ocr))
    trusted = lambda name: T.let(own(name), lambda v: F.when(by_ocr(name) & T.let(T.label(v), lambda x: (x != "") & F.contains(seen, x)), v).otherwise(""))
    frames = _list(rows, f"{crop}.normalized_fields.timeframes")
    frames = F.when(F.size(frames) > 0, frames).otherwise(_list(rows, "timeframes"))
    told = F.coalesce(parsed["timeframes"], V.none())
    rows = rows.withColumns({
        "__name": V.first_filled(parsed["instrument_name"], trusted("instrument_name")), "__venue": V.first_filled(parsed["venue"], trusted("venue")), "__own": own("primary_symbol"),
        "__frames": F.array_distinct(F.when(F.size(told) > 0, told).when(by_ocr("timeframes"), F.filter(frames, lambda f: frame_shown(f, label, ocr))).otherwise(V.none())),
    })
    symbol = F.coalesce(F.nullif(symbol_of(F.col("__name")), F.lit("")), F.when(symbol_shown(F.col("__own"), label, ocr), F.col("__own")), F.lit(""))
    rows = rows.withColumn("__symbol", symbol)
    rows = rows.withColumn("__name", F.when(F.col("__name") != "", F.col("__name")).otherwise(display_name(F.col("__symbol"))))
    shown = visible_text(label, F.col("__name"), F.col("__frames"), F.col("__venue"), F.col("__symbol"))
    fields = {"visible_text": shown, "primary_symbol": F.col("__symbol"), "instrument_name": F.col("__name"), "venue": F.col("__venue"), "timeframes": F.col("__frames")}
    return rows.withColumn("g", F.struct(*(c.alias(n) for n, c in fields.items()))).drop("__label", "__parsed", "__name", "__venue", "__own", "__frames", "__symbol")


def classified(rows: DataFrame) -> DataFrame:
    """Adds ``elements``, ``limits``, ``platform`` and ``kind`` (the asset type, repaired; empty if unknown)."""
    reply, told, crop = "llm_enrichment.structured_response", "target_json.description", "target_json.observed.visible_in_crop"
    tags = _list(rows, f"{crop}.visual_elements")
    raw = F.concat(_list(rows, f"{reply}.key_visual_elements"), _list(rows, f"{told}.key_visual_elements"), tags)
    limits = F.concat(_list(rows, f"{reply}.limitations"), _list(rows, f"{told}.limitations"))
    rows = rows.withColumns({"elements": F.array_distinct(F.filter(F.transform(raw, E.element), lambda e: e != "")), "limits": F.array_distinct(F.array_compact(F.transform(limits, E.limitation)))})
    words = F.concat_ws(" ", "__ocr", "__clean", "__reply", F.array_join("elements", " "))
    texts = [V.first_filled(at(rows, n)) for n in ("asset_type", "page_type", "caption", "summary", f"{reply}.short_caption", f"{reply}.visual_summary")]
    low = V.ascii_low(F.concat_ws(" ", *texts, F.array_join("elements", " "), F.col("g.visible_text")))
    signs = F.arrays_overlap(tags, F.array(*map(F.lit, ("chart_panel", "price_axis_or_scale", "timeframe_label"))))
    chart = at(rows, "page_type").eqNullSafe("chart") | F.coalesce(at(rows, "labels.likely_chart", "boolean"), F.lit(False)) | F.coalesce(signs, F.lit(False)) | low.rlike("chart|candlestick|tradingview|price scale|time axis")
    named = lambda n: F.nullif(F.nullif(F.lower(V.first_filled(at(rows, n))), F.lit("unknown")), F.lit(""))
    return rows.withColumns({"platform": F.when(F.contains(V.ascii_low(words), F.lit("tradingview")), "TradingView").otherwise(""), "kind": F.when(chart, "chart").otherwise(F.coalesce(named("asset_type"), named("page_type"), F.lit("")))})


# captions and summaries


def _subject() -> Column:
    return F.coalesce(F.nullif(F.col("g.primary_symbol"), F.lit("")), F.nullif(F.col("g.instrument_name"), F.lit("")), F.lit(GENERIC))


def _frames() -> Column:
    return F.array_join(F.slice("g.timeframes", 1, 2), "/")


def acceptable(text: Column, low: Column, elements: Column, frames: Column) -> Column:
    """A text (and its folded form) that doesn't interpret, names no other timeframe than those shown, and no technical label without its element."""
    have = F.transform(elements, lambda e: F.lower(e))
    lacks = F.lit(False)
    for word, needed in E.NEEDS.items():
        lacks = lacks | (F.contains(low, F.lit(word)) & ~F.arrays_overlap(have, F.array(*map(F.lit, needed))))
    conflict = T.let(E.timeframes_in(text, True), lambda said: (F.size(frames) > 0) & (F.size(said) > 0) & ~F.arrays_overlap(said, frames))
    return ~E._any(low, E.HEDGES) & ~conflict & ~F.coalesce(lacks, F.lit(False))


def names_subject(text: Column) -> Column:
    names = F.transform(F.array(F.col("g.primary_symbol"), F.col("g.instrument_name"), _frames()), T.label)
    return T.let(T.label(F.coalesce(text, F.lit(""))), lambda label: F.exists(names, lambda n: (n != "") & F.contains(label, n)))


def made_caption(kind: Column) -> Column:
    subject, frames, noun = _subject(), _frames(), F.when(kind == "", "visual").otherwise(V.spoken(kind))
    plain = F.concat_ws(" ", subject, F.nullif(frames, F.lit("")), noun)
    bare = F.concat(F.lit("Trading-related "), noun, F.when(frames != "", F.concat(F.lit(" with visible timeframe "), frames)).otherwise(""))
    base, extra = F.when(subject == GENERIC, bare).otherwise(plain), E.caption_modifiers(F.col("elements"))
    marked = F.when(F.arrays_overlap(extra, F.array(*map(F.lit, E.MARKING))), "Annotated ").otherwise("")
    return F.when(F.size(extra) > 0, F.concat(marked, base, F.lit(" with "), E.listed(extra))).otherwise(base)


def made_summary(kind: Column) -> Column:
    subject, frames = _subject(), _frames()
    branded = F.contains(V.ascii_low(F.col("__ocr")), F.lit("tradingview")) | F.array_contains("elements", "TradingView header or watermark")
    lead = F.when(kind == "chart", F.when(branded, "TradingView chart").otherwise("Chart")).when(kind != "", V.sentence_case(kind)).otherwise("Trading-related visual")
    rest = (
        F.when((subject != GENERIC) & (frames != ""), F.concat(F.lit(" for "), subject, F.lit(" on "), frames)).when(subject != GENERIC, F.concat(F.lit(" for "), subject))
        .when(frames != "", F.concat(F.lit(" with visible timeframe "), frames)).otherwise("")
    )
    shown = F.filter("elements", lambda e: ~e.isin(*E.HEADER_ELEMENTS))
    text = F.col("g.visible_text")
    return F.concat_ws(" ", F.concat(lead, rest, F.lit(".")), F.when(F.size(shown) > 0, F.concat(F.lit("Visible elements include "), E.listed(F.slice(shown, 1, 4)), F.lit("."))), F.when(text != "", F.concat(F.lit('Visible label text includes "'), text, F.lit('".'))))


def described(rows: DataFrame) -> DataFrame:
    """Adds ``short_caption`` and ``visual_summary``: the model's where they are grounded, else made of what is."""
    reply, told = "llm_enrichment.structured_response", "target_json.description"
    for name, n in (("__cap", "short_caption"), ("__sum", "visual_summary")):
        rows = rows.withColumn(name, V.first_filled(at(rows, f"{reply}.{n}"), at(rows, f"{told}.{n}")))
    rows = rows.withColumns({"__cap_low": V.ascii_low(F.col("__cap")), "__sum_low": V.ascii_low(F.col("__sum"))})
    caption, summary, cap_low, sum_low = (F.col(n) for n in ("__cap", "__sum", "__cap_low", "__sum_low"))
    elements, frames, kind = F.col("elements"), F.col("g.timeframes"), F.when(F.col("kind") == "", "visual").otherwise(F.col("kind"))
    own = acceptable(caption, cap_low, elements, frames) & (names_subject(caption) | ((caption != "") & (F.col("g.primary_symbol") == "")))
    plain = sum_low.rlike("chart|candlestick|price|axis|session")
    told_ = (summary != "") & acceptable(summary, sum_low, elements, frames) & (names_subject(summary) | plain)
    return rows.withColumns({"short_caption": F.when(own, T.collapse(caption)).otherwise(made_caption(kind)), "visual_summary": F.when(told_, T.collapse(summary)).otherwise(made_summary(kind))}).drop("__cap", "__sum", "__cap_low", "__sum_low")


# blocks of the response


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _any(parts: dict[str, Column]) -> Column:
    """A struct of these, null if all of them are."""
    have = F.lit(False)
    for c in parts.values():
        have = have | c.isNotNull()
    return F.when(have, F.struct(*(c.alias(n) for n, c in parts.items())))


def says_bos() -> Column:
    return F.contains(V.ascii_low(F.concat_ws(" ", "__ocr", "__clean", "__reply")), F.lit("bos")) | E.shows(F.col("elements"), "bos")


def chart_content() -> Column:
    e, summary = F.col("elements"), F.col("visual_summary")
    bad = ~acceptable(summary, V.ascii_low(summary), e, V.none())
    fields = {"chart_type": F.when(E.shows(e, "candlestick"), "candlestick").otherwise("unknown"), "visible_market_behavior": T.collapse(F.when(bad, made_summary(F.col("kind"))).otherwise(summary))}
    fields |= {flag: E.shows(e, *words) for flag, words, _ in E.CHART_FLAGS}
    fields |= {"position_tool_direction": _filled(E.position_direction(e)), "has_bos_label": F.when(says_bos(), True)}
    return F.when(F.col("kind") == "chart", F.struct(*(c.alias(n) for n, c in fields.items())))


def annotations_block() -> Column:
    e = F.col("elements")
    tool = E.position_direction(e)
    notes = {note[0]: F.when(E.shows(e, *words), note[1]) for _, words, note in E.CHART_FLAGS if note}
    notes[E.TEXT_NOTE[1][0]] = F.when(E.shows(e, *E.TEXT_NOTE[0]), E.TEXT_NOTE[1][1])
    notes["risk_reward_position_tool"] = F.when(tool.isin("long", "short"), F.concat(F.lit("visible "), tool, F.lit(f" {E.TOOL_NOTE}"))).when(tool != "", f"visible {E.TOOL_NOTE}")
    notes["bos_label"] = F.when(says_bos(), E.BOS_NOTE)
    return _any(notes)


def text_block() -> Column:
    brand = F.contains(V.ascii_low(F.concat_ws(" ", "__ocr", "__clean")), F.lit("tradingview"))
    parts = {"main_header": _filled(F.col("g.visible_text")), "indicator_text": _filled(V.prefixed_line(F.col("__clean"), "Indicator text:")), "watermark": F.when(brand, "TradingView")}
    some = F.coalesce(*parts.values()).isNotNull()
    return _any(parts | {"other_text_readability": F.when(some, "partially readable")})


def confidence_block(level: Column) -> Column:
    sure = lambda c: F.when(c, "high")
    return F.struct(
        F.coalesce(_filled(level), F.lit("medium")).alias("overall"), F.when(F.size("elements") > 0, "medium").otherwise("low").alias("annotation_meaning"), F.lit("low").alias("exact_prices"),
        sure(F.col("g.primary_symbol") != "").alias("symbol"), sure(F.size("g.timeframes") > 0).alias("timeframe"), sure(F.col("g.venue") != "").alias("venue"), sure(F.col("platform") != "").alias("platform"),
    )


def llm_level(rows: DataFrame) -> Column:
    level = F.lower(V.first_filled(at(rows, "llm_enrichment.structured_response.confidence")))
    return F.when(level.isin("low", "medium", "high"), level).otherwise("")


def with_response(annotations: DataFrame) -> DataFrame:
    """``annotations`` with ``response``, a struct whose absent fields are null."""
    rows = described(classified(grounded(annotations)))
    g = lambda n: F.col(f"g.{n}")
    some = lambda c: F.when(F.size(c) > 0, c)
    names = {"primary_symbol": _filled(g("primary_symbol")), "instrument_name": _filled(g("instrument_name")), "venue": _filled(g("venue")), "timeframes": some(g("timeframes"))}
    fields = {"asset_type": _filled(F.col("kind")), "platform": _filled(F.col("platform"))} | names | {
        "instrument": _any(names), "short_caption": _filled(F.col("short_caption")), "visual_summary": _filled(F.col("visual_summary")), "chart_content": chart_content(), "annotations": annotations_block(),
        "visible_text": _filled(g("visible_text")), "visible_text_details": text_block(), "key_visual_elements": some(F.col("elements")), "confidence": confidence_block(llm_level(annotations)), "limitations": some(F.col("limits")),
    }
    rows = rows.withColumn("response", F.struct(*(c.alias(n) for n, c in fields.items())))
    return rows.drop("g", "elements", "limits", "platform", "kind", "__clean", "__ocr", "__reply", "short_caption", "visual_summary")


def payload(response: Column) -> Column:
    """A pair's JSON text."""
    return F.to_json(F.struct(F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(TASK).alias("task_type"), response.alias("response")))


def reason(rows: DataFrame, least: str = "medium", require_llm: bool = True, allow_review: bool = False, image: Column | None = None) -> Column:
    """The first gate that an annotation with its ``response`` fails, or ``ok``."""
    r = F.col("response")
    level = llm_level(rows)
    signal = F.coalesce(*(r[n] for n in ("visible_text", "primary_symbol", "instrument_name", "venue")), F.array_join(r["timeframes"], ","))
    enriched = F.col("llm_enrichment").isNotNull() if "llm_enrichment" in rows.columns else F.lit(False)
    return gates.export_reason({
        "pair_type": at(rows, "pair_type"), "has_llm": enriched, "review_required": at(rows, "review_required", "boolean"), "quality": F.lower(V.first_filled(at(rows, "target_json.provenance.quality.annotation_quality"))),
        "confidence": level, "caption": r["short_caption"], "summary": r["visual_summary"], "has_signal": signal.isNotNull(), "has_image": F.lit(True) if image is None else image,
    }, least, require_llm, allow_review)


def export(annotations: DataFrame, **gate) -> DataFrame:
    """``id, reason, payload``: every annotation with the gate it fails, or ``ok`` and its pair."""
    rows = with_response(annotations)
    why = reason(rows, **gate)
    return rows.select("id", why.alias("reason"), F.when(why == "ok", payload(F.col("response"))).alias("payload"))


def renormalize(written: DataFrame, annotations: DataFrame) -> DataFrame:
    """Pairs already written (id, payload) made anew from their annotations: ``id, payload, changed, status``.

    status: ``normalized``, or ``missing_annotation`` for a pair without one, which stays as it is.
    """
    fresh = with_response(annotations).select("id", payload(F.col("response")).alias("__new"))
    both = written.join(fresh, "id", "left")
    out = F.coalesce("__new", "payload")
    return both.select("id", out.alias("payload"), (~out.eqNullSafe(F.col("payload"))).alias("changed"), F.when(F.col("__new").isNull(), "missing_annotation").otherwise("normalized").alias("status"))
