"""Annotations of visual assets and pages: market fields, labels, review, and the training target, from context and OCR text.

Stages of columns over one table, each asset a row. The one Python pass (fuzzy symbols and venues) is made by
:func:`read_names`, once a text; all else are expressions. Pages gather their assets by one aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import export as E
from quillmill.functions import extract as X
from quillmill.functions import geometry as G
from quillmill.functions import text as T
from quillmill.functions import visible as V
from quillmill.functions import vocab
from quillmill.operators import gates



def context_of(blocks: DataFrame, by: list[str]) -> DataFrame:
    """Per asset ``context_text`` (the unique lines of its blocks, ten at most), ``context_heading`` and ``paired_text_blocks``.

    ``blocks``: the columns ``by``, position, text, font, block (box). The heading is the first meaningful line of 4 to 110 characters among
    the first two of each block, the largest type first; else the first line of all.
    """
    blocks = blocks.withColumn("text", T.repair(F.col("text")))
    got = blocks.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("position", "text"))).alias("b"), F.sort_array(F.collect_list(F.struct((-F.col("font")).alias("f"), "block.y0", "block.x0", "position", "text"))).alias("s"))
    lines = F.flatten(F.transform("b", lambda x: T.polish(x["text"])))
    heads = F.flatten(F.transform("s", lambda x: F.slice(T.meaningful(x["text"]), 1, 2)))
    head = F.try_element_at(F.filter(heads, lambda x: F.length(x).between(4, 110)), F.lit(1))
    whole = F.array_join(F.transform("b", lambda x: x["text"]), "\n")
    return got.select(*by, F.array_join(F.slice(T.first_apart_from_case(lines), 1, 10), "\n").alias("context_text"), F.coalesce(head, F.try_element_at(T.polish(whole), F.lit(1)), F.lit("")).alias("context_heading"), F.size("b").alias("paired_text_blocks"))


def read_names(rows: DataFrame, **texts: str) -> DataFrame:
    """``rows`` with ``<name>_symbols`` and ``<name>_venues`` of each text column: the only step of this module that leaves the JVM."""
    return rows.withColumns({f"{n}_{k}": f(F.col(c)) for n, c in texts.items() for k, f in (("symbols", X.symbols), ("venues", X.fuzzy_venues))})


def _or(first: Column, second: Column) -> Column:
    return F.when(V.some(first), first).otherwise(second)


def market_fields(rows: DataFrame) -> DataFrame:
    """Adds symbols, primary_symbol, instrument_name, venue and timeframes: what the OCR text shows, else what all of the text says.

    rows: context_text, ocr_text, combined_text and, to fall back on where both are empty, page_text.
    """
    rows = rows.withColumn("analysis_text", F.coalesce(F.nullif(F.col("combined_text"), F.lit("")), F.col("page_text"), F.lit("")))
    rows = read_names(rows, ocr="ocr_text", analysis="analysis_text")
    rows = rows.withColumn("symbols", _or(F.col("ocr_symbols"), F.col("analysis_symbols")))
    venues = _or(F.col("ocr_venues"), F.col("analysis_venues"))
    primary = F.try_element_at("symbols", F.lit(1))
    return rows.withColumns({
        "primary_symbol": primary, "instrument_name": X.display_name(primary), "venue": F.try_element_at(venues, F.lit(1)),
        "timeframes": _or(X.timeframes(F.col("ocr_text")), X.timeframes(F.col("analysis_text"))),
    })


def _has(low: Column, words: tuple[str, ...]) -> Column:
    return low.rlike("|".join(words))


def labels(text: Column, symbols: Column, frames: Column, likely_chart: Column, **more: Column) -> Column:
    """What a text holds, as a struct. ``more``: further fields, put first."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.struct(
        *(c.alias(n) for n, c in more.items()), T.density(text).alias("text_density"), likely_chart.alias("likely_chart"), _has(low, vocab.LEVEL_WORDS).alias("contains_trade_levels"),
        _has(low, vocab.METRIC_WORDS).alias("contains_performance_metrics"), _has(low, vocab.RULE_WORDS).alias("contains_strategy_rules"), V.some(symbols).alias("contains_symbol"), V.some(frames).alias("contains_timeframe"),
    )


def _map(levels: Column) -> Column:
    return F.coalesce(levels, F.create_map().cast("map<string,string>"))


def annotate_assets(assets: DataFrame) -> DataFrame:
    """The annotation of each asset, target included.

    assets: id, source_pdf, page_number, asset_index, asset_source, asset (box), page (box), context_heading, context_text, ocr_raw,
    paired_text_blocks, page_text (the page's own text, for assets without any). Columns beyond these stay.
    """
    a = assets.withColumn("ocr_text", F.array_join(T.polish(T.repair(F.col("ocr_raw")), 10), "\n")).withColumn("context_text", F.coalesce("context_text", F.lit("")))
    a = a.withColumn("combined_text", V.merged_text(F.col("context_text"), F.col("ocr_text")))
    a = market_fields(a.withColumn("extraction_methods", V.methods(nearby_text=F.col("context_text"), ocr=F.col("ocr_text"))))
    text = F.col("analysis_text")
    a = a.withColumns({
        "trading_concepts": X.keyword_labels(text, vocab.CONCEPTS), "trading_domains": X.keyword_labels(text, vocab.DOMAINS), "bias": X.bias(text), "direction": X.direction(text), "setup_status": X.setup_status(text),
        "trade_levels": X.trade_levels(text), "__page": X.page_type(text, F.col("symbols"), F.col("timeframes"), F.size(T.words(text))),
    })
    a = a.withColumns({
        "page_type": F.col("__page.page_type"), "page_type_confidence": F.col("__page.confidence"),
        "asset_type": X.asset_type(F.col("context_text"), F.col("ocr_text"), F.col("symbols"), F.col("timeframes"), F.col("trading_concepts"), F.col("trading_domains")),
    }).drop("__page")
    f = {
        "asset_type": F.col("asset_type"), "page_type": F.col("page_type"), "symbol": F.col("primary_symbol"), "instrument": F.col("instrument_name"), "venue": F.col("venue"), "frames": F.col("timeframes"),
        "concepts": F.col("trading_concepts"), "bias": F.col("bias"), "direction": F.col("direction"), "setup": F.col("setup_status"), "levels": F.col("trade_levels"), "text": text, "context": F.col("context_text"), "ocr": F.col("ocr_text"),
    }
    page = F.greatest(G.area(F.col("page")), F.lit(1.0))
    own = labels(text, F.col("symbols"), F.col("timeframes"), (F.col("asset_type") == "chart") | (F.col("page_type") == "chart"), has_context_text=F.col("context_text") != "", has_ocr_text=F.col("ocr_text") != "")
    a = a.withColumns({
        "caption": V.caption(f), "summary": V.caption(f), "description": V.description(f), "clean_text": V.clean_text(f, own=False), "asset_bbox": G.rounded(F.col("asset")), "asset_bbox_ratio": G.share_of_page(F.col("asset"), F.col("page")),
        "labels": F.struct(*(own[n].alias(n) for n in LABELS), (G.area(F.col("asset")) / page >= 0.2).alias("is_large_visual"), F.col("paired_text_blocks")),
    })
    review = gates.asset_needs_review(F.col("combined_text"), F.col("labels.text_density"), F.col("asset_type"), F.col("page_type_confidence"), F.col("asset_source"), F.col("ocr_text"), F.col("primary_symbol"), F.col("timeframes"))
    return with_target(a.withColumn("review_required", review)).drop("analysis_text", "ocr_symbols", "ocr_venues", "analysis_symbols", "analysis_venues")


LABELS = ("has_context_text", "has_ocr_text", "text_density", "likely_chart", "contains_trade_levels", "contains_performance_metrics", "contains_strategy_rules", "contains_symbol", "contains_timeframe")


def field_sources(found: Column, venues: Column) -> Column:
    """Where each field of an annotation comes from. ``found``, ``venues``: what is read in the OCR text."""
    c = F.col
    context, ocr = c("context_text"), c("ocr_text")
    one = lambda name, fallback="heuristic": E.source_of(F.when(~V.blank(c(name)), F.array(name)).otherwise(V.none()), context, ocr, "", fallback)
    many = lambda name: E.source_of(c(name), context, ocr, "", "heuristic_normalization")
    symbol = E.promoted(one("primary_symbol"), V.symbol_shown(c("primary_symbol"), ocr, found), ocr)
    told = lambda name: F.when(V.some(c(name)) if name.startswith("trading") else ~V.blank(c(name)), "keyword_heuristic").otherwise("missing")
    name = F.when(V.blank(c("instrument_name")), "missing").when(symbol.contains("ocr"), "symbol_lookup_from_ocr_symbol").when(~V.blank(c("primary_symbol")), "symbol_lookup_from_context_symbol").otherwise("missing")
    fields = {
        "asset_type": F.lit("heuristic_classifier"), "page_type": F.lit("heuristic_classifier"), "primary_symbol": symbol, "instrument_name": name,
        "venue": E.promoted(one("venue", "heuristic_normalization"), F.coalesce(F.array_contains(venues, c("venue")), F.lit(False)), ocr),
        "symbols": E.promoted(many("symbols"), V.some(V.symbols_shown(c("symbols"), ocr, found)), ocr), "timeframes": E.promoted(many("timeframes"), V.some(V.frames_shown(c("timeframes"), ocr)), ocr),
        "bias": one("bias", "keyword_heuristic"), "direction": one("direction", "keyword_heuristic"), "setup_status": told("setup_status"),
        "trade_levels": E.source_of(F.map_values(_map(c("trade_levels"))), context, ocr, "regex_from_", "regex_extraction"), "trading_concepts": told("trading_concepts"), "trading_domains": told("trading_domains"),
    }
    return F.struct(*(v.alias(k) for k, v in fields.items()))


def shown_fields(sources: Column, found: Column, venues: Column) -> dict[str, Column]:
    """The fields that the crop itself bears out, as far as their sources rest on it."""
    c, ocr = F.col, F.col("ocr_text")
    by_ocr = lambda name: sources[name].contains("ocr")
    name = F.when(~V.blank(c("instrument_name")) & by_ocr("instrument_name"), c("instrument_name"))
    symbol = F.when(~V.blank(c("primary_symbol")) & by_ocr("primary_symbol") & (V.symbol_shown(c("primary_symbol"), ocr, found) | name.isNotNull()), c("primary_symbol"))
    shown = F.concat(V.symbols_shown(c("symbols"), ocr, found), F.array_compact(F.array(symbol)))
    empty = F.create_map().cast("map<string,string>")
    return {
        "primary_symbol": symbol, "instrument_name": name, "venue": F.when(by_ocr("venue") & F.array_contains(venues, c("venue")), c("venue")),
        "symbols": F.when(by_ocr("symbols"), F.array_intersect(F.coalesce("symbols", V.none()), shown)).otherwise(V.none()), "timeframes": F.when(by_ocr("timeframes"), V.frames_shown(c("timeframes"), ocr)).otherwise(V.none()),
        "trade_levels": F.when(by_ocr("trade_levels"), V.levels_shown(c("trade_levels"), ocr)).otherwise(empty),
    }


def with_target(a: DataFrame) -> DataFrame:
    """Adds ``target_json``: description, what is observed in crop and context, what is derived, and provenance.

    Needs ``ocr_symbols`` and ``ocr_venues`` (:func:`read_names`) besides the annotation's fields.
    """
    c, found, venues = F.col, F.col("ocr_symbols"), F.col("ocr_venues")
    a = a.withColumn("__src", field_sources(found, venues))
    a = a.withColumn("__v", F.struct(*(x.alias(n) for n, x in shown_fields(c("__src"), found, venues).items())))
    reasons = gates.review_reasons(c("review_required"), c("labels.text_density"), c("asset_type"), c("page_type_confidence"), c("asset_source"), c("ocr_text"), c("primary_symbol"), c("timeframes"))
    own = {"asset_type": c("asset_type"), "symbol": c("__v.primary_symbol"), "instrument": c("__v.instrument_name"), "venue": c("__v.venue"), "frames": c("__v.timeframes"), "levels": c("__v.trade_levels"), "ocr": c("ocr_text")}
    tags = V.element_tags({"asset_type": c("asset_type"), "labels": c("labels"), "venue": c("venue"), "ocr": c("ocr_text"), "levels": c("trade_levels")})
    a = a.withColumn("__reasons", reasons).withColumn("__tags", tags)
    same = lambda *names: [c(n).alias(n.split(".")[-1]) for n in names]
    fields = ("primary_symbol", "instrument_name", "venue", "symbols", "timeframes")
    target = F.struct(
        F.lit("3.0").alias("schema_version"), F.lit("image_to_structured_annotation").alias("task_type"),
        F.struct(c("caption").alias("short_caption"), V.visual_summary(own | {"elements": c("__tags")}).alias("visual_summary"), c("description").alias("context_augmented_summary"), c("__tags").alias("key_visual_elements"), c("__reasons").alias("limitations")).alias("description"),
        F.struct(
            F.struct(c("ocr_text"), V.clean_text(own, own=True).alias("clean_text"), F.struct(*same(*(f"__v.{n}" for n in fields))).alias("normalized_fields"), c("__v.trade_levels").alias("trade_levels"), c("__tags").alias("visual_elements")).alias("visible_in_crop"),
            F.struct("context_heading", "context_text").alias("paired_context"),
        ).alias("observed"),
        F.struct(*same("asset_type", "page_type", *fields, "bias", "direction", "setup_status", "trade_levels", "trading_concepts", "trading_domains", "labels")).alias("derived"),
        F.struct(
            F.struct(*same("source_pdf", "page_number", "asset_index", "asset_source")).alias("source_document"), F.when(c("context_text") != "", "crop_plus_nearby_page_text").otherwise("crop_only").alias("context_scope"),
            c("extraction_methods"), c("__src").alias("field_sources"),
            F.struct(gates.annotation_quality(c("primary_symbol"), c("timeframes"), c("venue"), c("ocr_text"), c("context_text"), c("__reasons")).alias("annotation_quality"), c("page_type_confidence")).alias("quality"),
            F.struct(c("review_required").alias("required"), c("__reasons").alias("reasons")).alias("review"),
        ).alias("provenance"),
    )
    return a.withColumn("target_json", target).drop("__src", "__v", "__reasons", "__tags")


def annotate_pages(pages: DataFrame, assets: DataFrame) -> DataFrame:
    """The annotation of each page: its own text and OCR text, with the symbols and timeframes of its assets added, in order.

    pages: id, source_pdf, page_number, embedded_text, ocr_text; assets: source_pdf, page_number, asset_index, symbols, timeframes.
    """
    by = ["source_pdf", "page_number"]
    got = assets.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("asset_index", "symbols", "timeframes"))).alias("of"), F.count(F.lit(1)).alias("asset_count"))
    p = pages.join(got, by, "left").withColumn("combined_text", V.merged_text(F.col("embedded_text"), F.col("ocr_text"))).withColumn("asset_count", F.coalesce("asset_count", F.lit(0)))
    p = p.withColumn("extraction_methods", V.methods(embedded_text=F.col("embedded_text"), ocr=F.col("ocr_text")))
    text = F.col("combined_text")
    p = read_names(p, page="combined_text").withColumns({
        "symbols": merged(F.col("page_symbols"), F.col("of"), "symbols"), "timeframes": merged(X.timeframes(text), F.col("of"), "timeframes"), "trading_concepts": X.keyword_labels(text, vocab.CONCEPTS), "trading_domains": X.keyword_labels(text, vocab.DOMAINS),
    })
    p = p.withColumn("__page", X.page_type(text, F.col("symbols"), F.col("timeframes"), F.size(T.words(text))))
    p = p.withColumns({"page_type": F.col("__page.page_type"), "page_type_confidence": F.col("__page.confidence")}).drop("__page", "of", "page_symbols", "page_venues")
    p = p.withColumns({
        "summary": E.summary(F.col("page_type"), F.col("symbols"), F.col("timeframes"), F.col("trading_concepts"), text),
        "labels": labels(text, F.col("symbols"), F.col("timeframes"), F.col("page_type") == "chart", has_embedded_text=~V.blank(F.col("embedded_text")), has_ocr_text=~V.blank(F.col("ocr_text"))),
    })
    review = gates.page_needs_review(text, F.col("labels.text_density"), F.col("page_type"), F.col("page_type_confidence"), F.col("ocr_text"), F.col("symbols"), F.col("timeframes"), F.col("asset_count"))
    target = F.struct("page_type", "summary", text.alias("clean_text"), "symbols", "timeframes", "trading_concepts", "trading_domains", "labels")
    return p.withColumn("review_required", review).withColumn("target_json", target)


def merged(own: Column, assets: Column, field: str) -> Column:
    """A page's values, then those of its assets in order, each once."""
    return F.array_distinct(F.filter(F.concat(F.coalesce(own, V.none()), F.flatten(F.transform(F.coalesce(assets, F.array()), lambda a: F.coalesce(a[field], V.none())))), lambda x: x != ""))
