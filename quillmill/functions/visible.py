"""What a picture's own text shows: lines worth quoting, header labels, and whether it bears out a symbol, venue or timeframe.

Everything is a Column expression. What needs fuzzy matching (symbols and venues read in a text) comes in as an array column,
so that the Python pass over a text happens once, before these.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions import extract as X
from quillmill.functions import text as T
from quillmill.functions import vocab

def none() -> Column:
    return F.array().cast("array<string>")



def blank(c: Column) -> Column:
    return F.coalesce(c == "", F.lit(True))


def some(c: Column) -> Column:
    """Does an array or map hold anything?"""
    return F.coalesce(F.size(c), F.lit(0)) > 0


def ascii_low(c: Column) -> Column:
    return F.lower(T.fold(F.coalesce(c, F.lit(""))))


# lines


def unique_lines(*texts: Column) -> Column:
    """Lines of all texts in turn, tidied, first of equals apart from case."""
    lines = F.flatten(F.array(*(F.split(F.coalesce(t, F.lit("")), "\n") for t in texts)))
    return T.first_apart_from_case(F.filter(F.transform(lines, T.tidy), lambda x: x != ""))


def merged_text(embedded: Column, ocr: Column) -> Column:
    """Either text if it is the only one, else the unique lines of both."""
    a, b = F.coalesce(embedded, F.lit("")), F.coalesce(ocr, F.lit(""))
    return F.when(a == "", b).when(b == "", a).otherwise(F.array_join(unique_lines(a, b), "\n"))


def methods(**texts: Column) -> Column:
    """Names of the texts that hold anything."""
    return F.array_compact(F.array(*(F.when(~blank(c), n) for n, c in texts.items())))


def with_method(have: Column, method: Column | str) -> Column:
    m = method if isinstance(method, Column) else F.lit(method)
    kept = F.filter(F.coalesce(have, none()), lambda x: T.strip(x) != "")
    return F.when(F.array_contains(kept, m), kept).otherwise(F.array_append(kept, m))


def informative(line: Column) -> Column:
    """Does an OCR line say something: words, not mostly digits or marks, no publishing notice."""
    return T.let(T.fold(line), _informative)


def _informative(low: Column) -> Column:
    count = lambda pattern: F.regexp_count(low, F.lit(pattern))
    letters, digits, marks, words = count("[A-Za-z]"), count("[0-9]"), count(r"[^A-Za-z0-9\s\x1c-\x1f]"), count("[A-Za-z]{3,}")
    notice = F.lower(low).rlike(r"tradingview\.com|freigegeben")
    figures = (digits > F.greatest(letters * 2, F.lit(8))) & (words < 2)
    return ~notice & (letters + digits >= 8) & (words > 0) & ~figures & (marks <= F.greatest(letters + digits, F.lit(1)))


def label_lines(ocr: Column) -> Column:
    return F.slice(F.filter(T.meaningful(ocr), informative), 1, 3)


def clean_lines(ocr: Column) -> Column:
    """Lines of an OCR text (repaired already) with plain punctuation and single blanks; blank ones dropped."""
    return F.filter(F.transform(F.split(F.coalesce(ocr, F.lit("")), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), lambda x: T.collapse(T.punctuation(x))), lambda x: x != "")


def prefixed_line(text: Column, prefix: str) -> Column:
    """What follows the colon in the first line that starts with a prefix, apart from case; else empty."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: T.strip(x))
    hit = F.try_element_at(F.filter(lines, lambda x: F.startswith(F.lower(x), F.lit(prefix.lower()))), F.lit(1))
    return F.coalesce(T.strip(F.regexp_extract(hit, "(?s)^[^:]*:(.*)$", 1)), F.lit(""))


def first_filled(*values: Column) -> Column:
    """The first value that isn't blank, stripped; else empty."""
    return F.coalesce(*(F.nullif(T.strip(v), F.lit("")) for v in values), F.lit(""))


# header labels


def label_text(text: Column) -> Column:
    """A header label with one kind of dash and dot, and single blanks around separators."""
    c = F.translate(T.collapse(F.coalesce(text, F.lit(""))), "•∙–—−", "··---")
    for pattern, to in ((r"(?U)\s*\+\s*", " + "), (r"(?U)\s*·\s*", " · "), (r"(?U)\s*,\s*", ", "), (r"(?U)\s*\|\s*", " | "), (r"(?U)\s+-\s+", " - ")):
        c = F.regexp_replace(c, pattern, to)
    return T.collapse(c)


def label_parts(text: Column) -> Column:
    parts = F.split(label_text(text), r"(?U)\s*[·•∙,|]\s*|\s+[+\-]\s+")
    return F.filter(F.transform(parts, lambda p: T.collapse(F.regexp_replace(p, r"^[+\-·|, ]+|[+\-·|, ]+$", ""))), lambda p: p != "")


# what is borne out


def holds(text: Column, value: Column) -> Column:
    """Does a text hold a value, letters and digits alone being compared?"""
    return T.let(T.token(F.coalesce(value, F.lit(""))), lambda v: (v != "") & F.contains(T.token(F.coalesce(text, F.lit(""))), v))


def symbol_shown(symbol: Column, ocr: Column, found: Column) -> Column:
    """``found``: the symbols read in the OCR text."""
    return ~blank(symbol) & ~blank(ocr) & F.coalesce(holds(ocr, symbol) | F.array_contains(F.coalesce(found, none()), symbol) | holds(ocr, X.display_name(symbol)), F.lit(False))


def symbols_shown(symbols: Column, ocr: Column, found: Column) -> Column:
    """Those of the symbols that the OCR text bears out, in order."""
    plain = F.filter(F.coalesce(symbols, none()), lambda s: holds(ocr, s) | holds(ocr, X.display_name(s)))
    return F.when(blank(ocr), none()).otherwise(F.array_intersect(F.coalesce(symbols, none()), F.concat(plain, F.coalesce(found, none()))))


def frame_shown(frame: Column, text: Column, names: dict[str, tuple[str, ...]], venues: tuple[str, ...]) -> Column:
    """Does a text name a timeframe: by its code, by one of its names, or, for minutes, by the bare number before a venue?"""
    table = F.create_map(*(F.lit(x) for k, v in names.items() for x in (k, "|".join(v))))
    before = F.lit(rf"\b(?=\s*[,/|\-]?\s*(?:{'|'.join(sorted(v.lower() for v in venues))})\b)")

    def shown(low: Column) -> Column:
        code = F.lower(F.coalesce(frame, F.lit("")))
        named = F.regexp_like(low, F.concat(F.lit(r"\b(?:"), F.concat_ws("|", code, F.try_element_at(table, F.coalesce(frame, F.lit("")))), F.lit(r")\b")))
        return (code != "") & (named | (code.rlike(r"^m\d+$") & F.regexp_like(low, F.concat(F.lit(r"\b"), F.substring(code, 2, 9), before))))

    return ~blank(text) & F.coalesce(T.let(ascii_low(text), shown), F.lit(False))


def frames_shown(frames: Column, ocr: Column) -> Column:
    return F.filter(F.coalesce(frames, none()), lambda f: frame_shown(f, ocr, vocab.FRAME_NAMES, vocab.VENUES))


def levels_shown(levels: Column, ocr: Column) -> Column:
    empty = F.create_map().cast("map<string,string>")
    return F.when(blank(ocr), empty).otherwise(F.map_filter(F.coalesce(levels, empty), lambda _, v: holds(ocr, v)))


def of_those(values: Column, detected: Column) -> Column:
    return F.filter(F.coalesce(values, none()), lambda v: (v != "") & F.array_contains(F.coalesce(detected, none()), v))


def levels_text(levels: Column) -> Column:
    return F.array_join(F.transform(F.map_entries(levels), lambda e: F.concat(F.replace(e["key"], F.lit("_"), F.lit(" ")), F.lit(" "), e["value"])), ", ")


# texts about an asset


def spoken(code: Column) -> Column:
    return F.replace(code, F.lit("_"), F.lit(" "))


def sentence_case(code: Column) -> Column:
    words = F.lower(spoken(code))
    return F.concat(F.upper(F.substring(words, 1, 1)), F.substring(words, 2, 1000))


def clean_text(a: dict[str, Column], own: bool) -> Column:
    """Lines of facts about an asset; ``own``: those that its crop shows, without bias, direction, setup and context.

    ``a``: asset_type, symbol, instrument, venue, frames, levels, ocr and, but for ``own``, bias, direction, setup, context.
    """
    line = lambda name, c: F.when(~blank(c), F.concat(F.lit(f"{name}: "), c))
    head = [
        line("Asset type", a["asset_type"]), line("Instrument", a["symbol"]), F.when(~a["instrument"].eqNullSafe(a["symbol"]), line("Instrument label", a["instrument"])),
        line("Venue", a["venue"]), F.when(some(a["frames"]), line("Timeframes", F.array_join(a["frames"], ", "))),
    ]
    levels = F.when(some(a["levels"]), F.concat(F.lit("Visible levels: " if own else "Levels: "), levels_text(a["levels"])))
    lines = label_lines(a["ocr"])
    if own:
        rest = [levels]
    else:
        focus = T.focus_line(a["context"])
        lines = F.filter(lines, lambda x: blank(focus) | (F.lower(x) != F.lower(focus)))
        rest = [line("Bias", a["bias"]), line("Direction", a["direction"]), line("Setup status", spoken(a["setup"])), levels, line("Context note", focus)]
    shown = F.when(some(lines), F.concat(F.lit("Visible labels: "), F.array_join(lines, "; ")))
    return F.concat_ws("\n", *head, *rest, shown)


def element_tags(a: dict[str, Column]) -> Column:
    """``a``: asset_type, labels (struct), venue, ocr, levels."""
    first = F.create_map(*(F.lit(x) for kv in vocab.PANELS.items() for x in kv))
    lab = a["labels"]
    rows = [
        (lab["contains_symbol"], "symbol_label"), (lab["contains_timeframe"], "timeframe_label"), (~blank(a["venue"]), "venue_label"), (~blank(a["ocr"]), "ocr_text_overlay"), (some(a["levels"]), "price_level_text"),
        (lab["likely_chart"], "price_axis_or_scale"), (lab["contains_performance_metrics"], "performance_metric_text"), (lab["contains_strategy_rules"], "strategy_rule_text"),
    ]
    return F.array_compact(F.array(F.coalesce(F.try_element_at(first, a["asset_type"]), F.lit("unknown_visual")), *(F.when(c, t) for c, t in rows)))


def visual_summary(a: dict[str, Column]) -> Column:
    """Up to four sentences on what a crop shows. ``a``: asset_type, symbol, instrument, venue, frames, ocr, levels, elements."""
    frames, symbol = F.array_join(F.slice(a["frames"], 1, 2), ", "), a["symbol"]
    chart = (
        F.when(~blank(symbol) & some(a["frames"]), F.concat(F.lit("Chart crop showing "), symbol, F.lit(" on "), frames, F.lit(".")))
        .when(~blank(symbol), F.concat(F.lit("Chart crop showing "), symbol, F.lit(".")))
        .when(some(a["frames"]), F.concat(F.lit("Chart crop with visible timeframe "), frames, F.lit(".")))
        .otherwise("Trading chart crop.")
    )
    opening = F.when(a["asset_type"] == "chart", chart).when(a["asset_type"] != "unknown", F.concat(sentence_case(a["asset_type"]), F.lit(" crop."))).otherwise("Trading-related crop.")
    lines, excerpt = label_lines(a["ocr"]), T.first_sentence(a["ocr"], 140)
    shown = F.when(some(lines), F.concat(F.lit("Visible text includes "), F.array_join(F.slice(lines, 1, 2), "; "), F.lit("."))).when(~blank(a["ocr"]) & (excerpt != ""), F.concat(F.lit("OCR excerpt: "), excerpt))
    sentences = [
        opening,
        F.when(~blank(a["instrument"]) & ~a["instrument"].eqNullSafe(symbol), F.concat(F.lit("Visible instrument label maps to "), a["instrument"], F.lit("."))),
        F.when(~blank(a["venue"]), F.concat(F.lit("Visible venue label: "), a["venue"], F.lit("."))),
        F.when(some(a["levels"]), F.concat(F.lit("Visible price text includes "), levels_text(a["levels"]), F.lit("."))),
        shown,
        F.when(some(a["elements"]), F.concat(F.lit("Key visual elements: "), F.array_join(F.transform(F.slice(a["elements"], 1, 6), spoken), ", "), F.lit("."))),
    ]
    return F.array_join(F.slice(F.array_compact(F.array(*sentences)), 1, 4), " ")


def caption(a: dict[str, Column]) -> Column:
    """One line on an asset, facts first. ``a``: asset_type, page_type, symbol, venue, frames, concepts, bias, setup, text."""
    frames, kind = F.array_join(F.slice(a["frames"], 1, 2), "/"), spoken(a["asset_type"])
    head = (
        F.when(~blank(a["symbol"]), F.concat_ws(" ", a["symbol"], F.nullif(frames, F.lit("")), kind)).when(some(a["frames"]), F.concat_ws(" ", frames, kind))
        .when(a["asset_type"] != "unknown", kind).when(a["page_type"] != "unknown", spoken(a["page_type"]))
    )
    parts = [
        head, F.when(~blank(a["bias"]), F.concat(a["bias"], F.lit(" bias"))), F.when(a["setup"] == "no_setup", "no setup"), F.when(~blank(a["venue"]), a["venue"]),
        F.when(some(a["concepts"]), F.concat(F.lit("concepts: "), F.array_join(F.slice(a["concepts"], 1, 3), ", "))), F.nullif(F.coalesce(F.nullif(T.focus_line(a["text"]), F.lit("")), T.first_sentence(a["text"], 180)), F.lit("")),
    ]
    return T.let(F.concat_ws(" | ", *parts), T.shortened)


def description(a: dict[str, Column]) -> Column:
    """Up to five sentences on an asset and its surroundings. ``a``: as :func:`caption`, with instrument, direction, levels, context, ocr."""
    symbol = a["symbol"]
    chart = (
        F.when(~blank(symbol) & some(a["frames"]), F.concat(F.lit("Trading chart for "), symbol, F.lit(" on "), F.array_join(F.slice(a["frames"], 1, 2), ", "), F.lit(".")))
        .when(~blank(symbol), F.concat(F.lit("Trading chart for "), symbol, F.lit("."))).otherwise("Trading chart.")
    )
    opening = (
        F.when(a["asset_type"] == "chart", chart).when(a["asset_type"] != "unknown", F.concat(sentence_case(a["asset_type"]), F.lit(".")))
        .when(a["page_type"] != "unknown", F.concat(sentence_case(a["page_type"]), F.lit(" visual."))).otherwise("Trading-related visual.")
    )
    told = lambda name, c: F.when(~blank(c), F.concat(F.lit(f"{name}: "), c, F.lit(".")))
    source = F.when(~blank(a["context"]), a["context"]).otherwise(F.coalesce(a["ocr"], F.lit("")))
    sentences = [
        opening, F.when(~blank(symbol) & (a["instrument"] != symbol), told("Instrument label", a["instrument"])), told("Venue", a["venue"]), told("Market bias", a["bias"]), told("Explicit direction", a["direction"]),
        F.when(a["setup"] == "no_setup", "Context states that no setup was present.").when(a["setup"] == "setup_mentioned", "A setup is mentioned in the surrounding context."),
        F.when(some(a["concepts"]), F.concat(F.lit("Key concepts: "), F.array_join(F.transform(F.slice(a["concepts"], 1, 4), spoken), ", "), F.lit("."))),
        F.when(some(a["levels"]), F.concat(F.lit("Mentioned levels: "), levels_text(a["levels"]), F.lit("."))),
        F.nullif(F.coalesce(F.nullif(T.focus_line(source), F.lit("")), T.first_sentence(source, 200)), F.lit("")),
    ]
    return F.array_join(F.slice(F.array_compact(F.array(*sentences)), 1, 5), " ")
