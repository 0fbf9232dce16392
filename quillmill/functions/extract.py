"""Dictionary, pattern and fuzzy extraction. Patterns are built from the vocabularies as one alternation each."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from quillmill.functions import vocab
from quillmill.functions.text import _fold, fold, let


def whole_words(words: tuple[str, ...], edge: str = "a-z0-9") -> str:
    return f"(?<![{edge}])(?:{'|'.join(re.escape(w) for w in words)})(?![{edge}])"


def keyword_labels(text: Column, table: dict[str, tuple[str, ...]] = vocab.CONCEPTS) -> Column:
    """Labels, sorted, of which any word stands alone in the folded lower-case text."""
    found = lambda low: F.sort_array(F.array_compact(F.array(*(F.when(low.rlike(whole_words(w)), k) for k, w in table.items()))))
    return let(F.lower(fold(F.coalesce(text, F.lit("")))), found)


def timeframes(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.sort_array(F.array_compact(F.array(*(F.when(low.rlike(rf"(?U)\b(?:{'|'.join(w)})\b"), k) for k, w in vocab.TIMEFRAMES.items()))))


def _one_of(text: Column, yes: tuple[str, str], no: tuple[str, str]) -> Column:
    has = lambda low, words: low.rlike(rf"\b({words})\b")
    return let(F.lower(fold(F.coalesce(text, F.lit("")))), lambda low: F.when(has(low, yes[1]) & ~has(low, no[1]), yes[0]).when(has(low, no[1]) & ~has(low, yes[1]), no[0]))


def bias(text: Column) -> Column:
    return _one_of(text, ("bullish", "bullish|bullisch"), ("bearish", "bearish|bearisch"))


def direction(text: Column) -> Column:
    return _one_of(text, ("long", "long|buy|kauf"), ("short", "short|sell|verkauf"))


def setup_status(text: Column) -> Column:
    low = F.lower(fold(F.coalesce(text, F.lit(""))))
    return let(low, lambda x: F.when(x.rlike("|".join(vocab.NO_SETUP)), "no_setup").when(x.rlike(r"\bsetup\b"), "setup_mentioned"))


def trade_level(text: Column, field: str) -> Column:
    """The number after the first of the field's words that has one; null without."""
    got = [F.nullif(F.regexp_extract(text, f"(?i){p}{vocab.NUMBER}", 1), F.lit("")) for p in vocab.LEVELS[field]]
    return F.coalesce(*got)


def trade_levels(text: Column) -> Column:
    table = F.create_map(*(x for f in vocab.LEVELS for x in (F.lit(f), trade_level(text, f))))
    return F.map_filter(table, lambda k, v: v.isNotNull())


def _hits(low: Column, words: tuple[str, ...]) -> Column:
    return sum((F.when(low.contains(w), 1).otherwise(0) for w in words), F.lit(0))


def hundredths(num: Column, den: Column) -> Column:
    """num / den rounded to two places as correctly rounded decimals of the double are."""
    return F.format_number(num / den, 2).cast("double")


def page_type(text: Column, symbols: Column, frames: Column, n_words: Column) -> Column:
    """struct(page_type, confidence): the highest score, the first of equals; unknown and 0 where all are 0."""
    low = F.lower(F.coalesce(text, F.lit("")))
    market = F.when((F.size(symbols) > 0) | (F.size(frames) > 0), 1).otherwise(0)
    bonus = {"chart": market + F.when(low.contains("page") & (n_words < 20), 1).otherwise(0), "market_analysis": market}
    scores = {k: _hits(low, w) * 2 + bonus.get(k, F.lit(0)) for k, w in vocab.PAGE_TYPES.items()}
    best, total = F.greatest(*scores.values()), sum(scores.values(), F.lit(0))
    name = F.coalesce(*(F.when(s == best, k) for k, s in scores.items()))
    return F.struct(F.when(best == 0, "unknown").otherwise(name).alias("page_type"), F.when(best == 0, 0.0).otherwise(hundredths(best, F.greatest(total, F.lit(1)))).alias("confidence"))


def asset_type(context: Column, ocr: Column, symbols: Column, frames: Column, concepts: Column, domains: Column) -> Column:
    low = F.lower(F.concat_ws("\n", F.coalesce(context, F.lit("")), F.coalesce(ocr, F.lit(""))))
    some = lambda words: _hits(low, words) > 0
    chart = (F.size(symbols) > 0) | (F.size(frames) > 0) | (F.size(concepts) > 0) | F.array_contains(domains, "technical_analysis") | some(vocab.CHART_WORDS)
    panel = F.array_contains(domains, "performance_review") | some(vocab.PANEL_WORDS)
    any_text = (F.coalesce(context, F.lit("")) != "") | (F.coalesce(ocr, F.lit("")) != "")
    return F.when(chart, "chart").when(panel, "performance_panel").when(some(vocab.STRATEGY_WORDS), "strategy_figure").when(any_text, "figure").otherwise("unknown")


def display_name(symbol: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in vocab.DISPLAY_NAMES.items() for x in kv)), symbol), symbol)


class Lexicon:
    """word -> value of the key that ranks first: the word itself, or, for 4 letters and more, the likeliest (the first of equals) if it
    is like enough. One that holds the other counts 0.92. Words met are remembered, up to a bound."""

    def __init__(self, table: dict[str, str], least: float = 0.72, most: int = 50_000) -> None:
        self.table, self.least, self.most, self.met = table, least, most, {}

    def __call__(self, word: str) -> str | None:
        if word in self.table or len(word) < 4 or not self.table:
            return self.table.get(word)
        if word not in self.met:
            if len(self.met) >= self.most:
                self.met.clear()
            self.met[word] = self._likeliest(word)
        return self.met[word]

    def _likeliest(self, word: str) -> str | None:
        best, found, match = 0.0, None, SequenceMatcher(None, "", "")
        match.set_seq1(word)
        for key, value in self.table.items():
            if word in key or key in word:
                like = 0.92
            else:
                match.set_seq2(key)
                bounds = (match.real_quick_ratio, match.quick_ratio)  # upper bounds, cheap ones first
                like = 0.0 if any(f() < self.least or f() <= best for f in bounds) else match.ratio()
            if like > best:
                best, found = like, value
        return found if best >= self.least else None


def fuzzy(word: str, table: dict[str, str], least: float = 0.72) -> str | None:
    return Lexicon(table, least)(word)


# bases and quotes of a pair that a slash parts, and of one that stands in running text
_SLASHED = Lexicon(vocab.BASE_ALIASES, 0.66), Lexicon(vocab.QUOTE_ALIASES, 0.66)
_RUNNING = Lexicon(vocab.BASE_ALIASES, 0.68), Lexicon(vocab.QUOTE_ALIASES, 0.68)
_VENUE = Lexicon({v.lower(): v for v in vocab.VENUES}, 0.8)


def _tokens(text: str) -> list[str]:
    return [t.lower() for t in re.findall(r"[A-Za-z][A-Za-z0-9]+", _fold(text))]


def _first(find: Lexicon, words: list[str]) -> str | None:
    return next(filter(None, map(find, words)), None)


def _pairs(text: str) -> set[str]:
    """Base and quote on both sides of a line's first slash; where no line has such a pair, a base with a quote among the four words after it."""
    sides = [(_tokens(a), _tokens(b)[:5]) for a, slash, b in (line.partition("/") for line in set(text.splitlines())) if slash]
    named = {(_first(_SLASHED[0], a), _first(_SLASHED[1], b)) for a, b in sides}
    found = {b + q for b, q in named if b and q}
    if not found:
        words = _tokens(text)
        near = ((_RUNNING[0](w), words[i + 1 : i + 5]) for i, w in enumerate(words))
        found = {b + q for b, after in near if b and (q := _first(_RUNNING[1], after))}
    return found


@F.pandas_udf(ArrayType(StringType()))
def pair_symbols(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: sorted(_pairs(t or "")))


@F.pandas_udf(ArrayType(StringType()))
def fuzzy_venues(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: sorted({v for w in _tokens(t or "") if (v := _VENUE(w))} | {v for v in vocab.VENUES if v in _fold(t or "").upper()}))


def symbols(text: Column) -> Column:
    """All instruments named: forex codes in pairs, $TICKERs, ...USD(T), known symbols, and fuzzy base / quote pairs."""
    up = F.upper(F.coalesce(text, F.lit("")))
    codes = "|".join(vocab.FOREX_CODES)
    pairs = F.regexp_extract_all(up, F.lit(rf"(?U)\b((?:{codes})(?:{codes}))\b"), F.lit(1))
    tick = F.regexp_extract_all(up, F.lit(r"(?U)\$([A-Z]{1,5})\b"), F.lit(1))
    usd = F.regexp_extract_all(up, F.lit(r"(?U)\b([A-Z]{2,6}USDT?)\b"), F.lit(1))
    known = F.array_compact(F.array(*(F.when(up.contains(s), s) for s in vocab.KNOWN_SYMBOLS)))
    return F.sort_array(F.array_distinct(F.concat(pairs, tick, usd, known, pair_symbols(text))))
