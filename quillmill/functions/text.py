"""Text and identifier expressions. All are Column functions inside the JVM but for mojibake repair, an Arrow batch that is
handed those rows only that show a marker."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillmill.functions import vocab

WS = r"(?U)\s+"


def stable_id(*parts: Column | str) -> Column:
    """First 16 hex digits of SHA-1 over the parts joined by ``::``; null parts are empty."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.substring(F.sha1(F.concat_ws("::", *(F.coalesce(c.cast("string"), F.lit("")) for c in cols))), 1, 16)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with the value worked out once, for expressions that use a long one often."""
    return F.transform(F.array(value), lambda x: f(x))[0]


def normalize_whitespace(c: Column) -> Column:
    """Wrongly decoded text repaired, NUL to space, CRLF and CR to LF, runs of blanks to one, three or more line breaks to two, ends stripped."""
    return tidy(repair(c))


def tidy(c: Column) -> Column:
    """:func:`normalize_whitespace` without the repair."""
    c = F.regexp_replace(F.regexp_replace(c, "\\x00", " "), "\r\n?", "\n")
    return strip(F.regexp_replace(F.regexp_replace(c, "[ \t]+", " "), "\n{3,}", "\n\n"))


def collapse(c: Column) -> Column:
    """All white space to single spaces, ends stripped."""
    return strip(F.regexp_replace(c, WS, " "))


def words(c: Column) -> Column:
    """Words between white space; none for blank or null text."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), WS), lambda w: w != "")


def density(c: Column) -> Column:
    return let(F.size(words(c)), lambda n: F.when(n < 25, "low").when(n < 120, "medium").otherwise("high"))


def first_sentence(c: Column, limit: int = 360) -> Column:
    flat = collapse(F.coalesce(c, F.lit("")))
    return let(F.split(flat, r"(?<=[.!?])\s+", 2)[0], lambda one: shortened(one, limit))


def shortened(one: Column, limit: int = 360) -> Column:
    return F.when(F.length(one) <= limit, one).otherwise(F.concat(F.rtrim(F.substring(one, 1, limit - 3)), F.lit("...")))


def slug(c: Column) -> Column:
    c = F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("/")), "^/+|/+$", "")
    c = F.regexp_replace(F.regexp_replace(c, "[^a-zA-Z0-9/_-]+", "-"), "-{2,}", "-")
    return F.regexp_replace(c, "^-+|-+$", "")


def path_tags(c: Column, keep: int = 6) -> Column:
    """Cleaned lower-case parts of a path, the last ``keep``."""
    parts = F.transform(F.split(c, "/"), lambda p: F.regexp_replace(F.regexp_replace(F.lower(F.trim(p)), "[^a-z0-9_-]+", "-"), "^-+|-+$", ""))
    parts = F.filter(parts, lambda p: p != "")
    return F.slice(parts, F.greatest(F.lit(1), F.size(parts) - keep + 1), F.lit(keep))


def image_extension(c: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in vocab.EXTENSIONS.items() for x in kv))
    return F.coalesce(F.try_element_at(table, F.regexp_replace(F.lower(F.trim(c)), r"^\.+", "")), F.lit(""))


def pair_id(pdf: Column, page: Column, asset: Column) -> Column:
    return stable_id("pdf_asset", pdf, page, asset)


def pair_basename(pdf: Column, page: Column, asset: Column) -> Column:
    name = F.replace(slug(F.regexp_replace(pdf, r"\.[^./]+$", "")), F.lit("/"), F.lit("__"))
    return F.format_string("%s__p%04d__a%02d__%s", name, page, asset, pair_id(pdf, page, asset))


def normalize_line(c: Column) -> Column:
    c = strip(F.translate(c, "\x00 ", "  "))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "^[•*\\-–—]+\\s*", ""), WS, " "), r"^[ |]+|[ |]+$", "")


def is_noise(line: Column) -> Column:
    return let(strip(F.lower(line)), _noise)


def _noise(low: Column) -> Column:
    return (low == "") | low.rlike(r"^(page\s*)?\d+(\s*(/|of)\s*\d+)?$") | low.rlike(r"^[-_=|. ]{3,}$") | low.rlike(r"(?U)^[^\p{L}\p{N}]$")


def is_date_or_time(line: Column) -> Column:
    low = strip(F.lower(line))
    days = "|".join(vocab.WEEKDAYS)
    return (low == "") | low.rlike(r"^\d{1,2}[.:]\d{2}$") | low.rlike(r"^\d{1,2}[./-]\d{1,2}[./-]\d{2,4}$") | low.rlike(rf"(?U)^({days}),?\s+\d{{1,2}}\.\s+\w+\s+\d{{4}}$")


def distinct_lines(lines: Column) -> Column:
    """First of each line apart from case, in order; blank ones dropped. Linear: lower-case lines are made once, their first places
    come from a map whose later keys give way, and places are sorted."""
    kept = F.filter(F.transform(lines, normalize_line), lambda x: x != "")
    return first_apart_from_case(kept)


def first_apart_from_case(kept: Column) -> Column:
    keyed = F.transform(kept, lambda x, i: F.struct(F.lower(x).alias("low"), i.alias("i"), x.alias("x")))
    ranked = F.sort_array(keyed)  # by line, then place
    before = F.concat(F.slice(F.array(F.lit(None).cast("string")), 1, 1), F.transform(ranked, lambda r: r["low"]))
    first = F.filter(F.zip_with(ranked, before, lambda r, b: F.struct(r["i"].alias("i"), r["x"].alias("x"), (r["low"].isNotNull() & ~r["low"].eqNullSafe(b)).alias("new"))), lambda r: r["new"])
    return F.transform(F.sort_array(F.transform(first, lambda r: F.struct(r["i"], r["x"]))), lambda r: r["x"])


def polish(text: Column, most: int | None = None) -> Column:
    """Lines of a text: hyphens at line ends undone, cleaned, without noise, each once. A single line falls into sentences."""
    whole = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)(\w)-\n(\w)", "$1$2")
    lines = F.when(whole.contains("\n"), F.split(whole, "\n")).otherwise(F.split(whole, r"(?<=[.!?])\s+"))
    clean = F.filter(F.transform(lines, normalize_line), lambda x: ~is_noise(x))
    out = distinct_lines(clean)
    return out if most is None else F.slice(out, 1, most)


def meaningful(text: Column) -> Column:
    return F.filter(polish(text), lambda x: ~is_date_or_time(x))


def focus_line(*texts: Column) -> Column:
    long = [F.try_element_at(F.filter(meaningful(t), lambda x: F.length(x) >= 8), F.lit(1)) for t in texts]
    any_ = [F.try_element_at(polish(t), F.lit(1)) for t in texts]
    return F.coalesce(*long, *any_, F.lit(""))


def punctuation(c: Column) -> Column:
    """Smart quotes, dashes, ellipsis and no-break space to ASCII; zero-width space and BOM dropped."""
    one = {k: v for k, v in vocab.PUNCTUATION.items() if len(v) == 1}
    c = F.translate(c, "".join(one) + "​﻿", "".join(one.values()))
    return F.replace(c, F.lit("…"), F.lit("..."))


def _fold(s: str) -> str:
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()


def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """By the rule of NFKD: characters that fold to one ASCII character, and those that fold to several."""
    one, more = {}, {}
    for c in map(chr, range(0x80, 0x110000)):
        if not 0xD800 <= ord(c) <= 0xDFFF and (low := _fold(c)):
            (one if len(low) == 1 else more)[c] = low
    return one, more


_ONE, _MORE = _folds()
_MORE_JSON = json.dumps(_MORE)


def _as_class(chars) -> str:
    """A pattern for any of some characters beyond ASCII, as ranges; ASCII is told apart first."""
    ranges: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return r"(?=\P{ASCII})[" + "".join(rf"\x{{{a:X}}}-\x{{{z:X}}}" for a, z in ranges) + "]"


def fold(c: Column) -> Column:
    """NFKD, then ASCII only, character by character (what decomposes leaves no ASCII out of order). Stays in the JVM, also in lambdas."""
    table = F.from_json(F.lit(_MORE_JSON), "map<string,string>")  # a literal, folded once
    spread = lambda x: F.array_join(F.transform(F.split(x, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), "")
    wide = lambda x: F.when(x.rlike(_as_class(_MORE)), spread(x)).otherwise(x)
    narrow = lambda x: F.regexp_replace(F.translate(wide(x), "".join(_ONE), "".join(_ONE.values())), r"[^\p{ASCII}]", "")
    return let(c, lambda x: F.when(x.rlike(r"^\p{ASCII}*$"), x).otherwise(narrow(x)))


def token(c: Column) -> Column:
    return F.regexp_replace(F.lower(fold(c)), "[^a-z0-9]+", "")


def label(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(fold(c)), "[^a-z0-9]+", " "))


_C1 = re.compile("[\x80-\x9f]")


def _marks(s: str) -> int:
    return 0 if s.isascii() else sum(s.count(m) for m in vocab.MOJIBAKE) + len(_C1.findall(s))


def repair_text(s: str) -> str:
    """Text that was decoded by a one-byte code page, decoded anew while that leaves fewer marks, at most twice."""
    for _ in range(2):
        best, low = s, _marks(s)
        if not low:
            break
        for page in ("latin-1", "cp1252"):
            try:
                again = s.encode(page).decode("utf-8")
            except UnicodeError:
                continue
            if (n := _marks(again)) < low:
                best, low = again, n
        if best == s:
            break
        s = best
    return s


@F.pandas_udf(StringType())
def _repair_batch(s: pd.Series) -> pd.Series:
    return s.map(repair_text, na_action="ignore")


def repair(c: Column) -> Column:
    dirty = c.rlike("[�ÃÂâï]")
    return F.when(dirty, _repair_batch(F.when(dirty, c))).otherwise(c)
