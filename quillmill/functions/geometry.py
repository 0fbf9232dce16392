"""Bounding boxes as structs (x0, y0, x1, y1) of doubles; page, block and asset measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARGIN, PADDING = 42.0, 10.0
MIN_WIDTH, MIN_HEIGHT, MIN_AREA, MIN_GAP = 0.2, 0.12, 0.02, 0.16


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(*(c.cast("double").alias(n) for c, n in ((x0, "x0"), (y0, "y0"), (x1, "x1"), (y1, "y1"))))


def width(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["x1"] - b["x0"])


def height(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["y1"] - b["y0"])


def area(b: Column) -> Column:
    return width(b) * height(b)


def intersection(a: Column, b: Column) -> Column:
    """Null where boxes only touch, or are apart."""
    x0, y0, x1, y1 = F.greatest(a["x0"], b["x0"]), F.greatest(a["y0"], b["y0"]), F.least(a["x1"], b["x1"]), F.least(a["y1"], b["y1"])
    return F.when((x0 < x1) & (y0 < y1), box(x0, y0, x1, y1))


def intersects(a: Column, b: Column) -> Column:
    return (F.greatest(a["x0"], b["x0"]) < F.least(a["x1"], b["x1"])) & (F.greatest(a["y0"], b["y0"]) < F.least(a["y1"], b["y1"]))


def union(a: Column, b: Column) -> Column:
    return box(F.least(a["x0"], b["x0"]), F.least(a["y0"], b["y0"]), F.greatest(a["x1"], b["x1"]), F.greatest(a["y1"], b["y1"]))


def expand(b: Column, by: float, page: Column) -> Column:
    return box(F.greatest(page["x0"], b["x0"] - by), F.greatest(page["y0"], b["y0"] - by), F.least(page["x1"], b["x1"] + by), F.least(page["y1"], b["y1"] + by))


def overlap(a: Column, b: Column) -> Column:
    """Intersection over the smaller area (at least 1)."""
    return F.coalesce(area(intersection(a, b)), F.lit(0.0)) / F.greatest(F.least(area(a), area(b)), F.lit(1.0))


def axis_overlap(a: Column, b: Column, axis: str = "x") -> Column:
    lo, hi = f"{axis}0", f"{axis}1"
    size = width if axis == "x" else height
    both = F.greatest(F.lit(0.0), F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]))
    return both / F.greatest(F.least(size(a), size(b)), F.lit(1.0))


def gap(a: Column, b: Column, axis: str = "y") -> Column:
    lo, hi = f"{axis}0", f"{axis}1"
    return F.greatest(F.lit(0.0), b[lo] - a[hi], a[lo] - b[hi])


def contains(outer: Column, inner: Column, share: float = 0.95) -> Column:
    return F.coalesce(area(intersection(outer, inner)), F.lit(0.0)) / F.greatest(area(inner), F.lit(1.0)) >= share


def is_visual(b: Column, page: Column) -> Column:
    one = lambda c: F.greatest(c, F.lit(1.0))
    return (width(b) / one(width(page)) >= MIN_WIDTH) & (height(b) / one(height(page)) >= MIN_HEIGHT) & (area(b) / one(area(page)) >= MIN_AREA)


def render_scale(b: Column) -> Column:
    """2200 pixels over the longer edge, from 2 to 4, to two places."""
    return F.round(F.least(F.lit(4.0), F.greatest(F.lit(2.0), F.lit(2200.0) / F.greatest(width(b), height(b), F.lit(1.0)))), 2)


def padding(source: Column) -> Column:
    """Points around an asset when it is drawn: none where an embedded picture is part of it."""
    return F.when(source.contains("embedded_image"), 0.0).otherwise(PADDING)


def rounded(b: Column) -> Column:
    return F.struct(*(F.round(b[e], 2).alias(e) for e in ("x0", "y0", "x1", "y1")))


def share_of_page(b: Column, page: Column) -> Column:
    """A box as parts of its page, to four places."""
    wide, high = F.greatest(width(page), F.lit(1.0)), F.greatest(height(page), F.lit(1.0))
    return F.struct(*(F.round((b[e] - page[f"{e[0]}0"]) / (wide if e[0] == "x" else high), 4).alias(e) for e in ("x0", "y0", "x1", "y1")))


def block_score(block: Column, font: Column, asset: Column, page: Column) -> Column:
    """How well a text block belongs to an asset; null outside its window."""
    x, down, side = axis_overlap(asset, block, "x"), gap(asset, block, "y"), gap(asset, block, "x")
    near = (x >= 0.35) & (down <= F.greatest(F.lit(2 * MARGIN), height(page) * 0.18))
    above = block["y1"] <= asset["y0"]
    score = x * 2.5 + 1.0 / (1.0 + down / 72.0) + F.when(above, 0.2).otherwise(0.0) + F.when(above & (font >= 14), 0.4).otherwise(0.0)
    return F.when(intersects(expand(asset, MARGIN, page), block) | near, score - F.least(side / F.greatest(width(page), F.lit(1.0)), F.lit(1.0)))


def prefers(block: Column, asset: Column) -> Column:
    return F.when(block["y0"] + block["y1"] <= asset["y0"] + asset["y1"], 1).otherwise(0)
