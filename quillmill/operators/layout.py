"""Pages: gaps between text, clusters of boxes, blocks dealt to assets. Relational but for clustering, which depends on order and runs page by page."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions import geometry as G

PAGE = ["source_pdf", "page_number"]


def text_gaps(blocks: DataFrame) -> DataFrame:
    """Vertical gaps of at least MIN_GAP of a page between its text blocks, and below them: gaps and islands by a running maximum.

    ``blocks``: source_pdf, page_number, bbox, page (boxes). A gap below ends one padding above the foot of the page.
    """
    h = F.greatest(G.height(F.col("page")), F.lit(1.0))
    pad = F.least(F.lit(G.MARGIN / 2), h * 0.03)
    side = F.least(F.lit(G.MARGIN / 2), G.width(F.col("page")) * 0.03)
    b = blocks.select(*PAGE, "page", h.alias("h"), pad.alias("pad"), side.alias("side"), F.greatest(F.col("page.y0"), F.col("bbox.y0") - pad).alias("s"), F.least(F.col("page.y1"), F.col("bbox.y1") + pad).alias("e"))
    w = Window.partitionBy(*PAGE).orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    between = b.withColumn("cursor", F.greatest(F.col("page.y0"), F.coalesce(F.max("e").over(w), F.col("page.y0")))).where("s - cursor >= h * 0.16")
    tail = b.groupBy(*PAGE).agg(F.first("page").alias("page"), F.first("h").alias("h"), F.first("pad").alias("pad"), F.first("side").alias("side"), F.max("e").alias("cursor"))
    tail = tail.withColumn("cursor", F.greatest("cursor", F.col("page.y0"))).where("page.y1 - cursor >= h * 0.16")
    shape = lambda df, end: df.select(*PAGE, (F.col("page.x0") + F.col("side")).alias("x0"), F.col("cursor").alias("y0"), (F.col("page.x1") - F.col("side")).alias("x1"), end.alias("y1"))
    return shape(between, F.col("s")).unionByName(shape(tail, F.col("page.y1") - F.col("pad")))


def assign_blocks(assets: DataFrame, blocks: DataFrame, most: int = 6) -> DataFrame:
    """For each asset its text blocks, in reading order.

    A block belongs to the asset of its page that it fits best; of assets it fits alike (to 1e-6) to those it stands above, or to all
    if it stands above all or none. Of an asset's blocks with the same text apart from case the best stays, then the best ``most``.
    An asset that no block fits takes the two nearest that share a fifth of its width.

    assets: PAGE, asset_index, asset (box), page (box); blocks: PAGE, block_index, block (box), font, text. Pages are joined with
    themselves only, and assets of a page are few.
    """
    asset, block = F.col("asset"), F.col("block")
    fits = assets.join(blocks, PAGE).withColumn("score", G.block_score(block, F.col("font"), asset, F.col("page"))).withColumn("above", G.prefers(block, asset))
    rivals = F.collect_list(F.struct("asset_index", "score", "above")).over(Window.partitionBy(*PAGE, "block_index"))
    fits = fits.withColumn("rivals", F.filter(rivals, lambda r: (r["asset_index"] != F.col("asset_index")) & r["score"].isNotNull()))
    top = F.array_max(F.transform("rivals", lambda r: r["score"]))
    level = F.abs(top - F.col("score")) <= 1e-6
    beaten = (top > F.col("score")) | (level & F.exists("rivals", lambda r: (F.abs(r["score"] - top) <= 1e-6) & (r["above"] > F.col("above"))))
    own = fits.withColumn("own", F.col("score").isNotNull() & ~F.coalesce(beaten, F.lit(False)))
    of = [*PAGE, "asset_index"]
    own = own.withColumn("any", F.max("own").over(Window.partitionBy(*of)))
    first = F.row_number().over(Window.partitionBy(*of, F.lower("text")).orderBy(F.desc("score"), "block_index"))
    good = own.where("own").withColumn("k", first).where("k = 1").withColumn("k", F.row_number().over(Window.partitionBy(*of).orderBy(F.desc("score"), "block_index"))).where(F.col("k") <= most)
    near = own.where(~F.col("any") & (G.axis_overlap(asset, block, "x") >= 0.2))
    near = near.withColumn("k", F.row_number().over(Window.partitionBy(*of).orderBy(G.gap(asset, block, "y"), G.gap(asset, block, "x"), "block_index"))).where("k <= 2")
    reading = Window.partitionBy(*of).orderBy("block.y0", "block.x0", "block_index")
    return good.unionByName(near).select(*of, "block_index", (F.row_number().over(reading) - 1).alias("position"), "text")


Box = tuple[float, float, float, float]


def _union(a: Box, b: Box) -> Box:
    return min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])


def _grown(b: Box, by: float, page: Box) -> Box:
    return max(page[0], b[0] - by), max(page[1], b[1] - by), min(page[2], b[2] + by), min(page[3], b[3] + by)


def _meet(a: Box, b: Box) -> bool:
    return max(a[0], b[0]) < min(a[2], b[2]) and max(a[1], b[1]) < min(a[3], b[3])


def _merged(boxes: list[Box], gap: float, page: Box) -> list[Box]:
    """In reading order, each box joins the first cluster that meets it once both are grown by ``gap``; again until nothing joins."""
    out = sorted(boxes, key=lambda b: (b[1], b[0]))
    while True:
        kept: list[Box] = []
        for b in out:
            k = next((i for i, o in enumerate(kept) if _meet(_grown(o, gap, page), _grown(b, gap, page))), None)
            if k is None:
                kept.append(b)
            else:
                kept[k] = _union(kept[k], b)
        if len(kept) == len(out):
            return sorted(kept, key=lambda b: (b[1], b[0]))
        out = kept


_EDGES = ["x0", "y0", "x1", "y1"]
_NO_PAGE = (float("-inf"), float("-inf"), float("inf"), float("inf"))


def _page_of(boxes: pd.DataFrame) -> Box:
    return tuple(boxes.iloc[0]["page"][e] for e in _EDGES) if "page" in boxes else _NO_PAGE


def cluster_boxes(boxes: DataFrame, gap: float = 14.0) -> DataFrame:
    """Boxes of a page merged while any two meet once both are grown by ``gap``, within the page. PAGE, x0, y0, x1, y1 and, to clamp, page (box)."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        got = _merged(list(pdf[_EDGES].itertuples(index=False, name=None)), gap, _page_of(pdf))
        return pd.DataFrame([(*key, i, *b) for i, b in enumerate(got)], columns=[*PAGE, "cluster", *_EDGES])

    return boxes.groupBy(*PAGE).applyInPandas(one, "source_pdf string, page_number int, cluster int, x0 double, y0 double, x1 double, y1 double")


def merge_candidates(boxes: DataFrame) -> DataFrame:
    """Visual candidates of a page, largest first: one that overlaps an earlier by 0.75 of the smaller, or is 0.9 inside it or it inside, joins it.

    Sources unite, the union is clamped to the page (where ``boxes`` has one), and a candidate of several loses its own picture: ``own_image``
    tells of those that are one embedded picture as it stands.
    """

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        area = lambda b: max(0.0, b[2] - b[0]) * max(0.0, b[3] - b[1])
        page = _page_of(pdf)
        kept: list[tuple[Box, frozenset[str], int]] = []
        rows = sorted(pdf[[*_EDGES, "source"]].itertuples(index=False, name=None), key=lambda r: (-area(r), r[1], r[0]))
        for *b, source in rows:
            for i, (o, names, n) in enumerate(kept):
                both = max(0.0, min(o[2], b[2]) - max(o[0], b[0])) * max(0.0, min(o[3], b[3]) - max(o[1], b[1]))
                small = min(area(o), area(b))
                if both / max(1.0, small) >= 0.75 or max(both / max(1.0, area(b)), both / max(1.0, area(o))) >= 0.9:
                    kept[i] = (_grown(_union(o, tuple(b)), 0.0, page), names | {*source.split("+")}, n + 1)
                    break
            else:
                kept.append((tuple(b), frozenset(source.split("+")), 1))
        kept.sort(key=lambda k: (k[0][1], k[0][0]))
        out = [(*key, i, *b, "+".join(sorted(s)), n == 1 and s == {"embedded_image"}) for i, (b, s, n) in enumerate(kept)]
        return pd.DataFrame(out, columns=[*PAGE, "asset_index", *_EDGES, "source", "own_image"])

    return boxes.groupBy(*PAGE).applyInPandas(one, "source_pdf string, page_number int, asset_index int, x0 double, y0 double, x1 double, y1 double, source string, own_image boolean")


def discover_candidates(pages: DataFrame, images: DataFrame, drawings: DataFrame, blocks: DataFrame) -> DataFrame:
    """The visual candidates of every page: embedded pictures and clusters of drawings that are large enough; where a page has neither, the
    gaps between its text.

    pages: PAGE, page (box); images, drawings: PAGE, bbox; blocks: PAGE, bbox. Drawings under 0.03 of the page or a quarter of its width are left out.
    """
    flat = lambda df, source: df.select(*PAGE, "page", *(F.col(f"bbox.{e}").alias(e) for e in _EDGES), F.lit(source).alias("source"))
    large = lambda df: df.where(G.is_visual(G.box(*(F.col(e) for e in _EDGES)), F.col("page")))
    one = lambda c: F.greatest(c, F.lit(1.0))
    drawn = drawings.join(pages, PAGE).where((G.area(F.col("bbox")) > 0) & (G.area(F.col("bbox")) / one(G.area(F.col("page"))) >= 0.03) & (G.width(F.col("bbox")) / one(G.width(F.col("page"))) >= 0.25))
    drawn = cluster_boxes(flat(drawn, "vector_drawing").drop("source")).join(pages, PAGE).select(*PAGE, "page", *_EDGES, F.lit("vector_drawing").alias("source"))
    found = merge_candidates(large(flat(images.join(pages, PAGE), "embedded_image").unionByName(drawn)))
    bare = blocks.join(pages, PAGE).join(found.select(*PAGE).distinct(), PAGE, "left_anti")
    gaps = text_gaps(bare).join(pages, PAGE).select(*PAGE, "page", *_EDGES, F.lit("text_gap").alias("source"))
    return found.unionByName(merge_candidates(large(gaps)))
