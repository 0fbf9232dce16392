"""Queries over page layouts, on inline boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.functions import geometry as G
from quillmill.operators import layout
from quillmill.plans.registry import query
from quillmill.plans.tables import values

_PAIRS = values("id ax0 ay0 ax1 ay1 bx0 by0 bx1 by1", [(i, *(float(v) for v in r)) for i, r in enumerate([
    (0, 0, 10, 10, 10, 0, 20, 10), (0, 0, 100, 100, 5, 5, 95, 95), (0, 0, 100, 100, 20, 0, 120, 100), (0, 0, 50, 20, 60, 30, 90, 60), (10, 10, 5, 5, 0, 0, 10, 10), (0, 0, 500, 250, 0, 260, 500, 300)])])


def _pairs(spark):
    d = spark.sql(_PAIRS)
    box = lambda p: G.box(*(F.col(f"{p}{k}") for k in ("x0", "y0", "x1", "y1")))
    return d.select("id", box("a").alias("a"), box("b").alias("b"))


_W = "WITH p AS (SELECT *, CAST(ax0 AS DOUBLE) AS x FROM (" + _PAIRS + ")), q AS (SELECT *, greatest(0.0, ax1 - ax0) AS aw, greatest(0.0, ay1 - ay0) AS ah, greatest(0.0, bx1 - bx0) AS bw, greatest(0.0, by1 - by0) AS bh, least(ax1, bx1) - greatest(ax0, bx0) AS ix, least(ay1, by1) - greatest(ay0, by0) AS iy FROM p)"


@query("bbox_metrics", _W + """
SELECT id, CAST(aw * ah AS DOUBLE) AS area, ix > 0 AND iy > 0 AS meets, CAST(CASE WHEN ix > 0 AND iy > 0 THEN ix * iy ELSE 0 END / greatest(least(aw * ah, bw * bh), 1.0) AS DOUBLE) AS overlap, CAST(greatest(0.0, ix) / greatest(least(aw, bw), 1.0) AS DOUBLE) AS x_overlap,
  CAST(greatest(0.0, by0 - ay1, ay0 - by1) AS DOUBLE) AS down, CAST(greatest(0.0, bx0 - ax1, ax0 - bx1) AS DOUBLE) AS side, CASE WHEN ix > 0 AND iy > 0 THEN ix * iy ELSE 0 END / greatest(bw * bh, 1.0) >= 0.95 AS holds,
  CAST(round(least(4.0, greatest(2.0, 2200.0 / greatest(aw, ah, 1.0))), 2) AS DOUBLE) AS scale FROM q
""")
def bbox_metrics(spark, sf_dir):
    a, b = F.col("a"), F.col("b")
    return _pairs(spark).select("id", G.area(a).alias("area"), G.intersects(a, b).alias("meets"), G.overlap(a, b).alias("overlap"), G.axis_overlap(a, b).alias("x_overlap"), G.gap(a, b, "y").alias("down"), G.gap(a, b, "x").alias("side"), G.contains(a, b).alias("holds"), G.render_scale(a).alias("scale"))


_BLOCKS = values("page_number block_index x0 y0 x1 y1 font text", [
    (1, 0, 50.0, 50.0, 500.0, 80.0, 18.0, "Heading"), (1, 1, 50.0, 90.0, 500.0, 120.0, 10.0, "intro"), (1, 2, 50.0, 420.0, 280.0, 440.0, 10.0, "below left"), (1, 3, 320.0, 420.0, 550.0, 440.0, 10.0, "below right"),
    (2, 0, 50.0, 10.0, 500.0, 700.0, 10.0, "body"), (2, 1, 50.0, 100.0, 300.0, 200.0, 10.0, "inside"), (3, 0, 50.0, 300.0, 500.0, 320.0, 10.0, "middle"), (3, 1, 50.0, 318.0, 500.0, 400.0, 10.0, "overlapping")])


def _blocks(spark):
    b = spark.sql(_BLOCKS).withColumn("source_pdf", F.lit("a.pdf"))
    return b.select("source_pdf", F.col("page_number").cast("int").alias("page_number"), "block_index", G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("bbox"), F.col("font").cast("double").alias("font"), "text", G.box(F.lit(0), F.lit(0), F.lit(600), F.lit(800)).alias("page"))


@query("text_gaps", f"""
WITH b AS (SELECT page_number, greatest(0.0, y0 - 21.0) AS s, least(800.0, y1 + 21.0) AS e FROM ({_BLOCKS})),
c AS (SELECT page_number, s, e, greatest(0.0, coalesce(max(e) OVER (PARTITION BY page_number ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS cur FROM b),
g AS (SELECT page_number, cur AS y0, s AS y1 FROM c WHERE s - cur >= 128.0 UNION ALL SELECT page_number, max(e), 800.0 - 21.0 FROM b GROUP BY page_number HAVING 800.0 - max(e) >= 128.0)
SELECT CAST(page_number AS INTEGER) AS page_number, CAST(18.0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(582.0 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1 FROM g
""")
def text_gaps(spark, sf_dir):
    return layout.text_gaps(_blocks(spark)).drop("source_pdf")


@query("block_assignment")
def block_assignment(spark, sf_dir):
    page = G.box(F.lit(0), F.lit(0), F.lit(600), F.lit(800))
    a = spark.sql(values("page_number asset_index x0 y0 x1 y1", [(1, 0, 50.0, 150.0, 280.0, 400.0), (1, 1, 320.0, 150.0, 550.0, 400.0)]))
    a = a.select(F.lit("a.pdf").alias("source_pdf"), F.col("page_number").cast("int").alias("page_number"), "asset_index", G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("asset"), page.alias("page"))
    return layout.assign_blocks(a, _blocks(spark).drop("page").withColumnRenamed("bbox", "block"))


def _boxes(spark):
    rows = [("a.pdf", 1, 0.0, 0.0, 10.0, 10.0, "embedded_image"), ("a.pdf", 1, 12.0, 0.0, 20.0, 10.0, "vector_drawing"), ("a.pdf", 1, 33.0, 0.0, 50.0, 10.0, "vector_drawing"), ("a.pdf", 1, 0.0, 100.0, 50.0, 150.0, "embedded_image"), ("a.pdf", 2, 0.0, 0.0, 100.0, 100.0, "embedded_image"), ("a.pdf", 2, 5.0, 5.0, 90.0, 90.0, "vector_drawing")]
    return spark.createDataFrame(rows, "source_pdf string, page_number int, x0 double, y0 double, x1 double, y1 double, source string")


@query("bbox_clusters")
def bbox_clusters(spark, sf_dir):
    return layout.cluster_boxes(_boxes(spark).drop("source"))


@query("asset_candidates")
def asset_candidates(spark, sf_dir):
    return layout.merge_candidates(_boxes(spark))
