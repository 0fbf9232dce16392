"""Validation, review, quality and export gates, with their histograms; deterministic splits; batches; prior work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions import vocab
from quillmill.functions.text import strip

ROLES = ("system", "user", "assistant")


def messages_valid(messages: Column) -> Column:
    """Two messages or more, known roles, contents that aren't blank; null is invalid."""
    each = F.forall(messages, lambda m: F.coalesce(m["role"].isin(*ROLES) & (strip(m["content"]) != ""), F.lit(False)))
    return F.coalesce((F.size(messages) >= 2) & each, F.lit(False))


def example_errors(id_: Column, messages: Column, metadata: Column) -> Column:
    blank = lambda c: F.coalesce(strip(c) == "", F.lit(True))
    return F.array_compact(F.array(
        F.when(blank(id_), "missing id"), F.when(~messages_valid(messages), "invalid messages"), F.when(metadata.isNull(), "missing metadata"),
        F.when(metadata.isNotNull() & blank(metadata["task_type"]), "missing metadata.task_type"),
        F.when(metadata.isNotNull() & blank(metadata["source_path"]), "missing metadata.source_path"),
    ))


def chats(turns: DataFrame) -> DataFrame:
    """A conversation a row: messages in order of turn."""
    got = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    return got.select("conv_id", F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content"))).alias("messages"))


def split_train_eval(rows: DataFrame, key: str, salt: str = "split") -> DataFrame:
    """``split`` = train for the first max(1, 9n div 10) rows by salted SHA-1 of the key, eval for the rest.

    Ranks come from two levels, buckets of the hash and places in them, so no task sorts all rows.
    """
    h = rows.withColumn("__h", F.sha1(F.concat(F.lit(f"{salt}::"), F.col(key).cast("string")))).withColumn("__b", F.substring("__h", 1, 3))
    sizes = h.groupBy("__b").agg(F.count(F.lit(1)).alias("c"))  # 4096 rows at most
    base = sizes.select("__b", F.coalesce(F.sum("c").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.sum("c").over(Window.partitionBy()).alias("n"))
    rank = F.row_number().over(Window.partitionBy("__b").orderBy("__h", key)) + F.col("base")
    ranked = h.join(F.broadcast(base), "__b").withColumn("__r", rank)
    cut = F.when(F.col("n") <= 1, F.col("n")).otherwise(F.greatest(F.lit(1), F.expr("n * 9 div 10")))
    return ranked.withColumn("split", F.when(F.col("__r") <= cut, "train").otherwise("eval")).drop("__h", "__b", "__r", "base", "n")


def rank_of(quality: Column) -> Column:
    return F.try_element_at(F.create_map(*(x for k, v in vocab.QUALITY_RANKS.items() for x in (F.lit(k), F.lit(v)))), quality)


def export_reason(a: dict[str, Column], least: str = "medium", require_llm: bool = True, allow_review: bool = False) -> Column:
    """The first gate an annotation fails, or ``ok``. ``a``: pair_type, has_llm, review_required, quality, confidence, caption, summary, has_signal, has_image."""
    need = vocab.QUALITY_RANKS[least]
    blank = lambda c: F.coalesce(c == "", F.lit(True))
    c = F.when(~a["pair_type"].eqNullSafe("visual_asset"), "not_visual_asset")
    if require_llm:
        c = c.when(~F.coalesce(a["has_llm"], F.lit(False)), "missing_llm_enrichment")
    if not allow_review:
        c = c.when(F.coalesce(a["review_required"], F.lit(False)), "review_required")
    quality = F.when(a["quality"].isin(*vocab.QUALITY_RANKS), a["quality"]).otherwise(F.when(F.coalesce(a["review_required"], F.lit(False)), "low").otherwise("medium"))
    c = c.when(rank_of(quality) < need, f"quality_below_{least}")
    if require_llm:
        c = c.when(rank_of(a["confidence"]) < 1, "llm_confidence_low")
    c = c.when(blank(a["caption"]), "missing_short_caption").when(blank(a["summary"]), "missing_visual_summary")
    return c.when(~F.coalesce(a["has_signal"], F.lit(False)), "missing_visible_signal").when(~F.coalesce(a["has_image"], F.lit(False)), "missing_image").otherwise("ok")


def review_reasons(review: Column, density: Column, asset_type: Column, confidence: Column, source: Column, ocr: Column, symbol: Column, frames: Column) -> Column:
    return F.array_compact(F.array(
        F.when(review, "auto_review_flag"), F.when(density == "low", "low_text_density"), F.when(asset_type == "unknown", "unknown_asset_type"),
        F.when(confidence < 0.45, "low_page_type_confidence"), F.when(source.contains("text_gap"), "text_gap_crop"), F.when(encoding_artifacts(ocr), "ocr_encoding_artifacts"),
        F.when(F.coalesce(symbol, F.lit("")) == "", "missing_primary_symbol"), F.when(F.coalesce(F.size(frames), F.lit(0)) == 0, "missing_timeframe"),
    ))


def encoding_artifacts(ocr: Column) -> Column:
    """Marks of text that was decoded wrongly."""
    return F.coalesce(ocr.rlike("|".join(vocab.ARTIFACTS)), F.lit(False))


def page_needs_review(text: Column, density: Column, page_type: Column, confidence: Column, ocr: Column, symbols: Column, frames: Column, n_assets: Column) -> Column:
    """A page with weak text, type or frames, or with pictures but no instrument."""
    none = lambda c: F.coalesce(F.size(c), F.lit(0)) == 0
    blank = F.coalesce(text == "", F.lit(True))
    return blank | (density == "low") | (page_type == "unknown") | (confidence < 0.45) | encoding_artifacts(ocr) | none(frames) | ((n_assets > 0) & none(symbols))


def asset_needs_review(text: Column, density: Column, asset_type: Column, confidence: Column, source: Column, ocr: Column, symbol: Column, frames: Column) -> Column:
    blank = lambda c: F.coalesce(c == "", F.lit(True))
    return blank(text) | (density == "low") | (asset_type == "unknown") | (confidence < 0.45) | source.contains("text_gap") | encoding_artifacts(ocr) | blank(symbol) | (F.coalesce(F.size(frames), F.lit(0)) == 0)


def annotation_quality(symbol: Column, frames: Column, venue: Column, ocr: Column, context: Column, reasons: Column) -> Column:
    have = lambda c: F.when(F.coalesce(c, F.lit("")) != "", 1).otherwise(0)
    score = have(symbol) + F.when(F.coalesce(F.size(frames), F.lit(0)) > 0, 1).otherwise(0) + have(venue) + have(ocr) + have(context) + F.when(~encoding_artifacts(ocr), 1).otherwise(0) - F.least(F.size(reasons), F.lit(3))
    return F.when(score >= 4, "high").when(score >= 2, "medium").otherwise("low")


def histogram(rows: DataFrame, by: str, name: str = "n") -> DataFrame:
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def manifest(rows: DataFrame, by: str) -> DataFrame:
    """One row: the total and the histogram as a map."""
    h = histogram(rows, by)
    return h.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce(F.col(by), F.lit("none")), "n")))).alias("counts"))


def batches(rows: DataFrame, group: str, order: list[str], every: int, limit: int | None = None) -> DataFrame:
    """Position in each group's queue (from 0), and whether a new batch starts there."""
    got = rows.withColumn("position", F.row_number().over(Window.partitionBy(group).orderBy(*order)) - 1)
    got = got if limit is None else got.where(F.col("position") < limit)
    starts = (F.col("position") % every == 0) if every and every > 0 else (F.col("position") == 0)
    return got.withColumn("new_batch", starts)


def stop_after_first(rows: DataFrame, group: str, order: list[str], flag: Column) -> DataFrame:
    """Rows of each group up to and with the first flagged one."""
    before = F.max(F.when(flag, 1).otherwise(0)).over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("__before", F.coalesce(before, F.lit(0))).where("__before = 0").drop("__before")


def preserve(current: DataFrame, prior: DataFrame) -> DataFrame:
    """What becomes of each current row's earlier work: ``id, status, prior_id``. Both sides: id, image_hash (null: no image)."""
    by_hash = prior.where("image_hash is not null").groupBy("image_hash").agg(F.count_distinct("id").alias("n"), F.min("id").alias("one"))
    own = prior.groupBy("id").agg(F.max("image_hash").alias("own_hash"), F.lit(True).alias("known"))
    j = current.join(own, "id", "left").join(by_hash, "image_hash", "left")
    known = F.coalesce("known", F.lit(False))
    same = F.col("image_hash").isNotNull() & (F.col("image_hash") == F.col("own_hash"))
    status = (
        F.when(F.col("image_hash").isNull(), F.when(known, "missing_current_image").otherwise("none")).when(same, "preserved").when(F.col("n") == 1, "preserved")
        .when(F.col("n") > 1, "duplicate_image_hash").when(known, "image_changed").otherwise("none")
    )
    return j.select("id", status.alias("status"), F.when(same, F.col("id")).when((status == "preserved"), F.col("one")).alias("prior_id"))


def upsert(base: DataFrame, updates: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of ``base``, each replaced by the last update of its key; new keys are added. One shuffle by key."""
    cols = base.columns
    both = base.select(*cols, F.lit(0).alias("__u"), F.lit(None).cast(updates.schema[order].dataType).alias("__o")).unionByName(updates.select(*cols, F.lit(1).alias("__u"), F.col(order).alias("__o")))
    last = both.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct("__u", "__o")).alias("r"))
    return last.select("r.*")


def enrichment_jobs(assets: DataFrame, done: DataFrame, images: DataFrame, key: str = "id") -> DataFrame:
    """Assets not done yet that have an image."""
    return assets.join(done.select(key), key, "left_anti").join(images.select(key), key, "left_semi")
