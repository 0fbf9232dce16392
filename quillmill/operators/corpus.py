"""Knowledge corpus: document rows, word-window chunks, lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions import text as T

SIZE, OVERLAP = 320, 40


def chunks(text: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """Windows of ``size`` words, ``size - overlap`` apart, joined by one space; one window for a text that fits."""
    step = max(1, size - overlap)
    starts = lambda n: F.when(n == 0, F.array().cast("array<int>")).when(n <= size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n - 1, F.lit(step)))
    # the words are split once, whatever the number of windows
    return T.let(T.words(text), lambda ws: F.transform(starts(F.size(ws)), lambda i: F.array_join(F.slice(ws, i + 1, F.lit(size)), " ")))


def document_rows(docs: DataFrame) -> DataFrame:
    """Non-blank documents in the output shape of a source: id, type, path, title, tags, text, density."""
    path = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    text = T.normalize_whitespace(F.col("text"))
    rows = docs.select(T.stable_id("node", path).alias("id"), F.col("source").alias("source_type"), path.alias("source_path"), F.col("doc_id").cast("string").alias("title"), T.path_tags(path).alias("tags"), text.alias("text"))
    return rows.where("text <> ''")


def knowledge_chunks(rows: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """A row per chunk, id ``<document>_chunk_<i>``. Narrow: one pass, no shuffle."""
    out = rows.select("id", "source_type", "source_path", "title", "tags", F.posexplode(chunks(F.col("text"), size, overlap)).alias("chunk_index", "text"))
    return out.select(F.concat("id", F.lit("_chunk_"), F.col("chunk_index").cast("string")).alias("id"), F.col("id").alias("source_document_id"), "source_type", "source_path", "title", "chunk_index", "tags", "text")


def line_table(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each document's distinct non-blank lines (apart from case), first of equals, numbered anew."""
    lines = docs.select(key, F.posexplode(F.split(T.repair(F.col("text")), "\n")).alias("at", "line")).withColumn("line", T.normalize_line(F.col("line"))).where("line <> ''")
    first = lines.groupBy(key, F.lower("line").alias("low")).agg(F.min(F.struct("at", "line")).alias("m")).select(key, "m.*")
    return first.select(key, (F.row_number().over(Window.partitionBy(key).orderBy("at")) - 1).alias("line_index"), "line")
