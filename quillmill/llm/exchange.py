"""Blocks of documents that put questions to hash buckets and get the answers back.

Corpus-wide look-ups (is this word known, does this string occur elsewhere) need a shuffle by key. One row for
each key and document would multiply the input, and a frequent key would fill one task. Here documents are
first gathered in blocks of about ``BLOCK_BYTES`` of text, and each block asks for each distinct key once: the
keys of one block and bucket travel as one packed row. A frequent key so reaches its bucket once a block, and
buckets are as many as keep each within memory. Answers return packed in the order of the questions.

Tables of ``ask`` go through the shared folder, so a lost executor costs a re-read, and the blocks that asked are
exactly those that are answered; ``ask_once`` leaves that to Spark's own recovery of shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import lean, materialize, slices

BLOCK_BYTES = 2 << 20
_TABLE = "kind int, block long, bucket int, payload binary"
_ANSWER = "block long, bucket int, answer binary"


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _batch(cols: list[tuple[list, pa.DataType]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in cols], names=names)


def _asked(docs: DataFrame, make: Callable, block_bytes: int) -> DataFrame:
    """Rows of kind 0, a block each, and of kind 1, the keys that a block asks of a bucket."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        f, part, seq, ids, texts, held = make(), TaskContext.get().partitionId(), 0, [], [], 0

        def out():
            payload, questions = f(ids, texts)
            block = part << 32 | seq
            k = [0] + [1] * len(questions)
            return _batch([(k, pa.int32()), ([block] * len(k), pa.int64()), ([-1, *(b for b, _ in questions)], pa.int32()), ([payload, *(p for _, p in questions)], pa.binary())], ["kind", "block", "bucket", "payload"])

        for b in slices(batches, 256):
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = t or ""
                ids.append(i)
                texts.append(raw)
                held += len(raw)
                if held >= block_bytes:
                    yield out()
                    seq, ids, texts, held = seq + 1, [], [], 0
        if ids:
            yield out()

    return docs.mapInArrow(lean(run), _TABLE)


def ask(docs: DataFrame, make: Callable, tag: str) -> tuple[DataFrame, DataFrame]:
    """Blocks and questions. ``make()`` gives a function of (ids, texts) -> (block payload, [(bucket, payload)]).

    ``docs`` has two columns, an id and the text (null: empty). A text longer than a block is a block alone.
    """
    table = materialize(_asked(docs, make, BLOCK_BYTES), tag, "kind")
    return table.where("kind = 0").select("block", "payload"), table.where("kind = 1").select("block", "bucket", "payload")


def ask_once(docs: DataFrame, make: Callable, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """As :func:`ask` for blocks that are read once: no table is written. Blocks and questions leave in one shuffle, each
    to where it will be needed, and stay there; blocks are the same whenever a lost task is run again, as their
    documents are read by the same split. The filters hold a row number, so that they stay above the shuffle,
    which both readers then share.
    """
    home = F.when(F.col("kind") == 0, F.col("block")).otherwise(-1 - F.col("bucket"))
    table = _asked(docs, make, block_bytes).withColumn("home", home.cast("long")).repartition("home")
    of = lambda kind: table.where((F.col("kind") == kind) | (F.monotonically_increasing_id() < 0))
    return of(0), of(1)


def answer(questions: DataFrame, make: Callable) -> DataFrame:
    """``make()`` gives a function of [(block, payload)], all of one bucket, -> answers in that order."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["block"].to_pylist(), table["payload"].to_pylist(), strict=True))
        got = make()(rows)
        return pa.table({"block": pa.array([b for b, _ in rows], pa.int64()), "bucket": pa.array([table["bucket"][0].as_py()] * len(rows), pa.int32()), "answer": pa.array(got, pa.binary())})

    return questions.groupBy("home" if "home" in questions.columns else "bucket").applyInArrow(run, _ANSWER)


def resolve(blocks: DataFrame, answers: DataFrame, f: Callable, schema: str) -> DataFrame:
    """``f(block, payload, {bucket: answer})`` -> an Arrow table of ``schema``, for every block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = dict(zip(right["bucket"].to_pylist(), right["answer"].to_pylist(), strict=True))
        return f(left["block"][0].as_py(), left["payload"][0].as_py(), found)

    return blocks.groupBy("home" if "home" in blocks.columns else "block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def buckets_for(n_bytes: int, per_bucket: int) -> int:
    return max(8, -(-n_bytes // per_bucket))


def doc_frame(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
