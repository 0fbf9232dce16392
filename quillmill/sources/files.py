"""Raw files to documents: text, Markdown, YAML, JSON, JSONL and CSV, through Spark's own readers.

A text or JSON file is one value and comes whole. JSONL and CSV files may be of any size: Spark's text reader takes them in ranges, their
lines are cut into pieces, meet again by file, in order, and are parsed as they stream by, so a worker holds a record and not a file.
Bytes that aren't UTF-8 are dropped, blank documents too. A JSON file that can't be parsed gives a row with ``error`` set and no text.
"""

from __future__ import annotations

import codecs
import csv
import io
import json
import re
import sys
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import text as T
from quillmill.operators.records import _lines

SUFFIXES = {".txt": "text", ".md": "text", ".markdown": "text", ".yaml": "text", ".yml": "text", ".json": "json", ".jsonl": "jsonl", ".csv": "csv"}
DOCUMENT = "source_type string, source_path string, format string, title string, record_index int, text string, payload_json string, error string"
_ARROW = pa.schema([(n, pa.int32() if kind == "int" else pa.string()) for n, kind in (f.split() for f in DOCUMENT.split(", "))])
#: Bytes of a line that travel as one row; characters of documents that leave a worker at once.
PIECE, BATCH = 8192, 4_000_000


def clean(text: str) -> str:
    """Wrongly decoded text repaired, white space tidied, as :func:`quillmill.functions.text.normalize_whitespace` has it."""
    text = re.sub(r"[ \t]+", " ", T.repair_text(text).replace("\x00", " ").replace("\r\n", "\n").replace("\r", "\n"))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def _kind(path: str) -> tuple[str | None, str]:
    """Kind and stem of a file by its name."""
    stem, dot, ext = path.rsplit("/", 1)[-1].rpartition(".")
    return SUFFIXES.get(f".{ext.lower()}") if dot else None, stem


def _dump(v) -> str | None:
    return json.dumps(v, ensure_ascii=False) if isinstance(v, dict) else None


def _shown(v) -> str:
    return clean("\n".join(_lines(v)))


def _split(chunks: Iterable[str], split: Callable[[str], list[str]]) -> Iterator[str]:
    """Lines of a text that comes in chunks, ends kept; the last one waits, as it may go on or its \\r be followed by \\n."""
    held: list[str] = []
    for c in chunks:
        held.append(c)
        if "\n" in c or "\r" in c:
            *whole, last = split("".join(held))
            held = [last]
            yield from whole
    yield from split("".join(held))


def _records(kind: str, stem: str, chunks: Iterable[str]) -> Iterator[tuple]:
    """Documents of a JSONL or CSV file, as :func:`parse` has them, one by one."""
    if kind == "jsonl":
        for i, line in enumerate(x.splitlines()[0] for x in _split(chunks, lambda s: s.splitlines(True))):
            if line.strip():
                try:
                    v = json.loads(line)
                except ValueError:
                    v = {"raw_line": line}
                yield kind, f"{stem}_{i}", i, _shown(v), _dump(v), None
    else:
        csv.field_size_limit(sys.maxsize)  # a field may be longer than the library's 131,072 characters
        for i, r in enumerate(csv.DictReader(_split(chunks, lambda s: list(io.StringIO(s, newline=""))))):
            v = {k: x for k, x in r.items() if k is not None}
            yield kind, f"{stem}_{i}", i, _shown(v), _dump(v), None


def parse(path: str, data: bytes) -> list[tuple]:
    """(format, title, record index, text, payload, error) of each document in a file."""
    kind, stem = _kind(path)
    text = data.decode("utf-8", "ignore")
    if kind == "text":
        return [(kind, stem, None, clean(text), None, None)]
    if kind == "json":
        try:
            got = json.loads(text)
        except ValueError as e:
            return [(kind, stem, None, None, None, str(e))]
        if isinstance(got, list):
            return [(kind, f"{stem}_{i}", i, _shown(v), _dump(v), None) for i, v in enumerate(got)]
        return [(kind, stem, None, _shown(got), _dump(got), None)]
    return list(_records(kind, stem, [text])) if kind else []


def _chunks(pieces: Iterable[tuple[int, bytes]]) -> Iterator[str]:
    """Characters of a file from its pieces (place in the line, bytes). The first tells what the text reader left out: the file's size less
    that of its lines, each with a line break, so 3 more for a byte order mark and 1 less without a break at the end."""
    pieces = iter(pieces)
    rest = int(next(pieces)[1])
    decode, before = codecs.getincrementaldecoder("utf-8")("ignore").decode, b""
    if rest >= 2:
        yield decode(codecs.BOM_UTF8)
    for place, piece in pieces:
        yield decode(before + piece if place == 0 else piece)
        before = b"\n"
    yield decode(before if rest in (0, 3) else b"", True)


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    made = lambda some: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), _ARROW, strict=True)], schema=_ARROW)
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r[5] or "") + len(r[6] or "") + 500
        if n > BATCH:
            yield made(held)
            held, n = [], 0
    if held:
        yield made(held)


def _named(*kinds: str) -> str:
    """A glob of the names of some kinds of files, in capitals or not."""
    return "*{" + ",".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in s) for s, k in SUFFIXES.items() if k in kinds) + "}"


def _pieces(spark: SparkSession, root: str) -> DataFrame:
    """JSONL and CSV files under a folder as pieces of their lines, in order within each file, a file in one partition: path, start, line, place, piece.

    A range's lines keep their order by a rising number; a range by its start. Each file's first row is what :func:`_chunks` asks for.
    """
    lines = spark.read.format("text").option("recursiveFileLookup", "true").option("lineSep", "\n").option("pathGlobFilter", _named("jsonl", "csv")).load(root)
    of = F.col("_metadata")
    lines = lines.select(of["file_path"].alias("path"), of["file_block_start"].alias("start"), of["file_size"].alias("size"), F.col("value").cast("binary").alias("bytes"))
    heads = lines.groupBy("path").agg((F.max("size") - F.sum(F.octet_length("bytes") + 1)).cast("string").cast("binary").alias("piece"))
    heads = heads.select("path", F.lit(-1).cast("long").alias("start"), F.lit(0).cast("long").alias("line"), F.lit(0).alias("place"), "piece")
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.octet_length("bytes") - 1) / PIECE).cast("int")), lambda i: F.substring("bytes", i * PIECE + 1, F.lit(PIECE)))
    cut = F.when(F.octet_length("bytes") <= PIECE, F.array("bytes")).otherwise(cut)
    pieces = lines.select("path", "start", F.monotonically_increasing_id().alias("line"), "bytes").select("path", "start", "line", F.posexplode(cut).alias("place", "piece"))
    return heads.unionAll(pieces).repartition("path").sortWithinPartitions("path", "start", "line", "place")


def read_documents(spark: SparkSession, root: str, source_type: str) -> DataFrame:
    """All documents under a folder, paths relative to it, tagged by the parts of their paths."""
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", _named("text", "json")).load(root).select("path", "content")
    local = lambda path: path.split(root.removeprefix("file://").rstrip("/") + "/", 1)[-1]

    def of_files(batches):
        files = ((local(b[0][i].as_py()), b[1][i].as_py()) for b in batches for i in range(b.num_rows))
        return _batches((source_type, path, *r) for path, data in files for r in parse(path, data))

    def of_pieces(batches):
        rows = (r for b in batches for r in zip(b[0].to_pylist(), b[3].to_pylist(), b[4].to_pylist(), strict=True))
        files = ((local(unquote(path)), (r[1:] for r in of)) for path, of in groupby(rows, lambda r: r[0]))
        return _batches((source_type, path, *r) for path, of in files for r in _records(*_kind(path), _chunks(of)))

    got = whole.mapInArrow(of_files, DOCUMENT).unionAll(_pieces(spark, root).mapInArrow(of_pieces, DOCUMENT))
    key = F.when(F.col("format") == "text", F.concat_ws("::", "source_type", "source_path")).otherwise(F.concat_ws("::", F.col("format"), F.col("source_path"), F.col("record_index").cast("string")))
    return got.where("error is not null or text <> ''").withColumn("id", F.substring(F.sha1(key), 1, 16)).withColumn("tags", T.path_tags(F.col("source_path")))


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, null fields left out."""
    df.write.mode("overwrite").json(path)
