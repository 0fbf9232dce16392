"""What the operators of this subpackage share: scratch tables, bounded caches, Arrow helpers.

Every text operator here reads whole texts through ``mapInArrow``; nothing below keeps rows on the
driver, and intermediate tables go to the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as the contracts define it: bytes 0x20 and 0x09-0x0D separate, all else belongs to words.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
_made: dict[str, list[str]] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables. A folder of our own only where the session names none and all runs in one machine's process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='quillmill-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    path = f"{scratch_root(spark)}/quillmill-{tag}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables this session has written; call it when their readers are done."""
    sc = spark.sparkContext
    for path in _made.pop(sc.applicationId, []):
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _drop_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _made:
        try:
            drop_scratch(spark)
        except Exception as e:  # the JVM may be gone by now; the folder then stays for its owner to clear
            print(f"scratch tables were left behind: {type(e).__name__}")


def trim_driver(spark: SparkSession) -> bool:
    """Have the driver's JVM give freed native memory back: planning and compiling take and free it in many threads, and the C library keeps
    it for each of them. True if it did; other JVMs (before 17.0.9, or without glibc) have no such command."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    try:
        args = gateway.new_array(jvm.java.lang.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        # by reflection: the server's own class is not public, and py4j looks for methods there
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:
        return False
    return True


def materialize(df: DataFrame, tag: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: cuts the lineage, survives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    w = df.write.option("compression", "zstd")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    trim_driver(spark)
    back = spark.read.schema(df.schema).parquet(path)
    return back.select(*df.columns)


def fold(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % m


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Total UTF-8 bytes of a text column (one cheap pass; sizes the bucket counts below)."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


class Bounded(dict):
    """A cache that empties itself once it holds ``limit`` keys, so memory stays flat on any input."""

    def __init__(self, make: Callable, limit: int = 400_000) -> None:
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def _trim() -> None:
    """Give freed memory back: workers live on after a task, beside those of the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def lean(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``f``, after which a worker keeps none of its memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        _trim()

    return run


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def sized(batches: Iterator[pa.RecordBatch], at: int, size: int, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Slices that hold at most ``rows`` rows and ``size`` bytes in the texts of column ``at``; a longer text is a slice alone."""
    for b in batches:
        ends = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(b.column(at)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)]
        a = 0
        while a < b.num_rows:
            z = max(a + 1, min(a + rows, int(np.searchsorted(ends, ends[a] + size, "right")) - 1))
            yield b.slice(a, z - a)
            a = z


def per_text(docs: DataFrame, keep: list[Column], make: Callable[[], Callable[[str], tuple]], fields: list[tuple[str, pa.DataType]], schema: str, text: str = "text", null: str | None = "") -> DataFrame:
    """One result row per document: ``keep`` columns, then what the function built by ``make()`` says of the text.

    ``make`` runs once in each task (it holds caches); null texts are passed as ``null``.
    """
    src = docs.select(*keep, F.col(text).alias("__text"))
    names = src.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in slices(batches):
            got = [f(null if t is None else t) for t in b.column(b.num_columns - 1).to_pylist()]
            cols = [pa.array([g[i] for g in got], type=t) for i, (_, t) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), *cols], names=[*names, *(n for n, _ in fields)])

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]), schema])
    return src.mapInArrow(lean(run), ddl)


def per_batch(docs: DataFrame, keep: list[Column], make: Callable[[], Callable[[list[str]], tuple]], fields: list[tuple[str, pa.DataType]], schema: str, text: str = "text") -> DataFrame:
    """As :func:`per_text`, but the function built by ``make()`` takes some texts (null: empty) and gives a column for each field."""
    src = docs.select(*keep, F.col(text).alias("__text"))
    names = src.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in slices(batches):
            got = f([t or "" for t in b.column(b.num_columns - 1).to_pylist()])
            cols = [pa.array(g, type=t) for g, (_, t) in zip(got, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), *cols], names=[*names, *(n for n, _ in fields)])

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]), schema])
    return src.mapInArrow(lean(run), ddl)


def in_one_task(sample: DataFrame, order: list[str], f: Callable[[Iterator[pa.RecordBatch]], bytes]) -> bytes | None:
    """What ``f`` makes of a sample (bounded by the caller), sorted, in one task: fitting costs an executor's memory, not the driver's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([f(batches)], pa.binary())], names=["made"])

    got = sample.repartition(1).sortWithinPartitions(*order).mapInArrow(lean(run), "made binary").collect()
    return bytes(got[0]["made"]) if got else None


def pack_strings(parts: list[bytes]) -> bytes:
    """Byte strings as one: their number, their lengths, their bytes."""
    n = np.array([len(parts), *map(len, parts)], np.uint32)
    return n.tobytes() + b"".join(parts)


def unpack_strings(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    sizes = np.frombuffer(data, np.uint32, n, 4)
    ends = (4 + 4 * n + np.cumsum(sizes, dtype=np.int64)).tolist()
    out, at = [], 4 + 4 * n
    for e in ends:
        out.append(data[at:e])
        at = e
    return out


def row_key(*names: str) -> Column:
    """A 128-bit key of some columns, equal only for rows equal in them (nulls tell themselves from all values)."""
    parts = [F.coalesce(F.concat(F.octet_length(F.col(n).cast("string")).cast("string"), F.lit(":"), F.col(n).cast("string")), F.lit("-")) for n in names]
    return F.unhex(F.md5(F.concat(*parts)))


def spare_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` hasn't."""
    low = {c.lower() for c in df.columns}
    while f"__{name}" in low:
        name += "_"
    return f"__{name}"


def unsigned_hash(*cols: Column, seed: str = "") -> Column:
    """A uniform double in [0, 1) from a stable 64-bit hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))
