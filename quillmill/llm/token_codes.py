"""Token-id output in directly addressable codes.

Ids are split into chunks of ``CHUNK`` bits. Level 0 holds every id's lowest chunk; a bitmap says which ids go
on, and level 1 holds those ids' next chunk, and so on. A directory of the ones before each ``BLOCK`` bits
makes rank a table look-up and a population count, so the i-th token is read without decoding its neighbours.

A segment is one self-contained byte string: ``DACS``, chunk bits, levels, number of ids; then for each level
its length, its chunks, and, but for the last, its bitmap and its directory. Segments of about ``SEGMENT`` ids
are the rows of the written table, next to the ids of their documents and the documents' first places.

``write_tokens`` keeps ascending doc_id order (null ids first; repeated ids side by side, by content), with one
shuffle of the ids; they are coded once, a segment at a time. ``read_tokens`` gives a row per document. Null texts are
empty; long texts are encoded whole, and a document longer than a segment makes a segment of its own length; rows that
repeat a doc_id stay side by side; extra columns are ignored; an empty table makes no segment and reads as no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm.common import documents, lean, materialize, slices

CHUNK, BLOCK, SEGMENT, END = 8, 512, 1 << 20, 2
#: Ranges of doc_id that are sorted apart.
MAX_PARTITIONS = 10_000
_MAGIC = b"DACS"


def encode_ids(ids: np.ndarray, chunk: int = CHUNK) -> bytes:
    """A segment of unsigned ids (``chunk`` is 8 or 16 bits)."""
    rest, levels = ids.astype(np.uint32), []
    kind = np.uint8 if chunk == 8 else np.uint16
    while True:
        low, high = (rest & ((1 << chunk) - 1)).astype(kind), rest >> chunk
        on = high > 0
        if not on.any():
            levels.append((low, None))
            break
        levels.append((low, on))
        rest = high[on]
    out = [_MAGIC, struct.pack("<BBQ", chunk, len(levels), len(ids))]
    for low, on in levels:
        out += [struct.pack("<Q", len(low)), low.tobytes()]
        if on is not None:
            bits = np.packbits(on, bitorder="little")
            ones = np.add.reduceat(on, np.arange(0, len(on), BLOCK), dtype=np.int64)
            out += [bits.tobytes(), np.r_[0, np.cumsum(ones)[:-1]].astype("<u4").tobytes()]
    return b"".join(out)


class Codes:
    """A segment for reading: ``codes[i]`` at random, ``codes.range(a, b)``, ``len(codes)``."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != _MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.chunk, n, self.n = struct.unpack_from("<BBQ", data, 4)
        kind, at, self.levels = (np.uint8 if self.chunk == 8 else np.dtype("<u2")), 14, []
        for k in range(n):
            (m,) = struct.unpack_from("<Q", data, at)
            low = np.frombuffer(data, kind, m, at + 8)
            at += 8 + low.nbytes
            bits = ones = None
            if k < n - 1:
                bits = np.frombuffer(data, np.uint8, -(-m // 8), at)
                at += bits.nbytes
                ones = np.frombuffer(data, "<u4", -(-m // BLOCK), at)
                at += ones.nbytes
            self.levels.append((low, bits, ones))

    def __len__(self) -> int:
        return self.n

    def _rank(self, level: int, i: int) -> int:
        _, bits, ones = self.levels[level]
        first = i // BLOCK * (BLOCK // 8)
        span = np.unpackbits(bits[first : i // 8 + 1], bitorder="little")[: i % BLOCK]
        return int(ones[i // BLOCK]) + int(span.sum())

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, (low, bits, _) in enumerate(self.levels):
            value |= int(low[i]) << (self.chunk * k)
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(k, i)
        return value

    def range(self, a: int, b: int) -> np.ndarray:
        """Ids a to b (exclusive); below the first level only what these ids have there is touched."""
        out, where = np.zeros(b - a, np.uint32), np.arange(b - a)
        for k, (low, bits, _) in enumerate(self.levels):
            if a >= b:
                break
            out[where] |= low[a:b].astype(np.uint32) << np.uint32(self.chunk * k)
            if bits is None:
                break
            on = np.unpackbits(bits[a >> 3 : -(-b // 8)], bitorder="little")[a & 7 :][: b - a].astype(bool)
            where, lo = where[on], self._rank(k, a)
            a, b = lo, lo + int(on.sum())
        return out


#: Bounds of each Python worker's caches: parts of texts between white space, and runs of letters or others in them.
MAX_PARTS, MAX_RUNS = 1_000_000, 600_000
#: Below this code point (Latin, Greek, Cyrillic) letters are letters to every library; İ alone grows a mark in lower case.
_KNOWN, _GROWS = "\u0530", "\u0130"


class Encoder:
    """texts -> ids as the library's ``encode(text, add_special_tokens=False)`` gives them.

    The tokenizer drops white space before it forms pieces, so a text's ids are those of the parts between its
    ASCII white space, one after another. It puts case away and never joins letters with other characters but in
    contractions, so a part in normal form, of scripts where what is a letter is beyond doubt, is in turn its runs of
    letters and of others; all other parts go to the library whole. Texts are cut and their distinct parts found by
    Arrow kernels; a worker keeps the ids of parts and runs it has met. New runs of letters go to the library
    together, and are told apart by word ends.
    """

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        size = self.tok.get_vocab_size()
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(size, bool)
        for word, i in self.tok.get_vocab().items():
            self.ends[i] = word.endswith("</w>")
        self.parts: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.split = regex.compile(r"\p{L}+|\P{L}+").findall

    def _wholes(self, some: list[str]):
        """Of each string the ids that the library gives it alone."""
        for i in range(0, len(some), 1000):
            for e in self.tok.encode_batch_fast(some[i : i + 1000], add_special_tokens=False):
                yield np.array(e.ids, self.kind).tobytes()

    def _words(self, words: list[str], into: dict[str, bytes]) -> None:
        """Put the ids of runs of letters ``into`` a cache."""
        for i in range(0, len(words), 2000):
            some = words[i : i + 2000]
            ids = np.array(self.tok.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            cut = (np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize
            if len(cut) == len(some):
                data, cut = ids.astype(self.kind).tobytes(), cut.tolist()
                into.update(zip(some, [data[a:z] for a, z in zip([0, *cut], cut, strict=False)], strict=True))
            else:  # a word's normal form holds more than letters
                into.update(zip(some, self._wholes(some), strict=True))

    def _learn(self, parts: list[str]) -> None:
        if len(self.parts) + len(parts) > MAX_PARTS:
            self.parts.clear()
        known, runs = self.parts, self.runs
        words, ended, mixed, whole = [], [], [], []
        for p in parts:
            if p.isascii():
                if p.isalpha():
                    words.append(p)
                elif p[:-1].isalpha():
                    ended.append(p)
                elif "'" in p or "<|" in p:
                    whole.append(p)
                else:
                    mixed.append(p)
            elif "'" in p or "<|" in p or max(p) >= _KNOWN or _GROWS in p or not is_normalized("NFC", p):
                whole.append(p)
            elif p.isalpha():
                words.append(p)
            else:
                mixed.append(p)
        known.update(zip(whole, self._wholes(whole), strict=True))
        met = [w for w in words if w in runs]
        known.update(zip(met, [*map(runs.pop, met)], strict=True))
        self._words([w for w in words if w not in known] if met else words, known)
        # the others are runs of letters and of others; a run that is no part itself is held apart
        heads, cut = [p[:-1] for p in ended], [*map(self.split, mixed)]
        every = {p[-1] for p in ended}.union(heads, *cut)
        new = [r for r in every if r not in known and r not in runs]
        if len(runs) + len(new) > MAX_RUNS:
            runs.clear()
            new = [r for r in every if r not in known]
        self._words([r for r in new if r.isalpha()], runs)
        left = [r for r in new if not r.isalpha()]
        runs.update(zip(left, self._wholes(left), strict=True))
        ids = {r: known[r] if r in known else runs[r] for r in every}
        known.update({p: ids[h] + ids[p[-1]] for p, h in zip(ended, heads, strict=True)})
        known.update({p: b"".join([ids[r] for r in own]) for p, own in zip(mixed, cut, strict=True)})

    def __call__(self, texts: pa.Array) -> pa.Array:
        """Each text's ids, as bytes of ``kind`` (null: empty)."""
        texts = pc.fill_null(texts, "")
        # upper case matters in the names of special tokens, and before a combining mark, with which it may compose otherwise than lower case
        texts = pc.if_else(pc.match_substring_regex(texts, r"<\||[A-Z]\p{M}"), texts, pc.ascii_lower(texts))
        cut = pc.ascii_split_whitespace(texts)
        words = cut.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = [*map(self.parts.get, distinct)]
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            some = [distinct[i] for i in new]
            self._learn(some)
            for i, p in zip(new, some, strict=True):
                found[i] = self.parts[p]
        # the parts' ids side by side, then cut anew by text
        ids = pa.array(found, pa.large_binary()).take(words.indices)
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, np.int64, len(ids) + 1, ids.offset * 8) if len(ids) else np.zeros(1, np.int64)
        at = ends[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(at)), data])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for this file; it outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenize(docs: DataFrame, path: str, cuts: np.ndarray | None = None) -> DataFrame:
    """``doc_id, ids, part``: each document's ids as little-endian unsigned integers of the narrowest width that holds the
    vocabulary, and the number of ``cuts`` that its doc_id reaches (null ids: none)."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = np.empty(0, np.int64) if cuts is None else cuts

    def run(batches) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for b in slices(batches, 1024):
            ids = encode(b.column(1))
            part = pa.array(np.searchsorted(cuts, b.column(0).fill_null(np.iinfo(np.int64).min).to_numpy(), "right"), pa.int32())
            for i in range(0, b.num_rows, 512):  # an array of Spark's binary type holds 2 GB
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 512), ids.slice(i, 512).cast(pa.binary()), part.slice(i, 512)], names=["doc_id", "ids", "part"])

    return src.mapInArrow(lean(run), "doc_id long, ids binary, part int")


_SEGMENTS = "part int, seq int, place long, n long, doc_ids array<long>, starts array<long>, codes binary"


def write_tokens(docs: DataFrame, path: str, end: int | None = END, segment: int = SEGMENT) -> DataFrame:
    """Write all documents' ids, each document's followed by ``end``, in ascending doc_id order; gives the table of segments, read back from the shared folder."""
    spark = docs.sparkSession
    parts = min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_PARTITIONS)
    # ranges come from the ids alone: sampling the tokenized rows would tokenize them twice
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), [i / parts for i in range(1, parts)], 10000)).first()[0] if parts > 1 else None
    cuts = np.array(sorted(set(cuts or ())), np.int64)
    ranged = tokenize(docs, path, cuts).repartition(parts, "part").sortWithinPartitions("part", "doc_id", "ids")

    def run(batches) -> Iterator[pa.RecordBatch]:
        kind, stop = encoder(path).kind, b""
        if end is not None:
            kind = kind if end <= np.iinfo(kind).max else np.dtype("<u4")
            stop = np.array([end], kind).tobytes()
        part, seq, place, ids, starts, held, n = None, 0, 0, [], [], [], 0

        def out():
            codes = encode_ids(np.frombuffer(b"".join(held), kind))
            cols = [([part], pa.int32()), ([seq], pa.int32()), ([place], pa.int64()), ([n], pa.int64()), ([ids], pa.list_(pa.int64())), ([starts], pa.list_(pa.int64())), ([codes], pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in cols], names=["part", "seq", "place", "n", "doc_ids", "starts", "codes"])

        narrow = encoder(path).kind
        for b in slices(batches, 64):
            for d, c, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if p != part:
                    if ids:
                        yield out()
                    part, seq, place, ids, starts, held, n = p, 0, 0, [], [], [], 0
                ids.append(d)
                starts.append(n)
                held += (c if kind == narrow else np.frombuffer(c, narrow).astype(kind).tobytes(), stop)
                n += len(c) // narrow.itemsize + (end is not None)
                if n >= segment:
                    yield out()
                    seq, place, ids, starts, held, n = seq + 1, place + n, [], [], [], 0
        if ids:
            yield out()

    return materialize(ranged.select("doc_id", "ids", "part").mapInArrow(lean(run), _SEGMENTS), "segments")


def read_tokens(segments: DataFrame) -> DataFrame:
    """From the written segments: ``doc_id, start, n_tokens, ids_crc32``, ``start`` counting all ids before the document."""
    # a segment knows its place in its part; parts are few whatever the data (at most MAX_PARTITIONS)
    sums = segments.groupBy("part").agg(F.sum("n").alias("n"))
    base = sums.withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "base")
    rows = segments.join(F.broadcast(base), "part").select((F.col("base") + F.col("place")).alias("place"), "n", "doc_ids", "starts", "codes")

    def run(batches):
        for b in slices(batches, 1):
            r = b.to_pylist()[0]
            codes, starts = Codes(r["codes"]), r["starts"]
            ends = [*starts[1:], r["n"]]
            data = memoryview(codes.range(0, len(codes)).astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * a : 4 * z]) for a, z in zip(starts, ends, strict=True)]
            cols = [(r["doc_ids"], pa.int64()), ([r["place"] + a for a in starts], pa.int64()), ([z - a for a, z in zip(starts, ends, strict=True)], pa.int64()), (crc, pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in cols], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(lean(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_token_codes(spark, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))
