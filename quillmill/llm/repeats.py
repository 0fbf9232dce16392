"""Removal of long repeated strings by suffix arrays.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts anywhere else. A suffix array over all
text would sit in one place; here windows of ``LENGTH`` bytes that can be equal are first brought together:

1. Each window's anchor is the leftmost ``CORE``-byte string in it of least hash, so equal windows have equal
   anchors at equal offsets. Successive windows share anchors; a run of them is one region.
2. Anchors that occur once in the corpus rule their windows out. They are looked up in hash buckets, one packed
   question a block of documents (see ``exchange``), so a frequent anchor is asked for once a block.
3. The other regions go to the bucket of their anchor, without the anchor's own bytes; equal regions of a block
   once. Where an anchor has several different regions, of which one is unique, the bucket builds the suffix array of
   all of them, each anchor one symbol: windows are then ``LENGTH - CORE + 1`` symbols long, and one is repeated
   exactly if it shares them with a neighbour in the array. Regions that are all repeated whole need none.
4. Blocks mark the windows they are told of, and cut.

Hashes of anchors that collide are told apart by a second checksum of 32 bits. Texts are UTF-8 bytes; null is
empty; matches don't cross documents; texts shorter than ``LENGTH`` lose nothing; all rows of a text that
repeats lose the same; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import documents, materialize, pack_strings, text_bytes, unpack_strings
from quillmill.llm.exchange import answer, ask, buckets_for, doc_frame, expand, resolve, squeeze
from quillmill.llm.suffix_array import common_at_least, suffix_array

LENGTH, CORE = 200, 160
SPAN = LENGTH - CORE + 1  # anchors to choose from in a window, and its length in symbols
PER_BUCKET = 32 << 20
#: Symbols in one suffix array (a larger group of one anchor is still one array).
ARRAY = 100_000
_TABLE = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64)


def _join(a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    h = a * np.uint64(0x9E3779B97F4A7C15 + 2 * step) + b
    h ^= h >> np.uint64(29)
    return h


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Of every string of ``size`` bytes, by doubling."""
    h, n, step = _TABLE[data], 1, 0
    while 2 * n <= size:
        h = _join(h[:-n], h[n:], step)
        n, step = 2 * n, step + 1
    if rest := size - n:
        h = _join(h[: len(h) - rest], h[rest:], 63)
    return h


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = op(x[:-n], x[n:])
        n *= 2
    if rest := width - n:
        x = op(x[: len(x) - rest], x[rest:])
    return x


def _even(h: np.ndarray) -> np.ndarray:
    """One to one over 64 bits. Anchors are least hashes, so their upper bits, which say the bucket, are anything but even."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def runs(data: np.ndarray, length: int = LENGTH, core: int = CORE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, last window, place and hash of the anchor."""
    if len(data) < length:
        e = np.empty(0, np.int64)
        return e, e, e, np.empty(0, np.uint64)
    width = length - core + 1
    h = _hashes(data, core)
    least = _sliding(h, width, np.minimum)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    last = np.r_[first[1:] - 1, len(least) - 1]
    pad = np.zeros(width - 1, np.uint64)
    anchors = np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), width, np.maximum) == h)
    if len(anchors) == len(first):
        return first, last, anchors, _even(h[anchors])
    out = []  # an anchor that recurs close by (periodic text): the leftmost of each window counts
    for a, z in zip(first.tolist(), last.tolist(), strict=True):
        at = a
        for p in (a + np.flatnonzero(h[a : z + width] == least[a])).tolist():
            if at <= z and p >= at:
                out.append((at, min(z, p), p))
                at = p + 1
    f, e, p = (np.array(c, np.int64) for c in zip(*out, strict=True))
    return f, e, p, _even(h[p])


class Block:
    """A block's documents with their runs; the order of everything below follows from the texts alone."""

    def __init__(self, raw: list[bytes]) -> None:
        self.raw = raw
        got = [runs(np.frombuffer(r, np.uint8)) for r in raw]
        self.doc = np.repeat(np.arange(len(raw)), [len(g[0]) for g in got])
        self.first, self.last, self.place, self.hash = (np.concatenate([g[k] for g in got]) if got else np.empty(0, np.int64) for k in range(4))

    def questions(self, n: int):
        """Distinct anchors (upper bits: bucket, then 32 bits that travel), in order of hash: bucket and its slice."""
        self.distinct, self.of, self.count = np.unique(self.hash, return_inverse=True, return_counts=True)
        bucket = ((self.distinct >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, int)
        return [(int(bucket[a]), a, z) for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(bucket)], strict=True)] if len(cut) else []

    def regions(self, repeated: np.ndarray, n: int) -> dict[int, list[tuple[bytes, list[int]]]]:
        """By bucket, in order: each distinct region of a repeated anchor as bytes, and its runs."""
        seen: dict[bytes, list[int]] = {}
        keep = np.flatnonzero(repeated[self.of])
        for k, d, a, z, p, h in zip(keep.tolist(), self.doc[keep].tolist(), self.first[keep].tolist(), self.last[keep].tolist(), self.place[keep].tolist(), self.hash[keep].tolist(), strict=True):
            r = self.raw[d]
            key = h.to_bytes(8, "big") + zlib.crc32(r[p : p + CORE]).to_bytes(4, "big") + bytes((p - a,)) + r[a:p] + r[p + CORE : z + LENGTH]
            if key in seen:
                seen[key].append(k)
            else:
                seen[key] = [k]
        out: dict[int, list[tuple[bytes, list[int]]]] = defaultdict(list)
        for key in sorted(seen):
            out[int.from_bytes(key[:4], "big") * n >> 32].append((key, seen[key]))
        return out


def _load(payload: bytes) -> tuple[list[int | None], Block]:
    head, null, *raw = unpack_strings(expand(payload))
    ids = [None if x else i for i, x in zip(np.frombuffer(head, "<i8").tolist(), null, strict=True)]
    return ids, Block(raw)


def _known(block: Block, n: int, found: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(0, bool)
    parts = [np.unpackbits(np.frombuffer(found[b], np.uint8), count=z - a).astype(bool) for b, a, z in block.questions(n)]
    return (np.concatenate(parts) if parts else out) | (block.count > 1)


def _planes(x: np.ndarray) -> bytes:
    return squeeze(np.ascontiguousarray(x.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes())


def _unplanes(data: bytes) -> np.ndarray:
    return np.frombuffer(expand(data), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _anchor_bucket(rows: list[tuple[int, bytes]]) -> list[bytes]:
    """Which anchors of each block another block has too."""
    asked = [np.cumsum(_unplanes(p), dtype=np.uint64).astype(np.uint32) for _, p in rows]
    every = np.sort(np.concatenate(asked))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    out = []
    for a in asked:
        i = np.minimum(np.searchsorted(twice, a), max(0, len(twice) - 1))
        out.append(np.packbits(twice[i] == a if len(twice) else np.zeros(len(a), bool)).tobytes())
    return out


def _windows(key: bytes) -> int:
    """Number of windows of a region: it has LENGTH - CORE bytes beside the anchor for one, and one more for each other."""
    return len(key) - 13 - (LENGTH - CORE) + 1


def repeated_windows(regions: Counter[bytes]) -> dict[bytes, int]:
    """For each region (with how often it occurs): which of its windows occur elsewhere, as bits."""
    groups: dict[bytes, list[bytes]] = defaultdict(list)
    for key in regions:
        groups[key[:12]].append(key)
    out, todo, held = {}, [], 0

    def sort() -> None:
        nonlocal todo, held
        keys = [k for g in todo for k in g]
        text, starts, at = [], [], 0
        for g, members in enumerate(todo):
            core = len(keys) + 256 + g
            for key in members:
                left = key[12]
                body = np.frombuffer(key, np.uint8, -1, 13).astype(np.int64) + len(keys)
                text += [body[:left], np.array([core]), body[left:], np.array([len(starts)])]  # ends differ, so nothing is shared across
                starts.append(at)
                at += len(body) + 2
        t = np.concatenate(text)
        sa = suffix_array(t)
        same = common_at_least(t, sa, SPAN)
        rep = np.zeros(len(t), bool)
        rep[sa[1:][same]] = True
        rep[sa[:-1][same]] = True
        for key, s in zip(keys, starts, strict=True):
            if regions[key] < 2:
                bits = np.flatnonzero(rep[s : s + _windows(key)])
                out[key] = sum(1 << i for i in bits.tolist())
        todo, held = [], 0

    for members in groups.values():
        single = [k for k in members if regions[k] < 2]
        for k in members:
            if regions[k] >= 2:
                out[k] = (1 << _windows(k)) - 1
        if single and len(members) > 1:
            todo.append(members)
            held += sum(len(k) - 11 for k in members)
            if held >= ARRAY:
                sort()
        else:
            out.update((k, 0) for k in single)
    if todo:
        sort()
    return out


def _region_bucket(rows: list[tuple[int, bytes]]) -> list[bytes]:
    asked, every = [], Counter()
    for _, p in rows:
        often, *keys = unpack_strings(expand(p))
        asked.append(keys)
        for k, twice in zip(keys, often, strict=True):
            every[k] += 1 + twice
    bits = repeated_windows(every)
    return [squeeze(np.array([bits[k] for k in keys], "<u8").tobytes()) for keys in asked]


def remove_repeats(docs: DataFrame, outputs: bool = False) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``; with ``outputs`` also ``kept`` (binary)."""
    n = buckets_for(text_bytes(docs), PER_BUCKET)

    def make():
        def block(ids, texts):
            raw = [t.encode() for t in texts]
            b = Block(raw)
            asks = []
            for k, a, z in b.questions(n):
                # the 32 bits below those that say the bucket: ascending modulo 2^32, so that differences are small
                low = (b.distinct[a:z] >> np.uint64(33 - n.bit_length())).astype(np.uint32)
                asks.append((k, _planes(np.diff(low, prepend=np.uint32(0)))))
            head = [np.array([i or 0 for i in ids], "<i8").tobytes(), bytes(i is None for i in ids)]
            return squeeze(pack_strings(head + raw)), asks

        return block

    blocks, questions = ask(doc_frame(docs), make, "repeats")
    anchors = materialize(answer(questions, lambda: _anchor_bucket), "anchors")

    def regions(block, payload, found):
        _, b = _load(payload)
        out = []
        for k, own in b.regions(_known(b, n, found), n).items():
            often = bytes(min(1, len(at) - 1) for _, at in own)
            out.append((k, squeeze(pack_strings([often, *(key for key, _ in own)]))))
        return pa.table({"block": pa.array([block] * len(out), pa.int64()), "bucket": pa.array([k for k, _ in out], pa.int32()), "payload": pa.array([p for _, p in out], pa.binary())})

    asked = resolve(blocks, anchors, regions, "block long, bucket int, payload binary")
    told = answer(asked, lambda: _region_bucket)
    both = anchors.unionByName(told.withColumn("bucket", -1 - F.col("bucket")))

    def finish(_, payload, found):
        ids, b = _load(payload)
        known = _known(b, n, found)
        run, words = [], []
        for k, own in b.regions(known, n).items():
            for (_, at), word in zip(own, np.frombuffer(expand(found[-1 - k]), "<u8").tolist(), strict=True):
                if word:
                    run += at
                    words += [word] * len(at)
        # one line of bytes for the block: a window that is told of starts 1 there and ends LENGTH on, within its document
        base = np.r_[0, np.cumsum([len(r) for r in b.raw], dtype=np.int64)]
        run, words = np.array(run, np.int64), np.array(words, np.uint64)
        first, step = base[b.doc[run]] + b.first[run], np.zeros(base[-1] + 1, np.int32)
        for k in range(SPAN):
            at = first[(words >> np.uint64(k)) & np.uint64(1) > 0] + k
            np.add.at(step, at, 1)
            np.subtract.at(step, at + LENGTH, 1)
        all_gone = np.cumsum(step[:-1]) > 0
        rows = []
        for d, (i, raw) in enumerate(zip(ids, b.raw, strict=True)):
            gone = all_gone[base[d] : base[d + 1]]
            removed = int(gone.sum())
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if removed else 0
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if removed else raw
            rows.append((i, len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), *((kept,) if outputs else ())))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + outputs]
        return pa.table({c: pa.array([r[k] for r in rows], kinds[k]) for k, c in enumerate(names)})

    return resolve(blocks, both, finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * outputs)


def op5_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))
