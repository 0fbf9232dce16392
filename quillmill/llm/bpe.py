"""Byte-level BPE, encoding and decoding, through a global shuffle of distinct words.

1. Each text is split by the pre-token pattern; a block of documents keeps the places of its pre-tokens as
   indices into its own list of distinct words. Blocks and their questions leave in one shuffle.
2. The distinct words go, packed by hash bucket, to the task that owns the bucket; there each distinct word of
   the corpus is encoded once (merges by rank, own implementation) and its ids go back to every block that asked.
3. Blocks put the ids in place. Decoding joins each id with its token's bytes (the vocabulary: 50,256 rows of
   fixed size, read by every task from the path given).

Null texts are empty; an empty text has no ids; a text longer than a block is a block alone, encoded whole; repeated
rows each give a row; an empty table gives no rows; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from quillmill.llm.common import documents, pack_strings, text_bytes, unpack_strings
from quillmill.llm.exchange import answer, ask_once, buckets_for, doc_frame, expand, resolve, squeeze

#: Bytes of input text for each bucket of distinct words.
PER_BUCKET = 32 << 20
#: Characters of a block; each asks once for each of its distinct words.
BLOCK_BYTES = 4 << 20
# Unicode's White_Space characters.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: A pre-token never runs from other characters into white space, so texts can be cut before each white run.
_PIECE = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def bpe(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the adjacent pair of lowest rank, leftmost first, until none is left. Long words use a heap."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 64:
        return _bpe_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _bpe_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    import heapq

    n = len(word)
    end, nxt, prev, live = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = nxt[i]
        if j < n and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, e = heapq.heappop(heap)
        j = nxt[i]
        if not live[i] or j >= n or end[j] != e or not live[j]:
            continue
        live[j], end[i], nxt[i] = False, e, nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    return [ranks[word[i : end[i]]] for i in range(n) if live[i]]


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN):
    """Blocks with their pre-tokens' places, and the answers: for each block and bucket its words' ids."""
    n = buckets_for(text_bytes(docs), PER_BUCKET)

    def make():
        import regex

        rx = regex.compile(pattern)

        def block(ids, texts):
            index: dict[bytes, int] = {}
            pieces: dict[str, bytes] = {}

            def places(piece: str) -> bytes:
                return np.array([index.setdefault(w.encode(), len(index)) for w in rx.findall(piece)], "<u4").tobytes()

            flat, counts = [], []
            for t in texts:
                size = 0
                for p in _PIECE.findall(t):
                    got = pieces.get(p)
                    if got is None:
                        got = pieces[p] = places(p)
                    flat.append(got)
                    size += len(got)
                counts.append(size >> 2)
            # a block's words by frequency, so that most places are small numbers
            place = np.frombuffer(b"".join(flat), "<u4")
            often = np.argsort(-np.bincount(place, minlength=len(index)), kind="stable")
            words = [*index]
            words = [words[i] for i in often.tolist()]
            rank = np.empty(len(words), "<u4")
            rank[often] = np.arange(len(words), dtype="<u4")
            bucket = np.array([zlib.crc32(w) for w in words], np.int64) % n
            order = np.argsort(bucket, kind="stable")
            wide = np.ascontiguousarray(rank[place]).view(np.uint8).reshape(-1, 4).T.tobytes()  # planes of equal bytes squeeze well
            held = [i is None for i in ids]
            head = [np.array([i or 0 for i in ids], "<i8").tobytes(), np.array(held, np.uint8).tobytes(), np.array(counts, "<u4").tobytes(), wide, bucket.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()]
            cut = np.flatnonzero(np.r_[True, bucket[order][1:] != bucket[order][:-1]]) if words else np.empty(0, int)
            asks = []
            for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(words)], strict=True) if len(cut) else ():
                own = [words[i] for i in order[a:z].tolist()]
                asks.append((int(bucket[order[a]]), squeeze(pack_strings(own))))
            return squeeze(pack_strings(head)), asks

        return block

    blocks, questions = ask_once(doc_frame(docs), make, BLOCK_BYTES)

    def reply():
        ranks = load_ranks(path)

        def bucket(rows):
            known: dict[bytes, bytes] = {}
            out = []
            for _, data in rows:
                got = []
                for w in unpack_strings(expand(data)):
                    if (v := known.get(w)) is None:
                        v = known[w] = np.array(bpe(w, ranks), "<u4").tobytes()
                    got.append(v)
                out.append(squeeze(pack_strings(got)))
            return out

        return bucket

    return blocks, answer(questions, reply)


def _unpack(payload: bytes, found: dict[int, bytes]):
    """Of a block: ids of documents, and each document's token ids."""
    head = unpack_strings(expand(payload))
    ids, null, counts = np.frombuffer(head[0], "<i8"), np.frombuffer(head[1], np.uint8), np.frombuffer(head[2], "<u4")
    place, bucket = (np.frombuffer(h, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel() for h in head[3:])
    words = [b""] * len(bucket)
    at = {b: unpack_strings(expand(v)) for b, v in found.items()}
    for i, w in zip(np.argsort(bucket, kind="stable").tolist(), (w for b in sorted(at) for w in at[b]), strict=True):
        words[i] = w
    at = 0
    for i, x, c in zip(ids.tolist(), null.tolist(), counts.tolist(), strict=True):
        yield (None if x else i), np.frombuffer(b"".join([words[k] for k in place[at : at + c].tolist()]), "<u4")
        at += c


class Decoder:
    """Ids to bytes by the table of token bytes, without a loop over tokens."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        table = [b""] * (max(ranks.values()) + 1)
        for b, r in ranks.items():
            table[r] = b
        self.size = np.array([len(b) for b in table], np.int64)
        self.start = np.r_[0, np.cumsum(self.size)[:-1]]
        self.bytes = np.frombuffer(b"".join(table), np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        n = self.size[ids]
        first = np.cumsum(n) - n
        return self.bytes[np.repeat(self.start[ids] - first, n) + np.arange(int(n.sum()))].tobytes()


_DECODERS: dict[str, Decoder] = {}


def _decoder(path: str) -> Decoder:
    if path not in _DECODERS:
        _DECODERS.clear()
        _DECODERS[path] = Decoder(load_ranks(path))
    return _DECODERS[path]


def encode_decode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, outputs: bool = False) -> DataFrame:
    """Per document ``doc_id, n_tokens, ids_sha256, decoded_sha256``; with ``outputs`` also ``ids`` and ``decoded``."""
    blocks, answers = encode(docs, path, pattern)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * outputs

    def finish(_, payload, found):
        dec, rows = _decoder(path), []
        for i, ids in _unpack(payload, found):
            text = dec(ids)
            rows.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text).hexdigest(), *((ids, text) if outputs else ())))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.binary()]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: 4 + 2 * outputs]
        return pa.table({n: pa.array([r[k] for r in rows], kinds[k]) for k, n in enumerate(names)})

    return resolve(blocks, answers, finish, schema)


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_decode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
