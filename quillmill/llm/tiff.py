"""Media columns: baseline TIFF pages, written and read without an imaging library.

``read_pages(data)`` walks the chain of image directories and yields one page each: strips or tiles,
uncompressed, PackBits, LZW or Deflate, with horizontal differencing undone. ``decode(df)`` does so for a
binary column, one row per page. ``write_tiff`` makes the files (8-bit grey, strips or tiles, any of those
codecs). Space for a page is taken only once as many bytes have been decoded, whatever sizes the file declares, so
memory is bounded by the pages of a small batch of files.

The query deals texts to forms by a checksum of their payload, equal texts to equal forms: strips or tiles, with or without
differencing; payloads of up to ``SMALL`` bytes also to PackBits, LZW or plain samples, all others to Deflate.

Defined results: a malformed file gives one row with page null and ``error`` set, whichever page is at fault; null media give
no row; null and empty texts are a payload of 64 zeros; texts of any length are stored whole, over pages of ``PAGE`` rows;
repeated rows get equal results, row by row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import documents, lean, slices

# Fixed values of the TIFF 6.0 format: tags, field sizes, compression codes.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS = 284, 317, 322, 323, 324, 325
FIELD = {1: ("B", 1), 2: ("B", 1), 3: ("H", 2), 4: ("I", 4)}
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946

#: Bytes in a row of pixels, rows in a strip, rows in a page, as the query below stores payloads.
ROW, STRIP, PAGE = 64, 1024, 16384
#: Payloads up to this size are dealt to all codecs; LZW and PackBits are plain Python.
SMALL = 4096


def packbits_decode(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        k = data[i]
        i += 1
        if k < 128:
            out += data[i : i + k + 1]
            i += k + 1
        elif k > 128:
            out += data[i : i + 1] * (257 - k)
            i += 1
    return bytes(out)


def packbits_encode(data: bytes) -> bytes:
    """Runs of 2 or more equal bytes as repeats, the rest as literals of up to 128 bytes."""
    if not data:
        return b""
    a = np.frombuffer(data, np.uint8)
    starts = np.r_[0, np.flatnonzero(a[1:] != a[:-1]) + 1]
    sizes = np.diff(np.r_[starts, len(a)])
    out, lit = bytearray(), bytearray()

    def flush() -> None:
        for j in range(0, len(lit), 128):
            part = lit[j : j + 128]
            out.append(len(part) - 1)
            out.extend(part)
        lit.clear()

    for s, n in zip(starts.tolist(), sizes.tolist(), strict=True):
        v = data[s]
        if n == 1:
            lit.append(v)
            continue
        flush()
        while n > 0:
            m = min(n, 128)
            out += bytes((257 - m, v)) if m > 1 else bytes((0, v))
            n -= m
    flush()
    return bytes(out)


def lzw_decode(data: bytes) -> bytes:
    """MSB-first codes of 9 to 12 bits; 256 clears, 257 ends; widths grow one code early, as the format has it."""
    table: list[bytes] = []
    out, bits, have, width, last = bytearray(), 0, 0, 9, b""
    for byte in data:
        bits = bits << 8 | byte
        have += 8
        if have < width:
            continue
        have -= width
        code = bits >> have
        bits &= (1 << have) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes((i,)) for i in range(256)] + [b"", b""], 9, b""
            continue
        if code < len(table):
            word = table[code]
        elif last and code == len(table):
            word = last + last[:1]
        else:
            raise ValueError("bad LZW code")
        out += word
        if last:
            table.append(last + word[:1])
        last = word
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    out, bits, have = bytearray(), 0, 0
    table: dict[bytes, int] = {}
    width, nxt = 9, 258

    def put(code: int) -> None:
        nonlocal bits, have
        bits, have = bits << width | code, have + width
        while have >= 8:
            have -= 8
            out.append(bits >> have & 255)
        bits &= (1 << have) - 1

    def clear() -> None:
        nonlocal width, nxt
        put(256)
        table.clear()
        table.update((bytes((i,)), i) for i in range(256))
        width, nxt = 9, 258

    clear()
    word = b""
    for i in range(len(data)):
        longer = word + data[i : i + 1]
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer] = nxt
        nxt += 1
        if nxt == 4094:
            clear()
        else:
            width = 9 if nxt < 512 else 10 if nxt < 1024 else 11 if nxt < 2048 else 12
        word = data[i : i + 1]
    if word:
        put(table[word])
        nxt += 1
        width = 9 if nxt < 512 else 10 if nxt < 1024 else 11 if nxt < 2048 else 12
    put(257)
    if have:
        out.append(bits << (8 - have) & 255)
    return bytes(out)


_PACK = {NONE: bytes, LZW: lzw_encode, DEFLATE: lambda b: zlib.compress(b, 1), PACKBITS: packbits_encode}
_UNPACK = {NONE: bytes, LZW: lzw_decode, DEFLATE: zlib.decompress, OLD_DEFLATE: zlib.decompress, PACKBITS: packbits_decode}


def write_tiff(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, rows: int = STRIP, tile: tuple[int, int] | None = None) -> bytes:
    """Little-endian file of 8-bit pages (height x width, or height x width x samples), in strips or ``tile`` (width, length) tiles."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for page in pages:
        a = page if page.ndim == 3 else page[:, :, None]
        height, width, samples = a.shape
        if tile:
            tw, tl = tile
            full = np.zeros((-(-height // tl) * tl, -(-width // tw) * tw, samples), np.uint8)
            full[:height, :width] = a
            parts = [full[y : y + tl, x : x + tw] for y in range(0, height, tl) for x in range(0, width, tw)]
        else:
            parts = [a[y : y + rows] for y in range(0, height, rows)]
        places, counts = [], []
        for p in parts:
            if predictor == 2:
                p = np.concatenate([p[:, :1], p[:, 1:] - p[:, :-1]], axis=1)
            data = _PACK[compression](p.tobytes())
            places.append(len(out))
            counts.append(len(data))
            out += data + b"\0" * (len(data) & 1)
        fields = {WIDTH: [width], LENGTH: [height], BITS: [8] * samples, COMPRESSION: [compression], PHOTOMETRIC: [1 if samples < 3 else 2], SAMPLES: [samples], PLANAR: [1], PREDICTOR: [predictor]}
        fields |= {TILE_WIDTH: [tile[0]], TILE_LENGTH: [tile[1]], TILE_OFFSETS: places, TILE_COUNTS: counts} if tile else {ROWS_PER_STRIP: [rows], STRIP_OFFSETS: places, STRIP_COUNTS: counts}
        long = {STRIP_OFFSETS, STRIP_COUNTS, TILE_OFFSETS, TILE_COUNTS, WIDTH, LENGTH, ROWS_PER_STRIP}
        entries = bytearray()
        for tag, v in sorted(fields.items()):
            kind, code = (4, "I") if tag in long else (3, "H")
            raw = struct.pack(f"<{len(v)}{code}", *v)
            if len(raw) > 4:
                raw, at = struct.pack("<I", len(out)), raw
                out += at
            entries += struct.pack("<HHI", tag, kind, len(v)) + raw.ljust(4, b"\0")
        if len(out) & 1:
            out.append(0)
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(fields)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def _directory(data: bytes, at: int, e: str) -> tuple[dict[int, tuple[int, ...]], int]:
    (n,) = struct.unpack_from(f"{e}H", data, at)
    tags = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(f"{e}HHI", data, at + 2 + 12 * i)
        if kind in FIELD:
            code, width = FIELD[kind]
            place = at + 10 + 12 * i
            if count * width > 4:
                (place,) = struct.unpack_from(f"{e}I", data, place)
            tags[tag] = struct.unpack_from(f"{e}{count}{code}", data, place)
    return tags, struct.unpack_from(f"{e}I", data, at + 2 + 12 * n)[0]


def _page(data: bytes, t: dict[int, tuple[int, ...]]) -> np.ndarray:
    width, height, samples = t[WIDTH][0], t[LENGTH][0], t.get(SAMPLES, (1,))[0]
    if set(t.get(BITS, (1,))) != {8} or t.get(PLANAR, (1,))[0] != 1:
        raise ValueError("only interleaved 8-bit samples are read")
    codec, predictor, tiled = t.get(COMPRESSION, (1,))[0], t.get(PREDICTOR, (1,))[0], TILE_OFFSETS in t
    if codec not in _UNPACK or predictor not in (1, 2):
        raise ValueError("unknown compression or predictor")
    w, h = (t[TILE_WIDTH][0], t[TILE_LENGTH][0]) if tiled else (width, min(t.get(ROWS_PER_STRIP, (height,))[0], height))
    if 0 in (width, height, samples, w, h):
        raise ValueError("a size of 0")
    across = -(-width // w)
    places, counts = t[TILE_OFFSETS if tiled else STRIP_OFFSETS], t[TILE_COUNTS if tiled else STRIP_COUNTS]
    if not len(places) == len(counts) == across * -(-height // h):
        raise ValueError("another number of parts than the sizes ask for")
    parts = []
    for k, (at, n) in enumerate(zip(places, counts, strict=True)):
        rows = h if tiled else min(h, height - k * h)
        raw = _UNPACK[codec](data[at : at + n])
        if len(raw) < rows * w * samples:
            raise ValueError("a part is short")
        parts.append(np.frombuffer(raw, np.uint8, rows * w * samples).reshape(rows, w, samples))
    out = np.empty((height, width, samples), np.uint8)
    for k, part in enumerate(parts):
        y, x = k // across * h, k % across * w
        if predictor == 2:
            part = np.cumsum(part, axis=1, dtype=np.uint8)
        out[y : y + h, x : x + w] = part[: height - y, : width - x]
    return out


def read_pages(data: bytes) -> Iterator[tuple[dict[int, tuple[int, ...]], np.ndarray]]:
    """Tags and samples of each page, along the chain of directories; a chain that loops is an error."""
    e = {b"II": "<", b"MM": ">"}.get(data[:2])
    if e is None or struct.unpack_from(f"{e}H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    (at,) = struct.unpack_from(f"{e}I", data, 4)
    seen = set()
    while at:
        if at in seen:
            raise ValueError("directories form a loop")
        seen.add(at)
        tags, at = _directory(data, at, e)
        yield tags, _page(data, tags)


PAGE_SCHEMA = "page int, width int, height int, samples int, compression int, pixels binary, error string"
_PAGE_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string()]


def decode(df: DataFrame, media: str, *keep: str) -> DataFrame:
    """One row per page of the files in column ``media``, beside the columns ``keep``."""
    src = df.select(*keep, media).where(F.col(media).isNotNull())
    n, names = len(keep), [*keep, *(f.split()[0] for f in PAGE_SCHEMA.split(", "))]

    def run(batches):
        for b in slices(batches, 16):
            at, rows = [], []
            for i, data in enumerate(b.column(n).to_pylist()):
                try:
                    own = [(k, a.shape[1], a.shape[0], a.shape[2], tags.get(COMPRESSION, (1,))[0], a.tobytes(), None) for k, (tags, a) in enumerate(read_pages(data))]
                except (ValueError, KeyError, IndexError, struct.error, zlib.error) as err:
                    own = [(None, None, None, None, None, None, f"{type(err).__name__}: {err}")]
                rows += own
                at += [i] * len(own)
            left = [b.column(i).take(pa.array(at, pa.int32())) for i in range(n)]
            yield pa.RecordBatch.from_arrays([*left, *(pa.array([r[i] for r in rows], t) for i, t in enumerate(_PAGE_TYPES))], names=names)

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]), PAGE_SCHEMA])
    return src.mapInArrow(lean(run), ddl)


def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + b"\0" * (max(1, -(-len(raw) // 64)) * 64 - len(raw))


def form_of(payload: bytes) -> dict:
    """How a payload is stored: :func:`write_tiff`'s compression, predictor and tile."""
    lot = zlib.crc32(payload)
    small = len(payload) <= SMALL
    return {
        "compression": {0: LZW, 1: PACKBITS, 2: NONE}.get(lot % 8, DEFLATE) if small else DEFLATE,
        "predictor": 1 + (lot >> 3 & 1), "tile": (((32, 16) if small else (32, 1024)) if lot >> 4 & 1 else None),
    }


def encode_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, media``: each text's padded bytes as a grey image 64 pixels wide, pages of ``PAGE`` rows."""

    def run(batches):
        for b in slices(batches, 64):
            sizes, files = [], []
            for t in b.column(1).to_pylist():
                n, data = payload_of(t)
                a = np.frombuffer(data, np.uint8).reshape(-1, ROW)
                sizes.append(n)
                files.append(write_tiff([a[y : y + PAGE] for y in range(0, len(a), PAGE)], **form_of(data)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


def op8_tiff(spark, sf_dir: str) -> DataFrame:
    """Digests of each document's stored file and of the pages read back from it (a file's pages follow one another)."""
    media = encode_texts(documents(spark, sf_dir))
    media = media.select("doc_id", "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "media")
    pages = decode(media, "media", "doc_id", "n_bytes", "media_bytes", "media_sha256")

    def digest(batches):
        open_, rows = None, []

        def close():
            key, sha, tail, size, hist, n = open_
            mean = float(hist @ np.arange(256)) / size
            p = hist[hist > 0] / size
            rows.append((*key[:2], size, sha.hexdigest(), zlib.crc32(tail), *key[2:], f"pages={n};mean={mean:.4f};entropy={float(-(p * np.log2(p)).sum()):.4f};zeros={int(hist[0])}"))

        def flush():
            cols = list(zip(*rows, strict=True)) if rows else [()] * 8
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)
            rows.clear()
            return out

        for b in batches:
            for r in b.to_pylist():
                if r["error"]:
                    raise ValueError(r["error"])
                if r["page"] == 0:
                    if open_:
                        close()
                    open_ = [(r["doc_id"], r["n_bytes"], r["media_bytes"], r["media_sha256"]), hashlib.sha256(), b"", 0, np.zeros(256, np.int64), 0]
                px = r["pixels"]
                open_[1].update(px)
                open_[2] = (open_[2] + px)[-64:] if len(px) < 64 else px[-64:]
                open_[3] += len(px)
                open_[4] += np.bincount(np.frombuffer(px, np.uint8), minlength=256)
                open_[5] += 1
            yield flush()
        if open_:
            close()
        yield flush()

    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    return pages.mapInArrow(lean(digest), "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
