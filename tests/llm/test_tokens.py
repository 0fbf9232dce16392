import hashlib
import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from quillmill.llm import bpe, token_codes

TEXTS = ["", None, "it's <|endoftext|> A<|EndOfText|>é ΣΑΣ ² ½x İi foo\x1cbar don't 'S", "a'b'll  l'l 12ab3\n\n x\t y", " \n", "x" * 5000, "日本語 テキスト　全角", "plain words, and plain words."]
WORDS, BYTES = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")

#: Composed with their marks only in lower case; the last with another mark between.
TEXTS += [f"{c} some {c}Text {c.lower()}" for c in ("H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a", "J\u0323\u030c")]


@pytest.mark.parametrize("chunk", [8, 16])
def test_codes_round_trip(chunk):
    rng = np.random.default_rng(1)
    for ids in (np.array([], np.uint32), rng.integers(0, 50_000, 3000), rng.integers(0, 2**32, 700), np.arange(300)):
        ids = ids.astype(np.uint32)
        c = token_codes.Codes(token_codes.encode_ids(ids, chunk))
        assert len(c) == len(ids)
        assert (c.range(0, len(ids)) == ids).all()
        for i in range(0, len(ids), 17):
            assert c[i] == ids[i]
            assert (c.range(i, min(len(ids), i + 40)) == ids[i : i + 40]).all()
    with pytest.raises(IndexError):
        c[len(ids)]


def _same(e, texts):
    got = e(pa.array(texts, pa.string())).to_pylist()
    for t, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, e.kind).tolist() == e.tok.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_encoder_matches_the_library(monkeypatch):
    e = token_codes.Encoder(WORDS)
    _same(e, TEXTS)
    _same(e, [])
    _same(e, ["İ.", "(İ)", "İ-", "aİ'b", "xİİ1"])
    monkeypatch.setattr(token_codes, "MAX_PARTS", 3)
    monkeypatch.setattr(token_codes, "MAX_RUNS", 3)
    _same(e, TEXTS)


def test_encoder_matches_the_library_over_all_scripts():
    e, rng = token_codes.Encoder(WORDS), random.Random(3)
    known = [chr(c) for c in range(1, 0x11000) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    low = [c for c in known if c < "\u0530"]
    marks = [c for c in known if unicodedata.category(c)[0] == "M"]
    texts = []
    for _ in range(3000):
        pool = rng.choice([low, low, known, marks + low[:200], list("ab1. '-AJİ\u0307\u030c")])
        texts.append("".join(rng.choice(pool) for _ in range(rng.randint(1, 12))))
    _same(e, texts)


def test_written_tokens(spark):
    d = spark.createDataFrame([*((3 * i, t, "x") for i, t in enumerate(TEXTS)), (6, "repeated id", "x"), (None, "no id", "y")], "doc_id long, text string, part string")
    got = token_codes.read_tokens(token_codes.write_tokens(d, WORDS, segment=7)).orderBy("start").collect()
    e, at = token_codes.Encoder(WORDS), 0
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda x: (x is not None, x))
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 6}
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    for i, t in enumerate(TEXTS):
        if i != 2:
            ids = np.array([*e.tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
            assert (by[3 * i]["n_tokens"], by[3 * i]["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_codes.read_tokens(token_codes.write_tokens(empty, WORDS)).collect() == []


def test_bpe_matches_tiktoken(spark):
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(BYTES), special_tokens={})
    d = spark.createDataFrame([*enumerate(TEXTS), (1, "twice"), (1, "twice"), (None, "no id")], "doc_id long, text string")
    got = bpe.encode_decode(d, BYTES, outputs=True).collect()
    assert len(got) == len(TEXTS) + 3
    want = sorted((hashlib.sha256((t or "").encode()).hexdigest(), enc.encode_ordinary(t or "")) for t in [*TEXTS, "twice", "twice", "no id"])
    assert sorted((r["decoded_sha256"], list(r["ids"])) for r in got) == want
    assert bpe.encode_decode(spark.createDataFrame([], "doc_id long, text string"), BYTES).collect() == []


def test_long_words_as_short_ones():
    ranks = bpe.load_ranks(BYTES)
    rng = np.random.default_rng(2)
    for _ in range(200):
        w = bytes(rng.choice(list(b"aetion lrs"), 40))
        assert bpe.bpe(w, ranks) == bpe._bpe_long(w, ranks)


def test_encoder_holds_each_string_once(monkeypatch):
    e, rng = token_codes.Encoder(WORDS), random.Random(9)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(500)]
    _same(e, [" ".join(f"{w}," for w in words), " ".join(words), " ".join(f"({w}) {w}2{w}" for w in words)])
    assert set(words) <= e.parts.keys()
    assert not e.parts.keys() & e.runs.keys()
    monkeypatch.setattr(token_codes, "MAX_PARTS", 100)
    monkeypatch.setattr(token_codes, "MAX_RUNS", 50)
    for i in range(0, 500, 50):
        _same(e, [" ".join([*words[i : i + 50], *(f"{w}-{w}é" for w in words[:50])])])
