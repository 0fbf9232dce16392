"""Operators against plain restatements of their methods, written without arrays, caches or tables."""

import hashlib
import itertools
import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillmill.llm import language, mixing, secrets, tiff, toxicity

DOC = "doc_id long, text string"


def words(rng, n):
    return " ".join(rng.choice(["ab", "cde", "f", "ghij", "klm", "no", "pq"]) + rng.choice("xyz") for _ in range(n))


# toxicity


def plain_ratio(toxic, ordinary, word, top=6, low=2):
    """log P(word | toxic) - log P(word | ordinary), counts and backoffs looked up one by one."""
    spell = lambda w: "^" * (top - 1) + w + "$"
    own = {top: [Counter(), Counter()]}
    for c, texts in zip(own[top], (toxic, ordinary), strict=True):
        for w, n in texts.items():
            s = spell(w)
            for i in range(top - 1, len(s)):
                c[s[i - top + 1 : i + 1]] += n
    for n in range(top - 1, low, -1):
        own[n] = [Counter(g[1:] for g in c) for c in own[n + 1]]
    shared = {low: Counter(g[1:] for g in set(own[low + 1][0]) | set(own[low + 1][1]))}
    for n in range(low - 1, 0, -1):
        shared[n] = Counter(g[1:] for g in shared[n + 1])

    def discount(values):
        one, two = sum(v == 1 for v in values), sum(v == 2 for v in values)
        return min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.5

    d = {n: discount(c.values()) for n, c in shared.items()} | {n: discount([*a.values(), *b.values()]) for n, (a, b) in own.items()}

    def p(k, g):
        n = len(g)
        if not n:
            return 1 / max(64, len(shared[1]) + 1)
        c = shared[n] if n <= low else own[n][k]
        same = [v for x, v in c.items() if x[:-1] == g[:-1]]
        if not same:
            return p(k, g[1:])
        return (max(c[g] - d[n], 0) + d[n] * len(same) * p(k, g[1:])) / sum(same)

    s = spell(word)
    return sum(math.log(p(0, s[i - top + 1 : i + 1])) - math.log(p(1, s[i - top + 1 : i + 1])) for i in range(top - 1, len(s)))


def test_toxicity_as_a_plain_model():
    rng = random.Random(1)
    toxic, ordinary = Counter(words(rng, 60).split() + ["grumpf", "grumpfs", "hail"]), Counter(words(rng, 90).split() + ["hail", "hall", "grim"])
    m = toxicity.Models(toxic, ordinary)
    asked = ["grumpf", "grumpfy", "hail", "abx", "zzz", "grim", "cdexy", "q"]
    for w, r in zip(asked, m.ratios(asked).tolist(), strict=True):
        assert r == pytest.approx(plain_ratio(toxic, ordinary, w), abs=1e-5), w


def test_toxicity_tables(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, 40) + (" grumpf " if i % 4 == 0 else " ") + words(rng, 20), "a") for i in range(160)]
    d = spark.createDataFrame([*rows, (None, "grumpf", "b"), (3, None, "c")], f"{DOC}, __text string").withColumn("__score", F.lit(1)).withColumn("__toxic", F.lit("x"))
    labels = spark.createDataFrame([(i, 1 if i % 4 == 0 else 0) for i in range(160)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.fit(d, labels)
    left = toxicity.drop_toxic(d, model)
    assert left.columns == d.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted([i for i in range(160) if i % 4] + [3], key=str)
    none = d.where("doc_id = -1")
    assert toxicity.drop_toxic(none, model).collect() == []
    assert toxicity.score(none, toxicity.fit(none, labels)).collect() == []


# language


def plain_profile(text):
    low = text.lower()
    parts = "".join(c if c.isalpha() else " " for c in low).split()
    counts = Counter()
    for w in parts:
        s = f"_{w}_"
        counts.update(w)
        for n in (2, 3):
            counts.update(s[i : i + n] for i in range(len(s) - n + 1))
    return counts


def test_language_as_plain_out_of_place_distance(spark):
    rng = random.Random(3)
    vocab = {"xx": ["abra", "dab", "ra"], "yy": ["odo", "rod", "abo"], "zz": ["éte", "tré", "ra"]}
    rows = [(i, " ".join(rng.choices(vocab[k], k=rng.randrange(1, 30))), k) for i, k in enumerate(itertools.islice(itertools.cycle(vocab), 120))]
    rows += [(500, "½ ² Ⅷ", "xx"), (501, "abra½dab 7", None), (502, "", "yy"), (503, None, "yy"), (504, "ra " * 50_000, "zz")]
    d = spark.createDataFrame(rows, f"{DOC}, lang string").withColumn("__text", F.lit("clash")).withColumn("score", F.lit(9))
    model = language.learn(d)
    got = {r["doc_id"]: r for r in language.identify(d, model).collect()}
    profiles = {}
    for k in vocab:
        counts = sum((plain_profile(t) for i, t, lang in rows if t and lang == k and zlib.crc32(str(i).encode()) % 3 != 1), Counter())
        profiles[k] = [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: language.SIZE]]
    assert model.langs == sorted(vocab)
    known = {g for p in profiles.values() for g in p}
    for i, t, _ in rows:
        counts = plain_profile(t or "")
        if not counts:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        mine = [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0] not in known, x[0]))][: language.SIZE]
        far = {k: sum(abs(p.index(g) - r) if g in p else language.SIZE for r, g in enumerate(mine)) for k, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert got[i]["lang_pred"] == best, i
        assert got[i]["score"] == pytest.approx(1 - far[best] / (language.SIZE * len(mine)))
    assert got[500]["lang_pred"] == "und"


# secrets


def test_field_as_by_enumeration():
    rng = np.random.default_rng(4)
    samples = []
    for n in (1, 2, 3, 4):
        samples.append(([tuple(rng.integers(0, 6, 2).tolist()) for _ in range(n)], rng.integers(0, 3, n).tolist()))

    def likelihood(w, m):
        total = 0.0
        for feats, tags in samples:
            def score(path):
                return sum(w[list(f), t].sum() for f, t in zip(feats, path, strict=True)) + sum(m[a, b] for a, b in zip((0, *path), path, strict=False))  # noqa: B023
            every = [score(p) for p in itertools.product(range(3), repeat=len(feats))]
            total += score(tags) - math.log(sum(map(math.exp, every)))
        return total

    few, many = secrets.train(samples, steps=1, rate=1e-3, ridge=0, ridge_moves=0), secrets.train(samples, steps=60, ridge=0, ridge_moves=0)
    zero = likelihood(np.zeros((secrets.SIZE, 3)), np.zeros((3, 3)))
    assert zero < likelihood(few.weights, few.moves) < likelihood(many.weights, many.moves) < 0
    # the first step goes along the gradient's signs: hold them against differences
    w, m, eps = np.zeros((secrets.SIZE, 3)), np.zeros((3, 3)), 1e-5
    for i, j in itertools.product(range(3), range(3)):
        m[i, j] = eps
        slope = (likelihood(w, m) - zero) / eps
        m[i, j] = 0
        assert slope == pytest.approx(0, abs=1e-4) or math.copysign(1, slope) == math.copysign(1, few.moves[i, j])
    for i, j in itertools.product(range(6), range(3)):
        w[i, j] = eps
        slope = (likelihood(w, m) - zero) / eps
        w[i, j] = 0
        assert slope == pytest.approx(0, abs=1e-4) or math.copysign(1, slope) == math.copysign(1, few.weights[i, j])


def test_viterbi_and_its_cuts_as_by_enumeration(monkeypatch):
    rng = np.random.default_rng(5)
    for _ in range(200):
        f = secrets.Field(np.zeros((1, 3)), rng.normal(0, 1, (3, 3)))
        e = rng.normal(0, 2, (rng.integers(1, 6), 3))
        score = lambda p: sum(e[t, k] for t, k in enumerate(p)) + sum(f.moves[a, b] for a, b in zip((0, *p), p, strict=False))  # noqa: B023, E731
        best = max(itertools.product(range(3), repeat=len(e)), key=score)
        assert tuple(f.viterbi(e, secrets.OUT, None)) == best
        for t in range(len(e) - 1):  # a token that the slack rules out is outside on the best path
            if e[t, 0] - e[t, 1] > f.slack[0] and e[t, 0] - e[t, 2] > f.slack[1]:
                assert best[t] == secrets.OUT


def test_field_adds_forms_that_no_pattern_has(spark):
    rng = random.Random(6)
    alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    hidden = lambda k: "".join(rng.choices(alnum, k=k))
    known = [lambda: f"api_key={hidden(20)}", lambda: "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)), lambda: f"{rng.getrandbits(160):040x}"]
    texts = [words(rng, 40) + (f" {rng.choice(known)()} " if i % 3 == 0 else f" {rng.randrange(10**6)} a.b{i}@mail.example.com ") + words(rng, 40) for i in range(300)]
    d = spark.createDataFrame([*enumerate(texts), (None, None), (3, "")], DOC).withColumn("__text", F.lit("x"))
    field = secrets.fit(d)
    foreign = [words(rng, 30) + f" {p}{hidden(32)} " + words(rng, 30) for p in ("ghp_", "sk-", "") for _ in range(30)]
    plain = [words(rng, 50) + f" {rng.randrange(10**7)} x.y{i}@mail.example.com " + words(rng, 20) for i in range(100)]
    scan = secrets.Scanner(field)
    assert sum(any(s[2] == "crf" for s in g) for g in scan(pa.array(foreign))) >= 80
    assert sum(bool(g) for g in scan(pa.array(plain))) <= 2
    got = secrets.scan(d, field, "doc_id").collect()
    assert len(got) == 302
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] != 3:
            base = [(s["start"], s["end"], s["kind"]) for s in r["spans"] if s["kind"] != "crf"]
            assert base == secrets.base_spans(texts[r["doc_id"]])
    none = d.where("doc_id = -1")
    assert secrets.fit(none) is None
    assert secrets.redact(none, None).columns == d.columns


def test_secrets_query_as_plain_patterns(spark):
    import re

    texts = [None, "", 'a token="abcdefg" b', "x" * 100_000 + " PASSWORD = abcdef" + " y" * 50_000, "AKIA" + "A" * 16, "0" * 24 + " " + "f" * 23, "secret: k secret: kkkkkk"] * 2
    d = spark.createDataFrame(list(enumerate(texts)), DOC)
    d.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/secrets/documents.parquet")
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
    for r in secrets.op6_secrets(spark, path.rsplit("/", 1)[0]).collect():
        t = texts[r["doc_id"]] or ""
        spans = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 20]
        spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 24]
        told = ",".join(s for _, _, s in sorted(spans))
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == i for _, k, _ in spans) for i in range(3))


# mixing


def plain_mix(rows, block, weights=(5, 2, 1), volume=1.5, passes=2):
    """Words taken of each document, by walking the slots one by one over written-out streams of words."""
    plan = {r["source"]: r for r in rows["plan"]}
    taken = Counter()
    for source, docs in rows["streams"].items():
        p = plan[source]
        stream = [d for d, n in docs for _ in range(n)]
        blocks = [stream[i : i + block] for i in range(0, len(stream), block)]
        left = p["words"]
        for rank in range(p["quota"]):
            for d in blocks[rank % len(blocks)]:
                if left > 0:
                    taken[d] += 1
                    left -= 1
    return taken


def test_mix_as_a_plain_schedule(spark):
    rng = random.Random(7)
    rows = [(i, rng.randrange(0, 40), rng.choice(["b", "a", None, "c"])) for i in range(300)]
    sized = spark.createDataFrame(rows, "doc_id long, size long, source string")
    got = {r["doc_id"]: r for r in mixing.mix_sizes(sized, block=16).collect()}
    plan = mixing.source_plan(sized, block=16)
    starts = mixing._streams(sized, plan, "mix").where("size > 0").orderBy("src", "start").collect()
    by = {r["src"]: r for r in plan.collect()}
    streams = defaultdict(list)
    for r in starts:
        at = sum(n for _, n in streams[by[r["src"]]["source"]])
        assert r["start"] == at  # a document begins where the one before it ends
        streams[by[r["src"]]["source"]].append((r["doc_id"], r["size"]))
    want = plain_mix({"plan": by.values(), "streams": streams}, 16)
    assert {i: r["taken"] for i, r in got.items()} == {i: want[i] for i, _, _ in rows}
    # targets as the rule has them, worked out one share at a time
    size = Counter()
    for _, n, s in rows:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    target, open_, left = {}, order[:], 1.5 * sum(size.values())
    while open_:
        w = {s: (5, 2, 1)[order.index(s) % 3] for s in open_}
        full = [s for s in open_ if left * w[s] / sum(w.values()) > 2 * size[s]]
        for s in full or open_:
            target[s] = 2 * size[s] if full else left * w[s] / sum(w.values())
        left -= sum(target[s] for s in full)
        open_ = [s for s in open_ if s not in target] if full else []
    for i, n, s in rows:
        assert got[i]["target"] == pytest.approx(target[s])
        assert (got[i]["size"], got[i]["source_size"]) == (n, size[s])


def test_mixed_documents_hold_the_words_taken(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{k}" for k in range(rng.randrange(0, 30))), "abc"[i % 3], 1, "x") for i in range(90)]
    rows += [(5, "twice the same", "a", 1, "x"), (5, "twice the same", "a", 1, "x"), (None, None, None, 1, "x"), (7, "long " * 20_000, "c", 1, "x")]
    d = spark.createDataFrame(rows, f"{DOC}, source string, __key int, __taken string")
    got = mixing.mixed(d, block=64).collect()
    assert got[0].__fields__ == d.columns
    n_words = Counter()
    for r in got:
        n_words[r["source"]] += len((r["text"] or "").split())
    taken = Counter()
    for r in mixing.mix(d, block=64).join(d.select("doc_id", "source").distinct(), "doc_id").collect():
        taken[r["source"]] += r["taken"]
    plan = {r["source"]: r["words"] for r in mixing.source_plan(d.select("doc_id", "source", F.when(F.col("text") == "", 0).otherwise(F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0))).cast("long").alias("size")), block=64).collect()}
    assert {s: n_words[s] for s in plan} == plan
    assert all(r["text"] in {t for _, t, *_ in rows} or any((t or "").startswith(r["text"]) for _, t, *_ in rows) for r in got if r["text"])
    assert sum(1 for r in got if not (r["text"] or "")) == sum(1 for _, t, *_ in rows if not t)
    assert mixing.mixed(d.where("doc_id = -1")).collect() == []


# media


def test_packbits_and_big_endian_by_hand():
    # the sample of the format's own description
    packed = bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA")
    plain = bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22") + b"\xaa" * 10
    assert tiff.packbits_decode(packed) == plain
    tags = [(256, 3, 1, 12 << 16), (257, 3, 1, 2 << 16), (258, 3, 1, 8 << 16), (259, 3, 1, 32773 << 16), (262, 3, 1, 1 << 16), (273, 4, 1, 8), (277, 3, 1, 1 << 16), (278, 3, 1, 2 << 16), (279, 4, 1, len(packed))]
    at = 8 + len(packed) + 1
    data = b"MM\0*" + struct.pack(">I", at) + packed + b"\0" + struct.pack(">H", len(tags)) + b"".join(struct.pack(">HHII", *t) for t in tags) + b"\0\0\0\0"
    ((_, page),) = tiff.read_pages(data)
    assert page.tobytes() == plain


def test_lzw_by_hand():
    # clear, 7, 7 8?, end: codes of nine bits packed by hand
    codes = [256, 7, 258, 8, 8, 257]
    bits = "".join(f"{c:09b}" for c in codes)
    data = bytes(int(bits[i : i + 8].ljust(8, "0"), 2) for i in range(0, len(bits), 8))
    assert tiff.lzw_decode(data) == bytes([7, 7, 7, 8, 8])


def test_bad_files_give_one_row(spark):
    good = [np.arange(64, dtype=np.uint8).reshape(8, 8)] * 3
    one = tiff.write_tiff(good, tiff.DEFLATE, tile=(16, 16))

    def patched(data, page, tag, value):
        (at,) = struct.unpack_from("<I", data, 4)
        for _ in range(page):
            n = struct.unpack_from("<H", data, at)[0]
            (at,) = struct.unpack_from("<I", data, at + 2 + 12 * n)
        n = struct.unpack_from("<H", data, at)[0]
        out = bytearray(data)
        for i in range(n):
            if struct.unpack_from("<H", data, at + 2 + 12 * i)[0] == tag:
                struct.pack_into("<I", out, at + 10 + 12 * i, value)
        return bytes(out)

    files = [one, patched(one, 0, tiff.TILE_WIDTH, 0), patched(one, 0, tiff.WIDTH, 2**32 - 1), patched(one, 2, tiff.LENGTH, 0), patched(one, 2, tiff.COMPRESSION, 99), one[:60], b""]
    got = tiff.decode(spark.createDataFrame(list(enumerate(files)), "id int, media binary"), "media", "id").orderBy("id", "page").collect()
    assert [(r["id"], r["page"], r["error"] is None) for r in got] == [(0, 0, True), (0, 1, True), (0, 2, True), *((i, None, False) for i in range(1, 7))]


def test_tiff_query_as_plain_digests(spark):
    rng = random.Random(9)
    texts = [None, "", "same", "same", *(words(rng, rng.randrange(0, 400)) for _ in range(60)), "é" * 900_000]
    d = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], f"{DOC}, media_bytes int")
    d.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/tiff2/documents.parquet")
    codecs = set()
    for r in tiff.op8_tiff(spark, path.rsplit("/", 1)[0]).collect():
        raw = (texts[r["doc_id"]] or "").encode()
        data = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        how = tiff.form_of(data)
        codecs.add((how["compression"], how["predictor"], bool(how["tile"])))
        a = np.frombuffer(data, np.uint8).reshape(-1, 64)
        pages = [a[i : i + tiff.PAGE] for i in range(0, len(a), tiff.PAGE)]
        stored = tiff.write_tiff(pages, **how)
        counts = Counter(data)
        entropy = -sum(n / len(data) * math.log2(n / len(data)) for n in counts.values())
        feature = f"pages={len(pages)};mean={sum(data) / len(data):.4f};entropy={entropy:.4f};zeros={counts[0]}"
        want = (len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature.replace("entropy=-0.0", "entropy=0.0"))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_bytes"], r["media_sha256"], r["feature"].replace("entropy=-0.0", "entropy=0.0")) == want
    assert {c for c, _, _ in codecs} == {tiff.NONE, tiff.LZW, tiff.PACKBITS, tiff.DEFLATE}
    assert len({(p, t) for _, p, t in codecs}) == 4
