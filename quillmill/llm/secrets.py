"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds spans to theirs.

Tokens are the parts of a text between white space, tagged secret-begin, secret-inside or outside. A token's
scores come from its shape (lengths, character classes, entropy, marks, key words), the shapes of its two
neighbours, and features of the file; transitions link tags. Decoding is Viterbi: where a token's outside score
leads by more than any neighbours' transitions can make up for, the best path passes through outside, so the chain is
cut there and only the stretches between are walked. Scores are worked out once for each distinct token met, and held in a
table bounded by ``MAX_KNOWN``; texts are scanned some ``SLICE_BYTES`` at a time, and a worker keeps nothing of a scan.

The field learns from the patterns' matches in a bounded sample: whole texts of the ``MAX_DOCS`` documents of lowest hash, as
many as fit in ``MAX_CHARS``. Windows about every match are positives; of tokens outside, per text ``ODD`` odd-looking ones and
one of any kind, by hash, and of all those at most ``PER_MATCH`` a match. Each positive is learnt three times: as it stands, with
the marks that the patterns look for (key words, the access prefix) hidden, and hidden with its characters drawn anew (seeded)
from other alphabets and lengths, so that the field knows secrets by shape and surroundings and finds forms that no pattern has. Scanning reads every row's whole text. A span of the field that
touches one of the patterns adds nothing; the patterns' own spans always stay.

Defined results: null texts are empty and have no spans; long texts are scanned whole; repeated rows get equal results; an
empty table, or a sample without a match, leaves the patterns alone; extra columns are ignored by the query and kept by
``redact``; a column to keep that is called ``spans`` is refused by ``scan``.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import random
import re
import string
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import documents, in_one_task, lean, sized

# The patterns by kind, in order, and the least length of their match (assign: of group 2).
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
_MAYBE = "password|passwd|secret|token|api_?key|akia|[0-9a-f]{24}"
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, so the same matches as HEX of that length

#: The bound of the sample that the field is trained on; of its windows about tokens outside secrets.
MAX_DOCS, MAX_CHARS, ODD, PER_MATCH = 6000, 20_000_000, 6, 4
SIZE = 1 << 14
#: The bounds of a scan: tokens whose scores are held, bytes of text (or one text) worked on at once.
MAX_KNOWN, SLICE_BYTES = 200_000, 2 << 20
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_KEY = re.compile(r"passw|secret|token|api_?key|credential|auth|bearer|private|key", re.IGNORECASE)
_PLAIN = re.compile(r"[^\W\d_]{1,30}[.,;:!?]?")
_ZEROS, _SAME = re.compile("0+"), re.compile(r"(.)\1+")
OUT, BEGIN, INSIDE = range(3)

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the patterns' matches, by start, then kind as listed."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), m.end(), "hex") for m in _LONG_HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _bucket(n: float, *cuts: float) -> int:
    return sum(n >= c for c in cuts)


class _Classes(dict):
    """For ``str.translate``: lower case a, upper case A, digits 0, all else ?."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        return "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "?"


_CLASSES = _Classes()
_CLASSES.update({code: _CLASSES[code] for code in range(0x530)})


def usual(token: str, key: bool) -> str:
    """Ordinary words, which are most tokens, stand for their class: length, capital, mark at the end."""
    if not key and _PLAIN.fullmatch(token):
        return f"\0{len(token) // 4}{token[0].isupper()}{token[-1] if not token[-1].isalpha() else ''}"
    return token


def shape(token: str) -> tuple[str, ...]:
    """What a token (as of :func:`usual`) looks like."""
    if token[0] == "\0":
        return "bias", "plain", f"plain{token[1:]}"
    core = token.strip("\"'`,;()[]{}<>")
    size, classes = len(core), core.translate(_CLASSES)
    turns = 2 * len(_ZEROS.findall(classes)) - (classes[:1] == "0") - (classes[-1:] == "0")
    short = _SAME.sub(r"\1", classes[:40])
    entropy = -sum(v / size * math.log2(v / size) for v in Counter(core).values()) if size else 0.0
    out = [
        "bias", f"size{_bucket(size, 1, 3, 6, 10, 16, 20, 24, 32, 48)}", f"digits{_bucket(classes.count('0') / max(1, size), 0.01, 0.2, 0.4, 0.7, 1)}",
        f"turns{_bucket(turns, 1, 3, 6, 10)}", f"entropy{_bucket(entropy, 1, 2, 3, 3.5, 4)}", f"short{short[:6]}", f"upper{classes.count('A') > 1}{'a' in classes}",
        f"long{size >= 16}{turns >= 3}", f"first{core[:4] if core[:4].isupper() and size >= 16 else ''}", f"hex{size >= 12 and all(c in '0123456789abcdef' for c in core)}",
    ]
    out += [f"has{c}" for c in "=:\"'" if c in token]
    if m := _KEY.search(token):
        out += ["key", f"key{m[0].lower()}", f"key={'=' in token or ':' in token}{size >= 14}"]
    if "=" in core[:-1]:
        value = core.split("=", 1)[1]
        out += [f"value{_bucket(len(value), 1, 6, 12)}{any(c.isdigit() for c in value)}"]
    return tuple(out)


@lru_cache(8192)
def _row(name: str) -> int:
    return zlib.crc32(name.encode()) % SIZE


def _places(token: str, hidden: bool = False) -> tuple[tuple[int, ...], tuple[int, ...], tuple[int, ...]]:
    """Weight rows of a token's features as itself, as the token before, as the token after; ``hidden``: without the patterns' marks."""
    s = shape(token)
    if hidden:
        s = tuple(f for f in s if not f.startswith(("key", "first")))
    few = [f for f in s if f.startswith(("plain", "size", "digits", "has", "key", "long", "short"))] + ["bias"]
    return tuple([_row(f"0{f}") for f in s]), tuple([_row(f"-{f}") for f in few]), tuple([_row(f"+{f}") for f in few])


def file_features(tokens: list[str] | int, n_keys: int) -> tuple[int, ...]:
    n = tokens if isinstance(tokens, int) else len(tokens)
    return tuple(zlib.crc32(f.encode()) % SIZE for f in (f"file{_bucket(n, 20, 100, 1000)}", f"keys{_bucket(n_keys, 1, 3)}"))


class Field:
    """Weights of features (SIZE x 3), transitions (3 x 3, from row to column) and start scores."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray) -> None:
        self.weights, self.moves = weights, moves
        # the most that the tags on both sides can add to a tag over what they add to outside
        m = moves
        self.slack = [max(m[p, y] + m[y, n] - m[p, OUT] - m[OUT, n] for p in range(3) for n in range(3)) for y in (BEGIN, INSIDE)]

    def viterbi(self, scores: np.ndarray, before: int = OUT, after: int | None = OUT) -> list[int]:
        """Best tags of a stretch whose neighbours on either side have the tags given."""
        best, back = scores[0] + self.moves[before], []
        for e in scores[1:]:
            all_ = best[:, None] + self.moves
            back.append(all_.argmax(0))
            best = all_.max(0) + e
        if after is not None:
            best = best + self.moves[:, after]
        tags = [int(best.argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        return tags[::-1]


def train(samples: list[tuple[list[tuple[int, ...]], list[int]]], steps: int = 120, rate: float = 0.3, ridge: float = 2e-4, ridge_moves: float = 0.02) -> Field:
    """Maximum likelihood by forward-backward over padded sequences, with AdaGrad steps. A sample: each token's weight rows, and tags."""
    n, length = len(samples), max(len(t) for _, t in samples)
    tags, mask = np.zeros((n, length), int), np.zeros((n, length), bool)
    rows, where = [], []
    for i, (feats, own) in enumerate(samples):
        tags[i, : len(own)], mask[i, : len(own)] = own, True
        for t, f in enumerate(feats):
            rows.extend(f)
            where.extend([i * length + t] * len(f))
    rows, where = np.array(rows), np.array(where)
    w, m = np.zeros((SIZE, 3)), np.zeros((3, 3))
    gw, gm = np.full_like(w, 1e-6), np.full_like(m, 1e-6)
    gold = np.zeros((n, length, 3))
    np.put_along_axis(gold, tags[:, :, None], 1.0, 2)
    gold *= mask[:, :, None]
    pair = np.zeros((3, 3))
    np.add.at(pair, (np.c_[np.zeros(n, int), tags[:, :-1]][mask], tags[mask]), 1)

    def sum_log(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)

    for _ in range(steps):
        e = np.stack([np.bincount(where, w[rows, k], n * length) for k in range(3)], 1).reshape(n, length, 3) * mask[:, :, None]
        fwd, bwd = np.zeros((n, length, 3)), np.zeros((n, length, 3))
        fwd[:, 0] = e[:, 0] + m[OUT]
        for t in range(1, length):
            step = sum_log(fwd[:, t - 1, :, None] + m[None], 1) + e[:, t]
            fwd[:, t] = np.where(mask[:, t, None], step, fwd[:, t - 1])
        for t in range(length - 2, -1, -1):
            step = sum_log(m[None] + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], 2)
            bwd[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        z = sum_log(fwd[:, -1], 1)
        p = np.exp(fwd + bwd - z[:, None, None]) * mask[:, :, None]
        q = np.exp(fwd[:, :-1, :, None] + m[None, None] + (e + bwd)[:, 1:, None, :] - z[:, None, None, None]) * mask[:, 1:, None, None]
        moved = q.sum((0, 1))
        moved[OUT] += p[:, 0].sum(0)
        d = ((gold - p) / n).reshape(-1, 3)
        g = np.stack([np.bincount(rows, d[where, k], SIZE) for k in range(3)], 1) - ridge * w
        h = (pair - moved) / n - ridge_moves * m
        gw += g * g
        gm += h * h
        w += rate * g / np.sqrt(gw)
        m = m + rate * h / np.sqrt(gm)
    return Field(w, m)


#: Alphabets that secrets' characters are drawn anew from, and the least and greatest length.
ALPHABETS = (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.digits + "ABCDEF", string.ascii_lowercase + string.digits, string.ascii_letters + string.digits + "-_")
REDRAWN = (14, 48)
_VALUE = re.compile(r"[A-Za-z0-9+/_-]{6,}(?!.*[A-Za-z0-9+/_-]{6})")


def redrawn(token: str, seed: int) -> str:
    """A token whose value (its last long run) has other characters, now and then after a short prefix."""
    rng = random.Random(seed)
    value = "".join(rng.choices(rng.choice(ALPHABETS), k=rng.randint(*REDRAWN)))
    prefix = "".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 4))) + rng.choice("_-") if rng.random() < 0.4 else ""
    return _VALUE.sub(lambda m: prefix + value, token, count=1)


Sample = tuple[list[tuple[int, ...]], list[int]]


def training_samples(texts: list[str], around: int = 5, odd: int = ODD, per_match: int = PER_MATCH) -> list[Sample]:
    """Windows about every match, as it stands and with the patterns' marks hidden, and about tokens outside, chosen by hash."""
    out, plain = [], []
    places = lru_cache(100_000)(_places)  # for this call alone: the worker lives on
    for text in texts:
        spans = base_spans(text)
        parts = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text)]
        if not parts:
            continue
        tags, last = [], None
        for a, z, _ in parts:
            hit = next((s for s in spans if s[0] < z and a < s[1]), None) if spans else None
            if hit is None:
                tags.append(OUT)
                last = None
            else:
                tags.append(INSIDE if last is not None and hit[0] < last else BEGIN)
                last = max(hit[1], last or 0)
        keys = [bool(_KEY.search(p[2])) for p in parts]
        words = [usual(p[2], key) for p, key in zip(parts, keys, strict=True)]
        whole = file_features(words, sum(keys))
        lot = lambda i: zlib.crc32(f"{i} {parts[i][2]}".encode("utf-8", "surrogatepass"))  # noqa: B023, E731

        def window(i: int, hidden: bool = False, anew: bool = False) -> Sample:
            lo, hi = max(0, i - around), min(len(words), i + around + 1)  # noqa: B023
            shown = [redrawn(w, lot(j)) if anew and tags[j] != OUT else w for j, w in enumerate(words)] if anew else words  # noqa: B023
            own = lambda j: places(shown[j], hidden and tags[j] != OUT)  # noqa: B023, E731
            feats = [(*own(j)[0], *(own(j - 1)[1] if j else ()), *(own(j + 1)[2] if j + 1 < len(words) else ()), *whole) for j in range(lo, hi)]  # noqa: B023
            return feats, tags[lo:hi]  # noqa: B023

        strange = [i for i, x in enumerate(words) if tags[i] == OUT and x[0] != "\0" and (keys[i] or len(x) > 16 or any(c.isdigit() for c in x))]
        outside = [*sorted(strange, key=lot)[:odd], zlib.crc32(text.encode("utf-8", "surrogatepass")) % len(words)]
        plain += [(lot(i), window(i)) for i in outside if tags[i] == OUT]
        out += [window(i, *how) for i, t in enumerate(tags) if t == BEGIN for how in ((False, False), (True, False), (True, True))]
    plain.sort(key=lambda x: x[0])
    return out + [x for _, x in plain[: max(500, per_match * len(out))]] if out else []


def fit(docs: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> Field | None:
    """Train on a sample by hash of the id; its ids (at most ``max_docs``) are broadcast, the work is done in one task."""
    ids = docs.where("doc_id is not null and text is not null").select("doc_id").distinct().withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_docs)
    rows = docs.select("doc_id", "text").where("text is not null").where(F.length("text") <= max_chars).join(F.broadcast(ids), "doc_id").select("text", "h", "doc_id")

    def run(batches) -> bytes:
        texts, read = [], 0
        for b in batches:
            for t in b.column(0).to_pylist():
                if read + len(t) <= max_chars:
                    read += len(t)
                    texts.append(t)
        samples = training_samples(texts)
        return pickle.dumps(train(samples) if samples else None)

    got = in_one_task(rows, ["h", "doc_id", "text"], run)
    return pickle.loads(got) if got else None


class Scanner:
    """Texts to all spans: the patterns' and, as kind ``crf``, those of the field that touch none of them."""

    def __init__(self, field: Field | None) -> None:
        self.field = field
        self.known: dict[str, int] = {}
        self.n, self.rows, self.keys = 0, np.empty((1024, 9)), np.empty(1024, bool)

    def _scores(self, distinct: list[str]) -> np.ndarray:
        """For each token its index in the table of scores (self, as before, as after; 3 tags each)."""
        if len(self.known) + len(distinct) > MAX_KNOWN:
            self.known, self.n = {}, 0
        known, w = self.known, self.field.weights
        new = [t for t in distinct if t not in known]
        if new:
            keys = pc.match_substring_regex(pa.array(new), f"(?i){_KEY.pattern}").to_pylist()
            for t, key in zip(new, keys, strict=True):
                like = usual(t, key)
                i = known.get(like)
                if i is None:
                    i = known[like] = self.n
                    if i == len(self.keys):
                        self.rows, self.keys = np.concatenate([self.rows, np.empty_like(self.rows)]), np.concatenate([self.keys, np.empty_like(self.keys)])
                    for k, rows in enumerate(_places(like)):
                        self.rows[i, 3 * k : 3 * k + 3] = w[list(rows)].sum(0)
                    self.keys[i] = key
                    self.n += 1
                known[t] = i
        return np.array([known[t] for t in distinct], np.int64)

    def tagged(self, texts: pa.Array) -> dict[int, list[tuple[int, int]]]:
        """Text number -> (token number, tag) of its tokens not outside."""
        cut = pc.ascii_split_whitespace(texts)
        flat = cut.flatten()
        real = pc.not_equal(pc.binary_length(flat), 0)
        ends = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))][cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        words = flat.filter(real).dictionary_encode()
        n = len(words)
        if not n:
            return {}
        at = self._scores(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        rows, keys, of = self.rows[at], self.keys[at], words.indices.to_numpy()
        lengths = np.diff(ends)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        first, last = np.zeros(n, bool), np.zeros(n, bool)
        some = lengths > 0
        first[ends[:-1][some]], last[ends[1:][some] - 1] = True, True
        e = rows[of, 0:3]
        e[1:] += np.where(first[1:, None], 0, rows[of[:-1], 3:6])
        e[:-1] += np.where(last[:-1, None], 0, rows[of[1:], 6:9])
        n_keys = np.bincount(doc, keys[of], len(lengths)).astype(int)
        whole = np.stack([self.field.weights[list(file_features(int(c), int(k)))].sum(0) for c, k in zip(lengths, n_keys, strict=True)])
        e += whole[doc]
        slack = self.field.slack
        open_ = np.flatnonzero((e[:, OUT] - e[:, BEGIN] <= slack[0]) | (e[:, OUT] - e[:, INSIDE] <= slack[1]))
        out: dict[int, list[tuple[int, int]]] = {}
        if not len(open_):
            return out
        new = np.r_[True, (np.diff(open_) > 1) | (doc[open_[1:]] != doc[open_[:-1]])]
        starts = open_[new]
        stops = np.r_[open_[np.flatnonzero(new)[1:] - 1], open_[-1]] + 1
        for a, z in zip(starts.tolist(), stops.tolist(), strict=True):
            tags = self.field.viterbi(e[a:z], OUT, None if last[z - 1] else OUT)
            if any(tags):
                d = int(doc[a])
                out.setdefault(d, []).extend((a + i - int(ends[d]), t) for i, t in enumerate(tags) if t)
        return out

    def __call__(self, texts: pa.Array) -> list[list[Span]]:
        texts = pc.fill_null(texts, "")
        maybe = pc.match_substring_regex(pc.ascii_lower(texts), _MAYBE).to_pylist()
        base = [base_spans(t.as_py()) if m else [] for t, m in zip(texts, maybe, strict=True)]
        if self.field is None:
            return base
        for d, tokens in self.tagged(texts).items():
            text = texts[d].as_py()
            parts = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
            spans: list[list[int]] = []
            for k, tag in tokens:
                if tag == INSIDE and spans and spans[-1][2] == k - 1:
                    spans[-1][1:] = [parts[k][1], k]
                else:
                    spans.append([*parts[k], k])
            found = base[d]
            extra = [(a, z, "crf") for a, z, _ in spans if not any(s < z and a < e for s, e, _ in found)]
            base[d] = sorted([*found, *extra], key=lambda s: (s[0], [*KINDS, "crf"].index(s[2])))
        return base


def scan(docs: DataFrame, field: Field | None, *keep: str) -> DataFrame:
    """Columns ``keep``, then ``spans``: array of (start, end, kind), by start."""
    src = docs.select(*keep, F.col("text").alias("__text"))
    held = docs.sparkSession.sparkContext.broadcast(field)  # SIZE x 3 weights
    n = len(keep)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches):
        find = Scanner(held.value)
        for b in sized(batches, n, SLICE_BYTES):
            found = [[{"start": a, "end": z, "kind": k} for a, z, k in s] for s in find(b.column(n))]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.array(found, kind)], names=[*keep, "spans"])

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]), "spans array<struct<start:long,end:long,kind:string>>"])
    return src.mapInArrow(lean(run), ddl)


def _is(kind: str):
    return lambda s: s["kind"] == kind


def op6_secrets(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    got = scan(docs, fit(docs), "doc_id")
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    count = [F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return got.select("doc_id", *count, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, field: Field | None, mark: str = "<secret>") -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mark``; rows without one, and null texts, stay as they are."""
    names = docs.columns
    src = docs.select(*names)
    held = docs.sparkSession.sparkContext.broadcast(field)
    at = names.index("text")

    def run(batches):
        find = Scanner(held.value)
        for b in sized(batches, at, SLICE_BYTES):
            texts = b.column(at)
            out = texts.to_pylist()
            for i, spans in enumerate(find(texts)):
                if spans:
                    t, parts, p = out[i], [], 0
                    for a, z, _ in spans:
                        if z <= p:
                            continue
                        if a >= p:
                            parts += [t[p:a], mark]
                        p = z
                    out[i] = "".join([*parts, t[p:]])
            cols = [pa.array(out, texts.type) if k == at else b.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return src.mapInArrow(lean(run), src.schema)
