"""Toxicity by class-conditional Kneser-Ney models that share their backoff counts.

Two models, toxic and ordinary, spell words character by character (words stand after ``TOP - 1`` marks, so that every
character has a whole context, and before one). Each class has counts of its own at orders ``TOP`` down to ``LOW + 1``: of
occurrences at the top, below it Kneser-Ney continuation counts, numbers of distinct left neighbours. Orders ``LOW`` and less
are continuation counts over both classes together, and all backoff ends there. A character whose context neither class has
met so costs both the same, and a rare expression leans towards toxic by the stretches over ``LOW`` characters that it shares
with toxic ones.

A document is judged by log P(text | toxic) - log P(text | ordinary) a character: of the whole text, and of its most
toxic stretches of ``SPANS`` words, so that a long text with one toxic passage isn't washed out. A logistic curve,
fitted on out-of-fold ratios, turns the three ratios into a score from 0 to 1. Runs of letters over ``PIECE``
characters, as unspaced scripts have, count as several words, each character scored once and in its own context.

The models are fitted on a bounded sample of labelled rows: for each class, of the ``MAX_DOCS`` rows of lowest hash, those
whose whole texts fit in ``MAX_CHARS`` characters. That is done in one task; the driver sees the finished tables only.
Scoring sees every row and every character.

Defined results: null or wordless texts have ratios 0 and get the curve's value there, as any neutral text;
without labelled rows of both classes every score is 0; labels null in either column are ignored, of several labels of
one document the toxic one counts; rows that repeat are scored alike; long texts are scored whole; an empty table
gives an empty result; extra columns are ignored by ``score`` and kept, whatever their names, by ``drop_toxic``.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import documents, fold, in_one_task, lean, per_batch, slices

TOP, LOW = 6, 2
SPANS = (3, 12)
#: The bound of the sample that the classifier is fitted on, for each class.
MAX_DOCS, MAX_CHARS = 3000, 6_000_000
_LETTERS = re.compile(r"\w+")
#: Longer words are judged in pieces of so many characters, about as long as words are.
PIECE = 16
_PAD, _STOP, _CUT = "^", "$", "\0"
_CACHE = 200_000


def _spelt(word: str) -> str:
    """A word as it is spelt: its scored characters are those after the first ``TOP - 1``."""
    return word[1:] if word[0] == _CUT else _PAD * (TOP - 1) + word + _STOP


def words_of(text: str) -> list[str]:
    """Lower-case words; of those over ``PIECE`` characters, pieces spelt out, each after the characters it follows."""
    words = _LETTERS.findall(text.lower())
    if not words or max(map(len, words)) <= PIECE:
        return words
    out = []
    for w in words:
        if len(w) <= PIECE:
            out.append(w)
        else:
            whole = _spelt(w)
            out += [_CUT + whole[i : i + PIECE + TOP - 1] for i in range(0, len(whole) - TOP + 1, PIECE)]
    return out


def _hashes(codes: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n characters up to each end."""
    h = np.full(len(ends), 0x9E3779B97F4A7C15 + n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n - 1, -1, -1):
            h = (h ^ codes[ends - j]) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
    return h


def _spread(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words as spelt, the places of the scored characters, and whose they are."""
    spelt = [*map(_spelt, words)]
    codes = np.frombuffer("".join(spelt).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, spelt), np.int64, len(spelt))
    start, scored = np.cumsum(size) - size, size - TOP + 1
    whose = np.repeat(np.arange(len(words)), scored)
    ends = np.arange(len(whose)) - np.repeat(np.cumsum(scored) - scored, scored) + start[whose] + TOP - 1
    return codes, ends, whose


def _discount(counts: np.ndarray) -> float:
    ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
    return min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5


def _look_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted keys among sorted ones, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Models:
    """Both classes' models, by order from the top: the log-likelihood ratios of the grams that either class has met, and
    of their contexts the ratio of the mass left to every other character. The shared backoff cancels in ratios."""

    def __init__(self, toxic: Counter[str], ordinary: Counter[str]) -> None:
        words = [*(toxic | ordinary)]
        codes, ends, whose = _spread(words)
        grams, at, of = np.unique(_hashes(codes, ends, TOP), return_index=True, return_inverse=True)
        count = [np.bincount(of, np.array([c[w] for w in words], float)[whose], len(grams)) for c in (toxic, ordinary)]
        ends, orders = ends[at], []
        for n in range(TOP, 0, -1):
            contexts, ctx = np.unique(_hashes(codes, ends - 1, n - 1), return_inverse=True)
            shorter, at, of = np.unique(_hashes(codes, ends, n - 1), return_index=True, return_inverse=True)
            orders.append((n, grams, contexts, ctx, count, of))
            # of each gram one shorter, how many distinct ones end in it
            count = [np.bincount(of, c > 0, len(shorter)) for c in count] if n - 1 > LOW else [np.bincount(of, None, len(shorter)).astype(float)]
            grams, ends = shorter, ends[at]
        p = [np.full(1, 1.0 / max(64, len(orders[-1][1]) + 1))]  # below all orders, every character alike
        self.tables = []
        for n, grams, contexts, ctx, count, of in reversed(orders):
            if len(p) < len(count):
                p = p * 2  # from here on each class has its own
            d, free, now = _discount(np.concatenate(count)), [], []
            for c, lower in zip(count, p, strict=True):
                total, kinds = np.bincount(ctx, c), np.bincount(ctx, c > 0)
                met = total > 0
                free.append(np.where(met, d * kinds / np.maximum(total, 1), 1.0))
                now.append(np.where(met[ctx], np.maximum(c - d, 0) / np.maximum(total, 1)[ctx], 0.0) + free[-1][ctx] * lower[of])
            p = now
            if n > LOW:
                self.tables.append((n, grams, (np.log(p[0]) - np.log(p[1])).astype(np.float32), contexts, (np.log(free[0]) - np.log(free[1])).astype(np.float32)))
        self.tables.reverse()

    def ratios(self, words: list[str]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of each word."""
        if not words:
            return np.empty(0)
        codes, ends, whose = _spread(words)
        out = np.zeros(len(words))
        for n, grams, gram_ratio, contexts, context_ratio in self.tables:
            c, known = _look_up(contexts, _hashes(codes, ends - 1, n - 1))
            g, met = np.zeros(len(ends), np.int64), known.copy()
            g[known], met[known] = _look_up(grams, _hashes(codes, ends[known], n))  # a gram met has its context met
            out += np.bincount(whose, np.where(met, gram_ratio[g] if len(grams) else 0.0, np.where(known, context_ratio[c] if len(contexts) else 0.0, 0.0)), len(words))
            ends, whose = ends[~met], whose[~met]  # the others go on to the next order
        return out


def features(ratios: np.ndarray, sizes: np.ndarray) -> tuple[float, ...]:
    """Ratios a character: of the whole text, and the best of each span of words."""
    if not len(ratios):
        return (0.0,) * (1 + len(SPANS))
    sums, chars = np.r_[0.0, np.cumsum(ratios)], np.r_[0, np.cumsum(sizes)]
    best = []
    for n in SPANS:
        n = min(n, len(ratios))
        best.append(float(((sums[n:] - sums[:-n]) / (chars[n:] - chars[:-n])).max()))
    return (float(sums[-1] / chars[-1]), *best)


def featurizer(models: Models):
    """Texts to rows of features; ratios of words met are held in a bounded cache."""
    cache: dict[str, float] = {}

    def of(texts: list[str]) -> np.ndarray:
        split = [*map(words_of, texts)]
        distinct = set().union(*split)
        if len(cache) + len(distinct) > _CACHE:
            cache.clear()
        new = [w for w in distinct if w not in cache]
        for i in range(0, len(new), 50_000):
            some = new[i : i + 50_000]
            cache.update(zip(some, models.ratios(some).tolist(), strict=True))
        out = np.zeros((len(texts), 1 + len(SPANS)))
        for i, words in enumerate(split):
            if words:
                size = np.fromiter(map(len, words), np.int64, len(words))
                if size.max() > PIECE:  # some are pieces
                    size = np.array([len(w) + 1 if w[0] != _CUT else len(w) - TOP for w in words])
                else:
                    size += 1
                out[i] = features(np.fromiter(map(cache.__getitem__, words), float, len(words)), size)
        return out

    return of


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton's method on standardised columns; classes weigh the same."""
    mid, wide = x.mean(0), x.std(0) + 1e-9
    a = np.c_[np.ones(len(x)), (x - mid) / wide]
    weigh = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (weigh * (p - y)) + ridge * w
        h = (a * (weigh * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w, mid, wide


class Classifier:
    """Of (text, label) rows: models of one half judge the other, the curve is fitted on that, then models of all rows are kept."""

    def __init__(self, rows: list[tuple[str, int]]) -> None:
        self.models = self.curve = None
        y = np.array([r[1] for r in rows], float)
        if len(set(y.tolist())) < 2:
            return
        # halves by turns within each class, so that each half has both where it can
        half = np.zeros(len(rows), int)
        for label in (0, 1):
            at = np.flatnonzero(y == label)
            half[at] = np.arange(len(at)) % 2
        words = [[Counter(), Counter()], [Counter(), Counter()]]
        for (text, label), h in zip(rows, half.tolist(), strict=True):
            words[h][1 - label].update(words_of(text))
        x = np.zeros((len(rows), 1 + len(SPANS)))
        for h in (0, 1):
            of = featurizer(Models(*words[1 - h]))
            at = np.flatnonzero(half == h).tolist()
            for i in range(0, len(at), 256):
                x[at[i : i + 256]] = of([rows[k][0] for k in at[i : i + 256]])
            del of
        for a, b in zip(*words, strict=True):
            a.update(b)
            b.clear()
        self.models = Models(*words[0])
        self.curve = _logistic(x, y)

    def scorer(self):
        """Texts to (scores, predictions)."""
        if self.models is None:
            return lambda texts: (np.zeros(len(texts)), np.zeros(len(texts), np.int32))
        of, (w, mid, wide) = featurizer(self.models), self.curve

        def some(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            z = w[0] + ((of(texts) - mid) / wide) @ w[1:]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            return p, (p >= 0.5).astype(np.int32)

        return some


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> Classifier:
    """Fit on labelled rows outside the held-out fold. Which rows: by hash of the id; the ids of the sample are broadcast (at most 2 x ``max_docs``)."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(fold(F.col("doc_id"), 5) != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("h", F.xxhash64("doc_id"))
    picked = [known.where(F.col("toxic") == y).orderBy("h", "doc_id").limit(max_docs) for y in (1, 0)]
    sample = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
    sample = sample.where(F.length("text") <= max_chars).select("toxic", "text", "h", "doc_id")

    def run(batches) -> bytes:
        rows, read = [], [0, 0]
        for b in batches:
            for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if read[y] + len(text) <= max_chars:
                    read[y] += len(text)
                    rows.append((text, y))
        return pickle.dumps(Classifier(rows))

    return pickle.loads(in_one_task(sample, ["h", "doc_id", "text"], run) or pickle.dumps(Classifier([])))


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``doc_id, score, predicted`` of every row."""
    held = docs.sparkSession.sparkContext.broadcast(classifier)  # two tables, bounded by the sample they were fitted on
    return per_batch(docs, [F.col("doc_id")], lambda: held.value.scorer(), [("score", pa.float64()), ("predicted", pa.int32())], "score double, predicted int")


def drop_toxic(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``docs`` without the rows that are predicted toxic."""
    held = docs.sparkSession.sparkContext.broadcast(classifier)
    at = docs.columns.index("text")

    def run(batches):
        judge = held.value.scorer()
        for b in slices(batches):
            _, toxic = judge([t or "" for t in b.column(at).to_pylist()])
            yield b.filter(pa.array(toxic == 0))

    return docs.mapInArrow(lean(run), docs.schema)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    got = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return got.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
