"""Language identification by rank-order n-gram profiles.

A profile is the ``SIZE`` most frequent character n-grams (1 to ``LONGEST``) of the words of a text, each word
padded with ``_``, most frequent first, ties by n-gram (in a document those of some language come
before those of none). A document is in the language whose profile is nearest
by out-of-place distance: for each n-gram of the document's profile, how far its rank lies from its rank in the
language, or ``SIZE`` where the language lacks it.

Profiles are learnt on a bounded sample: of each language the ``MAX_DOCS`` documents of lowest hash outside the
held-out fold, whole texts, until ``MAX_CHARS`` characters are read. Predictions read every row's whole text.

Letters are those of Unicode's letter categories: numerals such as one half or a Roman seven are none.

Defined results: null texts and texts without a letter are ``und`` with score 0; ties between languages go to
the first by name; nothing to learn from: every text is ``und``; repeated rows get equal results; long texts are read
whole; an empty table gives no rows; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm.common import Bounded, documents, fold, per_text, unsigned_hash

SIZE, LONGEST = 400, 3
#: The bound of the sample that profiles are learnt from, for each language; and of languages.
MAX_DOCS, MAX_CHARS, MAX_LANGS = 500, 2_000_000, 1000
_WORD = re.compile(r"[^\W\d_]+")


def letters_of(text: str) -> Counter[str]:
    """Runs of letters in lower case, with how often they occur."""
    found = Counter(_WORD.findall(text.lower()))
    for w in [w for w in found if not w.isalpha()]:  # the pattern lets letter-like numerals through
        n = found.pop(w)
        for part in "".join(c if c.isalpha() else " " for c in w).split():
            found[part] += n
    return found


def grams(word: str) -> list[str]:
    s = f"_{word}_"
    out = [*word]
    for n in range(2, LONGEST + 1):
        out += [s[i : i + n] for i in range(len(s) - n + 1)]
    return out


def top(counts: Counter[str], size: int = SIZE) -> list[str]:
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]


def profile(words: Counter[str], size: int = SIZE) -> list[str]:
    counts: Counter[str] = Counter()
    for w, c in words.items():
        for g in grams(w):
            counts[g] += c
    return top(counts, size)


class Identifier:
    def __init__(self, profiles: dict[str, list[str]]) -> None:
        self.langs = sorted(profiles)
        self.ids = {g: i for i, g in enumerate(sorted({g for p in profiles.values() for g in p}))}
        self.rank = np.full((len(self.langs), len(self.ids) + 1), -1, np.int32)  # the last column: n-grams of no profile
        for k, lang in enumerate(self.langs):
            self.rank[k, [self.ids[g] for g in profiles[lang]]] = np.arange(len(profiles[lang]))

    def predictor(self):
        """text -> (language, score); holds a bounded cache of the n-grams of words met."""
        if not self.langs:
            return lambda text: ("und", 0.0)
        number: dict[str, int] = dict(self.ids)
        names: list[str] = sorted(self.ids)
        known, rank, langs = len(self.ids), self.rank, self.langs

        def of_word(word: str) -> np.ndarray:
            own = grams(word)
            got = [*map(number.get, own)]
            if None in got:
                for k, g in enumerate(own):
                    if got[k] is None:
                        i = got[k] = number.setdefault(g, len(names))
                        if i == len(names):
                            names.append(g)
            return np.array(got, np.int32)

        cache = Bounded(of_word)
        empty = np.empty(0, np.int32)

        def one(text: str | None) -> tuple[str, float]:
            if len(names) > 100_000:  # forget n-grams of no profile, so that memory stays flat
                cache.clear()
                del names[known:]
                number.clear()
                number.update((g, i) for i, g in enumerate(names))
            words = letters_of(text or "")
            parts = [cache[w] for w in words]
            ids = np.concatenate(parts) if parts else empty
            if not len(ids):
                return "und", 0.0
            times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), [len(p) for p in parts])
            count = np.bincount(ids, times, minlength=1)
            met = np.flatnonzero(count)
            c = count[met]
            if len(met) > SIZE:
                least = np.partition(c, len(c) - SIZE)[len(c) - SIZE]
                met = met[c >= least]
                c = count[met]
            order = np.lexsort((np.minimum(met, known), -c))[:SIZE]
            mine = np.minimum(met[order], known)
            far = rank[:, mine]
            d = np.where(far < 0, SIZE, np.abs(far - np.arange(len(mine)))).sum(1)
            k = int(d.argmin())
            return langs[k], float(1 - d[k] / (SIZE * len(mine)))

        return one


def learn(docs: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> Identifier:
    """Profiles of the non-null ``lang`` values of rows outside the held-out fold."""
    d = docs.select("doc_id", "text", "lang").where("lang is not null and text is not null").where(fold(F.col("doc_id"), 3) != 1)
    sizes = {r["lang"]: r["count"] for r in d.groupBy("lang").count().limit(MAX_LANGS + 1).collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not sizes:
        return Identifier({})
    # a hash threshold leaves about twice the sample, whatever a language's share; ranking then sees few rows
    share = d.sparkSession.createDataFrame([(k, min(1.0, 2 * max_docs / n)) for k, n in sizes.items()], "lang string, share double")
    some = d.withColumn("h", unsigned_hash(F.col("doc_id"), seed="language")).join(F.broadcast(share), "lang").where("h < share")
    ranked = some.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(F.col("k") <= max_docs)
    words: dict[str, Counter[str]] = {}
    read: Counter[str] = Counter()
    for r in ranked.select("lang", "text", "k").sort("lang", "k").toLocalIterator():
        if read[r["lang"]] < max_chars:
            read[r["lang"]] += len(r["text"])
            words.setdefault(r["lang"], Counter()).update(letters_of(r["text"]))
    return Identifier({k: p for k, c in words.items() if (p := profile(c))})


def identify(docs: DataFrame, identifier: Identifier) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    held = docs.sparkSession.sparkContext.broadcast(identifier)  # at most MAX_LANGS profiles of SIZE n-grams
    return per_text(docs, [F.col("doc_id")], lambda: held.value.predictor(), [("lang_pred", pa.string()), ("score", pa.float64())], "lang_pred string, score double", null=None)


def op4_language(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    got = identify(docs, learn(docs))
    return got.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")
