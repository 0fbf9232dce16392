"""Largest inner products by vantage-point trees, for each length and shard of the vectors.

A shard (vectors of one length, dealt by hash of their id, about ``SHARD`` each) keeps its vectors in a tree: a
node's vantage point splits the rest at the median distance, leaves hold up to ``LEAF``. A block of queries walks
the tree together. With a query scaled to length T, q.x = (T^2 + |x|^2 - |q - x|^2) / 2; the triangle inequality
and a subtree's own largest norm bound that from above, so vectors of huge norm loosen the bound only of the
subtrees that hold them. A subtree is passed over when the bound, eased for rounding, is below a query's k-th best;
the gap of the triangle inequality counts ``relax`` times: 1 gives exact search, larger values prune more.

Leaves are ranked by the exact scores themselves, in double precision, one component after another, and equal
scores by smaller id. Equal vectors of a shard are one point with its ids ascending (the k + 1 smallest can matter,
and are kept), so copies neither unbalance a tree nor multiply work. Queries travel in blocks of ``BLOCK`` to every
shard of their length: a stated set of queries against all rows, not a join of rows with rows.

Defined results: vectors null, zero, or with null or non-finite components take no part; vectors of different
lengths have no inner product, so a query meets those of its own length; equal scores go by smaller id; rows
repeated under one id are one candidate row each; null ids take no part; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm.common import lean

SHARD, LEAF, BLOCK, K, RELAX = 8192, 256, 1024, 20, 1.0


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: rows that take part, as arrays of doubles."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    v = v.where("vec_id is not null and v is not null and size(v) > 0").where(fine)
    return v


class Tree:
    """Over points (n x d); nodes are tuples, leaves index arrays."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.points, self.leaf = points, leaf
        self.norms = np.linalg.norm(points, axis=1)
        self.root = self._build(np.arange(len(points)), np.random.default_rng(len(points)))

    def _build(self, at: np.ndarray, rng):
        if len(at) <= self.leaf:
            return at
        some = at[rng.permutation(len(at))[:5]]
        reach = [np.linalg.norm(self.points[at[:: max(1, len(at) // 200)]] - self.points[c], axis=1).std() for c in some]
        vantage = some[int(np.argmax(reach))]  # the candidate that spreads the others most
        d = np.linalg.norm(self.points[at] - self.points[vantage], axis=1)
        order = np.argsort(d, kind="stable")
        half = len(at) // 2
        inner, outer = order[:half], order[half:]
        bounds = (d[inner[0]], d[inner[-1]], d[outer[0]], d[outer[-1]], self.norms[at[inner]].max(), self.norms[at[outer]].max())
        return vantage, bounds, self._build(at[inner], rng), self._build(at[outer], rng)

    def search(self, q: np.ndarray, k: int, relax: float = 1.0) -> tuple[np.ndarray, np.ndarray, int]:
        """The k nearest points of each query: indices (-1: none) and distances; and how many points were compared."""
        best = np.full((len(q), k), np.inf)
        who = np.full((len(q), k), -1, np.int64)
        looked = 0
        norms = (self.points**2).sum(1)
        qn = (q**2).sum(1)

        def walk(node, mine: np.ndarray) -> None:
            nonlocal looked
            if not len(mine):
                return
            if not isinstance(node, tuple):
                looked += len(mine) * len(node)
                d = np.sqrt(np.maximum(0, qn[mine, None] + norms[node] - 2 * (q[mine] @ self.points[node].T)))
                alld = np.concatenate([best[mine], d], axis=1)
                allw = np.concatenate([who[mine], np.broadcast_to(node, d.shape)], axis=1)
                pick = np.argpartition(alld, k - 1, axis=1)[:, :k]
                best[mine], who[mine] = np.take_along_axis(alld, pick, 1), np.take_along_axis(allw, pick, 1)
                return
            vantage, (a, b, c, e, *_), inner, outer = node
            d = np.linalg.norm(q[mine] - self.points[vantage], axis=1)
            near = d <= (b + c) / 2
            for side, lo, hi, first in ((inner, a, b, near), (outer, c, e, ~near), (outer, c, e, near), (inner, a, b, ~near)):
                gap = np.maximum(0, np.maximum(lo - d, d - hi))
                walk(side, mine[first & (gap * relax <= best[mine].max(1) * (1 + 1e-9) + 1e-9)])

        walk(self.root, np.arange(len(q)))
        return who, best, looked

    def largest(self, q: np.ndarray, k: int, relax: float = 1.0) -> tuple[np.ndarray, np.ndarray, int]:
        """The k points of largest inner product with each query, of equal ones the first: indices (-1: none) and exact scores; and how many were compared."""
        score = np.full((len(q), k), -np.inf)
        who = np.full((len(q), k), -1, np.int64)
        looked = 0
        t = float(np.median(self.norms)) if len(self.norms) else 1.0
        columns = np.ascontiguousarray(self.points.T)
        with np.errstate(all="ignore"):
            scale = t / np.linalg.norm(q, axis=1)
            scaled = q * scale[:, None]
        if not 1e-100 < t < 1e100:  # squares would leave the range of doubles: no bound, all is scanned
            scale[:] = np.nan

        def walk(node, mine: np.ndarray) -> None:
            nonlocal looked
            if not len(mine):
                return
            if not isinstance(node, tuple):
                looked += len(mine) * len(node)
                s = exact_table(q[mine], columns[:, node])
                some = (s >= score[mine].min(1)[:, None]).any(1)
                mine, s = mine[some], s[some]
                s, w = np.concatenate([score[mine], s], axis=1), np.concatenate([who[mine], np.broadcast_to(node, s.shape)], axis=1)
                pick = np.lexsort((w, -s), axis=1)[:, :k]
                score[mine], who[mine] = np.take_along_axis(s, pick, 1), np.take_along_axis(w, pick, 1)
                return
            vantage, (a, b, c, e, m, n), inner, outer = node
            with np.errstate(all="ignore"):
                d = np.linalg.norm(scaled[mine] - self.points[vantage], axis=1)
                near = d <= (b + c) / 2
                for side, lo, hi, most, first in ((inner, a, b, m, near), (outer, c, e, n, ~near), (outer, c, e, n, near), (inner, a, b, m, ~near)):
                    gap = np.maximum(0, np.maximum(lo - d, d - hi) - 1e-9 * (d + hi + t)) * relax
                    bound = (t * t + most * most - gap * gap) / 2 + 1e-9 * (t * t + most * most)
                    walk(side, mine[first & ~(bound < score[mine].min(1) * scale[mine])])  # bounds that aren't numbers prune nothing

        walk(self.root, np.arange(len(q)))
        return who, score, looked


def exact_table(q: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """:func:`exact_scores` of every query with every point; ``columns``: a row a component."""
    s = np.zeros((len(q), columns.shape[1]))
    for j in range(len(columns)):
        s += q[:, j, None] * columns[j]
    return s


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, components added in order."""
    s = np.zeros(len(x))
    for j in range(x.shape[1]):
        s += q[:, j] * x[:, j]
    return s


def search(vectors: DataFrame, queries: DataFrame, k: int = K, relax: float = RELAX, shard: int = SHARD) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` (vec_id, v) its k best of ``vectors`` but itself."""
    pack = "d int, k int, ids binary, vecs binary"

    def packer(key):
        def run(t: pa.Table) -> pa.Table:
            ids = t["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            d = t["d"][0].as_py()
            v = np.array(t["v"].combine_chunks().flatten().to_numpy()).reshape(len(ids), d)
            cols = [([d], pa.int32()), ([t[key][0].as_py()], pa.int32()), ([ids[order].astype("<i8").tobytes()], pa.binary()), ([v[order].astype("<f8").tobytes()], pa.binary())]
            return pa.table([pa.array(c, kind) for c, kind in cols], names=["d", "k", "ids", "vecs"])

        return run

    def dealt(rows: DataFrame, key: str, most: int) -> tuple[DataFrame, DataFrame]:
        """The rows packed by length and part of about ``most``; and the lengths with their numbers of parts."""
        rows = rows.withColumn("d", F.size("v"))
        parts = rows.groupBy("d").agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).cast("int").alias("parts"))
        rows = rows.join(F.broadcast(parts), "d").withColumn(key, F.pmod(F.xxhash64("vec_id", F.lit(key)), F.col("parts")).cast("int"))
        return rows.groupBy("d", key).applyInArrow(packer(key), pack).withColumnRenamed("k", key), parts

    packed, shards = dealt(vectors, "shard", shard)
    packed = packed.select("d", "shard", F.col("ids").alias("xi"), F.col("vecs").alias("xv"))
    qp, _ = dealt(queries, "query", BLOCK)
    qp = qp.select("d", "query", F.col("ids").alias("qi"), F.col("vecs").alias("qv"))
    # each block of queries meets each shard of its length once
    meet = qp.join(F.broadcast(shards), "d").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).join(packed, ["d", "shard"])

    def run(batches):
        kept: tuple[object, object] = (None, None)
        for b in batches:
            for r in b.to_pylist():
                if kept[0] != (r["d"], r["xi"]):
                    kept = ((r["d"], r["xi"]), _index(r, k))
                tree, ids = kept[1]
                qi = np.frombuffer(r["qi"], "<i8")
                who, score, _ = tree.largest(np.frombuffer(r["qv"], "<f8").reshape(len(qi), r["d"]), min(k + 1, len(ids)), relax)
                row, col = np.nonzero(who >= 0)
                got, score = who[row, col], score[row, col]
                out = {}
                for i, g, s in zip(row.tolist(), got.tolist(), score.tolist(), strict=True):
                    out.setdefault(i, []).extend((-s, x) for x in ids[g] if x != qi[i])
                rows = [(int(qi[i]), x, -s) for i, c in out.items() for s, x in sorted(c)[:k]]
                cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

    found = meet.select("d", "xi", "xv", "qi", "qv").mapInArrow(lean(run), "query_id long, vec_id long, score double")
    # a query has at most k rows of each shard
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _index(r: dict, k: int):
    """The tree over a shard's distinct vectors, by smallest id; each one's smallest ids, as many as can matter."""
    xi = np.frombuffer(r["xi"], "<i8")
    xv = np.frombuffer(r["xv"], "<f8").reshape(len(xi), r["d"])
    first: dict[bytes, int] = {}
    ids: list[list[int]] = []
    at = []
    for i, key in enumerate(x.tobytes() for x in xv + 0.0):
        j = first.setdefault(key, len(ids))
        if j == len(ids):
            ids.append([])
            at.append(i)
        if len(ids[j]) <= k:
            ids[j].append(int(xi[i]))
    return Tree(xv[at]), ids


def op10_neighbours(spark, sf_dir: str) -> DataFrame:
    v = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return search(v, v.where("vec_id % 20 = 0"))


OP10_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id,
         list_reduce(list_prepend(0::DOUBLE, list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i])), lambda a, b: a + b) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
