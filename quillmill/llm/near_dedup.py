"""MinHash near-duplicates with min-max hashing.

1. A document's set: hashes of its distinct ``WORDS``-word shingles. Each of ``HASHES`` permutations gives two
   signature values, the least and the greatest, so ``2 * HASHES`` values cost half the evaluations.
2. Documents of equal sets are one class (grouped by a 128-bit digest of the set, with map-side combination).
3. Signatures are cut into bands of ``ROWS`` values. In each band bucket every class is paired with the least
   class only, a star, never all with all; a 1-bit sketch of the signature and the sizes rule out pairs that
   can't reach the threshold.
4. Pairs are confirmed on full sets, made anew from whole texts, star by star; a large star is cut in salted parts.
5. Components of the confirmed links. In buckets that still hold classes of several components, the stars may have
   missed links. There, in-task and in blocks of bounded size, classes are compared by sketch, and those that any
   class of another component could match are gathered with their likes; such gatherings are then compared on full
   sets, again in blocks, by matrix products over the shingles that two members share. Neither step emits pairs:
   each block gives a forest of the links it found, at most one row a member, so no link is lost or multiplied.

With 32 bands of 4 a pair at the threshold itself is missed with probability 5e-6; confirmed links are exact.

Defined results: a text with fewer words than a shingle is one shingle; null or wordless texts have the empty
set, link with nothing and are kept; repeated rows get equal results; a class's id is its least non-null doc_id; long texts are
read whole; an empty table gives no rows; extra columns, whatever their names, are ignored, and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.common import documents, lean, materialize, row_key, slices, spare_name
from quillmill.llm.components import connected_components

WORDS, HASHES, ROWS, BANDS = 5, 64, 4, 32
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Sketch bits (of 128) that may differ: at the threshold 16 differ on average, with deviation 3.8; this is 5 deviations above.
MAX_DIFFER = 35
_STAR = 1024
#: Members of a block that are compared in one task (each task holds two blocks at most).
_BLOCK = 1024
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX[0]
    x = (x ^ (x >> np.uint64(33))) * _MIX[1]
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: pa.Array, n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (null: none)."""
    import xxhash

    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = cut.flatten()
    real = pc.not_equal(pc.binary_length(flat), 0)  # splitting leaves empty words at the ends of a text
    offsets = cut.offsets.to_numpy() - cut.offsets[0].as_py()
    keep = real.to_numpy(zero_copy_only=False)
    ends = np.r_[0, np.cumsum(keep)][offsets]
    words = flat.filter(real).dictionary_encode()
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()], np.uint64)[words.indices.to_numpy()] if len(words) else np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        acc = np.zeros(max(0, len(h) - n + 1), np.uint64)
        for j in range(n):
            acc = (acc ^ h[j : len(h) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15 + 2 * j)
            acc ^= acc >> np.uint64(32)
        acc = _mix(acc)
    out = []
    for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if z - a >= n:
            out.append(np.unique(acc[a : z - n + 1]))
        elif z > a:
            out.append(np.array([int.from_bytes(hashlib.blake2b(h[a:z].tobytes(), digest_size=8).digest(), "little")], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, HASHES, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """For non-empty sets: a row each of HASHES minima, then HASHES maxima."""
    mul, add = _permutations()
    out = np.empty((len(sets), 2 * HASHES), np.uint64)
    sizes = [len(s) for s in sets]
    start = 0
    while start < len(sets):  # about a million shingles at a time
        stop, n = start, 0
        while stop < len(sets) and (stop == start or n + sizes[stop] <= 200_000):
            n += sizes[stop]
            stop += 1
        x = np.concatenate(sets[start:stop])
        at = np.r_[0, np.cumsum(sizes[start:stop])[:-1]]
        with np.errstate(over="ignore"):
            for k in range(HASHES):
                y = x * mul[k] + add[k]
                y ^= y >> np.uint64(31)
                out[start:stop, k] = np.minimum.reduceat(y, at)
                out[start:stop, HASHES + k] = np.maximum.reduceat(y, at)
        start = stop
    return out


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


_SETS = "doc_id long, row binary, n_shingles long, node binary, bands array<long>, s1 long, s2 long"


def sets_of(docs: DataFrame) -> DataFrame:
    """A row per document: its row key, set size, digest of the set, band keys and sketch."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("row"), "text")

    def run(batches):
        for b in slices(batches, 2048):
            sets = shingle_sets(b.column(2))
            full = [i for i, s in enumerate(sets) if len(s)]
            sig = signatures([sets[i] for i in full]) if full else np.empty((0, 2 * HASHES), np.uint64)
            order = np.arange(2 * HASHES).reshape(2, -1, ROWS // 2).transpose(1, 0, 2).reshape(BANDS, ROWS)  # a band: two minima, two maxima
            with np.errstate(over="ignore"):
                keys = np.zeros((len(full), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for j in range(ROWS):
                    keys = _mix(keys * np.uint64(31) + sig[:, order[:, j]])
            bits = np.packbits((_mix(sig) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64).reshape(len(full), 2)
            bands, sk, node = [None] * len(sets), [(None, None)] * len(sets), [None] * len(sets)
            for k, i in enumerate(full):
                bands[i], sk[i], node[i] = keys[k].view(np.int64), bits[k].tolist(), digest(sets[i])
            cols = [(list(map(len, sets)), pa.int64()), (node, pa.binary()), (bands, pa.list_(pa.int64())), ([x for x, _ in sk], pa.int64()), ([x for _, x in sk], pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(v, t) for v, t in cols)], names=["doc_id", "row", "n_shingles", "node", "bands", "s1", "s2"])

    return src.mapInArrow(lean(run), _SETS)


def _plausible(a: str, b: str) -> Column:
    big, small = F.greatest(f"{a}n", f"{b}n"), F.least(f"{a}n", f"{b}n")
    far = F.bit_count(F.col(f"{a}s1").bitwiseXOR(F.col(f"{b}s1"))) + F.bit_count(F.col(f"{a}s2").bitwiseXOR(F.col(f"{b}s2")))
    return (small * 100 >= big * PERCENT) & (far <= MAX_DIFFER)


def _texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, text``: one text of each class."""
    need = nodes.join(classes.select("node", "row"), "node")
    return docs.select(row_key("doc_id", "text").alias("row"), "text").join(need, "row").dropDuplicates(["node"]).select("node", "text")


class _Forest:
    """Links that join what wasn't joined yet."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))
        self.links: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def add(self, pairs) -> None:
        for i, j in pairs:
            a, b = self.find(i), self.find(j)
            if a != b:
                self.up[b] = a
                self.links.append((i, j))


def _plausible_forest(t: pa.Table, side: np.ndarray) -> list[tuple[int, int]]:
    """Of one block (or the meeting of two, told apart by ``side``): a forest of the pairs of different components that sketch and size allow."""
    number: dict[bytes, int] = {}
    root = np.array([number.setdefault(r, len(number)) for r in t["root"].to_pylist()], np.int64)
    n, s = t["n"].to_numpy(), [t[c].to_numpy().view(np.uint64) for c in ("s1", "s2")]
    both, out = len(set(side.tolist())) > 1, _Forest(t.num_rows)
    for i in range(t.num_rows):
        j = slice(i + 1, None)
        ok = (root[j] != root[i]) & (np.minimum(n[j], n[i]) * 100 >= np.maximum(n[j], n[i]) * PERCENT)
        if both:
            ok &= side[j] != side[i]
        ok &= sum(np.bitwise_count(x[j] ^ x[i]).astype(int) for x in s) <= MAX_DIFFER
        out.add((i, i + 1 + k) for k in np.flatnonzero(ok).tolist())
    return out.links


def _exact_forest(t: pa.Table, side: np.ndarray) -> list[tuple[int, int]]:
    """A forest of the links on full sets. Intersections come from products of 0/1 columns, one a shingle that two members have."""
    sets = shingle_sets(t["text"].combine_chunks())
    size = np.array([len(x) for x in sets], np.int64)
    every, times = np.unique(np.concatenate(sets), return_counts=True)
    shared = every[times > 1]
    member = np.repeat(np.arange(len(sets)), size)
    at = np.concatenate(sets)
    col = np.minimum(np.searchsorted(shared, at), max(0, len(shared) - 1))
    keep = shared[col] == at if len(shared) else np.zeros(len(at), bool)
    member, col = member[keep], col[keep]
    order = np.argsort(col, kind="stable")
    member, col = member[order], col[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, len(shared), 4096):
        a, z = np.searchsorted(col, [lo, lo + 4096])
        m = np.zeros((len(sets), min(4096, len(shared) - lo)), np.float32)
        m[member[a:z], col[a:z] - lo] = 1
        common += m @ m.T
    both, out = len(set(side.tolist())) > 1, _Forest(len(sets))
    for i in range(len(sets)):
        c = common[i, i + 1 :].astype(np.int64)
        ok = 100 * c >= PERCENT * (size[i] + size[i + 1 :] - c)
        if both:
            ok &= side[i + 1 :] != side[i]
        out.add((i, i + 1 + k) for k in np.flatnonzero(ok).tolist())
    return out.links


def _blocked(rows: DataFrame, key: str, cols: list[str], forest) -> DataFrame:
    """Groups of ``rows`` (with their size in ``members``) in blocks of about ``_BLOCK`` members, each block with itself and each two
    together, through ``forest``: ``u, v`` of the links found. A group within the bound is one task's."""
    r = rows.withColumn("__n", F.ceil(F.col("members") / F.lit(_BLOCK)).cast("int")).withColumn("__b", F.pmod(F.xxhash64("node"), F.col("__n")).cast("int"))
    r = r.withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    r = r.select(key, F.least("__b", "__o").alias("__i"), F.greatest("__b", "__o").alias("__j"), "__b", *cols)

    def run(t: pa.Table) -> pa.Table:
        side = t["__b"].to_numpy()
        i, j = t["__i"][0].as_py(), t["__j"][0].as_py()
        nodes = t["node"].to_pylist()
        links = forest(t, side) if i == j or len(set(side.tolist())) > 1 else []
        return pa.table({"u": pa.array([min(nodes[a], nodes[b]) for a, b in links], pa.binary()), "v": pa.array([max(nodes[a], nodes[b]) for a, b in links], pa.binary())})

    return r.groupBy(key, "__i", "__j").applyInArrow(run, "u binary, v binary")


def confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (u, v) of nodes whose full sets reach the threshold, as ``u, v``. Stars about u, large ones in salted parts."""
    sizes = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / F.lit(_STAR)).cast("int").alias("parts"))
    legs = pairs.join(sizes, "u").select(F.col("u").alias("hub"), F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("part"), F.col("v").alias("node"))
    hubs = sizes.select(F.col("u").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("u").alias("node"))
    roles = materialize(legs.unionByName(hubs), "roles")
    stars = roles.join(_texts(roles.select("node").distinct(), classes, docs), "node").withColumn("leg", F.col("hub") != F.col("node"))
    # a part of a star is at most _STAR texts, hub first
    dealt = stars.repartition(F.col("hub"), F.col("part")).sortWithinPartitions("hub", "part", "leg").select("hub", "part", "node", "text")

    def run(batches):
        hub = None
        for b in slices(batches, 512):
            hubs_, parts, nodes = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            us, vs = [], []
            for h, p, n, s in zip(hubs_, parts, nodes, shingle_sets(b.column(3)), strict=True):
                if h == n:
                    hub = (h, p, s)
                    continue
                if hub is None or hub[:2] != (h, p):
                    raise RuntimeError("a star without its hub")
                both = len(np.intersect1d(hub[2], s, assume_unique=True))
                if 100 * both >= PERCENT * (len(hub[2]) + len(s) - both):
                    us.append(h)
                    vs.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])

    return dealt.mapInArrow(lean(run), "u binary, v binary")


def _clusters(docs: DataFrame) -> DataFrame:
    """``doc_id, row, n_shingles, node, root, component_id`` for every row of ``docs`` (doc_id, text)."""
    sets = materialize(sets_of(docs), "sets")
    classes = sets.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.min("row").alias("row"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("s1").alias("s1"), F.first("s2").alias("s2"))
    classes = materialize(classes, "classes")
    band = classes.select("node", "n", "s1", "s2", F.explode("bands").alias("key"))
    shared = band.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("node", "n", "s1", "s2")).alias("m")).where("c > 1").select("key", "m")
    held = materialize(band.join(shared, "key").select("key", "node", "n", "s1", "s2", F.col("m.node").alias("mnode"), F.col("m.n").alias("mn"), F.col("m.s1").alias("ms1"), F.col("m.s2").alias("ms2")), "buckets")
    stars = held.where("node <> mnode").where(_plausible("m", "")).select(F.col("mnode").alias("u"), F.col("node").alias("v")).distinct()
    stars = materialize(stars, "stars")
    links = materialize(confirm(stars, classes, docs), "links")
    roots = connected_components(links)
    # what the stars left: buckets with classes of several components
    named = held.select("key", "node", "n", "s1", "s2").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo <> hi").select("key", "members")
    rest = materialize(named.join(mixed, "key"), "rest")
    near = materialize(_blocked(rest, "key", ["node", "n", "s1", "s2", "root"], _plausible_forest).distinct(), "near")
    if not near.isEmpty():
        gathered = connected_components(near)
        gathered = gathered.unionByName(gathered.select(F.col("root").alias("node"), "root").distinct())
        sized = gathered.join(gathered.groupBy("root").agg(F.count(F.lit(1)).alias("members")), "root").select("node", F.col("root").alias("gathering"), "members")
        texts = _texts(sized.select("node"), classes, docs)
        more = _blocked(sized.join(texts, "node"), "gathering", ["node", "text"], _exact_forest)
        links = materialize(links.unionByName(more), "links")
        roots = connected_components(links)
    named = classes.select("node", "least").join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    first = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.join(first, "root").select("node", "root", "component_id")
    got = sets.select("doc_id", "row", "n_shingles", "node").join(ids, "node", "left")
    return got.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text)."""
    return _clusters(docs).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: of least doc_id (nulls last). Texts without words all stay, identical rows once."""
    got, key = _clusters(docs), spare_name(docs, "row")
    best = got.where("node is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("b"))
    rows = best.select(F.col("b.row").alias(key)).unionByName(got.where("node is null").select(F.col("row").alias(key)))
    return docs.withColumn(key, row_key("doc_id", "text")).join(rows, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


OP9_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN ws IS NULL OR len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS sh FROM w
), x AS (SELECT doc_id, unnest(sh) AS g FROM s),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM i JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b WHERE 100 * n >= 75 * (len(p.sh) + len(q.sh) - n)
), u AS (SELECT a AS v, b AS t FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS v, doc_id AS t FROM documents UNION SELECT r.v, u.t FROM r JOIN u ON u.v = r.t),
c AS (SELECT v, min(t) AS component_id FROM r GROUP BY v)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept FROM s JOIN c ON c.v = s.doc_id
"""
