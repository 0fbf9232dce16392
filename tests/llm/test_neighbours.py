import numpy as np
import pytest

from quillmill.llm import neighbours


def brute(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, qv in ok:
        if q % 20 == 0:
            best = sorted((-float(neighbours.exact_scores(qv[None], v[None])[0]), i) for i, v in ok if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_exact_at_factor_one(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(700)] + [(800 + i, [1.0, 2.0, 0.0, 1.0]) for i in range(60)]
    rows += [(2000, None), (2001, [0.0] * 4), (2002, [float("nan"), 1.0, 1.0, 1.0]), (2003, [None, 1.0, 1.0, 1.0]), (2004, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (2005, [1.0])]
    v = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = neighbours.search(v, v.where("vec_id % 20 = 0"), 20, shard=200).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 20)


@pytest.mark.parametrize("relax", [1.0, 1.5])
def test_tree(relax):
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(3000, 6)), rng.normal(size=(40, 6))
    who, _, looked = neighbours.Tree(x, 64).search(q, 10, relax)
    best = np.argsort(((q[:, None] - x[None]) ** 2).sum(-1), axis=1)[:, :10]
    hit = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(who.tolist(), best.tolist(), strict=True)])
    assert hit == 1 if relax == 1 else hit > 0.7
    assert looked < 40 * 3000


def test_few_candidates(spark):
    v = neighbours.usable(spark.createDataFrame([(20, [1.0, 0.0]), (3, [0.5, 0.0])], "vec_id long, embedding array<float>"))
    assert [tuple(r) for r in neighbours.search(v, v.where("vec_id % 20 = 0")).collect()] == [(20, 1, 3, 0.5)]
    none = v.where("vec_id < 0")
    assert neighbours.search(none, none).collect() == []


def best_of(rows, k):
    """As brute, within each length."""
    out = []
    for n in {len(v) for _, v in rows}:
        ok = [(i, np.array(v, float)) for i, v in rows if len(v) == n]
        x, ids = np.array([v for _, v in ok]), [i for i, _ in ok]
        for q, qv in ok:
            if q % 20 == 0:
                s = neighbours.exact_scores(np.broadcast_to(qv, x.shape), x)
                best = sorted((-float(a), i) for a, i in zip(s, ids, strict=True) if i != q)[:k]
                out += [(q, r, i, -a) for r, (a, i) in enumerate(best, 1)]
    return sorted(out)


def searched(spark, rows, **more):
    v = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    return sorted(tuple(r) for r in neighbours.search(v, v.where("vec_id % 20 = 0"), **more).collect())


def test_each_length_by_itself(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)] + [(1000 + i, rng.normal(size=3).tolist()) for i in range(50)] + [(2001, [1.0] * 5)]
    got = searched(spark, rows, shard=100)
    assert len(got) == 20 * (15 + 3)
    assert got == best_of(rows, 20)


@pytest.mark.parametrize("norm", [1e6, 1e8, 1e12, 1e160])
def test_one_vector_of_huge_norm(spark, norm):
    x = np.random.default_rng(4).normal(size=(3000, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [*enumerate(x.tolist()), (3001, (x[0] * norm).tolist())]
    assert searched(spark, rows) == best_of(rows, 20)


def test_ties_at_the_cut_go_by_smaller_id(spark):
    x = np.random.default_rng(5).integers(-1, 2, (3000, 8))
    x[:, 0] = 1
    rows = [(int(i), v) for i, v in zip(np.random.default_rng(6).permutation(3000), x.astype(float).tolist(), strict=True)]
    assert searched(spark, rows) == best_of(rows, 20)


def test_largest_prunes():
    rng = np.random.default_rng(7)
    x, q = rng.normal(size=(3000, 4)), rng.normal(size=(40, 4))
    who, _, looked = neighbours.Tree(x, 64).largest(q, 10)
    assert (who == np.argsort(-(q @ x.T), axis=1)[:, :10]).all()
    assert looked < 40 * 3000
