"""Exact clustering: the trees, their bounds, and the whole operator against plain Lloyd."""

import hashlib
import math

import numpy as np
import pytest

from arborpay.llm.dual_tree import BLOCK, assign, cluster_vectors, cover_tree

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string"


def squares(a, b):
    return ((a - b) ** 2).sum(-1)


@pytest.mark.parametrize("seed", range(12))
def test_a_walk_settles_every_point_once(seed):
    rng = np.random.default_rng(seed)
    n, dim = int(rng.integers(1, 1200)), int(rng.choice([1, 3, 64]))
    base = rng.integers(-40, 40, (max(1, n // 6), dim))
    points = base[rng.integers(0, len(base), n)] + rng.integers(-1, 2, (n, dim)) * (seed % 2)
    centroids = points[rng.integers(0, n, int(rng.integers(1, 9)))] + rng.integers(0, 2, dim)
    tree = cover_tree(points)
    there = points[tree.order]
    assert sorted(tree.order.tolist()) == list(range(n))
    for i in range(len(tree.low)):
        assert np.sqrt(squares(there[tree.low[i] : tree.high[i]], there[tree.center[i]])).max() <= tree.radius[i] + 1e-9
        kids = range(tree.child[i], tree.child[i] + tree.kids[i])
        assert sum(tree.high[j] - tree.low[j] for j in kids) == (tree.high[i] - tree.low[i]) * (tree.kids[i] > 0)
        centers = there[tree.center[list(kids)]]
        for a in range(len(centers) - 1):  # separated
            assert tree.radius[i] == 0 or (4 * squares(centers[a + 1 :], centers[a]) > squares(there[tree.low[i] : tree.high[i]], there[tree.center[i]]).max()).all()
    got = np.full(n, -1)
    for low, high, number in assign(there, tree, centroids, cover_tree(centroids, 1)):
        for a, b, c in zip(low, high, number, strict=True):
            assert (got[a:b] == -1).all()
            got[a:b] = c
    assert (got == [squares(centroids, x).argmin() for x in there]).all()


def test_a_walk_skips_most_pairs():
    rng = np.random.default_rng(5)
    centers = rng.integers(-5000, 5000, (8, 64))
    points = centers[rng.integers(0, 8, 1024)] + rng.integers(-5, 6, (1024, 64))
    tree = cover_tree(points)
    ranges = [h - a for low, high, _ in assign(points[tree.order], tree, centers, cover_tree(centers, 1)) for a, h in zip(low, high, strict=True)]
    assert sum(ranges) == 1024 and len(ranges) < 50


def plain(rows, k=8, rounds=10, dim=64):
    kept = [(i, [math.floor(float(np.float32(x)) * 1024) for x in v]) for i, v, *_ in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: "~" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, g in groups.items():
            centroids[j] = [sum(x) // len(g) for x in zip(*g, strict=True)]
    placed = [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept]
    inertia = {}
    for _, j, d in placed:
        inertia[j] = inertia.get(j, 0) + d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, j, d in placed), key=str)


def rows_of(n, seed, copies=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, 64))
    rows = [(i, (centers[i % 5] + rng.normal(size=64) * 0.4).tolist(), i % 5, "x") for i in range(n)]
    return rows + [(1000 + i, rows[0][1], None, "copy") for i in range(copies)]


@pytest.mark.parametrize("case", ["odd", "few", "copies", "one", "many"])
def test_equal_to_plain_lloyd(spark, case):
    odd = [(900, None, 1, ""), (901, [], 1, ""), (902, [1.0] * 63, 1, ""), (903, [1.0] * 63 + [None], 1, ""), (904, [float("nan")] * 64, 1, ""), (905, [float("inf")] + [0.0] * 63, 1, ""), (906, [0.0] * 64, 1, ""), (None, [0.5] * 64, 1, ""), (3, [-0.0001] * 64, 1, ""), (3, [-0.0001] * 64, 1, "")]
    rows = {"odd": rows_of(120, 1) + odd, "few": rows_of(5, 2), "copies": rows_of(40, 3, copies=150), "one": [(i, [0.25] * 64, 0, "") for i in range(30)], "many": rows_of(BLOCK + 300, 4)}[case]
    got = cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_nothing_to_cluster(spark):
    assert cluster_vectors(spark.createDataFrame([(1, None, 1, "")], SCHEMA)).collect() == []


def test_components_beyond_a_long_are_an_error(spark):
    with pytest.raises(Exception, match="components of"):
        cluster_vectors(spark.createDataFrame([(1, [1e30] * 64, 1, "")], SCHEMA)).collect()
