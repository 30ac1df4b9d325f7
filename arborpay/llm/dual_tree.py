"""Exact centroid clustering by dual-tree Lloyd.

Vectors become integers, are gathered into blocks, and each block gets a cover tree, written once. In every
round a tree over the centroids is walked against all these trees at once: a pair of nodes is dropped where
its distance bound shows that another centroid is nearer to everything below, a node with one centroid left
is counted whole from the sums of its vectors, and what reaches the leaves is compared exactly. The driver
sees a row per centroid and round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborpay.llm.common import Workspace

#: Vectors of a block and of a leaf.
BLOCK, LEAF = 1024, 8
#: Components from here on have squared distances that a long can't hold.
LARGEST = 2**27


class Tree(NamedTuple):
    """A cover tree. Nodes go level by level; a node's children stand together, and so do its points."""

    order: np.ndarray  # the points' numbers, in tree order
    center: np.ndarray  # position of each node's center in that order; a center is a point of the node
    radius: np.ndarray  # largest distance of a point of the node from its center
    low: np.ndarray  # the node's points in tree order, low to high
    high: np.ndarray
    child: np.ndarray  # first child
    kids: np.ndarray  # number of children, 0 for a leaf


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of integer rows, exact."""
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree of some integer vectors.

    A node covers its points by a net of half its radius: its own center, then the first point that no
    center covers, until all are covered; centers of a net are more than half the radius apart.
    """
    order = np.arange(len(points))
    rows: list[list] = []
    todo = [(0, len(points))]
    nodes = 0
    while todo:
        level = []
        for low, high in todo:
            own = order[low:high]
            square = _squares(points[own], points[own[0]])
            far = int(square.max())
            row = [low, float(np.sqrt(far)), low, high, 0, 0]
            rows.append(row)
            if high - low <= leaf or (far == 0 and leaf > 1):
                continue
            groups = []
            if far == 0:  # equal points that have to come apart
                groups = [own[k : k + 1] for k in range(len(own))]
            while not groups or len(own):
                if far == 0:
                    break
                near = 4 * square <= far
                groups.append(own[near])
                own = own[~near]
                if len(own):
                    square = _squares(points[own], points[own[0]])
            row[4], row[5] = len(level), len(groups)
            at = low
            for g in groups:
                order[at : at + len(g)] = g
                level.append((at, at + len(g)))
                at += len(g)
        first = len(rows)  # children follow all nodes of this level
        for row in rows[nodes:]:
            row[4] += first
        nodes, todo = first, level
    center, radius, low, high, child, kids = (np.array(c) for c in zip(*rows, strict=True))
    return Tree(order, center.astype(np.int64), radius.astype(np.float64), low.astype(np.int64), high.astype(np.int64), child.astype(np.int64), kids.astype(np.int64))


def assign(points: np.ndarray, tree: Tree, centroids: np.ndarray, top: Tree) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (low, high, centroid) of ranges of the points, in tree order, whose nearest centroid is settled.

    ``points`` are in tree order. All pairs of nodes of a depth are bounded together. A tie goes to the
    centroid with the smaller number, so pairs within rounding of a tie are never dropped.
    """
    n, m = np.zeros(1, np.int64), np.zeros(1, np.int64)
    numbers = top.order
    ranked = centroids[numbers]
    while len(n):
        d = np.sqrt(_squares(points[tree.center[n]], ranked[top.center[m]]).astype(np.float64))
        best = np.full(len(tree.low), np.inf)
        np.minimum.at(best, n, d + tree.radius[n])
        keep = d - tree.radius[n] - top.radius[m] <= best[n] * (1 + 1e-9) + 1e-6
        n, m = n[keep], m[keep]
        left = np.bincount(n, minlength=len(tree.low))
        alone = (left[n] == 1) & (top.kids[m] == 0)
        if alone.any():
            yield tree.low[n[alone]], tree.high[n[alone]], numbers[top.low[m[alone]]]
            n, m = n[~alone], m[~alone]
        inner = np.zeros(len(tree.low), bool)  # nodes one of whose centroid nodes isn't a leaf
        inner[n[top.kids[m] > 0]] = True
        bottom = (tree.kids[n] == 0) & ~inner[n]
        if bottom.any():
            order = np.argsort(n[bottom], kind="stable")
            pair_n, pair_m = n[bottom][order], m[bottom][order]
            size = tree.high[pair_n] - tree.low[pair_n]
            at = np.repeat(tree.low[pair_n] - np.cumsum(size) + size, size) + np.arange(size.sum())
            number = np.repeat(numbers[top.low[pair_m]], size)
            by = np.lexsort((number, _squares(points[at], centroids[number]), at))
            first = by[np.unique(at[by], return_index=True)[1]]
            yield at[first], at[first] + 1, number[first]
            n, m = n[~bottom], m[~bottom]
        n, m = _opened(n, m, top.child, top.kids)
        m, n = _opened(m, n, tree.child, tree.kids)


def _opened(stay: np.ndarray, go: np.ndarray, child: np.ndarray, kids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs with each node of ``go`` replaced by its children; leaves stay."""
    size = np.maximum(kids[go], 1)
    offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    first = np.where(kids[go] > 0, child[go], go)
    return np.repeat(stay, size), np.repeat(first, size) + offset


_BLOCKS = "ids array<long>, points binary, center binary, radius binary, low binary, high binary, child binary, kids binary"


def _grow(dim: int) -> Callable:
    """Blocks of a partition's vectors, each with its tree."""

    def out(ids: list, points: np.ndarray) -> pa.RecordBatch:
        tree = cover_tree(points)
        row = [[ids[k] for k in tree.order.tolist()], points[tree.order].astype("<i4").tobytes(), *(x.tobytes() for x in tree[1:])]
        return pa.RecordBatch.from_arrays([pa.array([row[0]], pa.list_(pa.int64())), *(pa.array([x], pa.binary()) for x in row[1:])], [c.split()[0] for c in _BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            held.append(batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim))
            if len(ids) >= BLOCK:
                points = np.concatenate(held)
                whole = len(ids) // BLOCK * BLOCK
                for at in range(0, whole, BLOCK):
                    yield out(ids[at : at + BLOCK], points[at : at + BLOCK])
                ids, held = ids[whole:], [points[whole:]]
        if ids:
            yield out(ids, np.concatenate(held))

    return run


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray, Tree]]:
    for batch in batches:
        for k in range(batch.num_rows):
            raw = [batch.column(c)[k].as_py() for c in range(1, batch.num_columns)]
            points = np.frombuffer(raw[0], "<i4").reshape(-1, dim).astype(np.int64)
            radius = np.frombuffer(raw[2], np.float64)
            yield batch.column(0)[k].values, points, Tree(np.arange(len(points)), np.frombuffer(raw[1], np.int64), radius, *(np.frombuffer(x, np.int64) for x in raw[3:]))


def _sums(centroids: np.ndarray) -> Callable:
    """Of a partition: number and sum of the vectors nearest to each centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = centroids.shape
        top, count, total = cover_tree(centroids, 1), np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, points, tree in _blocks(batches, dim):
            ahead = np.concatenate([np.zeros((1, dim), np.int64), np.cumsum(points, axis=0)])
            for low, high, number in assign(points, tree, centroids, top):
                np.add.at(count, number, high - low)
                np.add.at(total, number, ahead[high] - ahead[low])
        there = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(count[there]), pa.array(total[there].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    return run


def _places(centroids: np.ndarray) -> Callable:
    """Each vector's cluster and squared distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = cover_tree(centroids, 1)
        for ids, points, tree in _blocks(batches, centroids.shape[1]):
            cluster = np.zeros(len(points) + 1, np.int64)
            for low, high, number in assign(points, tree, centroids, top):  # ranges don't overlap
                np.add.at(cluster, low, number)
                np.subtract.at(cluster, high, number)
            cluster = np.cumsum(cluster[:-1])
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(_squares(points, centroids[cluster]))], ["vec_id", "cluster", "distance"])

    return run


def cluster_vectors(embeddings: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: str = "3:") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector of ``dim`` finite components.

    Other rows are left out: vectors that are null, empty, of another length, or hold null or non-finite
    components. Rows that repeat a vec_id, or have none, are vectors of their own; those without vec_id are
    the last to seed a centroid, and rows with one vec_id seed in the order of their components. Fewer
    vectors than ``k`` are that many centroids; no vectors give no rows. Components of LARGEST or more,
    scaled, end the job with an error, as squared distances would no longer fit a long. Other columns are
    not read.
    """
    spark = embeddings.sparkSession
    ws = Workspace(spark, "lloyd")
    sound = "embedding is not null and size(embedding) = {0} and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))".format(dim)
    wide = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(sound)
    large = f"raise_error('components of {LARGEST} or more')"
    whole = wide.select("vec_id", F.expr(f"transform(embedding, x -> if(abs(x) * {scale} >= {LARGEST - 1}, cast({large} as bigint), floor(x * {scale})))").alias("v"))
    first = whole.orderBy(F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "v").limit(k)
    centroids = np.array([r["v"] for r in first.select("v").collect()], np.int64).reshape(-1, dim)  # k rows
    trees = ws.table(whole.mapInArrow(_grow(dim), _BLOCKS), "trees")
    for _ in range(rounds if len(centroids) else 0):
        parts = trees.mapInArrow(_sums(centroids), "cluster int, n long, total array<long>")
        new = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(dim)])
        moved = centroids.copy()
        for r in new.collect():  # k rows
            moved[r["cluster"]] = [r[f"t{i}"] // r["n"] for i in range(dim)]
        if (moved == centroids).all():  # every later round would find the same
            break
        centroids = moved
    shas = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    if not shas:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    placed = ws.table(trees.mapInArrow(_places(centroids), "vec_id long, cluster int, distance long"), "placed")
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows
    by = {r["cluster"]: r["cluster_inertia"] for r in sums}
    named = spark.createDataFrame([(c, by[c], sum(by.values()), shas[c]) for c in by], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
