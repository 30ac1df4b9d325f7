"""Nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample; every row is put into the leaf that a descent by nearest
centroid reaches. A query walks the tree through a priority queue of its distances to the nodes and
takes leaves in the order they come out. How many leaves are visited is calibrated: for a bounded set
of calibration queries the exact neighbours are found among all rows, and the number widens until so
large a share of them lies in the visited leaves. Neighbours equal to their query are easy and don't
count there. A walk also goes on until its leaves hold as many candidates as are asked for.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborpay.llm.common import Workspace

#: Rows that the tree is fitted on, at least and for each leaf, and their bytes at most; children of a node; calibration queries and the recall they must reach.
SAMPLE, PER_LEAF, SAMPLE_BYTES, BRANCH, CALIBRATION, RECALL = 8192, 4, 1 << 26, 8, 128, 0.97
#: Most leaves, so that the tree stays small enough to be sent to every task; twice the root of the rows up to then.
MOST_LEAVES = 32_768
#: Rows of one block of a leaf, and queries that meet a block in one task.
BLOCK, ASKED = 2048, 4096


@dataclass
class Tree:
    """Nodes by number, the root first; ``leaf`` is the number of a leaf or -1."""

    centroids: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0
    of_children: dict[int, np.ndarray] = field(default_factory=dict)

    def add(self, centroid: np.ndarray) -> int:
        self.centroids.append(centroid)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.leaf) - 1

    def around(self, node: int) -> np.ndarray:
        """Centroids of a node's children, kept once asked for."""
        if node not in self.of_children:
            self.of_children[node] = np.stack([self.centroids[k] for k in self.children[node]])
        return self.of_children[node]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row, by descent."""
        out = np.full(len(x), -1)
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            kids = self.children[node]
            c = self.around(node)
            near = ((c**2).sum(axis=1) - 2 * x[rows] @ c.T).argmin(axis=1)
            stack += [(k, rows[near == i]) for i, k in enumerate(kids)]
        return out

    def order(self, q: np.ndarray, visits: int, sizes: np.ndarray | None = None, wanted: int = 0) -> list[int]:
        """Leaves in the order a best-bin-first walk reaches them: so many, and until they hold as many rows as wanted."""
        queue, out, held = [(0.0, 0)], [], 0
        while queue and (len(out) < visits or held < wanted):
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
                held += int(sizes[self.leaf[node]]) if sizes is not None else 0
            elif self.children[node]:
                for k, d in zip(self.children[node], ((self.around(node) - q) ** 2).sum(axis=1).tolist(), strict=True):
                    heapq.heappush(queue, (d, k))
        return out


def fit_tree(sample: np.ndarray, leaves: int, seed: int = 4) -> Tree:
    """Split the fullest node into BRANCH clusters until there are so many leaves."""
    rng = np.random.default_rng(seed)
    tree = Tree()
    width = sample.shape[1]
    root = tree.add(sample.mean(axis=0) if len(sample) else np.zeros(width))
    queue, done = [(-len(sample), root, np.arange(len(sample)))], []
    while queue and len(queue) + len(done) < leaves:
        _, node, rows = heapq.heappop(queue)
        x = sample[rows]
        if len(rows) <= BRANCH or not (x != x[0]).any():
            done.append(node)
            continue
        c = x[rng.choice(len(x), BRANCH, replace=False)]
        for _ in range(8):
            near = ((c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
            c = np.stack([x[near == k].mean(axis=0) if (near == k).any() else c[k] for k in range(len(c))])
        near = ((c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        if (near == near[0]).all():
            done.append(node)
            continue
        for k in range(len(c)):
            if (near == k).any():
                kid = tree.add(c[k])
                tree.children[node].append(kid)
                heapq.heappush(queue, (-int((near == k).sum()), kid, rows[near == k]))
    for node in sorted([*done, *(n for _, n, _ in queue)]):
        tree.leaf[node] = tree.leaves
        tree.leaves += 1
    return tree


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if i is None or not x or None in x:
                continue
            v = np.asarray(x, np.float64)
            if np.isfinite(v).all() and v.any():
                rows.append((i, len(v), v.tobytes()))
        cols = list(zip(*rows, strict=True)) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], ["vec_id", "dim", "v"])


def _matrix(column, width: int) -> np.ndarray:
    """Rows of doubles, zeros where a vector is shorter than the longest."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(r.ljust(8 * width, b"\0") for r in raw), np.float64).reshape(len(raw), width)


def _assigner(tree: Tree, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(_matrix(batch.column(2), width)) if len(batch) else np.empty(0, int)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(leaf.astype(np.int32))], ["vec_id", "v", "leaf"])

    return run


def _nearest(q: np.ndarray, own: int, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of the k nearest rows with another id; ties to smaller ids."""
    d = np.sqrt(((x - q) ** 2).sum(axis=1))
    rows = np.flatnonzero(ids != own)
    rows = rows[np.lexsort((ids[rows], d[rows]))[:k]]
    return rows, d[rows]


def _brute(queries: list[tuple[int, bytes]], width: int, k: int) -> Callable:
    """The nearest rows of each calibration query within a batch, with their leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            ids, x, leaf = batch.column(0).to_numpy(), _matrix(batch.column(1), width), batch.column(2).to_numpy()
            rows = []
            for own, raw in queries:
                near, d = _nearest(np.frombuffer(raw.ljust(8 * width, b"\0"), np.float64), own, x, ids, k)
                rows.append((own, [{"score": float(s), "leaf": int(leaf[i])} for i, s in zip(near, d, strict=True)]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.list_(pa.struct([("score", pa.float64()), ("leaf", pa.int32())])))], ["query_id", "near"])

    return run


def _walker(tree: Tree, width: int, visits: int, sizes: np.ndarray, wanted: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                leaves = tree.order(np.frombuffer(raw.ljust(8 * width, b"\0"), np.float64), visits, sizes, wanted)
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(leaves), pa.int64()), pa.array(leaves, pa.int32())], ["query_id", "leaf"])

    return run


def _searcher(width: int, k: int) -> Callable:
    near = pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())]))

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out_q, out = [], []
        if queries.num_rows and rows.num_rows:
            ids, x = rows.column("vec_id").to_numpy(), _matrix(rows.column("v"), width)
            for own, q in zip(queries.column("query_id").to_pylist(), _matrix(queries.column("q"), width), strict=True):
                at, d = _nearest(q, own, x, ids, k)
                out_q.append(own)
                out.append([{"score": float(s), "vec_id": int(ids[i])} for i, s in zip(at, d, strict=True)])
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "near": pa.array(out, near)})

    return run


def _first_copies(rows: DataFrame, k: int) -> DataFrame:
    """rows (vec_id, v, ...) without copies that no list of k can hold.

    Ties go to smaller ids, so of equal vectors the k smallest ids but a query's own suffice, and of one id's
    copies k. Both limits apply before rows are shuffled as well, so a vector that is everywhere is no hot group.
    """
    of_id = Window.partitionBy("v", "vec_id").orderBy("dim")
    of_vector = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(of_id)).where(F.col("_n") <= k)
    return few.withColumn("_n", F.dense_rank().over(of_vector)).where(F.col("_n") <= k + 1).drop("_n")


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score, visits, trial_recall): the k nearest vectors found for each query, by Euclidean distance.

    ``visits`` is the calibrated number of leaves, ``trial_recall`` the share of the calibration queries'
    exact neighbours in them (null where none differ from their query).
    Both frames need vec_id and embedding. A query's own id is no candidate. Vectors that are null,
    empty, zero or hold null or non-finite components, and rows without vec_id, take no part; shorter
    vectors count as filled up with zeros. Ties go to the smaller vec_id. Repeated ids are candidates of
    their own; of a query id that repeats, one row is asked. No vectors or no queries give no rows;
    other columns are not read.
    """
    spark = vectors.sparkSession
    ws = Workspace(spark, "neighbours")

    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(_valid, "vec_id long, dim int, v binary")

    rows = ws.table(_first_copies(clean(vectors), k), "vectors")
    asked = ws.table(clean(queries).groupBy("vec_id").agg(F.min("v").alias("q")), "queries")
    n, width = rows.agg(F.count("*"), F.max("dim")).first()
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, visits int, trial_recall double")
    if not n or asked.isEmpty():
        return none
    leaves = int(min(MOST_LEAVES, max(1, 2 * n**0.5)))
    bound = max(1, min(max(SAMPLE, PER_LEAF * leaves), SAMPLE_BYTES // (8 * width)))
    # By hash, so that no task sorts or holds more than its part of the sample: about ``bound`` rows in all.
    drawn = rows.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)) < bound).select("v").toArrow()
    tree = fit_tree(_matrix(drawn.sort_by("v").column("v"), width), leaves)
    placed = ws.table(rows.mapInArrow(_assigner(tree, width), "vec_id long, v binary, leaf int"), "placed")

    trial = [(r["vec_id"], bytes(r["q"])) for r in asked.groupBy("q").agg(F.min("vec_id").alias("vec_id")).orderBy(F.xxhash64("vec_id")).limit(CALIBRATION).collect()]
    exact = placed.mapInArrow(_brute(trial, width, k), "query_id long, near array<struct<score: double, leaf: int>>")
    exact = exact.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near")).collect()
    ranks = []
    asked_by = dict(trial)
    for r in exact:
        place = {leaf: at for at, leaf in enumerate(tree.order(np.frombuffer(asked_by[r["query_id"]].ljust(8 * width, b"\0"), np.float64), tree.leaves))}
        ranks += [place[x["leaf"]] for x in r["near"] if x["score"] > 0]
    ranks.sort()
    visits = 1 + (ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)] if ranks else 0)
    reached = float(np.mean(np.array(ranks) < visits)) if ranks else None
    held = placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()  # one row per leaf, at most MOST_LEAVES
    in_leaf = np.zeros(tree.leaves, np.int64)
    in_leaf[[r["leaf"] for r in held]] = [r["n"] for r in held]

    # Large leaves are cut into blocks, and queries that visit one leaf into parts: every part meets every block.
    walks = asked.withColumnRenamed("vec_id", "query_id").select("query_id", "q")
    # Up to k rows may be the query's own.
    visited = ws.table(walks.mapInArrow(_walker(tree, width, visits, in_leaf, 2 * k + 1), "query_id long, leaf int"), "walks")
    sizes = placed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    parts = visited.groupBy("leaf").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("parts"))
    sizes = F.broadcast(sizes.join(parts, "leaf"))  # one row per leaf that is visited, at most MOST_LEAVES

    def each(number: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(number) - 1))

    own = F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int").alias("block")
    placed = placed.join(sizes, "leaf").select("leaf", own, each("parts").alias("part"), "vec_id", "v")
    part = F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("part")
    walks = visited.join(sizes, "leaf").select("leaf", "blocks", part, "query_id").join(walks, "query_id").select("leaf", each("blocks").alias("block"), "part", "query_id", "q")
    at = ("leaf", "block", "part")
    near = walks.groupBy(*at).cogroup(placed.groupBy(*at)).applyInArrow(_searcher(width, k), "query_id long, near array<struct<score: double, vec_id: long>>")
    best = near.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    return best.select("query_id", F.posexplode("near").alias("pos", "x")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"), F.lit(visits).cast("int").alias("visits"), F.lit(reached).cast("double").alias("trial_recall"))
