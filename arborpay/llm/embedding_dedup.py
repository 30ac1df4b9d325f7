"""Near-duplicate vectors by an epsilon grid order join.

Equal vectors of a label are merged first; a representative carries their number, so a group of copies
costs one row. Unit vectors are turned onto their leading principal directions and sorted by grid cells
of width epsilon there. Intervals of that sequence are joined recursively: two intervals whose boxes are
more than epsilon apart hold no pair and are skipped with all they contain. Distances in the turned space
never exceed those in the full space, so nothing is lost. Of a pair of the smallest intervals (blocks)
only the vectors within epsilon of the other's box are sent on, once for all pairs of a tile, to be compared
in double precision. A tile gives a row per linked vector and a spanning set of links, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborpay.llm.common import Workspace, connected_components

#: Leading principal directions of the grid; vectors of a block; intervals that one joins in the next.
DIRECTIONS, BLOCK, FAN = 6, 512, 8
#: Blocks to a side of a tile: a block is sent once to each tile that has pairs of it.
TILE = 8
#: Vector lengths with directions of their own, and components that these are taken from; others keep their first components.
LENGTHS, COMPONENTS = 16, 1024
#: Vectors of a length that its directions are taken from, and their bytes.
DRAWN, DRAWN_BYTES = 4096, 1 << 26
_SPOT = ", ".join(f"lo{k} double, hi{k} double" for k in range(DIRECTIONS))
_BLOCKS = f"part int, block int, dim int, label string, rows int, keys binary, ids binary, copies binary, wide boolean, vectors binary, {_SPOT}"


def _narrow(v: np.ndarray) -> tuple[bool, bytes]:
    """Vectors as bytes: singles where they hold every value exactly, else doubles."""
    with np.errstate(over="ignore"):
        f = v.astype(np.float32)
    return (False, f.tobytes()) if (f == v).all() else (True, v.tobytes())


def _units(raw: bytes, wide: bool, dim: int) -> np.ndarray:
    """Rows of unit vectors in doubles; the largest component is scaled to 1 first, so no norm over- or underflows."""
    x = np.frombuffer(raw, np.float64 if wide else np.float32).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that can link: their bytes, and a 128-bit key of label and vector."""
    from xxhash import xxh128_digest

    for batch in batches:
        ids, labels, vectors = (c.to_pylist() for c in batch.columns)
        rows = []
        for i, l, x in zip(ids, labels, vectors, strict=True):
            if i is None or l is None or not x or None in x:
                continue
            v = np.asarray(x, np.float64)
            if np.isfinite(v).all() and v.any():
                v = v + 0.0  # one zero
                wide, raw = _narrow(v)
                rows.append((i, l, len(v), wide, raw, xxh128_digest(l.encode("utf-8", "surrogatepass") + b"\0" + raw)))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        types = (pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["vec_id", "label", "dim", "wide", "v", "key"])


_VALID = "vec_id long, label string, dim int, wide boolean, v binary, key binary"


def _turn(drawn: pa.Table) -> pa.Table:
    """The leading directions of the unit vectors of one length, leading first, as numbers in rows of DIRECTIONS."""
    dim = drawn.column("dim")[0].as_py()
    pairs = zip(drawn.column("wide").to_pylist(), drawn.column("v").to_pylist(), strict=True)
    x = np.stack([_units(raw, wide, dim)[0, :COMPONENTS] for wide, raw in pairs])
    x = x - x.mean(axis=0)
    _, vectors = np.linalg.eigh(x.T @ x)
    turn = np.zeros((x.shape[1], DIRECTIONS))  # vectors shorter than that have zeros in the directions they lack
    turn[:, : min(x.shape[1], DIRECTIONS)] = vectors[:, ::-1][:, :DIRECTIONS]
    return pa.table({"dim": pa.array([dim], pa.int32()), "turn": pa.array([turn.ravel().tolist()], pa.list_(pa.float64()))})


def principal_directions(valid: DataFrame) -> dict[int, np.ndarray]:
    """Leading directions of the commonest vector lengths, from about DRAWN of their vectors or DRAWN_BYTES, drawn by hash.

    They are a rotation: links are the same whatever it is, and blocks are apart the better the closer it is.
    """
    common = valid.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(LENGTHS).collect()
    place = F.xxhash64("vec_id", "key")
    taken = F.lit(False)
    for r in common:
        bound = max(1, min(DRAWN, DRAWN_BYTES // (8 * r["dim"])))
        taken = taken | ((F.col("dim") == r["dim"]) & (F.pmod(place, F.lit(r["n"])) < bound))
    drawn = valid.where(taken).dropDuplicates(["vec_id", "key"])  # a row that is there many times is drawn once
    turns = drawn.select("dim", "wide", "v").groupBy("dim").applyInArrow(_turn, "dim int, turn array<double>")
    # COMPONENTS * DIRECTIONS numbers at most, for LENGTHS lengths at most.
    return {r["dim"]: np.array(r["turn"]).reshape(-1, DIRECTIONS) for r in turns.collect()}


def _spots(units: np.ndarray, directions: dict[int, np.ndarray]) -> np.ndarray:
    """Places of unit vectors of one length in the turned space."""
    turn = directions.get(units.shape[1])
    if turn is None:
        turn = np.eye(min(units.shape[1], COMPONENTS), DIRECTIONS)
    return units[:, : len(turn)] @ turn


def _cells(directions: dict[int, np.ndarray], eps: float) -> Callable:
    """Adds the grid cell, as bytes that sort like the cell's numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for d, wide, raw in zip(*(batch.column(c).to_pylist() for c in ("dim", "wide", "v")), strict=True):
                at = np.floor(_spots(_units(raw, wide, d), directions)[0] / eps)
                cells.append((at + 2**31).astype(">u4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.binary())], [*batch.schema.names, "cell"])

    return run


def _cut(directions: dict[int, np.ndarray]) -> Callable:
    """Blocks of a sorted partition: rows of one label, length and width, with their box."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []  # (dim, label, wide, id, copies, bytes, key)

        def out() -> pa.RecordBatch:
            nonlocal made
            dim, label, wide = held[0][:3]
            raw = b"".join(h[5] for h in held)
            spots = _spots(_units(raw, wide, dim), directions)
            box = [[float(x)] for k in range(DIRECTIONS) for x in (spots[:, k].min(), spots[:, k].max())]
            row = [[part], [made], [dim], [label], [len(held)], [b"".join(h[6] for h in held)], [np.array([h[3] for h in held], np.int64).tobytes()], [np.array([h[4] for h in held], np.int64).tobytes()], [wide], [raw], *box]
            made += 1
            held.clear()
            types = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_(), pa.binary(), *[pa.float64()] * (2 * DIRECTIONS)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types, strict=True)], [c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("dim", "label", "wide", "rep", "n", "v", "key")), strict=True):
                if held and (held[0][:3] != row[:3] or len(held) >= BLOCK):
                    yield out()
                held.append(row)
        if held:
            yield out()

    return run


_SIDES = "i long, j long, own long, partners array<long>, dim int, wide boolean, keys binary, ids binary, copies binary, vectors binary"


def _sides(directions: dict[int, np.ndarray], eps: float) -> Callable:
    """Of a block and the box around its partners in a tile: the vectors within epsilon of that box."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                r = dict(zip(batch.schema.names, row, strict=True))
                wide, dim = r["wide"], r["dim"]
                keep = np.arange(r["rows"])
                if r["own"] not in r["partners"]:
                    spots = _spots(_units(r["vectors"], wide, dim), directions)
                    low, high = (np.array([r[f"{e}{k}"] for k in range(DIRECTIONS)]) for e in ("lo", "hi"))
                    gap = np.maximum(0, np.maximum(low - spots, spots - high))
                    keep = np.flatnonzero((gap**2).sum(axis=1) <= eps * eps)
                if len(keep):
                    part = [np.frombuffer(r[c], np.uint8).reshape(r["rows"], -1)[keep].tobytes() for c in ("keys", "ids", "copies", "vectors")]
                    rows.append((r["i"], r["j"], r["own"], r["partners"], dim, wide, *part))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 10
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], [c.split()[0] for c in _SIDES.split(", ")])

    return run


def _links(threshold: float) -> Callable:
    """Of the pairs of blocks of a tile: links of each vector, and links that join what is connected within it."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = b"".join(r["keys"] for r in rows)
        ids = np.concatenate([np.frombuffer(r["ids"], np.int64) for r in rows])
        copies = [np.frombuffer(r["copies"], np.int64) for r in rows]
        first = np.concatenate([[0], np.cumsum([len(c) for c in copies])])
        at = {r["own"]: k for k, r in enumerate(rows)}
        units = [_units(r["vectors"], r["wide"], r["dim"]) for r in rows]
        n, ends = np.zeros(len(ids), np.int64), []
        for k, r in enumerate(rows):
            for m in (at[o] for o in r["partners"] if o >= r["own"] and o in at):
                near = units[k] @ units[m].T >= threshold
                if k == m:
                    np.fill_diagonal(near, False)
                else:
                    n[first[m] : first[m + 1]] += near.T @ copies[k]
                n[first[k] : first[k + 1]] += near @ copies[m]
                a, b = np.nonzero(near)
                ends.append((a + first[k], b + first[m]))
        a, b = (np.concatenate([e[x] for e in ends]) if ends else np.empty(0, np.int64) for x in (0, 1))
        root = np.arange(len(ids))
        while len(a):  # smallest position within reach
            low = root.copy()
            np.minimum.at(low, a, root[b])
            np.minimum.at(low, b, root[a])
            low = low[low]
            if (low == root).all():
                break
            root = low
        linked = np.flatnonzero(n)
        return pa.table({"a": ids[linked], "b": ids[root[linked]], "n": n[linked], "key": pa.array([keys[16 * k : 16 * k + 16] for k in linked.tolist()], pa.binary())})

    return run


def embedding_duplicates(embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row; links at cosine >= threshold under the same label.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without label or
    vec_id, link with nothing; vectors of different lengths don't link. Copies link with each other.
    A row without vec_id has a null component and is kept. Rows that repeat a vec_id are vectors of
    their own whose links add up under that id. No rows give no rows; other columns are not read.
    """
    spark = embeddings.sparkSession
    ws = Workspace(spark, "embeddings")
    eps = float(np.sqrt(2 - 2 * threshold)) + 1e-9
    plain = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    valid = plain.mapInArrow(_valid, _VALID)
    members = ws.table(valid.select("vec_id", "key"), "members")
    directions = principal_directions(valid)

    # The sequence: by label and length, then grid cells, of one row for all equal vectors. Ranges of it go to
    # partitions, which cut it into blocks.
    merged = valid.groupBy("dim", "label", "wide", "v", "key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    turned = merged.mapInArrow(_cells(directions, eps), "dim int, label string, wide boolean, v binary, key binary, rep long, n long, cell binary")
    order = ["dim", "label", "wide", "cell", "rep", "key"]
    blocks = turned.repartitionByRange(max(1, -(-members.count() // (16 * BLOCK))), *order).sortWithinPartitions(*order)
    blocks = ws.table(blocks.mapInArrow(_cut(directions), _BLOCKS), "blocks")
    ahead = F.coalesce(F.sum("made").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = blocks.groupBy("part").agg(F.count("*").alias("made")).withColumn("ahead", ahead)  # one row per partition of 16 blocks
    boxes = blocks.drop("keys", "ids", "copies", "vectors").join(parts, "part").withColumn("no", (F.col("ahead") + F.col("block")).cast("long"))
    boxes = ws.table(boxes.drop("ahead", "made"), "boxes")

    pairs = _interval_join(ws, boxes, eps)
    numbered = blocks.select("part", "block", "dim", "wide", "rows", "keys", "ids", "copies", "vectors").join(boxes.select("part", "block", F.col("no").alias("own")), ["part", "block"]).drop("part", "block")
    far = boxes.select(F.col("no").alias("other"), *[f"{e}{k}" for k in range(DIRECTIONS) for e in ("lo", "hi")])
    tile = [F.floor(F.col(c) / TILE).cast("long").alias(c) for c in "ij"]
    sides = pairs.select(*tile, F.col("i").alias("own"), F.col("j").alias("other")).union(pairs.where("i <> j").select(*tile, F.col("j").alias("own"), F.col("i").alias("other")))
    around = [f(f"{e}{k}").alias(f"{e}{k}") for k in range(DIRECTIONS) for e, f in (("lo", F.min), ("hi", F.max))]
    sides = sides.join(far, "other").groupBy("i", "j", "own").agg(F.collect_set("other").alias("partners"), *around)  # TILE partners at most, twice that where i = j
    sides = sides.join(numbered, "own").mapInArrow(_sides(directions, eps), _SIDES)
    found = ws.table(sides.groupBy("i", "j").applyInArrow(_links(threshold), "a long, b long, n long, key binary"), "links")

    # Back from representatives to rows: a row links with its copies and with what its representative links with.
    counts = found.groupBy("key").agg(F.sum("n").alias("more"))
    reps = members.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    placed = ws.table(members.join(reps, "key").select("vec_id", "rep", "key", "n"), "placed")
    counted = placed.join(counts, "key", "left")
    counted = counted.groupBy("vec_id").agg(F.sum(F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.min("rep").alias("rep"), F.max("rep").alias("last"))
    counted = ws.table(counted, "counted")
    split = counted.where("rep <> last").select("vec_id").join(placed, "vec_id").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    roots = connected_components(ws, found.select("a", "b").union(split))
    out = plain.select("vec_id").join(counted.select("vec_id", "n_links", "rep"), "vec_id", "left").join(roots.withColumnRenamed("v", "rep"), "rep", "left")
    component = F.coalesce("root", "rep", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def _interval_join(ws: Workspace, boxes: DataFrame, eps: float) -> DataFrame:
    """(i, j): pairs of blocks of one label and length, i <= j, whose boxes may hold vectors within eps.

    Intervals of FAN**level blocks are joined from the largest down; only pairs whose labels overlap and
    whose boxes come near each other are taken apart into the pairs of their FAN parts.
    """
    most = boxes.agg(F.max("no")).first()[0]
    if most is None:
        return ws.spark.createDataFrame([], "i long, j long")
    top = 0
    while FAN**top <= most:
        top += 1
    pairs = ws.spark.range(1).select(F.col("id").alias("i"), F.col("id").alias("j"))
    parts = F.sequence(F.lit(0), F.lit(FAN - 1))
    own = boxes.withColumn("first", F.struct("dim", "label")).withColumn("last", F.struct("dim", "label"))
    sides = ["first", "last", *[f"{e}{d}" for d in range(DIRECTIONS) for e in ("lo", "hi")]]
    for level in range(top, -1, -1):
        size = FAN**level
        wide = own.groupBy(F.floor(F.col("no") / size).cast("long").alias("k")).agg(*[(F.min if c.startswith(("first", "lo")) else F.max)(c).alias(c) for c in sides])
        if level < top:
            kids = pairs.select((F.col("i") * FAN).alias("i0"), (F.col("j") * FAN).alias("j0"))
            pairs = kids.withColumn("x", F.explode(parts)).withColumn("y", F.explode(parts)).select((F.col("i0") + F.col("x")).alias("i"), (F.col("j0") + F.col("y")).alias("j")).where("i <= j")
        a = wide.select(F.col("k").alias("i"), *[F.col(c).alias(f"{c}_a") for c in sides])
        b = wide.select(F.col("k").alias("j"), *[F.col(c).alias(f"{c}_b") for c in sides])
        near = pairs.join(a, "i").join(b, "j").where("first_a <= last_b and first_b <= last_a")
        gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"lo{d}_a") - F.col(f"hi{d}_b"), F.col(f"lo{d}_b") - F.col(f"hi{d}_a")), 2) for d in range(DIRECTIONS)), F.lit(0.0))
        pairs = ws.table(near.where(gap <= eps * eps).select("i", "j"), "pairs")
    return pairs
