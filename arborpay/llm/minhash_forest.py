"""Near-duplicate documents by an LSH forest over MinHash signatures.

The forest keeps several sorted orders of the signatures (trees), each over hash functions of its own. In
each, neighbours with the longest common prefix are the first candidates; links among them, confirmed on
the full sets, give a first set of components. A region is a run of rows with a common prefix: of
``DEPTHS[0]`` values at first, and of more where a region has so many pairs from different components
that comparing them would be too much. Pairs across components of a region that is small enough are
compared. Before that, a few trees give each such comparison's spanning forest alone, its most similar
pairs first: a group of near copies becomes one component by as many pairs as it has rows, and what is then
compared whole is what still stands in different components, each pair in the first tree that has it. At a similarity of 0.75 a pair shares no region of the least depth with probability
(1 - 0.75**4)**40 = 2.5e-7, and its estimate is too low for a confirmation with 2e-4.

What deepening takes apart is found in an exact way: documents of deepened regions are joined on the
rarest of their shingles, as many as two sets of that similarity can't both lack (prefix filtering). So a
passage that very many documents share makes a region deep, but takes no pair out of the search, and none
of them are compared all with all.

Copies with the same set of shingles are merged before the forest, so a group of exact copies costs
one row, however large it is.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborpay.llm.common import BROADCAST_IDS, Workspace, connected_components
from arborpay.llm.text import canonical, shingles

WORDS, NUM, DEN = 5, 75, 100
#: Trees, and values of each one's order; every value has a hash function of its own.
TREES, ORDER = 40, 12
HASHES = TREES * ORDER
#: Lengths of the prefix of a region, the next where the one before leaves too much; pairs across components that are compared in one region.
DEPTHS, CROWD = (4, 6, 8, 12), 1 << 20
#: Trees whose regions are first searched for forests.
FOREST_TREES = 8
#: Pairs across components whose estimated similarity is under this are not confirmed: 3.5 standard deviations under 0.75.
ESTIMATE = 0.68
#: Rows of a block of a region; bits of the buckets in which shingles are counted for the exact way.
BLOCK, RARE_BITS = 512, 18
#: From here on vertices stand for texts of doc_ids that have several.
ALIAS = 1 << 62
_A = np.random.default_rng(7).integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = np.random.default_rng(8).integers(0, 2**32, HASHES, dtype=np.uint32)


def signature(values: np.ndarray) -> bytes:
    """The low 16 bits of the MinHash values of a set of hashes."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (values >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 256):
        with np.errstate(over="ignore"):
            h = x[at : at + 256, None] * _A
            h ^= _B
        np.minimum(low, h.min(axis=0), out=low)
    return low.astype("<u2").tobytes()


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), HASHES)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh128_digest

    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            keys, sizes, sigs = [], [], []
            for text in part.column(1).to_pylist():
                s = shingles(canonical(text), WORDS)
                keys.append(xxh128_digest(s.tobytes()) if len(s) else None)
                sizes.append(len(s))
                sigs.append(signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())], ["doc_id", "set_key", "n_shingles", "sig"])


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document and tree: its values, four to a number, the first in the highest bits."""
    for batch in batches:
        for at in range(0, len(batch), 1024):
            part = batch.slice(at, 1024)
            n = len(part)
            four = _signatures(part.column(1)).reshape(n, TREES, ORDER // 4, 4).astype(np.int64)
            packed = four[..., 0] << 48 | four[..., 1] << 32 | four[..., 2] << 16 | four[..., 3]
            tree = np.repeat(np.arange(TREES, dtype=np.int32), n)
            values = [pa.array(packed[:, :, k].T.ravel()) for k in range(ORDER // 4)]
            yield pa.RecordBatch.from_arrays([pa.array(tree), *values, pa.array(np.tile(part.column(0).to_numpy(zero_copy_only=False), TREES))], ["tree", "v1", "v2", "v3", "doc"])


def _prefix(depth: int) -> list[F.Column]:
    """The values of a prefix, as columns p1 to p3."""
    out = []
    for k in range(3):
        left = min(4, max(0, depth - 4 * k))
        out.append((F.shiftright(f"v{k + 1}", 16 * (4 - left)) if left else F.lit(0)).cast("long").alias(f"p{k + 1}"))
    return out


CROWDED = "tree int, v1 long, v2 long, v3 long, doc long, before long, common int"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of regions of the least depth with more than one row, each with its predecessor and how many values they share.

    The first and the last row of a partition stay as well: their regions may go on elsewhere.
    """
    held = None  # the last row so far, and whether it has to be given out
    names = [c.split()[0] for c in CROWDED.split(", ")]

    def out(rows: np.ndarray) -> pa.RecordBatch:
        cols = [pa.array(rows[:, k], mask=rows[:, 6] < 0) if k == 5 else pa.array(rows[:, k].astype(np.int32) if k in (0, 6) else rows[:, k]) for k in range(7)]
        return pa.RecordBatch.from_arrays(cols, names)

    for batch in batches:
        if not len(batch):
            continue
        new = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
        rows = new if held is None else np.concatenate([held[None, :5], new])
        equal = rows[1:, 0] == rows[:-1, 0]
        common = np.zeros(len(rows) - 1, np.int64)
        for k in range(12):
            shift = 16 * (3 - k % 4)
            equal = equal & (rows[1:, 1 + k // 4] >> shift == rows[:-1, 1 + k // 4] >> shift)
            common += equal
        same = common >= DEPTHS[0]
        full = np.concatenate([rows, np.full((len(rows), 2), -1, np.int64)], axis=1)
        full[1:, 5], full[1:, 6] = np.where(same, rows[:-1, 4], -1), np.where(same, common, -1)
        wanted = np.zeros(len(rows), bool)
        wanted[1:] = same
        wanted[:-1] |= same
        if held is None:
            wanted[0] = True
        else:
            full[0, 5:7] = held[5:7]
            wanted[0] |= bool(held[7])
        yield out(full[:-1][wanted[:-1]])
        held = np.append(full[-1], int(wanted[-1]))
    if held is not None:
        yield out(held[None, :7])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([pack(canonical(t)) for t in part.column(1).to_pylist()], pa.binary())], ["doc", "packed"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets reach the similarity, in integers."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    recent: dict[int, np.ndarray] = {}

    def full(doc: int, packed) -> np.ndarray:
        got = recent.get(doc)
        if got is None:
            if len(recent) > 500:
                recent.clear()
            got = recent[doc] = shingles(unpack(packed.as_py()), WORDS)
        return got

    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keep = []
        for i, (x, y) in enumerate(zip(a, b, strict=True)):
            u, v = full(x, batch.column(2)[i]), full(y, batch.column(3)[i])
            if min(len(u), len(v)) * DEN < NUM * max(len(u), len(v)):
                continue
            both = len(np.intersect1d(u, v, assume_unique=True))
            if DEN * both >= NUM * (len(u) + len(v) - both):
                keep.append(i)
        yield batch.take(pa.array(keep, pa.int64())).select([0, 1])


def _spanning(a: np.ndarray, b: np.ndarray, near: np.ndarray, comp_a: np.ndarray, comp_b: np.ndarray) -> np.ndarray:
    """Places of the pairs that join components which more similar pairs haven't joined: fewer than there are components."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    keep = []
    order = np.lexsort((b, a, -near))
    for k, x, y in zip(order.tolist(), comp_a[order].tolist(), comp_b[order].tolist(), strict=True):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
            keep.append(k)
    return np.array(keep, np.int64)


def _similar(table: pa.Table, forest: bool = False, once: bool = False) -> pa.Table:
    """Pairs of a block pair from different components with similar signatures, or a spanning forest of them.

    With ``once``, of regions of the least depth, a pair only comes from the first tree that has it in a region.
    """
    doc = table.column("doc").to_numpy()
    comp = table.column("comp").to_numpy()
    size = table.column("n_shingles").to_numpy()
    side = table.column("block").to_numpy()
    i0, j0 = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    sig = _signatures(table.column("sig"))
    tree = table.column("tree")[0].as_py() if once else None
    left, right = np.flatnonzero(side == i0), np.flatnonzero(side == j0)
    empty = np.empty(0, np.int64)
    xs, ys, nears = [empty], [empty], [empty]
    for k, x in enumerate(left):
        others = right[k + 1 :] if i0 == j0 else right
        others = others[comp[others] != comp[x]]
        low, high = np.minimum(size[others], size[x]), np.maximum(size[others], size[x])
        others = others[low * DEN >= NUM * high]
        if len(others):
            near = (sig[others] == sig[x]).sum(axis=1)
            good = near >= ESTIMATE * HASHES
            others, near = others[good], near[good]
            if once:
                heads = (sig[others] == sig[x]).reshape(len(others), TREES, ORDER)[:, :, : DEPTHS[0]].all(axis=2)
                good = heads.argmax(axis=1) == tree
                others, near = others[good], near[good]
            xs.append(np.full(len(others), x))
            ys.append(others)
            nears.append(near)
    x, y = np.concatenate(xs), np.concatenate(ys)
    a, b = np.minimum(doc[x], doc[y]), np.maximum(doc[x], doc[y])
    if forest:
        keep = _spanning(a, b, np.concatenate(nears), comp[x], comp[y])
        a, b = a[keep], b[keep]
    return pa.table({"a": a, "b": b})


def _across(table: pa.Table) -> pa.Table:
    return _similar(table)


def _once(table: pa.Table) -> pa.Table:
    return _similar(table, once=True)


def _likeliest(table: pa.Table) -> pa.Table:
    return _similar(table, forest=True)


def _full_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for doc, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        yield doc, shingles(unpack(packed), WORDS)


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles of the sets fall into each bucket."""
    sums = np.zeros(1 << RARE_BITS, np.int64)
    for batch in batches:
        for _, values in _full_sets(batch):
            np.add.at(sums, (values >> np.uint64(64 - RARE_BITS)).astype(np.int64), 1)
    at = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["bucket", "n"])


def _rarest(counts: np.ndarray) -> Callable:
    """(key, doc): of each set the rarest shingles, one more than a set of the wanted similarity can lack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, values in _full_sets(batch):
                order = np.lexsort((values, counts[(values >> np.uint64(64 - RARE_BITS)).astype(np.int64)]))
                keys = values[order[: len(values) - -(-len(values) * NUM // DEN) + 1]]
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), doc, np.int64))], ["key", "doc"])

    return run


def _with_set_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh128_digest

    for batch in batches:
        keys = [xxh128_digest(s.tobytes()) if len(s) else None for s in (shingles(canonical(t), WORDS) for t in batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], ["doc_id", "text", "set_key"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each document, links at 100 * common >= 75 * union.

    ``docs`` needs doc_id and text; other columns are not read. Null and empty texts, and texts
    without words, have no shingles and link with nothing. Rows that repeat a doc_id each give a
    row with the size of its own set; they are in one component, each text with its own links. A row
    without doc_id is a component of its own, with a null component_id and kept true. doc_ids are under
    2**62. No rows give no rows.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "minhash")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = ws.table(plain.mapInArrow(_sketch, "doc_id long, set_key binary, n_shingles long, sig binary"), "sketch")
    known = sketches.where("set_key is not null and doc_id is not null")

    # One vertex for all rows with the same set: the smallest doc_id, or an alias where that has several sets.
    reps = known.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    several = ws.table(known.select("doc_id", "set_key").distinct().groupBy("doc_id").count().where("count > 1").select("doc_id"), "several")
    alias = F.lit(ALIAS) + F.shiftrightunsigned(F.xxhash64("set_key"), 3)
    reps = reps.join(several.select(F.col("doc_id").alias("rep"), F.lit(True).alias("more")), "rep", "left")
    reps = ws.table(reps.select("set_key", "rep", F.when(F.col("more"), alias).otherwise(F.col("rep")).alias("doc")), "reps")
    member = ws.table(known.select("doc_id", "set_key").join(reps, "set_key").select("doc_id", "doc").distinct(), "member")
    copies = member.where("doc_id <> doc").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    firsts = reps.select("set_key", F.col("rep").alias("doc_id"), "doc")
    signed = ws.table(known.join(firsts, ["set_key", "doc_id"]).dropDuplicates(["doc"]).select("doc", "n_shingles", "sig"), "signed")

    # The sorted orders, and the neighbours in them.
    rows = signed.select("doc", "sig").mapInArrow(_orders, "tree int, v1 long, v2 long, v3 long, doc long")
    order = ["tree", "v1", "v2", "v3", "doc"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    crowd = ws.table(rows.mapInArrow(_neighbours, CROWDED), "crowd")

    wanted = crowd.select("doc").distinct()
    single = plain.join(wanted.withColumnRenamed("doc", "doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("doc"), "text")
    odd = plain.join(F.broadcast(several), "doc_id", "left_semi") if several.count() <= BROADCAST_IDS else plain.join(several, "doc_id", "left_semi")
    odd = odd.mapInArrow(_with_set_keys, "doc_id long, text string, set_key binary").join(firsts, ["doc_id", "set_key"]).where(F.col("doc") >= ALIAS).select("doc", "text")
    packed = single.unionByName(odd).mapInArrow(_pack, "doc long, packed binary")
    packed = ws.table(packed.dropDuplicates(["doc"]), "packed")

    def confirm(pairs: DataFrame) -> DataFrame:
        pa_, pb_ = packed.select(F.col("doc").alias("a"), F.col("packed").alias("pa")), packed.select(F.col("doc").alias("b"), F.col("packed").alias("pb"))
        joined = pairs.join(pa_, "a").join(pb_, "b").select("a", "b", "pa", "pb")
        return ws.table(joined.mapInArrow(_confirm, "a long, b long"), "links")

    near = crowd.where("before is not null and before <> doc").select(F.least("doc", "before").alias("a"), F.greatest("doc", "before").alias("b")).distinct()
    links = confirm(near)
    comps = ws.table(connected_components(ws, links), "comps")

    # Regions that still hold several components: pairs across components, deeper where there are too many.
    # A pair whose first tree has it in a crowded region is among those of the exact way.
    def regions(comps: DataFrame, trees: int, pairs_of: Callable, deeper: Callable) -> tuple[list[DataFrame], list[DataFrame]]:
        """Pairs across components by depth, and the documents of crowded regions."""
        open_ = crowd.where(F.col("tree") < trees).select("tree", "v1", "v2", "v3", "doc")
        open_ = open_.join(comps.select(F.col("v").alias("doc"), "root"), "doc", "left").withColumn("comp", F.coalesce("root", "doc")).drop("root")
        open_ = ws.table(open_, "open")
        across, crowded = [], []
        for depth in DEPTHS:
            key = ["tree", "p1", "p2", "p3"]
            rows = open_.select("tree", "v1", "v2", "v3", "doc", "comp", *_prefix(depth))
            sums = ws.table(_mixed(rows, key), "regions")
            small = F.col("n_rest") * (F.col("n_main") + F.col("n_rest")) <= CROWD
            across.append(_pairs(ws, rows, sums.where(small), key, signed, pairs_of if depth == DEPTHS[0] else deeper))
            large = sums.where(~small).select(*key)
            if large.isEmpty():
                break
            open_ = ws.table(rows.join(large, key, "left_semi").select("tree", "v1", "v2", "v3", "doc", "comp"), "open")
            if depth == DEPTHS[0]:
                crowded.append(open_.select("doc").distinct())
        return across, crowded

    first, _ = regions(comps, FOREST_TREES, _likeliest, _likeliest)
    links = links.union(confirm(functools.reduce(DataFrame.unionByName, first).distinct()))
    comps = ws.table(connected_components(ws, links), "comps")
    across, crowded = regions(comps, TREES, _once, _across)
    if crowded:
        sets = packed.join(crowded[0], "doc", "left_semi")
        found = sets.mapInArrow(_bucket_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # 2**RARE_BITS rows at most
        counts = np.zeros(1 << RARE_BITS, np.int64)
        counts[found["bucket"]] = found["n"]
        keyed = sets.mapInArrow(_rarest(counts), "key long, doc long").join(comps.select(F.col("v").alias("doc"), "root"), "doc", "left")
        keyed = ws.table(keyed.select("key", "doc", F.coalesce("root", "doc").alias("comp")), "rarest")
        across.append(_pairs(ws, keyed, ws.table(_mixed(keyed, ["key"]), "keys"), ["key"], signed, _across))
    more = confirm(functools.reduce(DataFrame.unionByName, across).distinct())

    every = copies.union(links).union(more)
    roots = ws.table(connected_components(ws, every), "roots")
    sizes = sketches.select("doc_id", "n_shingles")
    out = sizes.join(roots.select(F.col("v").alias("doc_id"), "root"), "doc_id", "left")
    component = F.coalesce("root", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _mixed(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys with rows (doc, comp) of several components: the largest one, its rows, and those of the rest."""
    sums = rows.groupBy(*key, "comp").agg(F.count("*").alias("n"))
    sums = sums.groupBy(*key).agg(F.count("*").alias("n_comps"), F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("top")).where("n_comps > 1")
    return sums.select(*key, F.col("top.comp").alias("main"), F.col("top.n").alias("n_main"), (F.col("n") - F.col("top.n")).alias("n_rest"))


def _pairs(ws: Workspace, rows: DataFrame, sums: DataFrame, key: list[str], signed: DataFrame, pairs_of: Callable) -> DataFrame:
    """Similar pairs across the components of each key, compared in blocks; the largest component's rows meet the rest alone."""
    cells = rows.join(sums, key)
    rest_blocks = F.greatest(F.lit(1), F.ceil(F.col("n_rest") / BLOCK)).cast("int")
    main_blocks = F.greatest(F.lit(1), F.ceil(F.col("n_main") / BLOCK)).cast("int")
    is_main = F.col("comp") == F.col("main")
    spread = F.xxhash64("doc")
    cells = cells.withColumn("block", F.when(is_main, rest_blocks + F.pmod(spread, main_blocks)).otherwise(F.pmod(spread, rest_blocks)).cast("int"))
    # Main blocks meet each block of the rest; blocks of the rest meet each other and the main ones.
    partners = F.when(is_main, F.sequence(F.lit(0), rest_blocks - 1)).otherwise(F.sequence(F.lit(0), rest_blocks + main_blocks - 1))
    cells = cells.withColumn("other", F.explode(partners)).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    cells = cells.join(signed, "doc").select(*key, "i", "j", "block", "doc", "comp", "n_shingles", "sig")
    return ws.table(cells.groupBy(*key, "i", "j").applyInArrow(pairs_of, "a long, b long").distinct(), "across")
