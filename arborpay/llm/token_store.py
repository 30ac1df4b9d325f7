"""A content-addressed store of token ids: chunks stored once, recipes, and Merkle manifests.

Rolling hashes over the ids cut each document's stream into chunks, so equal passages give equal
chunks wherever they stand. A chunk's address is the SHA-256 of its bytes. The store is three tables:

chunks    digest, width (bytes per id), packed (zstd of the ids, little-endian)
recipes   in ascending doc_id order: doc_id, n_tokens, digests, root (Merkle root of the digests), part
manifest  one row per part: its documents, ids, ids of the parts before, and the root over its documents
top       one row: the parts, and the root over the parts' roots

Every read recomputes digests from the stored bytes and roots from the digests, and fails on any difference,
on a part that the manifest has and the recipes don't, and on a manifest that differs from the top.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arborpay.llm.common import Workspace
from arborpay.llm.text import power_tables
from arborpay.llm.tokens import encode_column

#: Ids of the rolling window; a cut where the low bits of its hash are 0; least and most ids of a chunk.
WINDOW, CUT_BITS, LEAST, MOST = 8, 10, 256, 4096
#: Addresses a task remembers so as to send a repeated chunk once.
SEEN = 200_000
_TABLE = np.random.default_rng(8).integers(0, 2**64, 65536, dtype=np.uint64)


def _marks(ids: np.ndarray) -> np.ndarray:
    """Ends of the windows whose hash asks for a cut; a window's hash doesn't depend on where it stands."""
    n = len(ids)
    if n <= WINDOW:
        return np.empty(0, np.int64)
    up, down = power_tables(n)
    with np.errstate(over="ignore"):
        run = np.cumsum(_TABLE[ids & 0xFFFF] * up[:n], dtype=np.uint64)
        h = (run[WINDOW:] - run[:-WINDOW]) * down[1 : n - WINDOW + 1]
    return np.flatnonzero((h >> np.uint64(64 - CUT_BITS)) == 0) + WINDOW + 1


def _ends(marks: list[int], n: int) -> list[int]:
    if n <= LEAST:
        return [n] if n else []
    ends, start = [], 0
    for end in [*marks, n]:
        while end - start > MOST:
            start += MOST
            ends.append(start)
        if end - start >= LEAST and end < n:
            ends.append(end)
            start = end
    if start < n:
        ends.append(n)
    return ends


def cuts(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of an id stream; the last is its length."""
    return _ends(_marks(ids).tolist(), len(ids))


def cuts_of_all(flat: np.ndarray, sizes: list[int]) -> Iterator[list[int]]:
    """The cuts of streams that stand one after the other. Windows that reach into the stream before end too early to cut."""
    marks, start = _marks(flat), 0
    for n in sizes:
        low, high = np.searchsorted(marks, (start, start + n)) if n > LEAST else (0, 0)
        yield _ends((marks[low:high] - start).tolist(), n)
        start += n


def merkle_root(leaves: list[bytes]) -> bytes:
    """Root of a binary hash tree; an odd node goes up as it is; no leaves: the hash of nothing."""
    level = leaves or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        up = [hashlib.sha256(b"\1" + level[i] + level[i + 1]).digest() for i in range(0, len(level) - 1, 2)]
        level = up + level[len(up) * 2 :]
    return level[0]


def _body(chunk: np.ndarray) -> tuple[int, bytes]:
    """Bytes per id of a chunk, and its bytes."""
    return (2, chunk.astype("<u2").tobytes()) if chunk.max() < 65536 else (4, chunk.tobytes())


def _encode(tokenizer: str, end_id: int) -> Callable:
    """Recipes (kind 0) and chunks (kind 1) of the documents of a partition."""
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        seen: set[bytes] = set()
        for batch in batches:
            for at in range(0, len(batch), 128):
                part = batch.slice(at, 128)
                rows = []
                raws = [raw + end for raw in encode_column(part.column(1), tokenizer)]
                flat, sizes = np.frombuffer(b"".join(raws), "<u4"), [len(raw) // 4 for raw in raws]
                bodies = flat.astype("<u2").tobytes() if flat.max() < 65536 else None
                first = 0
                for doc, n, stops in zip(part.column(0).to_pylist(), sizes, cuts_of_all(flat, sizes), strict=True):
                    digests, start = [], first
                    for stop in stops:
                        stop += first
                        width, body = (2, bodies[2 * start : 2 * stop]) if bodies is not None else _body(flat[start:stop])
                        digest = hashlib.sha256(bytes([width]) + body).digest()
                        digests.append(digest)
                        if digest not in seen:
                            if len(seen) >= SEEN:
                                seen.clear()
                            seen.add(digest)
                            rows.append((1, None, None, digest, width, pack(body)))
                        start = stop
                    first += n
                    rows.append((0, doc, n, b"".join(digests), None, None))
                types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["kind", "doc_id", "n_tokens", "digests", "width", "packed"])

    return run


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with each chunk once; recipes all stay."""
    last = None
    for batch in batches:
        kind, digest = batch.column(0).to_pylist(), batch.column(3).to_pylist()
        keep = []
        for i, (k, d) in enumerate(zip(kind, digest, strict=True)):
            if k == 0 or d != last:
                keep.append(i)
            if k == 1:
                last = d
        yield batch.take(pa.array(keep, pa.int64()))


def _doc_roots(digests: pa.Array) -> list[bytes]:
    return [merkle_root([d[i : i + 32] for i in range(0, len(d), 32)]) for d in digests.to_pylist()]


def _add_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_doc_roots(batch.column(2)), pa.binary())], ["doc_id", "n_tokens", "digests", "root"])


def _part_roots(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Root over the documents of a part, from their roots in order of place."""
    rows = sorted(x for b in batches for x in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([merkle_root([r for _, r in rows])], pa.binary()), pa.array([len(rows)], pa.int64())], ["part", "root", "n"])


def _roots_of_parts(recipes: DataFrame) -> DataFrame:
    return recipes.select("part", "place", "root").groupBy("part").applyInArrow(_part_roots, "part int, root binary, n long").drop("n")


class TokenStore:
    """The three tables under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def write(self, docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2) -> "TokenStore":
        """Encode whole texts and write the store.

        Reads doc_id and text; other columns are ignored. A null or empty text is its end id alone.
        Null doc_ids come first; rows with the same doc_id each have a recipe, shorter ones first.
        """
        plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        rows = plain.mapInArrow(_encode(tokenizer, end_id), "kind int, doc_id long, n_tokens long, digests binary, width int, packed binary")
        key = F.when(F.col("kind") == 1, F.xxhash64("digests")).otherwise(F.xxhash64("doc_id", "digests"))
        rows = rows.repartition(key).sortWithinPartitions("kind", "digests")
        schema = rows.schema
        rows.mapInArrow(_once, schema).write.partitionBy("kind").option("compression", "none").parquet(f"{self.path}/objects")
        recipes = self.spark.read.schema(schema).parquet(f"{self.path}/objects").where("kind = 0").select("doc_id", "n_tokens", "digests")
        order = ["doc_id", "n_tokens", "digests"]
        ordered = recipes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_add_roots, "doc_id long, n_tokens long, digests binary, root binary")
        ordered = ordered.select("*", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).alias("place"))
        ordered.write.parquet(f"{self.path}/recipes")
        written = self.table("recipes")
        parts = written.groupBy("part").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
        parts = parts.withColumn("tokens_ahead", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0)))
        parts.join(_roots_of_parts(written), "part").write.parquet(f"{self.path}/manifest")
        self._top().write.parquet(f"{self.path}/top")
        return self

    def _top(self) -> DataFrame:
        """Parts of the manifest and the root over them."""
        rows = self.table("manifest").select(F.lit(0).alias("part"), F.col("part").alias("place"), "root")  # one row per part
        return rows.groupBy("part").applyInArrow(_part_roots, "part int, root binary, n long").select(F.col("n").alias("n_parts"), "root")

    def _sound_manifest(self) -> DataFrame:
        """The manifest; fails the job where it isn't the one that the top was made from."""
        now = self._top().select(F.col("n_parts").alias("n_now"), F.col("root").alias("root_now"), F.lit(0).alias("all"))
        top = self.table("top").select("n_parts", F.col("root").alias("top_root"), F.lit(0).alias("all"))
        same = F.coalesce((F.col("n_parts") == F.col("n_now")) & (F.col("top_root") == F.col("root_now")), F.lit(False))
        both = top.join(now, "all", "left").select("all", F.when(same, True).otherwise(F.raise_error(F.lit("token store: the manifest differs from its top"))).alias("sound"))
        return self.table("manifest").withColumn("all", F.lit(0)).join(F.broadcast(both), "all").where("sound").drop("all", "sound")  # one row

    def chunks(self) -> DataFrame:
        """The stored chunks: digest, width, packed."""
        objects = self.spark.read.schema("kind int, doc_id long, n_tokens long, digests binary, width int, packed binary").parquet(f"{self.path}/objects")
        return objects.where("kind = 1").select(F.col("digests").alias("digest"), "width", "packed")

    def located(self) -> DataFrame:
        """Recipes with ``start``: the ids of all documents before, from the manifest and the part's own order.

        A recipe whose root doesn't follow from its digests, or a part whose root doesn't follow from
        its recipes, fails the job.
        """
        recipes = self.table("recipes")
        again = recipes.mapInArrow(_check_roots, recipes.schema)
        manifest = self._sound_manifest().select("part", "n_docs", "tokens_ahead", F.col("root").alias("part_root"))
        now = recipes.select("part", "place", "root").groupBy("part").applyInArrow(_part_roots, "part int, root binary, n long").select("part", F.col("root").alias("root_now"), F.col("n").alias("docs_now"))
        sound = F.coalesce((F.col("part_root") == F.col("root_now")) & (F.col("n_docs") == F.col("docs_now")), F.lit(False))
        # From the manifest's side, so that a part of which nothing is left is missed, too.
        parts = manifest.join(now, "part", "full").select("part", F.when(sound, F.col("tokens_ahead")).otherwise(F.raise_error(F.lit("token store: a part differs from its manifest"))).alias("tokens_ahead"))
        within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        out = again.withColumn("_in", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        return out.join(parts, "part", "right").withColumn("start", (F.col("tokens_ahead") + F.col("_in")).cast("long"))

    def digests(self) -> DataFrame:
        """(doc_id, start, n_tokens, ids_crc32) of each document, from the stored bytes of its chunks."""
        stored = self.chunks().mapInArrow(_read_chunks, "digest binary, n int, crc long")
        steps = self.located().select("doc_id", "start", "n_tokens", F.expr("explode(transform(sequence(0, cast(length(digests) / 32 as int) - 1), i -> struct(i as pos, substring(digests, i * 32 + 1, 32) as digest)))").alias("s"))
        steps = steps.select("doc_id", "start", "n_tokens", "s.pos", "s.digest").join(stored, "digest", "left")
        docs = steps.groupBy("start").agg(F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("pos", F.coalesce("n", F.lit(-1)).alias("n"), F.coalesce("crc", F.lit(0)).alias("crc")))).alias("steps"))
        flat = docs.select("doc_id", "start", "n_tokens", F.col("steps.n").alias("ns"), F.col("steps.crc").alias("crcs"))
        return flat.mapInArrow(_join_crcs, "doc_id long, start long, n_tokens long, ids_crc32 long")

    def documents(self) -> DataFrame:
        """(doc_id, start, ids) of each document, put together from its chunks."""
        steps = self.located().select("doc_id", "start", "n_tokens", F.expr("explode(transform(sequence(0, cast(length(digests) / 32 as int) - 1), i -> struct(i as pos, substring(digests, i * 32 + 1, 32) as digest)))").alias("s"))
        steps = steps.select("doc_id", "start", "n_tokens", "s.pos", "s.digest").join(self.chunks(), "digest")
        docs = steps.groupBy("start").agg(F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("pos", "digest", "width", "packed"))).alias("s"))
        flat = docs.select("doc_id", "start", "n_tokens", F.col("s.digest").alias("d"), F.col("s.width").alias("w"), F.col("s.packed").alias("p"))
        return flat.mapInArrow(_rebuild, "doc_id long, start long, ids array<long>")


def _unpacked(digest: bytes, width: int, packed: bytes) -> np.ndarray:
    import zstandard

    body = zstandard.ZstdDecompressor().decompress(packed)
    if hashlib.sha256(bytes([width]) + body).digest() != digest:
        raise ValueError("token store: a chunk differs from its address")
    return np.frombuffer(body, "<u2" if width == 2 else "<u4").astype("<u4")


def _check_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if _doc_roots(batch.column("digests")) != batch.column("root").to_pylist():
            raise ValueError("token store: a recipe differs from its root")
        yield batch


def _read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [_unpacked(*x) for x in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(i) for i in ids], pa.int32()), pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64())], ["digest", "n", "crc"])


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32, bits reflected."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


@lru_cache(100_000)
def _shift(n_bytes: int) -> int:
    """x to the 8 * n_bytes."""
    out, square, e = 1 << 31, 1 << 30, 8 * n_bytes
    while e:
        if e & 1:
            out = _times(square, out)
        square = _times(square, square)
        e >>= 1
    return out


def crc32_joined(first: int, second: int, n_bytes: int) -> int:
    """CRC-32 of two byte strings one after the other, from that of each and the second's length."""
    return _times(_shift(n_bytes), first) ^ second


def _join_crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for total, ns, crcs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            if min(ns) < 0 or sum(ns) != total:
                raise ValueError("token store: a document's chunks are missing or differ in length")
            crc = crcs[0]
            for n, c in zip(ns[1:], crcs[1:], strict=True):
                crc = crc32_joined(crc, c, 4 * n)
            out.append(crc)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [np.concatenate([_unpacked(*c) for c in zip(*x, strict=True)]).astype(np.int64) for x in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([o.tolist() for o in out], pa.list_(pa.int64()))], ["doc_id", "start", "ids"])


def store_documents(docs: DataFrame, path: str | None = None, **options) -> TokenStore:
    """Write the documents to a new store, in the shared folder unless a path is given."""
    spark = docs.sparkSession
    return TokenStore(spark, path or Workspace(spark, "token-store").path).write(docs, **options)
