"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

Examples over a limit are cut into pieces; what doesn't fill a sequence by itself is placed by the
dot-product heuristic: an open sequence takes the example that fits and has the largest product of its
demand with what is left of each limit. Each task packs what it reads in buffers of bounded size and
gives out full sequences; what is left over in all tasks is dealt to few tasks of a second stage and
packed there, so the padding doesn't depend on how the input is split, and no key makes a difference.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborpay.llm.common import Workspace
from arborpay.llm.tokens import encode_column

SEQUENCE, SEGMENTS = 2048, 256
#: Examples a task holds before it packs them; sequences this full are given out, others wait for the next buffer.
BUFFER, FULL = 4096, 0.99
#: Tokens of left-over pieces that a task of the second stage packs.
LEFT_OVER = 8_000_000
PIECES = "doc_id long, start long, length long, doc_tokens long, loss_tokens long, sequence_id long, offset long, ids binary, loss binary"


def place(tokens: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int]) -> list[list[int]]:
    """Indices of the examples of each sequence. No example may be over a limit by itself."""
    order = np.lexsort((np.arange(len(tokens)), -loss, -tokens))
    t, ls = tokens[order].astype(np.float64), loss[order].astype(np.float64)
    cap = np.asarray(limits, np.float64)
    weight = np.array([t.mean(), 1.0, max(ls.mean(), 1e-9)]) / cap**2 if len(t) else np.ones(3)
    bins: list[list[int]] = []
    while len(t):
        left_t, left_s, left_l = cap
        taken = np.zeros(len(t), bool)
        own: list[int] = []
        first = 0  # rows before it are too long for what is left
        while left_s >= 1:
            first = max(first, int(np.searchsorted(-t, -left_t)))
            fits = ~taken[first:] & (ls[first:] <= left_l)
            if not fits.any():
                break
            score = t[first:] * (weight[0] * left_t) + weight[1] * left_s + ls[first:] * (weight[2] * left_l)
            k = first + int(np.argmax(np.where(fits, score, -1.0)))
            taken[k] = True
            own.append(k)
            left_t, left_s, left_l = left_t - t[k], left_s - 1, left_l - ls[k]
        bins.append(order[own].tolist())
        keep = ~taken
        t, ls, order = t[keep], ls[keep], order[keep]
    return bins


def pieces(doc: int | None, ids: bytes, loss: bytes | None, limits: tuple[int, int, int]) -> Iterator[tuple]:
    """(doc, start, ids, tokens of the example, loss-bearing ids, mask) of each part of an example that keeps the limits.

    The mask has a byte per id; without one, every id but the last of the example bears loss.
    """
    total = len(ids) // 4
    bears = np.frombuffer(loss, np.uint8) if loss is not None else np.append(np.ones(total - 1, np.uint8), np.uint8(0)) if total else np.empty(0, np.uint8)
    upto = np.concatenate([[0], np.cumsum(bears, dtype=np.int64)])
    start = 0
    while start < total:
        most = int(np.searchsorted(upto, upto[start] + limits[2], "right")) - 1  # as far as the limit on loss goes
        stop = min(total, start + limits[0], most)
        yield doc, start, ids[4 * start : 4 * stop], total, int(upto[stop] - upto[start]), None if loss is None else loss[start:stop]
        start = stop


def _packer(read: Callable[[pa.RecordBatch], Iterator[tuple]], limits: tuple[int, int, int], first_id: int, last: bool) -> Callable:
    """Places the pieces that ``read`` gives; unless this is the last stage, those left over have no sequence."""
    sequence, segments, loss_limit = limits

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = first_id + (TaskContext.get().partitionId() << 36)
        made = 0
        waiting: list[tuple] = []
        rows: list[tuple] = []

        def give(own: list[tuple]) -> None:
            nonlocal made
            offset = 0
            for doc, start, ids, total, loss, mask in own:
                rows.append((doc, start, len(ids) // 4, total, loss, base + made, offset, ids, mask))
                offset += len(ids) // 4
            made += 1

        def settle(flush: bool) -> None:
            nonlocal waiting
            tokens = np.array([len(w[2]) // 4 for w in waiting], np.int64)
            loss = np.array([w[4] for w in waiting], np.int64)
            later: list[tuple] = []
            for own in place(tokens, loss, limits):
                done = tokens[own].sum() >= FULL * sequence or loss[own].sum() >= FULL * loss_limit or len(own) >= segments
                if done or (flush and last):
                    give([waiting[i] for i in own])
                else:
                    later.extend(waiting[i] for i in own)
            waiting = later
            if flush or len(later) > BUFFER // 2:  # too many that never fill a sequence
                if last:
                    waiting = []
                    for own in place(np.array([len(w[2]) // 4 for w in later], np.int64), np.array([w[4] for w in later], np.int64), limits):
                        give([later[i] for i in own])
                else:
                    rows.extend((doc, start, len(ids) // 4, total, n, None, None, ids, mask) for doc, start, ids, total, n, mask in later)
                    waiting = []

        def batch() -> pa.RecordBatch:
            nonlocal rows
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if i > 6 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))], [c.split()[0] for c in PIECES.split(", ")])
            rows = []
            return out

        for part in batches:
            for piece in read(part):
                if len(piece[2]) == 4 * sequence:
                    give([piece])
                else:
                    waiting.append(piece)
                if len(waiting) >= BUFFER:
                    settle(False)
                if len(rows) >= 1024:
                    yield batch()
        settle(True)
        while rows:
            rows, more = rows[:1024], rows[1024:]
            yield batch()
            rows = more

    return pack


def _pack(df: DataFrame, read: Callable[[pa.RecordBatch], Iterator[tuple]], limits: tuple[int, int, int]) -> DataFrame:
    if min(limits) < 1:
        raise ValueError("limits must be 1 at least")
    ws = Workspace(df.sparkSession, "packing")
    first = ws.table(df.mapInArrow(_packer(read, limits, 0, False), PIECES), "pieces")
    left = first.where("sequence_id is null")
    tokens = left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    order = ["doc_id", "start", "ids"]
    dealt = left.repartition(max(1, -(-tokens // LEFT_OVER)), F.xxhash64(*order)).sortWithinPartitions(*order)

    def again(part: pa.RecordBatch) -> Iterator[tuple]:
        return zip(*(part.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens", "loss_tokens", "loss")), strict=True)

    return first.where("sequence_id is not null").unionByName(dealt.mapInArrow(_packer(again, limits, 1 << 62, True), PIECES))


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", sequence: int = SEQUENCE, segments: int = SEGMENTS, loss_limit: int | None = None, end_id: int = 1) -> DataFrame:
    """Pieces of all documents, each with its ids (little-endian unsigned 32-bit) and its place in a sequence.

    Every id but the end id bears loss, so without a limit on loss under that on tokens, only tokens and
    segments can bind. Reads doc_id and text; other columns are ignored. A null or empty text is its end
    id alone. A null doc_id stays null, and rows with the same doc_id are packed apart. No rows give no rows.
    """
    end = struct.pack("<I", end_id)
    limits = (sequence, segments, loss_limit or sequence)

    def read(part: pa.RecordBatch) -> Iterator[tuple]:
        for doc, ids in zip(part.column(0).to_pylist(), encode_column(part.column(1), tokenizer), strict=True):
            yield from pieces(doc, ids + end, None, limits)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _pack(plain, read, limits)


def pack_examples(examples: DataFrame, sequence: int = SEQUENCE, segments: int = SEGMENTS, loss_limit: int | None = None) -> DataFrame:
    """Pieces of instruction data: ``examples`` has doc_id, ids and loss (a boolean per id), as formatted conversations have.

    A piece carries its mask, a byte per id. A null in a mask bears no loss; null or empty ids give no
    piece; a mask of another length than its ids fails the job, a null mask bears loss but for the last
    id. Other columns are ignored, null and repeated doc_ids stay apart. No rows give no rows.
    """
    limits = (sequence, segments, loss_limit or sequence)

    def read(part: pa.RecordBatch) -> Iterator[tuple]:
        for doc, ids, loss in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if ids:
                if loss is not None and len(loss) != len(ids):
                    raise ValueError("a mask differs in length from its ids")
                yield from pieces(doc, np.asarray(ids, "<u4").tobytes(), None if loss is None else bytes(map(bool, loss)), limits)

    plain = examples.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<long>").alias("ids"), F.col("loss").cast("array<boolean>").alias("loss"))
    return _pack(plain, read, limits)


def piece_digests(packed: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 in place of their ids."""
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids", "loss")
