"""Alignment of two tokenisers' tokens over the same bytes.

Texts are gathered into blocks. A block's texts are cut into chunks where both tokenisers have a boundary
whatever stands around it, and each distinct chunk is aligned once: its token intervals are tables in a
DuckDB of the Python worker, which numbers groups by a window sum over common ends, finds a token's group by
an ASOF join and overlaps by a range join inside the group. A block asks for its id pairs once; Spark adds up
the partial counts of all blocks, finds each B id's highest, and sends a block the counts it asked for.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborpay.llm.common import Workspace
from arborpay.llm.tokens import byte_encoding, tokenizer_path

#: Bytes of text of a block, chunks aligned at a time, and chunks and links a worker keeps before it starts afresh.
BLOCK, BATCH, CHUNKS, LINKS = 4_000_000, 25_000, 500_000, 4_000_000
_WORKER: dict[tuple[str, str], "Aligner"] = {}

#: Intervals a and b (i, id, s, e) lie on one line of bytes, chunk after chunk, so a chunk's last end is a common end.
_GROUPS = """
CREATE OR REPLACE TEMP TABLE g AS
SELECT sum(1) OVER (ORDER BY e) AS g, coalesce(lag(e) OVER (ORDER BY e), 0) AS s, e FROM a JOIN b USING (e);
CREATE OR REPLACE TEMP TABLE ag AS SELECT a.*, g.g FROM a ASOF JOIN g ON a.s >= g.s;
CREATE OR REPLACE TEMP TABLE bg AS SELECT b.*, g.g FROM b ASOF JOIN g ON b.s >= g.s;
"""
_LINKS = """
SELECT ag.s, (CAST(ag.id AS BIGINT) << 32) | bg.id AS pair
FROM ag JOIN bg ON ag.g = bg.g AND ag.s < bg.e AND bg.s < ag.e ORDER BY ag.i, bg.i
"""


class Aligner:
    """Aligned chunks of one Python worker, by chunk."""

    def __init__(self, a: str, b: str):
        import duckdb
        import sentencepiece

        self.a = byte_encoding(a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(b))
        self.a_bytes = self.a.pieces
        ids = range(self.b.get_piece_size())
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in ids]
        self.sizes = [np.array([len(p) for p in pieces], np.int64) for pieces in (self.a_bytes, self.b_bytes)]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self.afresh()

    def afresh(self) -> None:
        self.at: dict[str, int] = {}
        self.texts: list[str | None] = []
        self.counts: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.sound: list[np.ndarray] = []  # chunks whose bytes both give back
        self.kept = 0

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per chunk: tokens of A, of B, groups and links; first link; and all links' pairs of ids."""
        self.counts = [np.concatenate(self.counts)] if self.counts else [np.empty((0, 4), np.int64)]
        self.pairs = [np.concatenate(self.pairs)] if self.pairs else [np.empty(0, np.int64)]
        self.sound = [np.concatenate(self.sound)] if self.sound else [np.empty(0, bool)]
        return self.counts[0], np.concatenate([[0], np.cumsum(self.counts[0][:, 3])]), self.pairs[0]

    def add(self, chunks: list[str]) -> None:
        """Align chunks that aren't there yet. Each begins with the space that B adds."""
        for at in range(0, len(chunks), BATCH):
            self._add(chunks[at : at + BATCH])

    def _ids(self, chunks: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids under A and under B, of all chunks in a row, and how many each chunk has."""
        if any(c[-1].isspace() for c in chunks):
            own = [self.a.encode(c) for c in chunks]
            a, n_a = np.fromiter(chain.from_iterable(own), np.int64), np.array([len(x) for x in own], np.int64)
        else:  # what holds of the chunks of a text holds of any in a row
            a = self.a.encode_array("".join(chunks)).astype(np.int64)
            ends = np.cumsum([len(c.encode()) for c in chunks])
            n_a = np.diff(np.searchsorted(np.cumsum(self.sizes[0][a]), ends, "right"), prepend=0)
        own = self.b.encode([c[1:] for c in chunks], num_threads=1)
        return [a, np.fromiter(chain.from_iterable(own), np.int64)], [n_a, np.array([len(x) for x in own], np.int64)]

    def _add(self, chunks: list[str]) -> None:
        ids, n = self._ids(chunks)
        raw = [c.encode() for c in chunks]
        size = np.array([len(r) for r in raw], np.int64)
        spans = [np.add.reduceat(np.append(z[x], 0), np.cumsum(k) - k) * (k > 0) for z, x, k in zip(self.sizes, ids, n, strict=True)]
        good = (spans[0] == size) & (spans[1] == size)
        if not good.all() or b"".join([self.b_bytes[i] for i in ids[1].tolist()]) != b"".join(raw):
            parts = [np.split(x, np.cumsum(k)[:-1]) for x, k in zip(ids, n, strict=True)]
            good &= [b"".join([self.b_bytes[i] for i in x.tolist()]) == r for x, r in zip(parts[1], raw, strict=True)]
            ids = [x[np.repeat(good, k)] for x, k in zip(ids, n, strict=True)]
        n = [np.where(good, k, 0) for k in n]
        counts = np.zeros((len(chunks), 4), np.int64)
        counts[:, 0], counts[:, 1] = n
        texts: list[str | None] = [None] * len(chunks)
        if good.any():
            owner = np.repeat(np.flatnonzero(good), size[good])  # of each byte, its chunk
            tables = {}
            for name, flat, sizes in zip("ab", ids, self.sizes, strict=True):
                ends = np.cumsum(sizes[flat])
                tables[name] = pa.table({"i": np.arange(len(flat)), "id": flat.astype(np.int32), "s": ends - sizes[flat], "e": ends})
                self.db.register(name, tables[name])
            self.db.execute(_GROUPS)
            links = self.db.execute(_LINKS).fetchnumpy()
            counts[:, 3] = np.bincount(owner[links["s"]], minlength=len(chunks))
            self.pairs.append(np.asarray(links["pair"]))
            self.kept += len(links["s"])
            starts = self.db.execute("SELECT s FROM g ORDER BY s").fetchnumpy()["s"]
            counts[:, 2] = np.bincount(owner[starts], minlength=len(chunks))
            told = [_joined(table["id"].to_numpy(), np.isin(table["s"].to_numpy(), starts, assume_unique=True)) for table in tables.values()]
            groups = list(map("|".join, zip(*told, strict=True)))
            last = np.cumsum(counts[:, 2])
            for k, low, high in zip(range(len(chunks)), (last - counts[:, 2]).tolist(), last.tolist(), strict=True):
                if high > low:
                    texts[k] = ";".join(groups[low:high])
            for name in tables:
                self.db.unregister(name)
        self.at.update(zip(chunks, range(len(self.texts), len(self.texts) + len(chunks)), strict=True))
        self.texts += texts
        self.counts.append(counts)
        self.sound.append(good)

    def documents(self, texts: Iterable[str | None]) -> list[np.ndarray | None]:
        """The chunks of each text, by number; None for a text without tokens."""
        if len(self.at) > CHUNKS or self.kept > LINKS:
            self.afresh()
        cut = [chunks_of(t) if t else [] for t in texts]
        at = self.at
        self.add(list(set().union(*cut).difference(at)))
        self.tables()
        out: list[np.ndarray | None] = []
        for own in cut:
            numbers = np.array([at[c] for c in own], np.int64)
            if not self.sound[0][numbers].all() and len(own) > 1:
                numbers = self._whole("".join(own))
            out.append(numbers if len(numbers) and self.sound[0][numbers].all() else None)
        return out

    def _whole(self, text: str) -> np.ndarray:
        """A text as one chunk, as bytes may differ in its chunks and agree over all."""
        if text not in self.at:
            self.add([text])
            self.tables()
        return np.array([self.at[text]])


def _joined(ids: np.ndarray, first: np.ndarray) -> list[str]:
    """Ids as text, those of a group joined; ``first`` marks where a group begins."""
    text = list(map(str, ids.tolist()))
    at = np.flatnonzero(first).tolist()
    if len(at) == len(text):
        return text
    return [text[a] if b == a + 1 else ",".join(text[a:b]) for a, b in zip(at, [*at[1:], len(text)], strict=True)]


#: White space after which a space doesn't begin a chunk: A joins runs of it.
_RUN = re.compile(r"\s ")
_BEFORE = re.compile(r"(?<=\S)(?= )")


def chunks_of(text: str) -> list[str]:
    """Chunks of space+text. One ends before a space that follows a character that isn't white space.

    There A's pattern always ends a piece, and no piece of B holds a space after another character.
    """
    if _RUN.search(text) is None and text[0] != " " and text[-1] != " ":
        return [" " + w for w in text.split(" ")]
    out = _BEFORE.split(" " + text)
    if len(out) > 1 and out[-1] == " ":  # a space alone is no text to B
        out[-2:] = [out[-2] + " "]
    return out


def aligner(a: str, b: str) -> Aligner:
    """This Python worker's."""
    if (a, b) not in _WORKER:
        _WORKER[a, b] = Aligner(a, b)
    return _WORKER[a, b]


#: Rows of an aligned block: its distinct pairs with the number of its links that hold them; its documents with
#: their chunks; and one row with each chunk's number of links and the place of each link's pair among the pairs.
_ALIGNED = "block long, pair long, n long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, chunks binary, sizes binary, links binary"


def _rows(schema: str, rows: int, **columns) -> pa.Table:
    """A table of so many rows with these columns, the others null."""
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.table({name: pa.array(columns[name], types[kind]) if name in columns else pa.nulls(rows, types[kind]) for name, kind in fields})


def _aligns(a: str, b: str) -> Callable:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        own, block = aligner(a, b), key[0].as_py()
        docs = own.documents(table["text"].to_pylist())
        counts, first, pairs = own.tables()
        used = np.concatenate([d for d in docs if d is not None] or [np.empty(0, np.int64)])
        times = np.bincount(used, minlength=len(counts))
        here = np.argsort(-times, kind="stable")[: np.count_nonzero(times)]  # common chunks have small numbers, which pack well
        number = np.zeros(len(counts), "<u4")
        number[here] = np.arange(len(here))
        size = counts[here, 3]
        links = pairs[np.repeat(first[here] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        own.db.register("l", pa.table({"pair": links, "n": np.repeat(times[here], size)}))
        asked = own.db.execute("SELECT pair, CAST(sum(n) AS BIGINT) AS n FROM l GROUP BY pair ORDER BY pair").fetchnumpy()
        own.db.unregister("l")
        place = np.searchsorted(asked["pair"], links).astype("<u4")
        sums = np.array([np.zeros(4, np.int64) if d is None else counts[d].sum(axis=0) for d in docs], np.int64).reshape(-1, 4)
        shas = ["" if d is None else hashlib.sha256(";".join([own.texts[k] for k in d.tolist()]).encode()).hexdigest() for d in docs]
        chunks = [b"" if d is None else number[d].tobytes() for d in docs]
        n = len(asked["pair"])
        return pa.concat_tables([
            _rows(_ALIGNED, n, block=np.full(n, block), pair=asked["pair"], n=asked["n"]),
            _rows(_ALIGNED, len(docs), block=np.full(len(docs), block), doc_id=table["doc_id"].to_pylist(), n_a=sums[:, 0], n_b=sums[:, 1], n_groups=sums[:, 2], n_links=sums[:, 3], groups_sha256=shas, chunks=chunks),
            _rows(_ALIGNED, 1, block=[block], sizes=[size.astype("<u4").tobytes()], links=[place.tobytes()]),
        ])

    return run


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _tells(block: pa.Table, told: pa.Table) -> pa.Table:
    """Of an aligned block and the counts of its pairs: a row per document."""
    whole = block.filter(pa.compute.is_valid(block["sizes"])).slice(0, 1)
    docs = block.filter(pa.compute.is_valid(block["chunks"]))
    size = np.frombuffer(whole["sizes"][0].as_py(), "<u4").astype(np.int64)
    links = np.frombuffer(whole["links"][0].as_py(), "<u4")
    order = np.argsort(told["pair"].to_numpy())
    worth = np.stack([told["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64), told["total"].to_numpy()[order]], axis=1)
    ahead = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(worth[links], axis=0)])
    ends = np.cumsum(size)
    chunk = ahead[ends] - ahead[ends - size]
    sums = np.array([chunk[np.frombuffer(c, "<u4")].sum(axis=0) for c in docs["chunks"].to_pylist()], np.int64).reshape(-1, 2)
    columns = {c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table({**columns, "n_best": sums[:, 0], "count_sum": sums[:, 1], "groups_sha256": docs["groups_sha256"]})


def align_tokens(docs: DataFrame, a: str = "byte_bpe_50k.tiktoken", b: str = "piece_bpe_32k.model") -> DataFrame:
    """A row per document: tokens of A and B, groups, links, links at their B id's highest count, the sum of counts, and the groups' digest.

    ``a`` is a byte-level vocabulary as ranks, ``b`` a sentencepiece model; strings of special tokens are plain
    text. A text that is null or empty, or whose bytes B's pieces don't give back (a U+2581 of its own, for
    one), has no tokens: zeros and an empty digest. Rows that repeat a doc_id, or have none, are documents of
    their own. No rows give no rows; other columns are not read.
    """
    ws = Workspace(docs.sparkSession, "alignment")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bytes_ = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = plain.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(-(-bytes_ // BLOCK) or 1)))
    aligned = ws.table(dealt.groupBy("block").applyInArrow(_aligns(a, b), _ALIGNED), "aligned", codec="zstd")
    asked = aligned.where("pair is not null").select("block", "pair", "n")
    counted = asked.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair").bitwiseAND(F.lit(2**32 - 1)))
    most = counted.groupBy("b").agg(F.max("total").alias("most"))
    totals = counted.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    told = asked.join(totals, "pair").select(F.col("block").alias("back"), "pair", "total", "best")
    rest = aligned.where("pair is null").drop("pair", "n")
    return rest.groupBy("block").cogroup(told.groupBy("back")).applyInArrow(_tells, _RESULT)
