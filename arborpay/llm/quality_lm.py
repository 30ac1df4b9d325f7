"""Quality by perplexity under an interpolated modified Kneser-Ney model of words.

The model of a language counts word n-grams over all trusted texts. Every trusted text belongs to a
fold; a gram has a count without each fold and one over all of them, so that a trusted document is
scored by a model that hasn't seen its fold and any other by the whole. Documents are gathered into
blocks of bounded size and written once, as word ids. From the longest grams to single words, a block asks
shards, each a range of hashed grams, for its distinct grams, and brings what its trusted texts count; the
shard adds up and answers. So a block gets the counts of its own grams, no task holds a language's table,
and no table of counts is written. Of each gram one block learns the counts of all models, and brings them to
the shorter grams within it. Grams and counts travel as packed arrays, a row for a block and shard, in waves of
shards, so only one wave's grams are shuffled at a time.
"""

from __future__ import annotations

import contextlib
import functools
import itertools
import re
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arborpay.llm.common import BROADCAST_IDS, Workspace

#: Words of a gram.
WORDS = 3
#: Characters of a block; blocks that a task holds before it gives the largest out.
BLOCK_CHARS, HELD_BLOCKS = 8_000_000, 4
#: Waves of shards by words of a gram; characters to a shard of a wave; shards of a wave at least.
WAVES, SHARD_CHARS, LEAST_SHARDS = (2, 4, 3), 48_000_000, 6
#: Waves in which blocks are scored.
SCORE_WAVES = 4
#: Keys that are hashed at a time.
STEP_ROWS = 1 << 14
#: Bits of a word's id: two of n words share one with a probability of n**2 / 2**41.
WORD_BITS = 40
#: Share of the trusted documents of a language and length that its threshold keeps; width of a bin of cross-entropy, in nats.
QUANTILE, BIN = 0.998, 1e-4
#: Characters at which a length begins; trusted documents that count as much as what all languages say.
LENGTHS, DRAW = (100, 400, 1600), 500
#: Folds of trusted texts.
FOLDS = 4
#: A word, or a mark; characters of scripts without spaces are words of their own.
TOKEN, UNSPACED = re.compile(r"\w+|[^\w\s]"), re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def tokens(text: str) -> list[str]:
    if not text.isascii() and UNSPACED.search(text):
        text = UNSPACED.sub(r" \1 ", text)
    return TOKEN.findall(text)


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _mixed(ids: np.ndarray) -> np.ndarray:
    ids = ids * _P2
    return ((ids << np.uint64(31)) | (ids >> np.uint64(33))) * _P1


def _step(h: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of one more column, whose values went through _mixed."""
    out = h + (_P5 + np.uint64(8))
    high = np.empty(min(len(out), STEP_ROWS), np.uint64)
    for at in range(0, len(out), STEP_ROWS):  # few enough to stay in a core's cache
        x = out[at : at + STEP_ROWS]
        t = high[: len(x)]
        x ^= mixed[at : at + STEP_ROWS]
        np.right_shift(x, np.uint64(37), out=t)
        x <<= np.uint64(27)
        x |= t
        x *= _P1
        x += _P4
        for shift, factor in ((33, _P2), (29, _P3), (32, None)):
            np.right_shift(x, np.uint64(shift), out=t)
            x ^= t
            if factor is not None:
                x *= factor
    return out


def keys(grams: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of the columns of word ids of each row."""
    h = np.full(len(grams), 42, np.uint64)
    for j in range(grams.shape[1]):
        h = _step(h, _mixed(grams[:, j]))
    return h.view(np.int64)


@functools.cache
def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress


def pack(arrays: Iterable[np.ndarray]) -> bytes:
    """Arrays of booleans or whole numbers; bytes of equal weight lie together, so small numbers take little."""
    head, body = [], []
    for a in arrays:
        if a.dtype == bool:
            head += [0, 0, len(a)]
            body.append(np.packbits(a).tobytes())
            continue
        negative = a.dtype.kind == "i" and len(a) > 0 and a.min() < 0
        a = (a << 1) ^ (a >> 63) if negative else a
        a = a.astype("<u8")
        width = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
        head += [2 if negative else 1, width, len(a)]
        body.append(a.view(np.uint8).reshape(-1, 8).T[:width].tobytes())
    return _zstd()[0](b"".join([np.array([len(head), *head], "<i8").tobytes(), *body]))


def unpack(blob: bytes) -> Iterator[np.ndarray]:
    data = _zstd()[1](blob)
    n = int.from_bytes(data[:8], "little")
    at = 8 * (n + 1)
    for kind, width, size in np.frombuffer(data, "<i8", n, 8).reshape(-1, 3).tolist():
        took = width * size if kind else (size + 7) // 8
        part = np.frombuffer(data, np.uint8, took, at)
        at += took
        if not kind:
            yield np.unpackbits(part, count=size).astype(bool)
            continue
        wide = np.zeros((size, 8), np.uint8)
        wide[:, :width] = part.reshape(width, size).T
        a = wide.reshape(-1).view("<i8")
        yield ((a >> 1) & (2**63 - 1)) ^ -(a & 1) if kind == 2 else a


class Texts:
    """Some texts of a language as one run of word ids; each begins with WORDS - 1 marks. Ids of two languages differ."""

    def __init__(self, texts: list[str], lang: str):
        place: dict[str, int] = defaultdict(itertools.count(1).__next__)
        mark = np.zeros(WORDS - 1, np.int64)
        runs, sizes = [], []
        for text in texts:
            own = tokens(text)
            sizes.append(len(own))
            runs += [mark, np.fromiter(map(place.__getitem__, own), np.int64, len(own))]
        of = blake2b(lang.encode("utf-8", "surrogatepass") + b"\0", digest_size=WORD_BITS // 8)

        def hashed(word: str) -> int:
            h = of.copy()
            h.update(word.encode("utf-8", "surrogatepass"))
            return int.from_bytes(h.digest(), "little")

        ids = [int.from_bytes(of.digest(), "little")] + [hashed(w) for w in place]
        self._hold(np.array(sizes, np.int64), np.concatenate(runs) if runs else np.empty(0, np.int64), np.array(ids, np.uint64))

    def _hold(self, sizes: np.ndarray, flat: np.ndarray, ids: np.ndarray, mixed: np.ndarray | None = None) -> Texts:
        self.sizes, self.flat, self.ids = sizes, flat, ids
        self.text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + WORDS - 1)
        self._keys: list[np.ndarray] = []
        self._mixed = mixed
        return self

    def packed(self) -> bytes:
        return pack([self.sizes, self.flat, self.ids])

    @classmethod
    def read(cls, blob: bytes) -> Texts:
        sizes, flat, ids = unpack(blob)
        return cls.__new__(cls)._hold(sizes, flat, ids.view(np.uint64))

    def of(self, begin: int, end: int) -> Texts:
        """Some texts in a row alone."""
        if self._mixed is None:
            self._mixed = _mixed(self.ids)
        ends = np.concatenate([[0], np.cumsum(self.sizes + WORDS - 1)])
        return Texts.__new__(Texts)._hold(self.sizes[begin:end], self.flat[ends[begin] : ends[end]], self.ids, self._mixed)

    def starts(self, n: int) -> np.ndarray:
        """Where grams of n words begin that don't reach into the next text."""
        return np.flatnonzero(self.text[: max(len(self.text) - n + 1, 0)] == self.text[n - 1 :])

    def key(self, n: int) -> np.ndarray:
        """The key of the n words from each place on; what reaches into the next text is no gram."""
        if self._mixed is None:
            self._mixed = _mixed(self.ids)
        while len(self._keys) < n:
            k = len(self._keys)
            if k:
                self._keys.append(_step(self._keys[-1][: max(len(self.flat) - k, 0)], self._mixed[self.flat[k:]]))
            else:
                self._keys.append(self._words()[self.flat])
        return self._keys[n - 1]

    def _words(self) -> np.ndarray:
        if self._mixed is None:
            self._mixed = _mixed(self.ids)
        return _step(np.full(len(self._mixed), 42, np.uint64), self._mixed)

    def found_keys(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The keys of grams of n words, and the place of each; of a word the number of the word, once."""
        if n == 1:
            at = np.flatnonzero(np.bincount(self.flat, minlength=len(self.ids)))
            return self._words()[at], at
        at = self.starts(n)
        return self.key(n)[at], at

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The sorted keys of distinct grams of n words, and a place of each."""
        at = self.starts(n)
        x = self.key(n)[at]
        order = np.argsort(x)
        x = x[order]
        first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])[: len(x)])
        return x[first], at[order[first]]

    def distinct(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct grams of n words as rows of ids, and how often they occur."""
        at = self.starts(n)
        _, first, count = np.unique(self.key(n)[at], return_index=True, return_counts=True)
        return np.stack([self.ids[self.flat[at[first] + j]] for j in range(n)], axis=1), count


def _sorted_distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])[: len(x)]]


class Bucketed:
    """A table of rows by block, in buckets, so that what is gathered by block doesn't shuffle it."""

    def __init__(self, ws: Workspace, name: str, buckets: int):
        self.ws, self.buckets = ws, buckets
        self.name, self.path = f"quality_{name}_{uuid.uuid4().hex}", ws.folder(name)

    def add(self, df: DataFrame) -> None:
        df.write.mode("append").option("compression", "none").option("path", self.path).bucketBy(self.buckets, "block").saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.ws.spark.table(self.name)

    def forget(self) -> None:
        """Take the table out of the session's catalogue; its files go with Workspace.drop()."""
        self.ws.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents as word ids: so many characters of one language in one partition."""
    held: dict[tuple[str, str | None], list] = {}
    size: dict[tuple[str, str | None], int] = {}
    next_block = TaskContext.get().partitionId() << 32

    def out(own: tuple[str, str | None]) -> pa.RecordBatch:
        nonlocal next_block
        ids, models, texts = zip(*sorted(held.pop(own), key=lambda row: row[1]), strict=True)
        chars = [len(t) for t in texts]
        row = {"block": next_block, "lang": own[0], "lang_was": own[1], "chars": size.pop(own), "doc_id": list(ids), "model": list(models), "n_chars": chars, "words": Texts(list(texts), own[0]).packed()}
        next_block += 1
        return pa.RecordBatch.from_pylist([row], _BLOCK)

    for batch in batches:
        for doc_id, lang, lang_was, model, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "lang_was", "model", "text")), strict=True):
            own = (lang, lang_was)
            held.setdefault(own, []).append((doc_id, model, text or ""))
            size[own] = size.get(own, 0) + len(text or "") + 1
            if size[own] > BLOCK_CHARS:
                yield out(own)
            elif sum(size.values()) > HELD_BLOCKS * BLOCK_CHARS:
                yield out(max(size, key=size.__getitem__))
    for own in list(held):
        yield out(own)


_BLOCK = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("lang_was", pa.string()), ("chars", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("model", pa.list_(pa.int32())), ("n_chars", pa.list_(pa.int64())), ("words", pa.binary())])
_BLOCK_DDL = "block long, lang string, lang_was string, chars long, doc_id array<long>, model array<int>, n_chars array<long>, words binary"
_ASKED = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("lang", pa.string()), ("asked", pa.binary())])
_ASKED_DDL = "shard int, block long, lang string, asked binary"
_ANSWER = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("lang", pa.string()), ("found", pa.binary()), ("owned", pa.binary()), ("stats", pa.list_(pa.int64()))])
_ANSWER_DDL = "shard int, block long, lang string, found binary, owned binary, stats array<long>"


def _parts(words: bytes, models: list[int]) -> dict[int, Texts]:
    """The texts of a block by model; they are in its order."""
    own, model = Texts.read(words), np.array(models)
    return {int(m): own.of(*np.searchsorted(model, [m, m + 1])) for m in np.unique(model)}


def _told_apart(counts: np.ndarray, fold: int | np.ndarray) -> np.ndarray:
    """Counts by model to what they differ in, mostly 0, and back: of other folds from the whole; what a fold's own model has, others brought."""
    for m in range(FOLDS):
        counts[m] = np.where(fold == m, counts[m], counts[FOLDS] - counts[m])
    return counts


def _brought(known: np.ndarray, own: Texts, n: int, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """By model, what grams of n + 1 words at these places, with these counts by model, bring to known keys of n words.

    c: in how many ways a gram goes on to the left; x, y, z: with how many words seen once, twice and more
    often it goes on to the right, u: how often with words not seen once.
    """
    out = np.zeros((FOLDS + 1, 5, len(known)), np.int64)
    if not len(known):
        return out
    for begins in (1, 0):
        x = own.key(n)[at + begins]
        here = (x >= known[0]) & (x <= known[-1])
        place = np.searchsorted(known, x[here])
        for m in range(FOLDS + 1):
            c = counts[m][here]
            if begins:
                out[m, 0] = np.bincount(place[c > 0], minlength=len(known))
                continue
            out[m, 1] = np.bincount(place, np.where(c != 1, c, 0), len(known))
            for k, such in ((2, c == 1), (3, c == 2), (4, c > 2)):
                out[m, k] = np.bincount(place[such], minlength=len(known))
    return out


def _asks(parts: dict[int, Texts], n: int, shards: range, of: int, grown: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, bytes]]:
    """What a block asks each of some shards: the distinct grams of n words of each model, and what trusted texts bring to them.

    A shard has a range of keys. ``grown`` has places and counts of the grams of n + 1 words by model, where n < WORDS.
    """
    edges = np.array([((k << 32) + of - 1) // of << 32 for k in shards], np.uint64)
    last = np.uint64(((shards.stop << 32) + of - 1) // of * 2**32 - 1)
    asked = []
    for m, own in sorted(parts.items()):
        x, _ = own.found_keys(n)
        x = x[(x >= edges[0]) & (x <= last)]
        brought = np.empty((0, 0), np.int64)
        if m < FOLDS and n == WORDS:
            x, count = np.unique(x, return_counts=True)
            brought = count[None]
        else:
            x = _sorted_distinct(x)
            if m < FOLDS:
                brought = _told_apart(_brought(x, own, n, *grown[m]), m).reshape(5 * (FOLDS + 1), len(x))
        asked.append((m, x, [*np.searchsorted(x, edges).tolist(), len(x)], brought))
    for k, shard in enumerate(shards):
        here = [(m, x[ends[k] : ends[k + 1]], brought[:, ends[k] : ends[k + 1]]) for m, x, ends, brought in asked if ends[k] < ends[k + 1]]
        if here:
            trusted = [brought for m, _, brought in here if m < FOLDS]
            arrays = [np.array([m for m, _, _ in here]), np.array([len(x) for _, x, _ in here]), np.diff(np.concatenate([x for _, x, _ in here]), prepend=np.uint64(0))]
            if trusted:
                columns = np.concatenate(trusted, axis=1)
                arrays += [some := columns.any(axis=0), *columns[:, some]]
            yield shard, pack(arrays)


def _asked(rows: list[tuple[int, str, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows, strict=True), _ASKED, strict=True)] if rows else [pa.array([], f.type) for f in _ASKED], schema=_ASKED)


def _ask_longest(shards: range, of: int) -> Callable:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch.column(c)[k].as_py() for c in ("block", "lang", "model", "words")}
                yield _asked([(s, row["block"], row["lang"], b) for s, b in _asks(_parts(row["words"], row["model"]), WORDS, shards, of, {})])

    return ask


def _collected(rows: pa.Table, column: str) -> dict[int, list[np.ndarray]]:
    """Answers to a block by model, in the order of its sorted keys: which have one, and counts of those."""
    parts: dict[int, list[list[np.ndarray]]] = {}
    for blob in rows.sort_by("shard").column(column).drop_null():
        models, sizes, mask, *counts = unpack(blob.as_py())
        ends = np.cumsum(sizes)
        upto = np.concatenate([[0], np.cumsum(mask)])
        for m, a, b in zip(models.tolist(), (ends - sizes).tolist(), ends.tolist(), strict=True):
            parts.setdefault(m, []).append([mask[a:b], *(c[upto[a] : upto[b]] for c in counts)])
    return {m: [np.concatenate(x) for x in zip(*own, strict=True)] for m, own in parts.items()}


def _ask_shorter(n: int, shards: range, of: int) -> Callable:
    def ask(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        owned = _collected(answers, "owned")
        rows = []
        for row in blocks.to_pylist():
            parts, grown = _parts(row["words"], row["model"]), {}
            for m, own in parts.items():
                if m < FOLDS:
                    _, at = own.grams(n + 1)
                    mine, *counts = owned.get(m, [np.zeros(len(at), bool), *[np.empty(0, np.int64)] * (FOLDS + 1)])
                    grown[m] = at[mine], _told_apart(np.array(counts), m)
            rows += [(s, row["block"], row["lang"], b) for s, b in _asks(parts, n, shards, of, grown)]
        return pa.Table.from_batches([_asked(rows)])

    return ask


def _answer(n: int) -> Callable:
    """Adds up what trusted texts bring to the grams of a shard, and answers each block with the counts of its models.

    The first trusted texts that have a gram own it: they alone bring it to shorter grams, and get its counts of all models.
    """

    def of_language(lang: str, asks: list[tuple[int, int, bytes]]) -> Iterator[tuple]:
        read, some, brought = [], [], []
        for shard, block, blob in asks:
            models, sizes, x, *more = unpack(blob)
            read.append((shard, block, models, sizes, np.cumsum(x.view(np.uint64), dtype=np.uint64)))
            some.append(np.concatenate([*more[:1], np.zeros(len(x) - len(more[0]) if more else len(x), bool)]))
            if more:
                brought.append(np.array(more[1:]))
        x, model, some = np.concatenate([r[4] for r in read]), np.concatenate([np.repeat(r[2], r[3]) for r in read]), np.concatenate(some)
        known = _sorted_distinct(x[some])
        place = np.minimum(np.searchsorted(known, x), max(len(known) - 1, 0))
        sums, owns = np.zeros((FOLDS + 1, 1 if n == WORDS else 5, len(known)), np.int64), np.zeros(len(x), bool)
        found, own_counts = owns, sums[:, 0]
        if len(known):
            at, fold, counts = place[some], model[some], np.concatenate(brought, axis=1)
            add = lambda c, at: np.bincount(at, c, len(known)).astype(np.int64)
            if n == WORDS:
                sums[FOLDS, 0] = add(counts[0], at)
                for m in range(FOLDS):  # without each fold
                    sums[m, 0] = sums[FOLDS, 0] - add(counts[0][fold == m], at[fold == m])
            else:
                counts = _told_apart(counts.reshape(FOLDS + 1, 5, -1), fold)
                for m, k in np.ndindex(*sums.shape[:2]):
                    sums[m, k] = add(counts[m, k], at)
            first = np.empty(len(known), np.int64)
            first[at[::-1]] = np.arange(len(at))[::-1]  # of a place given more than once, the last stays
            owns[some] = first[at] == np.arange(len(at))
            stats = np.zeros((WORDS, FOLDS + 1, 6), np.int64)
            for m in range(FOLDS + 1):
                c = sums[m, 0]
                stats[n - 1, m] = [*((c == k).sum() for k in (1, 2, 3, 4)), (c > 0).sum(), c.sum()]
            yield None, None, lang, None, None, stats.reshape(-1).tolist()
            found = (known[place] == x) & sums.any(axis=1)[model, place]
            own_counts = _told_apart(sums[:, 0, place[owns]], model[owns])
        counts = sums[model[found], :, place[found]].T
        upto, own_upto = np.concatenate([[0], np.cumsum(found)]), np.concatenate([[0], np.cumsum(owns)])
        end = 0
        for shard, block, models, sizes, _ in read:
            begin, end = end, end + int(sizes.sum())
            answer = pack([models, sizes, found[begin:end], *counts[:, upto[begin] : upto[end]]])
            trusted = models < FOLDS
            middle = begin + int(sizes[trusted].sum())  # they come first
            owned = pack([models[trusted], sizes[trusted], owns[begin:middle], *own_counts[:, own_upto[begin] : own_upto[middle]]]) if n > 1 and trusted.any() else None
            yield shard, block, lang, answer, owned, None

    def answer(asked: pa.Table) -> pa.Table:
        by_lang: dict[str, list[tuple[int, int, bytes]]] = {}
        for row in asked.to_pylist():
            by_lang.setdefault(row["lang"], []).append((row["shard"], row["block"], row["asked"]))
        rows = [row for lang, asks in by_lang.items() for row in of_language(lang, asks)]
        return pa.table([pa.array(list(x), f.type) for x, f in zip(zip(*rows, strict=True), _ANSWER, strict=True)], schema=_ANSWER)

    return answer


def discounts(stats: list[int]) -> list[list[float]]:
    """By model the size of the vocabulary, the discounts of each order, and how often the empty context goes on, and with how many words seen once, twice and more often."""
    by_order = np.array(stats, float).reshape(WORDS, FOLDS + 1, 6)
    out = []
    for m in range(FOLDS + 1):
        once, twice, _, _, some, all_ = by_order[0, m]
        own = [some + 1]
        for s in by_order[:, m]:
            y = s[0] / max(s[0] + 2 * s[1], 1)
            own += [max(0.05, min(k - 0.05, k - (k + 1) * y * s[k] / max(s[k - 1], 1))) for k in (1, 2, 3)]
        out.append([*own, all_, once, twice, some - once - twice])
    return out


def logprobs(own: Texts, places: list[np.ndarray], counts: list[list[np.ndarray]], cuts: list[float]) -> np.ndarray:
    """Of each word of some texts, given the WORDS - 1 before it.

    For grams of 1, 2, ... words, ``places`` has the row of counts of the gram that begins at each place,
    and ``counts`` the columns c, t, x, y, z of those rows; the row after the last is that of grams without any.
    """
    first = own.starts(WORDS)
    p = np.full(len(first), 1 / cuts[0])
    for n in range(1, WORDS + 1):
        cut = np.array([0.0, *cuts[3 * n - 2 : 3 * n + 1]])
        c = np.append(counts[n - 1][0], 0).astype(float)
        c -= cut[np.minimum(c, 3).astype(int)]
        if n == 1:
            goes_on, left = np.array([cuts[-4]]), np.array([np.array(cuts[-3:]) @ cut[1:]])
            context = np.zeros(len(first), np.int8)
        else:
            goes_on = np.append(counts[n - 2][1], 0).astype(float)
            left = sum(np.append(counts[n - 2][k + 1], 0).astype(float) * cut[k] for k in (1, 2, 3))
            context = places[n - 2][first + WORDS - n]
        total = np.maximum(goes_on, 1)
        here = c[places[n - 1][first + WORDS - n]] / total[context] + (left / total)[context] * p
        p = np.where((goes_on > 0)[context], here, p)
    return np.log(p)


def entropies(own: Texts, places: list[np.ndarray], counts: list[list[np.ndarray]], cuts: list[float] | None) -> list[float | None]:
    """Of each text, in nats per word; none without words, or where the language has no trusted text."""
    if not cuts or not cuts[-4]:
        return [None] * len(own.sizes)
    lost = -logprobs(own, places, counts, cuts)
    sums = np.bincount(own.text[own.starts(WORDS)], lost, minlength=len(own.sizes))
    return [float(s / n) if n else None for s, n in zip(sums, own.sizes, strict=True)]


def _answered(own: Texts, n: int, here: np.ndarray) -> np.ndarray:
    """The row of the answer to the gram of n words at each place; here: which of its sorted distinct grams have one."""
    x, at = own.found_keys(n)
    order = np.argsort(x)
    x = x[order]
    gram = np.cumsum(np.concatenate([[False], x[1:] != x[:-1]])[: len(x)])
    row = np.where(here, np.cumsum(here) - 1, here.sum()).astype(np.int32)[gram]
    out = np.full(len(own.ids) if n == 1 else len(own.flat), here.sum(), np.int32)
    out[at[order]] = row
    return out[own.flat] if n == 1 else out


def _score(docs: pa.Table, found: pa.Table) -> pa.Table:
    """Documents of one language and model, packed one by one, by the counts of a table of keys."""
    import zstandard

    unpack_text = zstandard.ZstdDecompressor().decompress
    texts = ["" if p is None else unpack_text(p).decode("utf-8", "surrogatepass") for p in docs.column("packed").to_pylist()]
    own = Texts(texts, docs.column("lang")[0].as_py())
    key, columns = found.column("key").to_numpy().view(np.uint64), [found.column(c).to_numpy() for c in "ctxyz"]
    places, counts = [], []
    for n in range(1, WORDS + 1):
        grams, _ = own.grams(n)
        here = np.isin(grams, key)
        order = np.argsort(key)
        row = order[np.searchsorted(key, grams[here], sorter=order)]
        places.append(_answered(own, n, here))
        counts.append([c[row] for c in columns])
    entropy = entropies(own, places, counts, docs.column("cuts")[0].as_py())
    return pa.table({"doc_id": docs.column("doc_id"), "lang": docs.column("lang_was"), "n_chars": pa.array([len(t) for t in texts], pa.int64()), "trusted": pa.array(docs.column("model").to_numpy() < FOLDS), "entropy": pa.array(entropy, pa.float64())})


_SCORED = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("n_chars", pa.int64()), ("trusted", pa.bool_()), ("entropy", pa.float64())])


def _score_block(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Entropies of a block's documents, each by its own model."""
    order = answers.column("n")
    found = {n: _collected(answers.filter(pa.compute.equal(order, n)), "found") for n in range(1, WORDS + 1)}
    out = []
    for row in blocks.to_pylist():
        model, entropy = np.array(row["model"]), np.full(len(row["model"]), None, object)
        for m, own in _parts(row["words"], row["model"]).items():
            places, counts = [], []
            for n in range(1, WORDS + 1):
                here, *columns = found[n][m] if m in found[n] else [np.zeros(len(own.grams(n)[0]), bool), *[np.empty(0, np.int64)] * 5]
                places.append(_answered(own, n, here))
                if 1 < len(columns) and n < WORDS:
                    columns[1] = columns[1] + columns[2]
                counts.append(columns)
            entropy[model == m] = entropies(own, places, counts, row["cuts"] and row["cuts"][m])
        out.append(pa.table([pa.array(row["doc_id"], pa.int64()), pa.array([row["lang_was"]] * len(model), pa.string()), pa.array(row["n_chars"], pa.int64()), pa.array(model < FOLDS), pa.array(entropy.tolist(), pa.float64())], schema=_SCORED))
    return pa.concat_tables(out) if out else _SCORED.empty_table()


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cuts = [discounts(s) for s in batch.column("stats").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(cuts, pa.list_(pa.list_(pa.float64())))], ["lang", "cuts"])


@contextlib.contextmanager
def _freed_at_once(spark: SparkSession) -> Iterator[None]:
    """Meanwhile a write's shuffle files go when it has ended, not when the driver finds them forgotten."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def perplexities(ws: Workspace, docs: DataFrame) -> DataFrame:
    """(doc_id, lang, n_chars, trusted, entropy) of each document: nats per word, null where nothing can be said.

    ``docs`` has doc_id, lang, lang_was, model and text; the model is the fold of a trusted document, FOLDS of any other.
    """
    with _freed_at_once(ws.spark):
        return _perplexities(ws, docs)


def _perplexities(ws: Workspace, docs: DataFrame) -> DataFrame:
    spark = ws.spark
    texts = Bucketed(ws, "texts", int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts.add(docs.select("doc_id", "lang", "lang_was", "model", "text").mapInArrow(_gather, _BLOCK_DDL))
    ws.settle()
    shards = max(LEAST_SHARDS, -(-(texts.read().agg(F.sum("chars")).first()[0] or 0) // SHARD_CHARS))
    blocks = texts.read().select("block", "lang", "model", "words")
    answers: dict[int, DataFrame] = {}
    for n in range(WORDS, 0, -1):
        path = ws.folder(f"answers{n}")
        waves = WAVES[n - 1]
        for wave in range(waves):
            own = range(wave * shards, (wave + 1) * shards)
            if n == WORDS:
                asked = blocks.mapInArrow(_ask_longest(own, waves * shards), _ASKED_DDL)
            else:
                owned = answers[n + 1].where("owned is not null").select("shard", "block", "owned")
                asked = blocks.groupBy("block").cogroup(owned.groupBy("block")).applyInArrow(_ask_shorter(n, own, waves * shards), _ASKED_DDL)
            asked.groupBy("shard").applyInArrow(_answer(n), _ANSWER_DDL).write.option("compression", "none").parquet(f"{path}/wave={wave}")
            ws.settle()
        answers[n] = spark.read.schema(f"{_ANSWER_DDL}, wave int").parquet(path)
    stats = functools.reduce(DataFrame.unionAll, [a.where("stats is not null").select("lang", "stats") for a in answers.values()])
    sums = stats.groupBy("lang").agg(F.array(*[F.sum(F.col("stats")[k]) for k in range(WORDS * (FOLDS + 1) * 6)]).alias("stats"))
    cuts = ws.table(sums.mapInArrow(_cuts, "lang string, cuts array<array<double>>"), "cuts")
    found = functools.reduce(DataFrame.unionAll, [a.where("block is not null").select(F.lit(n).alias("n"), "shard", "block", "found") for n, a in answers.items()])
    with_cuts = texts.read().join(F.broadcast(cuts), "lang", "left")  # one row per language
    path, schema = ws.folder("scored"), "doc_id long, lang string, n_chars long, trusted boolean, entropy double"
    for wave in range(SCORE_WAVES):
        own, to_own = (df.where(F.pmod(F.xxhash64("block"), F.lit(SCORE_WAVES)) == wave) for df in (with_cuts, found))
        own.groupBy("block").cogroup(to_own.groupBy("block")).applyInArrow(_score_block, schema).write.parquet(f"{path}/wave={wave}")
        ws.settle()
    texts.forget()
    ws.drop("texts", *[f"answers{n}" for n in answers])
    return spark.read.schema(f"{schema}, wave int").parquet(path).drop("wave")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, lang, n_chars, entropy, perplexity, threshold, kept) for each row of docs.

    Trusted are documents that labels give quality 1 and not toxic 1; copies of a text share its fold. Null
    and empty texts, and languages without trusted text, have no entropy and are kept. A null language is
    one of its own.
    ``docs`` needs doc_id, text and lang; other columns are not read. No rows give no rows.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "quality")
    lang = F.col("lang").cast("string")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(lang, F.lit("\0none")).alias("lang"), lang.alias("lang_was"), F.col("text").cast("string").alias("text"))
    good = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    good = ws.table(good.where("doc_id is not null and quality = 1 and coalesce(toxic, 0) <> 1").select("doc_id"), "trusted")
    ids = F.broadcast(good) if good.count() <= BROADCAST_IDS else good
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")
    known = ids.withColumn("known", F.lit(True))
    plain = plain.join(known, "doc_id", "left").withColumn("model", F.when(F.col("known"), fold).otherwise(F.lit(FOLDS)))
    scored = perplexities(ws, plain)

    # Short texts scatter far more than long ones, so a quantile is one of a language's trusted documents of about
    # the same length, exact to a bin: counts by bin are few, whatever the number of documents. It is drawn
    # towards the mean and the quantile of all languages' distances from their means, the more the fewer its documents.
    # A language without trusted documents of a length takes its mean over all; one without any, the quantile over all.
    own = F.coalesce("lang", F.lit("\0none"))
    size = F.lit(0)
    for k, chars in enumerate(LENGTHS, 1):
        size = F.when(F.col("n_chars") >= chars, k).otherwise(size)
    scored = scored.withColumn("l", own).withColumn("size", size)
    judged = scored.where(F.col("entropy").isNotNull() & F.col("trusted")).select("l", "size", "entropy")
    means = F.broadcast(ws.table(judged.groupBy("l", "size").agg(F.avg("entropy").alias("mean"), F.count("*").alias("judged")), "means"))  # a row per language and length
    langs = F.broadcast(judged.groupBy("l").agg(F.avg("entropy").alias("lang_mean")))

    def quantiles(rows: DataFrame, name: str, *by: str) -> DataFrame:
        bins = rows.groupBy(*by, F.floor(F.col("entropy") / BIN).cast("long").alias("bin")).agg(F.count("*").alias("n"))
        bins = bins.withColumn("upto", F.sum("n").over(Window.partitionBy(*by).orderBy("bin"))).withColumn("all", F.sum("n").over(Window.partitionBy(*by)))
        return bins.where(F.col("upto") >= F.col("all") * quantile).groupBy(*by).agg(((F.min("bin") + 1) * BIN).alias(name))

    apart = judged.join(means, ["l", "size"]).select("size", F.lit(0).alias("one"), (F.col("entropy") - F.col("mean")).alias("entropy"))
    by_size = F.broadcast(ws.table(quantiles(apart, "apart", "size"), "by-size"))  # a row per length
    over_all = quantiles(judged.withColumn("one", F.lit(0)), "over_all", "one").join(quantiles(apart, "apart_all", "one"), "one").drop("one")
    over_all = F.broadcast(ws.table(over_all, "over-all"))  # one row
    exact = quantiles(judged, "exact", "l", "size").join(means, ["l", "size"]).join(by_size, "size")
    drawn = (F.col("exact") * F.col("judged") + (F.col("mean") + F.col("apart")) * DRAW) / (F.col("judged") + DRAW)
    limits = F.broadcast(ws.table(exact.select("l", "size", drawn.alias("limit")), "limits"))
    out = scored.join(limits, ["l", "size"], "left").join(langs, "l", "left").join(by_size, "size", "left").join(over_all, how="left")
    out = out.withColumn("limit", F.coalesce("limit", F.col("lang_mean") + F.coalesce("apart", "apart_all"), "over_all"))
    return out.select("doc_id", "lang", "n_chars", "entropy", F.exp("entropy").alias("perplexity"), F.exp("limit").alias("threshold"), F.coalesce(F.col("entropy") <= F.col("limit"), F.lit(True)).alias("kept"))
