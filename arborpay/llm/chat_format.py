"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and the sorted spans of its turns are
intersected with the token spans by binary search. The template's marks are tokens of their own, on
both sides of every text, so no token reaches over the end of a text and the mask holds no part of a
mark. Control strings inside texts get a backslash that reading back takes away, so no text can end
its turn or start another.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborpay.llm.tokens import byte_encoding

#: Marks of the template: before a role, between role and text, after a text.
START, TEXT, END = "<|im_start|>", "<|im_text|>", "<|im_end|>"
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_ROLE = {"\\": "\\\\", "\n": "\\n", "|": "\\|"}
_ROLE_BACK = {"\\": "\\", "n": "\n", "|": "|"}
FORMATTED = "conv_id long, text string, ids array<int>, token_starts array<int>, token_ends array<int>, loss array<boolean>, loss_starts array<int>, loss_ends array<int>"


def escape(text: str) -> str:
    """A text in which no ``<|`` is left."""
    return _ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The formatted conversation, and (start, end, role) of each turn's text in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = f"{START}{''.join(_ROLE.get(c, c) for c in role)}{TEXT}"
        body = escape(text)
        spans.append((at + len(head), at + len(head) + len(body), role))
        whole = f"{head}{body}{END}"
        out.append(whole)
        at += len(whole)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError("not a formatted conversation")
        line = formatted.index(TEXT, at)
        stop = formatted.index(END, line)
        role = re.sub(r"\\(.)", lambda m: _ROLE_BACK[m[1]], formatted[at + len(START) : line], flags=re.S)
        turns.append((role, unescape(formatted[line + len(TEXT) : stop])))
        at = stop + len(END)
    return turns


def token_spans(encoding, ids: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) character of each token; a token of a part of a character has all of it."""
    ends = np.cumsum(encoding.sizes[ids]) if len(ids) else np.empty(0, np.int64)
    starts = ends - encoding.sizes[ids]
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(raw) != (ends[-1] if len(ends) else 0):
        raise ValueError("the tokens don't cover the text")
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char[starts], char[ends - 1] + 1


def mask(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens bear loss: those within a span; all inputs are sorted."""
    bears = np.zeros(len(starts), bool)
    for s, e in spans:
        if s < e:
            bears[int(np.searchsorted(starts, s, "left")) : int(np.searchsorted(ends, e, "right"))] = True
    return bears


def covered(bears: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Runs of text under the tokens that bear loss."""
    s, e = starts[bears], ends[bears]
    if not len(s):
        return []
    first = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
    return list(zip(s[first].tolist(), e[np.append(first[1:] - 1, len(e) - 1)].tolist(), strict=True))


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else [], kind))


def _formatter(vocabulary: str, roles: tuple[str, ...]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = byte_encoding(vocabulary, (START, TEXT, END))
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                texts, ids, starts, ends, bears, runs = [], [], [], [], [], []
                for turns in part.column(1).to_pylist():
                    text, spans = render([(t["role"] or "", t["text"] or "") for t in turns])
                    own = np.asarray(encoding.encode(text), np.int64)
                    first, last = token_spans(encoding, own, text)
                    loss = mask([(s, e) for s, e, role in spans if role in roles], first, last)
                    for rows, x in zip((texts, ids, starts, ends, bears, runs), (text, own, first, last, loss, covered(loss, first, last)), strict=True):
                        rows.append(x)
                arrays = [_lists([r.astype(np.int32) for r in rows], pa.int32()) for rows in (ids, starts, ends)]
                under = [_lists([np.array([x[k] for x in r], np.int32) for r in runs], pa.int32()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), *arrays, _lists(bears, pa.bool_()), *under], [c.split()[0] for c in FORMATTED.split(", ")])

    return run


def format_conversations(conversations: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: text, ids, token spans, loss mask by token and the runs of text under it.

    The marks of the template have the three ids after the vocabulary's. Turns go by turn, then role and
    text, nulls first; repeated rows stay. Null texts and roles count as empty. Rows without conv_id are
    one conversation. A conversation is one row by definition, so the longest one must fit a task. No
    rows give no rows; columns beside conv_id, turn, role and text are not read.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    grouped = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return grouped.mapInArrow(_formatter(vocabulary, tuple(loss_roles)), FORMATTED)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i in range(len(batch)):
            conv, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            starts, ends, bears = (batch.column(k)[i].values.to_numpy(zero_copy_only=False) for k in (2, 3, 4))
            turns = parse(text)
            told = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
            loss = "".join(unescape(text[a:b]) for a, b in covered(bears.astype(bool), starts, ends))
            rows.append((conv, len(turns), told, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        cols = list(zip(*rows, strict=True)) if rows else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts say when read back, and the text under the tokens that bear loss."""
    return formatted.select("conv_id", "text", "token_starts", "token_ends", "loss").mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
