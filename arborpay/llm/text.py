"""Words and shingles of whole texts as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so its powers have inverses
_RULES = np.random.default_rng(20240611)
_BYTE = _RULES.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"n": 0}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of them."""
    if _powers["n"] < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        inverse = pow(_BASE, -1, 2**64)
        with np.errstate(over="ignore"):
            up = np.cumprod(np.full(size, _BASE, np.uint64), dtype=np.uint64)
            down = np.cumprod(np.full(size, inverse, np.uint64), dtype=np.uint64)
        _powers.update(n=size, up=up, down=down)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _MIX
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def canonical(text: str | None) -> bytes:
    """Lower case for A-Z, words apart by one space; words end at bytes 20 and 09 to 0D alone."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each span, from one running polynomial."""
    up, down = power_tables(len(data) + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64, out=run[1:])
        return mix((run[ends] - run[starts]) * down[starts])


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a canonical text."""
    gaps = np.flatnonzero(data == 32)
    return np.concatenate([[0], gaps + 1]).astype(np.int64), np.concatenate([gaps, [len(data)]]).astype(np.int64)


def shingles(canon: bytes, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all runs of so many words; a shorter text is one run; none without words."""
    if not canon:
        return np.empty(0, np.uint64)
    data = np.frombuffer(canon, np.uint8)
    starts, ends = word_spans(data)
    if len(starts) < words:
        return span_hashes(data, starts[:1], ends[-1:])
    return np.unique(span_hashes(data, starts[: len(starts) - words + 1], ends[words - 1 :]))
