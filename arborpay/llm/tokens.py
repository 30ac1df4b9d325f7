"""Whole-text tokenisation inside Spark tasks, with ids cached per white-space chunk.

The word tokenizer never joins characters across ASCII white space, so the ids of a text are the
ids of its chunks one after the other. Most chunks repeat, and a repeated chunk costs one look-up.
"""

from __future__ import annotations

import base64
import json
import os
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex

#: Entries a worker keeps before it starts afresh; bounds the memory of one Python worker.
CACHE_ENTRIES = 600_000
#: Marks that make a piece of their own after a word.
_MARKS = b".,;:!?"
_WORKER: dict[str, "ChunkTokenizer | ByteEncoding"] = {}


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file: a path as it is, a bare name from the installed public files."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte, by its published rule."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ChunkTokenizer:
    """Encodes texts to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.cache = _ChunkCache(self._chunk)
        self.letters = _byte_letters()
        self.model = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}
        self.ids = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        rules = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"]
        self.split = regex.compile(next(r["pattern"]["Regex"] for r in rules if r["type"] == "Split")).findall

    def whole(self, text: str) -> bytes:
        """The library's own result for a text."""
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _ids(self, mapped: str) -> bytes:
        """Ids of a piece whose bytes stand as printable letters."""
        found = self.model.tokenize(mapped)
        return self.ids[found[0].id] if len(found) == 1 else b"".join([self.ids[t.id] for t in found])

    def _piece(self, piece: str) -> bytes:
        """Ids of one lower-case piece that the pre-tokenizer leaves whole."""
        out = self.pieces.get(piece)
        if out is None:
            # Printable ASCII stands for itself; a piece has no space.
            plain = piece.isascii() and piece.isprintable()
            out = self._ids(piece if plain else piece.encode().decode("latin-1").translate(self.letters))
            if len(piece) < 7:  # suffixes, marks and short words come back; long ones are in the chunk cache
                self.pieces[piece] = out
        return out

    def _chunk(self, raw: bytes) -> bytes:
        """Ids of one unseen chunk. Latin-1 text is already in composed form; anything else takes the library's way."""
        if raw.isalpha():  # ASCII letters are one piece
            return self._ids(raw.lower().decode())
        word, mark = raw[:-1].lower(), raw[-1:]
        if mark in _MARKS and word.isalpha():  # a long word is kept as a chunk, so marks don't have it encoded again
            return (self.cache[word] if len(word) > 6 else self._piece(word.decode())) + self._piece(mark.decode())
        chunk = raw.decode()
        if max(chunk) < "\u0100" and "<|" not in chunk:
            chunk = chunk.lower()
            if chunk.isalpha():  # letters beyond ASCII are one piece, too
                return self._piece(chunk)
            if mark in _MARKS and chunk[:-1].isalpha():
                return (self.cache[chunk[:-1].encode()] if len(chunk) > 7 else self._piece(chunk[:-1])) + self._piece(chunk[-1])
            return b"".join(map(self._piece, self.split(chunk)))
        return self.whole(chunk)

    def encode(self, raws: list[bytes | None]) -> list[bytes]:
        """Ids of each text, given in UTF-8; a null text has none."""
        cache = self.cache
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
            self.pieces.clear()
        get = cache.__getitem__
        # Special tokens keep their case; otherwise only capitals of A-Z change, as the tokenizer does itself.
        return [b"".join(map(get, (raw if b"<|" in raw else raw.lower()).split())) if raw else b"" for raw in raws]


class _ChunkCache(dict):
    """Ids by chunk; an unseen chunk is encoded when it is asked for."""

    def __init__(self, encode: Callable[[bytes], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, raw: bytes) -> bytes:
        out = self[raw] = self.encode(raw)
        return out


def worker_tokenizer(name: str) -> ChunkTokenizer:
    """The tokenizer of this Python worker, loaded once."""
    if name not in _WORKER:
        _WORKER[name] = ChunkTokenizer(name)
    return _WORKER[name]


def encode_column(column, name: str, batch: int = 128):
    """Yield the id bytes of an Arrow string column, a few texts at a time."""
    tok = worker_tokenizer(name)
    for at in range(0, len(column), batch):
        yield from tok.encode(column.slice(at, batch).cast(pa.binary()).to_pylist())


class ByteEncoding:
    """A byte-level vocabulary given as ranks, with marks that are tokens of their own after its ids."""

    def __init__(self, name: str, marks: tuple[str, ...] = ()):
        import public_tokenizers
        import tiktoken

        with open(tokenizer_path(name), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        first = max(ranks.values()) + 1
        special = {mark: first + i for i, mark in enumerate(marks)}
        self._encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._marks = set(marks)
        self.pieces = [b""] * first + [mark.encode() for mark in marks]
        for token, rank in ranks.items():
            self.pieces[rank] = token
        self.sizes = np.array([len(piece) for piece in self.pieces], np.int64)

    def encode(self, text: str) -> list[int]:
        if not self._marks:
            return self._encoding.encode_ordinary(text)
        return self._encoding.encode(text, allowed_special=self._marks, disallowed_special=())

    def encode_array(self, text: str) -> np.ndarray:
        """Ids of a text, in which marks are plain text."""
        return self._encoding.encode_to_numpy(text, disallowed_special=())


def byte_encoding(name: str, marks: tuple[str, ...] = ()) -> ByteEncoding:
    """The encoding of this Python worker, loaded once."""
    key = "\0".join([name, *marks])
    if key not in _WORKER:
        _WORKER[key] = ByteEncoding(name, marks)
    return _WORKER[key]


def count_column(column, name: str, batch: int = 128):
    """Yield how many ids each text of an Arrow string column has under a vocabulary; a null text has none.

    A name that ends in .tiktoken is a table of ranks of a byte-level vocabulary, any other a word vocabulary.
    """
    if not name.endswith(".tiktoken"):
        yield from (len(ids) // 4 for ids in encode_column(column, name, batch))
        return
    encoding = byte_encoding(name)
    for text in column:
        yield len(encoding.encode(text.as_py() or ""))
