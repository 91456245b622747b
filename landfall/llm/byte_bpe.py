"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece the one valid last token is stored. A token is valid at the end of a prefix
when it and the last token of the prefix before it stay apart if the bytes of just these two are merged
by rank; a sequence whose neighbours all stay apart is the merge result of the whole. So bytes can be
appended at the cost of the new ones, and an edit is encoded again from its place to where the stored
tokens agree with the old ones over the length of the longest token.

A text is cut by the tokenizer's pattern first, as the tiktoken library does; a piece that is a token as
a whole is that token.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.tokenizers_common import Cache, tokenizer_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
DECODED_AT_ONCE = 1 << 18
#: Runs in which a blank stands between other white space: their pieces may span several words.
_MIXED_SPACE = regex.compile(r"\s \s")


class ByteBpe:
    """A vocabulary of ranks; encodes and decodes pieces and whole texts."""

    def __init__(self, path: str, pattern: str | None = None):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if pattern is None:
            import public_tokenizers

            pattern = public_tokenizers.PATTERN
        self.pattern = regex.compile(pattern)
        self.token_bytes = {i: t for t, i in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        # Finds the tokens that end at each byte; bytes are its characters of the same number.
        self.ending = ahocorasick.Automaton()
        for t, i in self.ranks.items():
            self.ending.add_word(t.decode("latin-1"), (i, len(t)))
        self.ending.make_automaton()
        self.apart = Cache(lambda k: self._stay_apart((k >> 32, k & 0xFFFFFFFF)))  # one number a pair
        self.halves = Cache(lambda t: self._halves(t), 1 << 20)
        self.history = Cache(lambda t: self._history(t) or False, 1 << 20)
        self.sound = Cache(lambda t: self.merge(self.token_bytes[t]) == [t])
        self.pieces = Cache(self._piece, 100_000)
        self.runs = Cache(self._run)
        # Bytes of all tokens one after the other, and where each begins.
        top = max(self.token_bytes) + 1
        self.sizes = np.array([len(self.token_bytes.get(i, b"")) for i in range(top)], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.token_bytes.get(i, b"") for i in range(top)), dtype=np.uint8)

    def merge(self, data: bytes) -> list[int]:
        """Ids by repeated merging of the neighbours of lowest rank: the definition, for short inputs."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min(((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _history(self, token: int) -> tuple[list, list] | None:
        """The tokens that have stood at the left and at the right end of ``token`` while it was
        merged: (token, rank that made it, rank that took it in), from the whole inwards; None if some
        token ranks before its own parts."""
        left, right = [], []
        for side, out in ((0, left), (1, right)):
            t, taken = token, 1 << 60
            while True:
                halves = self.halves[t]
                made = -1 if len(halves) == 1 else t
                if made >= taken:
                    return None
                out.append((self.token_bytes[t], made, taken))
                if len(halves) == 1:
                    break
                taken, t = t, halves[side]
        return left, right

    def _halves(self, token: int) -> tuple:
        """The two tokens of the last merge that makes ``token``; for a byte (None,)."""
        data = self.token_bytes[token]
        if len(data) == 1:
            return (None,)
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 2:
            rank, at = min(((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if rank == 1 << 60:
                return (None,)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]])

    def _stay_apart(self, pair: tuple[int, int]) -> bool:
        """Whether merging the bytes of two sound tokens gives just these two. They would meet only in a
        merge of an end of the first with an end of the second, while both stand, of a rank before
        those that take them in (of equal ranks the merge further left goes first)."""
        first, second = self.history[pair[0]], self.history[pair[1]]
        if not first or not second:
            return self.merge(self.token_bytes[pair[0]] + self.token_bytes[pair[1]]) == list(pair)
        for x, made_x, taken_x in first[1]:
            for y, made_y, taken_y in second[0]:
                if made_x < taken_y and made_y < taken_x:
                    rank = self.ranks.get(x + y)
                    if rank is not None and rank < taken_x and rank <= taken_y:
                        return False
        return True

    def extend(self, data: bytes, last: list[int], stop_at: list[int] | None = None, shift: int = 0) -> list[int]:
        """Fills ``last`` (the last token of each prefix of 1, 2, ... bytes) up to ``data``. With
        ``stop_at``, the tokens of a text whose end agrees, ``shift`` bytes further on, it ends early
        when they have agreed for as many bytes as the longest token has."""
        apart, sound, done, agreed = self.apart, self.sound, len(last), 0
        at = max(0, done - self.longest + 1)  # no token that ends after the known prefixes starts before
        for end, (token, size) in self.ending.iter(data[at:].decode("latin-1")):
            end += at
            if end < done:
                continue
            if end > done:
                break
            start = end + 1 - size
            if not (apart[last[start - 1] << 32 | token] if start else sound[token]):
                continue
            last.append(token)
            done += 1
            if stop_at is not None:
                old = done + shift
                agreed = agreed + 1 if 0 < old <= len(stop_at) and stop_at[old - 1] == token else 0
                if agreed >= self.longest:
                    last.extend(stop_at[old:])
                    return last
        if len(last) < len(data):
            raise ValueError("the vocabulary has no token for a byte")
        return last

    def prefixes(self, data: bytes) -> list[int]:
        """``extend`` from nothing, for the many short pieces of a text."""
        apart, sound, last, done = self.apart, self.sound, [], 0
        for end, (token, size) in self.ending.iter(data.decode("latin-1")):
            if end == done:
                start = end + 1 - size
                if apart[last[start - 1] << 32 | token] if start else sound[token]:
                    last.append(token)
                    done += 1
            elif end > done:
                break
        if done < len(data):
            raise ValueError("the vocabulary has no token for a byte")
        return last

    def walk(self, last: list[int]) -> list[int]:
        """Ids of the whole, from the last tokens of its prefixes."""
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.token_bytes[out[-1]])
        return out[::-1]

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else self.walk(self.prefixes(data))
        return struct.pack(f"<{len(ids)}I", *ids)

    def _cut(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def _run(self, run: str) -> bytes:
        """Ids of a blank and a run; a run of one piece is remembered as a run only."""
        pieces = self.pattern.findall(" " + run)
        return self._piece(pieces[0]) if len(pieces) == 1 else b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text. The pattern's matches never span a blank
        between two words, so runs between single blanks are cut one at a time."""
        if not text:
            return b""
        if "  " in text or _MIXED_SPACE.search(text):
            return self._cut(text)
        first, *rest = text.split(" ")
        return self._cut(first) + b"".join(map(self.runs.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        tokens = np.frombuffer(ids, dtype="<u4")
        if tokens.size and int(tokens.max()) >= self.sizes.size:
            raise KeyError(int(tokens.max()))
        out = []
        for k in range(0, tokens.size, DECODED_AT_ONCE):
            own = tokens[k:k + DECODED_AT_ONCE]
            size = self.sizes[own]
            if not size.all():
                raise KeyError(int(own[size == 0][0]))
            ends = np.cumsum(size)
            out.append(self.flat[np.arange(ends[-1]) + np.repeat(self.starts[own] - ends + size, size)].tobytes())
        return b"".join(out)


class PrefixEncoding:
    """One piece of bytes that grows or changes; ``ids`` is always its exact encoding by merges."""

    def __init__(self, bpe: ByteBpe, data: bytes = b""):
        self.bpe, self.data = bpe, data
        self.last = bpe.extend(data, [])

    def append(self, more: bytes) -> None:
        self.data += more
        self.bpe.extend(self.data, self.last)

    def edit(self, start: int, stop: int, new: bytes) -> None:
        """Replaces ``data[start:stop]`` by ``new``."""
        old = self.last
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = self.bpe.extend(self.data[:start + len(new)], old[:start])
        self.bpe.extend(self.data, self.last, old, stop - start - len(new))

    @property
    def ids(self) -> list[int]:
        return self.bpe.walk(self.last)


@lru_cache(maxsize=1)
def shared(path: str) -> ByteBpe:
    """One vocabulary a Python worker: tasks that follow each other there find its caches warm."""
    return ByteBpe(path)


def _round_trip(path: str | None):
    def run(batches):
        bpe = shared(path or tokenizer_path(VOCABULARY))
        for b in batches:
            n, ids_hash, text_hash = [], [], []
            for text in b.column(1).to_pylist():
                ids = bpe.encode(text)
                n.append(len(ids) // 4)
                ids_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row of ``docs (doc_id, text, ...)``: ``doc_id, n_tokens``, the SHA-256 of its ids (as
    little-endian unsigned 32-bit integers) and of the bytes they decode to. NULL is encoded as the empty
    text (no ids); rows that repeat are each encoded; an empty table gives no rows."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(_round_trip(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _ids(path: str | None, decode: bool):
    def run(batches):
        bpe = shared(path or tokenizer_path(VOCABULARY))
        for b in batches:
            if decode:
                out = [None if x is None else bpe.decode(np.array(x, dtype="<u4").tobytes()) for x in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])
            else:
                out = [np.frombuffer(bpe.encode(x), dtype="<u4").astype(np.int32) for x in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` (array of int) of every whole text; NULL and empty texts give an empty array."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_ids(path, False), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, bytes`` from ``(doc_id, ids)``; NULL ids give NULL."""
    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(_ids(path, True), "doc_id long, bytes binary")
