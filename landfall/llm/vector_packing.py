"""Packing of tokenised documents into fixed-length sequences by vector bin packing.

Each example has a demand vector: tokens, segments (1) and loss-bearing tokens (those of the last tokens
of its document that bear loss, all unless said, but for the first of its piece, which has none before
it there). A sequence has limits on all three. An example goes to the open sequence
where the dot product of its demand and the sequence's free room, both as shares of the limits, is
largest among those that it fits. When it fits none and ``OPEN`` sequences are open, it is cut to fill
the best one and the rest is placed in turn, so sequences close without padding. What is still open at
the end of a task is cut into full sequences and then into lengths that are powers of two, which are
not padded.

Every task packs the rows of its own partition; it holds at most ``OPEN`` sequences and one document.
Sequence ids hold the partition number, so they are unique without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.tokenizers_common import Cache, tokenizer_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Limits of a sequence: tokens, segments, loss-bearing tokens.
LIMITS = (2048, 256, 2048)
OPEN = 32
ROWS_OUT = 4096
_PLAIN = re.compile("([a-zß-öø-ÿ]+)([.,;:!?]*)")
_SPLIT = re.compile("[ \t\n\r]+")


class WordIds:
    """Ids of a whole text by the tokenizers library, one run between blanks at a time.

    The vocabulary's pattern drops white space and matches nothing across it, and its normaliser
    (composition, white space, lower case) does not act across it either, so a text's ids are those of
    its runs one after the other. A run of plain letters and closing punctuation is two matches of the
    pattern; its letters go straight to the library's BPE model. Everything else is encoded whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        self.byte_chars = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.runs = Cache(self._run)
        self.words = Cache(self._word, 200_000)
        self.marks = Cache(self._whole, 10_000)

    def _whole(self, run: str) -> bytes:
        return np.array(self.tokenizer.encode(run, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        mapped = word if word.isascii() else "".join([self.byte_chars[b] for b in word.encode()])
        return np.array([t.id for t in self.model.tokenize(mapped)], dtype="<u4").tobytes()

    def _run(self, run: str) -> bytes:
        m = _PLAIN.fullmatch(run)
        if m is None:
            return self._whole(run)
        word, mark = m.groups()
        return self.words[word] + self.marks[mark] if mark else self.words[word]

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of the text and the end id."""
        if not text:
            return END_ID.to_bytes(4, "little")
        low = text
        if "<|" not in text:  # else a special token's own letter case matters
            try:
                text.isascii() or text.encode("latin-1")
                low = text.lower()
            except UnicodeEncodeError:
                pass
        runs = [r for r in _SPLIT.split(low) if r] if _ODD_SPACE.search(low) else low.split()
        return b"".join(map(self.runs.__getitem__, runs)) + END_ID.to_bytes(4, "little")


#: White space that str.split() splits at beside the four of ``_SPLIT``.
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


@lru_cache(maxsize=1)
def shared(path: str) -> WordIds:
    """One tokenizer a Python worker: tasks that follow each other there find its caches warm."""
    return WordIds(path)


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: bytes
    doc_tokens: int
    loss_from: int = 0  # of the document's tokens, the first that bears loss

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def loss(self, n: int) -> int:
        """Loss-bearing tokens among the first ``n``."""
        return max(0, self.start + n - max(self.loss_from, self.start + 1))

    def within(self, loss: int) -> int:
        """How many tokens from the first on hold at most ``loss`` loss-bearing ones."""
        return loss + max(self.loss_from, self.start + 1) - self.start

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc_id, self.start, self.ids[:4 * n], self.doc_tokens, self.loss_from),
                Piece(self.doc_id, self.start + n, self.ids[4 * n:], self.doc_tokens, self.loss_from))


class Packer:
    """Places examples; ``add`` and ``finish`` return closed sequences (lists of pieces)."""

    def __init__(self, limits: tuple[int, int, int] = LIMITS, opened: int = OPEN):
        if limits[0] & (limits[0] - 1) or min(limits[1:]) < 1:
            raise ValueError("the token limit must be a power of two and the other limits positive")
        self.limits = limits
        self.opened = opened
        self.room: list[list[int]] = []  # of each open sequence: tokens, segments, loss-bearing tokens
        self.bins: list[list[Piece]] = []

    def _best(self, n: int, loss: int, fitting: bool) -> int:
        """The open sequence with the largest dot product of demand and room, as shares of the limits
        (the first of equal ones); with ``fitting`` of those with room for all, or -1."""
        a, b, c = (d / (x * x) for d, x in zip((n, 1, loss), self.limits))
        at, most = -1, -1.0
        for k, (tokens, segments, bearing) in enumerate(self.room):
            if not fitting or (tokens >= n and segments >= 1 and bearing >= loss):
                score = tokens * a + segments * b + bearing * c
                if score > most:
                    at, most = k, score
        return at

    def _open(self) -> int:
        self.bins.append([])
        self.room.append(list(self.limits))
        return len(self.bins) - 1

    def add(self, piece: Piece):
        tokens = self.limits[0]
        if tokens - 1 <= self.limits[2]:  # full sequences first, each sliced once from the whole
            first, edge = piece.start, piece.length // tokens * tokens
            for k in range(0, edge, tokens):
                yield [Piece(piece.doc_id, first + k, piece.ids[4 * k:4 * (k + tokens)], piece.doc_tokens, piece.loss_from)]
            _, piece = piece.cut(edge)
        while piece.length:
            n, loss = piece.length, piece.loss(piece.length)
            at = self._best(n, loss, True)
            if at >= 0:
                here, piece = piece.cut(n)
            elif len(self.bins) < self.opened and n <= tokens and loss <= self.limits[2]:
                at = self._open()
                here, piece = piece.cut(n)
            else:
                at = self._best(n, loss, False) if self.bins else self._open()
                here, piece = piece.cut(min(n, self.room[at][0], piece.within(self.room[at][2])))
            room = self.room[at]
            self.bins[at].append(here)
            room[0] -= here.length
            room[1] -= 1
            room[2] -= here.loss(here.length)
            if room[0] == 0:
                yield self._close(at)
            elif room[1] == 0 or room[2] <= 0:
                yield from self._powers(self._close(at))

    def _close(self, at: int) -> list[Piece]:
        self.room.pop(at)
        return self.bins.pop(at)

    def _powers(self, pieces: list[Piece]):
        """Cuts pieces into sequences of the token limit, or of powers of two for what is left."""
        pieces = pieces[::-1]
        left = sum(p.length for p in pieces)
        while left:
            size = min(self.limits[0], 1 << (left.bit_length() - 1))
            out, used, loss = [], 0, 0
            while used < size and len(out) < self.limits[1] and loss < self.limits[2]:
                p = pieces.pop()
                n = min(p.length, size - used, p.within(self.limits[2] - loss))
                here, rest = p.cut(n)
                out.append(here)
                used += n
                loss += here.loss(n)
                if rest.length:
                    pieces.append(rest)
            keep = 1 << (used.bit_length() - 1)
            while used > keep:  # a limit other than tokens was met: give back what is over a power of two
                p = out.pop()
                n = min(p.length, used - keep)
                here, rest = p.cut(p.length - n)
                if here.length:
                    out.append(here)
                pieces.append(rest)
                used -= n
            left -= used
            yield out

    def finish(self):
        pieces = [p for b in self.bins for p in b]
        self.bins, self.room = [], []
        yield from self._powers(pieces)


def _pack(path: str | None, limits, opened: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        words = shared(path or tokenizer_path(VOCABULARY))
        packer, rows, at = Packer(limits, opened), [], TaskContext.get().partitionId() << 40

        def flush():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
            rows.clear()

        def close(sequences):
            nonlocal at
            for pieces in sequences:
                offset = 0
                for p in pieces:
                    rows.append((p.doc_id, p.start, p.length, zlib.crc32(p.ids), p.doc_tokens, at, offset))
                    offset += p.length
                at += 1

        for b in batches:
            for doc_id, text, loss in zip(*(b.column(k).to_pylist() for k in range(3))):
                ids = words.ids(text)
                n = len(ids) // 4
                close(packer.add(Piece(doc_id, 0, ids, n, 0 if loss is None else max(0, n - max(0, loss)))))
                if len(rows) >= ROWS_OUT:
                    yield from flush()
        close(packer.finish())
        if rows:
            yield from flush()

    return run


def pack(docs: DataFrame, path: str | None = None, limits: tuple[int, int, int] = LIMITS, opened: int = OPEN, loss: Column | None = None) -> DataFrame:
    """One row per piece of ``docs (doc_id, text, ...)``: ``doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset``.

    ``loss`` is how many of a row's last tokens, the end id among them, bear loss (the answer of an
    instruction); all of them where it is not given, NULL or too large, none where it is negative.
    A NULL or empty text is its end id alone; a NULL doc_id stays NULL; rows that repeat are packed
    each; an empty table gives no rows; other columns are ignored."""
    bearing = F.lit(None).cast("long") if loss is None else loss.cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", bearing.alias("loss")).mapInArrow(
        _pack(path, limits, opened), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
