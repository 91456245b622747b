"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole: each turn is ``<|im_start|>role<|im_sep|>text<|im_end|>``. Control
strings inside roles and texts get one more backslash after their first character (``<\\|im_end|>``);
reading drops one, so any text comes back as it was. The formatted string is encoded once with
character offsets, and the sorted spans of the turns that bear loss are intersected with the token
spans by binary search. Control strings are single tokens, so token edges fall on the edges of texts.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.tokenizers_common import tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: The template's own control strings and those that other templates or vocabularies give a meaning.
CONTROLS = (START, SEPARATOR, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
LOSS_ROLES = ("assistant",)
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROLS)
_PLAIN = re.compile(rf"([<\[])(\\*(?:{_TAILS}))")
_ESCAPED = re.compile(rf"([<\[])\\(\\*(?:{_TAILS}))")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, int]]]:
    """The formatted conversation and the span of each turn's text (start, end, turn)."""
    out, at, spans = [], 0, []
    for i, (role, text) in enumerate(turns):
        head, body = f"{START}{escape(role)}{SEPARATOR}", escape(text)
        spans.append((at + len(head), at + len(head) + len(body), i))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition(SEPARATOR)
        turns.append((unescape(role), unescape(rest[: rest.index(END)])))
    return turns


def mask_spans(tokens: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Intersections (token, start, end) of token spans with sorted, disjoint text spans. ``tokens``
    (n, 2) is sorted; tokens that share a character each have it in their span."""
    out = [np.empty((0, 3), dtype=np.int64)]
    for lo, hi in spans.tolist():
        if lo < hi:
            first = int(np.searchsorted(tokens[:, 1], lo, side="right"))
            last = int(np.searchsorted(tokens[:, 0], hi, side="left"))
            own = tokens[first:last]
            out.append(np.stack([np.arange(first, last), np.maximum(own[:, 0], lo), np.minimum(own[:, 1], hi)], axis=1))
    return np.concatenate(out)


def masked_text(formatted: str, mask: np.ndarray) -> str:
    """All text under the mask, unescaped, in order; a character that tokens share counts once."""
    out, lo, hi = [], 0, 0
    for _, a, b in [*mask.tolist(), (0, 1 << 60, 1 << 60)]:
        if a > hi:
            out.append(unescape(formatted[lo:hi]))
            lo = a
        hi = max(hi, b)
    return "".join(out)


class Formatter:
    """Formats conversations and masks their tokens."""

    def __init__(self, path: str, loss_roles: tuple[str, ...] = LOSS_ROLES):
        from tokenizers import AddedToken, Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in (START, SEPARATOR, END)])
        self.loss_roles = loss_roles

    def format(self, turns: list[tuple[str, str]]):
        """Formatted string, token ids and loss spans (token, start, end)."""
        formatted, spans = render(turns)
        encoded = self.tokenizer.encode(formatted, add_special_tokens=False)
        offsets = np.array(encoded.offsets, dtype=np.int64).reshape(-1, 2)
        # Each token reaches to the next one's start, should the tokenizer leave blanks out of its offsets.
        if len(offsets):
            offsets[:, 0] = np.minimum(offsets[:, 0], np.append(0, np.maximum.accumulate(offsets[:-1, 1])))
        own = np.array([(a, b) for a, b, i in spans if turns[i][0] in self.loss_roles], dtype=np.int64).reshape(-1, 2)
        return formatted, encoded.ids, mask_spans(offsets, own)


FORMATTED = "conv_id long, formatted string, ids array<int>, mask array<struct<token:int,start:int,end:int>>"


def _format(path: str | None):
    def run(batches):
        formatter = Formatter(path or tokenizer_path(VOCABULARY))
        held, turns, rows, size = object(), [], [], 0

        def flush():
            ids, texts, tokens, masks = zip(*rows)
            ends = pa.array(np.cumsum([0] + [len(m) for m in masks]).astype(np.int32))
            flat = np.concatenate(masks).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(flat[:, i].copy()) for i in range(3)], names=["token", "start", "end"])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(tokens, pa.list_(pa.int32())),
                                              pa.ListArray.from_arrays(ends, spans)], ["conv_id", "formatted", "ids", "mask"])
            rows.clear()

        for b in batches:
            for conv_id, role, text in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv_id != held:
                    if turns:
                        rows.append((held, *formatter.format(turns)))
                        size += len(rows[-1][1])
                        if size > 1 << 20:
                            yield from flush()
                            size = 0
                    held, turns = conv_id, []
                turns.append((role, text))
        if turns:
            rows.append((held, *formatter.format(turns)))
        if rows:
            yield from flush()

    return run


def format_conversations(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """One row per conversation of ``(conv_id, turn, role, text)``: ``conv_id``, the ``formatted`` string,
    its token ``ids`` and the loss ``mask`` (token index and the characters of it that bear loss).

    Turns are ordered by turn, then role and text (ties; rows that repeat are each a turn; NULL turns
    first). NULL roles and texts are empty; rows without a conv_id are one conversation; an empty table
    gives no rows; other columns are ignored. Rows are sorted within partitions and a task holds one
    conversation at a time."""
    d = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                             F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (d.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(_format(path), FORMATTED))


def _digests(batches):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    for b in batches:
        rows = []
        mask = b.column(2)
        ends = np.asarray(mask.offsets)
        starts, stops = (np.asarray(mask.values.field(n)) for n in ("start", "end"))
        for i, (conv_id, formatted) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
            turns = read_back(formatted)
            own = slice(ends[i], ends[i + 1])
            loss = masked_text(formatted, np.stack([starts[own], starts[own], stops[own]], axis=1))
            rows.append((conv_id, len(turns), hashlib.sha256("".join([f"{r}\n{t}\n" for r, t in turns]).encode()).hexdigest(),
                         len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) if k in (2, 4) else pa.array(c, pa.int64()) for k, c in enumerate(zip(*rows))], names)


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from ``format_conversations``' output, as counts and SHA-256 digests."""
    return formatted.select("conv_id", "formatted", "mask").mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
