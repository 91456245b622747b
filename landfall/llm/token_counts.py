"""Token counts by the sentencepiece library with a whole-token shortcut.

In this vocabulary no piece goes on after a blank mark that follows another character, and none holds
a line feed among others, so the merges on either side of such places never meet. ``Proof`` checks both
when the model is loaded and finds, for every vocabulary string, whether it encodes alone as one token.
A text is then cut before its blanks: pre-tokens that are such strings count one each, the rest are
merged by the library and remembered in a bounded cache.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.tokenizers_common import Cache, tokenizer_path

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
_BLANK = "▁"
_RUNS = re.compile(" +[^ ]*")


class TokenCounter:
    """Counts the tokens of whole texts exactly as the library does."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_file=path)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))]
        # A line feed parts what follows from the blank that the library puts before a text.
        self.lead = len(sp.encode("\n"))
        self.proved = (not any(_BLANK in p.lstrip(_BLANK) or "\n" in p for p in pieces)
                       and sp.encode("\n a") == sp.encode("\n") + sp.encode("a")
                       and len(sp.encode("a  b \n c")) == len(sp.encode("a")) + len(sp.encode(" b")) + len(sp.encode("\n")) + len(sp.encode("c")))
        words = [p[1:] for p in pieces if p[0] == _BLANK and _BLANK not in p[1:] and len(p) > 1]
        alone = sp.encode(["\n " + w for w in words], num_threads=1) if self.proved else []
        self.whole = {w: 1 for w, ids in zip(words, alone) if len(ids) == self.lead + 1}
        self.counts = Cache(self._merge, always=self.whole)

    def _merge(self, pretoken: str) -> int:
        return len(self.library.encode("\n " + pretoken)) - self.lead

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.proved:
            return len(self.library.encode(text))
        text = text.replace(_BLANK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return sum(map(self.counts.__getitem__, [r[1:] for r in _RUNS.findall(" " + text)]))
        return sum(map(self.counts.__getitem__, text.split(" ")))


@lru_cache(maxsize=1)
def shared(path: str) -> TokenCounter:
    """One counter a Python worker: its proof is made once and tasks that follow find its cache warm."""
    return TokenCounter(path)


def _count(path: str | None):
    def run(batches):
        counter = shared(path or tokenizer_path(VOCABULARY))
        for b in batches:
            n = [counter.count(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs (doc_id, text, ...)``: ``doc_id, n_bytes`` (UTF-8), ``n_tokens`` and
    ``over_limit``. NULL and empty texts have no tokens; rows that repeat are each counted; an empty
    table gives no rows; other columns are ignored."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text")
    return (d.mapInArrow(_count(path), "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
