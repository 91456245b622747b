"""Language-model scores by deleted interpolation of n-gram estimates.

P(w | h) mixes the maximum-likelihood bigram c(h, w) / c(h), the unigram c(w) / N and the uniform
1 / (V + 1). The weights depend on a bucket of the context's count c(h) (its binary logarithm) and are
learned by expectation-maximisation: counts are taken on a part of the training texts, and the weights
that make the deleted part likeliest are found from its bigrams. The final counts are those of all
training texts.

Counts are looked up in blocks. Texts are dealt into chunks of about ``CHUNK_CHARS`` characters; a chunk
asks for the counts of its distinct keys (64-bit hashes of words and word pairs, so a word however
frequent is asked once a chunk), split by key range; each range adds up what all chunks have counted and
answers every chunk. Chunks and ranges grow in number with the input, not in size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import count_groups, fold, mix64, run_starts, word_hashes, word_spans, written

CHUNK_CHARS = 4_000_000
RANGE_CHARS = 4_000_000
#: Context buckets: 0 for a context never seen, then one for each power of two; the last is open.
CONTEXT_BUCKETS = 25
#: Steps per power of two in which the deleted part's probabilities are tabulated for the EM.
STEPS = 16
EM_ROUNDS = 100

_END = np.uint64(0x51ED270B7A1F3C88)
_BEGIN = np.uint64(0x2545F4914F6CDD1E)
_STEP = np.uint64(0x9E3779B97F4A7C55)
#: Parts of the corpus: counted, deleted (its bigrams teach the weights), only scored.
COUNTED, DELETED, SCORED = 0, 1, 2


class Tokens:
    """The tokens of a chunk's texts: words (A-Z lower-cased) and one end a text. Word keys are even,
    pair keys odd."""

    def __init__(self, texts: list[bytes | None]):
        texts = [t or b"" for t in texts]
        data = np.frombuffer(b"\n".join(texts).lower(), dtype=np.uint8)
        begin = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.empty(0, dtype=np.int64)
        start, end = word_spans(data)
        text_of = np.searchsorted(begin, start, side="right") - 1
        words = np.bincount(text_of, minlength=len(texts)) if len(texts) else np.empty(0, dtype=np.int64)
        self.last = np.cumsum(words + 1) - 1       # place of each text's end token
        self.first = self.last - words
        even = np.uint64(0xFFFFFFFFFFFFFFFE)
        token = np.full(start.size + len(texts), _END & even, dtype=np.uint64)
        token[np.arange(start.size) + text_of] = word_hashes(data, start, end) & even
        self.context = np.empty_like(token)
        self.context[1:] = token[:-1]
        self.context[self.first] = _BEGIN & even
        with np.errstate(over="ignore"):
            pair = mix64(self.context * _STEP + token) | np.uint64(1)
        # Distinct keys, their places for each token, and the chunk's own counts.
        keys, inverse, count = np.unique(np.concatenate([token, pair]), return_inverse=True, return_counts=True)
        n = token.size
        at = np.searchsorted(keys, _BEGIN & even)
        if at < keys.size and keys[at] == _BEGIN & even:
            raise ValueError("a word has the key of the text start")
        self.keys = np.insert(keys, at, _BEGIN & even)
        self.count = np.insert(count, at, len(texts))
        inverse = inverse + (inverse >= at)
        self.word_at, self.pair_at = inverse[:n], inverse[n:]
        self.context_at = np.empty_like(self.word_at)
        self.context_at[1:] = self.word_at[:-1]
        self.context_at[self.first] = at


def _chunks(docs: DataFrame) -> tuple[DataFrame, list[int]]:
    """``docs`` with the part and the chunk of each row, and the first chunk of each part. Rows without
    an id are only scored."""
    f = fold("doc_id")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), f.alias("fold"))
    d = d.withColumn("part", F.when(f.isNull() | (f == 1), SCORED).when(f == 4, DELETED).otherwise(COUNTED))
    size = {r["part"]: r["n"] for r in d.groupBy("part").agg(F.sum(F.length("text") + 1).alias("n")).collect()}
    counts = [count_groups(size.get(p, 0), CHUNK_CHARS, 1) for p in (COUNTED, DELETED, SCORED)]
    base = [0, counts[0], counts[0] + counts[1]]
    ranges = count_groups(sum(size.values()), RANGE_CHARS, 1)
    n, b = (F.element_at(F.array(*map(F.lit, x)), F.col("part") + 1) for x in (counts, base))
    chunk = b + F.pmod(F.xxhash64("doc_id", "text"), n)
    return d.select(chunk.cast("long").alias("chunk"), "doc_id", "fold", F.col("text").cast("binary").alias("text")), [*base, sum(counts), ranges]


def _ask(base: list[int]):
    ranges = base[4]

    def run(table):
        if not table.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (("range", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()))})
        chunk = table["chunk"][0].as_py()
        t = Tokens(table["text"].to_pylist())
        rows = []
        for r, lo, hi in _ranges(t.keys, ranges):
            keys = t.keys[lo:hi]
            rows.append((r, chunk, _pack_keys(keys), t.count[lo:hi].astype("<u4").tobytes()))
        return pa.table({n: pa.array(c, ty) for (n, ty), c in zip((("range", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())), zip(*rows))})

    return run


def _ranges(keys: np.ndarray, ranges: int):
    """(range, first, last) of the sorted keys that each range holds."""
    own = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    at = run_starts(own)
    return zip(own[at].tolist(), at.tolist(), np.append(at[1:], keys.size).tolist())


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane: the shuffle's compression drops the empty planes."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


ANSWER = "chunk long, range long, counts binary, counted binary, n long, v long, n_counted long, v_counted long"


def _answer(base: list[int]):
    def run(table):
        chunks = table["chunk"].to_pylist()
        keys = [_unpack_keys(k) for k in table["keys"].to_pylist()]
        counts = [np.frombuffer(c, dtype="<u4") for c in table["counts"].to_pylist()]
        r = table["range"][0].as_py()
        every, at = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.concatenate(counts).astype(np.int64)
        part = np.repeat(np.searchsorted(base[:3], chunks, side="right") - 1, [k.size for k in keys])
        counted = np.bincount(at, weights=count * (part == COUNTED), minlength=every.size).astype("<i8")
        trained = counted + np.bincount(at, weights=count * (part == DELETED), minlength=every.size).astype("<i8")
        word = (every & np.uint64(1) == 0) & (every != _BEGIN & np.uint64(0xFFFFFFFFFFFFFFFE))
        ends = np.cumsum([k.size for k in keys]).tolist()
        rows = []
        for c, lo, hi in zip(chunks, [0, *ends[:-1]], ends):
            own = at[lo:hi]
            teaches = base[DELETED] <= c < base[SCORED]
            rows.append((c, r, _planes(trained[own]), _planes(counted[own]) if teaches else None, None, None, None, None))
        rows.append((-1, r, None, None, int(trained[word].sum()), int((trained[word] > 0).sum()), int(counted[word].sum()), int((counted[word] > 0).sum())))
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
        names = ["chunk", "range", "counts", "counted", "n", "v", "n_counted", "v_counted"]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<i8")).view(np.uint8).reshape(-1, 8).T.tobytes()


def _counts_of(answers: pa.Table, column: str) -> np.ndarray:
    """A chunk's answers in the order of its sorted keys."""
    order = np.argsort(answers["range"].to_numpy())
    data = answers[column].to_pylist()
    return np.concatenate([np.ascontiguousarray(np.frombuffer(data[i], dtype=np.uint8).reshape(8, -1).T).view("<i8").ravel() for i in order])


def context_bucket(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, np.minimum(1 + np.log2(np.maximum(count, 1)).astype(np.int64), CONTEXT_BUCKETS - 1), 0)


def _estimates(t: Tokens, count: np.ndarray, n: int):
    """Context bucket, bigram and unigram estimates of every token."""
    c_context, c_pair = count[t.context_at], count[t.pair_at]
    return context_bucket(c_context), c_pair / np.maximum(c_context, 1), count[t.word_at] / max(n, 1)


def _step_of(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.round(np.log2(np.maximum(p, 1e-300)) * STEPS), 1).astype(np.int64)


def _evidence(n: int):
    def run(docs, answers):
        schema = pa.schema([("bucket", pa.int64()), ("pair", pa.int64()), ("word", pa.int64()), ("n", pa.int64())])
        if not docs.num_rows:
            return schema.empty_table()
        t = Tokens(docs["text"].to_pylist())
        bucket, p2, p1 = _estimates(t, _counts_of(answers, "counted"), n)
        rows, count = np.unique(np.stack([bucket, _step_of(p2), _step_of(p1)], axis=1), axis=0, return_counts=True)
        return pa.table([*rows.T, count], schema=schema)

    return run


def learn_weights(rows: list[tuple[int, int, int, int]], uniform: float) -> np.ndarray:
    """Weights (bigram, unigram, uniform) of every context bucket by expectation-maximisation on the
    tabulated evidence ``(bucket, pair step, word step, count)``. A bucket without evidence takes the
    weights learned from all buckets; those of bucket 0 have no bigram."""
    data = np.array(rows, dtype=np.int64).reshape(-1, 4)
    p = np.stack([np.where(s <= 0, np.exp2(s / STEPS), 0.0) for s in (data[:, 1], data[:, 2])] + [np.full(len(data), uniform)], axis=1)

    def em(p, n, start):
        w = start
        for _ in range(EM_ROUNDS):
            share = p * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * n[:, None]).sum(axis=0) + 0.01  # none becomes zero
            w /= w.sum()
        return w

    even = np.full(3, 1 / 3)
    pooled = em(p, data[:, 3], even) if len(data) else even
    out = np.tile(pooled, (CONTEXT_BUCKETS, 1))
    for b in np.unique(data[:, 0]).tolist():
        own = data[:, 0] == b
        out[b] = em(p[own], data[own, 3], even)
    out[0] = [0.0, *(out[0, 1:] / out[0, 1:].sum())]
    return out


def _scores(n: int, v: int, weights: np.ndarray):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(docs, answers):
        if not docs.num_rows:
            return schema.empty_table()
        t = Tokens(docs["text"].to_pylist())
        count = _counts_of(answers, "counts")
        c = count[t.word_at]
        bucket, p2, p1 = _estimates(t, count, n)
        w = weights[bucket]
        p = w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (v + 1)
        base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        size = t.last - t.first + 1
        held = pa.array([f == 1 for f in docs["fold"].to_pylist()], pa.bool_())
        return pa.table([docs["doc_id"].combine_chunks(), held, size, np.add.reduceat((c > 0).astype(np.int64), t.first), np.full(size.size, n),
                         np.add.reduceat(base, t.first), np.add.reduceat(np.log10(p), t.first)], schema=schema)

    return run


def score_texts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs (doc_id, text, ...)``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``.

    Training rows are those whose id's fold is not 1; of these, fold 4 is deleted while the weights are
    learned. NULL and empty texts are one end token; a row without an id is scored, not learned from,
    and not held out; rows that repeat count and are scored each; other columns are ignored; an empty
    table gives no rows. Without training tokens every score is uniform."""
    d, base = _chunks(docs)
    asked = d.groupBy("chunk").applyInArrow(_ask(base), "range long, chunk long, keys binary, counts binary")
    answers = written(asked.groupBy("range").applyInArrow(_answer(base), ANSWER), "lm-answers")
    totals = answers.filter("chunk = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "n_counted", "v_counted")]).first()
    answers = answers.filter("chunk >= 0").select("chunk", "range", "counts", "counted")
    teaches = (F.col("chunk") >= base[DELETED]) & (F.col("chunk") < base[SCORED])
    # The evidence is a table of bounded size: context buckets by probability steps.
    seen = (d.filter(teaches).groupBy("chunk").cogroup(answers.filter(teaches).groupBy("chunk"))
            .applyInArrow(_evidence(totals["n_counted"]), "bucket long, pair long, word long, n long")
            .groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n")).collect())
    weights = learn_weights([tuple(r) for r in seen], 1 / (totals["v_counted"] + 1))
    return (d.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(_scores(totals["n"], totals["v"], weights),
                          "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
