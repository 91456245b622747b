"""Ranked lexical search over K2-treaps.

Terms are maximal runs of ASCII letters and digits and of code points above ASCII, A-Z lower-cased. One
pass over the documents counts their terms and keeps the postings of the items' terms, a shard of
``SHARD_DOCS`` documents at a time. With the collection's statistics each shard becomes a term-document
grid: rows are terms, columns its documents by ascending id, a point's weight is its impact. A K2-treap
holds the grid: a quadtree whose nodes keep four child bits and the largest impact of their cell. An item
descends with the row paths of all its terms at once, over halving document ranges: the sum of its terms'
weighted cell maxima bounds every score in a range, the ranges of the highest bounds are opened first, and
the descent ends when no bound beats the worst of the best so far. What an item has found bounds its
descent in the next shards of the task.

Terms are compared by 64-bit hashes. Items are taken in blocks of ``BLOCK_TERMS`` term places, whose terms
and weights every task gets; each block reads the documents once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import Scratch, column_bytes, run_starts, word_hashes

BEST = 50
SHARD_DOCS = 4096
#: Text handled at once in a task.
SHARD_BYTES = 16 << 20
#: Term places of the items that are searched in one pass over the documents, and items gathered in the driver for it.
BLOCK_TERMS = 1 << 20
#: Document ranges opened at once.
OPENED = 64
#: Stands for a NULL doc_id inside the search.
NO_ID = -(1 << 63)

_IS_TERM = np.zeros(256, dtype=bool)
_IS_TERM[128:] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _IS_TERM[_a:_b] = True
#: Children before a quadrant, by the bits of a node.
_BEFORE = np.array([[bin(m & (1 << q) - 1).count("1") for q in range(4)] for m in range(16)], dtype=np.int64)


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of the texts one after the other, and the number of terms of each text."""
    if not texts:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    data = np.frombuffer(b"\n".join(texts).lower(), dtype=np.uint8)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    inside = np.zeros(data.size + 2, dtype=bool)
    inside[1:-1] = _IS_TERM[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]
    return word_hashes(data, start, end), np.diff(np.searchsorted(start, begin))


class K2Treap:
    """Points ``(row, column, weight)``, each place once, in a quadtree of ``2 ** depth`` rows and columns.
    Node 0 is the root; ``bits`` has a node's children (bit 2 * row half + column half), ``first`` its
    first child and ``top`` the largest weight of its cell."""

    def __init__(self, row: np.ndarray, column: np.ndarray, weight: np.ndarray, depth: int):
        self.depth = depth
        code = np.zeros(row.size, dtype=np.int64)
        for k in range(depth):
            code |= ((row >> k & 1) << (2 * k + 1)) | ((column >> k & 1) << 2 * k)
        order = np.argsort(code, kind="stable")
        code, top = code[order], weight[order].astype(np.int64)
        levels = [(np.zeros(code.size, dtype=np.uint8), np.zeros(code.size, dtype=np.int64), top)]
        for _ in range(depth):
            at = run_starts(code >> 2)
            bits = np.bitwise_or.reduceat(np.left_shift(np.uint8(1), (code & 3).astype(np.uint8)), at) if at.size else np.empty(0, dtype=np.uint8)
            levels.append((bits, at, np.maximum.reduceat(top, at) if at.size else top[:0]))
            code, top = (code >> 2)[at], levels[-1][2]
        levels.reverse()
        base = np.cumsum([0] + [x[0].size for x in levels])
        self.bits = np.concatenate([x[0] for x in levels])
        self.first = np.concatenate([x[1] + base[k + 1] for k, x in enumerate(levels)]).astype(np.int32)
        self.top = np.concatenate([x[2] for x in levels]).astype(np.int32)

    def children(self, node: np.ndarray, half: np.ndarray) -> np.ndarray:
        """The children of ``node`` (-1: none) in quadrant ``half``; -1 where there is none."""
        known = np.maximum(node, 0)
        bits = self.bits[known]
        there = (node >= 0) & (bits >> half.astype(np.uint8) & 1 == 1)
        return np.where(there, self.first[known] + _BEFORE[bits, half], -1)


def best_columns(tree: K2Treap, rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, best: list[tuple[int, int]], k: int = BEST) -> list[tuple[int, int]]:
    """``best``, sorted pairs (-score, id), brought up to date with the columns of ``tree`` (whose ids
    ascend): the ``k`` least pairs of a score above 0. ``rows`` and ``weights`` are an item's terms."""
    if not tree.top.size or not rows.size:
        return best
    start, height = np.zeros(1, dtype=np.int64), np.full(1, tree.depth)
    nodes = np.zeros((1, rows.size), dtype=np.int64)
    bound = np.array([int((weights * int(tree.top[0])).sum())])
    while bound.size:
        if len(best) == k:
            score, worst = -best[-1][0], best[-1][1]
            live = (bound > score) | ((bound == score) & (ids[start] < worst))
            bound, start, height, nodes = bound[live], start[live], height[live], nodes[live]
            if not bound.size:
                break
        if bound.size > OPENED:
            order = np.lexsort((start, -bound))
            now, rest = order[:OPENED], order[OPENED:]
        else:
            now, rest = np.arange(bound.size), np.empty(0, dtype=np.int64)
        done = now[height[now] == 0]
        if done.size:
            best = sorted(best + list(zip((-bound[done]).tolist(), ids[start[done]].tolist())))[:k]
        wide = now[height[now] > 0]
        below = height[wide] - 1
        half = 2 * (rows[None, :] >> below[:, None] & 1)
        made = [tree.children(nodes[wide], half + c) for c in (0, 1)]
        new = np.concatenate(made)
        at = np.concatenate([start[wide], start[wide] + (1 << below)])
        sums = (np.where(new >= 0, tree.top[np.maximum(new, 0)], 0).astype(np.int64) * weights).sum(axis=1)
        some = sums > 0
        bound, start = np.concatenate([bound[rest], sums[some]]), np.concatenate([start[rest], at[some]])
        height, nodes = np.concatenate([height[rest], np.tile(below, 2)[some]]), np.concatenate([nodes[rest], new[some]])
    return best


_SHARD = "ids binary, sizes binary, term binary, doc binary, tf binary, n long, l long"


def _shards(terms: np.ndarray):
    """Shards of documents: ids and term counts of each, and the postings of ``terms`` (sorted hashes)."""

    def shard(ids, texts):
        order = np.argsort(np.array(ids, dtype=np.int64), kind="stable")
        ids = np.array(ids, dtype=np.int64)[order]
        h, sizes = term_hashes([texts[i] for i in order])
        doc = np.repeat(np.arange(sizes.size), sizes)
        at = np.minimum(np.searchsorted(terms, h), max(0, terms.size - 1))
        known = np.flatnonzero(terms[at] == h) if terms.size else np.empty(0, dtype=np.int64)
        pair = np.sort(at[known] * sizes.size + doc[known])
        first = run_starts(pair)
        tf = np.diff(np.append(first, pair.size))
        pair = pair[first]
        return [ids.tobytes(), sizes.astype(np.int64).tobytes(), (pair // sizes.size).astype(np.int32).tobytes(), (pair % sizes.size).astype(np.int32).tobytes(),
                tf.astype(np.int64).tobytes(), int((sizes > 0).sum()), int(sizes.sum())]

    def run(batches):
        kinds = [*[pa.binary()] * 5, pa.int64(), pa.int64()]
        names = [c.split()[0] for c in _SHARD.split(", ")]
        ids, texts, held = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), column_bytes(b, "text")):
                if texts and (len(texts) == SHARD_DOCS or held + len(t) > SHARD_BYTES):
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(shard(ids, texts), kinds)], names)
                    ids, texts, held = [], [], 0
                ids.append(i)
                texts.append(t)
                held += len(t)
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(shard(ids, texts), kinds)], names)

    return run


def _document_frequencies(n_terms: int):
    def run(batches):
        df = np.zeros(n_terms, dtype=np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                df += np.bincount(np.frombuffer(t, dtype=np.int32), minlength=n_terms)
        some = np.flatnonzero(df)
        for k in range(0, some.size, 1 << 16):
            at = some[k:k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], ["term", "df"])

    return run


def impacts(tf: np.ndarray, size: np.ndarray, n: int, total: int) -> np.ndarray:
    """Impact of a term that occurs ``tf`` times in a document of ``size`` terms."""
    if size.size and 50 * int(size.max()) * n >= 1 << 62:
        m = np.array([50 + 50 * int(s) * n // total for s in size], dtype=np.int64)
    else:
        m = 50 + 50 * size * n // total
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def _search(items: list[tuple[int, np.ndarray]], weights: np.ndarray, n: int, total: int, k: int):
    def run(batches):
        best = [[] for _ in items]
        for b in batches:
            for ids, sizes, term, doc, tf in zip(*(c.to_pylist() for c in b.columns[:5])):
                ids, sizes = np.frombuffer(ids, dtype=np.int64), np.frombuffer(sizes, dtype=np.int64)
                term, doc, tf = np.frombuffer(term, dtype=np.int32), np.frombuffer(doc, dtype=np.int32), np.frombuffer(tf, dtype=np.int64)
                if not term.size:
                    continue
                here, row = np.unique(term, return_inverse=True)
                depth = max(1, int(max(here.size, ids.size) - 1).bit_length())
                tree = K2Treap(row.astype(np.int64), doc.astype(np.int64), impacts(tf, sizes[doc], n, total), depth)
                for j, (_, own) in enumerate(items):
                    at = np.minimum(np.searchsorted(here, own), here.size - 1)
                    rows = at[here[at] == own]
                    best[j] = best_columns(tree, rows, weights[here[rows]], ids, best[j], k)
        rows = [(items[j][0], i, -s) for j, own in enumerate(best) for s, i in own]
        for a in range(0, len(rows), 1 << 16):
            part = rows[a:a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*part)], ["item_id", "doc_id", "score"])

    return run


def _blocks(items: DataFrame, most: int):
    """The items as (item_id, sorted hashes of its terms), in lists of about ``most`` term places."""
    own, places = [], 0
    each = items.groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.concat_ws("\n", F.collect_set("text")).cast("binary").alias("text"))
    for r in each.toLocalIterator():
        h = np.unique(term_hashes([bytes(r["text"])])[0])
        if own and places + h.size > most:
            yield own
            own, places = [], 0
        own.append((r["item_id"], h))
        places += h.size
    if own:
        yield own


def rank_documents(docs: DataFrame, items: DataFrame, k: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each of ``items (item_id, text)`` the ``k`` documents of
    ``docs (doc_id, text, ...)`` with the highest scores above 0, equal ones by ascending doc_id.

    Rows of ``docs`` that share an id are documents of their own; rows of ``items`` that do are one item
    with the terms of all. A NULL text has no terms; a NULL id, of a document or an item, is an id like
    any other and comes before them. An item without terms, and an empty table, give no rows; other
    columns are ignored."""
    spark = docs.sparkSession
    scratch, found = Scratch(spark), None
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                         F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    for block in _blocks(items, block_terms):
        terms = np.unique(np.concatenate([h for _, h in block]))
        shards = scratch.written(source.mapInArrow(_shards(terms), _SHARD), "search-shards")
        n, total = shards.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("l"), F.lit(0))).first()
        df = np.zeros(terms.size, dtype=np.int64)
        for r in shards.select("term").mapInArrow(_document_frequencies(terms.size), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[r["term"]] = r["df"]
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
        places = [(i, np.searchsorted(terms, h)) for i, h in block]
        one = scratch.written(shards.mapInArrow(_search(places, weights, n, total, k), "item_id long, doc_id long, score long"), "search-found")
        scratch.free(shards)
        found = one if found is None else found.union(one)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score"))
