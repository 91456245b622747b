"""SimHash near-duplicates: pivot distance tables discard pairs, survivors are verified.

A fingerprint's bit is set when it is set in over half the 64-bit hashes of the text's word
shingles. Fingerprints link when at most ``max_bits`` bits differ; classes are the connected
components of the links.

Candidates come from bit blocks: cut into ``B`` blocks, two fingerprints that differ in at most
``d`` bits agree on at least ``B - d`` of them, so every choice of ``B - d`` blocks is one key.
``B`` follows the number of distinct fingerprints, so that keys are wider where there are more of
them; no pair is missed for any ``B``. A bucket with more than ``BUCKET_ROWS`` fingerprints is not
compared but keyed again on the bits that its key leaves open, until it is small enough (the open
bits run out after a few levels), so no bucket is capped and none is gathered whole.

Inside a bucket the distances of its fingerprints to ``PIVOTS`` fixed reference fingerprints form a
table. By the triangle inequality a pair whose coordinates differ by more than ``max_bits`` on any
pivot can't link; the rest is verified by its exact distance. The bucket gives the edges of a
spanning forest of its links, not all its pairs.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import column_bytes, run_starts, stream64, text_key, written
from landfall.llm.components import components

#: Reference fingerprints of the distance table.
PIVOTS = 16
#: A bucket with more distinct fingerprints is keyed again on further bits.
BUCKET_ROWS = 8192
#: With no more open bits than this a bucket holds at most 8192 fingerprints and is always compared.
FEW_OPEN_BITS = 13
_REFERENCE = stream64(PIVOTS, 5)
_BLOCK = 1 << 16


def fingerprint(text: bytes | None, words_per_shingle: int = 4) -> int:
    """The 64-bit fingerprint of a text in UTF-8; 0 without a word. Repeated shingles count each time."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    w = min(words_per_shingle, len(words))
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: len(words) - w + 1].tolist()
    end = end[w - 1:].tolist()
    n, ones, h = len(start), np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for k in range(0, n, _BLOCK):
        v = np.array([h(joined[a:b], 42) for a, b in zip(start[k:k + _BLOCK], end[k:k + _BLOCK])], dtype="<u8")
        ones += np.unpackbits(v.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(words_per_shingle: int):
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, words_per_shingle) for t in column_bytes(b, "text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], ["doc_id", "text_key", "fp"])

    return run


def fingerprints(docs: DataFrame, words_per_shingle: int = 4) -> DataFrame:
    """``(doc_id, text_key, fp)`` for every row of ``docs``; NULL and empty texts have fingerprint 0."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key("text").alias("text_key"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(_fingerprints(words_per_shingle), "doc_id long, text_key long, fp long"))


@lru_cache(maxsize=4096)
def block_masks(open_bits: int, blocks: int, max_bits: int) -> tuple[int, ...]:
    """Masks of every choice of ``blocks - max_bits`` blocks of the bits set in ``open_bits``."""
    at = [i for i in range(64) if open_bits >> i & 1]
    cut = [sum(1 << i for i in part.tolist()) for part in np.array_split(np.array(at, dtype=np.int64), blocks)]
    return tuple(dict.fromkeys(sum(c) for c in combinations(cut, blocks - max_bits)))


def block_count(distinct: int, max_bits: int) -> int:
    """Fewest blocks whose keys leave about one fingerprint a bucket, if bits were even."""
    b = max_bits + 1
    while b < max_bits + 5 and (64 * (b - max_bits)) // b < np.log2(max(2, distinct)):
        b += 1
    return b


def _keys(blocks: int, max_bits: int):
    """Rows (path, key, mask, fp): one for each key of a fingerprint; ``path`` tells the tables apart."""
    full = (1 << 64) - 1

    def run(batches):
        for b in batches:
            fp = np.asarray(b.column(0)).view(np.uint64)
            path = np.asarray(b.column(1))
            mask = np.asarray(b.column(2)).view(np.uint64)
            for m in np.unique(mask).tolist():
                own, p = fp[mask == m], path[mask == m]
                for i, sub in enumerate(block_masks(full & ~m, blocks, max_bits)):
                    now = np.uint64(m | sub)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(p * 1009 + i + 1), pa.array((own & now).view(np.int64)),
                         pa.array(np.full(own.size, now, dtype=np.uint64).view(np.int64)), pa.array(own.view(np.int64))],
                        ["path", "key", "mask", "fp"])

    return run


def link_forest(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints (unsigned)."""
    n = fp.size
    if n == 2:
        ok = int(np.bitwise_count(fp[0] ^ fp[1])) <= max_bits
        return (fp[:1], fp[1:]) if ok else (fp[:0], fp[:0])
    table = np.bitwise_count(fp[:, None] ^ _REFERENCE[None, :]).astype(np.int16)
    order = np.argsort(table[:, 0], kind="stable")
    fp, table = fp[order], table[order]
    left = np.arange(n)  # not yet in a tree, in order of the first coordinate
    us, vs = [], []
    while left.size:
        queue, left = [left[0]], left[1:]
        while queue and left.size:
            x = queue.pop()
            first = table[left, 0]
            lo, hi = np.searchsorted(first, [table[x, 0] - max_bits, table[x, 0] + max_bits + 1])
            at = lo + np.flatnonzero(np.abs(table[left[lo:hi]] - table[x]).max(axis=1, initial=0) <= max_bits)
            at = at[np.bitwise_count(fp[left[at]] ^ fp[x]) <= max_bits]
            if at.size:
                us.append(np.full(at.size, fp[x]))
                vs.append(fp[left[at]])
                queue.extend(left[at].tolist())
                left = np.delete(left, at)
    return (np.concatenate(us), np.concatenate(vs)) if us else (fp[:0], fp[:0])


def _links(max_bits: int, rows: int):
    """Reads keyed rows sorted by (path, key); gives edges (kind 0) of buckets of at most ``rows``
    fingerprints, and the rows of larger ones to be keyed again (kind 1)."""
    names = ["kind", "u", "v", "path", "mask"]

    def out(kind, u, v, path, mask):
        n = len(u)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, dtype=np.int8)), pa.array(np.asarray(u, dtype=np.uint64).view(np.int64)),
             pa.array(np.asarray(v, dtype=np.uint64).view(np.int64)),
             pa.array(np.full(n, path, dtype=np.int64)), pa.array(np.full(n, mask, dtype=np.int64))], names)

    def splits(mask):
        return 64 - (mask & (1 << 64) - 1).bit_count() > FEW_OPEN_BITS

    def close(bucket):
        (path, _, mask), parts, over = bucket
        fp = parts[0] if len(parts) == 1 else np.concatenate(parts)
        if over or fp.size > rows and splits(mask):
            yield out(1, fp, fp, path, mask)
        elif fp.size > 1:
            u, v = link_forest(fp, max_bits)
            if u.size:
                yield out(0, u, v, path, mask)

    def run(batches):
        held = None  # (path, key, mask), parts, whether part of it has left as too large
        for b in batches:
            path, key, mask, fp = (np.asarray(b.column(i)) for i in range(4))
            fp = fp.view(np.uint64)
            at = run_starts(path, key)
            ends = np.append(at[1:], path.size)
            single = ends - at == 1
            single[:1] = single[-1:] = False
            for s, e in zip(at[~single].tolist(), ends[~single].tolist()):
                me = (int(path[s]), int(key[s]), int(mask[s]))
                if held is not None and held[0][:2] == me[:2]:
                    held[1].append(fp[s:e])
                else:
                    if held is not None:
                        yield from close(held)
                    held = [me, [fp[s:e]], False]
                if sum(p.size for p in held[1]) > rows and splits(me[2]):
                    yield out(1, np.concatenate(held[1]), np.concatenate(held[1]), me[0], me[2])
                    held = [me, [fp[:0]], True]
        if held is not None:
            yield from close(held)

    return run


def fingerprint_links(distinct: DataFrame, max_bits: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges ``(u, v)`` between distinct fingerprints that span all their links. ``distinct`` has
    one row per fingerprint in the column ``fp``."""
    n = distinct.count()
    todo = distinct.select("fp", F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("mask"))
    blocks, edges, level = block_count(n, max_bits), None, 0
    while True:
        keyed = todo.mapInArrow(_keys(blocks, max_bits), "path long, key long, mask long, fp long")
        found = written(keyed.repartition(F.col("path"), F.col("key")).sortWithinPartitions("path", "key")
                        .mapInArrow(_links(max_bits, bucket_rows), "kind byte, u long, v long, path long, mask long"),
                        f"simhash-links{level}")
        e = found.filter("kind = 0").select("u", "v")
        edges = e if edges is None else edges.union(e)
        over = found.filter("kind = 1")
        if over.isEmpty():
            return edges
        todo = over.select(F.col("u").alias("fp"), "path", "mask")
        blocks, level = max_bits + 2, level + 1


def simhash_groups(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(doc_id, text_key, fp, label, component_id)`` for every row of ``docs (doc_id, text, ...)``.

    ``component_id`` is the smallest doc_id reachable over links, itself included; ``label`` names
    the component too and is never NULL. NULL, empty and blank texts share fingerprint 0. Rows that
    repeat are each returned. A NULL doc_id is never a component_id, unless all its component's are
    NULL. Other columns are ignored; an empty table gives no rows."""
    rows = written(fingerprints(docs, words_per_shingle), "simhash-fp")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-classes")
    linked = components(fingerprint_links(classes.select("fp"), max_bits, bucket_rows), "simhash")
    named = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("label", "fp").alias("label"))
    lows = named.groupBy("label").agg(F.min("low").alias("component_id"))
    named = written(named.join(lows, "label").select("fp", "label", "component_id"), "simhash-named")
    return rows.join(named, "fp").select("doc_id", "text_key", "fp", "label", "component_id")


def keep_one(docs: DataFrame, words_per_shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest doc_id (NULL ids
    last; ties: the smallest text key; of rows that repeat whole, one). All columns are kept."""
    groups = written(simhash_groups(docs, words_per_shingle, max_bits), "simhash-groups")
    order = F.struct(F.col("doc_id").isNull().alias("a"), "doc_id", "text_key")
    first = (groups.groupBy("label").agg(F.min(order).alias("o"))
             .select(F.col("o.doc_id").alias("_lf_id"), F.col("o.text_key").alias("_lf_key")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_lf_id")) & (text_key("text") == F.col("_lf_key"))
    kept = docs.join(first, same, "left_semi")
    twice = groups.groupBy("doc_id", "text_key").count().filter("count > 1")
    if not twice.isEmpty():
        kept = (kept.withColumn("_lf_key", text_key("text")).dropDuplicates(["doc_id", "_lf_key"]).drop("_lf_key"))
    return kept
