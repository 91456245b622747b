"""Document fingerprints by a quartile bucket digest.

Six byte triplets of every 5-byte window of a text are hashed into ``BUCKETS`` buckets and counted. A
digest holds the text's length class, the ratios of the counts' quartiles and, for every bucket, in which
quarter its count lies (two bits). Two digests are compared by the sum of their differences, bounded to
a likeness between 0 and 1.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import count_groups, mix64, text_key

BUCKETS = 256
WINDOW = 5
#: Places of each triplet in the window.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 1, 4), (0, 2, 3), (0, 2, 4), (0, 3, 4))
#: Difference of two buckets that lie one, two or three quarters apart.
APART = np.array([0, 1, 2, 6])
#: Difference at which the likeness is 0.
FULL_DIFFERENCE = 300
CHUNK_CHARS = 16_000_000
#: Most parts; beyond, parts grow instead. Parts are sorted with spilling and read row by row, so only
#: the cuts, which the driver holds, need a bound.
MOST_PARTS = 30_000
_BLOCK = 1 << 18
_TABLE = mix64(np.arange(1, 3 * 256 + 1, dtype=np.uint64)).astype(np.uint32).reshape(3, 256)
_SALT = mix64(np.arange(1001, 1001 + len(TRIPLETS), dtype=np.uint64)).astype(np.uint32)


def bucket_counts(data: bytes) -> np.ndarray:
    """Counts of a byte string's hashed triplets; all zero under 5 bytes."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for k in range(0, len(data) - WINDOW + 1, _BLOCK):
        b = np.frombuffer(data[k:k + _BLOCK + WINDOW - 1], dtype=np.uint8)
        n = b.size - WINDOW + 1
        first, second, third = (t[b] for t in _TABLE)
        hashes = np.concatenate([(first[x:x + n] ^ second[y:y + n] ^ third[z:z + n]) * (s | np.uint32(1)) for (x, y, z), s in zip(TRIPLETS, _SALT)])
        total += np.bincount(hashes >> np.uint32(24), minlength=BUCKETS)
    return total


class Digest:
    """Length class, quartile ratios and quarter of each bucket."""

    def __init__(self, counts: np.ndarray, size: int):
        q1, q2, q3 = np.partition(counts, (63, 127, 191))[[63, 127, 191]].tolist()
        self.quarter = (counts > q1).astype(np.int8) + (counts > q2) + (counts > q3)
        self.length = min(255, round(8 * math.log2(size))) if size else 0
        self.ratios = (q1 * 15 // q3, q2 * 15 // q3) if q3 else (0, 0)

    def hex(self) -> str:
        q = self.quarter.reshape(-1, 4).astype(np.uint8)
        return f"{self.length:02x}{self.ratios[0]:x}{self.ratios[1]:x}" + bytes((q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6).tolist()).hex()

    def likeness(self, other: Digest) -> float:
        """1 for equal digests, 0 from ``FULL_DIFFERENCE`` on; the order of the two does not matter."""
        d = int(APART[np.abs(self.quarter - other.quarter)].sum())
        d += 2 * max(0, abs(self.length - other.length) - 1)
        d += sum(abs(a - b) for a, b in zip(self.ratios, other.ratios))
        return 1.0 - min(d, FULL_DIFFERENCE) / FULL_DIFFERENCE


def digest(text: str | None) -> Digest:
    data = (text or "").encode()
    return Digest(bucket_counts(data), len(data))


def splits(docs: DataFrame) -> list[float]:
    """Ids that start the parts of about ``CHUNK_CHARS`` characters (or ``MOST_PARTS`` equal ones) in
    ascending order, the largest last."""
    r = docs.agg(F.sum(F.length("text") + 1).alias("n"), F.max("doc_id").cast("double").alias("top")).first()
    if r["top"] is None:
        return []
    n = min(MOST_PARTS, count_groups(r["n"] or 0, CHUNK_CHARS, 1))
    cuts = docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (8 * n)) if n > 1 else []
    return sorted({*cuts, r["top"]})


def _neighbours(one_part: bool):
    """Reads rows sorted by part and descending id, each part ended by its tail rows; pairs each row
    with the one that follows it."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def row(doc_id, text, own, next_text, following):
        n = len(text)
        k = n // 3
        head = text[:n - k].encode()
        tail = next_text[:k].encode()
        edited = head + tail
        d = Digest(*_edited_counts(text, head, edited, own))
        return doc_id, n, hashlib.sha256(edited).hexdigest(), own[0].hex(), d.hex(), own[0].likeness(d), own[0].likeness(following)

    def run(batches):
        held, part, first = None, None, None
        for b in batches:
            out = []
            for p, tail, doc_id, text in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("part", "tail", "doc_id", "text"))):
                if p != part:
                    part, first = p, None
                    held = None
                if tail and held is None:
                    continue  # a further row of the tail
                own = _own(text)
                if held is not None:
                    out.append(row(*held, text, own[0]))
                held = None if tail else (doc_id, text, own)
                if first is None and one_part and not tail:
                    first = (text, own)
            if out:
                yield batch(out)
        if one_part and held is not None:  # without tails: the first row follows the last
            yield batch([row(*held, first[0], first[1][0])])

    return run


def _own(text: str):
    data = text.encode()
    counts = bucket_counts(data)
    return Digest(counts, len(data)), counts


def _edited_counts(text: str, head: bytes, edited: bytes, own):
    """Counts of the edited text: those of the text, less the windows that reach past the head, more
    the edited text's."""
    at = max(0, len(head) - WINDOW + 1)
    return own[1] - bucket_counts(text.encode()[at:]) + bucket_counts(edited[at:]), len(edited)


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs (doc_id, text, ...)``: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``. The edited text has its last third (rounded down)
    replaced by the first as many code points, or all, of the next document's text, by descending id;
    the first follows the last.

    NULL texts are empty; rows of one id are ordered by the hash of their text; rows without an id come
    last, as one part; an empty table gives no rows; other columns are ignored. Each text moves once:
    parts are ranges of ids, and the first row of a part is copied to the end of the one before."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = splits(d)
    n = max(1, len(cuts))
    if n == 1:
        ordered = d.select(F.lit(0).alias("part"), F.lit(False).alias("tail"), "doc_id", "text", text_key("text").alias("text_key"))
    else:
        # Binary search of the id among the cuts; a row at a cut starts its part.
        points = F.split(F.lit(",".join(map(repr, cuts))), ",").cast("array<double>")  # folded into one literal
        low = F.aggregate(
            F.sequence(F.lit(1), F.lit(n.bit_length())), F.struct(F.lit(0).alias("lo"), F.lit(n - 1).alias("hi")),
            lambda a, _: F.when(
                (a["lo"] < a["hi"]) & (F.get(points, F.floor((a["lo"] + a["hi"]) / 2).cast("int")) < F.col("doc_id").cast("double")),
                F.struct((F.floor((a["lo"] + a["hi"]) / 2) + 1).cast("int").alias("lo"), a["hi"].alias("hi")))
            .otherwise(F.struct(a["lo"].alias("lo"), F.when(a["lo"] < a["hi"], F.floor((a["lo"] + a["hi"]) / 2).cast("int")).otherwise(a["hi"]).alias("hi"))),
            lambda a: a["lo"])
        part = F.coalesce(F.when(F.col("doc_id").isNotNull(), low), F.lit(0))
        starts = F.coalesce(F.get(points, F.col("part")) == F.col("doc_id").cast("double"), F.lit(False))
        places = F.when(starts, F.array(
            F.struct(F.col("part").alias("part"), F.lit(False).alias("tail")),
            F.struct(F.pmod(F.col("part") + 1, F.lit(n)).alias("part"), F.lit(True).alias("tail")))).otherwise(
            F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("tail"))))
        ordered = (d.withColumn("part", part).withColumn("place", F.explode(places))
                   .select("place.part", "place.tail", "doc_id", "text", text_key("text").alias("text_key")))
    return (ordered.repartition(n, "part")
            .sortWithinPartitions("part", "tail", F.desc_nulls_last("doc_id"), F.desc("text_key"))
            .mapInArrow(_neighbours(n == 1), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"))
