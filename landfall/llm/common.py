"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.session import scratch_dir

#: Bytes that separate words: blank and the control bytes from tab to carriage return.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
WORD_SPACE = r"[\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder, read back: cuts lineage and
    survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Spark's setting by which a query's shuffle files go as soon as it has ended.
_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries that run inside leave no shuffle files behind. A plan that is run again makes its
    shuffles anew, so a result never depends on this."""
    before = spark.conf.get(_FILE_CLEANUP, None)
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FILE_CLEANUP)
        else:
            spark.conf.set(_FILE_CLEANUP, before)


class Scratch:
    """Tables in the shared scratch folder that an operator needs for a while; ``free`` removes them
    once what was made of them is itself written, so they don't pile up on the disk. The shuffles that
    made a table go when it is written."""

    def __init__(self, spark: SparkSession):
        self._spark, self._held = spark, []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{scratch_dir(self._spark)}/llm/{name}-{uuid.uuid4().hex}"
        with shuffles_removed(self._spark):
            df.write.parquet(path)
        table = self._spark.read.schema(df.schema).parquet(path)
        self._held.append((table, path))
        return table

    def free(self, *tables: DataFrame) -> None:
        """Removes ``tables``; shuffle files of jobs that are over go too, which Spark does only when
        the driver's garbage is collected."""
        jvm = getattr(self._spark, "_jvm", None)  # none in a Spark Connect session: the folders stay
        if jvm is None:
            return
        for _, path in [x for x in self._held if any(x[0] is t for t in tables)]:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self._spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
        self._held = [x for x in self._held if not any(x[0] is t for t in tables)]
        gc.collect()
        jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id's decimal text modulo 5 (NULL for a NULL id)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(5))


def text_key(text: Column | str) -> Column:
    """64-bit key of a text that tells rows of one doc_id apart; NULL text has key 0."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.when(c.isNotNull(), F.xxhash64(c)), F.lit(0).cast("long"))


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """Bit mixer on unsigned 64-bit values (vectorised, wrapping)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream64(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random unsigned 64-bit values from a counter: the same on every machine."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(0x9E3779B97F4A7C15))


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[np.frombuffer(SPACE_BYTES, dtype=np.uint8)] = True
_BYTE_VALUE = stream64(256, 11)
_HASH_BYTES = 1 << 17
_POWERS = [np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> np.ndarray:
    """Powers of an odd multiplier modulo 2**64, grown on demand."""
    have = _POWERS[0]
    if have.size < n:
        size = max(n, 2 * have.size, 256)
        with np.errstate(over="ignore"):
            _POWERS[0] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, 0x9E3779B97F4A7C55, dtype=np.uint64)]))
    return _POWERS[0][:n]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) byte positions of the words of a byte array."""
    word = np.empty(data.size + 2, dtype=bool)
    word[0] = word[-1] = False
    np.logical_not(_IS_SPACE[data], out=word[1:-1])
    edge = np.flatnonzero(word[1:] != word[:-1])
    return edge[0::2], edge[1::2]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word ``data[start:end]``; equal words have equal hashes."""
    if start.size == 0:
        return np.empty(0, dtype=np.uint64)
    size = end - start
    first, total = np.cumsum(size) - size, int(size.sum())
    if total > _HASH_BYTES:  # in parts, for bounded memory
        cuts = np.unique(np.append(np.searchsorted(first, np.arange(0, total, _HASH_BYTES)), size.size))
        return np.concatenate([_hash_part(data, start[a:b], size[a:b]) for a, b in zip(cuts[:-1], cuts[1:])])
    return _hash_part(data, start, size)


def _hash_part(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    first, total = np.cumsum(size) - size, int(size.sum())
    within = np.arange(total) - np.repeat(first, size)
    at = within + np.repeat(start, size)
    with np.errstate(over="ignore"):
        part = _BYTE_VALUE[data[at]] * _powers(int(size.max()))[within]
        return mix64(np.add.reduceat(part, first) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """First positions of the runs of equal rows in sorted columns."""
    n = columns[0].size
    if n == 0:
        return np.empty(0, dtype=np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def count_groups(total: int, each: int, least: int) -> int:
    """How many groups of about ``each`` units hold ``total`` units (no upper limit)."""
    return max(least, -(-int(total) // each))
