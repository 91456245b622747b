"""Language identification by nearest centroid.

A text is lower-cased, runs of non-letters become one blank, and its character 1- to 3-grams are
counted in ``BUCKETS`` hashed buckets. The counts are weighted by inverse document frequency and
normalised. Each language has ``CENTROIDS`` centroids from spherical k-means; the prediction is the
language of the centroid with the largest cosine, and it is rejected when the cosine distance is
over the limit learned for texts of that size.

Document frequencies cover every training row. The centroids and limits are fitted on a bounded
sample of at most ``SAMPLE_ROWS`` labelled rows (about ``SAMPLE_ROWS / languages`` of each language,
chosen by a hash of id and text; the row of the smallest hash of each language in any case).
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import mix64, written

BUCKETS = 8192
ORDERS = (1, 2, 3)
CENTROIDS = 4
SAMPLE_ROWS = 2000
#: A text is rejected when its cosine is under this share of the lowest cosine of the fitted rows of its size.
REJECT_SHARE = 0.6
UNKNOWN = "und"
#: The table of languages is broadcast up to this many rows.
FEW_LANGUAGES = 10_000
_CHARS_AT_ONCE = 1 << 20


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """A 32-bit code for every letter; all other characters share the code of a blank (0)."""
    code = mix64(np.arange(1, sys.maxunicode + 2, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
    code[[c for c in range(sys.maxunicode + 1) if not chr(c).isalpha()]] = 0
    return code


def _letter_codes(text: str, after_letter: bool) -> tuple[np.ndarray, bool]:
    """Codes of a text's characters; of a run of non-letters only the blank after a letter stays.
    ``after_letter``: a letter stands before the text; returned is whether it ends with one."""
    c = _codes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    letter = c != 0
    ends = bool(letter[-1])
    letter[1:] |= letter[:-1].copy()
    letter[0] |= after_letter
    return c[letter], ends


def _counts(text: str | None) -> tuple[np.ndarray, int]:
    """Counts per bucket of a whole text's n-grams, and its number of letters. Long texts are
    counted in parts that share the codes where they meet."""
    total, letters = np.zeros(BUCKETS, dtype=np.int64), 0
    if not text:
        return total, 0
    carry, low, after_letter = np.zeros(1, dtype=np.uint32), text.lower(), False
    for k in range(0, len(low), _CHARS_AT_ONCE):
        c, after_letter = _letter_codes(low[k:k + _CHARS_AT_ONCE], after_letter)
        letters += int(np.count_nonzero(c))
        have = carry.size if k else 0  # codes that earlier parts have counted
        key = c = np.concatenate([carry, c])
        grams = []
        for n in ORDERS:
            if n > 1:
                key = key[:-1] * np.uint32(0x9E3779B1) + c[n - 1:]
            grams.append(key[max(0, have - n + 1):])
        total += np.bincount((np.concatenate(grams) * np.uint32(0x85EBCA6B)) >> np.uint32(19), minlength=BUCKETS)
        carry = c[-(max(ORDERS) - 1):]
    return (total, letters) if letters else (np.zeros(BUCKETS, dtype=np.int64), 0)


def _size_class(letters):
    return np.minimum(np.log2(np.maximum(letters, 1)).astype(np.int64), 12)


@dataclass
class LanguageModel:
    idf: np.ndarray          # of each bucket
    centroids: np.ndarray    # (n, BUCKETS), unit length
    langs: list[str]         # of each centroid
    limits: np.ndarray       # least cosine by size class

    def score(self, texts: list[str | None]):
        """Language, cosine of the nearest centroid (0 to 1) and rejection for each text."""
        langs, score, rejected = [], np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        columns = np.ascontiguousarray(self.centroids.T)
        for i, text in enumerate(texts):
            count, letters = _counts(text)
            if not letters or not self.langs:  # with no language to compare with, none is rejected for it
                langs.append(UNKNOWN)
                rejected[i] = not letters
                continue
            at = np.flatnonzero(count)
            x = count[at] * self.idf[at]
            cos = (x @ columns[at]) / np.sqrt(x @ x)
            best = int(cos.argmax())
            score[i] = min(1.0, max(0.0, float(cos[best])))
            rejected[i] = score[i] < self.limits[_size_class(letters)]
            langs.append(self.langs[best])
        return langs, score, rejected


def _frequencies(batches):
    """Of each task: in how many texts each bucket occurs, and the number of texts (bucket -1)."""
    df, n = np.zeros(BUCKETS, dtype=np.int64), 0
    for b in batches:
        for t in b.column(0).to_pylist():
            df += _counts(t)[0] > 0
            n += 1
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, BUCKETS)), pa.array(np.concatenate([[n], df]))], ["bucket", "n"])


def _sparse(batches):
    for b in batches:
        at, val, letters = [], [], []
        for t in b.column(1).to_pylist():
            c, n = _counts(t)
            nz = np.flatnonzero(c)
            at.append(nz.astype("<u2").tobytes())
            val.append(c[nz].astype("<u4").tobytes())
            letters.append(n)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at, pa.binary()), pa.array(val, pa.binary()), pa.array(letters, pa.int64())], ["lang", "at", "val", "letters"])


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit rows: farthest-first start at the row nearest the mean, then k-means by cosine."""
    start = [int((x @ x.mean(axis=0)).argmax())]
    near = x @ x[start[0]]
    while len(start) < min(k, len(x)):
        start.append(int(near.argmin()))
        near = np.maximum(near, x @ x[start[-1]])
    c = x[start]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        new = np.stack([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        new /= np.linalg.norm(new, axis=1, keepdims=True)
        if np.allclose(new, c):
            break
        c = new
    return c


def fit(train: DataFrame, sample_rows: int = SAMPLE_ROWS, centroids: int = CENTROIDS) -> LanguageModel:
    """A model of the rows of ``train (doc_id, text, lang)`` that have a language and a letter."""
    train = train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    # Sums of per-task counts: one row per bucket reaches the driver.
    df = train.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    seen = {r["bucket"]: r["n"] for r in df}
    idf = np.log((1 + seen.get(-1, 0)) / (1 + np.array([seen.get(i, 0) for i in range(BUCKETS)]))) + 1
    # One row per language: as many shares of the sample as there are languages, each taken by hash, and
    # at least the row of its smallest hash. Rows that repeat fall together and count once.
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    langs = written(train.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")), "languages")
    names = langs.count()
    each = max(1, sample_rows // max(1, names))
    share = langs.select(F.col("lang").alias("_lf_lang"), (F.lit(float(each)) / F.col("n")).alias("share"), "least")
    if names <= FEW_LANGUAGES:  # broadcast, so that no text is dealt out by language
        share = F.broadcast(share)
    sample = (train.join(share, train["lang"] == F.col("_lf_lang")).filter((place < F.col("share")) | (place == F.col("least"))).select("lang", "text").distinct()
              .mapInArrow(_sparse, "lang string, at binary, val binary, letters long").filter("letters > 0").collect())
    sample = sorted(sample, key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["val"])))
    out, names, rows = [], [], {}
    limits = np.zeros(13)
    least = [[] for _ in limits]
    for lang in sorted({r["lang"] for r in sample}):
        own = [r for r in sample if r["lang"] == lang]
        x = np.zeros((len(own), BUCKETS), dtype=np.float32)
        for i, r in enumerate(own):
            at = np.frombuffer(r["at"], dtype="<u2").astype(np.int64)
            x[i, at] = np.frombuffer(r["val"], dtype="<u4") * idf[at]
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        c = spherical_kmeans(x, centroids)
        out.append(c)
        names += [lang] * len(c)
        for size, cos in zip(_size_class(np.array([r["letters"] for r in own])), (x @ c.T).max(axis=1)):
            least[size].append(float(cos))
    for i in range(13):  # a size takes the lowest cosine of its own and all larger texts
        near = [v for part in least[i:] for v in part]
        limits[i] = REJECT_SHARE * min(near) if near else 0.0
    limits = np.minimum.accumulate(limits[::-1])[::-1]
    model = np.concatenate(out) if out else np.zeros((0, BUCKETS), dtype=np.float32)
    return LanguageModel(idf.astype(np.float32), model.astype(np.float32), names, limits)


def _predict(model, keep_rows: bool, names: list[str]):
    def run(batches):
        m = model.value
        for b in batches:
            langs, score, rejected = m.score(b.column(b.schema.get_field_index("_lf_text" if not keep_rows else "text")).to_pylist())
            if keep_rows:
                yield b.filter(pa.array(~rejected))
            else:
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(b.schema.get_field_index(n)) for n in names], pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)],
                    [*names, "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, model: LanguageModel, carry: dict[str, Column]) -> DataFrame:
    """One row per row of ``docs``: the columns ``carry``, ``lang_pred`` (``und`` for a NULL text or one
    without letters, or an empty model), ``score`` (cosine, 0 to 1) and ``rejected``. Equal texts get
    equal results whatever their other columns; an empty table gives no rows."""
    spark = docs.sparkSession
    d = docs.select(*[c.alias(n) for n, c in carry.items()], F.col("text").alias("_lf_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.drop("_lf_text").schema)
    return d.mapInArrow(_predict(spark.sparkContext.broadcast(model), False, list(carry)), f"{schema}, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with all their columns."""
    return docs.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model), True, []), docs.schema)
