"""Host-level quality rules, in DataFrame functions only.

Each document is measured on its own text. The share of documents that fail any rule is aggregated
by host (``source``), shrunk towards the corpus with a beta prior fitted to the hosts' rates
(method of moments), and the host's verdict is joined back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import WORD_SPACE, text_key, written

WINDOW = 8
MIN_WORDS = 20
#: A host whose shrunk failure rate is over this is rejected with all its documents.
HOST_LIMIT = 0.5
#: A document that fails a soft rule is forgiven only on a host with a shrunk rate up to this.
CLEAN_HOST = 0.02
#: Limits on the weight of the prior, in documents.
PRIOR_LEAST, PRIOR_MOST = 1.0, 1000.0

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_words(text: Column) -> Column:
    """Array of the words of a text; empty for NULL."""
    t = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(t) > 0, F.split(t, WORD_SPACE)).otherwise(F.array().cast("array<string>"))


def _pairs() -> Column:
    """Sorted (hash, place) of the 8-word windows of a text that has equal ones, else empty. Windows
    are compared by the 64-bit hash of their words' hashes."""
    w = F.col("windows")
    found = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(w)) < F.size(w), found).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def _places() -> Column:
    """Sorted places of the pairs whose neighbour has the same hash."""
    p = F.col("pairs")
    twin = F.filter(p, lambda x, k: ((k > 0) & (F.get(p, k - 1)["h"] == x["h"])) | (F.get(p, k + 1)["h"] == x["h"]))
    return F.sort_array(F.transform(twin, lambda x: x["i"]))


def _covered() -> Column:
    """Words in the windows at the places: 8 each, less what the window before covers too."""
    return F.aggregate(
        "places", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).cast("long").alias("n"), p.alias("last")),
        lambda a: a["n"])


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, source`` and the measures of each row's whole text (NULL: no words)."""
    keys = ["doc_id", "text_key", "source"]
    done = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines"]
    d = docs.select("doc_id", text_key("text").alias("text_key"), "source", F.coalesce("text", F.lit("")).alias("text"))
    d = d.select(*keys, "text", text_words(F.col("text")).alias("words"),
                 F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    d = d.select(
        *keys,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    # Each array that a lambda reads is a column of the step before (read twice or more, so that the
    # optimizer doesn't move its expression into the lambda, to be evaluated per element).
    n = F.size("hashes")
    d = d.select(*keys, *done, F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("hashes", i, F.lit(WINDOW)))))
        .otherwise(F.array().cast("array<bigint>")).alias("windows"))
    d = d.select(*keys, *done, _pairs().alias("pairs"))
    d = d.select(*keys, *done, _places().alias("places"))
    return d.select(*keys, *done, _covered().alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def soft_failed() -> Column:
    """More than a symbol per ten words, over 30 % repeated lines, or over half the characters capitals."""
    return ((F.col("n_symbols") * 10 > F.col("n_words")) | (F.col("n_dup_lines") * 100 > F.col("n_lines") * 30)
            | (F.col("n_capitals") * 2 > F.col("word_chars")))


def host_rates(measured: DataFrame) -> DataFrame:
    """``source, n, failed, rate``: one row per host (NULL is a host too); ``rate`` is the posterior
    mean of its failure rate. The prior's mean and weight are fitted to all hosts; the weight is
    kept between ``PRIOR_LEAST`` and ``PRIOR_MOST`` documents."""
    hosts = measured.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(base_failed() | soft_failed()).alias("failed"))
    total = hosts.agg(F.sum("failed").alias("k"), F.sum("n").alias("n")).first()
    mean = (total["k"] or 0) / total["n"] if total["n"] else 0.0
    # Spread of the hosts' rates beyond what sampling alone would give.
    extra = hosts.agg(F.avg(F.pow(F.col("failed") / F.col("n") - mean, F.lit(2.0)) - mean * (1 - mean) / F.col("n"))).first()[0]
    within = mean * (1 - mean)
    weight = within / extra - 1 if extra and extra > 0 else PRIOR_MOST
    weight = min(PRIOR_MOST, max(PRIOR_LEAST, weight))
    return hosts.withColumn("rate", (F.col("failed") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight)))


def judge(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs (doc_id, text, source)``: the measures, ``base_failed``,
    ``soft_failed``, ``host_failed`` and ``kept``.

    ``kept`` is false for a failed base rule, on a host whose shrunk failure rate is over
    ``HOST_LIMIT``, and for a failed soft rule unless the host's rate is at most ``CLEAN_HOST``.
    A NULL or empty text has no words and fails the base rule; a NULL source is a host of its own;
    rows that repeat count each; an empty table gives no rows; other columns are ignored. The
    measures are written once, without texts, as both the hosts and the documents read them."""
    m = written(measures(docs), "quality")
    # The join side is one row per host; Spark broadcasts it only under its size threshold, else
    # both sides are shuffled and adaptive execution splits a hot host.
    hosts = host_rates(m).select(F.col("source").alias("host"), "rate")
    j = m.join(hosts, F.col("source").eqNullSafe(F.col("host")), "left")
    host_failed = F.col("rate") > HOST_LIMIT
    return j.select(
        "doc_id", "text_key", *MEASURES, base_failed().alias("base_failed"), soft_failed().alias("soft_failed"),
        host_failed.alias("host_failed"),
        (~base_failed() & ~host_failed & ~(soft_failed() & (F.col("rate") > CLEAN_HOST))).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    bad = (judge(docs).filter(~F.col("kept"))
           .select(F.col("doc_id").alias("_lf_id"), F.col("text_key").alias("_lf_key")))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_lf_id")) & (text_key("text") == F.col("_lf_key")), "left_anti")
