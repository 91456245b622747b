"""Ranked search against a plain scoring of every document, and the K2-treap on its own."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from landfall.llm import ranked_search

from .conftest import SF, pairs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=50):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = {}
    for item, own in asked.items():
        found = []
        for i, c in counts:
            if not c:
                continue
            m = 100 - 50 + 50 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                found.append((-score, -(1 << 63) if i is None else i))
        out[item] = sorted(found)[:k]
    return {i: v for i, v in out.items() if v}


def ranked(docs, items, **more):
    out = {}
    for r in ranked_search.rank_documents(docs, items, **more).orderBy("item_id", "rank").collect():
        out.setdefault(r["item_id"], []).append((-r["score"], -(1 << 63) if r["doc_id"] is None else r["doc_id"]))
        assert r["rank"] == len(out[r["item_id"]])
    return out


def test_ranking_equals_a_plain_scoring(spark, docs, odd_docs, monkeypatch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    odd = spark.createDataFrame([(900, None), (901, ""), (902, "!!!"), (903, "same text TWICE same"), (904, "日本語 İstanbul word"), (None, "x y z"), (905, "no such zzzzzq"),
                                 (906, "word"), (906, "text")], "item_id long, text string")
    both, asked = docs.select("doc_id", "text").union(odd_docs.select("doc_id", "text")), items.union(odd)
    want = brute(pairs(both), [(r[0], r[1]) for r in asked.collect()])
    assert ranked(both, asked) == want
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 7)
    assert ranked(both.repartition(3), asked, block_terms=60) == want  # several blocks of items
    assert ranked(both, asked, k=3) == {i: v[:3] for i, v in want.items()}


def test_copies_are_ranked_by_id(spark, monkeypatch):
    random.seed(5)
    rows = [(k, "alpha beta gamma") for k in range(500, 0, -1)] + [(1000 + k, f"alpha delta{k % 7} " * (k % 5 + 1)) for k in range(200)]
    items = [(1, "Alpha BETA"), (2, "delta3 alpha"), (3, "gamma")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert ranked(docs, asked) == brute(rows, items)
    assert ranked_search.rank_documents(docs.limit(0), asked).count() == 0
    assert ranked_search.rank_documents(docs, asked.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_best_columns_equal_a_full_sum(seed):
    rng = np.random.RandomState(seed)
    rows, columns = rng.randint(1, 70), rng.randint(1, 300)
    grid = rng.randint(1, 50, (rows, columns)) * (rng.uniform(size=(rows, columns)) < rng.choice([0.02, 0.3, 1.0]))
    r, c = np.nonzero(grid)
    tree = ranked_search.K2Treap(r, c, grid[r, c], max(1, int(max(rows, columns) - 1).bit_length()))
    ids = np.sort(rng.choice(10_000, columns, replace=False))
    for _ in range(5):
        own = rng.choice(rows, rng.randint(1, min(rows, 8) + 1), replace=False)
        weights = rng.randint(0, 5, own.size)
        score = (grid[own] * weights[:, None]).sum(axis=0)
        want = sorted((-int(s), int(i)) for s, i in zip(score, ids) if s > 0)
        assert ranked_search.best_columns(tree, own, weights, ids, [], 10) == want[:10]
        assert ranked_search.best_columns(tree, own, weights, ids, [(-3, 5)], 10) == sorted([*want, (-3, 5)])[:10]
