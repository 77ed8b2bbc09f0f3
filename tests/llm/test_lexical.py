"""Against the score of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from annoflow.llm import lexical as L

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(AZ))


def brute(docs, items, k):
    tfs = [Counter(terms(t)) for _, t in docs]
    n_docs, total = sum(bool(t) for t in tfs), sum(sum(t.values()) for t in tfs)
    df = Counter(x for t in tfs for x in t)
    wanted = {}
    for item_id, text in items:
        wanted.setdefault(item_id, set()).update(terms(text))
    out = []
    for item_id, words in wanted.items():
        scored = []
        for (doc_id, _), tf in zip(docs, tfs):
            m = 100 - 90 + (90 * sum(tf.values()) * n_docs) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((1_000_000_000 * tf[x]) // (1000 * tf[x] + 8 * m))
                    for x in words if tf[x])
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0))
        out += [(item_id, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def check(spark, docs, items, k=10):
    got = L.search(docs, items, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == brute([tuple(r) for r in docs.select("doc_id", "text").collect()],
                         [tuple(r) for r in items.select("item_id", "text").collect()], k)
    return rows


def corpus(n, seed):
    """Few words, so that scores tie often; groups of copies."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Ünï", "É"]
    texts = [" ".join(rng.choices(words, weights=range(1, 43), k=rng.randint(1, 25))) for _ in range(n)]
    return [(rng.randrange(10**6), rng.choice(texts[:n // 2])) for _ in range(n)]


@pytest.mark.parametrize("k", [1, 10])
def test_ties_and_copies(spark, k):
    docs = spark.createDataFrame(corpus(700, 3), "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(i, f"w{i} w{i + 1} W{39 - i} É absent") for i in range(12)] + [(90, "w40"), (91, "absent"), (92, None)],
                                  "item_id long, text string")
    assert len(check(spark, docs, items, k)) == 12 * k


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_TERMS", 6)
    monkeypatch.setattr(L, "MERGE_GROUPS", 2)
    docs = spark.createDataFrame(corpus(200, 4), "doc_id long, text string").repartition(9)
    check(spark, docs, spark.createDataFrame([(f"q{i}", f"w{i} w{i + 20}") for i in range(15)], "item_id string, text string"))


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "word three", "x"), (1, "OTHER", "x"), (None, "id é", "x"), (2, None, "x"), (3, " .,", "x")],
                                  "item_id long, text string, score string")
    assert any(r[2] is None for r in check(spark, odd, items))
    assert check(spark, empty, items) == []
    assert check(spark, odd, items.limit(0)) == []


def test_stops_before_the_end_and_misses_nothing():
    rng = np.random.default_rng(5)
    n_docs, n_terms = 5000, 6
    term = np.repeat(np.arange(n_terms), n_docs)
    at = np.tile(np.arange(n_docs), n_terms)
    impact = (rng.pareto(1.2, len(term)) * 10).astype(np.int64)
    lists = L._Lists(n_docs, n_terms, term, at, impact)
    asked = []
    direct = lists.direct
    lists.direct = lambda t, d: asked.append(len(d)) or direct(t, d)
    total = impact.reshape(n_terms, n_docs).sum(axis=0)
    order = np.lexsort((np.arange(n_docs), -total))[:10]
    assert L.best_positions(lists, np.arange(n_terms), 10) == [(int(d), int(total[d])) for d in order]
    assert sum(asked) < n_docs / 4
    asked.clear()
    assert L.best_positions(lists, np.arange(n_terms), 10, floor=int(total.max()) + 1) == []
    assert sum(asked) < 200


def test_equal_scores_are_all_seen():
    """All documents tie: reading may stop only when nothing unseen could reach the k-th score."""
    lists = L._Lists(300, 2, np.repeat([0, 1], 300), np.tile(np.arange(300), 2), np.full(600, 5))
    assert L.best_positions(lists, np.arange(2), 3) == [(0, 10), (1, 10), (2, 10)]
