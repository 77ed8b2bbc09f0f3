"""Against a search for every window at every place."""

import re
from hashlib import sha256

import pytest

from annoflow.llm import decontamination as D
from annoflow.llm.common import read

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(AZ))


def brute(docs, items, size=10):
    windows = {}
    for i, t in items:
        w = words(t)
        if w:
            k = min(size, len(w))
            for s in range(len(w) - k + 1):
                windows.setdefault(tuple(w[s:s + k]), set()).add(i)
    lengths = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for k in lengths:
            for s in range(len(w) - k + 1):
                ids = windows.get(tuple(w[s:s + k]))
                if ids:
                    hit.update(range(s, s + k))
                    found |= ids
        ids = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(docs, items):
    return sorted((tuple(r) for r in D.digest(D.contamination(docs, items)).collect()), key=str)


def pairs(df, a, b="text"):
    return [tuple(r) for r in df.select(a, b).collect()]


def test_whole_table(spark, sf001):
    docs, items = read(spark, sf001, "documents"), read(spark, sf001, "benchmark")
    want = brute(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert sum(r[5] for r in want) > 0
    assert run(docs, items) == want


def test_short_items_ties_and_borders(spark, odd):
    items = spark.createDataFrame([(1, "Word"), (2, "word"), (3, None), (4, " ... "), (5, "one two three"), (6, "TWO, three"),
                                   (10, "id " * 12), (11, " ".join(f"w{i}" for i in range(14)))], "item_id long, text string")
    more = spark.createDataFrame(
        [(20, " ".join(f"w{i}" for i in range(13)) + " x " + " ".join(f"w{i}" for i in range(2, 14))), (21, "id " * 11),
         (22, " ".join(f"w{i}" for i in range(9))), (23, "two"), (24, "three one two"), (25, "wordword")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    assert run(docs, items) == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))


def test_clashing_columns_and_empty_tables(spark, odd, empty):
    items = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    none = items.limit(0)
    assert D.contamination(odd, items).count() == odd.count()
    assert {r.n_hit for r in D.contamination(odd, none).collect()} == {0}
    nameless = D.digest(D.contamination(odd, spark.createDataFrame([(None, "two three"), (None, None)], "item_id long, text string")))
    assert {(r.n_hit, r.n_items, r.contaminated) for r in nameless.collect()} == {(0, 0, False)}
    assert D.contamination(empty, items).count() == 0


@pytest.mark.parametrize("size,k", [(3, 1), (4, 4), (2, 5)])
def test_other_sizes(spark, sf001, size, k):
    docs, items = read(spark, sf001, "documents").limit(60), read(spark, sf001, "benchmark")
    got = sorted((r.doc_id, r.n_words, r.n_hit) for r in D.contamination(docs, items, size, k).collect())
    assert got == sorted(r[:3] for r in brute(pairs(docs, "doc_id"), pairs(items, "item_id"), size))
