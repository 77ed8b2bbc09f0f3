"""Against runs found word by word for every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from annoflow.llm import periodic as P
from annoflow.llm.common import read
from annoflow.llm.queries import QUERIES


def brute(w):
    """Every stretch with period q that cannot grow, if no smaller period holds all over it."""
    found, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(all(w[x] == w[x + p] for x in range(i, j + q - p)) for p in range(1, q)):
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    """The query's row, from the contract's words."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_runs_of_small_alphabets():
    rng = random.Random(7)
    for _ in range(1500):
        w = []
        while len(w) < rng.choice((8, 30, 120)):
            block = [rng.randrange(rng.choice((2, 3, 9))) for _ in range(rng.randint(1, 14))]
            w += (block * rng.randint(1, 7))[:rng.randint(1, 60)]
        assert P.runs(np.array(w)) == brute(w), w


@pytest.mark.parametrize("block", [1, 5, 64, 1000])
def test_nested_periods(block):
    """A period in which every gram of the smallest class comes twice: only longer grams tell the periods apart."""
    rng = random.Random(block)
    x = [rng.randrange(50) for _ in range(block)]
    period = x + [-1] + x + [-2] + x + [-1] + x + [-3]
    w = [-9] + period * 5 + x + [-8]
    found = P.runs(np.array(w))
    assert (1, 5 * len(period) + len(x), len(period)) in found
    if block < 100:
        assert found == brute(w)


def test_other_bounds():
    assert P.runs(np.array([1, 2] * 3), 6, 3) == [(0, 6, 2)] and P.runs(np.array([1, 2] * 3)) == []
    assert P.runs(np.array([7] * 9), 10, 3) == [] and P.runs(np.array([7] * 10), 10, 3) == [(0, 10, 1)]
    with pytest.raises(ValueError):
        P.runs(np.array([1]), 6, 2)


def test_very_long_texts_are_linear():
    n = 400_000
    assert P.runs(np.zeros(n, dtype=np.int64)) == [(0, n, 1)]
    w = np.tile(np.arange(99_991), 5)
    assert P.runs(w) == [(0, len(w), 99_991)]


def test_whole_table(spark, sf001):
    got = sorted(map(tuple, QUERIES["op13_periodic_runs"](spark, sf001).collect()))
    want = sorted(expected(*r) for r in read(spark, sf001, "documents", "doc_id", "text").collect())
    assert got == want
    assert sum(r[1] > 0 for r in got) > 5


def test_odd_rows(spark, odd, empty):
    texts = [(i, " ".join(["a b c"] * 5) + "\x1c  z") for i in range(40)]
    rows = odd.select("doc_id", "text").collect() + texts
    docs = odd.unionByName(spark.createDataFrame(texts, "doc_id long, text string"), allowMissingColumns=True)
    got = P.digest(P.periodic_runs(docs, plant=True)).collect()
    small = [r for r in rows if len(r[1] or "") < 1000]
    long = [tuple(r) for r in got if r.doc_id == 5 and r.length and r.length > 1000]
    assert long == [(5, 1, 0, 30000, 1, 30_000_000, hashlib.sha256(b"0,30000,1\n").hexdigest(), hashlib.sha256(b"word").hexdigest())]
    assert sorted(map(str, (tuple(r) for r in got if tuple(r) not in long))) \
        == sorted(map(str, (expected(*r) for r in small if r[0] != 5 or r[1] != "word " * 30000)))
    assert P.digest(P.periodic_runs(empty)).count() == 0
