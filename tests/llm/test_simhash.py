"""Against fingerprints bit by bit and all pairs of fingerprints."""

import re

import numpy as np
import pytest
import xxhash

from annoflow.llm import simhash as S
from annoflow.llm.common import read

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, distance=2):
    """Index of the first member of each one's component."""
    fps = np.array(fps, dtype=np.uint64)
    label = np.arange(len(fps))
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        if (new == label).all():
            return label
        label = new


def check(docs):
    rows = sorted([tuple(r) for r in docs.select("doc_id", "text").collect()], key=lambda r: (r[0] is None, r[0] or 0, str(r[1])))
    fps = [fingerprint(t) for _, t in rows]
    at = classes(fps)
    want = sorted(((d, f"{f:016x}", rows[c][0]) for (d, _), f, c in zip(rows, fps, at)), key=str)
    assert sorted((tuple(r) for r in S.digest(S.near_duplicates(docs)).collect()), key=str) == want
    return want


def test_whole_table(spark, sf001):
    want = check(read(spark, sf001, "documents"))
    assert len({w[2] for w in want}) < 200


def test_odd_rows(spark, odd, empty):
    check(odd)
    assert S.near_duplicates(empty).count() == 0
    assert S.text_fingerprint("é A b " * 70000) == fingerprint("é A b " * 70000)


def clusters(n, seed):
    rng = np.random.default_rng(seed)
    fp = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    chain = [fp[0]]
    for _ in range(200):  # a long chain of close fingerprints
        a, b = rng.choice(64, 2, replace=False)
        chain.append(chain[-1] ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)))
    ball = [fp[1] ^ np.uint64(sum(1 << int(b) for b in set(rng.choice(64, rng.integers(0, 5))))) for _ in range(600)]
    return np.unique(np.concatenate([fp, np.array(chain), np.array(ball)]))


@pytest.mark.parametrize("sample,leaf", [(1 << 14, 64), (40, 100), (3, 1)])
def test_links_give_all_components_for_any_tree(spark, sample, leaf):
    fp = clusters(1500, 3)
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    got = {r.u: r.v for r in S.components(S.links(df, 2, sample, leaf)).collect()}
    signed = np.sort(fp.view(np.int64))
    at = classes(signed.view(np.uint64))
    assert [got.get(int(x), int(x)) for x in signed] == [int(signed[i]) for i in at]


def test_every_close_pair_meets():
    fp = clusters(3000, 4)
    tree = S.VantageTree(fp[::3], 50, 2)
    at, leaf, member = tree.route(fp)
    assert sorted(at[member]) == list(range(len(fp)))
    home = dict(zip(at[member].tolist(), leaf[member].tolist()))
    there = set(zip(at.tolist(), leaf.tolist()))
    i, j = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2)
    assert all((a, home[b]) in there or (b, home[a]) in there for a, b in zip(i.tolist(), j.tolist()))
