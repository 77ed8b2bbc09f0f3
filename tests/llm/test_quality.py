import re

import numpy as np
import pytest

from annoflow.llm import quality as Q
from annoflow.llm.common import read

GAP = re.compile(r"[\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = [x for x in GAP.split(t) if x]
    lines = [x for x in t.split("\n") if any(GAP.split(x))]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + j for i, g in enumerate(grams) if seen[g] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def check(docs):
    rows = Q.base_counts(docs).collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text), r.doc_id
    return rows


def test_base_counts(spark, sf001, odd):
    assert len(check(read(spark, sf001, "documents"))) == 200
    check(odd.select("doc_id", "text"))
    made = ["a b c a b c", "a a a a", "a b", "a b c d a b c", "x y z\nx y z\n\n \n", "# $ % & | < > *", "a\x0bb\x0cc\x85d e"]
    check(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string"))


def test_verdicts(spark, sf001, odd, empty):
    rows = Q.judge(read(spark, sf001, "documents")).collect()
    labels = {r.doc_id: r.quality for r in read(spark, sf001, "labels").collect()}
    assert len(rows) == 200
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
        assert r.kept or r.base_failed or labels.get(r.doc_id) != 1
    assert Q.judge(odd).count() == odd.count()
    assert Q.judge(empty).count() == 0


def test_outliers_are_found_among_a_quarter_of_junk(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("aeioustrn"), rng.integers(3, 8))) for _ in range(4000)]
    rows = []
    for i in range(400):
        w = rng.choice(words, 120).tolist()
        rows.append((i, " ".join(x + "***" for x in w) if i % 5 == 0 else " ".join(w), "en", None))
    got = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] == (i % 5 != 0) for i in got)


@pytest.mark.parametrize("share", [35, 40])
def test_outliers_are_found_among_copies_of_one_junk_text(spark, share):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("aeioustrn"), rng.integers(3, 8))) for _ in range(4000)]
    junk = " ".join(x + "***" for x in rng.choice(words, 120))
    rows = [(i, junk if i % 100 < share else " ".join(rng.choice(words, 120)), "en", None) for i in range(400)]
    got = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] == (i % 100 >= share) for i in got)


def test_estimate_against_numpy(spark):
    """The chosen subset satisfies the fixed point of the concentration step."""
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(600, 5)) @ rng.normal(size=(5, 5)) * 1000).astype(int)
    x[:60] += 20000
    cols = ", ".join(f"x{i} long" for i in range(5))
    df = spark.createDataFrame([("en", "s", *map(int, r)) for r in x], f"lang string, source string, {cols}")
    est = Q.mcd(df).first()
    d = Q._on_group(df, Q.mcd(df)).withColumn("d", Q._distance()).collect()
    far = np.array([r.d for r in d])
    order = np.array([[r[f"x{i}"] for i in range(5)] for r in d])
    near = order[np.floor(np.log1p(far) * 4096) <= np.percentile(np.floor(np.log1p(far) * 4096), 75)]
    assert np.allclose([est[f"m{i}"] for i in range(5)], near.mean(axis=0), rtol=0.02, atol=30)
    assert (order[far > Q.chi2_quantile(1 - Q.REJECT, 5)].max(axis=1) > 10000).all()
    assert (far > Q.chi2_quantile(1 - Q.REJECT, 5)).sum() == 60


@pytest.mark.parametrize("q,p,x", [(0.95, 1, 3.841459), (0.99, 5, 15.08627), (0.5, 3, 2.365974)])
def test_chi2(q, p, x):
    assert abs(Q.chi2_quantile(q, p) - x) < 1e-5
