"""Agreement statistics against brute-force forms."""

import itertools
import random
from collections import defaultdict

from pyspark.sql import functions as F

from annoflow.operators import agreement


def random_annotations(n=600, seed=4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((f"a{i}", rnd.randint(1, 40), rnd.choice(["q1", "q2"]), rnd.choice(["x", "y", "z", None]),
                     rnd.randint(1, 12), i))
    return rows


SCHEMA = "id string, tweet_id bigint, question_tag string, answer_tag string, annotator_id bigint, seq bigint"


def brute_agreement(rows):
    # last answer per (tweet, annotator, question); pairs of annotators per tweet
    final = {}
    for _id, t, q, a, who, seq in sorted(rows, key=lambda r: r[5]):
        final[(t, who, q)] = a
    by_tweet = defaultdict(lambda: defaultdict(dict))
    for (t, who, q), a in final.items():
        by_tweet[t][who][q] = a
    agree, total = defaultdict(int), defaultdict(int)
    for t, m in by_tweet.items():
        for w1, w2 in itertools.permutations(m, 2):
            for q in set(m[w1]) & set(m[w2]):
                if m[w1][q] is None or m[w2][q] is None:
                    continue
                total[w1] += 1
                agree[w1] += m[w1][q] == m[w2][q]
    return {w: (agree[w], total[w]) for w in total}


def test_agreement_linear_equals_pairwise(spark):
    rows = random_annotations()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.annotator_id: (r.agreement_count, r.total_count)
           for r in agreement.annotator_agreement(df).collect() if r.total_count > 0}
    assert got == brute_agreement(rows)


def test_robust_z_mad_zero(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 1.0, 1.0, 0.5, None])], "i int, v double")
    got = {r.i: r.z for r in agreement.robust_z(df, "v", "z", below_median_only=True).collect()}
    assert got[3] == float("inf") and got[0] is None and got[4] is None


def test_robust_z_values(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 10.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = {r.i: r.z for r in agreement.robust_z(df, "v", "z").collect()}
    # median 3, deviations 2 1 0 1 7 -> MAD 1
    assert got == {0: 2.0, 1: 1.0, 2: 0.0, 3: 1.0, 4: 7.0}


def test_fleiss_kappa_textbook(spark):
    # 3 subjects, 3 raters, categories a/b: counts [[3,0],[0,3],[2,1]]
    rows = []
    table = {1: ["a"] * 3, 2: ["b"] * 3, 3: ["a", "a", "b"]}
    for t, answers in table.items():
        for who, a in enumerate(answers):
            rows.append((f"{t}-{who}", t, "q", a, who, len(rows), "m"))
    df = spark.createDataFrame(rows, SCHEMA + ", mode string")
    r = agreement.fleiss_kappa(df, min_annotations=0).first()
    p_bar = (1 + 1 + (4 + 1 - 3) / 6) / 3
    p_e = (5 / 9) ** 2 + (4 / 9) ** 2
    assert abs(r.kappa - (p_bar - p_e) / (1 - p_e)) < 1e-9


def test_exact_median_with_ties(spark):
    from annoflow.operators import stats
    import random
    rnd = random.Random(7)
    vals = [rnd.choice([rnd.random(), 0.5, 0.25]) for _ in range(5001)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "v double")
    s = sorted(vals)
    assert stats.exact_median(df, "v") == s[2500]
    df2 = spark.createDataFrame([(v,) for v in vals[:-1]], "v double")
    s2 = sorted(vals[:-1])
    assert stats.exact_median(df2, "v") == (s2[2499] + s2[2500]) / 2
