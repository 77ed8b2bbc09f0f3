"""Composite jobs on small parsed-status frames."""

import datetime as dt

from pyspark.sql import functions as F

from annoflow.plans import workflows


def parsed(spark, n=300):
    rows = []
    for i in range(n):
        day = dt.datetime(2020, 1 + (i % 3), 1 + (i % 20), 12, 0, 0)
        rows.append((str(i), f"text number {i % 250} @bob http://x.y/{i % 250}", day, "en" if i % 4 else "de",
                     i % 7 == 0, False, 5, True))
    return spark.createDataFrame(rows, "id string, text string, created_at timestamp, lang string, "
                                       "is_reply boolean, is_retweet boolean, token_count int, "
                                       "contains_keywords boolean")


def test_draw_sample_random_and_monthly(spark):
    df = parsed(spark)
    s = workflows.draw_sample(df, size=20, seed=1, mode="random", langs=["en"])
    rows = s.collect()
    assert len(rows) == 20 and all("<url>" in r.text and "@user" in r.text for r in rows)
    m = workflows.draw_sample(df, size=30, seed=1, mode="monthly")
    per = {r.bin: r["count"] for r in m.groupBy("bin").count().collect()}
    assert per == {"2020-01": 10, "2020-02": 10, "2020-03": 10}


def test_draw_sample_extend_excludes_previous(spark):
    df = parsed(spark)
    first = workflows.draw_sample(df, size=30, seed=2, mode="monthly", anonymize=False)
    prev = first.select(F.col("id").alias("tweet_id"), F.col("text").alias("tweet_text"))
    unavailable = prev.limit(3).select("tweet_id")
    again = workflows.draw_sample(df, size=30, seed=2, mode="monthly", previous=prev,
                                  unavailable=unavailable, available=None, anonymize=False)
    assert again.join(prev.withColumnRenamed("tweet_id", "id"), "id").count() == 0
    assert again.count() > 0


def test_split_labels_and_pretraining(spark):
    cleaned = spark.createDataFrame([(str(i), f"t{i}", 1, "q", i % 2, str(i % 2)) for i in range(100)],
                                    "id string, text string, question_id bigint, question_tag string, "
                                    "label_id bigint, label_tag string")
    out = workflows.split_labels(cleaned, question="q", seed=3, dev_size=0.1, test_size=0.2)
    got = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert got == {"train": 70, "dev": 10, "test": 20}
    pt = workflows.pretraining_text(parsed(spark), seed=1, lang="en", dev_cap=10)
    per = {r.split: r["count"] for r in pt.groupBy("split").count().collect()}
    n = sum(per.values())
    assert per["train"] == max(int(0.8 * n), n - 10)


def test_all_data_and_shuffle(spark):
    from annoflow.operators import predictions, sampling
    p = parsed(spark, 40)
    wide = spark.createDataFrame([("0", "pos", 0.9)], "id string, label_m string, probability_m double")
    lab = spark.createDataFrame([("3",)], "tweet_id string")
    out = predictions.all_data(p, wide, s_date="2020-01-01", e_date="2020-01-10 12:00:00", labelled=lab)
    rows = {r.id: r for r in out.collect()}
    assert rows["0"].label_m == "pos" and rows["3"].L and not rows["0"].L and "1" not in rows
    assert all(r.created_at <= dt.datetime(2020, 1, 10, 12) for r in rows.values())
    a = [r.id for r in sampling.shuffle(p, 3).collect()]
    b = [r.id for r in sampling.shuffle(p.repartition(4), 3).collect()]
    assert a == b and sorted(a) == sorted(r.id for r in p.collect())
