"""Exact top-k, global row index and splits against brute force."""

import hashlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from annoflow.functions.hashing import sample_key
from annoflow.operators import splits, topk


def key(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    # one group holds most rows
    rows = [(i, "hot" if i % 10 < 7 else f"g{i % 10}") for i in range(6000)]
    return spark.createDataFrame(rows, "id bigint, grp string").repartition(6)


def brute(rows, quota, seed=3):
    df = pd.DataFrame(rows, columns=["id", "grp"])
    df["k"] = [key(seed, i) for i in df.id]
    out = set()
    for g, part in df.groupby("grp"):
        q = quota(g, len(part)) if callable(quota) else quota
        out |= set(part.sort_values(["k", "id"]).head(q).id)
    return out


def test_top_k_per_group_skewed(spark, skewed):
    keyed = skewed.withColumn("_key", sample_key("id", 3))
    got = {r.id for r in topk.top_k_by_key(keyed, ["grp"], "_key", 25, "id").collect()}
    assert got == brute(skewed.collect(), 25)


def test_top_k_quota_column_and_share(spark, skewed):
    keyed = skewed.withColumn("_key", sample_key("id", 3)).withColumn(
        "q", F.when(F.col("grp") == "hot", 500).otherwise(10000))
    got = {r.id for r in topk.top_k_by_key(keyed, ["grp"], "_key", "q", "id").collect()}
    assert got == brute(skewed.collect(), lambda g, n: 500 if g == "hot" else 10000)
    got = {r.id for r in topk.top_k_by_key(keyed, ["grp"], "_key", topk.ShareOf(40), "id").collect()}
    assert got == brute(skewed.collect(), 10)  # 40 / 4 groups


def test_global_top_k_ranked(spark, skewed):
    keyed = skewed.withColumn("_key", sample_key("id", 3))
    got = [r.id for r in topk.top_k_by_key(keyed, [], "_key", 77, "id", out_rank="r").orderBy("r").collect()]
    df = pd.DataFrame({"id": [r.id for r in skewed.collect()]})
    df["k"] = [key(3, i) for i in df.id]
    assert got == list(df.sort_values(["k", "id"]).head(77).id)


def test_global_row_index(spark, skewed):
    keyed = skewed.withColumn("_key", sample_key("id", 5))
    idx = topk.global_row_index(keyed, ["_key", "id"], groups=["grp"], num_partitions=4)
    got = {(r.grp, r.id): r.row_idx for r in idx.collect()}
    df = pd.DataFrame(skewed.collect(), columns=["id", "grp"])
    df["k"] = [key(5, i) for i in df.id]
    df = df.sort_values(["grp", "k", "id"])
    df["pos"] = df.groupby("grp").cumcount()
    assert got == {(g, i): p for g, i, p in zip(df.grp, df.id, df.pos)}


def test_split_sizes(spark, skewed):
    df = skewed.select("id", F.col("grp").alias("question_tag"), (F.col("id") % 3).cast("string").alias("label"))
    out = splits.train_dev_test_split(df, seed=1, dev_size=0.1, test_size=0.2)
    counts = {(r.question_tag, r.split): r["count"] for r in out.groupBy("question_tag", "split").count().collect()}
    for q, n in df.groupBy("question_tag").count().collect():
        c1, c2 = int((1 - 0.1 - 0.2) * n), int((1 - 0.2) * n)
        assert counts.get((q, "train"), 0) == c1
        assert counts.get((q, "dev"), 0) == c2 - c1
        assert counts.get((q, "test"), 0) == n - c2
    assert out.count() == df.count() == out.select("id").distinct().count()


def test_balanced_split_classes_equal(spark, skewed):
    df = skewed.select("id", F.lit("q").alias("question_tag"),
                       F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("label"))
    out = splits.train_dev_test_split(df, seed=1, balanced=True)
    per = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert per["a"] == per["b"] == 1200


def test_pretrain_split(spark, skewed):
    out = splits.pretrain_split(skewed.select("id"), seed=9, dev_cap=100)
    per = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert per == {"train": max(int(0.8 * 6000), 6000 - 100), "dev": 6000 - max(int(0.8 * 6000), 5900)}


def test_pretrain_split_empty_and_below_the_cap(spark, skewed):
    assert splits.pretrain_split(skewed.select("id").limit(0), seed=9).count() == 0
    out = splits.pretrain_split(skewed.select("id"), seed=9)
    order = sorted(range(6000), key=lambda i: (key(9, i), i))
    assert {r.id for r in out.where("split = 'train'").collect()} == set(order[:4800])


def test_pretrain_split_beyond_the_dev_cap(spark):
    out = splits.pretrain_split(spark.range(1_200_000), seed=9)
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 1_000_000, "dev": 200_000}


def test_splits_without_dev_and_test_are_all_train(spark, skewed):
    df = skewed.select("id", F.col("grp").alias("question_tag"), F.lit("x").alias("label"))
    out = splits.train_dev_test_split(df, seed=1, dev_size=0.0, test_size=0.0)
    assert [tuple(r) for r in out.groupBy("split").count().collect()] == [("train", 6000)]


def test_hot_class_is_ranked_by_bucket_only(spark, skewed):
    """The ranking windows of a balanced split are keyed by class and bucket, so one class is many tasks."""
    df = skewed.select("id", F.lit("q").alias("question_tag"), F.col("grp").alias("label"))
    plan = splits.balance_classes(df, 3)._jdf.queryExecution().optimizedPlan().toString()
    ranked = [line for line in plan.splitlines() if "row_number(" in line]
    assert ranked and all("_bk" in line for line in ranked)
