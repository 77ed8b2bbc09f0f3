"""Annotations keep their order whatever the size of the keys."""

import itertools

from pyspark.sql import functions as F

from annoflow.operators import agreement, consensus
from annoflow.plans import views

SCHEMA = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
          "l_discount double, l_tax double, l_returnflag string, l_linestatus string")


def annotations(spark, tmp_path, keys):
    rows = [(o, p, s, n, 5.0, 0.05, 0.02, "A", "F") for o, p, s, n in keys]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "lineitem.parquet"))
    return views.annotations(spark, str(tmp_path))


def test_order_of_large_keys(spark, tmp_path):
    keys = [*itertools.product((0, 149_999, 53_999_999, 9 * 10**17, -3), (1, 999_999, 7_200_000, 10**15, -5), (0, 99_999, 100_000, 360_000, -1), (1, 7, 9))]
    keys += [(None, 1, 1, 1), (1, None, 1, 1), (1, 1, None, 1), (1, 1, 1, None)]
    got = annotations(spark, tmp_path, keys).select("id", "seq.order", "seq.rest").collect()
    pos = {f"{o}-{n}-{p}-{s}-A-F-5-5-2": (o * 8 + n) * 10**11 + p * 10**5 + s for o, p, s, n in keys[:-4]}
    assert len(got) == len(keys)
    assert {r.id: r.order * 8 * 10**11 + r.rest for r in got if r.id in pos} == pos
    assert all(0 <= r.rest < 8 * 10**11 for r in got if r.id in pos)
    assert [(r.order, r.rest) for r in got if r.id not in pos] == [(None, None)] * 4


def test_labels_of_large_keys(spark, tmp_path):
    """More than 11.5 million orders; the statuses looked up come before the relevant ones."""
    ann = annotations(spark, tmp_path, [(o, 7_000_000 + n, 300_000 + n, n) for o in (60_000_000, 60_000_001) for n in (1, 2, 3)])
    out = consensus.clean_labels(ann, is_relevant=True, relevant_tags=("A",), cutoff_worker_outliers=2.0, keyword_ids=spark.createDataFrame([(60_000_001,)], "id bigint"))
    assert [(r.id, r.label_tag) for r in out.collect()] == [(60_000_001, "A")]


def test_outliers_are_broadcast_and_answers_go(spark, tmp_path):
    rows = [(f"{t}-{w}", t, "q", "B" if w == 9 else "A", w, t * 10 + w) for t in range(40) for w in range(10) if w != 8 or t % 2]
    rows += [(f"{t}-{w}x", t, "q", "B", w, t * 10 + w) for t in range(0, 12) for w in (1, 2)]
    ann = spark.createDataFrame(rows, "id string, tweet_id bigint, question_tag string, answer_tag string, annotator_id bigint, seq bigint")
    out = agreement.agreement_outlier_ids(ann, 2.0, 5)
    assert 9 in {r[0] for r in out.collect()}
    assert all("outliers" in f for f in out.inputFiles()) and out.inputFiles()  # stored, so that its size is known
    marked = ann.withColumn("flag", F.lit("default")).withColumn("text", F.lit("t")).withColumn("question_id", F.lit(1)).withColumn("answer_id", F.lit(1))
    plan = consensus.answer_groups(marked, outlier_annotators=out)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan
