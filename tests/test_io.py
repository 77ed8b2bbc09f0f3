"""Invariants of the incremental ingest, fingerprints and writers."""

import json
import uuid

from pyspark.sql import functions as F

from annoflow import sinks
from annoflow.functions.hashing import fingerprint
from annoflow.streaming import ingest


def _status(i, **extra):
    d = {"id": i, "id_str": str(i), "text": f"status {i}", "created_at": "Wed Aug 27 13:08:45 +0000 2008",
         "user": {"id_str": "u1", "screen_name": "bob", "created_at": "Wed Aug 27 13:08:45 +0000 2008"},
         "entities": {"user_mentions": [], "urls": []}}
    d.update(extra)
    return json.dumps(d)


def test_merge_batch_is_idempotent_and_incremental(spark, tmp_path):
    store = str(tmp_path / f"store-{uuid.uuid4().hex}")
    first = spark.createDataFrame([(_status(1), "/a/f1"), (_status(2, in_reply_to_status_id_str="1"), "/a/f1")],
                                  "value string, source_file string")
    second = spark.createDataFrame([(_status(3, in_reply_to_status_id_str="1"), "/a/f2"),
                                    (_status(2, in_reply_to_status_id_str="1"), "/a/f2")],
                                   "value string, source_file string")
    ingest.merge_batch(first, store)
    snap1 = sorted((r.id, r.num_replies) for r in ingest.read_store(spark, store).collect())
    assert snap1 == [("1", 1), ("2", 0)]
    ingest.merge_batch(first, store)  # the same input again changes nothing
    assert sorted((r.id, r.num_replies) for r in ingest.read_store(spark, store).collect()) == snap1
    ingest.merge_batch(second, store)  # a new reply counts, the re-collected one does not
    assert sorted((r.id, r.num_replies) for r in ingest.read_store(spark, store).collect()) == [
        ("1", 2), ("2", 0), ("3", 0)]


def test_fingerprint_ignores_order_and_partitioning(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k"))
    a = fingerprint(df).first()
    b = fingerprint(df.repartition(5).orderBy(F.rand(3))).first()
    c = fingerprint(df.where("id != 5")).first()
    assert a == b and a != c


def test_writers(spark, tmp_path):
    labels = spark.createDataFrame([("1", "t", 1, "q", 0, "x"), ("2", "u", 1, "q", 1, "y")],
                                   "id string, text string, question_id bigint, question_tag string, "
                                   "label_id bigint, label_tag string")
    sinks.write_cleaned_labels(labels, str(tmp_path / "cl"), criterion="majority")
    back = spark.read.option("header", True).csv(str(tmp_path / "cl" / "by_question"))
    assert sorted((r.id, r.label, r.question_tag) for r in back.collect()) == [("1", "x", "q"), ("2", "y", "q")]
    rows = spark.range(25).select(F.col("id").cast("string").alias("text"),
                                  F.when(F.col("id") < 20, "train").otherwise("dev").alias("split"))
    sinks.write_pretrain_text(rows, str(tmp_path / "pt"), max_examples_per_file=4)
    train = spark.read.text(str(tmp_path / "pt" / "train"))
    assert train.count() == 20
    assert train.select(F.input_file_name()).distinct().count() >= 5


def test_splits_counts_and_translation_files_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("1", 'a "b"', "q", "train", 0), ("2", "c\nd", "q", "dev", 1)],
                                 "id string, text string, question_tag string, split string, batch int")
    sinks.write_splits(rows.drop("batch"), str(tmp_path / "splits"), seed=1)
    sinks.write_translation_input(rows, str(tmp_path / "translation"))
    sinks.write_counts(rows.select("id", "batch"), str(tmp_path / "counts"))

    def read(folder):
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / folder))

    want = {("1", 'a "b"'), ("2", "c\nd")}
    assert {(r.id, r.text) for r in read("translation").collect()} == want
    assert {(r.id, r.text) for r in read("splits").collect()} == want
    assert {(r.id, r.split) for r in read("splits").collect()} == {("1", "train"), ("2", "dev")}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "counts")).collect()} == {("1", 0), ("2", 1)}
