"""Disk holds what is in use: stored frames go with their block, a batch leaves the store alone, raw files are compressed."""

import json
import os

import pytest
from pyspark.sql import functions as F

from annoflow import session
from annoflow.operators import interactions
from annoflow.plans import catalog
from annoflow.session import Scratch, stage
from annoflow.streaming import ingest


def stored(spark):
    """What lies in the shared folder."""
    return set(os.listdir(session.ensure_checkpoint_dir(spark).removeprefix("file:")))


def lines(spark, *ids):
    rows = [json.dumps({"id": i, "id_str": str(i), "text": "a", "created_at": "Wed Jan 03 10:00:00 +0000 2024", "user": {"id_str": "7"}}) for i in ids]
    return spark.createDataFrame([(r, "/raw/tweets-20240103100000-0.jsonl") for r in rows], "value string, source_file string")


def test_frames_go_with_their_block(spark):
    before, shuffles = stored(spark), spark.conf.get(session._SHUFFLE_CLEANUP, None)
    with Scratch(spark) as outer:
        with Scratch(spark):
            kept, gone = outer.stage(spark.range(3), "kept"), stage(spark.range(5), "gone")
            twice = spark.range(90).groupBy((F.col("id") % 3).alias("k")).count()
            assert gone.count() == 5 and twice.collect() and len(twice.collect()) == 3  # shuffled once more
        assert {x.split("-")[0] for x in stored(spark) - before} == {"kept"}
        assert kept.count() == 3
    assert stored(spark) == before and spark.conf.get(session._SHUFFLE_CLEANUP, None) == shuffles
    assert stage(spark.range(2), "outside").count() == 2 and len(stored(spark) - before) == 1


def test_a_batch_leaves_the_store_alone(spark, tmp_path, monkeypatch):
    before, store = stored(spark), str(tmp_path / "s")
    ingest.merge_batch(lines(spark, 1, 2), store, span=1)
    ingest.merge_batch(lines(spark, 2, 3), store)
    assert stored(spark) == before
    attach = interactions.attach_counts

    def lost(*a):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(interactions, "attach_counts", lost)
    with pytest.raises(RuntimeError):
        ingest.merge_batch(lines(spark, 4), store)
    monkeypatch.setattr(interactions, "attach_counts", attach)
    assert stored(spark) == before and not Scratch.blocks()
    assert sorted(r.id for r in ingest.read_store(spark, store).collect()) == ["1", "2", "3"]


def test_raw_files_of_a_stream_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "FILE_ROWS", 4)
    (spark.range(10).coalesce(1).select(
        F.col("id").alias("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id"), F.lit("signup").alias("event_type"),
        F.lit(1.5).alias("value"), F.lit("{}").alias("props")).write.parquet(str(tmp_path / "events.parquet")))
    before = stored(spark)
    assert catalog._ingested(spark, str(tmp_path), (1,)).count() == 10
    left = stored(spark) - before
    assert [x.split("-")[0] for x in left] == ["stream"]  # the lines are in the raw files alone
    raw = os.path.join(session.ensure_checkpoint_dir(spark).removeprefix("file:"), *left, "raw", "period=1")
    files = [x for x in os.listdir(raw) if x[0] not in "._"]
    assert files and all(x.endswith(".txt.gz") for x in files)
    assert spark.read.text(raw).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 4
