"""Work is dealt evenly, whatever the keys: popular targets, rows without one, few large groups."""

import json

from pyspark.sql import functions as F

from annoflow.functions import entities
from annoflow.functions import status as S
from annoflow.operators import agreement, splits
from annoflow.operators.interactions import COUNT_COLS
from annoflow.plans import parse, views, workflows
from annoflow.session import stage
from annoflow.sources import raw


def events(spark, n):
    """Half of the rows name one of two targets, two in five none, others an id that is not there or there twice."""
    target = F.when(F.col("id") % 10 < 4, None).when(F.col("id") % 10 < 9, F.col("id") % 2).otherwise(F.when(F.col("id") % 20 < 10, -7).otherwise(5))
    df = spark.range(n).withColumn("target", target.cast("bigint"))
    return df.unionByName(df.where("id = 5")).unionByName(spark.createDataFrame([(None, 1), (None, None)], "id bigint, target bigint"))


def test_beside_targets(spark, monkeypatch):
    monkeypatch.setattr(views, "POPULAR_ROWS", 30)
    df = events(spark, 200)
    got = views.beside_targets(df, "id", "target").select("e.id", "e.target", F.col("t.id").alias("t_id"), F.col("t.target").alias("t_target"))
    t = df.select(F.col("id").alias("t_id"), F.col("target").alias("t_target"))
    want = df.join(t, df["target"] == t["t_id"], "left")
    key = lambda rows: sorted(map(str, rows))
    assert key(got.collect()) == key(want.select(*got.columns).collect())


def test_lines_dealt_evenly(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(views, "POPULAR_ROWS", 100)
    monkeypatch.setattr(views, "TASK_ROWS", 500)
    (spark.range(4000).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id % 90)").alias("ts"), (F.col("id") % 9).alias("user_id"),
        F.when(F.col("id") % 5 < 2, "signup").otherwise("view").alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 3}').alias("props"))
     .write.parquet(str(tmp_path / "events.parquet")))
    files = views.raw_status_lines(spark, str(tmp_path)).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 4000 + 2  # a notice for each hour
    assert max(r["count"] for r in files) < 800


def test_stored_files_have_few_rows(spark):
    stored = stage(spark.range(25_000).coalesce(1), "few")
    assert stored.count() == 25_000
    assert len(stored.inputFiles()) == 3


def test_batch_is_not_counted(spark):
    """The merge of a batch counts the whole log; counts of the batch alone would be dropped."""
    line = json.dumps({"id": 1, "id_str": "1", "text": "a", "created_at": "Wed Jan 03 10:00:00 +0000 2024", "user": {"id_str": "7"}, "in_reply_to_status_id_str": "2"})
    lines = spark.createDataFrame([(line, "/raw/tweets-20240103100000-0.jsonl")], "value string, source_file string").withColumn("day", raw.day_from_path("source_file"))
    batch, log, _ = parse.parse_with_log(lines, keep_origin=True)
    assert not set(COUNT_COLS.values()) & set(batch.columns)
    assert [tuple(r) for r in log.select("source_id", "kind", "target_id").collect()] == [("1", "reply", "2")]


def test_common_references_are_found_first(spark):
    row = spark.range(1).select(F.map_keys(entities._names()).alias("k")).first()
    assert row["k"][:2] == ["amp;", "lt;"] and len(row["k"]) == len(set(row["k"])) == len(entities.html5)


def test_split_rows_are_not_shuffled_by_question(spark):
    df = spark.range(90).select(F.col("id"), F.concat(F.lit("q"), (F.col("id") % 2).cast("string")).alias("question_tag"), F.lit("a").alias("label"), F.repeat(F.lit("x"), 50).alias("text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = splits.train_dev_test_split(df, seed=1)
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin [question_tag" in plan
        assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 54, "dev": 18, "test": 18}  # 45 rows each
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_target_is_found_once(spark, monkeypatch, tmp_path):
    (spark.range(20).select(
        F.col("id").alias("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"), F.col("id").alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(1.5).alias("value"), F.concat(F.lit('{"k": '), F.col("id") % 3, F.lit("}")).alias("props")).write.parquet(str(tmp_path / "events.parquet")))
    met, join = [], views.beside_targets
    monkeypatch.setattr(views, "beside_targets", lambda df, key, target: met.append(df) or join(df, key, target))
    lines = views.raw_status_lines(spark, str(tmp_path))
    assert "props" not in met[0].columns
    assert "get_json_object" not in met[0]._jdf.queryExecution().optimizedPlan().toString()
    got = lines.where("value like '%\"retweeted_status\"%'").select(F.get_json_object("value", "$.retweeted_status.id_str")).collect()
    assert sorted(r[0] for r in got) == sorted(str(i % 3) for i in range(20) if i % 50 != 7)  # the 7th line is a literal


def test_only_copies_are_stored(spark):
    status = {"id": 1, "id_str": "1", "text": "a", "user": {"id_str": "7"}, "quoted_status": {"id": 2, "id_str": "2", "text": "b", "user": {"id_str": "8"}}}
    values = [json.dumps(status), str({**status, "id_str": "3"}), "no line", '{"limit": 1}', json.dumps({**status, "id_str": None}), json.dumps({**status, "id_str": "4", "text": None})]
    lines = spark.createDataFrame([(v, "f") for v in values], "value string, source_file string")
    ok, bad = raw.parse_lines(lines, S.copies)
    assert {f.name for f in ok.schema["raw"].dataType.elementType.fields} >= {"priority", "id_str", "text_raw"}
    got = ok.select(F.explode("raw").alias("c")).where("c is not null").select("c.priority", "c.id_str", "c.text_raw", "c.quoted.user_id").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
        (0, "1", "a", "8"), (1, "2", "b", None), (0, "3", "a", "8"), (1, "2", "b", None), (0, "4", None, "8"), (1, "2", "b", None)]))
    assert sorted(r[0] for r in bad.select("value").collect()) == sorted(["no line", values[4]])


def test_final_answers_are_found_once(spark):
    rows = [(t, "q", a, "x" if a < 3 else "y", s) for t in range(4) for a in range(4) for s in (1, 2)]
    ann = spark.createDataFrame(rows, "tweet_id int, question_tag string, annotator_id int, answer_tag string, seq int")
    out = agreement.annotator_agreement(ann)
    assert "max_by" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r["annotator_id"]: (r["agreement_count"], r["total_count"]) for r in out.collect()} == {0: (8, 12), 1: (8, 12), 2: (8, 12), 3: (0, 12)}


def test_pretraining_texts_are_found_once(spark):
    parsed = spark.range(40).select(F.col("id"), F.concat(F.lit("text "), F.col("id") % 30).alias("text"), F.lit(False).alias("is_retweet"),
                                    F.lit("en").alias("lang"), F.lit(5).alias("token_count"))
    out = workflows.pretraining_text(parsed, seed=1)
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"train": 24, "dev": 6}
