"""Raw files on disk (gzip, names carrying the day) and the refusal rules of sampling."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from annoflow.operators import sampling
from annoflow.plans import parse as parse_plan
from annoflow.sources import raw


def _line(i, day):
    return json.dumps({"id": i, "id_str": str(i), "text": f"hello {i}",
                       "created_at": f"Wed Jan {day:02d} 10:00:00 +0000 2020",
                       "user": {"id_str": "7", "screen_name": "amy", "created_at": "Wed Jan 01 10:00:00 +0000 2020"},
                       "entities": {"user_mentions": [], "urls": []}})


def test_gzip_files_days_and_last_day(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    for day in (1, 2, 3):
        with gzip.open(d / f"stream-proj-2020-1-{day}-10-0-0-x.gz", "wt") as f:
            f.write("\n".join(_line(day * 10 + k, day) for k in range(3)) + "\n\n")
    lines = raw.read_raw_lines(spark, str(d))
    assert sorted(str(r.day) for r in lines.select("day").distinct().collect()) == [
        "2020-01-01", "2020-01-02", "2020-01-03"]
    kept = raw.omit_last_day(lines)
    parsed, bad = parse_plan.parse(kept)
    assert sorted(int(r.id) for r in parsed.collect()) == [10, 11, 12, 20, 21, 22]
    assert bad.count() == 0
    manifest = lines.select("source_file").distinct().where(F.col("source_file").contains("-1-1-"))
    assert raw.unused_lines(lines, manifest).select("day").distinct().count() == 2


def test_last_n_days_prefixes():
    import datetime as dt
    got = raw.last_n_days_prefixes("s3a://bucket/stream/", 3, today=dt.date(2021, 3, 1))
    assert got == ["s3a://bucket/stream/2021/03/01/", "s3a://bucket/stream/2021/02/28/",
                   "s3a://bucket/stream/2021/02/27/"]


def test_refusals(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("id"))
    with pytest.raises(ValueError):
        sampling.random_sample(df, 11, seed=1)
    assert sampling.random_sample(df, 10, seed=1).count() == 10
    sampled = spark.range(5).select(F.col("id").cast("string").alias("tweet_id"),
                                    F.lit("t").alias("tweet_text"), F.col("id").alias("sample_pos"))
    labelled = sampled.where("sample_pos < 3").select("tweet_id")
    with pytest.raises(ValueError):
        sampling.next_batch(sampled, 3, labelled=labelled)
    b = sampling.next_batch(sampled, 2, labelled=labelled, tail=False)
    assert sorted(r.tweet_id for r in b.collect()) == ["3", "4"] and {r.batch_id for r in b.collect()} == {1}
