"""Publishing, keys, questions and listings on small fixtures."""

import pytest
from pyspark.sql import functions as F

from annoflow import sinks
from annoflow.functions import privacy
from annoflow.operators import splits
from annoflow.sources import files, raw


def test_only_whole_runs_are_seen(spark, tmp_path):
    folder = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        sinks.published(spark, folder)
    df = spark.range(3).select(F.col("id"), F.col("id").cast("string").alias("text"))
    first = sinks.publish(spark, folder, lambda path: sinks.write_sample(df, path), seed=1)

    def killed(path):
        sinks.write_sample(df.limit(1), path)
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        sinks.publish(spark, folder, killed, seed=2)
    assert sinks.published(spark, folder) == (first, {"seed": 1})
    again = sinks.publish(spark, folder, lambda path: sinks.write_sample(df, path), seed=3, name="é")
    assert sinks.published(spark, folder) == (again, {"seed": 3, "name": "é"})
    assert spark.read.csv(f"{again}/data").count() == spark.read.csv(f"{first}/data").count() == 3


def test_the_key_is_in_no_plan(spark, tmp_path):
    secret = "0123456789abcdef"
    spark.createDataFrame([("a", bytearray(secret.encode())), ("b", bytearray(b"x" * 16))], "name string, key binary").write.parquet(str(tmp_path / "keys"))
    key = privacy.key_from_table(spark, str(tmp_path / "keys"), "a")
    df = spark.createDataFrame([(1, "amy", ["x", None]), (1, "amy", []), (None, None, None)], "i long, s string, l array<string>")
    spec = {"i": "id", "s": "str", "l": "list"}
    enc = privacy.encrypt_columns(df, spec, key)
    for plan in (enc._jdf.queryExecution().toString(), privacy.decrypt_columns(enc, spec, key)._jdf.queryExecution().toString()):
        assert secret not in plan and secret.encode().hex() not in plan.lower().replace(" ", "")
    rows = enc.collect()
    assert rows[0].i == rows[1].i and rows[0].s != rows[1].s and "amy" not in rows[0].s and rows[2].i is None
    enc.write.parquet(str(tmp_path / "enc"))
    dec = privacy.decrypt_columns(spark.read.parquet(str(tmp_path / "enc")), spec, key)
    assert sorted(map(str, dec.collect())) == sorted(map(str, spark.createDataFrame(
        [("1", "amy", ["x"]), ("1", "amy", None), (None, None, None)], "i string, s string, l array<string>").collect()))
    other = privacy.key_from_table(spark, str(tmp_path / "keys"), "b")
    assert enc.select("i").first() != privacy.encrypt_columns(df, spec, other).select("i").first()


def test_unknown_questions_are_refused(spark, tmp_path):
    labels = spark.createDataFrame([("1", "t", 1, "quality", 0, "x"), ("2", 'say "u"', 2, "toxic", 1, "y")], files.CLEANED_SCHEMA)
    for asked in ("colour", 7):
        with pytest.raises(ValueError, match="colour.*quality.*toxic|7.*1, 2"):
            splits.cleaned_for_question(labels, asked)
    assert [r.id for r in splits.cleaned_for_question(labels, 2).collect()] == ["2"]
    sinks.write_cleaned_labels(labels, str(tmp_path / "cl"))
    (tmp_path / "cl" / "all").rename(tmp_path / "cl" / "cleaned_labels_1.csv")
    back = files.read_cleaned(spark, str(tmp_path / "cl"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, labels.collect()))
    with pytest.raises(FileNotFoundError):
        files.read_cleaned(spark, str(tmp_path / "cl"), "none")


def test_listing_opens_no_file(spark, tmp_path):
    import datetime as dt

    for day, text in (("2020/01/01", "a\n"), ("2020/01/02", "b\nb\n"), ("2020/01/04", "c\n")):
        (tmp_path / day / "00").mkdir(parents=True)
        (tmp_path / day / "00" / "f.txt").write_text(text)
    (tmp_path / "2020/01/04/00/g.gz").write_bytes(b"\x1f\x8bno")
    listing = raw.list_files(spark, str(tmp_path))
    assert sorted((str(r.day), r.size) for r in listing.collect()) == [("2020-01-01", 2), ("2020-01-02", 4), ("2020-01-04", 2), ("2020-01-04", 4)]
    chosen = raw.select_files(spark, str(tmp_path), listing.where(F.col("day") == "2020-01-01"), skip_last_day=True)
    assert [r.value for r in raw.read_files(spark, chosen).collect()] == ["b", "b"]
    recent = raw.select_files(spark, str(tmp_path), last_n_days=3, today=dt.date(2020, 1, 3))  # the 3rd has no folder
    assert sorted(str(r.day) for r in recent.collect()) == ["2020-01-01", "2020-01-02"]
    none = raw.select_files(spark, str(tmp_path / "gone"))
    assert raw.read_files(spark, none).count() == 0
    lines = raw.read_raw_lines(spark, str(tmp_path / "2020/01/01/00"))  # a manifest of lines read names files as the listing does
    assert raw.unused_lines(listing, lines).count() == 3
