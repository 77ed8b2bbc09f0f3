"""Raw-line parsing rules, file-name days, geo primitives and CSV readers on hand-made fixtures."""

import json
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from annoflow.operators import geo
from annoflow.plans import parse as parse_plan
from annoflow.sources import files, raw


def status(i, text="hi", **extra):
    d = {"id": i, "id_str": str(i), "text": text, "created_at": "Wed Aug 27 13:08:45 +0000 2008",
         "lang": "en", "in_reply_to_status_id_str": None,
         "user": {"id_str": "u1", "screen_name": "bob", "name": "Bob", "description": "d&amp;d",
                  "location": "", "created_at": "Wed Aug 27 13:08:45 +0000 2008", "followers_count": 1,
                  "friends_count": 2, "statuses_count": 3, "verified": False},
         "entities": {"user_mentions": [], "urls": []}}
    d.update(extra)
    return d


def lines_df(spark, lines, path="/x/tweets-20200101120000-a.jsonl"):
    df = spark.createDataFrame([(v, path) for v in lines], "value string, source_file string")
    return df.withColumn("day", raw.day_from_path("source_file"))


def test_day_from_path(spark):
    df = spark.createDataFrame([("/a-b/tweets-20200305120000-x.jsonl",), ("/d/stream-p-2019-1-2-3-4-5-x.gz",),
                                ("/r/2021/07/09/13/file.jsonl",), ("/r/other.txt",)], "p string")
    got = [str(r[0]) if r[0] else None for r in df.select(raw.day_from_path("p")).collect()]
    assert got == ["2020-03-05", "2019-01-02", "2021-07-09", None]


def test_parse_rules(spark):
    orig = status(1, "original")
    rt = status(2, "RT ...", retweeted_status=status(1, "original full",
                                                     extended_tweet={"full_text": "original extended"}))
    quote = status(3, "my quote", quoted_status=status(4, "quoted one"))
    reply = status(5, "a reply", in_reply_to_status_id_str="1")
    literal = repr(status(6, "from python", lang=None)).replace('"', "'")
    lines = [json.dumps(x) for x in (orig, rt, quote, reply, orig)] + [
        literal, '{"limit": {"track": 2}}', "{broken", ""]
    df = lines_df(spark, lines).where(F.length("value") > 0)
    parsed, bad = parse_plan.parse(df)
    rows = {r.id: r for r in parsed.collect()}
    assert sorted(rows) == ["1", "2", "3", "4", "5", "6"]
    assert rows["2"].is_retweet and rows["2"].retweeted_status_id == "1"
    assert rows["2"].text == "original extended"  # text of a retweet comes from the original
    assert rows["1"].text == "original"  # the top-level copy beats the embedded one
    assert rows["3"].has_quote and rows["3"].quoted_status_id == "4"
    assert rows["1"].num_retweets == 1 and rows["1"].num_replies == 1
    assert rows["4"].num_quotes == 1
    assert rows["1"].user_description == "d&d"
    assert str(rows["1"].created_at) == "2008-08-27 13:08:45"
    assert [r.value for r in bad.collect()] == ["{broken"]


def test_extraction_gate(spark):
    rt = status(2, "RT", retweeted_status=status(1, "o"))
    q = status(3, "q", quoted_status=status(4, "o2"))
    df = lines_df(spark, [json.dumps(rt), json.dumps(q)])
    parsed, _ = parse_plan.parse(df, extract_retweets=False, extract_quotes=False)
    assert sorted(r.id for r in parsed.collect()) == ["1", "4"]  # embedded originals stay


def square(x0, y0, w, h):
    return [[{"lon": x0, "lat": y0}, {"lon": x0 + w, "lat": y0}, {"lon": x0 + w, "lat": y0 + h},
             {"lon": x0, "lat": y0 + h}]]


def test_point_in_polygon_concave_hole_and_nearest(spark):
    # U-shape (concave) and a square with a hole
    u = [[{"lon": 0.0, "lat": 0.0}, {"lon": 6.0, "lat": 0.0}, {"lon": 6.0, "lat": 6.0}, {"lon": 4.0, "lat": 6.0},
          {"lon": 4.0, "lat": 2.0}, {"lon": 2.0, "lat": 2.0}, {"lon": 2.0, "lat": 6.0}, {"lon": 0.0, "lat": 6.0}]]
    holed = square(10.0, 0.0, 6.0, 6.0) + square(12.0, 2.0, 2.0, 2.0)
    countries = spark.createDataFrame(
        [Row(iso_a2="UU", ord=0, rings=u), Row(iso_a2="HH", ord=1, rings=holed)],
        "iso_a2 string, ord int, rings array<array<struct<lon:double,lat:double>>>")
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 4.0), (3, 5.0, 5.0), (4, 11.0, 1.0), (5, 13.0, 3.0),
                                 (6, 8.5, 3.0), (7, 30.0, 3.0)], "id int, longitude double, latitude double")
    got = {r.id: r.country_code for r in geo.country_of_points(pts, countries).collect()}
    # 2 sits in the notch of the U, 5 in the hole of HH: each is 1 from the edge around it
    assert got == {1: "UU", 2: "UU", 3: "UU", 4: "HH", 5: "HH", 6: "HH", 7: "HH"}


def test_points_far_from_all_countries(spark):
    countries = spark.createDataFrame([Row(iso_a2="AA", ord=0, rings=square(0.0, 0.0, 1.0, 1.0)), Row(iso_a2="BB", ord=1, rings=square(5.0, 0.0, 1.0, 1.0))],
                                      "iso_a2 string, ord int, rings array<array<struct<lon:double,lat:double>>>")
    pts = spark.createDataFrame([(1, -118.0, 0.5), (2, 170.0, 80.0), (3, 3.5, 0.5)], "id int, longitude double, latitude double")
    got = {r.id: r.country_code for r in geo.country_of_points(pts, countries, cell=0.25).collect()}
    assert got == {1: "AA", 2: "BB", 3: "BB"}
    none = geo.country_of_points(pts, countries.limit(0), cell=0.25).collect()
    assert {r.country_code for r in none} == {None}


def test_centroid(spark):
    df = spark.createDataFrame([([[0.0, 0.0], [4.0, 0.0], [4.0, 2.0], [0.0, 2.0]],), ([[1.0, 1.0]] * 4,)],
                               "ring array<array<double>>")
    got = [(r.c.lon, r.c.lat) for r in df.select(geo.ring_centroid(F.col("ring")).alias("c")).collect()]
    assert got == [(2.0, 1.0), (1.0, 1.0)]


def test_gazetteer_longest_match(spark):
    gaz = spark.createDataFrame([("York", 1.0, 1.0, "GB", "g1", "city", 100),
                                 ("New York", 2.0, 2.0, "US", "g2", "city", 50),
                                 ("Santa Cruz de la Sierra", 4.0, 4.0, "BO", "g4", "city", 5),
                                 ("Paris", 3.0, 3.0, "FR", "g3", "city", 10)],
                                "name string, longitude double, latitude double, country_code string, "
                                "geoname_id string, location_type string, population bigint")
    df = spark.createDataFrame([(1, "New York, NY"), (2, "york!"), (3, "nowhere"), (4, None),
                                (5, "in Santa Cruz de la Sierra, Bolivia")],
                               "id int, user_location string")
    got = {r.id: r.geoname_id for r in geo.locate_by_gazetteer(df, gaz).collect()}
    assert got == {1: "g2", 2: "g1", 5: "g4"}


def test_prepare_countries(spark):
    df = spark.createDataFrame([("-99", "France", 0), ("RS", "Serbia", 1), ("-99", "Nowhere", 2)],
                               "iso_a2 string, name_en string, ord int")
    got = sorted(r.iso_a2 for r in geo.prepare_countries(df).collect())
    assert got == ["CS", "FR", "RS"]


def test_annotation_csv_union_and_modes(spark, tmp_path):
    root = tmp_path / "annotations"
    (root / "mturk").mkdir(parents=True)
    (root / "local").mkdir()
    (root / "mturk" / "b1.csv").write_text(
        "id,tweet_id,text,question_id,question_tag,answer_id,answer_tag,worker_id,flag,full_log\n"
        'a1,t1,hi,1,q,10,x,W1,default,"{""totalDurationUntilMturkSubmit"": 5000}"\n')
    (root / "local" / "b2.csv").write_text(
        "id,tweet_id,text,question_id,question_tag,answer_id,answer_tag,user_id,flag\n"
        "a2,t1,hi,1,q,11,y,7,default\n")
    df = files.read_annotations(spark, str(root))
    got = {r.id: (r.mode, r.annotator_id, r.total_time) for r in df.collect()}
    assert got == {"a1": ("mturk", "W1", 5.0), "a2": ("local", "7", None)}
    with pytest.raises(FileNotFoundError):
        files.read_annotations(spark, str(root), mode="public")


def test_uploaded_and_batches(spark, tmp_path):
    up = tmp_path / "uploaded" / "mturk"
    up.mkdir(parents=True)
    (up / "u.csv").write_text("tweet_id,tweet_text,availability\n1,a,available\n2,b,unavailable\n")
    s = tmp_path / "samples" / "batch_3"
    s.mkdir(parents=True)
    (s / "batch_3_2020.csv").write_text("5,x\n6,y\n")
    assert [r.tweet_id for r in files.read_uploaded(spark, str(tmp_path / "uploaded"), "unavailable").collect()] == ["2"]
    assert {r.batch_id for r in files.read_batches(spark, str(tmp_path / "samples")).collect()} == {3}
    assert files.read_sampled(spark, str(tmp_path / "samples")).count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_batches(spark, str(tmp_path / "nothing"))


def test_batch_repeated_after_a_failure_counts_once(spark, tmp_path, monkeypatch):
    """A failure between the log and the store, then the same batch again."""
    from annoflow.operators import interactions
    from annoflow.streaming import ingest

    first = [status(1, "original")]
    second = [status(2, "a reply", in_reply_to_status_id_str="1", in_reply_to_user_id_str="9")]

    def lines(rows):
        return lines_df(spark, [json.dumps(r) if not isinstance(r, str) else r for r in rows]).drop("day")

    store = str(tmp_path / "store")
    ingest.merge_batch(lines(first), store)
    attach = interactions.attach_counts

    def lost(*a, **k):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(interactions, "attach_counts", lost)
    with pytest.raises(RuntimeError):
        ingest.merge_batch(lines(second), store)
    monkeypatch.setattr(interactions, "attach_counts", attach)
    for _ in range(2):
        ingest.merge_batch(lines(second), store)
        got = {r.id: r.num_replies for r in ingest.read_store(spark, store).collect()}
        assert got == {"1": 1, "2": 0}


def test_no_line_is_lost(spark):
    kept = [json.dumps(status(1)), repr(status(2))]
    notices = ['{"limit": {"track": 2}}', "{'limit': {'track': 2}}", '{"id": null}']
    odd = ["[1,2]", "42", '"text"', "{broken", '{"id": 5}', "{'id': 6}", json.dumps({"id": 7, "id_str": None})]
    # a value of another type is lost, not its line; a literal whose nested object is no JSON is read whole
    kept += [json.dumps({**status(3), "user": "nobody"}), repr({**status(4), "user": {"id_str": "u", "verified": True}, "place": None})]
    ok, bad = raw.parse_lines(lines_df(spark, kept + notices + odd))
    assert sorted(tuple(r) for r in ok.select("raw.id_str", F.coalesce("raw.user.id_str", F.lit(""))).collect()) \
        == [("1", "u1"), ("2", "u1"), ("3", ""), ("4", "u")]
    assert sorted(r.value for r in bad.collect()) == sorted(odd)


def test_json_lines_stay_on_the_jvm(spark, tmp_path):
    (tmp_path / "tweets-20200101120000-a.jsonl").write_text(json.dumps(status(1)) + "\n" + repr(status(2)) + "\n")
    ok, _ = raw.parse_lines(raw.read_raw_lines(spark, str(tmp_path)))
    plan = ok._jdf.queryExecution().optimizedPlan().toString()
    branches = plan.split("Relation")
    # JSON lines were parsed once, before; only the branch of odd lines parses, and goes through Python
    assert plan.count("from_json") == 1 and plan.count("ArrowEvalPython") == 1
    assert "ArrowEvalPython" not in branches[0] and "from_json" not in branches[0]
    assert sorted(r[0] for r in ok.select("raw.id_str").collect()) == ["1", "2"]


def test_points_on_a_border_take_the_first_country(spark):
    countries = spark.createDataFrame([Row(iso_a2="AA", ord=0, rings=square(0.0, 0.0, 1.0, 1.0)), Row(iso_a2="BB", ord=1, rings=square(1.0, 0.0, 1.0, 1.0))],
                                      "iso_a2 string, ord int, rings array<array<struct<lon:double,lat:double>>>")
    pts = spark.createDataFrame([(1, 1.0, 0.5), (2, 1.0, 0.0), (3, 1.25, 0.5), (4, 0.0, 0.0)], "id int, longitude double, latitude double")
    got = {r.id: r.country_code for r in geo.country_of_points(pts, countries).collect()}
    assert got == {1: "AA", 2: "AA", 3: "BB", 4: "AA"}


def test_top_level_copy_replaces_a_stored_embedded_one(spark, tmp_path):
    """The retweet comes first, with a shortened copy of its original; the original follows."""
    from annoflow.streaming import ingest

    rt = status(2, "RT", retweeted_status=status(1, "short"))
    whole = status(1, "the whole text")
    store = str(tmp_path / "store")
    for lines in ([rt], [whole], [whole], [rt]):
        ingest.merge_batch(lines_df(spark, [json.dumps(x) for x in lines]).drop("day"), store)
    got = {r.id: (r.text, r.num_retweets) for r in ingest.read_store(spark, store).collect()}
    assert got == {"1": ("the whole text", 1), "2": ("short", 0)}


def test_csv_texts_with_quotes_and_newlines_round_trip(spark, tmp_path):
    from annoflow import sinks

    texts = ['say "hi", you', "two\nlines", "back\\slash \\", '"', "  spaces "]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string")
    sinks.write_sample(df, str(tmp_path / "run"))
    df.write.options(**sinks.CSV).csv(str(tmp_path / "samples" / "sampled_random_1.csv"))
    got = {r.tweet_id: r.tweet_text for r in files.read_sampled(spark, str(tmp_path / "samples")).collect()}
    assert [got[str(i)] for i in range(len(texts))] == texts
    again = spark.read.schema(files.SAMPLE_SCHEMA).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "run" / "data"))
    assert {r.tweet_id: r.tweet_text for r in again.collect()} == got


def test_newest_predictions_of_a_model_win(spark, tmp_path):
    from annoflow.operators import predictions

    for day, label in (("2020-01-05", "old"), ("2020-02-01", "new"), ("2019-12-31", "older")):
        (tmp_path / f"predicted_topic_{day}_ab1cd.csv").write_text(f"id,label,probability,labels,probabilities\n1,{label},0.5,,\n")
    long = predictions.read_predictions(spark, str(tmp_path))
    assert {r.model for r in long.collect()} == {"topic"}
    assert [r.label_topic for r in predictions.wide_predictions(long).collect()] == ["new"]


def test_encryption_hides_and_joins(spark):
    from annoflow.functions import privacy

    df = spark.createDataFrame([("amy",), ("amy",), ("bob",)], "v string")
    enc = [r[0] for r in df.select(privacy.encrypt_value(F.col("v"), "0123456789abcdef")).collect()]
    assert enc[0] == enc[1] != enc[2] and "amy" not in enc
    gcm = df.select(privacy.encrypt_value(F.col("v"), "0123456789abcdef", deterministic=False).alias("e"), "v")
    assert all(r.d == r.v != r.e for r in gcm.select("e", "v", privacy.decrypt_value(
        F.col("e"), "0123456789abcdef", deterministic=False).alias("d")).collect())
