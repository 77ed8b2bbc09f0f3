"""Observed step figures, headers of many files, and places by the beginnings of their names."""

import pytest
from pyspark.sql import functions as F

from annoflow.operators import geo
from annoflow.operators.steps import Steps
from annoflow.sources import files


def test_steps_are_counted_while_the_chain_runs(spark):
    steps = Steps()
    df = steps(spark.range(100), "start")
    df = steps(df.where("id % 4 = 0"), "fourth")
    df = steps(df.withColumn("n", F.lit(3)), "weight", F.sum("n"))
    df = steps(df.join(spark.range(0).withColumnRenamed("id", "k"), F.col("id") == F.col("k"), "left_semi"), "none")
    df = steps(df.where("id > 3"), "after", F.sum("n"))
    assert steps.run(df, "chain").count() == 0
    assert [tuple(r) for r in steps.report(spark).collect()] == [
        ("start", 100, None), ("fourth", 25, 75.0), ("weight", 75, -200.0), ("none", 0, 100.0), ("after", 0, None)]


def test_many_files_of_two_layouts(spark, tmp_path):
    (tmp_path / "local").mkdir()
    (tmp_path / "mturk").mkdir()
    for i in range(300):
        if i % 2:
            (tmp_path / "local" / f"b{i}.csv").write_text(f'id,tweet_id,answer_tag,user_id\na{i},t,"x\nid,y",{i}\n')
        else:
            (tmp_path / "mturk" / f"m{i}.csv").write_text(f"tweet_id,id,worker_id,extra\nt,a{i},W{i},z\n")
    (tmp_path / "local" / "empty.csv").write_text("")
    df = files.read_annotations(spark, str(tmp_path))
    got = {r.id: (r.mode, r.annotator_id, r.answer_tag) for r in df.collect()}
    assert got == {f"a{i}": ("local", str(i), "x\nid,y") if i % 2 else ("mturk", f"W{i}", None) for i in range(300)}
    assert {r.id for r in files.read_annotations(spark, str(tmp_path), pattern="b29").collect()} == {"a29", *(f"a{i}" for i in range(291, 300, 2))}
    for bad in (lambda: files.read_annotations(spark, str(tmp_path), "nobody"), lambda: files.read_uploaded(spark, str(tmp_path), mode="nobody")):
        with pytest.raises(ValueError):
            bad()


def test_long_names_and_beginnings(spark):
    long = " ".join(f"part{i}" for i in range(15))
    names = [long, "part0", "part0 part1", "new", "new york", "york", "new york city hall", "st", "a b c"]
    gaz = spark.createDataFrame([(n, 0.0, 0.0, "XX", f"g{i}", "city", 100 - i) for i, n in enumerate(names)],
                                "name string, longitude double, latitude double, country_code string, geoname_id string, location_type string, population bigint")
    places = ["in " + long + " today", long[:-1], "New York City", "new york city hall!", "york new", "a b", "x a b c", "St", "", "part1 part0", "new new york"]

    def want(p):
        words = p.lower().replace("!", "").split()
        hits = [(len(n.split()), 100 - i, f"g{i}") for i, n in enumerate(names) if any(words[k:k + len(n.split())] == n.split() for k in range(len(words)))]
        return max(hits)[2] if hits else None

    df = spark.createDataFrame(list(enumerate(places)), "id int, user_location string")
    got = {r.id: r.geoname_id for r in geo.locate_by_gazetteer(df, gaz).collect()}
    assert [got.get(i) for i in range(len(places))] == [want(p) for p in places]
    plan = geo.locate_by_gazetteer(df, gaz)._jdf.queryExecution().executedPlan().toString()
    assert "flatten" not in plan  # no table of all word sequences
