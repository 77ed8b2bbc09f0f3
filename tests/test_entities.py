"""HTML references decoded on the JVM against Python's own decoder."""

import html
import random
from html.entities import html5

from pyspark.sql import functions as F

from annoflow.functions import text as T


def check(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", T.html_unescape("t").alias("d")).collect():
        assert r.d == (None if r.t is None else html.unescape(r.t)), repr(r.t)


def test_all_names(spark):
    check(spark, [f"a&{n}{end}" for n in html5 for end in ("", ";", "x y", " &")])


def test_all_numbers_of_the_first_planes(spark):
    df = spark.range(0, 0x20000, 1, 8).select("id", T.html_unescape(F.concat(F.lit("&#"), "id", F.lit(";"))).alias("d"))
    assert [r for r in df.collect() if r.d != html.unescape(f"&#{r.id};")] == []


def test_odd_references(spark):
    check(spark, [None, "", "&", "&&", "&;", "&#;", "&#x;", "&#X1F600", "&#x1f600;z", "&#0;", "&#00000000065;", "&#1114111;", "&#1114112;", "&#xFFFE;", "&#x10FFFF;",
                  "&#99999999999999999999;", "&#x" + "f" * 40, "&#xD800;", "&#55357;&#56832;", "&amp;lt;", "&ampamp;", "&notit;", "&notin;", "&copycat", "&Copy;", "& amp;",
                  "&" + "a" * 40 + ";", "&lt" + "x" * 40, "x&amp", "é&eacute;&EACUTE;", "&a\tb", "&#\n1", " &nbsp;", "a&#x41g"])


def test_random_texts(spark):
    rng = random.Random(1)
    bits = ["&", "#", "x", ";", "amp", "lt", "not", "in", "1", "65", "128", " ", "\n", "é", "copy", "frac12", "<"]
    check(spark, ["".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(4000)])


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("a &eacute; b",)], "t string").select(T.normalize_str("t").alias("n"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and df.first().n == "a é b"
