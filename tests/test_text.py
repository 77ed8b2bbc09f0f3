"""Text expressions against expected texts written out by hand."""

import hashlib
import html

import pytest
from pyspark.sql import functions as F

from annoflow.functions import text as T

# text, normalised, URLs replaced, user names replaced, both replaced, cleared
SAME = None  # as the text
CASES = [
    ("hey,@bob look", SAME, SAME, "hey @user look", "hey @user look", "hey look"),
    ("mail a@b.com now", SAME, SAME, SAME, SAME, SAME),
    ("@@x and @y", SAME, SAME, "@@x and @user", "@@x and @user", "@@x and"),
    ("@abcdefghijklmnop is too long", SAME, SAME, SAME, SAME, SAME),
    ("@zo\u00eb_\u00e9 hi", SAME, SAME, "@user hi", "@user hi", "hi"),
    ("see http://x.co/a?b=1 and www.foo.bar plus htt://y", SAME, "see <url> and <url> plus <url>", SAME,
     "see <url> and <url> plus <url>", "see and plus"),
    ("tab\there\nnew  line", *["tab here new line"] * 5),
    ("zero\u200bwidth", "zerowidth", SAME, SAME, SAME, SAME),
    ("&amp; &lt;3 &eacute; &#39;q&#39; &notanentity; &&&", "& <3 \u00e9 'q' \u00acanentity; &&&", SAME, SAME, SAME, SAME),
    ("nbsp\u00a0here\u3000x", *["nbsp here x"] * 5),
    ("", SAME, SAME, SAME, SAME, SAME),
    ("RT @user: hi", SAME, SAME, "RT @user : hi", "RT @user : hi", "rt : hi"),
    ("  lead trail  ", *["lead trail"] * 5),
    ("RT @CNN: breaking http://t.co/x @a_b_c!", SAME, "RT @CNN: breaking <url> @a_b_c!",
     "RT @user : breaking http://t.co/x @user !", "RT @user : breaking <url> @user !", "rt : breaking !"),
    ("e-mail: x@y @sp ace", SAME, SAME, "e-mail: x@y @user ace", "e-mail: x@y @user ace", "e-mail: x@y ace"),
    ("\u00c9COLE @\u00dcn\u00efcode_1 fin.", SAME, SAME, "\u00c9COLE @user fin.", "\u00c9COLE @user fin.", "\u00e9cole fin."),
    ("ends with @handle", SAME, SAME, "ends with @user", "ends with @user", "ends with"),
]
SAMPLES = [c[0] for c in CASES]


def expected(i):
    return [c[0] if c[i] is SAME else c[i] for c in CASES]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, s string")


def _col(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_normalize(texts):
    assert _col(texts, T.normalize_str("s")) == expected(1)


def test_normalize_null(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(T.normalize_str("s")).first()[0] == ""


def test_urls_users_anonymize(texts):
    assert _col(texts, T.replace_urls("s")) == expected(2)
    assert _col(texts, T.replace_usernames("s")) == expected(3)
    assert _col(texts, T.anonymize_text("s")) == expected(4)


def test_text_cleared(texts):
    assert _col(texts, T.text_cleared("s")) == expected(5)


def test_strip_rt_option(spark):
    df = spark.createDataFrame([(0, "RT  @bob: hi there")], "i int, s string")
    assert _col(df, T.text_cleared("s")) == ["rt : hi there"]
    assert _col(df, T.text_cleared("s", strip_rt=True)) == ["hi there"]


def test_dedup_key_and_hash(texts):
    assert _col(texts, T.sample_dedup_key("s")) == [s.strip() for s in SAMPLES]  # no sample has a filler
    marked = texts.sparkSession.createDataFrame([(0, " @<user> so <url>"), (1, "<url>")], "i int, s string")
    assert _col(marked, T.sample_dedup_key("s")) == ["so", ""]
    assert _col(texts, T.text_hash("s")) == [hashlib.md5(s.encode()).hexdigest() for s in SAMPLES]


def test_fold_quotes(spark):
    df = spark.createDataFrame([(0, "‘a’ “b” c–d ´")], "i int, s string")
    assert _col(df, T.fold_quotes("s")) == ["'a' \"b\" c-d '"]


def test_token_count_forms_agree(spark, texts):
    a = [r.token_count for r in T.with_token_count(texts, "s").orderBy("i").collect()]
    b = _col(texts, T.token_count("s"))
    assert a == b
    df = spark.createDataFrame([(0, "The quick brown fox http://x.y @me jumps over the lazy dog")], "i int, s string")
    assert T.with_token_count(df, "s").first().token_count == 6  # quick brown fox jumps lazy dog


def test_contains_keywords(spark):
    df = spark.createDataFrame([
        (0, "Vaccine news", None, None), (1, "nothing", "vaccineguy", None),
        (2, "nothing", None, "http://a.org/vaccines/x"), (3, "nothing", None, "http://a.org/xvaccine"),
        (4, "nothing", None, "http://a.org/2vaccine_"),
    ], "i int, t string, m string, u string")
    got = _col(df, T.contains_keywords("t", "m", "u", ["vaccine"]))
    assert got == [True, True, False, False, True]
    assert _col(df, T.contains_keywords("t", "m", "u", [])) == [False] * 5


def test_unescape_fast_path_matches_python(spark):
    cases = ["a &amp; b", "&amp;lt; x", "&lt;3 &gt; &quot;q&quot; &apos;a&#39;", "&amp;amp;", "AT&T &ampx",
             "&eacute;t&eacute; &amp;", "&#x41;&#66; &nbsp;!", "& alone", "&&&", "", "no entity"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(cases)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(T.html_unescape(F.col("s"))).collect()]
    assert got == [html.unescape(s) for s in cases]


def test_keywords_between_separators_in_urls(spark):
    import re

    urls = ["http://x.org/flu", "http://x.org/influenza", "http://x.org/flu2", "http://x.org/2flu_a", "http://x.org/flucas", "http://x.org/éflué",
            "http://x.org/é-flu-é", "http://x.org/coldx", "http://x.org/xcold", "http://x.org/٣flu", "x flu", ""]
    for keywords in (("flu",), ("flu|cold",), ("col", "flu")):
        df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", T.contains_keywords(F.lit(""), None, "u", keywords).alias("k"))
        for r in df.collect():
            want = any(re.search(rf"(\b|\d|_){k}(\b|\d|_|cas)", r.u.lower()) for k in keywords)
            assert r.k == want, (keywords, r.u)
