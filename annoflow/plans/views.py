"""Derived views: how the driver's tables stand in for the pipeline's entities.

Each view is written once here (DataFrame form) and once in
:mod:`annoflow.plans.oracle` (SQL form); the two must stay in step.

- annotations   <- lineitem   (one crowd answer per line item)
- statuses      <- events     (clicks reply to, purchases quote, views retweet
                               the status named by ``props.k``)
- texts         <- documents  (+ a handle and a URL so anonymisation has work)
- cleaned       <- labels x documents (two questions: quality, toxic)
- turns         <- conversations (each turn replies to the previous one)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annoflow.functions.time import total_time
from annoflow.session import stage
from annoflow.sources.tables import read_table


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    c = F.col
    mode = F.when(c("l_discount") >= 0.05, F.lit("mturk")).otherwise(F.lit("local"))
    ms_submit = (c("l_quantity") * 1000).cast("bigint")
    ms_sequence = (c("l_quantity") * 1000 + c("l_linenumber") * 250).cast("bigint")
    full_log = F.when(c("l_discount") == 0.0, F.lit(None).cast("string")).otherwise(F.concat(
        F.lit('{"totalDurationUntilMturkSubmit": '), ms_submit.cast("string"),
        F.lit(', "totalDurationQuestionSequence": '), ms_sequence.cast("string"), F.lit("}")))
    # (l_orderkey * 8 + l_linenumber) * 10^11 + l_partkey * 10^5 + l_suppkey is too large for a bigint from some 11 million
    # orders on: two numbers of the same order, all below the order's digit and that with what is carried
    below = lambda x, d: F.call_function("div", x - F.pmod(x, F.lit(d)), F.lit(d))
    part = c("l_partkey") + below(c("l_suppkey").cast("bigint"), 100_000)
    line = c("l_linenumber") + below(part, 1_000_000)
    order = c("l_orderkey") + below(line, 8)
    rest = (F.pmod(line, F.lit(8)) * F.lit(100_000_000_000) + F.pmod(part, F.lit(1_000_000)) * 100_000
            + F.pmod(c("l_suppkey"), F.lit(100_000)))
    # the four key columns repeat: the id adds every field the pipeline reads,
    # so (pos, id) orders rows totally up to exact duplicates; pos is null if one of them is
    ann_id = F.concat_ws("-", c("l_orderkey"), c("l_linenumber"), c("l_partkey"), c("l_suppkey"),
                         c("l_returnflag"), c("l_linestatus"), c("l_quantity").cast("bigint"),
                         F.round(c("l_discount") * 100).cast("bigint"), F.round(c("l_tax") * 100).cast("bigint"))
    df = li.select(
        ann_id.alias("id"),
        c("l_orderkey").alias("tweet_id"),
        F.concat(F.lit("status "), c("l_orderkey").cast("string")).alias("text"),
        F.ascii(c("l_linestatus")).cast("bigint").alias("question_id"),
        c("l_linestatus").alias("question_tag"),
        F.ascii(c("l_returnflag")).cast("bigint").alias("answer_id"),
        c("l_returnflag").alias("answer_tag"),
        c("l_suppkey").alias("annotator_id"),
        F.when(c("l_tax") == 0.08, F.lit("incorrect"))
         .when(c("l_tax") == 0.0, F.lit("correct")).otherwise(F.lit("default")).alias("flag"),
        mode.alias("mode"),
        full_log.alias("full_log"),
        F.struct(order.alias("order"), F.when(order.isNotNull(), rest).alias("rest"), ann_id.alias("id")).alias("seq"),
    )
    return df.withColumn("total_time", total_time("full_log", "mode"))


# interaction kind of an event, by event type
KIND_BY_EVENT = {"click": "reply", "purchase": "quote", "view": "retweet"}


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One status per event; ``target_id`` is the status it interacts with."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    kind = F.when(F.col("event_type") == "click", F.lit("reply")) \
        .when(F.col("event_type") == "purchase", F.lit("quote")) \
        .when(F.col("event_type") == "view", F.lit("retweet"))
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("created_at"),
        F.col("user_id"),
        F.col("event_type"),
        kind.alias("kind"),
        F.when(kind.isNotNull(), F.get_json_object("props", "$.k").cast("bigint")).alias("target_id"),
        F.col("value"),
        F.concat(F.lit("Event "), F.col("event_type"), F.lit(" by @u"), F.col("user_id").cast("string"),
                 F.lit(" see http://e.example/"), F.col("event_id").cast("string")).alias("text"),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as statuses: ``RT @<source>: see <page url> <whole text>``."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"], spread_by="doc_id")
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    j = docs.join(pages, docs.doc_id == pages.page_id, "left")
    return j.select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("RT @"), F.col("source"), F.lit(": see "), F.coalesce(F.col("url"), F.lit("")),
                 F.lit(" "), F.col("text")).alias("text"),
        F.col("text").alias("raw_text"),
        F.col("lang"),
        F.col("url"),
        F.col("source").alias("mentions"),
    )


def cleaned_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned-label rows: one per (document, question) from ``labels``."""
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    long = lab.select(
        "doc_id",
        F.expr("stack(2, 'quality', 1L, cast(quality as string), 'toxic', 2L, cast(toxic as string)) "
               "as (question_tag, question_id, label_tag)"))
    return long.join(docs, "doc_id").select(
        F.col("doc_id").alias("id"), "text", "question_id", "question_tag",
        F.col("label_tag").cast("bigint").alias("label_id"), "label_tag")


def embedded_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status copies as met during ingest: every status at top level (priority 0) and the originals
    embedded in quotes and retweets (priority 1, seen when the embedding status was).  Quoted
    originals lie outside the collection (negative ids), so these are only ever embedded."""
    st = statuses(spark, sf_dir)
    top = st.select("id", "created_at", "user_id", F.lit(0).alias("priority"),
                    F.col("created_at").alias("seen_at"), F.col("id").alias("source_id"))
    emb_src = st.where(F.col("kind").isin("quote", "retweet")).select(
        "target_id", "kind", F.col("created_at").alias("seen_at"), F.col("id").alias("source_id"))
    orig = st.select("id", "created_at", "user_id")
    emb = emb_src.join(orig, emb_src.target_id == orig.id).select(
        F.when(F.col("kind") == "quote", -1 - F.col("id")).otherwise(F.col("id")).alias("id"),
        "created_at", "user_id", F.lit(1).alias("priority"), "seen_at", "source_id")
    return top.unionByName(emb)


def sample_tables(spark: SparkSession, sf_dir: str, seed: int = 42):
    """Sample bookkeeping derived from documents/labels.

    sampled: every document in seeded order (``sample_pos``); unavailable:
    documents in German; labelled: documents with labels; batched (batch 1):
    documents of source ``src0``.
    """
    from annoflow.functions.hashing import sample_key
    from annoflow.operators.topk import global_row_index

    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"])
    keyed = docs.select(F.col("doc_id").alias("tweet_id"), sample_key("doc_id", seed).alias("_key"))
    sampled = (global_row_index(keyed, ["_key", "tweet_id"], index_col="sample_pos").drop("_key")
               .join(docs.select(F.col("doc_id").alias("tweet_id"), F.col("text").alias("tweet_text")), "tweet_id")
               .select("tweet_id", "tweet_text", "sample_pos"))
    unavailable = docs.where(F.col("lang") == "de").select(F.col("doc_id").alias("tweet_id"))
    labelled = read_table(spark, sf_dir, "labels", ["doc_id"]).select(F.col("doc_id").alias("tweet_id"))
    batched = docs.where(F.col("source") == "src0").select(F.col("doc_id").alias("tweet_id"),
                                                          F.lit(1).alias("batch_id"))
    return sampled, unavailable, labelled, batched


def order_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as dated statuses (seven years: month and year bins)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created_at"))


# ---- raw statuses as collected (JSON lines), countries and a gazetteer

TWITTER_TS = "EEE MMM dd HH:mm:ss '+0000' yyyy"


def _status_struct(e: str, embedded: bool = False):
    """Raw status object of event alias ``e`` (a struct of its columns)."""
    c = lambda n: F.col(f"{e}.{n}")
    text = F.concat(F.lit("Event "), c("event_type"), F.lit(" of user "), c("user_id").cast("string"),
                    F.lit(" &amp; value "), F.round(c("value") * 100).cast("bigint").cast("string"),
                    F.lit("\tend"))
    user = F.struct(
        c("user_id").cast("string").alias("id_str"),
        F.concat(F.lit("u"), c("user_id").cast("string")).alias("screen_name"),
        F.concat(F.lit("User "), c("user_id").cast("string")).alias("name"),
        F.concat(F.lit("about\nuser "), c("user_id").cast("string")).alias("description"),
        F.concat(F.lit("Home of NATION_"), (c("user_id") % 25).cast("string"), F.lit("!")).alias("location"),
        F.date_format(F.lit("2018-01-01 00:00:00").cast("timestamp"), TWITTER_TS).alias("created_at"),
        (c("user_id") * 10).alias("followers_count"),
        c("user_id").alias("friends_count"),
        c("event_id").alias("statuses_count"),
        ((c("user_id") % 2) == 0).alias("verified"))
    x = (c("value") * 7.3) % 360 - 180
    y = (c("value") * 3.1) % 160 - 80
    at = F.instr(text, "user ") - 1
    mention = F.struct(c("user_id").cast("string").alias("id_str"),
                       F.concat(F.lit("u"), c("user_id").cast("string")).alias("screen_name"),
                       F.array(at, at + F.length(F.concat(F.lit("user "), c("user_id").cast("string"))))
                       .alias("indices"))
    media_item = lambda kind, i: F.struct(
        F.lit(kind).alias("type"),
        F.concat(F.lit("http://m.example/"), c("event_id").cast("string"), F.lit(f"/{i}.jpg")).alias("media_url"),
        F.concat(F.lit("http://x.example/"), c("event_id").cast("string"), F.lit(f"/{kind}/{i}"))
        .alias("expanded_url"))
    fields = [
        c("event_id").alias("id"), c("event_id").cast("string").alias("id_str"), text.alias("text"),
        F.struct(F.array(mention).alias("user_mentions")).alias("entities"),
        F.when(c("event_type") == "purchase", F.struct(F.array(
            media_item("photo", 1), media_item("photo", 2), media_item("video", 3)).alias("media")))
        .alias("extended_entities"),
        F.date_format(c("ts"), TWITTER_TS).alias("created_at"), F.lit("en").alias("lang"),
        F.when(c("event_type") == "click", c("target")).cast("string").alias("in_reply_to_status_id_str"),
        user.alias("user"),
        F.when(c("event_type") == "signup", F.struct(F.array(x, y).alias("coordinates"))).alias("coordinates"),
        F.when(c("event_type") == "error", F.struct(
            F.when(c("user_id") % 2 == 0, F.lit("")).otherwise(
                F.concat(F.lit("N"), F.char(F.lit(65) + c("user_id") % 25))).alias("country_code"),
            F.lit("city").alias("place_type"),
            F.struct(F.array(F.array(F.array(x - 0.5, y - 0.5), F.array(x + 0.5, y - 0.5),
                                     F.array(x + 0.5, y + 0.5), F.array(x - 0.5, y + 0.5))).alias("coordinates"))
            .alias("bounding_box"))).alias("place"),
    ]
    return F.struct(*fields)


#: A target named by more rows than this is popular.
POPULAR_ROWS = 10_000
#: Rows of wide text that one task makes.
TASK_ROWS = 50_000


def beside_targets(df: DataFrame, key: str, target: str) -> DataFrame:
    """Left self-join on ``target`` = ``key``, as two structs ``e`` (the row) and ``t`` (its target).

    No task gets all rows of a key: rows without a target are not joined, and popular targets, of which there are at most
    rows / :data:`POPULAR_ROWS`, are broadcast.
    """
    e = df.select(F.struct(*df.columns).alias("e"))
    t = df.where(F.col(key).isNotNull()).select(F.struct(*df.columns).alias("t"))
    popular = stage(df.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("_key")).agg(F.count("*").alias("_n"))
                    .where(F.col("_n") > POPULAR_ROWS).select("_key"), "popular")
    hot = F.broadcast(popular)
    on = F.col(f"e.{target}") == F.col(f"t.{key}")
    lone = e.where(F.col(f"e.{target}").isNull()).withColumn("t", F.lit(None).cast(t.schema["t"].dataType))
    told = e.where(F.col(f"e.{target}").isNotNull())
    few = told.join(hot, F.col(f"e.{target}") == F.col("_key"), "left_anti").join(t, on, "left")
    many = (told.join(hot, F.col(f"e.{target}") == F.col("_key"), "left_semi")
            .join(F.broadcast(t.join(hot, F.col(f"t.{key}") == F.col("_key"), "left_semi")), on, "left"))
    return lone.unionByName(few).unionByName(many)


def _dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt by hash to tasks of about :data:`TASK_ROWS`, before they are made wide."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // TASK_ROWS)), *keys)


def lines_file(ts: str):
    """The file of an hour's lines."""
    return F.concat(F.lit("/raw/tweets-"), F.date_format(ts, "yyyyMMddHH"), F.lit("0000-0.jsonl")).alias("source_file")


def raw_status_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON lines of every event: clicks reply to, purchases quote and views
    retweet the event named by ``props.k`` (embedded as a full object).  Every
    50th line is written as a Python literal, and each collection day gets an
    API notice line."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    ev = ev.withColumn("target", F.when(F.col("event_type").isin("click", "purchase", "view"),
                                        F.get_json_object("props", "$.k").cast("bigint"))).drop("props")
    # read ten times below: the target is found once, and the text it is found in goes no further
    ev = stage(ev, "events")
    j = _dealt(beside_targets(ev, "event_id", "target"), ["e.event_id", "e.ts", "e.user_id"])
    me = _status_struct("e")
    emb = _status_struct("t")
    raw = me.withField("quoted_status", F.when(F.col("e.event_type") == "purchase", emb)) \
            .withField("retweeted_status", F.when(F.col("e.event_type") == "view", emb))
    js = F.to_json(raw)
    literal = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        js, '"', "'"), ":true", ":True"), ":false", ":False"), ":null", ":None")
    lines = j.select(
        F.when(F.col("e.event_id") % 50 == 7, literal).otherwise(js).alias("value"),
        lines_file("e.ts"))
    # every event has its line, so the files are those of the events
    notices = (ev.select(F.date_trunc("hour", "ts").alias("ts")).distinct().alias("e")
               .select(F.lit('{"limit": {"track": 3}}').alias("value"), lines_file("e.ts")).distinct())
    from annoflow.sources.raw import day_from_path
    out = lines.unionByName(notices).withColumn("day", day_from_path("source_file"))
    # stored once, like the collected files: the JSON building above would
    # otherwise be inlined into every expression that reads ``value``
    return stage(out, "lines")


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rectangle per nation on a 5 x 5 grid (iso 'NA'..'NY'), region from ``region``."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    k = F.col("n_nationkey")
    x0 = F.lit(-150.0) + (k % 5) * 60.0
    y0 = F.lit(-80.0) + F.floor(k / 5) * 32.0
    pt = lambda x, y: F.struct(x.alias("lon"), y.alias("lat"))
    ring = F.array(pt(x0, y0), pt(x0 + 50, y0), pt(x0 + 50, y0 + 28), pt(x0, y0 + 28))
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.concat(F.lit("N"), F.char(F.lit(65) + k)).alias("iso_a2"),
        F.col("n_name").alias("name_en"), F.col("r_name").alias("region_wb"),
        F.col("n_name").alias("subregion"), F.array(ring).alias("rings"), k.alias("ord"))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation names as places at their rectangle centres."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    k = F.col("n_nationkey")
    return n.select(
        F.col("n_name").alias("name"),
        (F.lit(-125.0) + (k % 5) * 60.0).alias("longitude"),
        (F.lit(-66.0) + F.floor(k / 5) * 32.0).alias("latitude"),
        F.when(k % 7 == 3, F.lit("")).otherwise(F.concat(F.lit("N"), F.char(F.lit(65) + k))).alias("country_code"),
        F.concat(F.lit("g"), k.cast("string")).alias("geoname_id"),
        F.lit("country").alias("location_type"),
        (F.lit(1000) + k).cast("bigint").alias("population"))
