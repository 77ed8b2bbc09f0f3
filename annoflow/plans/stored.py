"""Registered queries on data that is written and read back: raw files chosen from a listing, copies of other days in the ingest
store, published outputs, prediction files, exports; and options of operators that no other query takes.  Each has its SQL beside it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from annoflow import sinks
from annoflow.functions import text as T
from annoflow.functions.hashing import fingerprint
from annoflow.operators import interactions, predictions, reports, sampling, splits
from annoflow.plans import exports, oracle, views, workflows
from annoflow.session import shared_folder
from annoflow.sources import files, raw
from annoflow.sources.tables import read_table

QUERIES, ORACLE_SQL = {}, {}


def _query(sql: str):
    def register(fn):
        QUERIES[fn.__name__], ORACLE_SQL[fn.__name__] = fn, sql
        return fn
    return register


def _broken_file(spark, path: str) -> None:
    """A gzip file by its name, but not by its content: reading it fails."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p)
    out.write(b"\x1f\x8bno gzip")
    out.close()


def raw_day_folders(spark, sf_dir: str) -> str:
    """Raw lines as files below ``YYYY/MM/DD/00/``.  The newest day's folder and the one of the 3rd also hold an unreadable file."""
    root = shared_folder(spark, "raw-days")
    views.raw_status_lines(spark, sf_dir).select("value", F.col("day").cast("string").alias("d")).write.partitionBy("d").text(f"{root}/by-day")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = sorted(f.getPath().getName()[2:] for f in fs.listStatus(path(f"{root}/by-day")) if f.isDirectory())
    for d in days:
        target = f"{root}/raw/{d.replace('-', '/')}"
        fs.mkdirs(path(target))
        fs.rename(path(f"{root}/by-day/d={d}"), path(f"{target}/00"))
        if d == days[-1] or d.endswith("-03"):
            _broken_file(spark, f"{target}/00/broken.gz")
    return f"{root}/raw"


@_query("""
WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y%m%d%H') AS file FROM events)
SELECT day, CAST(count(*) + count(DISTINCT file) AS BIGINT) AS n_lines FROM e
WHERE day < (SELECT max(day) FROM e) AND day NOT LIKE '%-03' GROUP BY day""")
def raw_files_selected(spark, sf_dir):
    """The newest day, used files and days without a folder are left out before any file is opened; some of
    them could not be read."""
    root = raw_day_folders(spark, sf_dir)
    newest = raw.list_files(spark, root).agg(F.max("day")).first()[0] or dt.date(2024, 1, 1)
    used = raw.list_files(spark, root).where(F.dayofmonth("day") == 3).select("source_file")
    chosen = raw.select_files(spark, root, used, skip_last_day=True, last_n_days=60, today=newest + dt.timedelta(days=9))
    return raw.read_files(spark, chosen).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n_lines"))


@_query("""
SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 3 <> 0 THEN 'whole ' ELSE 'short ' END || CAST(event_id AS VARCHAR) AS text,
       strftime(CASE WHEN event_id % 3 <> 0 THEN ts ELSE ts - INTERVAL 1 DAY END, '%Y-%m-%d') AS created_day, CAST(1 AS BIGINT) AS num_retweets
FROM events
UNION ALL
SELECT CAST(event_id + 1000000000 AS VARCHAR), 'short ' || CAST(event_id AS VARCHAR), strftime(ts, '%Y-%m-%d'), CAST(0 AS BIGINT) FROM events""")
def stream_better_copies(spark, sf_dir):
    """Every status is first met inside a retweet, with another day; of two in three the original follows."""
    from annoflow.streaming import ingest

    ev = read_table(spark, sf_dir, "events", ["event_id", "ts"], spread_by="event_id")
    at = lambda c: F.date_format(c, views.TWITTER_TS)

    def status(id_, text, ts):
        return [id_.alias("id"), id_.cast("string").alias("id_str"), text.alias("text"), at(ts).alias("created_at"),
                F.struct(F.lit("1").alias("id_str")).alias("user")]

    me, ts = F.col("event_id"), F.col("ts")
    short = F.struct(*status(me, F.concat(F.lit("short "), me.cast("string")), ts - F.expr("INTERVAL 1 DAY")))
    retweet = F.struct(*status(me + 1000000000, F.lit("RT"), ts), short.alias("retweeted_status"))
    whole = F.struct(*status(me, F.concat(F.lit("whole "), me.cast("string")), ts))
    file = F.concat(F.lit("/raw/tweets-"), F.date_format(ts, "yyyyMMddHH"), F.lit("0000-0.jsonl")).alias("source_file")
    store = shared_folder(spark, "store")
    ingest.merge_batch(ev.select(F.to_json(retweet).alias("value"), file), store, batch_id="1", span=1 << 20)
    ingest.merge_batch(ev.where("event_id % 3 != 0").select(F.to_json(whole).alias("value"), file), store, batch_id="2")
    return ingest.read_store(spark, store).select("id", "text", F.col("created_day").cast("string").alias("created_day"), "num_retweets")


# ---- published outputs (K2-K5, K7, K8): a half-done run, an older one and the current one

def _published(spark, label, write, old, new):
    """``new`` published after ``old``; a later run is killed after it wrote its data."""
    folder = shared_folder(spark, label)
    sinks.publish(spark, folder, lambda path: write(old, path), n=1)

    def killed(path):
        write(old, path)
        raise InterruptedError

    sinks.publish(spark, folder, lambda path: write(new, path), n=2)
    try:
        sinks.publish(spark, folder, killed, n=3)
    except InterruptedError:
        pass
    run, params = sinks.published(spark, folder)
    assert params == {"n": 2}
    return run


def _csv(spark, path, schema, header=True):
    return spark.read.schema(schema).option("header", header).option("multiLine", True).option("escape", '"').csv(path)


_HASH = "md5(coalesce(text, ''))"


def _hashed(df, *columns):
    return df.select(*columns, F.md5(F.coalesce("text", F.lit(""))).alias("text_hash"))


@_query(f"SELECT CAST(doc_id AS VARCHAR) AS id, {_HASH} AS text_hash FROM documents")
def written_sample(spark, sf_dir):
    """K2."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"]).select(F.col("doc_id").alias("id"), "text")
    run = _published(spark, "samples", sinks.write_sample, docs.where("id < 10"), docs)
    return _hashed(_csv(spark, f"{run}/data", "id string, text string", header=False), "id")


@_query(f"""WITH {oracle.CLEANED}
SELECT CAST(id AS VARCHAR) AS id, question_tag, label_tag AS label, {_HASH} AS text_hash FROM cleaned""")
def written_labels(spark, sf_dir):
    """K3, one folder a question."""
    labels = views.cleaned_labels(spark, sf_dir)
    run = _published(spark, "cleaned", sinks.write_cleaned_labels, labels.where("question_id = 1"), labels)
    return _hashed(_csv(spark, f"{run}/by_question", "id string, text string, label string, question_tag string"), "id", "question_tag", "label")


@_query(f"SELECT CAST(id AS VARCHAR) AS id, question_tag, label, split FROM ({oracle.TRAIN_DEV_TEST_SPLIT})")
def written_splits(spark, sf_dir):
    """All questions split, one folder a question and split."""
    cut = workflows.split_labels(views.cleaned_labels(spark, sf_dir), seed=42)
    run = _published(spark, "splits", sinks.write_splits, cut.where("split = 'dev'"), cut)
    return _csv(spark, run, "id string, text string, label string, question_tag string, split string").select("id", "question_tag", "label", "split")


@_query(f"""SELECT split, md5(text) AS text_hash FROM ({oracle.PRETRAIN_TEXT})""")
def written_pretrain_text(spark, sf_dir):
    """K5: text lines by split."""
    from annoflow.plans import parse as parse_plan

    parsed, _ = parse_plan.parse(views.raw_status_lines(spark, sf_dir), keywords=("purchase", "view"))
    rows = workflows.pretraining_text(parsed, seed=5, lang="en", min_tokens=3, drop_retweets=True, keyword_only=True)
    run = _published(spark, "pretrain", sinks.write_pretrain_text, rows.where("split = 'dev'"), rows)
    parts = [spark.read.text(f"{run}/{s}").select(F.lit(s).alias("split"), F.md5("value").alias("text_hash")) for s in ("train", "dev")]
    return parts[0].unionByName(parts[1])


@_query(f"""WITH {oracle.STATUSES}
SELECT target_id AS id, CAST(count(*) FILTER (WHERE kind = 'reply') AS BIGINT) AS num_replies,
       CAST(count(*) FILTER (WHERE kind = 'quote') AS BIGINT) AS num_quotes, CAST(count(*) FILTER (WHERE kind = 'retweet') AS BIGINT) AS num_retweets
FROM statuses WHERE kind IS NOT NULL AND target_id IS NOT NULL GROUP BY target_id""")
def written_counts(spark, sf_dir):
    """K7."""
    counts = interactions.count_interactions(interactions.interaction_log(views.statuses(spark, sf_dir)))
    run = _published(spark, "counts", sinks.write_counts, counts.where("num_quotes > 0"), counts)
    return spark.read.parquet(run)


@_query(oracle.TRANSLATION_INPUT.replace("SELECT id, text,", "SELECT id, text AS text,"))
def written_translation(spark, sf_dir):
    """K8, T9 without a limit; the run carries the content's fingerprint (P17) as its parameter."""
    from annoflow.plans import parse as parse_plan

    parsed, _ = parse_plan.parse(views.raw_status_lines(spark, sf_dir))
    rows = exports.translation_input(parsed)
    folder = shared_folder(spark, "translation")
    content = fingerprint(rows).first().asDict()
    run = sinks.publish(spark, folder, lambda path: sinks.write_translation_input(rows, path), **content)
    back = _csv(spark, run, "id string, text string, batch bigint")
    assert fingerprint(back).first().asDict() == sinks.published(spark, folder)[1] == content
    return back


@_query(f"""SELECT row_id, CAST(id AS VARCHAR) AS id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, 'say "' || text || '",' AS text
FROM ({oracle.PREDICTION_INPUT})""")
def written_prediction_input(spark, sf_dir):
    """Two outputs that are aligned by row_id; texts with quotes and commas."""
    rows = exports.prediction_input(views.statuses(spark, sf_dir), "2024-01-03 00:00:00", "2024-01-20 23:59:59")
    rows = rows.withColumn("text", F.concat(F.lit('say "'), "text", F.lit('",')))
    run = _published(spark, "prediction", exports.write_prediction_input, rows.where("row_id < 3"), rows)
    back = exports.read_prediction_input(spark, run)
    return back.select("row_id", "id", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"), "text")


# ---- files and options

@_query("""SELECT CAST(doc_id AS VARCHAR) AS id, CAST(quality AS VARCHAR) AS label_quality, CAST(toxic AS VARCHAR) AS label_my_toxic,
       CAST(0.25 AS DOUBLE) AS probability_quality FROM labels""")
def prediction_files(spark, sf_dir):
    """Prediction files of two models, one of them run twice."""
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    root = shared_folder(spark, "predictions")
    for name, label, p in (("predicted_quality_2024-01-05_ab1cd", F.lit("old"), 0.75), ("predicted_quality_2024-02-01_ef2ab", F.col("quality"), 0.25),
                           ("predicted_my_toxic_2024-01-05_ab1cd", F.col("toxic"), 0.5)):
        (lab.select(F.col("doc_id").alias("id"), label.cast("string").alias("label"), F.lit(p).alias("probability"), F.lit("").alias("labels"),
                    F.lit("").alias("probabilities")).write.option("header", True).csv(f"{root}/{name}.csv"))
    long = predictions.read_predictions(spark, [f"{root}/*.csv"])
    return predictions.wide_predictions(long).select("id", "label_quality", "label_my_toxic", "probability_quality")


@_query(f"""WITH {oracle.STATUSES}
SELECT s.id, s.kind, CAST(l.quality AS VARCHAR) AS label_quality FROM statuses s LEFT JOIN labels l ON s.id = l.doc_id
WHERE s.event_type IN ('click', 'signup')""")
def flagged_predictions(spark, sf_dir):
    """statuses with predictions, those of a flag only, no retweets."""
    st = views.statuses(spark, sf_dir).withColumns({"chosen": F.col("event_type").isin("click", "signup", "view"),
                                                    "is_retweet": F.coalesce(F.col("kind") == "retweet", F.lit(False))})
    wide = read_table(spark, sf_dir, "labels", ["doc_id", "quality"]).select(F.col("doc_id").alias("id"), F.col("quality").cast("string").alias("label_quality"))
    return predictions.attach_predictions(st, wide, flag="chosen", drop_retweets=True).select("id", "kind", "label_quality")


@_query("""SELECT CAST(doc_id AS VARCHAR) AS tweet_id, 'available' AS availability FROM documents WHERE lang IS DISTINCT FROM 'de'""")
def uploaded_available(spark, sf_dir):
    """Of all uploaded batches those that are available."""
    root = shared_folder(spark, "uploaded")
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    (docs.select(F.col("doc_id").alias("tweet_id"), F.col("text").alias("tweet_text"), F.when(F.col("lang") == "de", "unavailable").otherwise("available").alias("availability"))
     .write.option("header", True).options(**sinks.CSV).csv(f"{root}/mturk"))
    return files.checked(files.read_uploaded(spark, root, "available"), "available")


_O = "SELECT o_orderkey AS id, o_orderdate AS created_at, 'order ' || CAST(o_orderkey AS VARCHAR) || ' of @u' || CAST(o_custkey AS VARCHAR) AS text, o_orderpriority AS p FROM orders"


@_query(f"""WITH o AS ({_O} WHERE o_orderstatus <> 'P'),
f AS (SELECT id, text, strftime(created_at, '%Y-%m') AS bin, p FROM o WHERE p <> '1-URGENT'),
d AS (SELECT bin, count(*) FILTER (WHERE p = '2-HIGH') AS n_un, count(*) FILTER (WHERE p = '5-LOW' AND id % 50 = 0) AS n_us FROM f GROUP BY bin),
drawn AS (SELECT f.*, n_un, n_us FROM f JOIN d USING (bin)
          QUALIFY row_number() OVER (PARTITION BY bin ORDER BY {oracle._key(9, 'id')}, id) <= 12 + n_un)
SELECT id, bin, {oracle._anonymize('text')} AS text FROM (SELECT * FROM drawn WHERE p <> '2-HIGH' AND NOT (p = '5-LOW' AND id % 50 = 0))
QUALIFY row_number() OVER (PARTITION BY bin ORDER BY {oracle._key(9, 'id')}, id) <= greatest(12 - n_us, 0)""")
def drawn_extend_sample(spark, sf_dir):
    """A further monthly sample without replies and earlier samples; uploads shape each month's quota."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"])
    key, p = F.col("o_orderkey"), F.col("o_orderpriority")
    st = o.select(key.alias("id"), F.col("o_orderdate").alias("created_at"), (p == "1-URGENT").alias("is_reply"),
                  F.concat(F.lit("order "), key.cast("string"), F.lit(" of @u"), F.col("o_custkey").cast("string")).alias("text"), "o_orderstatus", p.alias("p"))
    ids = lambda df: df.select(F.col("id").alias("tweet_id"), F.col("text").alias("tweet_text"))
    out = workflows.draw_sample(st, seed=9, mode="monthly", include_replies=False, min_token_count=None, bin_size=12,
                                previous=ids(st.where("o_orderstatus = 'P'")), unavailable=ids(st.where("p = '2-HIGH'")),
                                available=ids(st.where("p = '5-LOW' AND id % 50 = 0")))
    return out.select("id", "bin", "text")


@_query(f"""SELECT id, text FROM ({oracle.TRANSLATION_INPUT_ALL}) ORDER BY {oracle._key(4, 'id')}, id LIMIT 150""")
def translation_sample(spark, sf_dir):
    """A seeded subsample of the rows to translate."""
    from annoflow.plans import parse as parse_plan

    parsed, _ = parse_plan.parse(views.raw_status_lines(spark, sf_dir))
    return exports.translation_rows(parsed, limit=150, seed=4, geo_only=False).select("id", "text")


@_query(f"""SELECT doc_id AS id, CAST(row_number() OVER (ORDER BY {oracle._key(6, 'doc_id')}, doc_id) - 1 AS BIGINT) AS at FROM documents""")
def shuffled(spark, sf_dir):
    """T5: documents in a seeded order, written and numbered as they come."""
    from annoflow.operators.topk import global_row_index

    docs = read_table(spark, sf_dir, "documents", ["doc_id"]).select(F.col("doc_id").alias("id"))
    ordered = sampling.shuffle(docs, 6).withColumn("_at", F.monotonically_increasing_id())
    return global_row_index(ordered, ["_at"], index_col="at").select("id", "at")


@_query("SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS same_in_any_order, true AS other_if_changed FROM documents")
def frame_fingerprint(spark, sf_dir):
    """The fingerprint of a table, of its rows dealt anew, and of a table with one changed row."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"])
    dealt = docs.repartition(7, "source", "doc_id")
    changed = docs.withColumn("lang", F.when(F.col("doc_id") == 3, "xx").otherwise(F.col("lang")))
    one, two, three = (fingerprint(d).select("n_rows", F.struct("xor_hash", "sum_hash").alias(n)) for d, n in ((docs, "a"), (dealt, "b"), (changed, "c")))
    return one.join(two, "n_rows").join(three, "n_rows").select("n_rows", (F.col("a") == F.col("b")).alias("same_in_any_order"),
                                                                (F.col("a") != F.col("c")).alias("other_if_changed"))


@_query(f"""SELECT doc_id AS id, md5(translate('“' || coalesce(text, '') || '”–’', '{T.QUOTE_FOLD_FROM}', '{T.QUOTE_FOLD_TO.replace("'", "''")}')) AS text_hash FROM documents""")
def folded_quotes(spark, sf_dir):
    """P21."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return docs.select(F.col("doc_id").alias("id"), F.md5(T.fold_quotes(F.concat(F.lit("“"), F.coalesce("text", F.lit("")), F.lit("”–’")))).alias("text_hash"))


_FIGURES = ("n_sampled", "n_unavailable", "n_batched", "n_labelled", "n_left", "n_left_incl_labelled", "pct_labelled")


def _unpivot(report: str, sql: str, columns, label: str = "") -> str:
    return " UNION ALL ".join(f"SELECT '{report}' AS report, {label}'{c}' AS item, CAST({c} AS DOUBLE) AS value FROM ({sql})" for c in columns)


@_query(" UNION ALL ".join([
    f"SELECT 'overview' AS report, stage AS item, CAST(n AS DOUBLE) AS value FROM ({oracle.STAGE_OVERVIEW})",
    """SELECT 'raw_files', 'streaming.n_files', CAST(count(DISTINCT strftime(ts, '%Y-%m-%d')) AS DOUBLE) FROM events""",
    """SELECT 'raw_files', 'historic.n_files', CAST(1 AS DOUBLE)""",
    _unpivot("sample", oracle.SAMPLE_STATS, _FIGURES),
    f"SELECT 'annotation', question_tag || '=' || label_tag, CAST(n AS DOUBLE) FROM ({oracle.LABEL_SHARE})",
    _unpivot("outliers", oracle.OUTLIER_SUMMARY, ("n_annotators", "n_outlier", "n_no_outlier", "n_not_considered", "pct_outlier", "mean_value", "median_value",
                                                  "min_value", "max_value"), "criterion || '.' || "),
    _unpivot("cleaned", oracle.CLEANED_SUMMARY, ("n_labels", "n_tweets"))]))
def full_report(spark, sf_dir):
    """All reports in one table; raw files of both kinds."""
    from annoflow.operators import agreement, annotator_stats

    root = shared_folder(spark, "kinds")
    lines = views.raw_status_lines(spark, sf_dir)
    days = [r[0] for r in lines.select(F.col("day").cast("string")).distinct().collect()]
    # One small file a day by the name of the stream; the listing counts files, whatever they hold.
    for d in days:
        _broken_file(spark, f"{root}/stream/tweets-{d.replace('-', '')}000000-0.jsonl")
    _broken_file(spark, f"{root}/history/collected-2023-1-1-0-0-0-x.gz")
    ann, cleaned = views.annotations(spark, sf_dir), views.cleaned_labels(spark, sf_dir)
    sampled, unavailable, labelled, batched = views.sample_tables(spark, sf_dir)
    outliers = agreement.worker_outliers(ann, min_tasks=3, time_cutoff=3, agreement_cutoff=3, min_comparisons_count=20)
    shares = annotator_stats.label_share(cleaned).select(F.concat_ws("=", "question_tag", "label_tag").alias("item"), F.col("n").alias("value"))
    out = reports.full_report(
        overview=reports.stage_overview(lines, views.statuses(spark, sf_dir), sampled, ann, cleaned), files=raw.list_files(spark, root),
        sample=sampling.sample_stats(sampled, unavailable, labelled, batched), annotation=shares,
        outliers=reports.outlier_summary(outliers), cleaned=annotator_stats.cleaned_summary(cleaned))
    return out.where(~F.col("item").endswith("n_bytes"))


@_query(f"""WITH p AS ({oracle.PARSE_STATUSES}), cols AS (SELECT id, is_retweet, has_quote, text FROM p),
kw AS (SELECT * FROM cols WHERE NOT is_retweet AND has_quote),
steps AS (SELECT 0 AS o, 'start' AS step, count(*) AS n_rows FROM cols
UNION ALL SELECT 1, 'drop_retweets', count(*) FROM cols WHERE NOT is_retweet
UNION ALL SELECT 2, 'contains_keywords', count(*) FROM kw
UNION ALL SELECT 3, 'lang', count(*) FROM kw
UNION ALL SELECT 4, 'min_tokens', count(*) FROM kw
UNION ALL SELECT 5, 'drop_duplicates', (SELECT count(*) FROM ({oracle.PRETRAIN_TEXT})))
SELECT step, n_rows, round(100.0 * (lag(n_rows) OVER (ORDER BY o) - n_rows) / nullif(lag(n_rows) OVER (ORDER BY o), 0), 9) AS pct_removed FROM steps""")
def pretrain_steps(spark, sf_dir):
    """A27 for the pre-training chain: one run of the chain gives its texts and the figures."""
    from annoflow.operators.steps import Steps
    from annoflow.plans import parse as parse_plan

    parsed, _ = parse_plan.parse(views.raw_status_lines(spark, sf_dir), keywords=("purchase",))
    steps = Steps()
    workflows.pretraining_text(parsed, seed=5, lang="en", min_tokens=3, drop_retweets=True, keyword_only=True, steps=steps)
    return steps.report(spark)
