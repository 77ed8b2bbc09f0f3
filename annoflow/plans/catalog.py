"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from annoflow.functions import text as T
from annoflow.operators import agreement, annotator_stats, consensus
from annoflow.plans import oracle, views

QueryFn = Callable[[SparkSession, str], DataFrame]

ROW_COLS = ["id", "tweet_id", "question_tag", "answer_tag", "annotator_id", "flag"]


def label_majority(spark, sf_dir):
    return consensus.clean_labels(views.annotations(spark, sf_dir), "majority", 3)


def label_unanimous(spark, sf_dir):
    return consensus.clean_labels(views.annotations(spark, sf_dir), "unanimous", 3)


def label_agreement_gt(spark, sf_dir):
    return consensus.clean_labels(views.annotations(spark, sf_dir), min_labels_cutoff=2,
                                  selection_agreement=0.6)


def exclude_incorrect(spark, sf_dir):
    return consensus.exclude_incorrect_rows(views.annotations(spark, sf_dir)).select(*ROW_COLS)


def label_cutoff(spark, sf_dir):
    return consensus.min_labels_rows(views.annotations(spark, sf_dir), 3).select(*ROW_COLS)


def is_relevant(spark, sf_dir):
    return consensus.relevant_rows(views.annotations(spark, sf_dir), ("A",)).select(*ROW_COLS)


def annotator_agreement(spark, sf_dir):
    ann = consensus.drop_incomplete(views.annotations(spark, sf_dir))
    ag = agreement.annotator_agreement(ann)
    return ag.withColumn("agreement_ratio", F.round("agreement_ratio", 9))


def annotator_outliers(spark, sf_dir):
    out = agreement.worker_outliers(views.annotations(spark, sf_dir), min_tasks=3,
                                    time_cutoff=3, agreement_cutoff=3, min_comparisons_count=20)
    for c in ("time_values", "time_zscores", "agreement_values", "agreement_zscores"):
        out = out.withColumn(c, F.round(c, 9))
    return out


def fleiss_kappa(spark, sf_dir):
    return agreement.fleiss_kappa(views.annotations(spark, sf_dir), by=("mode",), min_annotations=20)


def qs_histogram(spark, sf_dir):
    return annotator_stats.results_per_qs_histogram(views.annotations(spark, sf_dir))


def workers_per_tweet(spark, sf_dir):
    return annotator_stats.workers_per_tweet_histogram(views.annotations(spark, sf_dir))


def time_per_worker(spark, sf_dir):
    return annotator_stats.per_worker(views.annotations(spark, sf_dir))


def time_per_qs(spark, sf_dir):
    return annotator_stats.time_per_qs_summary(views.annotations(spark, sf_dir))


def fastest_workers(spark, sf_dir):
    return annotator_stats.smallest(annotator_stats.per_worker(views.annotations(spark, sf_dir)), "mean_time", 10)


def time_histogram(spark, sf_dir):
    return annotator_stats.binned_histogram(
        annotator_stats.qs_first_times(views.annotations(spark, sf_dir)), "total_time", 5.0)


def label_share(spark, sf_dir):
    return annotator_stats.label_share(views.cleaned_labels(spark, sf_dir))


def cleaned_summary(spark, sf_dir):
    return annotator_stats.cleaned_summary(views.cleaned_labels(spark, sf_dir))


def normalize_text(spark, sf_dir):
    docs = views.texts(spark, sf_dir)
    return docs.select("id", T.normalize_str("raw_text").alias("text"))


def text_hash(spark, sf_dir):
    docs = views.texts(spark, sf_dir)
    return docs.select("id", T.text_hash(T.normalize_str("raw_text")).alias("text_hash"))


def anonymize_text(spark, sf_dir):
    return views.texts(spark, sf_dir).select("id", T.anonymize_text("text").alias("text"))


def text_cleared(spark, sf_dir):
    return views.texts(spark, sf_dir).select("id", T.text_cleared("text").alias("text_cleared"))


def token_count(spark, sf_dir):
    docs = views.texts(spark, sf_dir).select("id", T.normalize_str("raw_text").alias("text"))
    return T.with_token_count(docs, "text").select("id", "token_count")


KEYWORDS = oracle.KEYWORDS


def contains_keywords(spark, sf_dir):
    t = views.texts(spark, sf_dir)
    return t.select("id", T.contains_keywords("text", "mentions", "url", KEYWORDS).alias("contains_keywords"))


QUERIES: dict[str, QueryFn] = {
    "label_majority": label_majority,
    "label_unanimous": label_unanimous,
    "label_agreement_gt": label_agreement_gt,
    "exclude_incorrect": exclude_incorrect,
    "label_cutoff": label_cutoff,
    "is_relevant": is_relevant,
    "annotator_agreement": annotator_agreement,
    "annotator_outliers": annotator_outliers,
    "fleiss_kappa": fleiss_kappa,
    "qs_histogram": qs_histogram,
    "workers_per_tweet": workers_per_tweet,
    "time_per_worker": time_per_worker,
    "time_per_qs": time_per_qs,
    "fastest_workers": fastest_workers,
    "time_histogram": time_histogram,
    "label_share": label_share,
    "cleaned_summary": cleaned_summary,
    "normalize_text": normalize_text,
    "text_hash": text_hash,
    "anonymize_text": anonymize_text,
    "text_cleared": text_cleared,
    "token_count": token_count,
    "contains_keywords": contains_keywords,
}

ORACLE_SQL: dict[str, str] = {
    "label_majority": oracle.LABEL_MAJORITY,
    "label_unanimous": oracle.LABEL_UNANIMOUS,
    "label_agreement_gt": oracle.LABEL_AGREEMENT_GT,
    "exclude_incorrect": oracle.EXCLUDE_INCORRECT_ROWS,
    "label_cutoff": oracle.LABEL_CUTOFF_ROWS,
    "is_relevant": oracle.IS_RELEVANT_ROWS,
    "annotator_agreement": oracle.ANNOTATOR_AGREEMENT,
    "annotator_outliers": oracle.ANNOTATOR_OUTLIERS,
    "fleiss_kappa": oracle.FLEISS_KAPPA,
    "qs_histogram": oracle.QS_HISTOGRAM,
    "workers_per_tweet": oracle.WORKERS_PER_TWEET,
    "time_per_worker": oracle.TIME_PER_WORKER,
    "time_per_qs": oracle.TIME_PER_QS,
    "fastest_workers": oracle.FASTEST_WORKERS,
    "time_histogram": oracle.TIME_HISTOGRAM,
    "label_share": oracle.LABEL_SHARE,
    "cleaned_summary": oracle.CLEANED_SUMMARY,
    "normalize_text": oracle.NORMALIZE_TEXT,
    "text_hash": oracle.TEXT_HASH,
    "anonymize_text": oracle.ANONYMIZE_TEXT,
    "text_cleared": oracle.TEXT_CLEARED,
    "token_count": oracle.TOKEN_COUNT,
    "contains_keywords": oracle.CONTAINS_KEYWORDS,
}


# ---- interactions, dedup, sampling, splits

from annoflow.operators import interactions, sampling, splits  # noqa: E402

COUNT_COLS = ["num_quotes", "num_replies", "num_retweets"]


def interaction_counts(spark, sf_dir):
    return interactions.count_interactions(interactions.interaction_log(views.statuses(spark, sf_dir)))


def parsed_with_counts(spark, sf_dir):
    st = views.statuses(spark, sf_dir)
    counts = interactions.count_interactions(interactions.interaction_log(st))
    return interactions.attach_counts(st.select("id", "created_at", "kind"), counts)


def extend_merge(spark, sf_dir):
    st = views.statuses(spark, sf_dir).select("id", "created_at", "kind", "target_id")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    overlap = F.lit("2024-01-10").cast("timestamp_ntz")
    old = st.where(F.col("created_at") < cut)
    new = st.where(F.col("created_at") >= overlap)
    existing = interactions.attach_counts(old.select("id", "created_at"),
                                          interactions.count_interactions(interactions.interaction_log(old)))
    return interactions.extend_merge(existing, new.select("id", "created_at"),
                                     interactions.interaction_log(old), interactions.interaction_log(new))


def dedup_by_id(spark, sf_dir):
    rows = views.embedded_copies(spark, sf_dir)
    return interactions.dedup_by_id(rows, ("priority", "seen_at", "source_id"))


def _sample_input(spark, sf_dir):
    t = views.texts(spark, sf_dir)
    t = T.with_token_count(t.withColumn("_norm", T.normalize_str("raw_text")), "_norm").drop("_norm")
    t = sampling.filter_statuses(t, min_token_count=3, include_replies=True, langs=["en", "fr"]).select("id", "text")
    return sampling.dedup_keep_first(t, T.sample_dedup_key("text"), ["id"])


def random_sample(spark, sf_dir):
    s = sampling.random_sample(_sample_input(spark, sf_dir), 100, seed=42, strict=False)
    return s.select("id", T.anonymize_text("text").alias("text"))


def monthly_sample(spark, sf_dir):
    s = sampling.binned_sample(views.order_statuses(spark, sf_dir), seed=7, size=800, period="months")
    return s.select("id", "bin")


def next_batch(spark, sf_dir):
    sampled, unavailable, labelled, batched = views.sample_tables(spark, sf_dir)
    b = sampling.next_batch(sampled, 25, unavailable=unavailable, labelled=labelled, batched=batched)
    return b.select("tweet_id", "tweet_text", "sample_pos", "batch_id")


def sample_stats(spark, sf_dir):
    sampled, unavailable, labelled, batched = views.sample_tables(spark, sf_dir)
    return sampling.sample_stats(sampled, unavailable, labelled, batched)


def sample_distribution(spark, sf_dir):
    corpus = views.order_statuses(spark, sf_dir)
    sample = sampling.binned_sample(corpus, seed=7, size=800, period="months")
    return sampling.sample_distribution(corpus, sample)


def train_dev_test_split(spark, sf_dir):
    df = splits.cleaned_for_question(views.cleaned_labels(spark, sf_dir))
    out = splits.train_dev_test_split(df, seed=42, dev_size=0.2, test_size=0.2)
    return out.select("id", "question_tag", "label", "split")


def balanced_split(spark, sf_dir):
    df = splits.cleaned_for_question(views.cleaned_labels(spark, sf_dir))
    out = splits.train_dev_test_split(df, seed=42, dev_size=0.2, test_size=0.2, balanced=True)
    return out.select("id", "question_tag", "label", "split")


def pretrain_split(spark, sf_dir):
    t = views.texts(spark, sf_dir).where(F.col("lang") == "en")
    t = T.with_token_count(t.withColumn("_norm", T.normalize_str("raw_text")), "_norm").drop("_norm")
    t = t.where(F.col("token_count") >= 3).select("id", "text")
    t = sampling.dedup_keep_first(t, T.text_cleared("text"), ["id"])
    return splits.pretrain_split(t.select("id"), seed=42).select("id", "split")


def has_label_filter(spark, sf_dir):
    out = splits.has_label_filter(views.cleaned_labels(spark, sf_dir), "1,0")
    return out.select("id", "question_tag", "label_tag")


QUERIES.update({
    "interaction_counts": interaction_counts,
    "parsed_with_counts": parsed_with_counts,
    "extend_merge": extend_merge,
    "dedup_by_id": dedup_by_id,
    "random_sample": random_sample,
    "monthly_sample": monthly_sample,
    "next_batch": next_batch,
    "sample_stats": sample_stats,
    "sample_distribution": sample_distribution,
    "train_dev_test_split": train_dev_test_split,
    "balanced_split": balanced_split,
    "pretrain_split": pretrain_split,
    "has_label_filter": has_label_filter,
})

ORACLE_SQL.update({
    "interaction_counts": oracle.INTERACTION_COUNTS,
    "parsed_with_counts": oracle.PARSED_WITH_COUNTS,
    "extend_merge": oracle.EXTEND_MERGE,
    "dedup_by_id": oracle.DEDUP_BY_ID,
    "random_sample": oracle.RANDOM_SAMPLE,
    "monthly_sample": oracle.MONTHLY_SAMPLE,
    "next_batch": oracle.NEXT_BATCH,
    "sample_stats": oracle.SAMPLE_STATS,
    "sample_distribution": oracle.SAMPLE_DISTRIBUTION,
    "train_dev_test_split": oracle.TRAIN_DEV_TEST_SPLIT,
    "balanced_split": oracle.BALANCED_SPLIT,
    "pretrain_split": oracle.PRETRAIN_SPLIT,
    "has_label_filter": oracle.HAS_LABEL_FILTER,
})


# ---- raw parsing (C1) and geo enrichment

from annoflow.plans import parse as parse_plan  # noqa: E402

PARSE_COLS = ["id", "text", "is_retweet", "has_quote", "is_reply", "retweeted_status_id", "quoted_status_id",
              "in_reply_to_status_id", "user_id", "user_description", "user_is_verified", "token_count",
              "num_replies", "num_quotes", "num_retweets"]


def parse_statuses(spark, sf_dir):
    parsed, _bad = parse_plan.parse(views.raw_status_lines(spark, sf_dir))
    return parsed.select(*PARSE_COLS, F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
                         F.col("created_day").cast("string").alias("created_day"))


def geo_enrich(spark, sf_dir):
    parsed, _bad = parse_plan.parse(views.raw_status_lines(spark, sf_dir),
                                    countries=views.countries(spark, sf_dir),
                                    gazetteer=views.gazetteer(spark, sf_dir))
    return parsed.select("id", "geo_type", F.round("longitude", 6).alias("longitude"),
                         F.round("latitude", 6).alias("latitude"), "country_code", "geoname_id",
                         "location_type", "region", "subregion")


QUERIES.update({"parse_statuses": parse_statuses, "geo_enrich": geo_enrich})
ORACLE_SQL.update({"parse_statuses": oracle.PARSE_STATUSES, "geo_enrich": oracle.GEO_ENRICH})


# ---- reading windows, region lookup, privacy, predictions, overview

from annoflow.functions import privacy  # noqa: E402
from annoflow.operators import geo, predictions  # noqa: E402
from annoflow.sources import parsed as parsed_src  # noqa: E402

# a fixed 16-byte key for the round-trip check (real keys come from the caller)
DEMO_KEY = "0123456789abcdef"


def date_window_scan(spark, sf_dir):
    st = views.statuses(spark, sf_dir).withColumn("created_day", F.to_date("created_at"))
    return parsed_src.date_window(st, "2024-01-05", "2024-01-12").select("id", "created_at", "kind")


def omit_last_day(spark, sf_dir):
    return parsed_src.omit_last_day(views.statuses(spark, sf_dir)).select("id", "created_at")


def region_lookup(spark, sf_dir):
    from annoflow.sources.tables import read_table
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    coded = cust.select("c_custkey", F.concat(F.lit("N"), F.char(F.lit(65) + F.col("c_nationkey")))
                        .alias("country_code"))
    return geo.region_lookup(coded, views.countries(spark, sf_dir)).select(
        "c_custkey", "country_code", "region", "subregion")


def encrypt_roundtrip(spark, sf_dir):
    from annoflow.sources.tables import read_table
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    df = cust.select("c_custkey", F.col("c_custkey").alias("key_enc"), F.col("c_name").alias("name_enc"),
                     F.array("c_mktsegment", F.lit(None).cast("string"), "c_name").alias("list_enc"))
    spec = {"key_enc": "id", "name_enc": "str", "list_enc": "list"}
    keys_at = _scratch(spark, "keys")
    spark.createDataFrame([("ids", bytearray(DEMO_KEY.encode()))], "name string, key binary").write.parquet(keys_at)
    key = privacy.key_from_table(spark, keys_at, "ids")
    enc = privacy.encrypt_columns(df, spec, key)
    dec = privacy.decrypt_columns(enc, spec, key)
    dec = dec.select("c_custkey", F.col("key_enc").cast("bigint").alias("key_dec"), F.col("name_enc").alias("name_dec"),
                     F.array_join("list_enc", "|").alias("list_dec"))
    # equal ids must still join, and nothing may show through
    keys = cust.select(privacy.encrypt_value(F.col("c_custkey"), key).alias("key_enc"), "c_name")
    hidden = (enc.join(keys, "key_enc").select(
        "key_enc", F.col("c_custkey").alias("_id"), ((F.col("name_enc") != F.col("c_name"))
                   & (F.col("key_enc") != F.col("c_custkey").cast("string"))).alias("hidden")))
    return dec.join(hidden, dec["c_custkey"] == hidden["_id"]).drop("_id", "key_enc")


def _long_predictions(spark, sf_dir):
    from annoflow.sources.tables import read_table
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    prob = (F.lit(0.5) + (F.col("doc_id") % 50) / 100.0)
    return lab.select(F.col("doc_id").alias("id"), F.expr(
        "stack(2, 'quality', cast(quality as string), 'toxic', cast(toxic as string)) as (model, label)"),
        prob.alias("probability"))


def prediction_join(spark, sf_dir):
    wide = predictions.wide_predictions(_long_predictions(spark, sf_dir), ["quality", "toxic"])
    t = views.texts(spark, sf_dir).select("id", "lang")
    return predictions.attach_predictions(t, wide).select(
        "id", "lang", "label_quality", F.round("probability_quality", 6).alias("probability_quality"),
        "label_toxic", F.round("probability_toxic", 6).alias("probability_toxic"))


def membership_flags(spark, sf_dir):
    sampled, unavailable, labelled, batched = views.sample_tables(spark, sf_dir)
    cleaned = views.cleaned_labels(spark, sf_dir).select("id")
    t = views.texts(spark, sf_dir).select("id")
    return predictions.membership_flags(t, uploaded=batched, labelled=labelled, cleaned=cleaned)


def stage_overview(spark, sf_dir):
    from annoflow.operators import reports
    return reports.stage_overview(
        raw_lines=views.raw_status_lines(spark, sf_dir).select("value"),
        parsed=views.statuses(spark, sf_dir),
        sampled=views.sample_tables(spark, sf_dir)[0],
        annotations=views.annotations(spark, sf_dir),
        cleaned=views.cleaned_labels(spark, sf_dir))


QUERIES.update({
    "date_window_scan": date_window_scan,
    "omit_last_day": omit_last_day,
    "region_lookup": region_lookup,
    "encrypt_roundtrip": encrypt_roundtrip,
    "prediction_join": prediction_join,
    "membership_flags": membership_flags,
    "stage_overview": stage_overview,
})
ORACLE_SQL.update({
    "date_window_scan": oracle.DATE_WINDOW_SCAN,
    "omit_last_day": oracle.OMIT_LAST_DAY,
    "region_lookup": oracle.REGION_LOOKUP,
    "encrypt_roundtrip": oracle.ENCRYPT_ROUNDTRIP,
    "prediction_join": oracle.PREDICTION_JOIN,
    "membership_flags": oracle.MEMBERSHIP_FLAGS,
    "stage_overview": oracle.STAGE_OVERVIEW,
})


# ---- cleaning metrics, outlier report, media, mentions, exports

from annoflow.functions import status as S  # noqa: E402
from annoflow.operators import reports  # noqa: E402
from annoflow.plans import exports  # noqa: E402
from annoflow.sources.raw import parse_lines  # noqa: E402


def clean_steps(spark, sf_dir):
    keyword_ids = views.statuses(spark, sf_dir).where(F.col("kind").isNotNull()).select("id")
    return consensus.cleaning_steps(views.annotations(spark, sf_dir), min_labels_cutoff=3, is_relevant=True,
                                    relevant_tags=("A",), exclude_incorrect=True, keyword_ids=keyword_ids)


def clean_labels_full(spark, sf_dir):
    ann = views.annotations(spark, sf_dir)
    keyword_ids = views.statuses(spark, sf_dir).where(F.col("kind").isNotNull()).select("id")
    return consensus.clean_labels(ann, "majority", 3, is_relevant=True, relevant_tags=("A",),
                                  exclude_incorrect=True, keyword_ids=keyword_ids, cutoff_worker_outliers=2.0)


def _outliers(spark, sf_dir):
    return agreement.worker_outliers(views.annotations(spark, sf_dir), min_tasks=3, time_cutoff=3,
                                     agreement_cutoff=3, min_comparisons_count=20)


def outlier_summary(spark, sf_dir):
    return reports.outlier_summary(_outliers(spark, sf_dir))


def outlier_list(spark, sf_dir):
    out = reports.outlier_list(_outliers(spark, sf_dir))
    return out.withColumns({c: F.round(c, 9) for c in ("value", "zscore")})


def outliers_in_both(spark, sf_dir):
    return reports.outliers_in_both(_outliers(spark, sf_dir))


def media_info(spark, sf_dir):
    ok, _ = parse_lines(views.raw_status_lines(spark, sf_dir))
    m = S.media_info(F.col("raw"))
    return ok.select(F.col("raw.id_str").alias("id"), m["has_media"].alias("has_media"),
                     F.coalesce(m["media"]["photo"], F.lit(0)).alias("n_photo"),
                     F.coalesce(m["media"]["video"], F.lit(0)).alias("n_video"),
                     F.array_join(m["media_image_urls"], " ").alias("image_urls"))


def replace_mentions(spark, sf_dir):
    ok, _ = parse_lines(views.raw_status_lines(spark, sf_dir))
    raw = F.col("raw")
    return ok.select(F.col("raw.id_str").alias("id"),
                     S.replace_user_mentions(raw["text"], S.mentions_for(raw)).alias("text"))


def prediction_input(spark, sf_dir):
    rows = exports.prediction_input(views.statuses(spark, sf_dir), "2024-01-03 00:00:00", "2024-01-20 23:59:59")
    return rows.select("row_id", "id", "created_at", "text")


def _translation_rows(spark, sf_dir):
    parsed, _ = parse_plan.parse(views.raw_status_lines(spark, sf_dir))
    return exports.translation_input(parsed)


def translation_input(spark, sf_dir):
    return _translation_rows(spark, sf_dir).select("id", "text", "batch")


def translation_input_all(spark, sf_dir):
    parsed, _ = parse_plan.parse(views.raw_status_lines(spark, sf_dir))
    return exports.translation_input(parsed, geo_only=False).select("id", "text", "batch")


def translation_cost(spark, sf_dir):
    parsed, _ = parse_plan.parse(views.raw_status_lines(spark, sf_dir))
    return exports.translation_cost(exports.translation_rows(parsed))


QUERIES.update({
    "clean_steps": clean_steps,
    "clean_labels_full": clean_labels_full,
    "outlier_summary": outlier_summary,
    "outlier_list": outlier_list,
    "outliers_in_both": outliers_in_both,
    "media_info": media_info,
    "replace_mentions": replace_mentions,
    "prediction_input": prediction_input,
    "translation_input": translation_input,
    "translation_input_all": translation_input_all,
    "translation_cost": translation_cost,
})
ORACLE_SQL.update({
    "clean_steps": oracle.CLEAN_STEPS,
    "clean_labels_full": oracle.CLEAN_LABELS_FULL,
    "outlier_summary": oracle.OUTLIER_SUMMARY,
    "outlier_list": oracle.OUTLIER_LIST,
    "outliers_in_both": oracle.OUTLIERS_IN_BOTH,
    "media_info": oracle.MEDIA_INFO,
    "replace_mentions": oracle.REPLACE_MENTIONS,
    "prediction_input": oracle.PREDICTION_INPUT,
    "translation_input": oracle.TRANSLATION_INPUT,
    "translation_input_all": oracle.TRANSLATION_INPUT_ALL,
    "translation_cost": oracle.TRANSLATION_COST,
})


# ---- incremental ingest with Structured Streaming

def _ingested(spark, sf_dir, periods):
    """Raw lines written as files of three collection periods, streamed and merged one period after the
    other in the given order; the store must equal the batch parse."""
    from annoflow.session import FILE_ROWS, Scratch, shared_folder
    from annoflow.streaming import ingest

    root = shared_folder(spark, "stream")
    period = F.when(F.dayofmonth("day") <= 10, 1).when(F.dayofmonth("day") <= 20, 2).otherwise(3)
    with Scratch(spark):
        # a compressed file is read by one task, so none has many lines
        (views.raw_status_lines(spark, sf_dir).select("value", period.alias("period"))
         .write.partitionBy("period").option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS).text(f"{root}/raw"))
    for n in periods:
        ingest.start_ingest(spark, f"{root}/raw/period={n}", f"{root}/store", f"{root}/stream-{n}", span=1 << 20).awaitTermination()
    parsed = ingest.read_store(spark, f"{root}/store")
    return parsed.select(*PARSE_COLS, F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
                         F.col("created_day").cast("string").alias("created_day"))


def stream_ingest(spark, sf_dir):
    return _ingested(spark, sf_dir, (1, 2, 3))


def stream_ingest_out_of_order(spark, sf_dir):
    return _ingested(spark, sf_dir, (3, 1, 2))


QUERIES.update({"stream_ingest": stream_ingest, "stream_ingest_out_of_order": stream_ingest_out_of_order})
ORACLE_SQL.update({"stream_ingest": oracle.PARSE_STATUSES, "stream_ingest_out_of_order": oracle.PARSE_STATUSES})


# ---- composite jobs on parsed statuses

from annoflow.plans import workflows  # noqa: E402

PRETRAIN_KEYWORDS = ("purchase", "view")


def pretrain_text(spark, sf_dir):
    parsed, _ = parse_plan.parse(views.raw_status_lines(spark, sf_dir), keywords=PRETRAIN_KEYWORDS)
    out = workflows.pretraining_text(parsed, seed=5, lang="en", min_tokens=3, drop_retweets=True,
                                     keyword_only=True)
    return out.select("id", "text", "split")


def class_counts(spark, sf_dir):
    df = splits.cleaned_for_question(views.cleaned_labels(spark, sf_dir))
    return splits.class_counts(df)


QUERIES.update({"pretrain_text": pretrain_text, "class_counts": class_counts})
ORACLE_SQL.update({"pretrain_text": oracle.PRETRAIN_TEXT, "class_counts": oracle.CLASS_COUNTS})


# ---- options of earlier operators: previous samples, one question, closed gates, the all-data view

def extend_sample(spark, sf_dir):
    """A new sample without the previous one, by id and by text."""
    rows = _sample_input(spark, sf_dir)
    first = sampling.random_sample(rows, 100, seed=42, strict=False)
    rest = sampling.exclude_previous(rows, first.select(F.col("id").alias("tweet_id"), F.col("text").alias("tweet_text")))
    return sampling.random_sample(rest, 100, seed=43, strict=False).select("id")


def question_labels(spark, sf_dir):
    """S11 + F9: one question, statuses that carry either label."""
    rows = splits.cleaned_for_question(views.cleaned_labels(spark, sf_dir), "quality", has_label="1|2")
    return rows.select("id", "question_tag", "label")


def question_split(spark, sf_dir):
    """T6 + F11: one question by id, two of its labels."""
    rows = splits.cleaned_for_question(views.cleaned_labels(spark, sf_dir), 1, return_label_ids=True)
    return splits.train_dev_test_split(rows, seed=8, dev_size=0.1, test_size=0.3, label_tags=(0, 1)).select("id", "label", "split")


def gated_statuses(spark, sf_dir):
    """retweets and quotes not extracted."""
    parsed, _ = parse_plan.parse(views.raw_status_lines(spark, sf_dir), extract_retweets=False, extract_quotes=False)
    return parsed.select("id", "text", "is_reply")


def mention_ids(spark, sf_dir):
    """Ids of the mentioned users."""
    parsed, _ = parse_plan.parse(views.raw_status_lines(spark, sf_dir))
    return parsed.select("id", F.array_join("entities_user_mentions", ",").alias("mentioned"))


def all_data(spark, sf_dir):
    """Statuses with predictions and flags in an inclusive window."""
    st = views.statuses(spark, sf_dir).select("id", "created_at", "kind")
    wide = predictions.wide_predictions(_long_predictions(spark, sf_dir), ["quality", "toxic"])
    _, _, labelled, batched = views.sample_tables(spark, sf_dir)
    out = predictions.all_data(st, wide.select("id", "label_quality"), "2024-01-03 00:00:00", "2024-01-20 23:59:59",
                               uploaded=batched, labelled=labelled, usecols=("id", "created_at", "kind"))
    return out.select("id", "kind", "label_quality", "S", "L")


QUERIES.update({"extend_sample": extend_sample, "question_labels": question_labels, "question_split": question_split,
                "gated_statuses": gated_statuses, "mention_ids": mention_ids, "all_data": all_data})
ORACLE_SQL.update({"extend_sample": oracle.EXTEND_SAMPLE, "question_labels": oracle.QUESTION_LABELS,
                   "question_split": oracle.QUESTION_SPLIT, "gated_statuses": oracle.GATED_STATUSES,
                   "mention_ids": oracle.MENTION_IDS, "all_data": oracle.ALL_DATA})


# ---- stored tables and files, written from the tables and read back

from annoflow import sinks  # noqa: E402
from annoflow.sources import files  # noqa: E402
from annoflow.sources.tables import read_table  # noqa: E402


def _scratch(spark, name):
    """A new folder in the shared checkpoint folder."""
    import os
    import uuid

    from annoflow.session import ensure_checkpoint_dir
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def write_read_parsed(spark, sf_dir):
    root = _scratch(spark, "parsed")
    parsed, _bad = parse_plan.parse(views.raw_status_lines(spark, sf_dir))
    parse_plan.write_parsed(parsed, root)
    out = parsed_src.read_parsed(spark, root, "2024-01-05", "2024-01-12", usecols=["id", "text", "created_at", "created_day"])
    return out.select("id", "text", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
                      F.col("created_day").cast("string").alias("created_day"))


def annotation_files(spark, sf_dir):
    root = _scratch(spark, "annotations")
    ann = views.annotations(spark, sf_dir)
    shared = ["id", "tweet_id", "text", "question_id", "question_tag", "answer_id", "answer_tag", "flag", "full_log"]
    for mode, who in (("local", "user_id"), ("mturk", "worker_id")):  # the modes name annotators differently
        (ann.where(F.col("mode") == mode).select(*shared, F.col("annotator_id").alias(who))
         .write.option("header", True).options(**sinks.CSV).csv(f"{root}/{mode}"))
    return files.read_annotations(spark, root).select(
        "id", "tweet_id", "question_tag", "answer_tag", "annotator_id", "flag", "mode", "total_time")


def sample_files(spark, sf_dir):
    root = _scratch(spark, "samples")
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    docs.write.options(**sinks.CSV).csv(f"{root}/sampled_random_1.csv")
    return files.read_sampled(spark, root).select("tweet_id", F.md5(F.coalesce("tweet_text", F.lit(""))).alias("text_hash"))


def batch_files(spark, sf_dir):
    root = _scratch(spark, "batches")
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    for n in (1, 2, 3):
        (docs.where(F.col("doc_id") % 3 == n - 1).select("doc_id", "text")
         .write.options(**sinks.CSV).csv(f"{root}/batch_{n}/batch_{n}_1.csv"))
    return files.read_batches(spark, root).select("tweet_id", "batch_id", F.md5(F.coalesce("tweet_text", F.lit(""))).alias("text_hash"))


def uploaded_files(spark, sf_dir):
    root = _scratch(spark, "uploaded")
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    (docs.select(F.col("doc_id").alias("tweet_id"), F.col("text").alias("tweet_text"),
                 F.when(F.col("lang") == "de", "unavailable").otherwise("available").alias("availability"))
     .write.option("header", True).options(**sinks.CSV).csv(f"{root}/mturk"))
    uploaded = files.read_uploaded(spark, root)
    return files.checked(uploaded, df=uploaded.select("tweet_id", "mode"))


QUERIES.update({"write_read_parsed": write_read_parsed, "annotation_files": annotation_files, "sample_files": sample_files,
                "batch_files": batch_files, "uploaded_files": uploaded_files})
ORACLE_SQL.update({"write_read_parsed": oracle.WRITE_READ_PARSED, "annotation_files": oracle.ANNOTATION_FILES,
                   "sample_files": oracle.SAMPLE_FILES, "batch_files": oracle.BATCH_FILES,
                   "uploaded_files": oracle.UPLOADED_FILES})


# ---- operators on stored data

from annoflow.plans import stored  # noqa: E402

QUERIES.update(stored.QUERIES)
ORACLE_SQL.update(stored.ORACLE_SQL)
