"""Descriptive annotation statistics.

Every statistic is a grouped aggregate; the tables behind the reference's
plots are returned as DataFrames (drawing is left to the caller).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annoflow.operators.agreement import question_sequences


def counter_histogram(df: DataFrame, value: str, value_alias: str, count_alias: str) -> DataFrame:
    """Frequency table of an integer column (A18, counter form)."""
    return df.groupBy(F.col(value).alias(value_alias)).agg(F.count("*").alias(count_alias))


def binned_histogram(df: DataFrame, value: str, width: float, origin: float = 0.0) -> DataFrame:
    """Fixed-width histogram of a numeric column (A18, binned form)."""
    b = F.floor((F.col(value) - F.lit(origin)) / F.lit(width)).cast("bigint")
    return (df.where(F.col(value).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count("*").alias("n"))
            .withColumn("lower", F.lit(origin) + F.col("bin") * F.lit(width)))


def results_per_qs_histogram(ann: DataFrame) -> DataFrame:
    """How many question sequences have k results."""
    return counter_histogram(question_sequences(ann), "results_count", "results_count", "n_qs")


def workers_per_tweet_histogram(ann: DataFrame) -> DataFrame:
    """Distinct annotators (= question sequences) per tweet, as a frequency table."""
    per_tweet = question_sequences(ann).groupBy("tweet_id").agg(F.count("*").alias("n_workers"))
    return counter_histogram(per_tweet, "n_workers", "n_workers", "n_tweets")


def qs_first_times(ann: DataFrame) -> DataFrame:
    """A12 input: first non-null total_time of every (annotator, tweet)."""
    return (ann.where(F.col("annotator_id").isNotNull() & F.col("tweet_id").isNotNull()
                      & F.col("total_time").isNotNull())
            .groupBy("annotator_id", "tweet_id")
            .agg(F.min_by("total_time", "seq").alias("total_time")))


def time_per_qs_summary(ann: DataFrame) -> DataFrame:
    """Mean and median time per question sequence (exact median, see
    :func:`annoflow.operators.stats.exact_median`)."""
    from annoflow.operators.stats import exact_median

    t = qs_first_times(ann).checkpoint(eager=True)
    med = exact_median(t, "total_time")
    return t.agg(F.count("*").alias("n_qs"), F.round(F.avg("total_time"), 9).alias("mean_time"),
                 F.round(F.lit(med).cast("double"), 9).alias("median_time"))


def smallest(df: DataFrame, value: str, n: int) -> DataFrame:
    """The n smallest values (a top-k report), with their rank."""
    top = df.select(value).where(F.col(value).isNotNull()).orderBy(value).limit(n)
    # the window runs over the n kept rows only
    return top.select(F.col(value), F.row_number().over(Window.orderBy(value)).alias("rank"))


def per_worker(ann: DataFrame) -> DataFrame:
    """Results, question sequences and mean time per annotator."""
    return (ann.where(F.col("annotator_id").isNotNull())
            .groupBy("annotator_id")
            .agg(F.count("*").alias("n_results"),
                 F.count_distinct("tweet_id").alias("n_qs"),
                 F.round(F.avg("total_time"), 9).alias("mean_time")))


def label_share(labels: DataFrame) -> DataFrame:
    """Count and percentage of each label within its question."""
    per = labels.groupBy("question_tag", "label_tag").agg(F.count("*").alias("n"))
    tot = labels.groupBy("question_tag").agg(F.count("*").alias("total"))
    return per.join(tot, "question_tag").select(
        "question_tag", "label_tag", "n", F.round(100.0 * F.col("n") / F.col("total"), 9).alias("pct"))


def cleaned_summary(labels: DataFrame) -> DataFrame:
    """Number of cleaned labels and of distinct statuses."""
    return labels.agg(F.count("*").alias("n_labels"), F.count_distinct("id").alias("n_tweets"))
