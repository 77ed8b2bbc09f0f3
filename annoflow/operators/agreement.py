"""Inter-annotator agreement and annotator outliers.

No pairwise self-join: for an annotator whose (final) answer on a
(tweet, question) is x, the number of comparisons there is n-1 and the number of
agreements is n_x-1, where n counts annotators with an answer and n_x those
answering x.  Summing these per annotator gives the pairwise totals in linear
work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annoflow.operators.stats import exact_median
from annoflow.session import Scratch, stage


def final_answers(ann: DataFrame) -> DataFrame:
    """One answer per (tweet, question, annotator): the last one given (by seq)."""
    a = ann.where(F.col("tweet_id").isNotNull() & F.col("annotator_id").isNotNull()
                  & F.col("question_tag").isNotNull())
    return (a.groupBy("tweet_id", "question_tag", "annotator_id")
            .agg(F.max_by("answer_tag", "seq").alias("answer_tag"))
            .where(F.col("answer_tag").isNotNull()))


def annotator_agreement(ann: DataFrame) -> DataFrame:
    """Per annotator ``agreement_count``, ``total_count`` and their ratio.

    The final answers are stored, as they are counted and then joined with the counts."""
    last = stage(final_answers(ann), "answers")
    per_answer = (last.groupBy("tweet_id", "question_tag", "answer_tag").agg(F.count("*").alias("n_x"))
                  .withColumn("n", F.sum("n_x").over(Window.partitionBy("tweet_id", "question_tag"))))
    joined = last.join(per_answer, ["tweet_id", "question_tag", "answer_tag"])
    return (joined.groupBy("annotator_id")
            .agg(F.sum(F.col("n_x") - 1).alias("agreement_count"),
                 F.sum(F.col("n") - 1).alias("total_count"))
            .withColumn("agreement_ratio", F.try_divide(F.col("agreement_count").cast("double"),
                                                        F.col("total_count").cast("double"))))


def robust_z(df: DataFrame, value: str, out: str, below_median_only: bool = False) -> DataFrame:
    """|x - median| / MAD over the non-null values of ``value``.

    Median and MAD are two scalar aggregates; MAD = 0 gives +inf for x != median.
    With ``below_median_only`` only values under the median get a score.  The
    input (one row per annotator) is checkpointed first so the two scalar
    passes and the final projection do not recompute its shuffles.
    """
    df = df.checkpoint(eager=True)
    x = F.col(value)
    med = exact_median(df, x)
    if med is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    mad = exact_median(df, F.abs(x - F.lit(med)))
    dev = F.abs(x - F.lit(med))
    if mad == 0:
        z = F.when(dev == 0, F.lit(None).cast("double")).otherwise(F.lit(float("inf")))
    else:
        z = dev / F.lit(mad)
    if below_median_only:
        z = F.when(x < F.lit(med), z)
    return df.withColumn(out, z.cast("double"))


def agreement_outlier_ids(ann: DataFrame, cutoff: float, min_comparisons_count: int = 20) -> DataFrame:
    """Annotators whose low agreement has a robust z-score above ``cutoff``.

    They are stored, so that few ones are broadcast to the annotations that are marked with them; the answers go."""
    with Scratch(ann.sparkSession) as scratch:
        ag = annotator_agreement(ann).where(F.col("total_count") >= min_comparisons_count)
        ag = robust_z(ag, "agreement_ratio", "z", below_median_only=True)
        return scratch.leave(ag.where(F.col("z") > cutoff).select("annotator_id"), "outliers")


def question_sequences(ann: DataFrame) -> DataFrame:
    """A10: one row per (annotator, tweet) with the number of results."""
    return (ann.where(F.col("annotator_id").isNotNull() & F.col("tweet_id").isNotNull())
            .groupBy("annotator_id", "tweet_id").agg(F.count("*").alias("results_count")))


def worker_outliers(ann: DataFrame, min_tasks: int = 3, time_cutoff: float = 3,
                    agreement_cutoff: float = 3, min_comparisons_count: int | None = 20) -> DataFrame:
    """Per annotator time and agreement values, z-scores and outlier tags.

    Tags are 'outlier' / 'no_outlier' for annotators that were considered and
    null otherwise.
    """
    per_worker = (ann.where(F.col("annotator_id").isNotNull())
                  .groupBy("annotator_id")
                  .agg(F.count_distinct("tweet_id").alias("qs_count"),
                       F.avg("total_time").alias("_mean_time")))
    per_worker = per_worker.where(F.col("qs_count") > 0)
    considered = F.col("qs_count") >= min_tasks
    per_worker = per_worker.withColumn("time_values", F.when(considered, F.col("_mean_time")))
    per_worker = robust_z(per_worker, "time_values", "time_zscores", below_median_only=True)
    per_worker = per_worker.withColumn(
        "time_outlier", F.when(considered, F.when(F.col("time_zscores") > time_cutoff, "outlier")
                               .otherwise("no_outlier")))
    ag = annotator_agreement(ann)
    if min_comparisons_count is not None:
        ag = ag.where(F.col("total_count") >= min_comparisons_count)
    ag = robust_z(ag.select("annotator_id", F.col("agreement_ratio").alias("agreement_values")),
                  "agreement_values", "agreement_zscores", below_median_only=True)
    ag = ag.withColumn("agreement_outlier", F.when(F.col("agreement_zscores") > agreement_cutoff, "outlier")
                       .otherwise("no_outlier"))
    return per_worker.join(ag, "annotator_id", "left").select(
        "annotator_id", "qs_count", "time_values", "time_zscores", "time_outlier",
        "agreement_values", "agreement_zscores", "agreement_outlier")


def fleiss_kappa(ann: DataFrame, by=("mode",), min_annotations: int = 20) -> DataFrame:
    """A5 + A26 + F14: Fleiss' kappa per question (and per ``by`` columns).

    P_i = (sum_j n_ij^2 - n_i) / (n_i (n_i - 1)) over tweets with n_i > 1,
    P_e = sum_j p_j^2 over all annotations of the question.  Only questions
    with more than ``min_annotations`` distinct tweets are reported.
    """
    keys = list(by) + ["question_tag"]
    a = ann.where(F.col("tweet_id").isNotNull() & F.col("question_tag").isNotNull()
                  & F.col("answer_tag").isNotNull())
    cells = a.groupBy(*keys, "tweet_id", "answer_tag").agg(F.count("*").alias("n_ij"))
    per_tweet = cells.groupBy(*keys, "tweet_id").agg(
        F.sum("n_ij").alias("n_i"), F.sum(F.col("n_ij") * F.col("n_ij")).alias("s2"))
    p_i = F.when(F.col("n_i") > 1, (F.col("s2") - F.col("n_i")) / (F.col("n_i") * (F.col("n_i") - 1)))
    observed = per_tweet.groupBy(*keys).agg(F.avg(p_i).alias("p_bar"), F.count("*").alias("n_tweets"))
    chance = (cells.groupBy(*keys, "answer_tag").agg(F.sum("n_ij").alias("n_j"))
              .groupBy(*keys).agg((F.sum(F.col("n_j") * F.col("n_j")).cast("double")
                                   / F.pow(F.sum("n_j").cast("double"), 2)).alias("p_e")))
    out = observed.join(chance, keys).where(F.col("n_tweets") > min_annotations)
    kappa = F.try_divide(F.col("p_bar") - F.col("p_e"), 1 - F.col("p_e"))
    return out.select(*keys, "n_tweets", F.round("p_bar", 9).alias("p_bar"), F.round("p_e", 9).alias("p_e"),
                      F.round(kappa, 9).alias("kappa"))
