"""Composite jobs of the annotation workflow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoflow.functions import text as T
from annoflow.operators import sampling, splits
from annoflow.operators.steps import Steps
from annoflow.session import stage


def draw_sample(parsed: DataFrame, size: int | None = None, seed: int = 0, mode: str = "random",
                langs=None, include_replies: bool = False, anonymize: bool = True,
                keyword_only: bool = False, min_token_count: int | None = 3, min_date=None, max_date=None,
                previous: DataFrame | None = None, bin_size: int | None = None,
                unavailable: DataFrame | None = None, available: DataFrame | None = None) -> DataFrame:
    """S5 -> F2-F6 -> J3 (extend) -> W2 -> T2 / T3 -> P9.

    ``previous`` (tweet_id, tweet_text) switches on extend mode: earlier sampled
    ids and texts are excluded and, in monthly mode, unavailable / available
    uploads shape the per-bin quotas.
    """
    df = sampling.filter_statuses(parsed, min_date, max_date, min_token_count, include_replies, langs,
                                  keyword_only)
    if previous is not None:
        df = sampling.exclude_previous(df, previous)
    df = sampling.dedup_keep_first(df, T.sample_dedup_key("text"), ["created_at", "id"])
    if mode == "random":
        sample = sampling.random_sample(df, size, seed)
    elif mode == "monthly":
        ids = lambda d: None if d is None else d.select(F.col("tweet_id").alias("id"))
        extend = previous is not None
        sample = sampling.binned_sample(df, seed, size=size, bin_size=bin_size, period="months",
                                        unused=ids(unavailable) if extend else None,
                                        used=ids(available) if extend else None)
    else:
        raise ValueError(f"unknown sample mode {mode!r}")
    if anonymize:
        sample = sample.withColumn("text", T.anonymize_text("text"))
    return sample


def split_labels(cleaned: DataFrame, question=None, seed: int = 42, dev_size: float = 0.2,
                 test_size: float = 0.2, balanced_labels: bool = False, label_tags=(), has_label: str = "",
                 return_label_ids: bool = False) -> DataFrame:
    """S11 -> T7 -> F11 -> T6 (all questions when ``question`` is None)."""
    df = splits.cleaned_for_question(cleaned, question, has_label, return_label_ids)
    return splits.train_dev_test_split(df, seed, dev_size, test_size, label_tags=label_tags,
                                       balanced=balanced_labels)


def pretraining_text(parsed: DataFrame, seed: int = 0, lang: str | None = "en", min_tokens: int = 3,
                     drop_retweets: bool = True, keyword_only: bool = False, dev_cap: int = 200_000,
                     steps: Steps | None = None) -> DataFrame:
    """F7, F5, F6, F3 (>=) -> dedup on P19 -> shuffle -> T8 split; rows (id, text, split).

    The texts are stored: the split looks up its cuts in them, and its readers write each part on its own.  With ``steps`` the rows
    left after every step are observed (A27) while the chain runs, once.
    """
    mark = steps or (lambda df, name: df)
    df = mark(parsed, "start")
    if drop_retweets:
        df = mark(df.where(~F.col("is_retweet")), "drop_retweets")
    if keyword_only:
        df = mark(df.where(F.col("contains_keywords")), "contains_keywords")
    if lang is not None:
        df = mark(df.where(F.col("lang") == lang), "lang")
    if min_tokens > 0:
        df = mark(df.where(F.col("token_count") >= min_tokens), "min_tokens")
    df = mark(sampling.dedup_keep_first(df.select("id", "text"), T.text_cleared("text"), ["id"]), "drop_duplicates")
    df = stage(df, "pretraining") if steps is None else steps.run(df, "pretraining")
    return splits.pretrain_split(df, seed, dev_cap=dev_cap)
