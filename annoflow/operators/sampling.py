"""Sampling statuses for annotation.

Randomness is a seeded hash of the id (``md5(seed ':' id)``), so a sample does
not depend on partitioning, is reproducible, and top-k selection stays exact
(see :mod:`annoflow.operators.topk`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoflow.functions.hashing import sample_key
from annoflow.functions.time import period_key
from annoflow.operators.topk import ShareOf, global_row_index, top_k_by_key


def filter_statuses(df: DataFrame, min_date=None, max_date=None, min_token_count: int | None = 3,
                    include_replies: bool = False, langs=None, keyword_only: bool = False) -> DataFrame:
    """Date range [min, max), strict token minimum, replies, keywords, languages."""
    if min_date is not None:
        df = df.where(F.col("created_at") >= F.lit(min_date))
    if max_date is not None:
        df = df.where(F.col("created_at") < F.lit(max_date))
    if min_token_count is not None:
        df = df.where(F.col("token_count") > min_token_count)
    if not include_replies:
        if "is_reply" not in df.columns:
            raise ValueError("replies cannot be excluded without the column is_reply; pass include_replies=True")
        df = df.where(~F.col("is_reply"))
    if keyword_only:
        df = df.where(F.col("contains_keywords"))
    if langs:
        df = df.where(F.col("lang").isin(*langs))
    return df


def exclude_previous(df: DataFrame, sampled: DataFrame) -> DataFrame:
    """Drop statuses already sampled, by id and by identical text."""
    ids = sampled.select(F.col("tweet_id").alias("id")).distinct()
    # Texts meet by their hash, 16 bytes, and are compared themselves where hashes are equal.
    txt = sampled.where(F.col("tweet_text").isNotNull()).select(F.col("tweet_text").alias("_text"), F.md5("tweet_text").alias("_hash")).distinct()
    same = (F.md5("text") == F.col("_hash")) & (F.col("text") == F.col("_text"))
    return df.join(ids, "id", "left_anti").join(txt, same, "left_anti")


def dedup_keep_first(df: DataFrame, key: F.Column, order_cols) -> DataFrame:
    """One row per ``key`` value, the first in ``order_cols`` order.

    An aggregate (min of a struct led by the order columns) rather than a
    window: map-side partial aggregation collapses a hot key before the
    shuffle.  The key is hashed (md5) so long texts are not shuffled twice; a
    null key is one group, as in a pandas drop_duplicates.
    """
    cols = df.columns
    order_cols = list(order_cols)
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                      *[F.col(c) for c in cols])
    return (df.groupBy(F.md5(key).alias("_dk")).agg(F.min(packed).alias("_r"))
            .select(*[F.col(f"_r.{c}").alias(c) for c in cols]))


def random_sample(df: DataFrame, size: int, seed: int, id_col: str = "id", strict: bool = True) -> DataFrame:
    """Exactly ``size`` rows without replacement, seeded.

    ``strict`` raises, as the reference does, when fewer rows exist (this costs
    one extra counting pass).
    """
    keyed = df.withColumn("_key", sample_key(id_col, seed))
    if strict:
        n = df.count()
        if n < size:
            raise ValueError(f"cannot sample {size} rows from {n}")
    return top_k_by_key(keyed, [], "_key", size, id_col).drop("_key")


def binned_sample(df: DataFrame, seed: int, size: int | None = None, bin_size: int | None = None,
                  period: str = "months", unused: DataFrame | None = None, used: DataFrame | None = None,
                  id_col: str = "id") -> DataFrame:
    """The same number of rows from every time bin.

    ``bin_size`` defaults to int(size / number of bins).  With ``unused`` /
    ``used`` (frames of ``id``, extend mode) each bin draws bin_size + #unused,
    drops unused and used ids, and keeps bin_size - #used.
    """
    b = df.withColumn("bin", period_key("created_at", period))
    keyed = b.withColumn("_key", sample_key(id_col, seed))
    if unused is None and used is None:
        quota = bin_size if bin_size is not None else ShareOf(size)
        return top_k_by_key(keyed, ["bin"], "_key", quota, id_col).drop("_key")
    if bin_size is None:
        n_bins = b.select("bin").distinct().count()
        bin_size = int(size / n_bins) if n_bins else 0

    def per_bin(ids: DataFrame | None, name: str) -> DataFrame:
        if ids is None:
            return b.select("bin").distinct().withColumn(name, F.lit(0))
        hit = b.join(ids.select(F.col("id").alias(id_col)).distinct(), id_col, "left_semi")
        return hit.groupBy("bin").agg(F.count("*").alias(name))

    quotas = (per_bin(unused, "_n_unused").join(per_bin(used, "_n_used"), "bin", "full")
              .na.fill(0, ["_n_unused", "_n_used"]))
    keyed = keyed.join(quotas, "bin", "left").na.fill(0, ["_n_unused", "_n_used"]) \
        .withColumn("_quota", F.lit(bin_size) + F.col("_n_unused")) \
        .withColumn("_keep", F.greatest(F.lit(bin_size) - F.col("_n_used"), F.lit(0)))
    drawn = top_k_by_key(keyed, ["bin"], "_key", "_quota", id_col)
    excluded = None
    for ids in (unused, used):
        if ids is not None:
            e = ids.select(F.col("id").alias(id_col))
            excluded = e if excluded is None else excluded.unionByName(e)
    drawn = drawn.join(excluded.distinct(), id_col, "left_anti")
    kept = top_k_by_key(drawn, ["bin"], "_key", "_keep", id_col)
    return kept.drop("_key", "_quota", "_keep", "_n_unused", "_n_used")


def still_available(sampled: DataFrame, unavailable: DataFrame | None, labelled: DataFrame | None,
                    batched: DataFrame | None, ignore_previous: bool = False) -> DataFrame:
    """Sample rows whose id is not unavailable, labelled or (unless ignored) batched."""
    out = sampled
    for ids in (unavailable, labelled, None if ignore_previous else batched):
        if ids is not None:
            out = out.join(ids.select("tweet_id").distinct(), "tweet_id", "left_anti")
    return out


def next_batch(sampled: DataFrame, num_tweets: int, unavailable=None, labelled=None, batched=None,
               tail: bool = True, ignore_previous: bool = False, batch_id: int | None = None) -> DataFrame:
    """T4: the last (or first) ``num_tweets`` still-available rows in sample order.

    ``sampled`` has ``tweet_id, tweet_text, sample_pos``; ``batched`` may carry
    ``batch_id`` (the new id is max + 1).  Refuses when too few rows are left.
    """
    avail = still_available(sampled, unavailable, labelled, batched, ignore_previous)
    left = avail.select("tweet_id").distinct().count()
    if left == 0 or num_tweets > left:
        raise ValueError(f"requested a batch of {num_tweets} but {left} statuses are available")
    if batch_id is None:
        prev = None
        if batched is not None and "batch_id" in batched.columns:
            prev = batched.agg(F.max("batch_id")).first()[0]
        batch_id = (prev or 0) + 1
    order = F.col("sample_pos").desc() if tail else F.col("sample_pos").asc()
    return avail.orderBy(order).limit(num_tweets).withColumn("batch_id", F.lit(batch_id))


def sample_stats(sampled: DataFrame, unavailable: DataFrame, labelled: DataFrame, batched: DataFrame) -> DataFrame:
    """Distinct sampled / unavailable / batched / labelled ids and what is left."""
    s = sampled.select("tweet_id").distinct()
    u = unavailable.select("tweet_id").distinct()
    lab = labelled.select("tweet_id").distinct()
    bat = batched.select("tweet_id").distinct()
    flags = (s.withColumn("_s", F.lit(True))
             .join(u.withColumn("_u", F.lit(True)), "tweet_id", "full")
             .join(lab.withColumn("_l", F.lit(True)), "tweet_id", "full")
             .join(bat.withColumn("_b", F.lit(True)), "tweet_id", "full"))
    s_, u_, l_, b_ = (F.coalesce(F.col(c), F.lit(False)) for c in ("_s", "_u", "_l", "_b"))
    return flags.agg(
        F.count_if(s_).alias("n_sampled"),
        F.count_if(u_).alias("n_unavailable"),
        F.count_if(b_).alias("n_batched"),
        F.count_if(l_).alias("n_labelled"),
        F.count_if(s_ & ~u_ & ~l_ & ~b_).alias("n_left"),
        F.count_if(s_ & ~u_ & ~b_).alias("n_left_incl_labelled"),
    ).withColumn("pct_labelled", F.round(F.try_divide(100.0 * F.col("n_labelled"), F.col("n_sampled")), 9))


def sample_distribution(corpus: DataFrame, sample: DataFrame, id_col: str = "id") -> DataFrame:
    """Corpus position and day/month/year index (from the first date) of sampled rows."""
    first = corpus.agg(F.min("created_at")).first()[0]
    idx = global_row_index(corpus.select(id_col, "created_at"), ["created_at", id_col], index_col="idx")
    hit = idx.join(sample.select(id_col).distinct(), id_col, "left_semi")
    base = F.lit(first).cast("timestamp_ntz") if first is not None else F.lit(None)
    return hit.select(
        id_col, "idx",
        F.datediff(F.to_date("created_at"), F.to_date(base)).alias("day_idx"),
        ((F.year("created_at") - F.year(base)) * 12 + F.month("created_at") - F.month(base)).alias("month_idx"),
        (F.year("created_at") - F.year(base)).alias("year_idx"))


def shuffle(df: DataFrame, seed: int, id_col: str = "id") -> DataFrame:
    """T5: a seeded random order (range-partitioned sort on the sample key)."""
    return df.withColumn("_key", sample_key(id_col, seed)).orderBy("_key", id_col).drop("_key")
