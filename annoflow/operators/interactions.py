"""Reply / quote / retweet counts and their merge into parsed statuses.

Counts are a ``groupBy`` over a distinct interaction log
``(source_id, kind, target_id)``: partial aggregation absorbs a viral target
before the shuffle, and counting a distinct log makes re-ingesting the same
status idempotent (D18).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("reply", "quote", "retweet")
COUNT_COLS = {"reply": "num_replies", "quote": "num_quotes", "retweet": "num_retweets"}


def interaction_log(statuses: DataFrame) -> DataFrame:
    """Distinct (source_id, kind, target_id) rows of top-level statuses.

    ``statuses`` has ``id``, ``kind`` and ``target_id``, or the parsed flags
    (``in_reply_to_status_id``, ``quoted_status_id`` / ``has_quote``,
    ``retweeted_status_id`` / ``is_retweet``), from which the log is exploded.
    """
    if "kind" in statuses.columns:
        log = statuses.select(F.col("id").alias("source_id"), "kind", "target_id")
    else:
        retweet = F.col("retweeted_status_id")
        quote = F.when(retweet.isNull(), F.col("quoted_status_id"))  # quotes inside retweets do not count
        pairs = F.array(
            F.struct(F.lit("reply").alias("kind"), F.col("in_reply_to_status_id").alias("target_id")),
            F.struct(F.lit("quote").alias("kind"), quote.alias("target_id")),
            F.struct(F.lit("retweet").alias("kind"), retweet.alias("target_id")))
        log = statuses.select(F.col("id").alias("source_id"), F.inline(pairs))
    return log.where(F.col("target_id").isNotNull() & F.col("kind").isNotNull()).distinct()


def count_interactions(log: DataFrame) -> DataFrame:
    """A1/A2: ``id, num_quotes, num_replies, num_retweets`` for every target."""
    return log.groupBy(F.col("target_id").alias("id")).agg(
        *[F.count_if(F.col("kind") == k).alias(COUNT_COLS[k]) for k in KINDS])


def attach_counts(parsed: DataFrame, counts: DataFrame) -> DataFrame:
    """Left join on id; missing counts are 0."""
    j = parsed.join(counts, "id", "left")
    for c in COUNT_COLS.values():
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("bigint"))
    return j


def dedup_by_id(rows: DataFrame, order_cols=("priority", "created_at", "source_file", "line")) -> DataFrame:
    """One row per id; a top-level copy (priority 0) beats an embedded one,
    then the earliest (day, file, line).  Aggregate form (min of a struct)."""
    cols = [c for c in rows.columns if c != "id"]
    order_cols = [c for c in order_cols if c in rows.columns]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)], *[F.col(c) for c in cols])
    return (rows.where(F.col("id").isNotNull()).groupBy("id").agg(F.min(packed).alias("_r"))
            .select("id", *[F.col(f"_r.{c}").alias(c) for c in cols]))


def extend_merge(existing: DataFrame, new_rows: DataFrame, existing_log: DataFrame,
                 new_log: DataFrame) -> DataFrame:
    """Merge a new batch into stored statuses.

    Stored rows win over re-collected copies, new ids are appended, and counts
    are recomputed from the union of the two distinct interaction logs, so a
    status collected twice is counted once.
    """
    base = [c for c in existing.columns if c not in COUNT_COLS.values()]
    old = existing.select(*base)
    fresh = new_rows.select(*base).join(old.select("id"), "id", "left_anti")
    rows = old.unionByName(fresh)
    log = existing_log.unionByName(new_log).distinct()
    return attach_counts(rows, count_interactions(log))
