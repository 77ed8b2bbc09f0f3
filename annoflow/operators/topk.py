"""Exact per-group top-k, cuts by position and global row positions without single-task windows.

``top_k_by_key`` and ``label_by_position`` work on a uniform hash key whose leading hex digits
deal every group into ``16 ** BUCKET_DIGITS`` buckets.  One aggregate counts the buckets; running
totals over the counts give each bucket the position of its first row, so rows are only ever
ordered within a bucket.  A group that holds a third of the data is spread over all its buckets,
and the result is exact (no retry, no cap, no second plan for other sizes).

``global_row_index`` numbers rows in a total order: range partitioning, a
per-partition position from ``monotonically_increasing_id`` after a sort, and
per-partition offsets from a table of at most (partitions + groups) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annoflow.session import stage

#: Leading hex digits of the key that name a bucket: 65,536 buckets in each group.
BUCKET_DIGITS = 4


class ShareOf:
    """Quota int(size / number of groups), taken from the bucket counts."""

    def __init__(self, size: int):
        self.size = size


def _bucket(key: str) -> Column:
    return F.coalesce(F.substring(F.col(key), 1, BUCKET_DIGITS), F.lit(""))  # a null key comes first


def _bucket_counts(df: DataFrame, groups: list[str], key: str, *aggs: Column) -> DataFrame:
    """Per group and bucket: _c rows, _off rows of the group in the buckets before, and ``aggs``."""
    hist = df.groupBy(*groups, _bucket(key).alias("_bk")).agg(F.count("*").alias("_c"), *aggs)
    before = _per_group(groups).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    return hist.withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0)))


def _per_group(groups: list[str]):
    # Without groups the window holds bucket counts only, at most 16 ** BUCKET_DIGITS rows.
    return Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))


def top_k_by_key(df: DataFrame, groups, key: str, quota, tie: str, out_rank: str | None = None) -> DataFrame:
    """Keep the first ``quota`` rows per group in (key, tie) order.

    ``key`` is a hex hash column (uniform); ``quota`` an int, a column that is
    constant within a group, or ``ShareOf(size)``.  ``out_rank`` names a column
    for the rank (from 1).
    """
    groups = list(groups)
    if isinstance(quota, ShareOf):
        hist = _bucket_counts(df, groups, key)
        n_groups = hist.where("_off = 0").agg(F.count("*")).scalar()
        hist = hist.withColumn("_q", (F.lit(quota.size) / n_groups).cast("bigint"))
    else:
        q = F.lit(quota) if isinstance(quota, int) else F.col(quota)
        hist = _bucket_counts(df, groups, key, F.max(q).alias("_q"))
        hist = hist.withColumn("_q", F.max("_q").over(_per_group(groups)))
    needed = hist.where(F.col("_off") < F.col("_q")).select(*groups, "_bk", "_off", "_q")
    within = Window.partitionBy(*groups, "_bk").orderBy(key, tie)
    rank = out_rank or "_rank"
    out = (df.withColumn("_bk", _bucket(key)).join(needed, [*groups, "_bk"])
           .withColumn(rank, F.col("_off") + F.row_number().over(within))
           .where(F.col(rank) <= F.col("_q")).drop("_bk", "_off", "_q"))
    return out if out_rank else out.drop(rank)


def label_by_position(df: DataFrame, groups, key: str, tie: str, cuts, labels, out: str) -> DataFrame:
    """Label rows by their position in (key, tie) order within their group.

    ``cuts`` are ascending functions of the group's size (a column) that give a position; rows
    before the first cut get ``labels[0]``, and so on.  The (key, tie) pairs at the cuts are
    looked up in a checkpoint of the narrow columns, in the one bucket that holds each cut; the
    rows themselves are then compared with them, neither numbered, sorted nor stored.  Rows equal
    in key and tie get one label.
    """
    groups = list(groups)
    narrow = df.select(*groups, key, tie).checkpoint(eager=True)
    hist = _bucket_counts(narrow, groups, key).withColumn("_n", F.sum("_c").over(_per_group(groups)))
    at = F.array(*[cut(F.col("_n")).cast("bigint") for cut in cuts])
    edges = (hist.select(*groups, "_bk", "_off", "_c", F.posexplode(at).alias("_i", "_pos"))
             .where((F.col("_pos") >= F.col("_off")) & (F.col("_pos") < F.col("_off") + F.col("_c"))))
    place = F.col("_off") + F.row_number().over(Window.partitionBy(*groups, "_i").orderBy(key, tie)) - 1
    found = (narrow.withColumn("_bk", _bucket(key)).join(edges, [*groups, "_bk"])
             .withColumn("_place", place).where(F.col("_place") == F.col("_pos")))
    pair = F.struct(F.col(key).alias("k"), F.col(tie).alias("t"))
    names = [f"_cut{i}" for i in range(len(cuts))]
    bounds = found.groupBy(*groups).agg(*[F.max(F.when(F.col("_i") == i, pair)).alias(c) for i, c in enumerate(names)])
    if groups:
        # A row a group: the rows themselves, with all their columns, are not shuffled by so few keys.
        marked = df.join(F.broadcast(hist.select(*groups).distinct().join(bounds, groups, "left")), groups)
    else:
        row = bounds.first()  # one row, a pair for each cut
        marked = df.withColumns({c: F.lit(None) if row[c] is None else F.struct(
            F.lit(row[c]["k"]).alias("k"), F.lit(row[c]["t"]).cast(df.schema[tie].dataType).alias("t")) for c in names})
    label = F.lit(labels[-1])
    for c, name in reversed(list(zip(names, labels))):
        # a cut at the end of the group has no row: everything is before it
        before = F.lit(True) if not groups and row[c] is None else F.col(c).isNull() | (pair < F.col(c))
        label = F.when(before, name).otherwise(label)
    return marked.withColumn(out, label).drop(*names)


def global_row_index(df: DataFrame, order_cols, groups=(), index_col: str = "row_idx",
                     num_partitions: int | None = None, materialized: bool = False) -> DataFrame:
    """0-based position of each row in ``order_cols`` order, restarting per group.

    ``order_cols`` must make the order total.  The range-partitioned, sorted
    and numbered frame is checkpointed: the per-partition positions are then
    stored values, so the offsets table and the rows cannot disagree (AQE may
    read one shuffle differently in two branches, and a lost executor may
    recompute a stage).  The input is stored first, so that the range sampling and the
    checkpoint do not compute it twice: pass keys and order columns only, and attach wide columns afterwards.
    """
    groups = list(groups)
    keys = groups + list(order_cols)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = df if materialized else stage(df, "index")
    ranged = (base.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_mid", F.monotonically_increasing_id())).checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), 33)
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    stats = ranged.groupBy(pid.alias("_pid"), *groups).agg(F.count("*").alias("_cnt"), F.min(local).alias("_first"))
    w = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))).orderBy("_pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    stats = stats.select("_pid", *groups, "_off", "_first")
    j = ranged.withColumn("_pid", pid).join(stats if groups else F.broadcast(stats), ["_pid", *groups])
    return j.withColumn(index_col, F.col("_off") + local - F.col("_first")).drop("_pid", "_off", "_first", "_mid")
