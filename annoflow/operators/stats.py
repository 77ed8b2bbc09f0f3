"""Exact order statistics without holding a whole column in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_median(df: DataFrame, value: Column | str):
    """Exact median (mean of the two middle values for an even count) of the
    non-null values, or None.

    Equal values are counted together (partly before the shuffle) and the counts dealt
    by range of value.  Totals per range say which ranges hold the middle ranks, and running
    totals inside a range which values.  The driver gets the totals (a row for each
    partition) and at most two values.
    """
    x = F.col(value) if isinstance(value, str) else value
    vals = df.select(x.cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    counts = vals.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    dealt = counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()).checkpoint(eager=True)
    totals = sorted(tuple(r) for r in dealt.groupBy("part").agg(F.sum("n")).collect())
    n = sum(t for _, t in totals)
    if n == 0:
        return None
    picked, before = [], 0
    running = F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    for part, total in totals:
        ranks = [k - before for k in sorted({(n - 1) // 2, n // 2}) if before <= k < before + total]
        before += total
        if ranks:
            here = dealt.where(F.col("part") == part).withColumn("upto", running)
            hit = [(F.col("upto") - F.col("n") <= k) & (F.col("upto") > k) for k in ranks]
            picked += [r["v"] for r in here.where(hit[0] | hit[-1]).collect()]
    return (min(picked) + max(picked)) / 2.0
