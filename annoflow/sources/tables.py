"""Reading the input tables (one parquet dataset per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annoflow.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
               spread_by: str | list[str] | None = None) -> DataFrame:
    """Read one table; a column list becomes the scan's ReadSchema (pruning).

    ``spread_by`` names a unique row key for CPU-heavy per-row work (text,
    JSON): when the scan yields fewer splits than the cluster has cores (few
    large row groups), the rows are hash-partitioned on that key so every core
    gets a share.  A unique key spreads evenly and does not pre-satisfy a later
    grouping, so map-side partial aggregation still runs before that shuffle.
    Large inputs already have enough splits and are left alone (no shuffle).
    """
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    if spread_by:
        df = spread(df, spread_by)
    return df


def spread(df: DataFrame, key) -> DataFrame:
    """Hash-partition on ``key`` only if the frame has fewer partitions than cores."""
    keys = [key] if isinstance(key, str) else list(key)
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, *keys)
    return df
