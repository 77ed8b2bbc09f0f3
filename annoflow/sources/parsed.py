"""Reading the parsed-status table (S5) and date windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_window(df: DataFrame, s_date=None, e_date=None, day_col: str = "created_day") -> DataFrame:
    """``s_date <= day < e_date`` on the day column (partition pruning when
    it is the partition column)."""
    if s_date is not None:
        df = df.where(F.col(day_col) >= F.to_date(F.lit(str(s_date)[:10])))
    if e_date is not None:
        df = df.where(F.col(day_col) < F.to_date(F.lit(str(e_date)[:10])))
    return df


def read_parsed(spark: SparkSession, root: str, s_date=None, e_date=None, usecols=None,
                contains_keywords: bool = False, num_days: int | None = None) -> DataFrame:
    """Parsed statuses in [s_date, e_date), optional column subset and
    keyword-only rows (the flag column is then dropped), first ``num_days`` days.

    Day bounds become PartitionFilters, the column list the ReadSchema, the
    keyword flag a pushed Parquet filter.
    """
    df = date_window(spark.read.parquet(root), s_date, e_date)
    if num_days is not None:
        days = [r[0] for r in df.select("created_day").distinct().orderBy("created_day").limit(num_days).collect()]
        df = df.where(F.col("created_day").isin(days))
    if contains_keywords:
        df = df.where(F.col("contains_keywords"))
    if usecols:
        cols = [c for c in usecols if not (contains_keywords and c == "contains_keywords")]
        df = df.select(*cols)
    return df


def created_window(df: DataFrame, start=None, end=None, col: str = "created_at") -> DataFrame:
    """both ends inclusive, on the timestamp."""
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(F.col(col) <= F.lit(end).cast("timestamp"))
    return df


def omit_last_day(df: DataFrame, day_expr=None) -> DataFrame:
    """S3: drop the rows of the newest day (incomplete collection)."""
    day = day_expr if day_expr is not None else F.to_date("created_at")
    last = df.agg(F.max(day)).first()[0]
    return df if last is None else df.where(day < F.lit(last))
