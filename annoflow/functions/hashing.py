"""Seeded sample keys and order-insensitive fingerprints (T2 key, P17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sample_key(id_col="id", seed: int = 0) -> Column:
    """md5(seed ':' id) as hex: a seeded, partition-independent random order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _c(id_col).cast("string")))


def fingerprint(df: DataFrame) -> DataFrame:
    """One-row, order-insensitive fingerprint of a whole frame."""
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.agg(F.count("*").alias("n_rows"), F.bit_xor(h).alias("xor_hash"),
                  F.sum(h.cast("decimal(38,0)")).cast("string").alias("sum_hash"))
