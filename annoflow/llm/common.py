"""Helpers shared by the operators: staging in the shared folder, row keys, batch slicing."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from annoflow.session import ensure_checkpoint_dir, table_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Bytes of text that a Python task holds as word arrays at a time.  Batches are
#: cut at document borders, so one document is always processed whole.
SLICE_BYTES = 1 << 21


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the checkpoint folder, deleted when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor recomputes nothing that lies before it.
    """
    path = shared_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(*columns: str) -> list[Column]:
    """128 bits that identify a row by the given columns, nulls included."""
    parts = [F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")) for c in columns]
    return [F.xxhash64(*parts).alias("_k1"), F.xxhash64(F.lit(1), *parts).alias("_k2")]


def ascii_lower(column: Column) -> Column:
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)


def slices(texts, limit: int = SLICE_BYTES):
    """(start, length) runs of an Arrow string array of about ``limit`` bytes each."""
    import numpy as np
    import pyarrow.compute as pc

    n = len(texts)
    if n == 0:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < n:
        base = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield start, stop - start
        start = stop
