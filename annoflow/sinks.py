"""Writers (K1-K8).  Run parameters go to a small metadata file next to the
data instead of into file names.  CSV files double the quotes inside values,
as the readers expect.

``publish`` makes a run visible as a whole: the writers write into a folder of the run, and a small manifest, written last
and renamed into place, names it with its parameters.  Readers follow the newest manifest (``published``), so a half-done
or repeated run is never seen."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Values are written as they are: quotes doubled, spaces at both ends kept.
CSV = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _manifests(spark: SparkSession, folder: str) -> list[str]:
    fs, pattern = _fs(spark, f"{folder}/manifest-*")
    return sorted(f.getPath().toString() for f in fs.globStatus(pattern) or [])


def publish(spark: SparkSession, folder: str, write: Callable[[str], None], **params) -> str:
    """``write(run_folder)``, then make that run the current one of ``folder``; returns the run folder."""
    run = uuid.uuid4().hex
    write(f"{folder}/runs/{run}")
    fs, draft = _fs(spark, f"{folder}/_draft-{run}")
    out = fs.create(draft)
    out.write(json.dumps({"run": run, "params": params}, sort_keys=True, default=str).encode())
    out.close()
    while True:  # the next free number; another run may take it first
        known = _manifests(spark, folder)
        n = int(known[-1].rsplit("-", 1)[1]) + 1 if known else 1
        _, place = _fs(spark, f"{folder}/manifest-{n:012d}")
        if not fs.exists(place) and fs.rename(draft, place):
            return f"{folder}/runs/{run}"


def published(spark: SparkSession, folder: str) -> tuple[str, dict]:
    """The current run's folder and parameters."""
    known = _manifests(spark, folder)
    if not known:
        raise FileNotFoundError(f"nothing was published in {folder}")
    manifest = json.loads("\n".join(r[0] for r in spark.read.text(known[-1]).collect()))
    return f"{folder}/runs/{manifest['run']}", manifest["params"]


def _meta(df: DataFrame, folder: str, params: dict) -> None:
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps(params, sort_keys=True, default=str),)], "params string") \
        .coalesce(1).write.mode("overwrite").text(f"{folder}/_run")


def write_sample(sample: DataFrame, folder: str, columns=("id", "text"), **params) -> None:
    """K2: headerless CSV of the sample (or all columns with header)."""
    cols = list(columns)
    out = sample if cols == ["all"] else sample.select(*cols)
    out.write.mode("overwrite").option("header", cols == ["all"]).options(**CSV).csv(f"{folder}/data")
    _meta(sample, folder, params)


def write_cleaned_labels(labels: DataFrame, folder: str, **params) -> None:
    """K3: the full table and one folder per question with (id, text, label)."""
    labels.select("id", "text", "question_id", "question_tag", "label_id", "label_tag") \
        .write.mode("overwrite").option("header", True).options(**CSV).csv(f"{folder}/all")
    labels.select("id", "text", F.col("label_tag").alias("label"), "question_tag") \
        .write.mode("overwrite").option("header", True).partitionBy("question_tag").options(**CSV).csv(f"{folder}/by_question")
    _meta(labels, folder, params)


def write_splits(splits: DataFrame, folder: str, **params) -> None:
    """K4: one folder per (question, split)."""
    splits.write.mode("overwrite").option("header", True).partitionBy("question_tag", "split").options(**CSV).csv(folder)
    _meta(splits, folder, params)


def write_pretrain_text(rows: DataFrame, folder: str, max_examples_per_file: int = 1_000_000) -> None:
    """K5: train/dev text lines, at most ``max_examples_per_file`` per file."""
    for split in ("train", "dev"):
        rows.where(F.col("split") == split).select("text").write.mode("overwrite") \
            .option("maxRecordsPerFile", max_examples_per_file).text(f"{folder}/{split}")


def write_counts(counts: DataFrame, folder: str) -> None:
    """K7: interaction counts as Parquet (a recovery point instead of a pickle)."""
    counts.write.mode("overwrite").parquet(folder)


def write_translation_input(rows: DataFrame, folder: str) -> None:
    """K8: CSV (id, text) for the translation service, batches kept as a column."""
    rows.select("id", "text", "batch").write.mode("overwrite").option("header", True).options(**CSV).csv(folder)
