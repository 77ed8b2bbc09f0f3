"""CSV inputs of the annotation workflow.

Layout (one folder per kind, as the pipeline writes them):
``annotations/<mode>/*.csv`` (header), ``samples/sampled_<dtype>_*.csv`` (no header: id, text),
``samples/batch_<n>/batch_<n>*.csv`` (no header), ``uploaded/<mode>/*.csv`` (header),
``cleaned/*.csv`` (header).  Every reader returns a DataFrame, also when no
file matches (then with zero rows), instead of an empty set; a root that is
not there raises.  An empty value reads as null.  A "file" may also be a folder that Spark wrote.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annoflow.functions.time import total_time

MODES = ("local", "mturk", "public", "other")

ANNOTATION_SCHEMA = ("id string, tweet_id string, text string, project_id bigint, question_id bigint, "
                     "question_tag string, answer_id bigint, answer_tag string, user_id bigint, worker_id string, "
                     "flag string, full_log string")
SAMPLE_SCHEMA = "tweet_id string, tweet_text string"
UPLOADED_SCHEMA = "tweet_id string, tweet_text string, availability string"
CLEANED_SCHEMA = ("id string, text string, question_id bigint, question_tag string, label_id bigint, "
                  "label_tag string")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _files(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Paths under ``root`` that match, listed through the Hadoop file system: any store that Spark reads."""
    fs, top = _file_system(spark, root)
    if not fs.exists(top):
        raise FileNotFoundError(root)
    _, path = _file_system(spark, os.path.join(root, pattern))
    return sorted(f.getPath().toString() for f in fs.globStatus(path) or [])


def _modes(mode: str) -> tuple[str, ...]:
    if mode in ("all", "*"):
        return MODES
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; there are {', '.join(MODES)}")
    return (mode,)


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """First line of every file (of a folder: of each of its parts), read by tasks; one short row a file comes back."""
    def first_lines(batches):
        last = None
        for batch in batches:
            files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
            rows = []
            for i, (file, start) in enumerate(zip(files, starts)):
                if start == 0 and file != last:
                    rows.append({"file": file, "header": batch.column("value")[i].as_py()})
                last = file
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("file", pa.string()), ("header", pa.string())]))

    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return {r.file: r.header.lstrip("\ufeff") for r in lines.mapInArrow(first_lines, "file string, header string").collect()}


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_annotations(spark: SparkSession, root: str, mode: str = "all", pattern: str = "*") -> DataFrame:
    """Annotation CSVs of one mode (or all); files may differ in columns.

    ``pattern`` is looked for anywhere in the file names.  Files of equal header are read together.  Adds ``mode``, ``file`` and a file-order ``seq``
    (mode, file, row position), ``annotator_id = coalesce(user_id, worker_id)`` and ``total_time``.
    Raises FileNotFoundError when nothing matches.
    """
    modes = _modes(mode)
    paths = _files(spark, root, os.path.join("{" + ",".join(modes) + "}", f"*{pattern}*.csv"))
    layouts: dict[str, list[str]] = {}
    for path, header in sorted(_headers(spark, paths).items()) if paths else ():
        layouts.setdefault(header, []).append(path)
    if not layouts:
        raise FileNotFoundError(f"no annotation files for mode {mode!r} under {root}")
    wanted = T._parse_datatype_string(ANNOTATION_SCHEMA)
    out = None
    for paths in layouts.values():
        df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(paths)
        file = F.col("_metadata.file_path")
        # a multi-line CSV file is one split, so the id follows its row order
        df = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted.fields],
                       F.regexp_extract(file, r"/([^/]+)/[^/]+$", 1).alias("mode"), file.alias("file"),
                       F.monotonically_increasing_id().alias("_row"))
        out = df if out is None else out.unionByName(df)
    rank = F.array_position(F.array(*[F.lit(m) for m in modes]), F.col("mode"))
    out = out.withColumn("seq", F.struct(rank.alias("mode_rank"), "file", F.col("_row").alias("row"))).drop("_row")
    out = out.withColumn("annotator_id", F.coalesce(F.col("user_id").cast("string"), F.col("worker_id")))
    return out.withColumn("total_time", total_time("full_log", "mode"))


def null_tag_counts(ann: DataFrame) -> DataFrame:
    """S6 quality check: rows with a missing question or answer tag."""
    return ann.agg(F.count_if(F.col("question_tag").isNull()).alias("null_question_tag"),
                   F.count_if(F.col("answer_tag").isNull()).alias("null_answer_tag"))


def read_sampled(spark: SparkSession, root: str, dtype: str = "*") -> DataFrame:
    """Headerless sample files; ``sample_pos`` keeps the file order."""
    paths = _files(spark, root, f"sampled_{dtype}_*.csv")
    if not paths:
        return _empty(spark, SAMPLE_SCHEMA + ", sample_pos struct<file:string,row:bigint>")
    # a multi-line CSV file is one split, so the id follows its row order
    df = spark.read.schema(SAMPLE_SCHEMA).option("multiLine", True).option("escape", '"').csv(paths)
    return df.withColumn("sample_pos", F.struct(F.col("_metadata.file_path").alias("file"),
                                                F.monotonically_increasing_id().alias("row")))


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """All previous batches with their ``batch_id``."""
    paths = _files(spark, root, os.path.join("batch_*", "batch_*.csv"))
    if not paths:
        return _empty(spark, SAMPLE_SCHEMA + ", batch_id int")
    df = spark.read.schema(SAMPLE_SCHEMA).option("multiLine", True).option("escape", '"').csv(paths)
    return df.withColumn("batch_id", F.regexp_extract(F.col("_metadata.file_path"),
                                                      r"/batch_(\d+)/batch_", 1).cast("int"))


def read_uploaded(spark: SparkSession, root: str, availability: str | None = None, mode: str = "*") -> DataFrame:
    """Uploaded batches (with availability), optionally one availability."""
    paths = _files(spark, root, os.path.join("{" + ",".join(_modes(mode)) + "}", "*.csv"))
    if not paths:
        return _empty(spark, UPLOADED_SCHEMA + ", mode string")
    df = spark.read.schema(UPLOADED_SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(paths)
    df = df.withColumn("mode", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1))
    if availability is not None:
        if availability not in ("available", "unavailable"):
            raise ValueError("availability must be 'available' or 'unavailable'")
        df = df.where(F.col("availability") == availability)
    return df


def checked(uploaded: DataFrame, availability: str | None = None, df: DataFrame | None = None) -> DataFrame:
    """(tweet_id, availability), optionally joined to a frame on tweet_id."""
    out = uploaded.select("tweet_id", "availability")
    if availability is not None:
        out = out.where(F.col("availability") == availability)
    return df.join(out, "tweet_id") if df is not None else out


def read_cleaned(spark: SparkSession, root: str, name: str = "cleaned_labels*") -> DataFrame:
    """S11 input: the cleaned-label file (exactly one must match)."""
    paths = _files(spark, root, f"{name}.csv")
    if not paths:
        raise FileNotFoundError(f"no cleaned label files {name}.csv under {root}")
    if len(paths) > 1:
        raise ValueError(f"{len(paths)} cleaned label files match {name}; name one")
    return spark.read.schema(CLEANED_SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(paths)
