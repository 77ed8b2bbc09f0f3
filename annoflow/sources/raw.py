"""Raw status files.

Files are chosen from a listing (path, day, size), so that used files, days to omit and days that are not there cost
nothing.  Lines are read with the text source (gzip and bzip2 are decoded natively), parsed once with ``from_json`` against an
explicit schema and stored; only lines that are not JSON objects then go through a small Arrow UDF that
turns Python-literal dictionaries into JSON.  What still fails is returned as quarantine rows instead of aborting the run.
"""

from __future__ import annotations

import ast
import datetime as dt
import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from annoflow.schema import RAW_STATUS
from annoflow.session import stage

# The three file-name layouts that carry the collection day.
DAY_FROM_COMPACT = r"tweets-(\d{8})\d{6}"                          # tweets-YYYYMMDDHHMMSS-...
DAY_FROM_DASHED = r"-(\d{4}-\d{1,2}-\d{1,2})-\d+-\d+-\d+"             # ...-Y-M-D-H-M-S-...
DAY_FROM_DIRS = r"/(\d{4}/\d{2}/\d{2})/[^/]+/[^/]+$"                # .../YYYY/MM/DD/HH/file


def file_name(path: Column) -> Column:
    """One spelling of a file's path: sources differ in the slashes of a local one."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def read_raw_lines(spark: SparkSession, paths) -> DataFrame:
    """S1 input: non-empty lines with their file path and collection day."""
    df = spark.read.text(paths).select("value", file_name(F.col("_metadata.file_path")).alias("source_file"))
    return df.where(F.length("value") > 0).withColumn("day", day_from_path("source_file"))


def day_from_path(path: Column | str) -> Column:
    """Collection day from the file name (two patterns) or its directories."""
    p = F.col(path) if isinstance(path, str) else path
    base = F.substring_index(p, "/", -1)
    compact = F.to_date(F.nullif(F.regexp_extract(base, DAY_FROM_COMPACT, 1), F.lit("")), "yyyyMMdd")
    dashed = F.to_date(F.nullif(F.regexp_extract(base, DAY_FROM_DASHED, 1), F.lit("")), "yyyy-M-d")
    dirs = F.to_date(F.nullif(F.regexp_extract(p, DAY_FROM_DIRS, 1), F.lit("")), "yyyy/MM/dd")
    return F.when(base.startswith("tweets"), compact) \
        .otherwise(F.coalesce(dashed, dirs))


def omit_last_day(lines: DataFrame, day_col: str = "day") -> DataFrame:
    """S3: drop every row (a line, or a file of a listing) of the newest, incomplete collection day."""
    last = lines.agg(F.max(day_col)).first()[0]
    return lines if last is None else lines.where(F.col(day_col) < F.lit(last))


def unused_lines(lines: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """S4 (batch form): skip rows (lines, or files of a listing) of files in the manifest (``source_file``)."""
    if manifest is None:
        return lines
    return lines.join(manifest.select("source_file").distinct(), "source_file", "left_anti")


def last_n_days_prefixes(root: str, last_n_days: int, today: dt.date | None = None) -> list[str]:
    """``root/YYYY/MM/DD/`` prefixes for today and the n-1 days before."""
    today = today or dt.datetime.now(dt.timezone.utc).date()
    days = [today - dt.timedelta(days=i) for i in range(last_n_days)]
    return [f"{root.rstrip('/')}/{d:%Y/%m/%d}/" for d in days]


def _there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    matches = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return matches is not None and len(matches) > 0


def list_files(spark: SparkSession, paths) -> DataFrame:
    """The files below the paths (which may hold wildcards): ``source_file, day, size``.  Paths that are not there have none.

    Nothing is opened: Spark lists the folders and leaves the content column out.
    """
    paths = [p for p in ([paths] if isinstance(paths, str) else paths) if _there(spark, p)]
    if not paths:
        return spark.createDataFrame([], "source_file string, day date, size bigint")
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return df.select(file_name(F.col("path")).alias("source_file"), F.col("length").alias("size")).select("source_file", day_from_path("source_file").alias("day"), "size")


def read_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """S1 input: the lines of the files of a listing.  Their paths pass through the driver, as in any read of files."""
    paths = [r[0] for r in files.select("source_file").collect()]
    if not paths:
        return spark.createDataFrame([], "value string, source_file string, day date")
    return read_raw_lines(spark, paths)


def select_files(spark: SparkSession, root: str, manifest: DataFrame | None = None, skip_last_day: bool = False,
                 last_n_days: int | None = None, today: dt.date | None = None) -> DataFrame:
    """S3, S4, S15 on the listing: the files below ``root`` that are to be read.

    ``last_n_days`` looks only into the folders of these days; ``manifest`` has the files already used; ``skip_last_day``
    leaves out the newest day that is there.
    """
    files = list_files(spark, root if last_n_days is None else last_n_days_prefixes(root, last_n_days, today))
    if skip_last_day:
        files = omit_last_day(files)
    return unused_lines(files, manifest)


@F.pandas_udf(StringType())
def _literal_to_json(lines: pd.Series) -> pd.Series:
    def conv(s):
        try:
            return json.dumps(ast.literal_eval(s)) if s is not None else None
        except Exception:  # noqa: BLE001 - anything unparsable is quarantined
            return None
    return lines.map(conv)


# A filter on a result is not pushed below a non-deterministic function, so no line is converted twice.
_literal_to_json = _literal_to_json.asNondeterministic()


#: What ``from_json`` reads, and the line itself where it is no object of that form.
_READ = StructType(RAW_STATUS.fields + [StructField("_odd", StringType())])


def _parsed(column) -> Column:
    """The parsed line.  As the row of a generator it is computed once; a plain column would be put into every expression that uses it."""
    return F.explode(F.array(F.from_json(column, _READ, {"columnNameOfCorruptRecord": "_odd"})))


def _kind(raw, sound) -> Column:
    """ok, odd (unreadable), bad (an id but no id_str), or null (a notice).  ``sound``: what has an id_str was read well."""
    return (F.when(sound & (F.coalesce(raw["id_str"], F.lit("")) != ""), F.lit("ok"))
            .when(raw.isNull() | raw["_odd"].isNotNull(), F.lit("odd"))
            .when(raw["id"].isNotNull(), F.lit("bad")))


def parse_lines(lines: DataFrame, take: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse lines into ``raw`` status structs, or what ``take`` makes of a struct (then only this is stored: the struct
    has some 140 fields, most of them null in any line, and each costs time to write and to read back).

    Returns (statuses, quarantine).  Objects without ``id`` (API notices) are dropped.  To
    quarantine go lines that are neither JSON nor a Python literal, values that are no object,
    and objects with an ``id`` but no ``id_str``.

    Every line is parsed once and stored; good rows, odd lines and quarantine are read from there.  Odd lines are parsed
    once more: JSON objects with a value of another type than the schema's as they are, all others
    as what the literal UDF makes of them.  JSON lines never leave the JVM.
    """
    kept = F.col("_raw").dropFields("_odd") if take is None else take(F.col("_raw"))
    once = lines.select("*", _parsed("value").alias("_raw"))
    good = F.col("_kind") == "ok"
    once = stage(once.withColumn("_kind", _kind(F.col("_raw"), F.col("_raw._odd").isNull())).where(F.col("_kind").isNotNull())
                 .withColumns({"raw": F.when(good, kept), "value": F.when(~good, F.col("value"))}).drop("_raw"), "parsed")
    is_json = F.json_object_keys("value").isNotNull()
    literals = once.where("_kind = 'odd'").drop("raw").withColumn("_json", _literal_to_json(F.when(~is_json, F.col("value"))))
    literals = literals.withColumn("_json", F.when(is_json, F.col("value")).otherwise(F.col("_json")))
    literals = literals.select("*", _parsed("_json").alias("_raw")).drop("_json").withColumn("_kind", _kind(F.col("_raw"), F.lit(True)))
    ok = (once.where(good).drop("value", "_kind")
          .unionByName(literals.where(good).withColumn("raw", kept).drop("value", "_kind", "_raw")))
    bad = (once.where("_kind = 'bad'").select("value", "source_file")
           .unionByName(literals.where("_kind in ('bad', 'odd')").select("value", "source_file")))
    return ok, bad
