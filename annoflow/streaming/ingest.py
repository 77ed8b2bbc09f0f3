"""Incremental ingest of raw status files with Structured Streaming.

The file source's checkpoint replaces the used-file manifest (S4).  Each micro-batch is parsed with the batch plan and merged
into a store of four tables, all cut by *buckets* of ids.  Status ids grow with time, so a bucket is a range of ids: a batch
touches the newest buckets and those of the statuses it answers, and what it reads and rewrites is bounded by these, not by the
history.

- ``statuses/created_day=/bucket=``: parsed rows with their counts, for readers.  Of all copies of a status the one that the batch
  parse prefers stays (X2, W1): top-level before embedded, then the earliest by (day, file, line), whatever order the files
  come in;
- ``locator/bucket=``: of each stored id its day and the order (``_origin``) of its copy, so that a better copy of any day finds
  the one that it replaces;
- ``log/bucket=/batch=``: the distinct (source_id, kind, target_id) interactions (X3), by the bucket of the target.  Files are named by
  their batch, so that a repeated batch replaces its own;
- ``quarantine/batch=``: lines that could not be read.

*Order of a merge:* log, statuses, emptied partitions, locator.  The locator says what is stored, so it comes last: a batch
that failed anywhere before finds the same rows to be new, and writes the same partitions again.
"""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annoflow.operators import interactions
from annoflow.plans import parse as parse_plan
from annoflow.session import Scratch, stage
from annoflow.sources.raw import day_from_path

COUNT_COLS = list(interactions.COUNT_COLS.values())

#: Ids of one bucket: some 17 minutes of time-ordered 64-bit ids (22 bits below the millisecond).
BUCKET_SPAN = 1 << 42
#: Buckets of ids that are no numbers.
OTHER_BUCKETS = 256
#: How Spark names the partition of null.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def bucket_of(id_col: str, span: int) -> Column:
    """The bucket of an id: a range of 64-bit numbers, or else a hash."""
    n = f"try_cast({id_col} AS BIGINT)"
    below = F.expr(f"{n} div {span} - if({n} < 0 AND {n} % {span} != 0, 1, 0)")
    return F.when(below.isNotNull(), F.concat(F.lit("n"), below.cast("string"))) \
        .otherwise(F.concat(F.lit("h"), F.pmod(F.crc32(F.col(id_col).cast("binary")), F.lit(OTHER_BUCKETS)).cast("string")))


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _read_parts(spark: SparkSession, table: str, parts: list[str], schema: str) -> DataFrame:
    """The partitions of a table that are there; no other folder is listed."""
    there = [f"{table}/{p}" for p in parts if _exists(spark, f"{table}/{p}")]
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table).parquet(*there)


def _overwrite(df: DataFrame, table: str, *parts: str) -> None:
    """Replaces the partitions that ``df`` has rows of, when the job commits."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(table)


def _folders(pairs: DataFrame) -> set[tuple[str, str]]:
    """The (day, bucket) folders of a frame of such pairs."""
    return {(str(r[0]) if r[0] else NO_DAY, r[1]) for r in pairs.distinct().collect()}


def _span(spark: SparkSession, store: str, span: int | None) -> int:
    """The store's bucket span, set by its first batch."""
    path = f"{store}/_layout"
    if _exists(spark, path):
        known = spark.read.parquet(path).first()["span"]
        if span not in (None, known):
            raise ValueError(f"the store has buckets of {known} ids, not {span}")
        return known
    span = span or BUCKET_SPAN
    spark.createDataFrame([(span,)], "span bigint").coalesce(1).write.parquet(path)
    return span


def merge_batch(batch_lines: DataFrame, store: str, keywords=(), countries=None, gazetteer=None,
                batch_id: str | None = None, span: int | None = None) -> None:
    """Parse one batch of lines and merge it into the store.

    Idempotent: a batch that is merged again, after a failure or not, changes nothing.  ``batch_id`` names the batch's files.
    ``span`` is the width of the id buckets of a new store.
    """
    spark = batch_lines.sparkSession
    with Scratch(spark) as scratch:
        _merge(spark, scratch, batch_lines, store, keywords, countries, gazetteer, batch_id or uuid.uuid4().hex, _span(spark, store, span))


def _merge(spark: SparkSession, scratch: Scratch, batch_lines: DataFrame, store: str, keywords, countries, gazetteer, batch_id: str, span: int) -> None:
    with Scratch(spark):  # the parsed lines and their copies are done with when the batch's rows are stored
        lines = batch_lines.withColumn("day", day_from_path("source_file"))
        parsed, new_log, bad = parse_plan.parse_with_log(lines, keywords, countries, gazetteer, keep_origin=True)
        rows = scratch.stage(parsed.withColumn("bucket", bucket_of("id", span)), "batch-rows")
        new_log = scratch.stage(new_log.withColumn("bucket", bucket_of("target_id", span)), "batch-log")
        _overwrite(bad.withColumn("batch", F.lit(batch_id)), f"{store}/quarantine", "batch")

    # Lists of buckets and days are as long as the batch has folders to write.
    buckets = [r[0] for r in rows.select("bucket").union(new_log.select("bucket")).distinct().collect()]
    parts = [f"bucket={b}" for b in buckets]

    log_schema = "source_id string, kind string, target_id string, bucket string, batch string"
    log = _read_parts(spark, f"{store}/log", parts, log_schema).where(F.col("batch") != batch_id)
    fresh = new_log.join(log, ["bucket", "source_id", "kind", "target_id"], "left_anti").withColumn("batch", F.lit(batch_id))
    _overwrite(fresh.select(*[c.split()[0] for c in log_schema.split(", ")]), f"{store}/log", "bucket", "batch")
    log = _read_parts(spark, f"{store}/log", parts, log_schema)

    origin = rows.schema["_origin"].dataType.simpleString()
    locator = _read_parts(spark, f"{store}/locator", parts, f"id string, day date, _origin {origin}, bucket string")
    # New ids, and better copies of stored ones, with the day of the copy that they replace.  What is stored is looked up by ids
    # and orders alone, and only what is known already is stored: the rows are neither joined with the locator nor written again.
    had = locator.select("bucket", "id", F.col("_origin").alias("_had"), F.col("day").alias("_had_day"))
    known = (rows.select("bucket", "id", "_origin", "created_day").join(had, ["bucket", "id"])
             .select("bucket", "id", "created_day", "_had_day", (F.col("_origin") < F.col("_had")).alias("_wins")))
    if any(_exists(spark, f"{store}/locator/{p}") for p in parts):  # else all rows are new
        known = stage(known, "known-rows")
    better = rows.join(known.where("NOT _wins"), ["bucket", "id"], "left_anti")
    replaced = known.where("_wins")
    # Targets of the whole batch, not of what is new in the log: a repeated batch finds its log already there
    # and still has to count it.
    hit = locator.join(new_log.select("bucket", F.col("target_id").alias("id")).distinct(), ["bucket", "id"], "left_semi")
    touched = (better.select(F.col("created_day").alias("day"), "bucket")
               .union(replaced.select("_had_day", "bucket")).union(hit.select("day", "bucket")))
    pairs = _folders(touched)
    moved = _folders(replaced.where("NOT (_had_day <=> created_day)").select("_had_day", "bucket"))

    columns = [c for c in rows.columns if c not in ("created_day", "bucket")]
    stored_schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*columns).schema.fields]
                              + [f"{c} bigint" for c in COUNT_COLS] + ["created_day date", "bucket string"])
    stored = _read_parts(spark, f"{store}/statuses", [f"created_day={d}/bucket={b}" for d, b in sorted(pairs)], stored_schema)
    base = stored.drop(*COUNT_COLS).join(better.select("bucket", "id"), ["bucket", "id"], "left_anti").unionByName(better)
    # All interactions with a status lie in its own bucket.  Counts are stored, so that few ones are broadcast.
    counts = stage(interactions.count_interactions(log), "counts")
    merged = interactions.attach_counts(base, counts)
    emptied = moved - _folders(base.select("created_day", "bucket")) if moved else set()
    # Spark moves new partitions into their place when all rows are written, so those that are read here are still there.
    _overwrite(merged.hint("rebalance", "created_day", "bucket").sortWithinPartitions("created_day", "bucket", "created_at"),
               f"{store}/statuses", "created_day", "bucket")
    for day, bucket in sorted(emptied):  # all their statuses have moved to another day
        fs, folder = _fs(spark, f"{store}/statuses/created_day={day}/bucket={bucket}")
        fs.delete(folder, True)
        if fs.exists(folder.getParent()) and not fs.listStatus(folder.getParent()):
            fs.delete(folder.getParent(), False)

    mine = better.select("id", F.col("created_day").alias("day"), "_origin", "bucket")
    changed = better.select("bucket").distinct()
    rest = locator.join(changed, "bucket", "left_semi").join(mine.select("bucket", "id"), ["bucket", "id"], "left_anti")
    _overwrite(rest.unionByName(mine).hint("rebalance", "bucket"), f"{store}/locator", "bucket")


def start_ingest(spark: SparkSession, raw_dir: str, store: str, checkpoint: str | None = None,
                 max_files_per_trigger: int | None = None, keywords=(), countries=None, gazetteer=None, span: int | None = None):
    """Stream new files of ``raw_dir`` into ``store``; returns the StreamingQuery
    (``trigger(availableNow=True)``: process what is there, then stop)."""
    checkpoint = checkpoint or f"{store}/_stream"  # files read once are not read again by a later call
    stream = f"{zlib.crc32(checkpoint.encode()):08x}"
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(raw_dir).select("value", F.col("_metadata.file_path").alias("source_file")) \
        .where(F.length("value") > 0)
    return (src.writeStream.foreachBatch(
        lambda batch, epoch: merge_batch(batch, store, keywords, countries, gazetteer, f"{stream}-{epoch}", span))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """The parsed statuses, one row an id."""
    return spark.read.parquet(f"{store}/statuses").drop("_origin", "bucket")


def read_quarantine(spark: SparkSession, store: str) -> DataFrame:
    """``value, source_file, batch`` of the lines that could not be read."""
    path = f"{store}/quarantine"
    schema = "value string, source_file string, batch string"
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)
