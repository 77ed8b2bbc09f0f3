"""Sharding (operator 6): extendible hashing.

Rows get an address of 256 bits: a hash of the id, then one of the text, then one of the row, so
that equal ids and even equal rows part at last.  A bucket is a prefix of the address.  It
holds its rows if they fit the byte limit, each row weighing one byte at least (or if it has one row); otherwise it, and it alone,
splits on the next bit.  The directory is built a page of ``PAGE`` bits at a time from summed bytes
per prefix; rows of buckets that still are too large at the end of a page go on to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from annoflow.llm.common import stage

LIMIT = 1 << 20
DIGITS = 3              # hex digits of the address in a directory page
PAGE = 4 * DIGITS
ADDRESS_DIGITS = 64


def _addresses(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    def part(c):
        return F.lpad(F.lower(F.hex(c)), 16, "0")

    text = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.concat(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), part(F.xxhash64(text)),
                 part(F.xxhash64(F.monotonically_increasing_id()))).alias("address"), *more)


def assign_shards(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8, null text: 0), shard ("s" and its bits), depth,
    shard_bytes, shard_rows.

    A shard has at most ``limit`` bytes and ``limit`` rows, so that empty texts, too, are split.  A text longer than the limit has a shard to
    itself.  Null ids share one address start and
    are split by their texts; repeated rows by a row number that is written before use.  An
    empty table has no shards.  Other columns are not read.
    """
    return _assigned(stage(_addresses(docs, id_col, text_col), "addresses"), limit)


def _assigned(rows: DataFrame, limit: int) -> DataFrame:
    """``assign_shards`` of staged addresses; further columns of ``rows`` stay with their row."""
    more = [c for c in rows.columns if c not in ("doc_id", "n_bytes", "address")]
    out, page = None, 0
    total = rows.agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if max(total["b"] or 0, total["n"]) <= limit or total["n"] <= 1:
        return rows.select(*more, "doc_id", "n_bytes", F.lit("s").alias("shard"), F.lit(0).alias("depth"),
                           F.lit(total["b"] or 0).cast("long").alias("shard_bytes"), F.lit(total["n"]).cast("long").alias("shard_rows"))
    while True:
        done = DIGITS * page                     # digits that the open buckets share
        digits = min(DIGITS, ADDRESS_DIGITS - done)
        width = 4 * digits
        entry = F.substring("address", 1, done + digits)
        sums = stage(rows.groupBy(entry.alias("entry")).agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")), "page")
        bits = F.lpad(F.conv(F.substring("entry", done + 1, digits), 16, 2), width, "0")
        levels = sums.withColumn("bits", bits).select(
            "entry", F.substring("entry", 1, done).alias("open"), "bits", "b", "n",
            F.explode(F.sequence(F.lit(1), F.lit(width))).alias("d")).withColumn("prefix", F.expr("left(bits, d)"))
        buckets = levels.groupBy("open", "prefix").agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
        last = done + digits >= ADDRESS_DIGITS
        fits = buckets.where((F.greatest("b", "n") <= limit) | (F.col("n") == 1)
                             | (F.lit(last) & (F.length("prefix") == width)))
        # The first prefix that fits is the bucket: all shorter ones were split.
        leaf = (levels.select("entry", "open", "prefix", "d").join(fits, ["open", "prefix"])
                .groupBy("entry").agg(F.min(F.struct("d", "prefix", "b", "n")).alias("leaf")))
        directory = stage(sums.select("entry").join(leaf, "entry", "left"), "directory")
        shared = _bits(F.substring("entry", 1, done), done)
        placed = (rows.withColumn("entry", entry).join(directory.where("leaf is not null"), "entry")
                  .select(*more, "doc_id", "n_bytes", F.concat(F.lit("s"), shared, "leaf.prefix").alias("shard"),
                          (F.col("leaf.d") + 4 * done).cast("int").alias("depth"),
                          F.col("leaf.b").alias("shard_bytes"), F.col("leaf.n").alias("shard_rows")))
        out = placed if out is None else out.unionByName(placed)
        still = directory.where("leaf is null").select("entry")
        if not still.take(1):
            return out
        rows = stage(rows.withColumn("entry", entry).join(still, "entry", "left_semi").drop("entry"), "addresses")
        page += 1


def _bits(digits, n: int):
    """The bits of n hex digits, converted digit by digit (conv() is limited to 64 bits)."""
    if not n:
        return F.lit("")
    return F.concat(*(F.lpad(F.conv(F.substring(digits, i + 1, 1), 16, 2), 4, "0") for i in range(n)))


def _folder(columns: list[str]) -> str:
    """The column that names shards, free in a table of these columns."""
    name, taken = "shard", {c.lower() for c in columns}
    while name in taken:
        name = "_" + name
    return name


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes ``docs`` under path/shard=..., each shard by one task, every row once.

    The whole row goes with its address, so null and repeated ids and repeated rows need no join.  If ``docs`` has a column of that
    name, it stays, and folders are named by the first free one of _shard, __shard and so on.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    rows = _assigned(stage(_addresses(docs, id_col, text_col, whole), "addresses", compression="zstd"), limit)
    folder = _folder(docs.columns)
    (rows.select("_row.*", F.col("shard").alias(folder)).repartition(folder)
     .write.mode("overwrite").partitionBy(folder).parquet(path))


def written_shards(spark: SparkSession, path: str, schema: StructType, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``assign_shards``, from the files of ``write_shards`` of rows with this schema."""
    folder = _folder(schema.names)
    files = spark.read.schema(StructType([*schema.fields, StructField(folder, StringType())])).parquet(path)
    rows = files.select(F.col(id_col).alias("doc_id"), F.col(folder).alias("shard"),
                        F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("n_bytes"))
    sums = rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows"))
    return rows.join(sums, "shard").select("doc_id", "n_bytes", "shard", (F.length("shard") - 1).cast("int").alias("depth"),
                                           "shard_bytes", "shard_rows")
