"""Export jobs: prediction inputs (C6) and translation inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annoflow.functions import text as T
from annoflow.operators.sampling import dedup_keep_first, random_sample
from annoflow.operators.topk import global_row_index
from annoflow.session import stage
from annoflow.sinks import CSV
from annoflow.sources.parsed import created_window

# Translation request size and price per block of characters.
REQUEST_ROWS = 20
PRICE_PER_BLOCK = 0.01
BLOCK_CHARS = 500


def prediction_input(parsed: DataFrame, start=None, end=None, anonymize: bool = True,
                     url_filler: str = T.URL_FILLER, user_filler: str = T.USER_FILLER) -> DataFrame:
    """C6 (F15, T1, P9, K6): statuses in [start, end], in time order, with a
    ``row_id`` that aligns the text output with the (id, created_at) output."""
    df = created_window(parsed.select("id", "created_at", "text"), start, end)
    idx = global_row_index(df.select("id", "created_at"), ["created_at", "id"], index_col="row_id")
    if anonymize:
        df = df.withColumn("text", T.anonymize_text("text", url_filler, user_filler))
    return df.join(idx.select("id", "row_id"), "id").select("row_id", "id", "created_at", "text")


def write_prediction_input(rows: DataFrame, folder: str) -> None:
    """K6: ``text`` (headerless) and ``id, created_at`` outputs, both keyed by row_id."""
    rows.select("row_id", "text").write.mode("overwrite").option("header", False).options(**CSV).csv(f"{folder}/text")
    rows.select("row_id", "id", "created_at").write.mode("overwrite").option("header", True).options(**CSV).csv(
        f"{folder}/id_created_at")


def read_prediction_input(spark: SparkSession, folder: str) -> DataFrame:
    """Both outputs of K6, aligned by row_id: row_id, id, created_at, text."""
    read = spark.read.option("multiLine", True).option("escape", '"')
    text = read.schema("row_id bigint, text string").csv(f"{folder}/text")
    ids = read.schema("row_id bigint, id string, created_at timestamp").option("header", True).csv(f"{folder}/id_created_at")
    return ids.join(text, "row_id")


def translation_rows(parsed: DataFrame, limit: int | None = None, seed: int = 0, geo_only: bool = True) -> DataFrame:
    """Id and text of geo-tagged statuses (types 1, 2) unless ``geo_only`` is off, not retweets, one row per
    cleared text; optional seeded subsample."""
    df = parsed.where(~F.col("is_retweet"))
    if geo_only:
        df = df.where(F.col("geo_type").isin(1, 2))
    df = dedup_keep_first(df.select("id", "text"), T.text_cleared("text"), ["id"])
    return df if limit is None else random_sample(df, limit, seed, strict=False)


def translation_input(parsed: DataFrame, limit: int | None = None, seed: int = 0, geo_only: bool = True) -> DataFrame:
    """C8 (F12, T9, P28): the rows to translate, in request batches of 20 rows in id order."""
    df = stage(translation_rows(parsed, limit, seed, geo_only), "translation")
    idx = global_row_index(df.select("id"), ["id"], index_col="_pos", materialized=True)
    return df.join(idx.select("id", F.floor(F.col("_pos") / REQUEST_ROWS).cast("bigint").alias("batch")), "id")


def translation_cost(rows: DataFrame) -> DataFrame:
    """Characters to translate and the price estimate."""
    n = F.sum(F.length("text"))
    return rows.agg(n.alias("n_chars"), F.round(n / BLOCK_CHARS * PRICE_PER_BLOCK, 9).alias("cost_eur"))
