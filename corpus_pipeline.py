"""A corpus cleaned, deduplicated, decontaminated and encoded: five stages, each one of the operators.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each as Parquet in the
shared folder and rereads it for the next one.  All but the last return the columns of
``documents``.  Null ids and texts, repeated rows and empty tables are handled as the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from annoflow.llm import decontamination, line_dedup, pieces, quality, simhash
from annoflow.llm.common import read, row_key, stage
from annoflow.llm.queries import _batches, tokenizer


def _keep(docs: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """Rows of docs whose key (of the columns) is among the keys."""
    k1, k2 = row_key(*columns)
    return (docs.withColumns({"_k1": k1, "_k2": k2}).join(keys.select("_k1", "_k2").distinct(), ["_k1", "_k2"], "left_semi")
            .select(*docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    judged = quality.keyed_judge(docs)
    return _keep(docs, judged.where("kept"), "doc_id", "text", "lang", "source")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one has; n_chars is counted anew."""
    out = line_dedup.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of smallest id (null last), of equal ids that of
    smallest key; of repeated rows one."""
    _batches(spark)
    found = simhash.keyed_near_duplicates(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "_k1", "_k2")).alias("f")
    # Not by component_id: it is null where no id is known, and components share it where ids repeat.
    kept = found.groupBy("root").agg(first).select("f._k1", "f._k2")
    k1, k2 = row_key("doc_id", "text")
    one = docs.withColumns({"_k1": k1, "_k2": k2}).join(kept, ["_k1", "_k2"], "left_semi")
    return one.dropDuplicates(["_k1", "_k2"]).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    _batches(spark)
    found = decontamination.keyed_contamination(docs, read(spark, sf_dir, "benchmark"))
    return _keep(docs, found.where("n_hit = 0"), "doc_id", "text")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every remaining document, as digests."""
    _batches(spark)
    return pieces.digest(pieces.encode_documents(docs, tokenizer(pieces.MODEL)))


STAGES = [("quality rules", quality_rules), ("line dedup", dedup_lines), ("simhash near-dedup", dedup_documents),
          ("benchmark decontamination", decontaminate), ("sentencepiece", encode_pieces)]

#: Tokenizers cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
