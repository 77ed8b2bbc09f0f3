"""Raw status lines -> one flat, deduplicated, geo-enriched table with
reply / quote / retweet counts, partitioned by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoflow.functions import status as S
from annoflow.functions.text import with_token_count
from annoflow.operators import geo, interactions
from annoflow.schema import PARSED
from annoflow.session import stage
from annoflow.sources.raw import parse_lines


def top_level_log(firsts: DataFrame) -> DataFrame:
    """A1 input: interactions of top-level statuses (reply, quote unless retweet, retweet).

    Read from the deduplicated top-level copies (before the F1 gate): a status
    collected twice is counted once, and this branch shares the dedup shuffle
    with the record branch instead of parsing the input again.
    """
    c = F.col("c")
    return interactions.interaction_log(firsts.where(c["priority"] == 0).select(
        c["id_str"].alias("id"),
        c["in_reply_to_status_id"].alias("in_reply_to_status_id"),
        c["quoted"]["id_str"].alias("quoted_status_id"),
        c["retweeted"]["id_str"].alias("retweeted_status_id")))


def dedup_copies(ok: DataFrame) -> DataFrame:
    """One copy per status id, of lines with their copies; top-level beats embedded, then the earliest
    (day, file, line hash).  An aggregate, so the millions of embedded copies of
    a viral original collapse map-side."""
    cp = ok.select("day", "source_file", "line_hash", F.explode("raw").alias("c")).where(F.col("c").isNotNull())
    best = cp.groupBy(F.col("c.id_str").alias("_id")).agg(
        F.min(F.struct(F.col("c.priority").alias("p"), "day", "source_file", "line_hash", "c")).alias("w"))
    return best.select(F.col("w.c").alias("c"), F.struct("w.p", "w.day", "w.source_file", "w.line_hash").alias("_origin"))


def parse(lines: DataFrame, keywords=(), countries: DataFrame | None = None, gazetteer: DataFrame | None = None,
          extract_retweets: bool = True, extract_quotes: bool = True) -> tuple[DataFrame, DataFrame]:
    """Parse ``lines`` (value, source_file, day) into parsed statuses.

    Returns (parsed, quarantine).  Parsed rows follow :data:`PARSED` plus
    ``created_day`` (the partition column).
    """
    parsed, _log, bad = parse_with_log(lines, keywords, countries, gazetteer, extract_retweets, extract_quotes)
    return parsed, bad


def parse_with_log(lines: DataFrame, keywords=(), countries: DataFrame | None = None,
                   gazetteer: DataFrame | None = None, extract_retweets: bool = True,
                   extract_quotes: bool = True, keep_origin: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As :func:`parse`, also returning the distinct interaction log of the lines.

    ``keep_origin`` adds ``_origin``, by which copies of a status are ordered (W1), and leaves the counts out: the merge of a
    batch counts the store's whole log.  The distinct copies are stored, as the log and the records are read from them, and so
    are the counts: few ones are then broadcast, and no record is shuffled.
    """
    ok, bad = parse_lines(lines.withColumn("line_hash", F.md5("value")), S.copies)
    firsts = stage(dedup_copies(ok), "copies")
    log = top_level_log(firsts)
    kept = firsts.where(S.extraction_gate(extract_retweets, extract_quotes))
    origin = ["_origin"] if keep_origin else []
    rec = kept.select(*S.extract_columns(keywords), *origin)
    rec = with_token_count(rec, "text")
    if not keep_origin:
        rec = interactions.attach_counts(rec, stage(interactions.count_interactions(log), "counts"))
    if countries is not None:
        # each branch of the enrichment reads the rows: parse once
        rec = geo.enrich(stage(rec, "records"), geo.prepare_countries(countries), gazetteer)
    else:
        rec = geo.basics(rec)
    out = rec.select(*[F.col(f.name).cast(f.dataType) for f in PARSED.fields if f.name in rec.columns], *origin)
    return out.withColumn("created_day", F.to_date("created_at")), log, bad


def write_parsed(parsed: DataFrame, path: str) -> None:
    """K1: one partition per created day, each file's rows sorted by time; reruns replace
    only the days present in the frame (dynamic partition overwrite)."""
    # A rebalance gathers days like a repartition, but AQE splits a day that is too large for a task.
    (parsed.hint("rebalance", "created_day").sortWithinPartitions("created_day", "created_at")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("created_day").parquet(path))
