"""Benchmark decontamination (operator 1): a prefix-filtered set join.

A benchmark item gives windows of ``window`` consecutive words (an item of fewer
words is one window).  A window is the set of its shingles, and it is contained in
a document if its words stand there consecutively.  Containment asks for every
shingle, so with the shingles of a window ordered by rarity over the whole corpus
one prefix shingle, the rarest, is necessary: the join is on it alone.  Bounds on
position and length drop matches whose window would begin before or end behind the
document, and the words around the match decide exactly.

Memory: the only broadcast is a Bloom filter of ``BLOOM_BITS`` bits, whatever the
size of the benchmark.  Windows and their items stay distributed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from annoflow.llm.common import row_key, slices, stage
from annoflow.llm.words import shingle_hashes, words_of

WINDOW, SHINGLE = 10, 5

#: Fixed size of the filter that keeps shingles no window has out of the shuffle
#: (4 MB as bytes).  False positives cost time only.
BLOOM_BITS = 1 << 25


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(39)).astype(np.int64)


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per (item, distinct window): item_id, window (words, spaced), n (its words),
    shingles array<struct<h, offset>>.  Items without words have none."""

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, n in slices(texts):
                w = words_of(texts.slice(lo, n))
                by_k = {}
                rows = []
                for t in range(n):
                    a, b = int(w.first[t]), int(w.first[t + 1])
                    size = min(window, b - a)
                    k = min(shingle, size)
                    if not size:
                        continue
                    if k not in by_k:
                        h, at = shingle_hashes(w, k)
                        by_k[k] = dict(zip(at.tolist(), h.view(np.int64).tolist()))
                    seen = set()
                    for s in range(a, b - size + 1):
                        text = w.text(s, s + size)
                        if text not in seen:
                            seen.add(text)
                            rows.append((ids[lo + t].as_py(), text, size,
                                         [{"h": by_k[k][s + j], "offset": j} for j in range(size - k + 1)]))
                if rows:
                    c = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[0], pa.string()), pa.array(c[1], pa.string()), pa.array(c[2], pa.int32()),
                         pa.array(c[3], pa.list_(pa.struct([("h", pa.int64()), ("offset", pa.int32())])))],
                        names=["item_id", "window", "n", "shingles"])

    return benchmark.mapInArrow(run, "item_id string, window string, n int, shingles array<struct<h:bigint,offset:int>>")


def _bloom(windows: DataFrame) -> np.ndarray:
    """The filter over all shingles of all windows: bits are or-ed in tasks, then merged by slot range."""
    def bits(batches):
        seen = np.zeros(BLOOM_BITS, dtype=bool)
        for b in batches:
            seen[_slots(b.column(0).to_numpy().view(np.uint64))] = True
        at = np.flatnonzero(np.packbits(seen))
        for lo in range(0, len(at), 1 << 16):
            part = at[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array(np.packbits(seen)[part].astype(np.int32), pa.int32())],
                names=["byte", "bits"])

    merged = (windows.select(F.explode("shingles.h").alias("h")).mapInArrow(bits, "byte long, bits int")
              .groupBy("byte").agg(F.bit_or("bits").alias("bits")))
    packed = np.zeros(BLOOM_BITS // 8, dtype=np.uint8)
    got = merged.toArrow()  # at most BLOOM_BITS / 8 rows
    packed[got["byte"].to_numpy()] = got["bits"].to_numpy().astype(np.uint8)
    return packed


def _shingle_counts(docs: DataFrame, filt, ks: list[int]) -> DataFrame:
    """Occurrences over all documents of the shingles that pass the filter."""
    def run(batches):
        bloom = np.unpackbits(filt.value).view(bool)
        for batch in batches:
            for lo, n in slices(batch.column(0)):
                w = words_of(batch.column(0).slice(lo, n))
                for k in ks:
                    h, _ = shingle_hashes(w, k)
                    u, c = np.unique(h[bloom[_slots(h)]], return_counts=True)
                    if len(u):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(u.view(np.int64)), pa.array(c.astype(np.int64))], names=["h", "c"])

    return docs.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _document_matches(docs: DataFrame, filt, ks: list[int], window: int) -> DataFrame:
    """For each document a row with its word count and a null h; for each shingle that passes
    the filter a row with its place and the words around it, as far as a window can reach."""
    schema = pa.schema([("_k1", pa.int64()), ("_k2", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("h", pa.int64()),
                        ("at", pa.int64()), ("before", pa.int32()), ("around", pa.string())])

    def run(batches):
        bloom = np.unpackbits(filt.value).view(bool)
        for batch in batches:
            *keys, texts = batch.columns
            for lo, n in slices(texts):
                w = words_of(texts.slice(lo, n))
                counts = w.counts()
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, n) for c in keys), pa.array(counts.astype(np.int64)), none, none,
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())], schema=schema)
                for k in ks:
                    h, at = shingle_hashes(w, k)
                    hit = np.flatnonzero(bloom[_slots(h)])
                    if not len(hit):
                        continue
                    h, at = h[hit], at[hit]
                    t = np.searchsorted(w.first, at, side="right") - 1
                    left = np.maximum(at - (window - k), w.first[t])
                    right = np.minimum(at + window, w.first[t + 1])
                    around = [w.text(a, b) for a, b in zip(left.tolist(), right.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [*(c.take(pa.array(lo + t)) for c in keys), pa.array(counts[t].astype(np.int64)),
                         pa.array(h.view(np.int64)), pa.array(at - w.first[t]),
                         pa.array((at - left).astype(np.int32)), pa.array(around, pa.string())], schema=schema)

    return docs.mapInArrow(run, "_k1 long, _k2 long, doc_id long, n_words long, h long, at long, before int, around string")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside any occurrence of a
    window), item_ids (sorted array of items with occurring windows, as strings).

    Null and empty texts have no words and no hits.  Rows are told apart by id and text, null
    ids included, so repeated rows get equal results.  Items without words or without an id give no window; items with equal windows all
    count.  An empty benchmark or an empty table gives zero hits or no rows.  Other columns are
    not read.
    """
    return keyed_contamination(docs, benchmark, window, shingle, id_col, text_col, item_col, item_text_col).drop("_k1", "_k2")


def keyed_contamination(docs, benchmark, window=WINDOW, shingle=SHINGLE, id_col="doc_id", text_col="text",
                        item_col="item_id", item_text_col="text"):
    """``contamination`` with the row's key (``row_key`` of id and text) as _k1 and _k2."""
    spark = docs.sparkSession
    per_item = stage(item_windows(benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string"), F.col(item_text_col).cast("string")),
                                  window, shingle), "windows")
    windows = per_item.groupBy("window").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    ks = sorted(r[0] for r in per_item.select(F.least(F.lit(shingle), "n").alias("k")).distinct().collect())  # at most `shingle` rows
    filt = spark.sparkContext.broadcast(_bloom(per_item))
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    counts = _shingle_counts(texts, filt, ks)
    shingles = windows.select("window", "n", F.explode("shingles").alias("s")).select("window", "n", "s.h", "s.offset")
    # A shingle that no document has makes its window impossible: the inner minimum below
    # is over counted shingles, and absent ones count 0 and come first.
    rarest = (shingles.join(counts, "h", "left")
              .groupBy("window", "n")
              .agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "h", "offset")).alias("p")))
    prefix = stage(rarest.where("p.c > 0").select("window", "n", "p.h", "p.offset"), "prefixes")
    found = stage(_document_matches(
        docs.select(*row_key(id_col, text_col), F.col(id_col).cast("long").alias("doc_id"),
                    F.col(text_col).cast("string").alias("text")), filt, ks, window), "matches")
    at = F.col("at") - F.col("offset")
    hits = (found.where("h is not null").join(prefix, "h")
            .where((at >= 0) & (at + F.col("n") <= F.col("n_words")))  # position and length bounds
            .where(F.expr("array_join(slice(split(around, ' '), before - offset + 1, n), ' ')") == F.col("window"))
            .select("_k1", "_k2", at.alias("start"), (at + F.col("n")).alias("end"), "window"))
    hits = stage(hits, "hits")
    # An interval adds the words behind everything that began before it.
    covered = (hits.groupBy("_k1", "_k2", "start").agg(F.max("end").alias("end"))
               .withColumn("done", F.expr("max(end) over (partition by _k1, _k2 order by start "
                                          "rows between unbounded preceding and 1 preceding)"))
               .groupBy("_k1", "_k2").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest(
                   F.col("start"), F.coalesce("done", F.lit(0))))).alias("n_hit")))
    items = (hits.select("_k1", "_k2", "window").distinct().join(per_item.select("window", "item_id"), "window")
             .groupBy("_k1", "_k2").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")))
    return (found.where("h is null").select("_k1", "_k2", "doc_id", "n_words")
            .join(covered, ["_k1", "_k2"], "left").join(items, ["_k1", "_k2"], "left")
            .select("_k1", "_k2", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
