"""Ranked lexical search by the Best Position Algorithm.

*Index.* Documents are taken in slices.  A slice keeps, for each term of the searched items, its postings (document,
occurrences), and each document's length: one staged row a slice, so that texts are read once for each block of items.  Corpus
figures (documents, their terms, documents of a term) are sums over the slices.

*Search.* Within a slice each term has an impact list: its documents by falling contribution to the score.  An item reads
its lists in parallel from the top (sorted access), and looks each new document up in all its lists (direct access), which
gives its whole score and marks its position in each of them as seen.  The best position of a list is the last one before
which all are seen, whether read or looked up.  No unseen document can score more than the sum of the contributions at the best
positions; the item stops when this sum is strictly below its k-th score, so that documents of equal score are all seen and
ties fall by id.  The k best so far are carried from slice to slice, so that later slices often stop after a few rows.

*Merge.* Every task gives at most k documents an item; they are merged in two steps.

Items are searched in blocks of about ``BLOCK_TERMS`` distinct terms; a block's terms and weights go to the tasks, so that
what is sent is bounded, and a larger set of items costs more passes, not more memory.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from annoflow.llm.common import ascii_lower, slices, stage
from annoflow.llm.words import word_strings, words_of

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Distinct terms of the items that are searched together, about.  An item's terms stay together.
BLOCK_TERMS = 32768
#: Groups of tasks whose results are merged before the last step.
MERGE_GROUPS = 256
#: Rows of each list that an item reads at first; each further step doubles them.
FIRST_READ = 8

_SLICE = T.StructType([
    T.StructField("doc_id", T.ArrayType(T.LongType())),
    T.StructField("length", T.ArrayType(T.LongType())),
    T.StructField("term", T.ArrayType(T.IntegerType())), T.StructField("at", T.ArrayType(T.IntegerType())),
    T.StructField("tf", T.ArrayType(T.IntegerType())),
])
_FOUND = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term); the texts of one item_id, null included, are one item."""
    terms = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0))
    return items.select("item_id", F.explode(terms).alias("term")).distinct()


def _blocks(wanted: DataFrame):
    """Blocks of items: (item ids, term lists), each collected by itself."""
    n_terms = wanted.select(F.count_distinct("term")).first()[0]
    n = -(-n_terms // BLOCK_TERMS)
    for b in range(n):
        mine = wanted if n == 1 else wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b)
        rows = mine.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect()
        rows.sort(key=lambda r: (r.item_id is None, r.item_id))
        if rows:
            yield [r.item_id for r in rows], [r.terms for r in rows]


def _postings(docs: DataFrame, terms: list[str]) -> DataFrame:
    """One row a slice of documents: ids (nulls last, else ascending), lengths, and postings by term, then document."""
    def part(batches):
        vocabulary = pa.array(terms, pa.large_string())
        for batch in batches:
            for lo, count in slices(batch.column("text")):
                ids = batch.column("doc_id").slice(lo, count)
                order = pc.sort_indices(ids, null_placement="at_end")
                ids = ids.take(order)
                w = words_of(batch.column("text").slice(lo, count).take(order), hashed=False)
                size = w.counts()
                known = pc.fill_null(pc.index_in(word_strings(w), value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(count), size)
                key, tf = np.unique(known[known >= 0].astype(np.int64) * count + doc[known >= 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([size], pa.list_(pa.int64())),
                    *(pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (key // count, key % count, tf))],
                    names=_SLICE.names)

    return stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(part, _SLICE), "postings")


class _Lists:
    """Impact lists of one slice: postings by (term, document), with their place in the list of their term."""

    def __init__(self, n_docs: int, n_terms: int, term, at, impact):
        keep = impact > 0
        term, at, impact = term[keep].astype(np.int64), at[keep].astype(np.int64), impact[keep]
        self.n_docs, self.key, self.impact = n_docs, term * n_docs + at, impact
        self.first = np.searchsorted(term, np.arange(n_terms + 1))
        #: Postings in the order of the lists: by term, falling impact, document.
        self.order = np.lexsort((at, -impact, term))
        self.place = np.empty(len(term), dtype=np.int64)
        self.place[self.order] = np.arange(len(term)) - self.first[term]
        self.doc = at

    def direct(self, terms: np.ndarray, docs: np.ndarray):
        """Postings of each term (rows) for each document (columns), and whether there is one."""
        want = terms[:, None] * self.n_docs + docs
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return at, self.key[at] == want


def best_positions(lists: _Lists, terms: np.ndarray, k: int, floor: int = 0) -> list[tuple[int, int]]:
    """(document, score) of all documents that may be among the k best of a slice: by falling score, ties by document.

    ``floor``: the score that k documents of earlier slices reach.  Documents below the k-th score are left out.
    """
    terms = terms[lists.first[terms + 1] > lists.first[terms]]
    if not len(terms):
        return []
    start, size = lists.first[terms], lists.first[terms + 1] - lists.first[terms]
    base = np.concatenate([[0], np.cumsum(size)])
    seen = np.zeros(int(base[-1]), dtype=bool)          # positions of all lists, one after another
    met = np.zeros(lists.n_docs, dtype=bool)
    best = np.zeros(len(terms), dtype=np.int64)         # positions of each list that are seen from its top on
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth, step = 0, FIRST_READ
    while True:
        read = np.concatenate([lists.order[s + depth:s + min(depth + step, n)] for s, n in zip(start, size)])
        new = np.unique(lists.doc[read])
        new = new[~met[new]]
        met[new] = True
        depth, step = depth + step, step * 2
        if len(new):
            at, there = lists.direct(terms, new)
            scores = np.concatenate([scores, np.where(there, lists.impact[at], 0).sum(axis=0)])
            docs = np.concatenate([docs, new])
            seen[(base[:-1, None] + lists.place[at])[there]] = True
        bound = 0
        for i, n in enumerate(size.tolist()):
            rest = seen[base[i] + best[i]:base[i + 1]]
            if len(rest):
                gap = int(rest.argmin())
                best[i] += len(rest) if rest[gap] else gap
            if best[i] < n:
                bound += int(lists.impact[lists.order[start[i] + best[i] - 1]])
        kth = max(floor, int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0)
        if bound < kth or bound == 0:
            break
    good = scores >= max(kth, 1)
    docs, scores = docs[good], scores[good]
    order = np.lexsort((docs, -scores))[:k]
    return list(zip(docs[order].tolist(), scores[order].tolist()))


def _impacts(tf: np.ndarray, weight: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Contributions of postings to the score, in 64-bit integers."""
    m = 100 - 90 + (90 * length * n_docs) // n_terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _search_block(postings: DataFrame, n_docs: int, n_terms: int, weights: np.ndarray, items: list[np.ndarray], k: int) -> DataFrame:
    def part(batches):
        top: list[list] = [[] for _ in items]  # of each item (-score, id is null, id), ascending, at most k
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("doc_id")[row].values
                length, term, at, tf = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in ("length", "term", "at", "tf"))
                if not len(term):
                    continue
                lists = _Lists(len(ids), len(weights), term, at,
                               _impacts(tf.astype(np.int64), weights[term], length[at], n_docs, n_terms))
                for i, terms in enumerate(items):
                    floor = -top[i][-1][0] if len(top[i]) == k else 0
                    found = best_positions(lists, terms, k, floor)
                    if found:
                        named = [(-score, (x := ids[d].as_py()) is None, x or 0) for d, score in found]
                        top[i] = sorted(top[i] + named)[:k]
        rows = [(i, None if null else doc_id, -score) for i, best in enumerate(top) for score, null, doc_id in best]
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(_FOUND.names, r)) for r in rows],
                                             schema=pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())]))

    return postings.mapInArrow(part, _FOUND)


def _first(found: DataFrame, k: int, *groups: str) -> DataFrame:
    w = Window.partitionBy(*groups).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents of every item: item_id, rank, doc_id, score (above 0).

    Terms are words of letters, digits and all characters beyond ASCII; only A-Z are lower-cased.  A null or empty text has none.  The
    texts of one item_id (null is one too) are one item; its terms count once.  Documents are taken row by row: repeated rows and rows of
    one id rank side by side, as many as there are; rows without an id come last among equals.  Empty tables give no
    rows.  Ids of documents are integers.  Other columns are not read.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
                           T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    out = None
    for item_ids, term_lists in _blocks(stage(item_terms(items), "item-terms")):
        vocabulary = sorted({t for terms in term_lists for t in terms})
        number = {t: i for i, t in enumerate(vocabulary)}
        own = [np.array([number[t] for t in terms], dtype=np.int64) for terms in term_lists]
        postings = _postings(docs, vocabulary)
        total = postings.select(
            F.sum(F.expr("size(filter(length, n -> n > 0))")).cast("long").alias("docs"),
            F.sum(F.expr("aggregate(length, 0L, (a, n) -> a + n)")).alias("terms")).first()
        df = dict(postings.select(F.explode("term").alias("term")).groupBy("term").count().collect())
        n_docs, n_terms = total.docs or 0, total.terms or 0
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(vocabulary))],
                           dtype=np.int64)
        found = _search_block(postings, n_docs, n_terms, weights, own, k)
        found = _first(found.withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))), k, "item", "_g").drop("rank", "_g")
        ids = spark.createDataFrame(list(enumerate(item_ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)]))
        block = _first(found, k, "item").join(ids, "item").select("item_id", "rank", "doc_id", "score")
        out = block if out is None else out.unionByName(block)
    return spark.createDataFrame([], schema) if out is None else out
