"""Periodic runs of words: seed and extend along the diagonals of a document.

A run is a stretch of consecutive words whose smallest period is q, at least max(6, 4 * q) words
long, that no neighbouring word extends keeping the period.  A stretch of l words with period q is
a diagonal of l - q pairs (i, i + q) of equal words, and so at least 3 * q of them (5, if q is 1).

*Seeds.* Periods are searched by classes [2^j, 2^(j+1)).  A class indexes the grams of the overlap
that its least period guarantees: 5 words for the period 1, else 3 * 2^j.  Such a gram is longer than
any period of its class, so that within a run its next occurrence is exactly one period on (an earlier
one would give the run a smaller period, by the theorem of Fine and Wilf).  Enumerating for each
occurrence the next one in the document is therefore complete, and linear in the document: a
gram that occurs a thousand times gives 999 pairs.  A gram can recur only where the shorter
gram of the class before recurs, so that classes after the first look at few words.

*Extension.* A seed (i, q) is extended to both sides, word by word, unless the furthest word covered
so far on the diagonal of lag q lies beyond it.

Grams are found by 64-bit hashes; each run is made of words that were compared themselves.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from annoflow.llm.common import slices

#: A run has at least this many words, and this many times its period.
MIN_WORDS, MIN_TIMES = 6, 4

_MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (a >> np.uint64(29))) * _MIX1 + (b ^ (b >> np.uint64(32))) * _MIX2
    return h ^ (h >> np.uint64(31))


def _recurring(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the grams with hashes ``h`` at places ``at`` (ascending): the pairs of each occurrence and the next one."""
    # Slots of a table with a single gram cannot hold a recurring one: they are left out of the sort.
    bits = max(8, int(len(h)).bit_length() + 2)
    slot = (h >> np.uint64(64 - bits)).astype(np.int64)
    often = np.bincount(slot, minlength=1)[slot] > 1
    h, at = h[often], at[often]
    if not len(h):
        return at, at
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    first, then = at[order][:-1][same], at[order][1:][same]
    back = np.argsort(first)
    return first[back], then[back]


def _matched(w: np.ndarray, i: int, q: int) -> int:
    """The first place from i on where the words q apart differ."""
    n, step = len(w) - q, 64
    while i < n:
        stop = min(n, i + step)
        differ = w[i:stop] != w[i + q:stop + q]
        k = int(differ.argmax())
        if differ[k]:
            return i + k
        i, step = stop, step * 2
    return n


def _matched_back(w: np.ndarray, i: int, q: int) -> int:
    """The start of the stretch of equal pairs that ends before i."""
    step = 64
    while i > 0:
        lo = max(0, i - step)
        differ = (w[lo:i] != w[lo + q:i + q])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            return i - k
        i, step = lo, step * 2
    return 0


def runs(w: np.ndarray, min_words: int = MIN_WORDS, min_times: int = MIN_TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the word numbers ``w``, by start, then period.

    ``min_times`` must be 3 or more: for a run of at least 3 periods the gram of its class is as long as its period
    (the argument above).
    """
    if min_times < 3:
        raise ValueError("runs of fewer than three periods are not found by these seeds")
    n = len(w)
    found: list[tuple[int, int, int]] = []
    if n < min_words:
        return found
    # gram[j]: hash of the 2^j words from a place on; a gram of any length is two of these, overlapping.
    gram = [w.astype(np.uint64) * _MIX2 + _MIX1]
    places = np.arange(n)
    low = 1
    while low * min_times <= n:
        # Least overlap of this class and of all later ones: it never falls from class to class.
        k = min(max(min_words - q, (min_times - 1) * q) for q in range(low, max(low + 1, min_words)))
        while (2 << (len(gram) - 1)) <= k:
            half = 1 << (len(gram) - 1)
            gram.append(_pair(gram[-1][:-half], gram[-1][half:]))
        top = k.bit_length() - 1
        places = places[places <= n - k]
        if not len(places):
            break
        g, shift = gram[top], k - (1 << top)
        first, then = _recurring(_pair(g[places], g[places + shift]), places)
        if not len(first):
            break
        lag = then - first
        mine = (lag >= low) & (lag < 2 * low)
        furthest: dict[int, int] = {}
        for i, q in zip(first[mine].tolist(), lag[mine].tolist()):
            if i < furthest.get(q, 0):
                continue
            end = _matched(w, i, q)
            if end == i:  # equal hashes of unequal grams
                continue
            furthest[q] = end
            start = _matched_back(w, i, q)
            length = end + q - start
            if length >= max(min_words, min_times * q):
                found.append((start, length, q))
        places = np.union1d(first, then)
        low *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those that no run contains after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, length, q in found:
        edge[start + q] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers."""
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """The contract's planted repeats: for each word the original word to take its place, for one id in ten."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)),
                       T.StructField("collapsed", T.StringType())])


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """Per document: doc_id, runs (start, length, period; by start, then period) and the collapsed text.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; the collapsed text has those that stay, joined by one space.  A
    null or empty text has no runs and collapses to the empty text.  Documents are taken row by row: repeated rows
    and null ids give a row each, other columns are not read.  Ids are integers.  ``plant`` first puts the contract's repeats into the
    words of documents that have an id.
    A task holds one slice of documents; one document's words must fit into a task.
    """
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def part(batches):
        for batch in batches:
            texts = batch.column("text")
            for lo, count in slices(texts):
                ids = batch.column("doc_id").slice(lo, count)
                all_runs, collapsed = [], []
                for doc_id, text in zip(ids.to_pylist(), texts.slice(lo, count).to_pylist()):
                    words = (text or "").encode().split()
                    taken = planted(len(words), doc_id) if plant else None
                    if taken is not None:
                        words = [words[i] for i in taken.tolist()]
                    found = runs(word_numbers(words))
                    if found:
                        words = [words[i] for i in np.flatnonzero(kept_words(len(words), found)).tolist()]
                    all_runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    collapsed.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(all_runs, kind), pa.array(collapsed, pa.string())],
                                                 names=["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(part, SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """The query's columns: count, greatest run, and digests of the runs and of the collapsed text."""
    r = F.col("runs")
    # The greatest run: by length, then smallest start, then smallest period.
    best = F.array_max(F.transform(r, lambda x: F.struct(x["length"].alias("l"), (-x["start"]).alias("s"), (-x["period"]).alias("p"))))
    lines = F.transform(r, lambda x: F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size(r) > 0, "\n").otherwise(""))
    return found.select("doc_id", F.size(r).cast("long").alias("n_runs"), best.alias("b"), "collapsed", listed.alias("listed")).select(
        "doc_id", "n_runs", (-F.col("b.s")).alias("start"), F.col("b.l").alias("length"), (-F.col("b.p")).alias("period"),
        F.expr("(1000 * b.l) div (-b.p)").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
