"""SimHash near-dedup (operator 8) with vantage-point trees.

Fingerprints are 64 bits; bit b is set if it is set in over half of the XXH64 hashes (seed 42) of the
text's word shingles.  Distinct fingerprints are dealt to shards, the leaves of a
vantage-point tree: a node splits at a radius around its vantage point.  A fingerprint
is a member of one leaf, and a visitor wherever the triangle inequality does not rule out a member
within the distance: for a member x and a visitor y, |d(x, p) - d(y, p)| <= d(x, y).  So every close
pair meets in the leaf of one of the two.  Inside a leaf the members are ordered by
distance from a vantage point of their own, which bounds the range each has to be compared
with.  Leaves give spanning links, not all pairs, and components are joined by alternating large
and small stars on Spark.

The tree is fitted on a bounded sample (``SAMPLE`` distinct fingerprints, lowest by hash); it only
decides where pairs meet.  Every fingerprint is routed, and the result is exact for any tree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from annoflow.llm.common import row_key, stage

SHINGLE, DISTANCE = 3, 2
SAMPLE = 1 << 14
LEAF = 1024          # members a leaf should have
BLOCK = 512          # members compared at once inside a leaf


def text_fingerprint(text: str | None, k: int = SHINGLE) -> int:
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z, and only space and \t to \r
    if not words:
        return 0
    if len(words) <= k:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    lo = np.concatenate([[0], ends[:-k] + 1]).tolist()
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    count, n = np.zeros(64, dtype=np.int64), len(words) - k + 1
    hi = ends[k - 1:].tolist()
    for a in range(0, n, 1 << 16):
        h = np.array([digest(view[s:e], 42) for s, e in zip(lo[a:a + (1 << 16)], hi[a:a + (1 << 16)])], dtype=np.uint64)
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * count > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """_k1, _k2 (row key), doc_id, fp (the 64 bits as a signed long)."""
    def run(batches):
        for b in batches:
            fp = np.array([text_fingerprint(t, shingle) for t in b.column(3).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(fp.view(np.int64))],
                                             names=["_k1", "_k2", "doc_id", "fp"])

    d = docs.select(*row_key(id_col, text_col), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    return d.mapInArrow(run, "_k1 long, _k2 long, doc_id long, fp long")


class VantageTree:
    """Nodes (vantage point, radius, inside, outside); a negative child -1 - i is leaf i."""

    def __init__(self, sample: np.ndarray, leaf: float, distance: int):
        self.distance, self.nodes, self.leaves = distance, [], 0
        self.root = self._build(np.sort(sample), leaf)

    def _build(self, part: np.ndarray, leaf: float) -> int:
        best = None
        if len(part) > max(leaf, 2):
            for p in part[np.linspace(0, len(part) - 1, 16).astype(int)]:
                count = np.bincount(np.bitwise_count(part ^ p), minlength=68)
                below = np.cumsum(count)
                for r in np.flatnonzero(count)[:-1].tolist():
                    share = below[r] / len(part)
                    # What a split costs: fingerprints in the band that have to visit the other side, and imbalance.
                    band = (below[min(67, r + self.distance)] - below[max(0, r - self.distance)]) / len(part)
                    cost = band + 4 * max(0.0, abs(share - 0.5) - 0.15)
                    if best is None or cost < best[0]:
                        best = (cost, p, r)
        if best is None:
            self.leaves += 1
            return -self.leaves
        _, p, r = best
        at = len(self.nodes)
        self.nodes.append(None)
        d = np.bitwise_count(part ^ p)
        self.nodes[at] = (p, r, self._build(part[d <= r], leaf), self._build(part[d > r], leaf))
        return at

    def route(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into fp, leaf, member?) of every place each fingerprint goes to."""
        out, todo = [], [(self.root, np.arange(len(fp)), np.ones(len(fp), dtype=bool))]
        while todo:
            node, at, member = todo.pop()
            if not len(at):
                continue
            if node < 0:
                out.append((at, np.full(len(at), -1 - node, dtype=np.int32), member))
                continue
            p, r, inside, outside = self.nodes[node]
            d = np.bitwise_count(fp[at] ^ p).astype(np.int64)
            # A member visits the inside if it lies outside, near the border; the other half of the
            # pair then need not visit.  A visitor goes wherever a member can be within the distance.
            i = d <= r + self.distance
            o = np.where(member, d > r, d > r - self.distance)
            todo.append((inside, at[i], member[i] & (d[i] <= r)))
            todo.append((outside, at[o], member[o]))
        return tuple(np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else ([], [], [])))


def _roots(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (each the smallest index of its set) after joining the sets of i and j."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def leaf_links(members: np.ndarray, visitors: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the graph of pairs (member, member) and (member, visitor) within the distance."""
    fp = np.concatenate([members, visitors])
    if not len(members):
        return fp[:0], fp[:0]
    d = np.bitwise_count(fp ^ members[0]).astype(np.int64)
    order = np.argsort(d, kind="stable")
    fp, d = fp[order], d[order]
    own = np.flatnonzero(order < len(members))
    label = np.arange(len(fp))
    for a in range(0, len(own), BLOCK):
        rows = own[a:a + BLOCK]
        lo = np.searchsorted(d, d[rows[0]] - distance, side="left")
        hi = np.searchsorted(d, d[rows[-1]] + distance, side="right")
        for c in range(lo, hi, 1 << 14):
            near = np.bitwise_count(fp[rows, None] ^ fp[None, c:min(hi, c + (1 << 14))]) <= distance
            i, j = np.nonzero(near)
            i, j = rows[i], j + c
            label = _roots(label, i[i != j], j[i != j])
    at = np.flatnonzero(label != np.arange(len(fp)))
    return fp[at], fp[label[at]]


def links(distinct: DataFrame, distance: int = DISTANCE, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """Links (u, v), u > v, whose components are those of all pairs of ``distinct.fp`` within the distance."""
    spark = distinct.sparkSession
    n = distinct.count()
    got = distinct.orderBy(F.xxhash64("fp"), "fp").limit(sample).toArrow()["fp"].to_numpy().view(np.uint64)
    tree = spark.sparkContext.broadcast(VantageTree(got, leaf * min(1.0, sample / max(n, 1)), distance))

    def route(batches):
        for b in batches:
            fp = b.column(0).to_numpy()
            at, to, member = tree.value.route(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), pa.array(fp[at]), pa.array(member.astype(bool))],
                                             names=["leaf", "fp", "member"])

    def pairs(table: pa.Table) -> pa.Table:
        fp = table["fp"].to_numpy().view(np.uint64)
        member = table["member"].to_numpy()
        a, b = (x.view(np.int64) for x in leaf_links(fp[member], fp[~member], distance))
        return pa.table({"u": np.maximum(a, b), "v": np.minimum(a, b)})

    routed = distinct.mapInArrow(route, "leaf int, fp long, member boolean")
    return routed.groupBy("leaf").applyInArrow(pairs, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): v is the smallest node of u's component; for u that are not smallest themselves.

    Alternating large and small stars (Kiveris et al. 2014) until the links no longer change.
    """
    def mark(e):
        r = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        return tuple(r)

    now = stage(edges, "links")
    seen = mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now, was = stage(small, "small"), seen
        seen = mark(now)
        if seen == was:
            break
    return now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (smallest doc_id reachable over links of at most
    ``distance`` differing bits, its own included).

    Null and empty texts, and texts of white space, have fingerprint 0 and link like any
    other.  A null id is never the smallest unless all are null.  Repeated rows keep a row each.
    An empty table gives no rows.  Other columns are not read.
    """
    return keyed_near_duplicates(docs, id_col, text_col, shingle, distance).drop("_k1", "_k2", "root")


def keyed_near_duplicates(docs, id_col="doc_id", text_col="text", shingle=SHINGLE, distance=DISTANCE):
    """``near_duplicates`` with the row's key (of id and text) as _k1 and _k2, and root, the smallest fingerprint of the
    component: unlike component_id, which may be null or shared by repeated ids, it names one component only."""
    prints = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), distance))
    rooted = (distinct.join(roots.select(F.col("u").alias("fp"), "v"), "fp", "left")
              .select("fp", "least", F.coalesce("v", "fp").alias("root")))
    rooted = stage(rooted, "roots")
    classes = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp").select("_k1", "_k2", "doc_id", "fp", "root", "component_id")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
