"""Against a comparison of all pairs of lines."""

import random
import re

from annoflow.llm import line_dedup as L
from annoflow.llm.common import read

GAP = re.compile(r"[\x20\x09-\x0D]+")


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    """doc_id (unique) -> removed places."""
    lines = []
    for d, t in sorted(docs, key=lambda r: (r[0] is None, r[0])):
        for i, x in enumerate((t or "").split("\n")):
            w = [y for y in GAP.split(x) if y]
            if w:
                lines.append((d, i, w))
    seen, by_size, gone = set(), {}, {d: [] for d, _ in docs}
    for d, i, w in lines:
        n = len(w)
        # four words in five agree: one edit, and the longer line has five words
        near = any(within_one(w, v) for m in (n - 1, n, n + 1) if max(m, n) >= 5 for v in by_size.get(m, ()))
        if tuple(w) in seen or near:
            gone[d].append(i)
        if tuple(w) not in seen:
            seen.add(tuple(w))
            by_size.setdefault(n, []).append(w)
    return gone


def check(docs, **options):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    texts = dict(rows)
    got = L.dedup_lines(docs, **options).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.removed_lines == want[r.doc_id], r.doc_id
        t = texts[r.doc_id]
        assert r.text == (None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in set(r.removed_lines)))
    return want


def test_whole_table(spark, sf001):
    assert sum(map(bool, check(read(spark, sf001, "documents")).values())) > 5


def test_edits(spark):
    w = [f"w{i}" for i in range(30)]

    def line(x):
        return " ".join(x)

    made = [line(w), line(w[:7] + ["x"] + w[8:]), line(w[:29]), line(w + ["more"]), line(w[1:]), line(w[:3] + ["a", "b"] + w[5:]),
            line(w[:19]), line(w[:20]), line(w[:18] + ["q"]), "a b c d", "a b c d", "a b c d e", "a  b c\td e", "", "x\n\n" + line(w[:20]),
            line(["z"] + w), line(w[:15] + ["z"] + w[15:]), line(w[:15] + ["z", "y"] + w[15:])]
    check(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string"))
    for rows in (3, 0):  # words fetched by a broadcast, and by a shuffle
        check(spark.createDataFrame(list(enumerate(reversed(made))), "doc_id long, text string"), broadcast_rows=rows)


def test_short_lines(spark):
    """Repeats of any line with a word go; one word may differ from five words on."""
    made = ["a", "a", "b", "a b", "a b", "", " ", "a b c d", "a b c x", "a b c d e", "a b c", "p q r s t", "p q x s t", "p q r s", "q r s t", "p q r s t u v",
            "p q r s t u", "k l m n", "k l m", "k l m n o"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "doc_id long, text string")
    want = check(docs)
    assert {made[i] for i, x in want.items() if x} == {"a", "a b", "a b c d e", "p q x s t", "p q r s", "q r s t", "p q r s t u", "k l m n o"}
    check(spark.createDataFrame([(0, "\n".join(made)), (1, "\n".join(reversed(made)))], "doc_id long, text string"))


def test_short_random_lines(spark):
    rng = random.Random(2)
    made = ["\n".join(" ".join(rng.choices("abc", k=rng.randint(0, 8))) for _ in range(6)) for _ in range(150)]
    check(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string"))


def test_many_lines_around_one(spark):
    """Hundreds of lines that differ in one word each share a variant."""
    w = [f"w{i}" for i in range(25)]
    made = [" ".join(w[:i % 25] + [f"v{i}"] + w[i % 25 + 1:]) + "\nown line number " + str(i) + " of this text" for i in range(300)]
    want = check(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string"))
    assert sum(0 in x for x in want.values()) >= 275


def test_odd_rows(spark, odd, empty):
    got = L.dedup_lines(odd).collect()
    assert len(got) == odd.count()
    assert {r.text for r in got if r.doc_id == 2} == {None}
    assert {r.text for r in got if r.doc_id == 3} == {""}
    assert L.dedup_lines(odd).columns == [*odd.columns, "removed_lines"]
    assert L.dedup_lines(empty).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f g")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.text) for r in L.dedup_lines(nulls).collect()) == [(False, "a b c d e f"), (True, ""), (True, "")]
