import re

from annoflow.llm import licenses as L
from annoflow.llm.common import read

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    w = WORD.findall((text or "").translate(AZ))
    at = sorted((i, label) for phrase, label in L.BASE.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split())
    return len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))


def check(docs):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = L.digest(L.scan(docs)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == \
        sorted(((d, *brute(t)) for d, t in texts), key=str)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    return {r.doc_id: r for r in got}


def test_whole_table(spark):
    assert sum(r.n_base > 0 for r in check(read(spark, "/root/testdata/sf0.01", "documents")).values()) > 10


def test_templates(spark, odd, empty):
    texts = ["x y " + t.replace(" ", ", ") + " end" for _, t, _ in L.TEMPLATES]
    broken = ["permission is hereby granted free of charge to nobody at all", "source and binary forms", "MIT", "license MIT", "gnu general\npublic license",
              "gnu general public", "cc by", "cc by cc BY-NC"]
    rows = check(spark.createDataFrame(list(enumerate(texts + broken)), "doc_id long, text string"))
    for i, (label, _, _) in enumerate(L.TEMPLATES):
        assert label in rows[i].labels.split(","), label
        assert rows[i].score > 0.99
    for i in (0, 1, 3):
        assert rows[len(texts) + i].labels == ""
    check(odd.select("doc_id", "text"))
    assert L.scan(odd).count() == odd.count()
    assert L.scan(empty).count() == 0


def test_phrases_do_not_cross_documents(spark):
    rows = check(spark.createDataFrame([(1, "mit"), (2, "license apache"), (3, "license")], "doc_id long, text string").coalesce(1))
    assert {r.n_base for r in rows.values()} == {0}


def test_templates_cut_short_in_the_whole_corpus(spark):
    """Many words of the templates are in no document; what is there must be a fair share of one."""
    texts = ["under the terms of the GNU Lesser General Public License as published", "x mozilla public license y", "x licensed under CC BY-NC", "nothing of it",
             "license lesser gnu general public"]
    rows = check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [rows[i].labels for i in range(5)] == ["lgpl", "", "cc-by,cc-by-nc", "", ""]


def test_names_that_are_only_mentioned(spark):
    """A name, a quoted phrase or words of a licence in other order are no licence."""
    texts = ["we discuss the mozilla public license critically", "the gnu lesser general public license is shorter than the gnu affero general public license",
             "unencumbered software is rare", "he wrote 'redistribution and use in source and binary forms' on the wall of the room where we met",
             "creative commons attribution is a topic of this lecture", "whoever is obtaining a copy of this software should know that permission is hereby granted free of charge",
             "software this of copy a obtaining person any to charge of free granted hereby is permission"] * 3 + ["plain words " * 40] * 30
    rows = check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [rows[i].labels for i in range(len(texts)) if rows[i].labels not in ("", rows[i].base_labels)] == []


def test_edited_licences(spark):
    """Whole texts with a tenth of the words replaced, dropped or added, key phrases aside, keep their label."""
    import random

    rng = random.Random(3)
    long = [(label, t, keys) for label, t, keys in L.TEMPLATES if len(t.split()) > 40]
    assert {x for x, _, _ in long} >= {"mit", "bsd", "bsd-3-clause", "isc", "apache-2.0", "zlib", "unlicense", "gpl", "lgpl", "agpl"}
    made = []
    for label, t, keys in long:
        for _ in range(4):
            w = t.split()
            safe = {j + x for k in keys for j in range(len(w)) if w[j:j + len(k.split())] == k.split() for x in range(len(k.split()))}
            out = []
            for i, x in enumerate(w):
                r = rng.random()
                if i in safe or r > 0.1:
                    out.append(x)
                elif r < 0.04:
                    out.append("edited")
                elif r < 0.07:
                    out += [x, "more"]
            made.append((label, "Some file. " * 5 + " ".join(out) + " int main"))
    rows = check(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(made)] + [(1000 + i, "plain words " * 30) for i in range(60)], "doc_id long, text string"))
    assert [label for i, (label, _) in enumerate(made) if label not in rows[i].labels.split(",")] == []
