"""Each stage against what the operators' brute forces say of its own input."""

import corpus_pipeline as C
from annoflow.llm.common import read
from test_decontamination import brute as contaminated
from test_line_dedup import brute as repeated
from test_simhash import classes, fingerprint


def test_stages(spark, sf001):
    docs = read(spark, sf001, "documents")
    assert [n for n, _ in C.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination", "sentencepiece"]
    labels = {r.doc_id: r.quality for r in read(spark, sf001, "labels").collect()}
    good = C.quality_rules(spark, docs, sf001)
    assert good.columns == docs.columns
    ids = {r.doc_id for r in good.collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    for d in text:
        if labels.get(d) == 1 and len((text[d] or "").split()) >= 60:
            assert d in ids
    lines = C.dedup_lines(spark, good, sf001).cache()
    gone = repeated([(r.doc_id, r.text) for r in good.collect()])
    for r in lines.collect():
        assert r.text == "\n".join(x for i, x in enumerate(text[r.doc_id].split("\n")) if i not in set(gone[r.doc_id]))
        assert r.n_chars == len(r.text)
    one = C.dedup_documents(spark, lines, sf001)
    assert one.columns == docs.columns
    rows = sorted((r.doc_id, r.text) for r in lines.collect())
    at = classes([fingerprint(t) for _, t in rows])
    assert sorted(r.doc_id for r in one.collect()) == sorted(rows[i][0] for i in set(at.tolist()))
    clean = C.decontaminate(spark, one, sf001)
    items = [tuple(r) for r in read(spark, sf001, "benchmark").select("item_id", "text").collect()]
    want = sorted(r[0] for r in contaminated([(r.doc_id, r.text) for r in one.collect()], items) if not r[5])
    assert sorted(r.doc_id for r in clean.collect()) == want
    assert sorted(r.doc_id for r in C.encode_pieces(spark, clean, sf001).collect()) == want
    assert sorted(r.doc_id for r in C.run(spark, sf001).collect()) == want


def test_odd_and_empty(spark, odd, empty, sf001):
    for name, stage in C.STAGES:
        for docs in (odd, empty):
            out = stage(spark, docs, sf001)
            n = out.count()
            assert n <= docs.count()
            if name != "sentencepiece":
                assert out.columns == docs.columns
    once = C.dedup_documents(spark, odd, sf001).collect()
    assert sum(r.text == "one two three" for r in once) == 1


def test_unlike_texts_without_an_id_or_of_one_id(spark, sf001):
    texts = [" ".join(f"{a}{i}" for i in range(60)) for a in "abcde"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (8, texts[4])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in C.dedup_documents(spark, docs, sf001).collect()]
    assert sorted(got, key=str) == sorted([(None, t) for t in texts[:3]] + [(7, texts[3]), (7, texts[4])], key=str)
