"""Against the known text of labelled pages, other names than those trained on, and the table's articles."""

import itertools
import random
import re
import time
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from annoflow.llm import html_pages as P
from annoflow.llm import html_text as H
from annoflow.llm.common import read
from annoflow.llm.html_blocks import Path, leaf_blocks
from annoflow.llm.queries import QUERIES, _page_model


@pytest.fixture(scope="module")
def model():
    return _page_model(P.TRAINING_PAGES)


def score(model, pages):
    """(precision, recall) over blocks, and the share of pages without an error."""
    root, hit, said, true, whole = Path(), 0, 0, 0, 0
    for html, text in pages:
        blocks = leaf_blocks(html, root)
        y, got = H.labels_of(blocks, text), model.decode(blocks)
        assert "\n\n".join(b.text for b, k in zip(blocks, y) if k) == text  # the reader finds every block as it was written
        hit, said, true, whole = hit + sum(a and b for a, b in zip(y, got)), said + sum(got), true + sum(y), whole + (y == got)
    return hit / said, hit / true, whole / len(pages)


def test_held_out_pages(model):
    precision, recall, whole = score(model, list(P.labelled_pages(400, seed=99)))
    assert precision > 0.98 and recall > 0.98 and whole > 0.88


def test_names_never_seen():
    half = H.fit(list(P.labelled_pages(names=slice(0, None, 2))))
    precision, recall, whole = score(half, list(P.labelled_pages(300, 98, slice(1, None, 2))))
    assert precision > 0.96 and recall > 0.96 and whole > 0.75


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_whole_table(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    html = {r.page_id: r.html for r in read(spark, sf_dir, "pages").collect()}
    got = QUERIES["op11_html_text"](spark, sf_dir).collect()
    assert len(got) == len(html)
    for r in got:
        inner = re.search(r"<article>(.*?)(</article>|$)", html[r.page_id], re.S).group(1)
        parts = (" ".join(unescape(re.sub(r"<[^>]*(>|$)", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n\n".join(x for x in parts if x), r.page_id
        assert r.n_chars == len(r.text)


def texts(html):
    return [b.text for b in leaf_blocks(html, Path())]


@pytest.mark.parametrize("html,blocks", [
    ("", []), ("plain & simple", ["plain & simple"]), ("a<b", ["a"]), ("1 < 2 <3 </ x> 4", ["1 < 2 <3 4"]),
    ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]), ("<ul><li>a<li>b<ul><li>c</ul>d</ul>", ["a", "b", "c", "d"]),
    ("<p>a<br>b&nbsp;\n c&amp;&lt;&#233;&#x1F600;&copy", ["a b c&<é😀©"]),
    ("<script>var x='</p><p>no';</script><p>yes<style>p{}</style> on</p>", ["yes on"]),
    ("<p>a<!-- > <p>no --> b</p><!-- open <p>no", ["a b"]), ('<p title="a > b" id=x>t</p>', ["t"]), ("<a href=\"x>t</a> u", ["t u"]),
    ("<p>t</p><a href='cut off", ["t"]), ("<p>t</p><scr", ["t"]), ("<script>never closed <p>t</p>", []), ("<TITLE>t</TITLE><P>U</P>", ["U"]),
    ("<p><b>a</p><p>b</b></p>", ["a", "b"]), ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
    ("<select><option>a<option>b</select>c<button>d</button>", ["c"]), ("</p></div></b>x</body>y", ["xy"]), ("<![CDATA[x]]><?php y ?>z", ["z"]),
    ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]), ("<textarea><p>no</textarea>x", ["x"]), ("<noscript><p>no</p></noscript>x", ["x"]),
])
def test_blocks(html, blocks):
    assert texts(html) == blocks


def test_reader_is_linear():
    for html in ("<div>" * 100_000 + "x", "<p a=\"" * 100_000, "<b><p>" * 50_000, "<!--" * 100_000, "x<" * 100_000, "<ul><li>" * 50_000, "</p>" * 100_000,
                 "<p>" + "word " * 1_000_000, "<a href='x'>y</a>" * 50_000, "<script>" * 50_000):
        t = time.time()
        leaf_blocks(html, Path())
        assert time.time() - t < 8, html[:20]


def test_fit_is_the_gradient_of_sequence_likelihood():
    """A fitted chain has the label counts and pair counts that it expects, summed over all label sequences."""
    pages = list(P.labelled_pages(6, seed=4))
    pages = [(f"<div>{''.join(f'<p>{w}</p>' for w in t.split()[:5])}</div>", "\n\n".join(t.split()[1:4])) for _, t in pages]
    model = H.fit(pages, steps=3000)
    root, expected, seen = Path(), np.zeros(3), np.zeros(3)
    for html, text in pages:
        blocks = leaf_blocks(html, root)
        y, features = H.labels_of(blocks, text), H.page_features(blocks)
        emit = [sum(model.weight[f] for f in (*b.path.features, *fs)) for b, fs in zip(blocks, features)]
        stats, weights = [], []
        for labels in itertools.product((0, 1), repeat=len(blocks)):
            s = model.start[labels[0]] + sum(e * v for e, v in zip(emit, labels)) + sum(model.step[1][a][b] for a, b in zip(labels, labels[1:]))
            weights.append(np.exp(s))
            stats.append((sum(labels), labels[0], sum(a and b for a, b in zip(labels, labels[1:]))))
        best = list(itertools.product((0, 1), repeat=len(blocks)))[int(np.argmax(weights))]
        assert model.decode(blocks) == list(best)
        expected += np.average(stats, axis=0, weights=weights)
        seen += (sum(y), y[0], sum(a and b for a, b in zip(y, y[1:])))
    assert np.allclose(expected, seen, atol=0.1)


def test_odd_rows(spark, model):
    long = "<article>" + "<p>Word and word.</p>" * 20_000 + "</article>"
    rows = [(1, "u", "<article><h1>T</h1><p>One. Two, three.</p></article>"), (1, "u", "<article><h1>T</h1><p>One. Two, three.</p></article>"), (2, None, None),
            (None, "v", ""), (3, "w", " \n "), (None, None, None), (4, "x", long), (5, "y", "\x00\x01<p>�")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("n_blocks", F.lit("y"))
    got = H.digest(H.extract(pages, model))
    assert got.columns == ["page_id", "url", "text", "n_chars", "n_blocks"]
    rows = got.collect()
    assert [r.text for r in rows if r.page_id == 1] == ["T\n\nOne. Two, three."] * 2
    assert all(r.text == "" and r.n_chars == 0 for r in rows if r.page_id in (2, 3, None))
    assert [r.n_blocks for r in rows if r.page_id == 4] == [20_000]
    assert next(r.text for r in rows if r.page_id == 4) == "\n\n".join(["Word and word."] * 20_000)
    assert H.extract(pages.limit(0), model).count() == 0
    assert H.fit([]).decode(leaf_blocks("<p>x</p>", Path())) == [0]
