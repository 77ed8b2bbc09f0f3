"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page.

Each block is article or not.  A block's score is the sum of the weights of its features: names, classes, ids and roles of
all its ancestors, and its text (length, share of links, end of sentence, and so on; the same of its neighbours; its
place in the page; the share of the page's prose that stands in its section).  Transitions have weights of their own
for neighbours in one section and in two.  The weights are fitted to labelled pages by the likelihood of whole label
sequences (forward-backward), and a page is decoded by Viterbi.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from annoflow.llm.common import slices
from annoflow.llm.html_blocks import Block, Path, leaf_blocks

#: Gradient steps, step size and ridge of the fit.
STEPS, RATE, RIDGE = 200, 0.1, 2e-5
#: Distinct element paths that a task remembers.
PATHS = 50_000

_WORDS = (1, 3, 6, 12, 25, 60)


def _bucket(x, bounds) -> int:
    return sum(x > b for b in bounds)


def text_features(block: Block) -> tuple[list[str], str]:
    """Features of a block's own text, and its shape, which its neighbours see."""
    t, tag = block.text, block.path.own
    words = _bucket(t.count(" ") + 1, _WORDS)
    link = _bucket(block.links / len(t), (0.02, 0.35, 0.75))
    out = [f"w{words}", f"l{link}", f"p:{tag}", f"p:{tag}:w{words}", f"p:{tag}:l{link}", f"w{words}:l{link}",
           f"e:{int(t[-1] in '.!?…\"”»')}:w{min(words, 3)}", f"k:{min(t.count(','), 3)}"]
    if "©" in t or "(c)" in t.lower():
        out.append("copyright")
    if any(x in t for x in "|»›•·"):
        out.append("separator")
    if "@" in t:
        out.append("at")
    if sum(c.isdigit() for c in t[:200]) * 4 > min(len(t), 200):
        out.append("digits")
    return out, f"{words}{link}"


def page_features(blocks: list[Block]) -> list[list[str]]:
    """Features of each block besides those of its ancestors."""
    prose: dict[int, int] = {}
    for b in blocks:
        prose[b.section] = prose.get(b.section, 0) + max(0, len(b.text) - b.links)
    most, n = max(prose.values(), default=1) or 1, len(blocks)
    own = [text_features(b) for b in blocks]
    out = []
    for i, (features, _) in enumerate(own):
        share = _bucket(prose[blocks[i].section] / most, (0.02, 0.1, 0.3, 0.6, 0.99))
        out.append(features + [f"<{own[i - 1][1] if i else ''}", f">{own[i + 1][1] if i + 1 < n else ''}",
                               f"at{_bucket(i / n, (0.02, 0.15, 0.5, 0.8, 0.95))}", f"share{share}",
                               f"share{share}:{features[0]}", "bias"])
    return out


@dataclass
class Model:
    """``weight``: of a feature in favour of article; ``step[e][a][b]``: of b after a, e: both in one section."""

    weight: dict[str, float]
    step: list
    start: list

    def decode(self, blocks: list[Block]) -> list[int]:
        """The likeliest labels (Viterbi); ties fall to 0."""
        if not blocks:
            return []
        get, back, states, scores = self.weight.get, [], None, page_features(blocks)
        for i, (block, features) in enumerate(zip(blocks, scores)):
            path = block.path
            if path.cache is None:
                path.cache = sum(get(f, 0.0) for f in path.features)
            e = path.cache + sum([get(f, 0.0) for f in features])
            if states is None:
                states = (self.start[0], self.start[1] + e)
                continue
            s = self.step[block.section == blocks[i - 1].section]
            a, b = states
            from0, from1 = int(b + s[1][0] > a + s[0][0]), int(b + s[1][1] > a + s[0][1])
            back.append((from0, from1))
            states = (states[from0] + s[from0][0], states[from1] + s[from1][1] + e)
        label = int(states[1] > states[0])
        out = [label]
        for pointers in reversed(back):
            label = pointers[label]
            out.append(label)
        return out[::-1]


def labels_of(blocks: list[Block], text: str) -> list[int]:
    """Labels of a page's blocks from its known main text: its blocks, in order, joined by two line breaks."""
    parts = [p for p in (text or "").split("\n\n") if p]
    out, at = [], 0
    for b in blocks:
        hit = at < len(parts) and b.text == parts[at]
        at += hit
        out.append(int(hit))
    return out


def fit(pages: list[tuple[str, str]], steps: int = STEPS) -> Model:
    """A model of labelled pages (html, main text).

    Runs where it is called, over the pages given: a bounded sample.  Deterministic.
    """
    index: dict[str, int] = {}
    root, columns, sizes, lengths, labels, same = Path(), [], [], [], [], []
    for html, text in pages:
        blocks = leaf_blocks(html, root)
        if not blocks:
            continue
        for b, features in zip(blocks, page_features(blocks)):
            row = [index.setdefault(f, len(index)) for f in (*b.path.features, *features)]
            columns += row
            sizes.append(len(row))
        lengths.append(len(blocks))
        labels += labels_of(blocks, text)
        same += [0] + [int(a.section == b.section) for a, b in zip(blocks, blocks[1:])]
    if not lengths:
        return Model({}, [[[0.0] * 2] * 2] * 2, [0.0, 0.0])
    # Blocks by place, then by falling length of their page: the blocks of one place lie together, and the
    # first of them are those whose pages go on.
    rank = np.empty(len(lengths), dtype=np.int64)
    rank[np.argsort(-np.array(lengths), kind="stable")] = np.arange(len(lengths))
    place = np.concatenate([np.arange(x) for x in lengths])
    order = np.lexsort((np.repeat(rank, lengths), place))
    sizes = np.array(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    columns = np.array(columns)[np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in order])]
    sizes, y, same = sizes[order], np.array(labels)[order], np.array(same)[order]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    width = np.bincount(place)
    off = np.concatenate([[0], np.cumsum(width)])
    chain = [(slice(off[i - 1], off[i - 1] + width[i]), slice(off[i], off[i + 1])) for i in range(1, len(width))]
    n = len(lengths)
    last = off[np.sort(lengths)[::-1] - 1] + np.arange(n)
    page = np.concatenate([np.arange(x) for x in width])
    here = np.arange(n, len(y))
    before = off[place[order][here] - 1] + page[here]

    w, step, start = np.zeros(len(index)), np.zeros((2, 2, 2)), np.zeros(2)
    known_step = np.zeros((2, 2, 2))
    np.add.at(known_step, (same[here], y[before], y[here]), 1)
    known_start = np.bincount(y[:n], minlength=2).astype(float)
    parameters = [w, step, start]
    m1, m2 = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for t in range(1, steps + 1):
        score = np.stack([np.zeros(len(y)), np.add.reduceat(w[columns], starts)])
        s = step[same].transpose(1, 2, 0)  # [label before][label][block]
        ahead, behind = np.zeros((2, len(y))), np.zeros((2, len(y)))
        ahead[:, :n] = start[:, None] + score[:, :n]
        for prev, now in chain:
            for b in (0, 1):
                ahead[b, now] = np.logaddexp(ahead[0, prev] + s[0, b, now], ahead[1, prev] + s[1, b, now]) + score[b, now]
        for prev, now in reversed(chain):
            rest = score[:, now] + behind[:, now]
            for a in (0, 1):
                behind[a, prev] = np.logaddexp(s[a, 0, now] + rest[0], s[a, 1, now] + rest[1])
        total = np.logaddexp(ahead[0, last], ahead[1, last])[page]
        p1 = np.exp(ahead[1] + behind[1] - total)
        expected_step = np.zeros((2, 2, 2))
        for a in (0, 1):
            for b in (0, 1):
                p = np.exp(ahead[a, before] + s[a, b, here] + score[b, here] + behind[b, here] - total[here])
                expected_step[:, a, b] = np.bincount(same[here], weights=p, minlength=2)
        gradient = [np.bincount(columns, weights=np.repeat(y - p1, sizes), minlength=len(w)) / len(y) - RIDGE * w,
                    (known_step - expected_step) / len(y) - RIDGE * step,
                    (known_start - np.array([(1 - p1[:n]).sum(), p1[:n].sum()])) / len(y) - RIDGE * start]
        for p, g, a, b in zip(parameters, gradient, m1, m2):  # Adam
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p += RATE * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
    return Model({f: float(w[i]) for f, i in index.items()}, step.tolist(), start.tolist())


def main_text(html: str | None, model: Model, root: Path) -> tuple[str, int]:
    """The page's article blocks joined by two line breaks, and how many blocks the page has."""
    blocks = leaf_blocks(html or "", root)
    return "\n\n".join(b.text for b, keep in zip(blocks, model.decode(blocks)) if keep), len(blocks)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """Per page: page_id, url, text (empty if there is none), n_blocks (of the whole page).

    Pages are taken row by row: repeated rows, null ids and null urls give a row each; null html is empty.  Other columns
    are not read.  ids and urls keep their types.  A task holds a slice of pages; one page must fit into a task.
    """
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()),
                           T.StructField("n_blocks", T.LongType())])

    def part(batches):
        root, seen = Path(), 0
        for batch in batches:
            html = batch.column("html")
            for lo, count in slices(html):
                texts, sizes = [], []
                for page in html.slice(lo, count).to_pylist():
                    text, n = main_text(page, model, root)
                    texts.append(text)
                    sizes.append(n)
                    seen += n
                    if seen > PATHS:  # at most one path a block is new
                        root, seen = Path(), 0
                yield pa.RecordBatch.from_arrays([batch.column("page_id").slice(lo, count), batch.column("url").slice(lo, count),
                                                  pa.array(texts, pa.string()), pa.array(sizes, pa.int64())], names=schema.names)

    return pages.select("page_id", "url", "html").mapInArrow(part, schema)


def digest(found: DataFrame) -> DataFrame:
    """The query's columns."""
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks")
