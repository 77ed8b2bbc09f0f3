"""License scans (operator 7): a positional rare-token index.

All words of all templates (notices, one-line forms and whole licence texts) are indexed by position.  The document frequency of the
words is counted over all documents, and of the template words that a file has, those of highest IDF, its anchors, are looked
up.  Each anchor proposes where its template would begin; places on which ``AGREE`` anchors agree, give or take ``DRIFT`` words, are
candidates.  There the template's words are sought near their positions: those found must have ``SHARE`` of its IDF,
and all mandatory key phrases must stand near theirs.  So a licence with edits is found, and a mere mention of its name is not.
A template whose phrases have a word that the file lacks is not looked
up: it cannot be found.  Apart from that, plain phrases are counted wherever their words stand together.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from annoflow.llm.common import slices
from annoflow.llm.words import words_of

# Phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Label, template, mandatory key phrases (all inside the template).
TEMPLATES = [
    ("gpl", "this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    ("gpl", "it under the terms of the gnu general public license as published by the free software foundation",
     ["gnu general public license", "free software foundation"]),
    ("lgpl", "it under the terms of the gnu lesser general public license as published by the free software foundation",
     ["gnu lesser general public license"]),
    ("agpl", "it under the terms of the gnu affero general public license as published by the free software foundation",
     ["gnu affero general public license"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     ["permission is hereby granted free of charge", "obtaining a copy of this software"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     ["redistribution and use in source and binary forms", "conditions are met"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["permission to use copy modify", "with or without fee"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software"]),
]
# Licence texts from their first words on, without titles and copyright lines.
_MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the
software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute
sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following
conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"""
_AS_IS = """the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of
merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any
claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software
or the use or other dealings in the software"""
_BSD = """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions
are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the
documentation and or other materials provided with the distribution"""
_BSD_THIRD = """ 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission"""
_ISC = """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all
warranties with regard to this software including all implied warranties of merchantability and fitness"""
_APACHE = """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may
obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software
distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see
the license for the specific language governing permissions and limitations under the license"""
_ZLIB = """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages
arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications
and to alter it and redistribute it freely subject to the following restrictions the origin of this software must not be misrepresented"""
_UNLICENSE = """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or
distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"""
_GNU = """this program is free software you can redistribute it and or modify it under the terms of the gnu {name} as published by the free
software foundation either version {version} of the license or at your option any later version this program is distributed in the hope that
it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the
gnu {name} for more details"""


def _text(t: str) -> str:
    return " ".join(t.split())


TEMPLATES += [
    ("mit", _text(_MIT + " " + _AS_IS), ["permission is hereby granted free of charge", "substantial portions of the software"]),
    ("bsd", _text(_BSD), ["redistribution and use in source and binary forms", "redistributions in binary form must reproduce"]),
    ("bsd-3-clause", _text(_BSD + _BSD_THIRD), ["redistribution and use in source and binary forms", "endorse or promote products"]),
    ("isc", _text(_ISC), ["with or without fee is hereby granted", "appear in all copies"]),
    ("apache-2.0", _text(_APACHE), ["licensed under the apache license version 2 0", "language governing permissions and limitations"]),
    ("zlib", _text(_ZLIB), ["alter it and redistribute it freely", "must not be misrepresented"]),
    ("unlicense", _text(_UNLICENSE), ["unencumbered software", "by any means"]),
    *((label, _text(_GNU.format(name=name, version=version)), [f"under the terms of the gnu {name}", "later version"])
      for label, name, version in (("gpl", "general public license", 3), ("gpl", "general public license", 2),
                                   ("lgpl", "lesser general public license", 3), ("agpl", "affero general public license", 3))),
]
ANCHORS = 4      # words of highest IDF, of those in the file, that a template is looked up by
AGREE = 2        # anchors that must agree on a place
DRIFT = 8        # words that a template's word may stand off its position, for edits
SHARE = 0.5      # share of the template's IDF that must be found in place


def _hash(words: list[str]) -> np.ndarray:
    return words_of(pa.array(words, pa.large_string())).hash


class Index:
    """Postings of all words of the templates, given the document frequency of the words."""

    def __init__(self, templates, frequency: dict[str, int], documents: int):
        self.templates = [(label, words.split(), [k.split() for k in keys]) for label, words, keys in templates]
        self.idf = {w: float(np.log((documents + 1) / (frequency.get(w, 0) + 1))) for _, t, _ in self.templates for w in t}
        self.postings = [defaultdict(list) for _ in self.templates]
        for i, (_, t, _) in enumerate(self.templates):
            for at, w in enumerate(t):
                self.postings[i][w].append(at)
        self.rarest = [sorted(p, key=lambda w: (-self.idf[w], w)) for p in self.postings]
        self.mandatory = [{w for k in keys for w in k} for _, _, keys in self.templates]
        self.weight = [sum(self.idf[w] for w in t) for _, t, _ in self.templates]

    def anchors(self, i: int, present) -> list[str]:
        """Words of template i to look up in a file with the words ``present``: the rarest, a mandatory one among them."""
        here = [w for w in self.rarest[i] if w in present]
        out = here[:ANCHORS]
        if self.mandatory[i] and not self.mandatory[i] & set(out):
            out += [w for w in here if w in self.mandatory[i]][:1]
        return out

    def labels(self, places_of: dict[str, list[int]], word, n: int) -> dict[str, float]:
        """Label -> share of the template's IDF in place; places_of has the positions of each template word in the file, ascending;
        word(i) is the file's i-th word."""
        out: dict[str, float] = {}
        for i, (label, t, keys) in enumerate(self.templates):
            if not self.mandatory[i] <= places_of.keys():
                continue
            proposed = sorted((at - offset, w) for w in self.anchors(i, places_of) for at in places_of[w] for offset in self.postings[i][w])
            lo = 0
            least = min(AGREE, len(self.postings[i]))
            agreed: dict[str, int] = defaultdict(int)
            tried = None
            for begin, w in proposed:  # anchors within DRIFT words before this place
                agreed[w] += 1
                while proposed[lo][0] < begin - DRIFT:
                    agreed[proposed[lo][1]] -= 1
                    lo += 1
                if sum(c > 0 for c in agreed.values()) < least or tried == begin or out.get(label, 0.0) >= 1.0:
                    continue
                tried = begin
                score = self._share(i, begin, places_of)
                if score >= SHARE and score > out.get(label, 0.0) and all(self._phrase_near(i, k, begin, word, n) for k in keys):
                    out[label] = score
        return out

    def _share(self, i: int, begin: int, places_of: dict[str, list[int]]) -> float:
        """Share of template i's IDF in words that stand within DRIFT of where they should, each place of the file used once."""
        used: set[int] = set()
        total = 0.0
        for j, w in enumerate(self.templates[i][1]):
            at = places_of.get(w, ())
            k = bisect_left(at, begin + j - DRIFT)
            best = None
            while k < len(at) and at[k] <= begin + j + DRIFT:
                if at[k] not in used and (best is None or abs(at[k] - begin - j) < abs(best - begin - j)):
                    best = at[k]
                k += 1
            if best is not None:
                used.add(best)
                total += self.idf[w]
        return min(1.0, total / (self.weight[i] or 1.0))

    def _phrase_near(self, i: int, phrase: list[str], begin: int, word, n: int) -> bool:
        t = self.templates[i][1]
        for j in range(len(t) - len(phrase) + 1):
            if t[j:j + len(phrase)] == phrase:
                for at in range(max(0, begin + j - DRIFT), min(n - len(phrase), begin + j + DRIFT) + 1):
                    if all(word(at + x) == phrase[x] for x in range(len(phrase))):
                        return True
        return False


def _phrases(w, wid: np.ndarray, ids: dict[str, int], phrase: list[str]) -> np.ndarray:
    """First words of the places where the phrase stands inside one text."""
    k = len(phrase)
    if len(wid) < k:
        return np.zeros(0, np.int64)
    ok = np.ones(len(wid) - k + 1, dtype=bool)
    for j, x in enumerate(phrase):
        ok &= wid[j:len(wid) - k + 1 + j] == ids[x]
    at = np.flatnonzero(ok)
    t = np.searchsorted(w.first, at, side="right") - 1
    return at[at + k <= w.first[t + 1]]


def _vocabulary(templates, base):
    vocabulary = sorted({x for p in base for x in p.split()} | {x for _, t, _ in templates for x in t.split()})
    h = _hash(vocabulary)
    order = np.argsort(h)
    return vocabulary, h[order], order


def _word_ids(w, sorted_hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Index into the vocabulary of each word, -1 for others (64-bit hashes)."""
    at = np.minimum(np.searchsorted(sorted_hashes, w.hash), len(order) - 1)
    return np.where(sorted_hashes[at] == w.hash, order[at], -1)


def document_frequency(texts: DataFrame, templates=TEMPLATES, base=BASE) -> DataFrame:
    """(word, df) of the licence words over all documents; the empty word has the number of documents."""
    vocabulary, hashes, order = _vocabulary(templates, base)

    def run(batches):
        total, rows = np.zeros(len(vocabulary), dtype=np.int64), 0
        for b in batches:
            rows += b.num_rows
            for lo, n in slices(b.column(0)):
                w = words_of(b.column(0).slice(lo, n))
                wid = _word_ids(w, hashes, order)
                at = np.flatnonzero(wid >= 0)
                t = np.searchsorted(w.first, at, side="right") - 1
                total += np.bincount(np.unique(t * len(vocabulary) + wid[at]) % len(vocabulary), minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array([*vocabulary, ""]), pa.array([*total.tolist(), rows], pa.int64())], names=["word", "df"])

    return texts.mapInArrow(run, "word string, df long").groupBy("word").agg(F.sum("df").alias("df"))


def scan(docs: DataFrame, templates=TEMPLATES, base=BASE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word (null without a base phrase), base_labels and
    labels (sorted arrays), score (best share, by IDF, of a template found in place; 1 for a base phrase).

    A null text has no words and no labels.  Null ids and repeated rows stay as they are; an
    empty table gives no rows; other columns are not read.  ``templates`` is a parameter and
    small: it goes to every task, while documents never leave theirs.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    frequency = {r["word"]: r["df"] for r in document_frequency(texts, templates, base).collect()}  # a row for each template word
    vocabulary, hashes, order = _vocabulary(templates, base)
    ids = {x: i for i, x in enumerate(vocabulary)}
    index = Index(templates, frequency, frequency.pop("", 0))
    at_word = {x: i for i, x in enumerate(vocabulary)}
    needed = [np.array([at_word[x] for x in sorted(m)], dtype=np.int64) for m in index.mandatory]
    inside = np.array([x in index.idf for x in vocabulary])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                        ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64())])

    def run(batches):
        for b in batches:
            for lo, n in slices(b.column(1)):
                w = words_of(b.column(1).slice(lo, n))
                wid = _word_ids(w, hashes, order)
                first, counts = w.first, w.counts()
                places, found = defaultdict(list), defaultdict(set)
                for phrase, label in base.items():
                    for at in _phrases(w, wid, ids, phrase.split()).tolist():
                        t = int(np.searchsorted(first, at, side="right")) - 1
                        places[t].append(at - int(first[t]))
                        found[t].add(label)
                hits = np.flatnonzero((wid >= 0) & inside[wid])
                text = np.searchsorted(first, hits, side="right") - 1
                has = np.zeros((n, len(vocabulary)), dtype=bool)
                has[text, wid[hits]] = True
                # Texts in which some template has all words of its mandatory phrases; the others cannot match.
                able = np.any([has[:, m].all(axis=1) & has.any(axis=1) for m in needed], axis=0) if needed else np.zeros(n, dtype=bool)
                anchors = defaultdict(lambda: defaultdict(list))
                for t, at in zip(text[able[text]].tolist(), hits[able[text]].tolist()):
                    anchors[t][vocabulary[wid[at]]].append(at - int(first[t]))
                rows = []
                for t in range(n):
                    base_labels = found.get(t, set())
                    more = {}
                    if t in anchors:
                        begin = int(first[t])
                        more = index.labels(anchors[t], lambda i: w.text(begin + i, begin + i + 1), int(counts[t]))
                    score = max([1.0 if base_labels else 0.0, *more.values()])
                    p = places.get(t)
                    rows.append((int(counts[t]), len(p) if p else 0, min(p) if p else None, max(p) if p else None,
                                 sorted(base_labels), sorted(base_labels | set(more)), score))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, n), *(pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), list(schema)[1:]))], schema=schema)

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                             "base_labels array<string>, labels array<string>, score double")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")
