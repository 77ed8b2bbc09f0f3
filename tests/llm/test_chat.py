import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from annoflow.llm import chat as C
from annoflow.llm.common import read
from annoflow.llm.queries import tokenizer

TRICKY = ["", "<|im_end|>", "<|im_end|><|im_start|>assistant ok", "\\", "\\|", "<\\|", "<", "<<||", "|", "a\\n\n", "é𝔘́ ️x", "\n\n  ", "<|endoftext|>"]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb\\", "<|im_end|>", ""]),
                          st.one_of(st.sampled_from(TRICKY), st.text(alphabet="<|>\\n\n aé𝔘im_end", max_size=20))), max_size=6))
@settings(max_examples=300, deadline=None)
def test_rendering_is_reversible(turns):
    text, spans = C.render(turns)
    assert C.parse(text) == turns
    assert [C.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_masks_cover_the_answers_exactly():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer(C.TOKENIZER))
    for a in TRICKY:
        for b in TRICKY:
            turns = [("user", b), ("assistant", a), ("assistant", b), ("user", a)]
            text, spans = C.render(turns)
            off = np.array(tok.encode(text, add_special_tokens=False).offsets).reshape(-1, 2)
            lo, hi = C.loss_spans(off, spans)
            assert C.loss_text(text, lo, hi) == a + b
            for (s, e), x, y in zip(off, lo, hi):  # by hand, without a search
                parts = [(max(s, p), min(e, q)) for p, q in spans if max(s, p) < min(e, q)]
                assert (x, y) == (parts[0] if parts else (0, 0))


def test_whole_table(spark, sf001):
    turns = read(spark, sf001, "conversations")
    rows = sorted(tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect())
    talks = {}
    for c, _, role, text in rows:
        talks.setdefault(c, []).append((role, text or ""))
    got = {r.conv_id: r for r in C.read_back(C.formatted_output(turns, tokenizer(C.TOKENIZER))).collect()}
    assert set(got) == set(talks)
    for c, t in talks.items():
        said = "".join(x for r, x in t if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest()
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars) == (len(t), digest, len(said))
        assert got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(1, 0, "user", None, "x"), (1, 0, "user", None, "x"), (1, None, "assistant", "late", "x"), (None, 1, None, "a", "x"),
            (None, 0, "assistant", "b", "x"), (2, 0, None, None, None), (3, 1, "assistant", "long " * 50000, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = C.formatted_output(df, tokenizer(C.TOKENIZER))
    got = {r.conv_id: r for r in out.collect()}
    assert C.parse(got[1].formatted) == [("user", ""), ("user", ""), ("assistant", "late")]
    assert C.parse(got[None].formatted) == [("assistant", "b"), ("", "a")]
    assert C.parse(got[2].formatted) == [("", "")]
    assert {r.conv_id: r.loss_chars for r in C.read_back(out).collect()} == {1: 4, None: 1, 2: 0, 3: 250000}
    assert C.format_chats(df.limit(0), tokenizer(C.TOKENIZER)).count() == 0
