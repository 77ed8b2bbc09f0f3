"""Chat formatting (operator 4) with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and the spans of the
assistant texts are intersected with the token spans by binary search.  Each token
carries the part of its span that lies under the loss (empty: no loss), so a
token that also covers some of the template is trained on, yet the text under the mask is exact.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from annoflow.llm.common import stage

BEGIN, END = "<|im_start|>", "<|im_end|>"
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_ESCAPED = re.compile(r"\\([\\|n])")
TOKENIZER = "byte_bpe_50k.json"

#: Characters of whole conversations that are encoded at a time.
ENCODE_CHARS = 1 << 17


@lru_cache(maxsize=1)
def _tokenizer(file: str):
    """One per Python worker, without threads of its own: Spark has a task for each core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(file)
    tok.encode_special_tokens = True
    return tok


def escape(text: str) -> str:
    """Reversible: afterwards no ``<|`` is left, so no control string can stand in a text."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the spans (code points) of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{BEGIN}{escape(role).replace(chr(10), chr(92) + 'n')}\n"
        body = escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def loss_spans(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """For each token (rows: begin, end; both sorted) the part of it under one of the sorted spans.

    A token over more than one span gets the range from the first to the last; as templates lie
    between spans and are longer than a token, this does not occur with word tokenizers.
    """
    lo, hi = np.zeros((2, len(offsets)), dtype=np.int32)
    begin, end = offsets[:, 0], offsets[:, 1]
    for s, e in spans:
        if s == e:
            continue
        a = int(np.searchsorted(end, s, side="right"))
        b = int(np.searchsorted(begin, e, side="left"))
        lo[a:b] = np.maximum(begin[a:b], s)
        hi[a:b] = np.minimum(end[a:b], e)
    return lo, hi


def loss_text(formatted: str, lo, hi) -> str:
    """Text under the mask: parts of a character that several tokens share count once."""
    parts, done = [], 0
    for a, b in zip(lo, hi):
        a = max(a, done)
        if b > a:
            parts.append(formatted[a:b])
            done = b
    return unescape("".join(parts))


SCHEMA = ("conv_id long, n_turns int, formatted string, input_ids array<int>, "
          "offset_begin array<int>, offset_end array<int>, loss_begin array<int>, loss_end array<int>")


def format_chats(turns: DataFrame, tokenizer_file: str, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation, as in ``SCHEMA``.

    Turns go by turn number (null last), then role and text; null roles and texts are empty.
    Repeated rows are turns of their own.  Rows without a conversation id form one
    conversation of id null.  An empty table gives no rows.  Other columns are not read.
    A conversation is encoded whole, so it has to fit a task; others share nothing with it.
    """
    def run(batches):
        tok = _tokenizer(tokenizer_file)
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int32()), ("formatted", pa.string()),
                            *((c, pa.list_(pa.int32())) for c in
                              ("input_ids", "offset_begin", "offset_end", "loss_begin", "loss_end"))])

        def encoded(some):
            """Rows of a few (conv_id, turns, formatted text, spans)."""
            rows = []
            for (conv, n, text, spans), e in zip(some, tok.encode_batch([x[2] for x in some], add_special_tokens=False)):
                off = np.array(e.offsets, dtype=np.int32).reshape(-1, 2)
                lo, hi = loss_spans(off, spans)
                rows.append((conv, n, text, np.array(e.ids, dtype=np.int32), off[:, 0], off[:, 1], lo, hi))
            return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            some, size = [], 0
            for conv, talk in zip(batch.column(0).to_pylist(), batch.column(1)):
                turns = [(t["role"], t["text"]) for t in talk.as_py()]
                text, spans = render(turns)
                some.append((conv, len(turns), text, spans))
                size += len(text)
                if size >= ENCODE_CHARS:
                    yield encoded(some)
                    some, size = [], 0
            if some:
                yield encoded(some)

    turn = F.struct(F.col(turn_col).isNull().alias("z"), F.col(turn_col).alias("turn"),
                    F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    talks = (turns.groupBy(F.col(conv_col).cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("t"))
             .select("conv_id", F.expr("transform(t, x -> struct(x.role as role, x.text as text))").alias("turns")))
    return talks.mapInArrow(run, SCHEMA)


def read_back(chats: DataFrame) -> DataFrame:
    """Turns and loss text as they stand in the written output, as digests."""
    def run(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                turns = parse(r["formatted"])
                said = loss_text(r["formatted"], r["loss_begin"], r["loss_end"])
                rows.append({"conv_id": r["conv_id"], "n_turns": len(turns),
                             "turns_sha256": hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in turns).encode()).hexdigest(),
                             "loss_chars": len(said), "loss_sha256": hashlib.sha256(said.encode()).hexdigest(),
                             "formatted_chars": len(r["formatted"])})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))

    return chats.select("conv_id", "formatted", "loss_begin", "loss_end").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted_output(turns: DataFrame, tokenizer_file: str) -> DataFrame:
    """The formatted conversations, written as Parquet in the shared folder."""
    return stage(format_chats(turns, tokenizer_file), "chats")
