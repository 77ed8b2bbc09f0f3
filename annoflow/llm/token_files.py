"""Token-ID output (operator 5): Arrow files of equal-length sequences with masks.

Documents are dealt by id range, sorted, encoded and written; each range is one file.  A file has
record batches of ``BATCH`` rows with two fixed-size lists, ``ids`` and ``mask`` (false: padding).
Lists of one length lie back to back in a batch without offsets, so sequence i of a
memory-mapped file is a slice: no copy, no decoding.  The id stream runs on through a file; only
its last sequence is padded.  A second file of the same name and ``.docs`` has the documents
(doc_id, start, n_tokens) in order.

Tasks write under a name of their own and rename at the end, so a repeated task
replaces what a lost one left.
"""

from __future__ import annotations

import gc
import json
import re
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from annoflow.llm.common import shared_path, slices

SEQUENCE, BATCH = 2048, 64
END_ID = 2

#: Words whose ids a Python worker remembers, twice: the last so many, and those before them.
CACHE_WORDS = 500_000

#: A file holds the sequences of about so many bytes of input, by the planner's estimate; at least one file a shuffle partition.
FILE_BYTES = 256 << 20

# What a tokenizer's own file says if its texts may be cut (see WordEncoder).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: What plain texts have not: ``<``, and characters other than ASCII and the letters of Latin-1.
_NOT_PLAIN = re.compile(rb"[<\xc2\xc4-\xff]|\xc3[\x97\xb7]")
#: SPLIT for lowered plain texts, where every byte from 0x80 on is part of a letter.
_PLAIN = re.compile(rb"'(?:[stmd]|re|ve|ll)|[a-z\x80-\xff]+|[0-9]|[^\sa-z0-9\x80-\xff]+")


class _Memory(dict):
    """Part of a text -> its ids; asks once for each."""

    def __init__(self, tok, dtype, capacity):
        super().__init__()
        self.tok, self.letter, self.capacity, self.older = tok, "H" if dtype.itemsize == 2 else "I", capacity, {}

    def __missing__(self, part: bytes) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self.tok.encode(part.decode(), add_special_tokens=False).ids
            ids = struct.pack(f"<{len(ids)}{self.letter}", *ids)
        self[part] = ids
        return ids

    def trim(self):
        """Keeps the last ``capacity`` parts or more, and the as many before them."""
        if len(self) > self.capacity:
            self.older = dict(self)
            self.clear()


def may_cut(file: dict) -> bool:
    """Whether the parts of a text that ``WordEncoder`` cuts are independent, by the tokenizer's file."""
    model = file["model"]
    plain_merges = model["type"] == "BPE" and not any(model.get(k) for k in (
        "dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
    brackets = all(re.fullmatch(r"<[^\s<]*", t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])
                   for t in file["added_tokens"])
    return (file["normalizer"], file["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER) and plain_merges and brackets


class WordEncoder:
    """Encodes by parts that are independent, each through the tokenizers library and then remembered.

    Only if the tokenizer's file is known to allow it: it composes, turns white space to one space, lowers case, splits by ``SPLIT``
    and merges bytes by rank, and its added tokens are plain strings in angle brackets.  No token, merge or composition then
    reaches over white space, so a text may be cut at space and \\t to \\r.
    Plain texts (ASCII and Latin-1 letters, which NFC leaves alone and which have one lower-case
    letter each) are cut further.  With any other file whole texts are encoded.  There is no part that the library does not encode.
    """

    def __init__(self, tokenizer_file: str, capacity: int = CACHE_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        tok = Tokenizer.from_file(tokenizer_file)
        self.dtype = np.dtype("<u2") if tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.tok, self.cuts = tok, may_cut(json.loads(tok.to_str()))
        self.words = _Memory(tok, self.dtype, capacity // 4)
        merges = Tokenizer.from_file(tokenizer_file)  # for parts that are normal and split already
        merges.normalizer = None
        merges.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.parts = _Memory(merges, self.dtype, capacity)

    def _encode(self, text: str) -> bytes:
        if not self.cuts:
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        raw = text.encode()
        if not _NOT_PLAIN.search(raw):
            return b"".join(map(self.parts.__getitem__, _PLAIN.findall(text.lower().encode())))
        return b"".join(map(self.words.__getitem__, raw.split()))

    def __call__(self, texts: list[str]) -> list[bytes]:
        self.words.trim()
        self.parts.trim()
        gc.disable()  # or else the memory is searched for cycles, which it has not, again and again
        try:
            return [self._encode(t) for t in texts]
        finally:
            gc.enable()


@lru_cache(maxsize=1)
def encoder_of(tokenizer_file: str) -> WordEncoder:
    """One per Python worker, over all its tasks."""
    return WordEncoder(tokenizer_file)


def _encoded(batches, tokenizer_file: str, end_id: int):
    """(ids of documents, their little-endian ids with the end id), a slice of documents at a time."""
    encoder = encoder_of(tokenizer_file)
    end = np.array([end_id], dtype=encoder.dtype).tobytes()
    for b in batches:
        for lo, n in slices(b.column(1)):
            yield (b.column(0).slice(lo, n).to_pylist(),
                   [x + end for x in encoder([t or "" for t in b.column(1).slice(lo, n).to_pylist()])])


def _filesystem(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[len("file:"):])


def _write(encoded, kind: np.dtype, folder: str, sequence: int, batch_rows: int, part: int):
    """Writes one partition's sorted documents; gives its number, documents and tokens."""
    store, root = _filesystem(folder)
    name, own = f"{root}/part-{part:05d}", uuid.uuid4().hex
    tmp, docs = f"{name}.{own}.tmp", []
    out = writer = schema = None
    held, tokens, at = [], 0, 0
    full = sequence * batch_rows

    def put(ids, real):
        mask = np.arange(len(ids)) < real
        writer.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids), sequence), pa.FixedSizeListArray.from_arrays(pa.array(mask), sequence)],
            schema=schema))

    for doc_ids, texts in encoded:
        if writer is None:
            store.create_dir(root, recursive=True)
            schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
            out = store.open_output_stream(tmp)
            writer = pa.ipc.new_file(out, schema)
        for doc_id, raw in zip(doc_ids, texts):
            n = len(raw) // kind.itemsize
            docs.append((doc_id, tokens, n))
            tokens += n
        held.append(np.frombuffer(b"".join(texts), dtype=kind))
        at += len(held[-1])
        if at >= full:
            ids, n = np.concatenate(held), at // full * full
            for lo in range(0, n, full):
                put(ids[lo:lo + full], full)
            held, at = [ids[n:]], at - n
    if writer is None:
        return
    if at:
        put(np.concatenate([*held, np.zeros(-at % sequence, kind)]), at)
    writer.close()
    out.close()
    table = pa.table({"doc_id": pa.array([d[0] for d in docs], pa.int64()), "start": pa.array([d[1] for d in docs], pa.int64()),
                      "n_tokens": pa.array([d[2] for d in docs], pa.int64())})
    with store.open_output_stream(f"{tmp}.docs") as f, pa.ipc.new_file(f, table.schema) as w:
        w.write_table(table, max_chunksize=1 << 16)
    store.move(f"{tmp}.docs", f"{name}.docs")
    store.move(tmp, f"{name}.arrow")
    yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "docs": pa.array([len(docs)], pa.int64()),
                                      "tokens": pa.array([tokens], pa.int64())})


def write_token_files(docs: DataFrame, tokenizer_file: str, folder: str, end_id: int = END_ID, sequence: int = SEQUENCE,
                      batch_rows: int = BATCH, files: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and writes ``docs`` in ascending order of doc_id (null ids last; equal ids by a hash of the text) and
    returns the manifest: part, docs, tokens, first_token (tokens of all files before)."""
    spark = docs.sparkSession
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    n = files or max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-size // FILE_BYTES), 1 << 20))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]

    def run(batches):
        from pyspark import TaskContext

        yield from _write(_encoded(batches, tokenizer_file, end_id), encoder_of(tokenizer_file).dtype, folder, sequence, batch_rows,
                          TaskContext.get().partitionId())

    dealt = d.repartitionByRange(n, *order).sortWithinPartitions(*order)
    manifest = sorted(dealt.mapInArrow(run, "part int, docs long, tokens long").collect())  # a row for each file
    rows, first = [], 0
    for m in manifest:
        rows.append((m["part"], m["docs"], m["tokens"], first))
        first += m["tokens"]
    return spark.createDataFrame(rows, "part int, docs long, tokens long, first_token long")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document from the files: doc_id, start (in the whole stream), n_tokens, ids_crc32."""
    def run(batches):
        store, root = _filesystem(folder)
        for b in batches:
            for part, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                name = f"{root}/part-{part:05d}"
                with open_file(store, f"{name}.docs") as docs, open_file(store, f"{name}.arrow") as data:
                    stream = TokenFile(data)
                    for i in range(docs.num_record_batches):
                        t = docs.get_batch(i)
                        crc = []
                        for s, n in zip(t["start"].to_pylist(), t["n_tokens"].to_pylist()):
                            c = 0
                            for ids, mask in stream.pieces(s, n):
                                if mask.false_count:
                                    raise ValueError(f"{name}.arrow: document at {s} has padding")
                                c = zlib.crc32(ids.astype("<u4", copy=False), c)
                            crc.append(c)
                        yield pa.RecordBatch.from_arrays(
                            [t["doc_id"], pa.array(t["start"].to_numpy() + first), t["n_tokens"], pa.array(crc, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.select("part", "first_token").repartition(max(1, manifest.count()), "part")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def open_file(store, path: str):
    """An Arrow file: mapped into memory where it lies on a file system that can be, else read as it is asked for."""
    from pyarrow import fs

    source = pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)
    return pa.ipc.open_file(source)


class TokenFile:
    """The sequences of one file, and the id stream that they make up.  Ids are views into the file, masks are its bits: nothing
    is copied or decoded."""

    def __init__(self, data: pa.ipc.RecordBatchFileReader):
        self.data, self.at, self.loaded = data, -1, None
        first = data.get_batch(0)
        self.sequence = first.schema.field("ids").type.list_size
        self.per_batch = first.num_rows * self.sequence

    def _batch(self, i: int):
        if i != self.at:
            b = self.data.get_batch(i)
            self.loaded = (b.column(0).flatten().to_numpy(zero_copy_only=True), b.column(1).flatten())
            self.at = i
        return self.loaded

    def __len__(self) -> int:
        last = self.data.get_batch(self.data.num_record_batches - 1).num_rows
        return (self.data.num_record_batches - 1) * (self.per_batch // self.sequence) + last

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Sequence i and its mask, at any place."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        ((ids, mask),) = self.pieces(i * self.sequence, self.sequence)
        return ids, mask

    def pieces(self, start: int, n: int):
        """The ids and masks from ``start`` on, one piece for each batch that they lie in."""
        while n:
            i, lo = divmod(start, self.per_batch)
            ids, mask = self._batch(i)
            k = min(n, len(ids) - lo)
            if k <= 0:
                raise IndexError(start)
            yield ids[lo:lo + k], mask.slice(lo, k)
            start, n = start + k, n - k


def token_files(docs: DataFrame, tokenizer_file: str, folder: str | None = None, end_id: int = END_ID, sequence: int = SEQUENCE,
                batch_rows: int = BATCH, id_col: str = "doc_id", text_col: str = "text") -> tuple[str, DataFrame]:
    """Encodes and writes ``docs``; gives the folder and the manifest.

    A null or empty text has the end id alone.  Repeated rows are written each.  An empty
    table writes no file.  Other columns are not read.  ``folder`` must be seen by all executors.
    """
    folder = folder or shared_path(docs.sparkSession, "token-files")
    return folder, write_token_files(docs, tokenizer_file, folder, end_id, sequence, batch_rows, None, id_col, text_col)
