"""SentencePiece encoding and decoding with original offsets (operator 10).

The normaliser is the library's: the longest prefix that the compiled character map knows is
replaced, other characters stay.  Here each normalised byte remembers the bytes it came from, so
every piece of the library's encoding is projected to a span of original bytes.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from annoflow.llm.common import slices

MODEL = "piece_bpe_32k.model"
SPACE = "▁".encode()


class CharacterMap:
    """Longest-prefix lookup in a compiled character map.

    The map is four bytes of trie size, a double array of 32-bit units, and zero-terminated
    replacements.  In a unit, bits 0-7 and 31 are the label, bit 8 tells that a key ends below, and bits 10-30 (times
    256 if bit 9 is set) lead to the children; the unit of a key's end holds its value.
    """

    def __init__(self, compiled: bytes):
        size = struct.unpack("<I", compiled[:4])[0] if compiled else 0
        self.units = np.frombuffer(compiled, dtype="<u4", count=size // 4, offset=4).tolist() if size else []
        self.replacements = compiled[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix of data[at:], and its replacement."""
        units, found = self.units, None
        if not units:
            return None
        node = self._children(0, units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            has_value = unit >> 8 & 1
            node = self._children(node, unit)
            if has_value:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        n, value = found
        return n, self.replacements[value:self.replacements.index(0, value)]

    @staticmethod
    def _children(node: int, unit: int) -> int:
        return node ^ (unit >> 10 << (unit >> 6 & 8))


class Normalizer:
    """Normalises one text and keeps, for each normalised byte, the original bytes it stands for."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.mark = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(normalised bytes, begin, end): byte i stands for data[begin[i]:end[i]]."""
        raw = np.frombuffer(data, dtype=np.uint8)
        if self.map.units:
            out, lo, hi = self._mapped(data)
        else:
            at = np.arange(len(raw), dtype=np.int64)
            out, lo, hi = raw, at, at + 1
        if self.squeeze:
            space = out == 0x20
            first = np.concatenate([[True], space[:-1]])  # leading, or behind another space
            keep = ~(space & first)
            last = np.flatnonzero(keep & ~space)
            keep[last[-1] + 1 if len(last) else 0:] = False
            out, lo, hi = out[keep], lo[keep], hi[keep]
        if not len(out):
            none = np.zeros(0, dtype=np.int64)
            return none.astype(np.uint8), none, none
        if self.prefix:
            out, lo, hi = (np.concatenate([[first], x]) for first, x in ((0x20, out), (lo[0], lo), (lo[0], hi)))
        if self.mark:
            wide = out == 0x20
            times = np.where(wide, len(SPACE), 1)
            place = np.cumsum(times) - times
            grown = np.repeat(out, times).astype(np.uint8)
            for k, byte in enumerate(SPACE):
                grown[place[wide] + k] = byte
            out, lo, hi = grown, np.repeat(lo, times), np.repeat(hi, times)
        return out, lo, hi

    def _mapped(self, data: bytes):
        parts, begins, ends, at, n = [], [], [], 0, len(data)
        while at < n:
            hit = self.map.longest(data, at)
            if hit is None:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                piece = data[at:at + size]
                begins += range(at, at + size)
                ends += range(at + 1, at + size + 1)
            else:
                size, piece = hit
                begins += [at] * len(piece)
                ends += [at + size] * len(piece)
            parts.append(piece)
            at += size
        return (np.frombuffer(b"".join(parts), dtype=np.uint8), np.array(begins, dtype=np.int64), np.array(ends, dtype=np.int64))


class Codec:
    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        proto = model_pb2.ModelProto()
        proto.ParseFromString(self.library.serialized_model_proto())
        self.normalize = Normalizer(proto.normalizer_spec)
        byte_kind = model_pb2.ModelProto.SentencePiece.BYTE
        #: Bytes of normalised text under each piece; a byte piece is one byte.
        self.size = np.array([1 if p.type == byte_kind else len(p.piece.encode()) for p in proto.pieces], dtype=np.int64)
        self.unknown = self.library.unk_id()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1) if ids else []

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Original byte span of each piece."""
        out, lo, hi = self.normalize(text.encode())
        sizes = self.size[ids]
        if self.unknown in ids:  # an unknown piece is as long as the text it stands for
            sizes = np.array([len(p.encode()) for p in self.library.encode(text, out_type=str)], dtype=np.int64)
        stop = np.cumsum(sizes)
        if (int(stop[-1]) if len(stop) else 0) != len(out):
            raise ValueError("pieces do not cover the normalised text")
        if not len(stop):
            return stop, stop
        return lo[stop - sizes], hi[stop - 1]


@lru_cache(maxsize=2)
def codec(model_file: str) -> Codec:
    """One per Python worker."""
    return Codec(model_file)


def encode_documents(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids, begin and end (original byte span of each piece), decoded.

    A null or empty text has no ids and decodes to an empty text.  Null ids and repeated rows
    stay as they are; an empty table gives no rows; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.list_(pa.int32())) for c in ("ids", "begin", "end")), ("decoded", pa.string())])

    def run(batches):
        c = codec(model_file)
        for b in batches:
            for at, n in slices(b.column(1)):
                texts = [t or "" for t in b.column(1).slice(at, n).to_pylist()]
                ids = c.encode(texts)
                spans = [c.spans(t, i) for t, i in zip(texts, ids)]
                border = pa.array(np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32))

                def lists(values):
                    return pa.ListArray.from_arrays(border, pa.array(np.concatenate(values).astype(np.int32)))

                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, n), lists([np.array(i, dtype=np.int32) for i in ids]), lists([s[0] for s in spans]),
                     lists([s[1] for s in spans]), pa.array(c.decode(ids), pa.string())], schema=schema)

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, ids array<int>, begin array<int>, end array<int>, decoded string")


def digest(encoded: DataFrame) -> DataFrame:
    """With a check that spans follow one another."""
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"),
                          F.coalesce(F.try_element_at("end", F.lit(-1)), F.lit(0)).cast("long").alias("bytes_covered"))
