import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from annoflow.llm import token_files as T
from annoflow.llm.common import read
from annoflow.llm.queries import tokenizer

FILE = tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(FILE)


def check(spark, docs, tok, **sizes):
    folder, manifest = T.token_files(docs, FILE, **sizes)
    got = [tuple(r) for r in T.read_token_files(spark, folder, manifest).collect()]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("x")).collect()
    rows.sort(key=lambda r: (r.doc_id is None, r.doc_id, r.x))
    rows = [(r.doc_id, [*tok.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in rows]
    want, at = [], 0
    for d, ids in rows:
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    return folder, manifest.collect()


def test_whole_table(spark, sf001, tok):
    folder, manifest = check(spark, read(spark, sf001, "documents"), tok)
    store, root = T._filesystem(folder)
    for m in manifest:
        name = f"{root}/part-{m.part:05d}.arrow"
        with pa.memory_map(name) as f:
            before = pa.total_allocated_bytes()
            file = pa.ipc.open_file(f)
            b = file.get_batch(0)
            ids, mask = b.column(0).flatten().to_numpy(zero_copy_only=True), b.column(1).flatten()
            assert b.schema.field("ids").type.list_size == b.schema.field("mask").type.list_size == T.SEQUENCE
            assert len(ids) == len(mask) and pa.total_allocated_bytes() - before < ids.nbytes
            total = sum(int(pc.sum(file.get_batch(i).column(1).flatten()).as_py() or 0) for i in range(file.num_record_batches))
            assert total == m.tokens


@pytest.mark.parametrize("sequence,batch_rows", [(1, 1), (7, 3), (64, 2)])
def test_small_sequences(spark, odd, tok, sequence, batch_rows):
    check(spark, odd, tok, sequence=sequence, batch_rows=batch_rows)


def test_empty_table(spark, empty):
    folder, manifest = T.token_files(empty, FILE)
    assert manifest.count() == 0
    assert T.read_token_files(spark, folder, manifest).count() == 0


@pytest.mark.parametrize("capacity", [3, 100])
def test_word_by_word_is_exact(tok, capacity):
    texts = ["It's the END. x y\x1cz ́a é Σας ΌΣΟΣ", "<|startoftext|> a<|endoftext|>b <|endoftext|", "## # a\x85b \x0b\x0c", "", "  ",
             "日本語 テスト 1234 5 ½ ﬁ İstanbul", "'s 't' re ' ll\n'll", "a$$$ b%%%, c***. d### (e) f]. g-- h_ i\\ j\" k/ l= 9.. x'. y's. z'", "ÀÉ ÿß. ÷ × µ Þþ, ñ!! Ö.ö; ª", "Ça… É. é.. Ü<", "É\u0301. x", "End. END... x!? y….z…. <|ENDOFTEXT|>. <|endoftext|>.", "J\u030c. \u01f0, K\u212a. don't.'s;"]
    encoder = T.WordEncoder(FILE, capacity)
    for t, ids in zip(texts, encoder(texts)):
        assert np.frombuffer(ids, encoder.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_other_tokenizers_are_encoded_whole(spark, odd):
    from tokenizers import Tokenizer

    other = tokenizer("byte_bpe_50k.json")
    tok = Tokenizer.from_file(other)
    texts = ["two  spaces\n\nand lines", "It's the END. x y", " lead", "a b<|endoftext|> c", "", "日本語 1234"]
    encoder = T.WordEncoder(other)
    for t, ids in zip(texts, encoder(texts)):
        assert np.frombuffer(ids, encoder.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, t
    folder, manifest = T.token_files(odd, other, end_id=50256)
    got = {r.doc_id: r.n_tokens for r in T.read_token_files(spark, folder, manifest).where("doc_id in (4, 5, 6)").collect()}
    assert got == {r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in odd.where("doc_id in (4, 5, 6)").collect()}


def test_a_file_that_differs_in_a_rule_is_not_cut():
    import json

    file = json.loads(open(FILE).read())
    assert T.may_cut(file)
    for change in (lambda f: f["normalizer"]["normalizers"][1].update(content="_"), lambda f: f["normalizer"]["normalizers"].pop(),
                   lambda f: f["pre_tokenizer"]["pretokenizers"][1].update(add_prefix_space=True), lambda f: f["model"].update(dropout=0.1),
                   lambda f: f["added_tokens"][0].update(content="a b"), lambda f: f["added_tokens"][0].update(lstrip=True), lambda f: f.update(normalizer=None)):
        other = json.loads(json.dumps(file))
        change(other)
        assert not T.may_cut(other)


def test_sequences_are_views_at_any_place(spark, sf001, tok):
    folder, manifest = T.token_files(read(spark, sf001, "documents"), FILE, sequence=32, batch_rows=4)
    store, root = T._filesystem(folder)
    first = manifest.orderBy("part").first()
    with T.open_file(store, f"{root}/part-{first.part:05d}.arrow") as data:
        f = T.TokenFile(data)
        assert len(f) == -(-first.tokens // 32)
        whole = np.concatenate([f[i][0] for i in range(len(f))])
        for i in (len(f) - 1, 0, len(f) // 2, 3):
            before = pa.total_allocated_bytes()
            ids, mask = f[i]
            assert not ids.flags.owndata and pa.total_allocated_bytes() - before < 64
            assert ids.tolist() == whole[i * 32:i * 32 + 32].tolist() and mask.true_count == min(32, first.tokens - i * 32)
        with pytest.raises(IndexError):
            f[len(f)]
