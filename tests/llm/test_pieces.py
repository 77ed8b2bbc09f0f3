from hashlib import sha256

import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from annoflow.llm import pieces as S
from annoflow.llm.common import read
from annoflow.llm.queries import tokenizer

MODEL = tokenizer(S.MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_whole_table(spark, sf001, library):
    docs = read(spark, sf001, "documents")
    got = {r.doc_id: r for r in S.encode_documents(docs, MODEL).collect()}
    for r in docs.collect():
        ids = library.encode(r.text or "")
        assert list(got[r.doc_id].ids) == ids and got[r.doc_id].decoded == library.decode(ids)
        data = (r.text or "").encode()
        g = got[r.doc_id]
        assert all(a == b for a, b in zip(g.begin[1:], g.end))  # spans follow one another and cover the text
        assert not data or (g.begin[0] == 0 and g.end[-1] == len(data))
    for r in S.digest(S.encode_documents(docs, MODEL)).collect():
        assert r.ids_sha256 == sha256(",".join(map(str, got[r.doc_id].ids)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256(got[r.doc_id].decoded.encode()).hexdigest()


def test_odd_rows(spark, odd, empty, library):
    rows = S.encode_documents(odd, MODEL).collect()
    want = [(r.doc_id, library.encode(r.text or "")) for r in odd.collect()]
    assert sorted(((r.doc_id, list(r.ids)) for r in rows), key=str) == sorted(want, key=str)
    assert S.encode_documents(empty, MODEL).count() == 0


@given(st.text(alphabet=st.characters(exclude_categories=["Cs"], exclude_characters="\0"), max_size=40))
@settings(max_examples=300, deadline=None)
def test_spans_point_at_the_pieces(text):
    c = S.codec(MODEL)
    ids = c.encode([text])[0]
    lo, hi = c.spans(text, ids)
    data, proto = text.encode(), c.library
    for i, a, b in zip(ids, lo, hi):
        if not proto.is_byte(i):
            assert proto.id_to_piece(i).replace("▁", " ").lstrip(" ") == data[a:b].decode().replace("▁", " ").lstrip(" ")


SAMPLES = ["ｈｅｌｌｏ　ｗｏｒｌｄ ①②③ ㍿ ﬁne", "  a  b   c  ", "é é ½ ™ İ", "한국어 テスト ﾃｽﾄ", "", "   ", "​­x y\t\n z", "ﷺ"]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf", "identity"])
def test_compiled_maps_give_what_the_library_gives(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    from sentencepiece import sentencepiece_model_pb2 as model_pb2
    proto = model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    spec = proto.normalizer_spec
    spec.add_dummy_prefix = spec.escape_whitespaces = spec.remove_extra_whitespaces = True
    mine = S.Normalizer(spec)
    for text in SAMPLES:
        out, lo, hi = mine(text.encode())
        assert out.tobytes().decode() == library.normalize(text), (rule, text)
        assert (lo <= hi).all() and (lo[1:] >= lo[:-1]).all() and (not len(hi) or hi.max() <= len(text.encode()))
