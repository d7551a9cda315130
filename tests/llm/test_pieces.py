import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_data import ODD_TEXTS, SMALL
from quayside.llm import pieces as P

PATH = P.vocabulary("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
SEGMENTER = P.segmenter(PATH)


def by_table(text, common=None):
    rows = next(P.Join(SEGMENTER, common or {}).block([text]))
    ids = np.frombuffer(b"".join(i for i, _ in rows), "<u4").tolist()
    return ids, "".join(d for _, d in rows)[1:]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abthe  ▁\n\t.,0<>sé日😀\x00\x1c ")), max_size=50))
def test_any_text(text):
    ids, back = by_table(text)
    assert ids == LIBRARY.encode(text) and back == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_characters(text):
    text = text.encode("utf-8", "ignore").decode("utf-8")
    ids, back = by_table(text)
    assert ids == LIBRARY.encode(text) and back == LIBRARY.decode(ids)


def test_table_holds_the_most_frequent_words_once(spark):
    df = spark.createDataFrame([("a b a",), ("a b c",), (None,), ("",)], "text string")
    got = {r.chunk: (list(np.frombuffer(r.ids, "<u4")), r.decoded) for r in P.chunk_table(df, PATH, common=2).collect()}
    assert got == {"▁a": (LIBRARY.encode("a"), " a"), "▁b": (LIBRARY.encode("b"), " b")}


@pytest.mark.parametrize("common", [0, 3, P.COMMON])
def test_general_interface(spark, odd_docs, common):
    df = P.decoded(P.encoded(odd_docs, PATH, common=common), PATH)
    for r in df.collect():
        assert list(r.ids) == LIBRARY.encode(r.text or "") and r.decoded == LIBRARY.decode(list(r.ids))


def test_taken_names_are_an_error(spark, odd_docs):
    with pytest.raises(ValueError):
        P.encoded(odd_docs, PATH, ids="LANG")


def test_models_with_crossing_pieces_are_an_error(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.pieces[5000].piece = "of▁the"
    bad = tmp_path / "bad.model"
    bad.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        P.Segmenter(str(bad))


def expected(doc_id, text):
    ids = LIBRARY.encode(text or "", add_bos=True, add_eos=True)
    return (str(doc_id), len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest())


@pytest.mark.parametrize("where", ["odd", "small"])
def test_query_equals_the_library(spark, odd_dir, where):
    d = odd_dir if where == "odd" else SMALL
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in P.op11(spark, d).collect())
    assert got == sorted(expected(*r) for r in docs)


def test_blocks_do_not_change_the_result(monkeypatch):
    texts = [t for t in ODD_TEXTS] * 2
    whole = list(P.Join(SEGMENTER, {}).texts(texts))
    monkeypatch.setattr(P, "BLOCK", 7)
    assert list(P.Join(SEGMENTER, {}).texts(texts)) == whole and len(whole) == len(texts)
