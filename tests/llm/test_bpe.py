import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_data import ODD_TEXTS
from quayside.llm import bpe as B

PATH = B.vocabulary("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODEC = B.codec(PATH)


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_odd_texts_and_documents(small_rows):
    for text in [*ODD_TEXTS, *(t for _, t in small_rows)]:
        ids = CODEC.encode(text)
        assert ids == expected(text)
        assert CODEC.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abE's'tred .,!?\n\t09éßİſﬁ́日😀  \x1c\x85<|>")), max_size=40))
def test_any_text(text):
    assert CODEC.encode(text) == expected(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_characters(text):
    text = text.encode("utf-8", "ignore").decode("utf-8")
    assert CODEC.encode(text) == expected(text)


def test_cuts_are_no_pair_of_a_token():
    rng = random.Random(3)
    pieces = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzĠÃ©qxzj0", k=30)) for _ in range(50)]
    cut = [CODEC.fragments_of(p) for p in pieces]
    assert all("".join(f) == p for f, p in zip(cut, pieces)) and any(len(f) > 1 for f in cut)


def test_general_interface_and_query(spark, odd_docs, odd_dir):
    df = B.decoded(B.encoded(odd_docs, PATH), PATH)
    for r in df.collect():
        assert r.ids == expected(r.text) and r.decoded == LIBRARY.decode(r.ids, skip_special_tokens=False)
    want = sorted((str(r.doc_id), len(i := expected(r.text)), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(),
                   hashlib.sha256(LIBRARY.decode(i, skip_special_tokens=False).encode()).hexdigest()) for r in odd_docs.collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.op3(spark, odd_dir).collect()) == want
