import os
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_data import ODD_TEXTS
from quayside.llm import records as R

PATH = R.vocabulary("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODEC = R._codec(PATH)


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def ids_of(text):
    return np.frombuffer(CODEC.encode(text or ""), "<u2").tolist()


def test_odd_texts_and_documents(small_rows):
    for text in [*ODD_TEXTS, *(t for _, t in small_rows)]:
        assert ids_of(text) == expected(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abE's'tred .,!?\n\t  09éßİ́日😀  \x1c\x85<|>")), max_size=40))
def test_any_text(text):
    assert ids_of(text) == expected(text)


def test_round_trip_in_order(spark, odd_docs, tmp_path):
    manifest = R.write_shards(odd_docs, str(tmp_path / "a"), PATH, shards=5)
    shards = manifest.orderBy("shard").collect()
    back = [(i, ids.tolist()) for s in shards for i, ids in R.records(s.file, s.width)]
    rows = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [i for i, _ in back] == [r.doc_id for r in rows]
    assert sorted(map(str, back)) == sorted(str((r.doc_id, expected(r.text) + [0])) for r in rows)
    at = 0
    table = {}
    for i, ids in back:
        table.setdefault(i, []).append((at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    got = {}
    for r in R.read_shards(manifest).orderBy("start").collect():
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    assert got == table
    for s in shards:  # shuffled reads by the index
        for k, (i, ids) in reversed(list(enumerate(R.records(s.file, s.width)))):
            j, same = R.read_record(s.file, s.index_file, k, s.width)
            assert i == j and (ids == same).all()


def test_damage_is_seen(spark, odd_docs, tmp_path):
    file = R.write_shards(odd_docs, str(tmp_path / "b"), PATH, shards=1).first().file
    data = bytearray(open(file, "rb").read())
    for at in (0, 9, 13, 30, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        path = os.path.join(str(tmp_path), "broken.rec")
        with open(path, "wb") as f:
            f.write(broken)
        with pytest.raises((ValueError, struct.error)):
            list(R.records(path, 2))


def test_plain_texts_share_their_pieces():
    """A word met beside ever new signs is merged once."""
    codec, words = R.ByteLevelCodec(PATH), ["harbour", "café", "Łódź"]
    texts = [f" {w}{a}{b} {w}'s" for w in words for a in ".,;:!?" for b in "\")]}»"]
    met = []
    codec.pieces.compute = lambda piece: met.append(piece) or codec._piece(piece)
    for text in texts:
        assert np.frombuffer(codec.encode(text), "<u2").tolist() == expected(text)
    assert not codec.chunks and sorted(p for p in met if p.strip() in words) == sorted(f" {w}" for w in words)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("a's'tred9 \t\n\r_-.")), st.characters(min_codepoint=0x21, max_codepoint=0x24F)), max_size=60))
def test_any_plain_text(text):
    assert ids_of(text) == expected(text)
