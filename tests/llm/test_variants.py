import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from llm_data import SMALL
from quayside.llm import variants as V


def one_edit(a, b):
    """Exactly one insertion, deletion or replacement apart (by trying all)."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(a == b[:k] + b[k + 1:] for k in range(len(b)))


def brute(docs):
    """The contract, word by word and pair by pair (pairs via shared deletions)."""
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    by = {}
    for w in words:
        for k in {w, *(w[:k] + w[k + 1:] for k in range(len(w)))}:
            by.setdefault(k, []).append(w)
    near = {w: set() for w in words}
    for group in by.values():
        for a in group:
            near[a].update(b for b in group if a != b and one_edit(a, b))
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def _rows(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=lambda r: r[0])


def test_documents_equal_brute_force(spark, small_rows):
    got, want = _rows(V.op13(spark, SMALL)), brute(small_rows)
    assert got == want and any(r[1] for r in want)


def _pairs(spark, words):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [tuple(r) for r in V.near_words(df).collect()]
    want = [(a, words[a], b, words[b]) for a in words for b in words if a != b and one_edit(a, b)]
    assert sorted(got) == sorted(want)
    return want


def test_near_words_of_dense_short_words(spark, rng):
    words = {"".join(rng.choices("abé", k=rng.randint(1, 5))): rng.randint(1, 9) for _ in range(150)}
    assert len(_pairs(spark, words)) > 500


def test_long_words_need_few_levels(spark):
    long = "x" * 4000
    words = {long: 5, long + "x": 3, long[:2000] + "y" + long[2001:]: 4, "y" + long: 3, long[1:] + "z": 7, "zzzzz": 3}
    assert len(_pairs(spark, words)) >= 8


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text(alphabet=st.sampled_from(list("abcßÿ")), min_size=1, max_size=6), min_size=1, max_size=40))
def test_any_words(spark, words):
    _pairs(spark, {w: 1 + k for k, w in enumerate(sorted(words))})


def test_roots_follow_chains(spark):
    rows = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", None), ("x", None), ("y", "e")]
    got = {r.word: r.root for r in V.with_roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {"a": "e", "b": "e", "c": "e", "d": "e", "e": "e", "x": "x", "y": "e"}


def test_previous_spans_partitions(spark):
    values = sorted({f"w{k * 7919 % 1000:03d}" for k in range(500)})
    got = {r.w: r.p for r in V.with_previous(spark.createDataFrame([(v,) for v in values], "w string"), "w", "p").collect()}
    assert got == dict(zip(values, [None, *values[:-1]]))


def test_odd_documents(spark, odd_docs, odd_dir):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert _rows(V.op13(spark, odd_dir)) == brute(docs)


def test_texts_of_hot_words(spark, tmp_path):
    rng = random.Random(11)
    rows = [(k, " ".join(rng.choices(["weather", "Weather", "whether", "wether", "weathers", "ÀCCENT", "Àccent", "accent"], [50, 9, 20, 3, 2, 1, 4, 2], k=40)))
            for k in range(200)] + [(None, None), (None, "Straße straße STRASSE straße"), (5, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert _rows(V.op13(spark, str(tmp_path))) == brute(rows)
