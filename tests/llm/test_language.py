import math
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_data import SMALL
from quayside.llm import language as L


@pytest.fixture(scope="module")
def result(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs.select("doc_id", "text", "lang").join(L.op2(spark, "/root/testdata/sf0.01"), "doc_id").collect()


def test_held_out_accuracy(result):
    held = [r for r in result if r.held_out and r.lang]
    assert len(held) > 150
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in result)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in result)


def test_mixture_is_found(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) > 1500")
    model = L.train(docs)
    text = {r.lang: r.text for r in docs.collect()}
    mixed = spark.createDataFrame([("one", text["en"][:1500]), ("two", text["en"][:900] + " " + text["fr"][:600])], "k string, text string")
    got = {r.k: r.language for r in L.with_language(mixed, model).collect()}
    assert set(got["one"].proportions) == {"en"}
    assert set(got["two"].proportions) == {"en", "fr"} and got["two"].lang == "en"
    assert abs(got["two"].proportions["en"] - 0.6) < 0.12 and got["two"].score == got["two"].proportions["en"]


def test_em_recovers_proportions(rng):
    g = np.random.default_rng(5)
    probs = g.dirichlet(np.ones(200) * 0.2, size=3).T + 1e-9
    true = np.array([0.7, 0.3, 0.0])
    counts = np.bincount(g.choice(200, size=20000, p=probs @ true / (probs @ true).sum()), minlength=200).astype(float)
    share, _ = L.mixture(counts, probs, rounds=200)
    assert np.abs(share - true).max() < 0.03
    chosen, _ = L.infer(counts, np.log(probs))
    assert sorted(chosen) == [0, 1]


def brute_grams(text):
    """Bucket -> count of the byte trigrams of a text's letters, any other run
    as one space, between two spaces."""
    cleaned, gap = [], False
    for c in (text or "").lower():
        if unicodedata.category(c)[0] in "LM":
            cleaned.append(c)
            gap = False
        elif not gap:
            cleaned.append(" ")
            gap = True
    b = (" " + "".join(cleaned) + " ").encode()
    return Counter((int.from_bytes(b[i:i + 3], "big") * 2654435761 % 2**32) >> 18 for i in range(len(b) - 2))


def brute_em(grams, model, names):
    """Shares by expectation-maximisation, gram by gram, and the log-likelihood."""
    total, share = sum(grams.values()), {x: 1 / len(names) for x in names}
    for _ in range(L.ROUNDS):
        new = dict.fromkeys(names, 0.0)
        for g, n in grams.items():
            parts = {x: share[x] * model[x][g] for x in names}
            whole = sum(parts.values())
            for x in names:
                new[x] += n * parts[x] / whole / total
        moved, share = max(abs(new[x] - share[x]) for x in names), new
        if moved < 1e-3:
            break
    return share, sum(n * math.log(sum(share[x] * model[x][g] for x in names)) for g, n in grams.items())


def brute_languages(grams, model):
    names = sorted(model)
    single = {x: sum(n * math.log(model[x][g]) for g, n in grams.items()) for x in names}
    top = max(names, key=lambda x: single[x])
    share, best, price = {top: 1.0}, single[top], L.PENALTY * math.log(sum(grams.values()))
    all_shares, most = brute_em(grams, model, names)
    while len(share) < len(names) and most - best > price:
        rest = sorted((x for x in names if x not in share), key=lambda x: -all_shares[x])[:3]
        tried = [brute_em(grams, model, [*share, x]) for x in rest]
        more, value = max(tried, key=lambda t: t[1])
        if value - best <= price:
            break
        share, best = more, value
    return share


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()
    counts = defaultdict(Counter)
    for r in docs:
        if r.lang is not None and r.text and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            counts[r.lang] += brute_grams(r.text)
    model = {x: {g: (n[g] + L.SMOOTHING) / (n.total() + L.SMOOTHING * L.BUCKETS) for g in range(L.BUCKETS)} for x, n in counts.items()}
    got = {r.doc_id: r for r in L.op2(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for r in docs:
        g = got[r.doc_id]
        if not any(c.isalpha() for c in r.text or ""):
            assert (g.lang_pred, g.score) == ("und", 0.0)
            continue
        want = brute_languages(brute_grams(r.text), model)
        assert set(g.proportions) == set(want)
        assert all(abs(g.proportions[x] - want[x]) < 1e-9 for x in want)
        assert g.lang_pred == max(want, key=lambda x: want[x]) and abs(g.score - max(want.values())) < 1e-9


def test_odd_texts(spark, odd_docs, empty_docs):
    model = L.train(odd_docs)
    got = {(r.doc_id, r.text): r.language for r in L.with_language(odd_docs, model).collect()}
    for (_, text), g in got.items():
        lettered = any(c.isalpha() for c in text or "")
        assert (g.lang == "und") == (not lettered) and (g.score == 0) == (not lettered)
    untrained = L.with_language(odd_docs, L.train(empty_docs)).collect()
    assert {r.language.lang for r in untrained} == {"und"}
    kept = L.identified(odd_docs)
    assert kept.columns == odd_docs.columns
    assert all(any(c.isalpha() for c in r.text or "") for r in kept.collect())
