import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_data import SMALL
from quayside.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def _usable(rows):
    return [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]


def brute(rows, components=8):
    """Plain Python integers, then one eigh."""
    rows = [(i, [math.floor(1024 * float(c)) + 100000 for c in v]) for i, v in _usable(rows)]
    n, dims = len(rows), len(rows[0][1])
    s = [sum(x[d] for _, x in rows) for d in range(dims)]
    v = np.array([[sum((n * x[a] - s[a]) * (n * x[b] - s[b]) for _, x in rows) / n ** 3 for b in range(dims)] for a in range(dims)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    keep = [k for k in range(min(components, dims)) if e[k] > 1e-12 * e[0] and e[k] > 0]
    out = {}
    for i, x in rows:
        far = [n * a - b for a, b in zip(x, s)]
        for k in keep:
            out[i, k + 1] = (n, sum(f * f for f in far), float(np.dot(np.array([f / n for f in far]), u[:, k]) / math.sqrt(e[k])), e[k] / np.trace(v))
    return out


def _same(got, want):
    assert {(r.vec_id, r.component) for r in got} == set(want) and len(got) == len(want)
    signs = {}
    for r in got:
        n, deviation, value, share = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(share, rel=1e-9) and 0 <= r.identity_error < 1e-9
        if abs(value) > 1e-3:
            sign = signs.setdefault(r.component, math.copysign(1, r.whitened * value))
            assert sign * r.whitened == pytest.approx(value, rel=1e-6, abs=1e-7)


def _table(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def test_small_table_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    _same(W.op12(spark, SMALL).collect(), brute(rows))


def test_odd_rows_are_left_out_and_counted_nowhere(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, [rng.gauss(0, 1 + d) - 200 * (d == 2) for d in range(5)]) for k in range(300)]
    rows += [(1000 + k, rows[0][1]) for k in range(200)]  # one vector holds much of the table
    odd = [(900, None), (901, []), (902, [None] * 5), (903, [float("nan")] * 5), (904, [1.0, 2.0, float("inf"), 0.0, 0.0]),
           (905, [0.0, None, 0.0, 0.0, 0.0])]
    d = _table(spark, tmp_path, rows + odd)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    _same(W.op12(spark, d).collect(), brute(rows))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, tmp_path, rows):
    assert W.op12(spark, _table(spark, tmp_path, rows)).collect() == []


def test_null_and_repeated_ids_and_clashing_names(spark, tmp_path):
    rows = [(None, [1.0, 0.5], "x", 1), (7, [0.0, 2.0], "y", 2), (7, [3.0, 1.0], None, None), (8, [0.0, 2.0], "z", 3)]
    d = _table(spark, tmp_path, rows, "vec_id long, embedding array<float>, whitened string, n int")
    got = W.op12(spark, d).collect()
    assert sorted(str(r.vec_id) for r in got) == ["7"] * 4 + ["8"] * 2 + ["None"] * 2 and {r.n for r in got} == {4}
    with pytest.raises(ValueError):
        W.whitened(spark.read.parquet(f"{d}/embeddings.parquet"), "embedding", W.fitted(W.finite(spark.createDataFrame(
            [(1, [1.0, 2.0]), (2, [0.0, 1.0])], SCHEMA), "embedding"), "embedding"))


def test_vectors_of_several_lengths_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], SCHEMA)
    with pytest.raises(Exception, match="several lengths"):
        W.value_ranges(df, "embedding")


def test_wide_deviations_stay_exact(spark, tmp_path):
    rows = [(k, [1000.0 * (k % 7), -750.0 * (k % 5), float(k)]) for k in range(700)]
    _same(W.op12(spark, _table(spark, tmp_path, rows)).collect(), brute(rows))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 2 ** 20)] * 3), min_size=1, max_size=200))
def test_planes_give_exact_products(rows):
    y = np.array(rows, "int64")
    bits = np.array([21, 21, 21])
    counts = W.plane_counts(W.packed_planes(y, bits))
    both = counts + np.triu(counts, 1).T
    weight = 1 << np.tile(np.arange(21), 3)
    for i in range(3):
        for j in range(3):
            block = both[21 * i:21 * i + 21, 21 * j:21 * j + 21] * np.outer(weight[:21], weight[:21])
            assert block.sum() == (y[:, i] * y[:, j]).sum()


def test_a_deviation_beyond_64_bits_is_null(spark, tmp_path):
    rows = [(k, [4e4 * (k % 7), float(k)]) for k in range(700)]
    got = {r.vec_id: r.deviation for r in W.op12(spark, _table(spark, tmp_path, rows)).collect()}
    want = {i: d for (i, c), (_, d, _, _) in brute(rows).items() if c == 1}
    assert all(got[i] == (want[i] if want[i] < 2 ** 63 else None) for i in want) and None in got.values()
