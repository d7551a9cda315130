import hashlib
import re

from pyspark.sql import functions as F

from quayside.llm import fingerprint as S


def signatures(text):
    words = [w for w in re.sub(r"[^\w]|_", " ", (text or "").lower()).split()]
    common = set(S.anchor_words())
    out = set()
    for k, w in enumerate(words):
        if w in common:
            chain = [x for x in words[k + 1:] if x not in common][:S.CHAIN]
            if chain:
                out.add((w, *chain))
    return out or ({("whole", *words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def ring(rows):
    rows = sorted((i, t or "") for i, t in rows if i is not None)
    return [(i, t, rows[(k + 1) % len(rows)][1]) for k, (i, t) in enumerate(rows)]


def check(spark, folder, rows):
    got = sorted((r for r in S.op1(spark, folder).collect() if r.doc_id is not None), key=lambda r: (r.doc_id, r.n_chars))
    by_text = {}
    want = ring(rows)
    assert len(got) == len(want)
    for r, (i, text, following) in zip(got, want):
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert (r.doc_id, r.n_chars) == (i, len(text))
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - jaccard(signatures(text), signatures(edited))) < 1e-12
        assert abs(r.near_next - jaccard(signatures(text), signatures(following))) < 1e-12
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1.0)


def test_small_table(spark, small_rows, tmp_path):
    spark.createDataFrame(small_rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    check(spark, str(tmp_path), small_rows)


def test_sparse_ids(spark, small_rows, tmp_path, rng):
    ids = rng.sample(range(-10**12, 10**12), 80) + list(range(5000, 5040)) + [10**17, -10**17]
    rows = [(i, t) for i, (_, t) in zip(ids, small_rows)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    check(spark, str(tmp_path), rows)


def test_block_order_takes_a_row_per_slice_to_one_task(spark, rng):
    ids = sorted(rng.sample(range(-10**15, 10**15), 5000))
    firsts = spark.createDataFrame([(i // S.BLOCK, i) for i in ids], "block long, doc_id long")
    ordered = S.block_order(firsts)
    home = {r.doc_id: r.home for r in ordered.collect()}
    assert home == {i: ids[k - 1] // S.BLOCK for k, i in enumerate(ids)}
    # what is sorted in a single task is an aggregate by slice
    plan = ordered._jdf.queryExecution().executedPlan().toString().splitlines()
    single = next(k for k, line in enumerate(plan) if "SinglePartition" in line)
    assert any("HashAggregate(keys=[slice" in line for line in plan[single:single + 2])
    assert not any("block#" in line and "SinglePartition" in line for line in plan)


def test_one_document_follows_itself(spark, tmp_path):
    spark.createDataFrame([(5, "the cat and the dog")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    r = S.op1(spark, str(tmp_path)).first()
    assert r.near_next == 1.0


def test_odd_rows_with_null_id(spark, odd_dir):
    rows = [r for r in S.op1(spark, odd_dir).collect() if r.doc_id is None]
    assert [r.near_next for r in rows] == [1.0, 1.0]


def test_pruning_bound(spark):
    rows = spark.createDataFrame([([1, 2, 3, 4], [1]), ([1, 2, 3, 4], [1, 2, 3, 4, 5]), ([], []), ([], [1])], "a array<int>, b array<int>")
    got = [r[0] for r in rows.select(S.pruned_jaccard(F.col("a"), F.col("b"), 0.8)).collect()]
    assert got == [0.0, 0.8, 1.0, 0.0]
    parts = spark.range(1, 400).select("id", S.length_partition(F.col("id")).alias("p")).collect()
    by = {r.id: r.p for r in parts}
    assert all(abs(by[a] - by[b]) <= 1 for a in by for b in range(a, min(400, int(a / 0.8) + 1)))
