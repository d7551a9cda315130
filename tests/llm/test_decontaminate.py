import hashlib
import re

from llm_data import SMALL
from quayside.llm import decontaminate as D


def brute(text, items):
    def words(t):
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        m = min(13, len(v))
        windows = {tuple(v[k:k + m]) for k in range(len(v) - m + 1)} if m else set()
        for k in range(len(w) - m + 1 if m else 0):
            if tuple(w[k:k + m]) in windows:
                hit.update(range(k, k + m))
                found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)


def test_search_equals_brute_force(rng):
    for _ in range(300):
        letters = "ab" if rng.random() < 0.5 else "abcdef"
        items = [(str(k), " ".join(rng.choices(letters, k=rng.randint(0, 20)))) for k in range(rng.randint(0, 5))]
        text = " ".join(rng.choices(letters, k=rng.randint(0, 120)))
        tables = D.build_tables([(i, t.encode()) for i, t in items])
        words = D.words_of(text.encode())
        spans, found = D.find(tables, words)
        want = brute(text, items)
        assert (len(words), sum(b - a for a, b in spans), len(found)) == want[:3]


def test_blocks_give_the_same_result(spark, small_rows):
    docs = spark.createDataFrame(small_rows, "doc_id long, text string")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = {i: brute(t, items) for i, t in small_rows}
    assert any(w[4] for w in want.values())
    for size in (1 << 20, 2000):
        rows = D.benchmark_hits(docs, bench, block_bytes=size).select(
            "doc_id", "hits", D.n_hit(D.F.col("hits")).alias("n"), D.is_contaminated(D.F.col("hits")).alias("bad")).collect()
        got = {r.doc_id: (r.hits.n_words, r.n, len(r.hits["items"]),
                          hashlib.sha256(",".join(sorted(r.hits["items"])).encode()).hexdigest(), r.bad) for r in rows}
        assert got == want


def test_odd_documents(spark, odd_dir):
    items = [(1, "the cat sat on the mat"), (4, spark.read.parquet(f"{odd_dir}/benchmark.parquet").where("item_id = 4").first().text)]
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((brute(r.text, items) for r in docs), key=str)
    got = D.op10(spark, odd_dir).collect()
    assert sorted(((r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=str) == want
