"""The pipeline against a brute-force version over the small table."""
import hashlib

import corpus_pipeline
from llm_data import SMALL, written
from pyspark.sql import functions as F
from test_bpe import LIBRARY
from test_decontaminate import brute as contamination
from test_neardup import brute as components
from test_spans import PII

from quayside.llm import pii


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "pii", "tokens"]


def redact(text):
    spans = sorted((m.start(), n, m.end(), k) for n, (k, p, ok) in enumerate(PII) for m in p.finditer(text) if ok(m))
    out, at = "", 0
    for a, _, b, k in spans:
        if b > at:
            out += (text[at:a] + f"<{k.upper()}>") if a >= at else ""
            at = b
    return out + text[at:]


def brute(rows, items):
    rows = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    component = components(rows, 5, 80)
    rows = [(i, t) for i, t in rows if component[i][1] == i]
    rows = [(i, redact(t)) for i, t in rows if not contamination(t, items)[4]]
    out = []
    for i, t in rows:
        ids = LIBRARY.encode(t, add_special_tokens=False).ids
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out)


def test_run_equals_brute_force(spark, small_rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert len(got) < len(small_rows) and got == brute(small_rows, items)


def test_columns_are_kept(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_after = stage(spark, docs, odd_dir)
        assert docs_after.dtypes == docs.dtypes
        docs = docs_after
