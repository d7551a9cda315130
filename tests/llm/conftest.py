import random

import pytest
from llm_data import ODD_TEXTS, PROSE, SCHEMA, SMALL, written


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    rows = [(k, t, "en" if k % 3 else None, f"s{k % 2}" if k % 5 else None, len(t) if t else None) for k, t in enumerate(ODD_TEXTS)]
    rows += [(2, " ", "en", None, 1), (16, PROSE, "en", "s0", len(PROSE)), (None, PROSE, "de", "s1", None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_dir(spark, odd_docs, tmp_path_factory):
    from pyspark.sql import functions as F

    clash = ["n_words", "hits", "component_id", "kept", "key", "spans", "ids", "n_tokens", "language", "start", "next_text", "words", "rank", "n"]
    wide = odd_docs.select("*", *[F.lit("clash").alias(c) for c in clash])
    bench = spark.createDataFrame([(1, "the cat sat on the mat"), (2, None), (3, ""), (None, "sun shone"), (4, PROSE)], "item_id long, text string")
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "http://a/b", "<p>t", "x"), (2, "http://a/b", "", "x")],
                                  "page_id long, url string, html string, lines string")
    vectors = spark.createDataFrame([(1, None, "x"), (None, [1.0, 0.0], "x"), (2, [0.0, 2.0], "x"), (2, [0.0, 2.0], "x"), (3, [], "x"), (4, [3.0, None], "x")],
                                    "vec_id long, embedding array<float>, whitened string")
    return written(wide, tmp_path_factory.mktemp("odd"), benchmark=bench, pages=pages, embeddings=vectors)


@pytest.fixture(scope="session")
def empty_dir(spark, empty_docs, tmp_path_factory):
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    return written(empty_docs, tmp_path_factory.mktemp("empty"), benchmark=bench, pages=pages, embeddings=vectors)


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def small_rows(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
