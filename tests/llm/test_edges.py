"""Every query on odd rows, on columns with clashing names and on empty tables."""
import pytest

from llm_data import SMALL

from quayside.llm import bpe, decontaminate, language
from quayside.llm.registry import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows(spark, odd_dir, name):
    got = QUERIES[name](spark, odd_dir).collect()
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet").count()
    if name.startswith("op7"):
        assert len(got) == 3
    elif name.startswith("op12"):
        assert len(got) == 3  # three usable vectors, one component with variance
    elif not name.startswith(("op9", "op13", "pipeline")):
        assert len(got) == docs


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, duck, name):
    from quayside.plans.verify import compare

    ok, said = compare(QUERIES[name](spark, SMALL), duck, SQL[name])
    assert ok, said


def test_taken_names_are_errors(odd_docs, empty_docs):
    path = bpe.vocabulary("word_bpe_49k.json")
    model = language.train(empty_docs)
    for column, call in {
        "IDS": lambda df: bpe.encoded(df, path),
        "decoded": lambda df: bpe.decoded(df, path),
        "hits": lambda df: decontaminate.benchmark_hits(df, df),
        "Language": lambda df: language.with_language(df, model),
    }.items():
        with pytest.raises(ValueError, match="already has a column"):
            call(odd_docs.withColumnRenamed("source", column))
