"""The corpus pipeline: documents in, training tokens' digests out.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which `run` writes as Parquet into the shared folder and
reads again as the next stage's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import bpe, decontaminate, language, neardup, pii
from quayside.llm.common import stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay; `und` goes."""
    return language.identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles,
    similarity 0.8 or more) stays: the smallest doc_id."""
    return neardup.deduplicated(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontaminate.decontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays."""
    return pii.redacted(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token count and digests of the ids and of the decoded text."""
    return bpe.digests(docs, bpe.vocabulary("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("tokens", tokenise),
]

# Mixture inference and tokenisation have no SQL form; tests/llm compares the
# pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
