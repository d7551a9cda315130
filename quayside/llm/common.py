"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import scratch_path

# Rows and bytes per Arrow batch handed to Python.  A batch holds whole texts:
# the bytes bound a worker's memory (a longer text is a batch of its own).
ARROW_ROWS, ARROW_BYTES = 512, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of `ARROW_ROWS` rows and about `ARROW_BYTES` at most for
    the session's Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`stored`, and the path, for tables that are dropped (`drop_scratch`)
    once the table made from them is written."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` under the shared checkpoint folder and read it back: cuts
    the lineage with files that survive the loss of an executor."""
    return written(df, name)[0]


def utf8(col: Column | str) -> Column:
    """Text as UTF-8 bytes; null as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit("")).cast("binary")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that `df` does not have."""
    have, name = {c.lower() for c in df.columns}, stem
    while name.lower() in have:
        name = "_" + name
    return name


def unused(df: DataFrame, name: str) -> str:
    """`name`, an error if `df` has a column of that name already."""
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the input already has a column {name}")
    return name


def merged(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A sort-merge join, whatever the sizes at hand: for sides that both grow
    with the corpus, so the plan is the same at every size.  Adaptive execution
    splits the partitions of hot keys."""
    return left.join(right.hint("merge"), on, how)
