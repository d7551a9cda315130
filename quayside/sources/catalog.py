"""Named input tables.

`load_inputs(spark, dir)` exposes the parquet tables of one data directory as
lazily-read DataFrames (one scan per use; Catalyst prunes columns and pushes
filters into each scan).

A table's schema is read from its footer once per process and then passed
to `spark.read.schema(...)`, so building a plan that reads `orders` eight
times does not run eight schema-inference jobs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_SCHEMAS: dict[tuple, StructType] = {}


def _schema_key(path: str) -> tuple:
    try:
        st = os.stat(path)
        return (path, st.st_mtime_ns, st.st_size)
    except OSError:  # remote storage: the path alone
        return (path,)

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Inputs:
    """Attribute access to `<dir>/<name>.parquet` tables."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark = spark
        self.base_dir = base_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        path = f"{self.base_dir}/{name}.parquet"
        key = _schema_key(path)
        schema = _SCHEMAS.get(key)
        if schema is None:
            df = self.spark.read.parquet(path)
            _SCHEMAS[key] = df.schema
            return df
        return self.spark.read.schema(schema).parquet(path)

    def domain(self, name: str) -> DataFrame:
        """A domain input, derived from the driver tables."""
        from quayside.sources import standins

        return getattr(standins, name)(self)

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.table(name)
        raise AttributeError(name)


def load_inputs(spark: SparkSession, base_dir: str) -> Inputs:
    return Inputs(spark, base_dir)


def write_csv_export(df: DataFrame, path: str, null_value: str = "\\N") -> None:
    """CSV export with a header row; nulls are written apart from empty text."""
    (df.write.option("header", True).option("nullValue", null_value)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_csv_export(spark: SparkSession, path: str, schema: str | StructType, null_value: str = "\\N") -> DataFrame:
    """Daily CSV export (header row) read with an explicit schema, as RAW
    tables are loaded; no schema inference pass over the data."""
    reader = spark.read.schema(schema).option("header", True).option("nullValue", null_value)
    return reader.option("mode", "PERMISSIVE").csv(path)
