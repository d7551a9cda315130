"""Data tests: each returns its violations (or outcome counts) as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside import config as C


def duplicate_events(df: DataFrame, keys=("carrier", "container_number", "status", "event_timestamp")) -> DataFrame:
    """Keys shared by more than one event (0 rows = pass)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_events"))
            .filter(F.col("n_events") > 1))


def tracking_type_check(df: DataFrame, col: str = "type_of_tracking", group=("carrier",)) -> DataFrame:
    """Counts per tracking type with an accepted flag (null is not accepted)."""
    accepted = F.coalesce(F.col(col).isin(list(C.TRACKING_TYPES)), F.lit(False))
    g = df.groupBy(*group, col).agg(F.count(F.lit(1)).alias("n_events"))
    return g.select(*group, col, accepted.alias("accepted"), "n_events")


def required_columns(sources: dict[str, DataFrame], required=C.REQUIRED_EVENT_COLUMNS) -> DataFrame:
    """Contract check per (source, required column): whether the column
    exists, the source's row count, and how many rows lack a value (null or
    blank; every row when the column is absent).  One aggregate pass per
    source; the per-column counts are unpivoted into rows."""
    from quayside.functions.text import is_blank

    out = None
    for name, df in sources.items():
        aggs = [F.count(F.lit(1)).alias("n_rows")]
        for c in required:
            missing = F.count_if(is_blank(c)) if c in df.columns else F.count(F.lit(1))
            aggs.append(missing.cast("bigint").alias(c))
        counts = df.agg(*aggs).unpivot(["n_rows"], list(required), "column_name", "n_missing")
        counts = counts.select(
            F.lit(name).alias("source"), "column_name",
            F.col("column_name").isin([c for c in required if c in df.columns]).alias("present"),
            "n_rows", "n_missing")
        out = counts if out is None else out.unionByName(counts)
    return out
