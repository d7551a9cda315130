"""The domain inputs of the plans, by name.

A plan asks for its inputs by name (`SRC.intransit(t)`), and `t` decides where
they come from: `catalog.Inputs` derives them from the driver tables
(`standins`), `NamedInputs` takes any mapping of DataFrames, and `load_named`
and `load_jdbc` fill such a mapping from files or a database.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside import config as C

# Report workbook sheets (the base template's rows are `intransit`).
SHEETS = ("intransit", "shipment_master", "locations", "milestone_export", "carrier_notes", "cca_sheet",
          "io_sheet", "yesterday", "trailers", "csp_sheet")
# TMS tables and views.
TMS = ("em_shipment", "shipment_refs", "shipment_milestones", "unitload_refs", "container_assn",
       "container_attributes", "status_docs", "status_doc_refs", "orders_assn", "order_packages", "location_entities")
# Carrier events, watch list and staged exports.
EVENTS = ("tracking_events", "hlcu_events", "maeu_events", "tracking_cards", "watchlist", "staged_shipments_raw", "mixed_ids")
NAMES = SHEETS + TMS + EVENTS


class NamedInputs:
    """Inputs given as a mapping of named DataFrames.  A carrier's events may
    be left out where `tracking_events` holds both carriers."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame]):
        unknown = sorted(set(frames) - set(NAMES))
        if unknown:
            raise ValueError(f"unknown inputs: {', '.join(unknown)}")
        self.spark, self.frames = spark, dict(frames)

    def domain(self, name: str) -> DataFrame:
        if name in self.frames:
            return self.frames[name]
        carrier = {"hlcu_events": (C.HLCU, "place_of_activity"), "maeu_events": (C.MAEU, "location")}.get(name)
        if carrier and "tracking_events" in self.frames:
            return self.frames["tracking_events"].filter(F.col("carrier") == carrier[0]).withColumnRenamed("place", carrier[1])
        raise KeyError(f"input {name!r} was not given")


def load_named(spark: SparkSession, folder: str, names: Iterable[str], fmt: str = "parquet",
               schemas: dict[str, StructType | str] | None = None) -> NamedInputs:
    """Inputs from `<folder>/<name>.<fmt>`, CSV with a header row.  CSV needs
    a schema per input (nothing is inferred from the data)."""
    frames = {}
    for name in names:
        reader = spark.read
        if schemas and name in schemas:
            reader = reader.schema(schemas[name])
        elif fmt == "csv":
            raise ValueError(f"no schema for {name}.csv")
        if fmt == "csv":
            reader = reader.option("header", True)
        frames[name] = reader.format(fmt).load(f"{folder.rstrip('/')}/{name}.{fmt}")
    return NamedInputs(spark, frames)


def load_jdbc(spark: SparkSession, url: str, tables: dict[str, str], split: dict[str, tuple[str, int, int]],
              partitions: int, properties: dict[str, str] | None = None) -> NamedInputs:
    """Inputs from a database: `tables` maps input names to tables or views;
    `split` gives a table's numeric column and its bounds, so that it is read in
    `partitions` range queries (a table without one is read by one task)."""
    frames = {}
    for name, source in tables.items():
        options = {**(properties or {}), "url": url, "dbtable": source}
        if name in split:
            column, low, high = split[name]
            options |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(partitions)}
        frames[name] = spark.read.format("jdbc").options(**options).load()
    return NamedInputs(spark, frames)


def _named(name: str) -> Callable[..., DataFrame]:
    def get(t) -> DataFrame:
        return t.domain(name)

    get.__name__ = name
    get.__doc__ = f"The input {name!r} of `t`."
    return get


globals().update({name: _named(name) for name in NAMES})
