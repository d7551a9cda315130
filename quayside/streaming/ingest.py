"""Structured Streaming ingestion: payload folders picked up incrementally,
an idempotent streaming upsert into a partitioned snapshot, and a stored
high-water mark for incremental readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.functions.timeparse import ntz_lit
from quayside.operators.upsert import merge_snapshot, read_snapshot
from quayside.sources.payload import LINES_SCHEMA


def ingest_available(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                     schema=LINES_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """Process every file present in `source_dir` that this checkpoint has not
    seen yet (availableNow), appending to a parquet folder with the file
    sink's exactly-once log; returns the committed output."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = r.json(source_dir)
    q = (stream.writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_dir)


def upsert_available(spark: SparkSession, source_dir: str, table: str, keys: list[str], partition_by: list[str],
                     prepare, checkpoint: str, schema=LINES_SCHEMA, max_files_per_trigger: int | None = None,
                     sort_by: list[str] | None = None, after_stage=None, after_merge=None) -> None:
    """Stream new payload files into the snapshot folder `table` by key.

    Every micro-batch is merged into the partitions it touches
    (`merge_snapshot`); no version numbers are kept, so batch merges and other
    streams can write the same table before and after.  A retried micro-batch
    finds what its first run staged under the checkpoint's name, and one that
    the ledger beside the checkpoint lists as finished is passed over.  The merge
    picks one winner per key by (load time, sequence), so a key repeated inside
    one batch, or a file delivered twice, leaves the table as if it had been
    seen once.  `prepare(df)` turns raw lines into rows with the table's
    columns.
    """
    def merge(batch: DataFrame, epoch_id: int) -> None:
        base = checkpoint.rstrip("/")
        merge_snapshot(table, prepare(batch), keys, partition_by, f"{base}-staged/{epoch_id}", sort_by,
                       ledger=f"{base}-ledger/{epoch_id}", after_stage=None if after_stage is None else lambda: after_stage(epoch_id))
        if after_merge is not None:  # test hook: fail between write and offset commit
            after_merge(epoch_id)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.json(source_dir).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def incremental_read(df: DataFrame, watermark, col: str = "last_updated", inclusive: bool = False) -> DataFrame:
    """Rows changed after the stored high-water mark, or at it too
    (`inclusive`); the comparison is pushed to the scan."""
    return df.filter(F.col(col) >= ntz_lit(watermark) if inclusive else F.col(col) > ntz_lit(watermark))


class HighWaterMark:
    """Stored high-water mark for incremental reads: a small parquet table on
    shared storage with the greatest value seen and the content hashes of the
    rows that carry it.  `changes(df)` returns the rows newer than the mark and
    the rows at the mark that were not seen yet, so rows that arrive later with
    the same time are not missed (all rows the first time).  Commit only after
    the changes were processed: a failure re-reads them instead of skipping
    them."""

    SCHEMA = "mark timestamp_ntz, seen bigint"

    def __init__(self, spark: SparkSession, path: str, col: str = "last_updated"):
        self.spark, self.path, self.col = spark, path.rstrip("/"), col

    def _marks(self) -> DataFrame:
        return read_snapshot(self.spark, self.path, StructType.fromDDL(self.SCHEMA))

    def current(self):
        """The stored mark (one value), or None."""
        return self._marks().agg(F.max("mark")).first()[0]

    def _hash(self, df: DataFrame):
        return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in sorted(df.columns)])

    def changes(self, df: DataFrame) -> DataFrame:
        """The mark becomes a literal predicate, so it is pushed into the
        scan; only rows at the mark are compared with the seen hashes."""
        wm = self.current()
        if wm is None:
            return df
        seen = self._marks().filter(F.col("mark") == ntz_lit(wm)).select(F.col("seen").alias("_seen"))
        at = incremental_read(df, wm, self.col, inclusive=True).filter(F.col(self.col) == ntz_lit(wm))
        again = at.withColumn("_seen", self._hash(df)).join(seen, "_seen", "left_anti").drop("_seen")
        return incremental_read(df, wm, self.col).unionByName(again.select(*df.columns))

    def commit(self, changes: DataFrame) -> None:
        top = changes.agg(F.max(self.col).alias("mark"))
        rows = changes.select(F.col(self.col).alias("mark"), self._hash(changes).alias("seen"))
        rows.join(F.broadcast(top), "mark", "left_semi").write.mode("append").parquet(self.path)
