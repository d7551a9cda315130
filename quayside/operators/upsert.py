"""Keyed upsert without a table format: merge = union + per-key winner, and
snapshots kept as partitioned parquet folders that Spark itself overwrites
partition by partition.

Per key, the row with the greatest (load time, sequence) wins: batch rows
beat target rows, and within one batch the later copy of a repeated key
wins.  The winner is chosen with `max_by` in a grouped aggregate, which is
combined per map partition before the shuffle, so a key repeated across a
large share of all rows never collects in one task.  A snapshot's merge is laid out
as it is stored before it groups, in the same shuffle; there the rows of keys
that repeat very often are combined first.  Replaying a batch
gives the same winners, so the merge is idempotent.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegralType, StringType, StructType, TimestampNTZType, TimestampType

from quayside.session import drop_scratch, path_exists


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], load_ts: str = "last_updated",
           seq: str = "seq") -> DataFrame:
    """Merge `batch` into `target` by `keys`; both carry `load_ts` and `seq`.

    The merge sets fields: columns the batch does not have keep the target's
    values (null for new keys).  Batch rows with a null in a key cannot be
    stored and are left out (`upsert_metrics` counts them as failed).  This is
    the whole-table merge; `merge_snapshot` feeds it only the partitions a
    batch touches."""
    return _merged(target, batch, keys, load_ts, seq).select(*target.columns)


def _merged(target: DataFrame, batch: DataFrame, keys: list[str], load_ts: str, seq: str, marks: dict[str, Column] | None = None,
            layout: list[str] | None = None) -> DataFrame:
    """The merged rows, with further aggregates per key (`marks`).  With
    `layout`, functions of the key, they lie in ranges of it and of the key:
    the grouping needs no further shuffle, and neither does a write by it."""
    by = [*[c for c in layout or [] if c not in keys], *keys]
    stored = batch.where(_has_key(keys))
    sent = [c for c in target.columns if c in batch.columns and c not in by]
    kept = [c for c in target.columns if c not in batch.columns]
    order = F.struct(F.col(load_ts), F.col(seq))
    both = target.withColumn("_old", F.lit(True)).unionByName(
        stored.select(*by, *sent).withColumn("_old", F.lit(False)), allowMissingColumns=True)
    if layout:
        both = both.repartitionByRange(*by)
    picks = [F.max_by(F.struct(*sent), order).alias("_w")]
    if kept:
        picks.append(F.max_by(F.struct(*kept), F.when(F.col("_old"), order)).alias("_k"))
    marks = marks or {}
    g = both.groupBy(*by).agg(*picks, *[m.alias(name) for name, m in marks.items()])
    return g.select(*[F.col(c) if c in by else F.col("_w" if c in sent else "_k").getField(c).alias(c)
                      for c in target.columns], *marks)


def _observed_merge(target: DataFrame, batch: DataFrame, keys: list[str], load_ts: str, seq: str, seen: Observation,
                    layout: list[str]) -> DataFrame:
    """`upsert` laid out by `layout`, whose counts the writing job leaves in `seen`."""
    content = [c for c in target.columns if c in batch.columns and c not in (*layout, *keys, load_ts, seq)]
    digest = _digest(target.select(*content))
    order = F.struct(F.col(load_ts), F.col(seq))
    df = _merged(target, batch, keys, load_ts, seq, {
        "_sent": F.max(~F.col("_old")), "_before": F.max_by(F.when(F.col("_old"), digest), F.when(F.col("_old"), order))}, layout)
    sent, new = F.col("_sent"), F.col("_before").isNull()
    return df.observe(seen, F.count_if(sent & new).alias("inserted"), F.count_if(sent & ~new).alias("matched"),
                      F.count_if(sent & ~new & (F.col("_before") != digest)).alias("modified")).drop("_sent", "_before")


def _digest(df: DataFrame) -> Column:
    """Hash of the columns of `df`, each as it is where equal values hash alike
    (as text they would have to be formatted), and of which are null."""
    plain = (StringType, IntegralType, BooleanType, DateType, TimestampType, TimestampNTZType)
    values = [F.col(f.name) if isinstance(f.dataType, plain) else F.col(f.name).cast("string") for f in df.schema.fields]
    return F.xxhash64(*values, *[v.isNull() for v in values])


# A key with about this many rows in a batch is combined before the merge's
# shuffle; they are looked for in a sample, which the result does not depend on.
HOT_KEY_ROWS = 1_000_000
HOT_KEY_SAMPLE = 0.01


def key_sample(df: DataFrame) -> DataFrame:
    """The rows among which hot keys are looked for."""
    return df.sample(HOT_KEY_SAMPLE, seed=7)


def hot_keys_combined(batch: DataFrame, sample: DataFrame, keys: list[str], load_ts: str = "last_updated", seq: str = "seq") -> DataFrame:
    """`batch` with one row, the winner, for each key that a large share of its
    `sample` repeats (combined per map partition); all rows of the other keys."""
    key = F.xxhash64(*keys)
    seen = sample.where(_has_key(keys)).groupBy(key.alias("_h")).count()
    hot = [r[0] for r in seen.where(F.col("count") > HOT_KEY_ROWS * HOT_KEY_SAMPLE).collect()]
    if not hot:
        return batch
    top = latest_per_key(batch.where(_has_key(keys) & key.isin(hot)), keys, load_ts, seq)
    return batch.where(~_has_key(keys) | ~key.isin(hot)).unionByName(top)


def _has_key(keys: list[str]) -> Column:
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return ok


def latest_per_key(df: DataFrame, keys: list[str], load_ts: str = "last_updated", seq: str = "seq") -> DataFrame:
    """One row per key: the greatest (load time, sequence) -- an initial
    snapshot from rows that may repeat keys."""
    cols = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(load_ts), F.col(seq))).alias("_w"))
    return g.select(*keys, *[F.col("_w").getField(c).alias(c) for c in cols])


def upsert_metrics(target: DataFrame, batch: DataFrame, keys: list[str], group: list[str] | None = None,
                   seq: str = "seq") -> DataFrame:
    """Counts of one bulk upsert: `inserted` keys that are new; `updated`
    operations that modify a stored document (an identical resend modifies
    nothing: of equal contents sent for one key only one counts, and none if
    the target holds it already); `failed` operations without a full key;
    `total_processed` all operations.  `group` columns are keys.

    One pass without a join: target and batch rows of one content meet in a
    grouped aggregate per (key, content), and these per key."""
    group = group or []
    have = [c for c in batch.columns if c != seq]
    content = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in have])
    absent = {c: F.lit(None).cast("string") for c in have if c not in target.columns}
    old = target.where(_has_key(keys)).withColumns(absent).select(*keys, content.alias("_h"), F.lit(0).alias("_op"))
    sent = batch.select(*keys, content.alias("_h"), F.lit(1).alias("_op"))
    per = old.unionByName(sent).groupBy(*keys, "_h").agg(F.sum("_op").alias("_ops"), (F.min("_op") == 0).alias("_old"))
    per = per.groupBy(*keys).agg(F.sum("_ops").alias("_ops"), F.max("_old").alias("_known"),
                                 F.count_if((F.col("_ops") > 0) & ~F.col("_old")).alias("_changes")).where(F.col("_ops") > 0)
    stored, new = _has_key(keys), ~F.col("_known")
    return per.groupBy(*group).agg(
        F.count_if(stored & new).alias("inserted"),
        F.coalesce(F.sum(F.when(stored, F.col("_changes") - new.cast("bigint"))), F.lit(0)).cast("bigint").alias("updated"),
        F.coalesce(F.sum("_ops"), F.lit(0)).cast("bigint").alias("total_processed"),
        F.coalesce(F.sum(F.when(~stored, F.col("_ops"))), F.lit(0)).cast("bigint").alias("failed"))


# ---------------------------------------------------------- snapshots
def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows stored under `path`; none if nothing was stored yet.  Any
    other read error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_partitions(df: DataFrame, path: str, partition_by: list[str], sort_by: list[str] | None = None) -> None:
    """Store `df` as the full content of each partition it contains, leaving
    other partitions alone (Spark's dynamic partition overwrite).

    REBALANCE: AQE coalesces small partitions and splits skewed ones, so a hot
    partition is written by several tasks.  Sorting within files keeps
    min/max statistics tight on the point-lookup column."""
    out = df.hint("rebalance", *partition_by)
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def swap_partitions(df: DataFrame, path: str, partition_by: list[str], sort_by: list[str] | None = None) -> None:
    """`write_partitions` of rows read from files that lie by partition already:
    written as they are read, without a shuffle."""
    out = df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", SNAPSHOT_CODEC)
     .partitionBy(*partition_by).parquet(path))


# Snapshots are written twice, under `staging` and swapped in, and read rarely.
SNAPSHOT_CODEC = "zstd"
# Touched partitions named one by one in the filter of a merge's read.  A
# snapshot's partitions are listed on the driver in any case; beyond this the
# read is reduced by a semi join instead.
NAMED_PARTITIONS = 20_000
METRICS = ["inserted", "matched", "modified", "total_processed", "failed"]


def staged_once(batch: DataFrame, path: str) -> DataFrame:
    """`batch` as written under `path`: by this call, or by an earlier one that
    finished writing.  Whatever reads it sees the same rows, even if the batch
    gives others each time it is evaluated."""
    spark = batch.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        batch.write.mode("overwrite").parquet(path)
    return spark.read.schema(batch.schema).parquet(path)


def touched_partitions(snapshot: DataFrame, batch: DataFrame, partition_by: list[str]) -> DataFrame:
    """The rows of the snapshot's partitions that hold a partition value of
    the batch.  The values become literals, so the scan lists and reads no
    other partition."""
    touched = batch.select(*partition_by).distinct()
    return _of_partitions(snapshot, touched, touched.limit(NAMED_PARTITIONS + 1).collect(), partition_by)


def _of_partitions(snapshot: DataFrame, touched: DataFrame, rows: list, partition_by: list[str]) -> DataFrame:
    """`touched_partitions`, given the first of their `rows`."""
    if len(rows) > NAMED_PARTITIONS:
        return snapshot.join(touched, partition_by, "left_semi")
    by: dict[tuple, list] = {}
    for *first, last in (tuple(r)[:len(partition_by)] for r in rows):
        by.setdefault(tuple(first), []).append(last)
    named = F.lit(False)
    for first, lasts in by.items():
        one = F.col(partition_by[-1]).isin(lasts)
        for c, v in zip(partition_by, first):
            one = (F.col(c) == F.lit(v)) & one
        named = named | one
    return snapshot.where(named)


def merge_snapshot(path: str, batch: DataFrame, keys: list[str], partition_by: list[str], staging: str,
                   sort_by: list[str] | None = None, load_ts: str = "last_updated", seq: str = "seq",
                   schema: StructType | None = None, ledger: str | None = None, after_stage=None,
                   in_place: DataFrame | None = None) -> dict[str, int] | None:
    """Upsert `batch` into the snapshot at `path`, reading and rewriting only
    the partitions the batch touches.

    `partition_by` columns must be functions of the key, so that a key never
    changes partition, and without null or blank values.

    1. The batch is written under `staging` once; every later step reads those
       files, also when the merge is run again with the same `staging`.  With
       `in_place`, its `key_sample`, it is read where it lies: a row-local view
       of stored files, which a merge run again is given again, or more of it.
    2. The partitions it touches become literal predicates of the read.
    3. The merged content is written under `staging`, by ranges of partition and
       key in one shuffle, and then swapped in as it lies.  If
       a run dies in between, running it again merges the snapshot, what was
       staged and the batch, so nothing is lost whichever partitions the first
       run had swapped, and merges made meanwhile stay.
    4. `ledger`, a path, marks the batch as finished.  A merge whose mark
       exists does nothing and returns None.

    `staging` is removed at the end.  `schema` is the snapshot's schema
    (default: the batch's).  Returns what the write itself observed: `inserted`
    and `matched` keys, matched keys whose content was `modified`, operations
    in all (`total_processed`) and those `failed` for want of a full key."""
    spark = batch.sparkSession
    if ledger is not None and path_exists(spark, f"{ledger}/_SUCCESS"):
        return None
    rows = batch if in_place is not None else staged_once(batch, f"{staging}/batch")
    sample = in_place if in_place is not None else key_sample(rows)
    schema = schema or rows.schema
    # One pass over the batch finds its partitions and counts its rows.
    counted = [F.count(F.lit(1)).alias("_n"), F.count_if(~_has_key(keys)).alias("_failed")]
    touched = rows.groupBy(*partition_by).agg(*counted)
    first = touched.limit(NAMED_PARTITIONS + 1).collect()
    total, failed = sum(r["_n"] for r in first), sum(r["_failed"] for r in first)
    if len(first) > NAMED_PARTITIONS:
        total, failed = rows.agg(*counted).first()
    current = _of_partitions(read_snapshot(spark, path, schema), touched.select(*partition_by), first, partition_by)
    earlier = read_snapshot(spark, f"{staging}/merged/*", schema)
    known = current.select(*schema.names).unionByName(earlier.select(*schema.names))
    seen = Observation()
    merged = _observed_merge(known, hot_keys_combined(rows, sample, keys, load_ts, seq), keys, load_ts, seq, seen, partition_by)
    attempt = f"{staging}/merged/{uuid.uuid4().hex[:12]}"
    merged.write.option("compression", SNAPSHOT_CODEC).partitionBy(*partition_by).parquet(attempt)
    if after_stage is not None:  # test hook: fail between the two writes
        after_stage()
    swap_partitions(spark.read.schema(schema).parquet(attempt), path, partition_by, sort_by)
    if ledger is not None:
        spark.range(1).write.mode("overwrite").parquet(ledger)
    counts = {**{m: int(seen.get[m] or 0) for m in METRICS[:-2]}, "total_processed": total, "failed": failed}
    drop_scratch(spark, staging)
    return counts
