"""Spark session defaults and shared-storage scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes
# (broadcast only when a side is measured small), coalesces small shuffle
# partitions and splits skewed ones.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Map tasks x reducers is the number of shuffle blocks.
MAX_SHUFFLE_PARTITIONS = 65536
# Compressed bytes of a task's shuffle read, see `shuffle_partitions_for`.
TASK_SHUFFLE_BYTES = 16 << 20


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20,
                 broadcast_limit_bytes: int = 64 << 20, max_partitions: int = MAX_SHUFFLE_PARTITIONS) -> dict[str, str]:
    """Settings sized from the input volume.

    * scans split into `target_partition_bytes` pieces;
    * the initial shuffle partition count aims at that size per reducer but
      is capped at `max_partitions` (map tasks x reducers is the number of
      shuffle blocks, so 100 TB gets 65536 partitions of ~1.6 GB input each;
      partial aggregation usually shrinks what is shuffled well below the
      input).  AQE then coalesces small partitions and splits skewed ones (a
      partition is skewed above 5x the median and 1 GiB);
    * broadcast joins only for sides measured below `broadcast_limit_bytes`
      at runtime, with a sort-merge fallback beyond it.
    """
    parts = min(max_partitions, max(200, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_limit_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_limit_bytes),
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "quayside",
                  extra: dict | None = None, checkpoint_dir: str | None = None,
                  input_bytes: int | None = None) -> SparkSession:
    """A session with the defaults above.  `checkpoint_dir` names the shared
    folder for intermediate files (required off local mode, see
    `checkpoint_root`); `input_bytes` adds the settings of `cluster_conf`."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", os.environ.get("QUAYSIDE_DRIVER_MEMORY", "8g")))
    sized = cluster_conf(input_bytes) if input_bytes else {}
    shared = {"spark.checkpoint.dir": checkpoint_dir} if checkpoint_dir else {}
    for k, v in {**SESSION_DEFAULTS, **sized, **shared, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Let the session's shuffles start with a partition for every
    `rows_per_task` of `rows`, where it has fewer; returns the number they start
    with.  AQE joins small partitions but splits none that a grouping or a join
    needs whole, so with a fixed number a task's share grows with the input.
    It joins them up to `TASK_SHUFFLE_BYTES` at most: narrow rows compress well
    and take many times that in a sort's memory.  The settings stay, for plans
    that run later; small inputs leave them alone."""
    initial, joined = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    have = int(spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    need = min(MAX_SHUFFLE_PARTITIONS, -(-rows // rows_per_task))
    if need > have:
        spark.conf.set(initial, str(need))
        size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(joined))
        spark.conf.set(joined, str(min(size, TASK_SHUFFLE_BYTES)))
    return max(have, need)


# HotSpot compiles no method of more bytes than this, it interprets them.
COMPILED_METHOD_BYTES = 8000


def compiled_methods(spark: SparkSession) -> None:
    """Let the session generate whole-stage code only where its methods are
    small enough to be compiled; elsewhere Spark runs its operators one by one,
    whose code is split into small methods.  The setting stays, as above."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(limit, str(min(int(spark.conf.get(limit)), COMPILED_METHOD_BYTES)))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    On a cluster it must be named: executors could not read each other's
    files in a folder of one machine, so an unset folder is an error there.
    Only a session in local mode (one machine) falls back to a temporary one.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if configured is None:
            if not is_local(sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="quayside-ckpt-")
        # DataFrame checkpoints use the context's folder.
        sc.setCheckpointDir(configured)
    return (configured or sc.getCheckpointDir()).rstrip("/")


def is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for one run's files."""
    return f"{checkpoint_root(spark)}/quayside/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once under the checkpoint folder and read back, for frames
    that several branches of a plan need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the file system that its path names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Remove scratch folders whose files nothing reads any more."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
