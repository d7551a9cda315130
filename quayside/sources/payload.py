"""Event payload files: the carrier envelope `{carrier, scraped_at,
total_events, records: [...]}`, event JSON lines, and file selection.

A payload record carries no position of its own; `ordinal` (the position in
the run) comes from its place in the file.
"""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quayside import config as C
from quayside.session import drop_scratch, path_exists, scratch_path

RECORD_FIELDS = C.RECORD_FIELDS
CARRIER_FILES = C.CARRIER_FILES
RECORD_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in RECORD_FIELDS])

# `part` numbers the envelopes of a run that was written in several; it is
# absent where a run is one envelope.  `total_events` counts the whole run.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("carrier", T.StringType()),
    T.StructField("scraped_at", T.StringType()),
    T.StructField("total_events", T.LongType()),
    T.StructField("part", T.LongType()),
    T.StructField("records", T.ArrayType(RECORD_SCHEMA)),
    T.StructField("_corrupt_record", T.StringType()),
])
RUN = ["carrier", "scraped_at"]


def records_struct(df: DataFrame) -> DataFrame:
    """Event rows (snake_case) -> one `record` struct in payload field names,
    beside the row's ordinal."""
    fields = [(F.col(f.lower()) if f.lower() in df.columns else F.lit(None)).cast("string").alias(f) for f in RECORD_FIELDS]
    return df.select(*RUN, "ordinal", F.struct(*fields).alias("record"))


def build_envelopes(events: DataFrame, max_records: int) -> DataFrame:
    """Event rows -> envelopes of at most `max_records` records.

    A run (carrier, scraped_at) is cut into parts by floor(ordinal /
    max_records): ordinals are unique integers, so no envelope -- one
    `collect_list` -- can exceed the bound, whatever the volume or skew.  The
    parts of a run follow each other in order, and `total_events` is the
    run's, so what the envelopes say does not depend on the bound.
    """
    r = records_struct(events).withColumn("part", F.floor(F.col("ordinal") / F.lit(max_records)).cast("bigint"))
    g = r.groupBy(*RUN, "part").agg(F.array_sort(F.collect_list(F.struct("ordinal", "record"))).alias("rows"))
    g = g.select(*RUN, "part", F.transform("rows", lambda x: x["record"]).alias("records"))
    return g.join(r.groupBy(*RUN).agg(F.count(F.lit(1)).alias("total_events")), RUN).select(
        *RUN, "total_events", "part", "records")


def write_envelopes(envelopes: DataFrame, path: str) -> None:
    """One JSON envelope per line (JSON lines)."""
    out = envelopes.select(F.to_json(F.struct(*RUN, "total_events", "part", "records")).alias("value"))
    out.write.mode("overwrite").text(path)


def write_named_files(files: DataFrame, directory: str) -> None:
    """Rows (name, place, value) -> one text file per `name` in `directory`,
    its lines by `place`.

    All files are first written and committed by Spark in a folder that
    readers do not list, and then moved to their names, each in one step, so no
    reader sees a part of a file.  A run that died while moving is finished by
    the next one.  A file of the same name is replaced.  A time stamp in the
    name (a run's) becomes the file's modification time, so the order of the
    runs is that of their times whatever the order of writing.  One writer a
    folder; a file is written by one task, line by line."""
    spark, staging = files.sparkSession, f"{directory.rstrip('/')}/_writing"
    if path_exists(spark, f"{staging}/_SUCCESS"):
        _publish(spark, staging, directory)
    lines = files.where(F.col("name").isNotNull()).repartition("name").sortWithinPartitions("name", "place")
    lines.select("name", "value").write.mode("overwrite").partitionBy("name").text(staging)
    _publish(spark, staging, directory)


def _publish(spark: SparkSession, staging: str, directory: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for file in fs.globStatus(path(f"{staging}/name=*/part-*")):
        name = unquote(file.getPath().getParent().getName().removeprefix("name="))
        to = path(directory, name)
        if fs.exists(to):
            fs.delete(to, False)
        if not fs.rename(file.getPath(), to):
            raise OSError(f"could not move {file.getPath()} to {to}")
        if stamp := re.search(r"\d{8}_\d{6}", name):
            when = dt.datetime.strptime(stamp[0], "%Y%m%d_%H%M%S").replace(tzinfo=dt.timezone.utc)
            fs.setTimes(to, int(when.timestamp() * 1000), -1)
    drop_scratch(spark, staging)


def run_file_name(config=CARRIER_FILES) -> Column:
    """The file name of a run (carrier, scraped_at) after its carrier's
    pattern; null for other carriers."""
    stem = F.coalesce(*[F.when(F.col("carrier") == c["carrier"], F.lit(c["pattern"])) for c in config])
    return F.replace(stem, F.lit("*"), F.col("scraped_at"))


def write_run_files(envelopes: DataFrame, directory: str, config=CARRIER_FILES) -> None:
    """One file per run, named so that `latest_file_per_carrier` finds it, with
    an envelope a line in the order of the parts."""
    value = F.to_json(F.struct(*RUN, "total_events", "part", "records"))
    write_named_files(envelopes.select(run_file_name(config).alias("name"), F.col("part").alias("place"), value.alias("value")), directory)


def read_envelopes(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read envelopes with an explicit schema, with the file each came from
    and its place there: where the piece of the file starts that a task reads
    (`block`), and a number that grows from line to line of it (`line`).
    Malformed text lands in `_corrupt_record` instead of failing the job.
    `multi_line` reads pretty-printed one-envelope-per-file payloads."""
    env = (spark.read.schema(ENVELOPE_SCHEMA).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record")
           .option("multiLine", multi_line).json(path))
    return env.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("line"), F.size(F.coalesce("records", F.array())).alias("n_records"))


def rejected_envelopes(env: DataFrame) -> DataFrame:
    """The malformed envelopes: their text, file and what could be read."""
    return env.filter(F.col("_corrupt_record").isNotNull()).select(
        F.col("_corrupt_record").alias("text"), "file", "carrier", "scraped_at")


def explode_envelopes(env: DataFrame) -> DataFrame:
    """Well-formed envelopes -> one row per record (missing records -> none),
    with its position in the run as `ordinal`: the records of the earlier
    envelopes of the run (by part, then file, then place in the file) plus its
    place in the envelope.  Equal envelopes are told apart by their place.
    Malformed envelopes are in `rejected_envelopes`.

    Only counts are ordered per run; the records stay where they are until
    their envelope's offset meets them."""
    e = env.filter(F.col("_corrupt_record").isNull()).withColumn("_e", F.struct(
        F.coalesce("part", F.lit(0)).alias("part"), "file", "block", "line"))
    order = Window.partitionBy(*RUN).orderBy("_e").rowsBetween(Window.unboundedPreceding, -1)
    first = e.select(F.col("_e").alias("_f"), F.coalesce(F.sum("n_records").over(order), F.lit(0)).alias("_first"))
    j = e.join(first, F.col("_e") == F.col("_f")).select(
        F.col("carrier").alias("payload_carrier"), "scraped_at", "_first", F.posexplode(F.coalesce("records", F.array())).alias("_pos", "r"))
    return j.select("payload_carrier", "scraped_at", (F.col("_first") + F.col("_pos")).cast("bigint").alias("ordinal"), "r.*")


def load_payloads(spark: SparkSession, path: str, rejects: str, multi_line: bool = False) -> DataFrame:
    """Records of the payloads under `path`; malformed envelopes are appended
    as text to the folder `rejects`, so none is lost without a sign.  The
    payloads are parsed once, into the scratch folder that the result reads, so
    that an envelope's place is one value for all that follows."""
    env = read_envelopes(spark, path, multi_line)
    parsed = scratch_path(spark, "envelopes")
    env.write.parquet(parsed)
    env = spark.read.schema(env.schema).parquet(parsed)
    rejected_envelopes(env).write.mode("append").parquet(rejects)
    return explode_envelopes(env)


def load_latest(spark: SparkSession, directory: str, rejects: str, config=CARRIER_FILES, multi_line: bool = True) -> DataFrame:
    """The records of each carrier's latest payload file, one load driven by
    the carrier configuration; carriers without a file are skipped.  Only the
    chosen names (one per carrier) pass the driver.  `multi_line` is for
    pretty-printed files; `write_run_files` writes an envelope a line."""
    out = None
    for row in latest_file_per_carrier(list_files(spark, directory), config=config).collect():
        df = load_payloads(spark, f"{directory.rstrip('/')}/{row.file_name}", rejects, multi_line)
        df = df.withColumn("carrier", F.lit(row.carrier))
        out = df if out is None else out.unionByName(df)
    return out


def write_event_lines(events: DataFrame, path: str) -> None:
    """Scalable payload form: one JSON event per line with its ordinal,
    partitioned by carrier and scrape, so no envelope array is ever built."""
    (records_struct(events).select(*RUN, "record.*", "ordinal")
     .hint("rebalance", *RUN)
     .write.mode("overwrite").partitionBy(*RUN).json(path))


LINES_SCHEMA = T.StructType(list(RECORD_SCHEMA.fields) + [
    T.StructField("ordinal", T.LongType()), T.StructField("carrier", T.StringType()), T.StructField("scraped_at", T.StringType())])


def payload_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Per (carrier, scrape) event counts of a JSON-lines payload folder
    (partition folders carrier=/scraped_at= read as strings)."""
    lines = spark.read.schema(LINES_SCHEMA).json(path)
    return lines.groupBy(*RUN).agg(F.count(F.lit(1)).alias("total_events"))


def glob_regex(pattern: str) -> str:
    return "^" + re.escape(pattern).replace(r"\*", ".*").replace(r"\?", ".") + "$"


def list_files(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """(file_name, modified_at) of the files in `directory`, from the
    `binaryFile` source; the content column is never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                        F.col("modificationTime").alias("modified_at"))


def latest_file_per_carrier(listing: DataFrame, name_col: str = "file_name",
                            mtime_col: str = "modified_at", config=CARRIER_FILES) -> DataFrame:
    """Most recently modified file per carrier pattern; carriers without a
    matching file are absent.  `listing` can come from any file listing,
    e.g. `spark.read.format("binaryFile").load(dir).select("path",
    "modificationTime")` (the content column is pruned)."""
    carrier = None
    for c in config:
        hit = F.col(name_col).rlike(glob_regex(c["pattern"]))
        carrier = F.when(hit, F.lit(c["carrier"])) if carrier is None else carrier.when(hit, F.lit(c["carrier"]))
    m = listing.withColumn("carrier", carrier).filter(F.col("carrier").isNotNull())
    g = m.groupBy("carrier").agg(
        F.max_by(F.struct(F.col(name_col), F.col(mtime_col)), F.struct(F.col(mtime_col), F.col(name_col)))
        .alias("_f"))
    return g.select("carrier", F.col("_f").getField(name_col).alias(name_col),
                    F.col("_f").getField(mtime_col).alias(mtime_col))


def payload_checks(env: DataFrame) -> DataFrame:
    """Structure checks per run -> counts per check outcome: corrupt_json
    (per envelope), missing_field, count_mismatch (all parts of the run
    against its total_events), ok; plus the number of records carried."""
    bare = F.col("carrier").isNull() | F.col("scraped_at").isNull() | F.col("records").isNull() | F.col("total_events").isNull()
    runs = env.withColumn("_bad", F.col("_corrupt_record").isNotNull()).groupBy(*RUN, "_bad").agg(
        F.max(bare).alias("bare"), F.max("total_events").alias("total"), F.count(F.lit(1)).alias("_files"),
        F.sum(F.size(F.coalesce("records", F.array()))).alias("_n"))
    status = (F.when(F.col("_bad"), F.lit("corrupt_json")).when(F.col("bare"), F.lit("missing_field"))
              .when(F.col("_n") != F.col("total"), F.lit("count_mismatch")).otherwise(F.lit("ok")))
    c = runs.select(status.alias("check_name"), F.when(F.col("_bad"), F.col("_files")).otherwise(1).alias("_p"),
                    F.when(F.col("_bad"), 0).otherwise(F.col("_n")).alias("_n"))
    return c.groupBy("check_name").agg(F.sum("_p").cast("bigint").alias("n_payloads"), F.sum("_n").cast("bigint").alias("n_records"))
