"""Carrier tracking-event operators: classification, duplicate flags, keys,
summaries and timelines.

Per-container and per-key "pick one row" rules are written as a partial
(map-side combined) aggregate that returns the winning row's unique ordinal,
followed by a join back on that ordinal.  A container or key holding a large
share of all rows therefore never lands in a single task: the aggregate is
combined per partition before the shuffle, and the join key is unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside import config as C
from quayside.functions import text as T
from quayside.functions import timeparse as TP

# Winner keys are packed into one decimal(38,0): shifted epoch microseconds
# in the high digits, (2^63 - 1 - ordinal) in the low 19.  A single
# fixed-width value lets `max` run as a hash aggregate (struct keys force a
# sort-based aggregate) while keeping the exact "latest, then lowest
# ordinal" order.
_D = "decimal(38,0)"
_LOW = 10 ** 19
_TS_SHIFT = 10 ** 17  # makes every timestamp's epoch micros positive
_ORD_MAX = 2 ** 63 - 1


def _dec(v) -> Column:
    return F.lit(str(v)).cast(_D)


def latest_first_key(ts: str, ordinal: str) -> Column:
    """Orderable key: greater = later timestamp (null lowest), then lower
    ordinal.  Ordinals must be non-negative 64-bit integers."""
    t_ = F.col(ts).cast("timestamp_ntz")
    # Epoch microseconds of the local (NTZ) value from calendar parts, so the
    # key is monotonic in any session time zone.
    micros = (F.unix_date(F.to_date(t_)).cast(_D) * _dec(86_400_000_000)
              + F.hour(t_).cast(_D) * _dec(3_600_000_000) + F.minute(t_).cast(_D) * _dec(60_000_000)
              + (F.date_part(F.lit("SECOND"), t_) * 1_000_000).cast(_D) + _dec(_TS_SHIFT))
    t = F.coalesce(micros, _dec(0))
    return t * _dec(_LOW) + (_dec(_ORD_MAX) - F.col(ordinal).cast(_D))


def ordinal_of_key(key: Column) -> Column:
    return (_dec(_ORD_MAX) - F.pmod(key, _dec(_LOW))).cast("bigint")


def key_has_ts(key: Column) -> Column:
    return key >= _dec(_LOW)


def _as_of(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return TP.ntz_lit(as_of or C.AS_OF)


def mark_ordinals(df: DataFrame, winners: DataFrame, flag: str, ordinal: str = "ordinal") -> DataFrame:
    """Add boolean `flag`: True for rows whose ordinal is in `winners`."""
    w = winners.select(F.col(ordinal).alias("_win_ord"), F.lit(True).alias(flag))
    out = df.join(w, df[ordinal] == w["_win_ord"], "left").drop("_win_ord")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


# ------------------------------------------------------------ parse / ts
def with_hlcu_ts(df: DataFrame, out: str = "event_ts") -> DataFrame:
    return df.withColumn(out, TP.hlcu_event_ts("date", "time"))


def with_maeu_ts(df: DataFrame, out: str = "event_ts", date_only: bool = False) -> DataFrame:
    ts = TP.maeu_event_date("date") if date_only else TP.maeu_event_ts("date", "time")
    return df.withColumn(out, ts)


# ---------------------------------------------------------- classification
def classify_tracking(df: DataFrame, as_of=None, key: str = "container_number",
                      ts: str = "event_ts", ordinal: str = "ordinal",
                      out: str = "type_of_tracking") -> DataFrame:
    """Historic / Current / Future per container relative to `as_of`.

    Unparseable or future timestamps -> Future; the latest past event of each
    container -> Current (ties: lowest ordinal); other past events -> Historic.
    """
    now = _as_of(as_of)
    past = df.filter(F.col(ts) <= now)
    winners = (past.groupBy(key).agg(F.max(latest_first_key(ts, ordinal)).alias("w"))
               .select(ordinal_of_key(F.col("w")).alias(ordinal)))
    marked = mark_ordinals(df, winners, "_is_current", ordinal)
    label = (F.when(F.col(ts).isNull() | (F.col(ts) > now), F.lit(C.FUTURE))
             .when(F.col("_is_current"), F.lit(C.CURRENT))
             .otherwise(F.lit(C.HISTORIC)))
    return marked.withColumn(out, label).drop("_is_current")


def constant_tracking(df: DataFrame, out: str = "type_of_tracking") -> DataFrame:
    """Carrier M exports every row as Current (no classification)."""
    return df.withColumn(out, F.lit(C.CURRENT))


# ------------------------------------------------------------- keys
def with_concat_keys_hlcu(df: DataFrame) -> DataFrame:
    keys = T.concat_keys_hlcu("container_number", "status", "transport", "type_of_tracking")
    return df.withColumns(keys)


def with_concat_2_hlcu(df: DataFrame) -> DataFrame:
    """The duplicate key alone; it does not depend on the tracking type."""
    return df.withColumn("concat_2", T.concat_keys_hlcu("container_number", "status", "transport", F.lit(""))["concat_2"])


def with_concat_keys_maeu(df: DataFrame) -> DataFrame:
    keys = T.concat_keys_maeu("container_number", "status", "type_of_tracking")
    return df.withColumns(keys)


def with_event_id(df: DataFrame, out: str = "_id",
                  fields=("container_number", "status", "date", "time")) -> DataFrame:
    return df.withColumn(out, T.composite_id(*fields))


# ---------------------------------------------------- latest-duplicate flag
def flag_latest(df: DataFrame, group: str = "concat_2", ts: str = "event_ts",
                ordinal: str = "ordinal", fallback_first: bool = True,
                out: str = "duplicates", rows: DataFrame | None = None) -> DataFrame:
    """In every group with more than one row, mark one row 'Latest'.

    The winner is the row with the greatest timestamp, first in input order
    on ties.  If no row of the group has a valid timestamp, the first row
    wins when `fallback_first` (carrier H) and no row does otherwise
    (carrier M).  All other rows get ''.  `rows` may name a leaner frame with
    the same ordinals to pick the winners from.
    """
    g = (df if rows is None else rows).groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.max(latest_first_key(ts, ordinal)).alias("w"))
    g = g.filter(F.col("n") > 1)
    if not fallback_first:
        g = g.filter(key_has_ts(F.col("w")))
    winners = g.select(ordinal_of_key(F.col("w")).alias(ordinal))
    marked = mark_ordinals(df, winners, "_is_latest", ordinal)
    return marked.withColumn(out, F.when(F.col("_is_latest"), F.lit(C.LATEST)).otherwise(F.lit(""))) \
                 .drop("_is_latest")


# ------------------------------------------------------------ summaries
def tracking_type_counts(df: DataFrame, col: str = "type_of_tracking") -> DataFrame:
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n_events"))
            .orderBy(F.col("n_events").desc(), F.col(col)))


def container_summary(df: DataFrame, key: str = "container_number", ordinal: str = "ordinal") -> DataFrame:
    """Per container: event count (non-null statuses), first and last date in
    input order (nulls skipped), and the distinct tracking types joined with
    ', ' in order of first appearance."""
    dated = F.when(F.col("date").isNotNull(), F.col(ordinal))
    main = df.groupBy(key).agg(
        F.count("status").alias("events"),
        F.min_by("date", dated).alias("first_date"),
        F.max_by("date", dated).alias("last_date"),
    )
    firsts = (df.filter(F.col("type_of_tracking").isNotNull())
              .groupBy(key, "type_of_tracking").agg(F.min(ordinal).alias("_first")))
    types = firsts.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_first", "type_of_tracking"))),
                                 lambda x: x["type_of_tracking"]), ", ").alias("tracking_types"))
    return main.join(types, key, "left")


def sample_per_type(df: DataFrame, n: int = 3, col: str = "type_of_tracking",
                    ordinal: str = "ordinal") -> DataFrame:
    """First `n` rows (input order) of each tracking type.

    `row_number() <= n` is planned with a partial WindowGroupLimit, so each
    map task forwards at most `n` rows per type before the shuffle.
    """
    w = Window.partitionBy(col).orderBy(ordinal)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def latest_duplicates_preview(df: DataFrame, n: int = 10, ordinal: str = "ordinal") -> DataFrame:
    """The first `n` rows flagged Latest, in input order (a top-k report:
    planned as a per-partition top-k merged on the driver side of one
    small exchange)."""
    return df.filter(F.col("duplicates") == C.LATEST).orderBy(ordinal).limit(n)


def container_summary_preview(summary: DataFrame, n: int = 20, key: str = "container_number") -> DataFrame:
    """The first `n` container summaries in container order (top-k report)."""
    return summary.orderBy(key).limit(n)


def distinct_types(df: DataFrame, col: str = "type_of_tracking", ordinal: str = "ordinal") -> DataFrame:
    """The distinct values of a column in order of first appearance (their
    smallest ordinal)."""
    return df.groupBy(col).agg(F.min(ordinal).alias("first_ordinal")).orderBy("first_ordinal")


def current_events(df: DataFrame) -> DataFrame:
    return df.filter(F.col("type_of_tracking") == C.CURRENT)


def latest_duplicates(df: DataFrame) -> DataFrame:
    return df.filter(F.col("duplicates") == C.LATEST)


def journey_timeline(df: DataFrame, key: str = "container_number", ts: str = "event_ts",
                     ordinal: str = "ordinal", status: str = "status") -> DataFrame:
    """Step number and previous status of every dated event of a container.

    Ordered per container without ever putting a whole container in one task,
    and without a job when the plan is built: a slice is a container's minute,
    a function of the row alone.  Rows are numbered within their slice.  What
    comes before a slice is summed over two light tables, minutes of a day and
    days of a container, so no window holds more than 1,440 minutes, the days
    of one container, or the events of one container in one minute.
    """
    keys = [key, "_day", "_minute"]
    at = F.col(ts)
    # From calendar parts, so the slices keep the order in any session zone.
    ev = df.filter(at.isNotNull()).withColumns({"_day": F.unix_date(F.to_date(at)), "_minute": F.hour(at) * 60 + F.minute(at)})
    # The last status is wrapped: a null status is still the previous one.
    minutes = ev.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max_by(F.struct(status), F.struct(ts, ordinal)).alias("_last"))
    days = minutes.groupBy(key, "_day").agg(F.sum("_n").alias("_n"), F.max_by("_last", "_minute").alias("_last"))

    def before(w: Window, n: str, last: str) -> list[Column]:
        total = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1))
        return [F.coalesce(total, F.lit(0)).alias(n), F.lag("_last").over(w).alias(last)]

    days = days.select(key, "_day", *before(Window.partitionBy(key).orderBy("_day"), "_n_days", "_last_day"))
    minutes = minutes.select(*keys, *before(Window.partitionBy(key, "_day").orderBy("_minute"), "_n_minutes", "_last_minute"))
    same_day = F.col(key).eqNullSafe(F.col("_k")) & (F.col("_day") == F.col("_d"))
    slices = minutes.join(days.select(F.col(key).alias("_k"), F.col("_day").alias("_d"), "_n_days", "_last_day"), same_day)
    slices = slices.select(F.col(key).alias("_k"), F.col("_day").alias("_d"), F.col("_minute").alias("_m"),
                           (F.col("_n_days") + F.col("_n_minutes")).alias("_offset"),
                           F.coalesce("_last_minute", "_last_day").alias("_before"))
    w = Window.partitionBy(*keys).orderBy(ts, ordinal)
    ev = ev.withColumns({"_rn": F.row_number().over(w), "_lag": F.lag(F.struct(status)).over(w)})
    same = F.col(key).eqNullSafe(F.col("_k")) & (F.col("_day") == F.col("_d")) & (F.col("_minute") == F.col("_m"))
    return ev.join(slices, same).select(
        *df.columns, (F.col("_offset") + F.col("_rn")).cast("bigint").alias("step"),
        F.coalesce("_lag", "_before").getField(status).alias("prev_status"))


def container_lookup(df: DataFrame, container: str, tracking_type: str | None = None) -> DataFrame:
    """Point access by container (and optionally tracking type)."""
    out = df.filter(F.col("container_number") == container)
    if tracking_type is not None:
        out = out.filter(F.col("type_of_tracking") == tracking_type)
    return out


def write_lookup_snapshot(df: DataFrame, path: str, key: str = "container_number", then: tuple[str, ...] = ("type_of_tracking",),
                          row_group_bytes: int = 16 << 20) -> None:
    """Store `df` for point access by `key`: range-partitioned and sorted by
    it, so that a value lies in few files and few row groups, whose minimum and
    maximum leave out the others; a bloom filter of each row group answers for
    values in between that do not occur.  A hot value spans several files
    (sorting goes on by `then` and the row's hash)."""
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    out = df.withColumn("_spread", spread).repartitionByRange(key, *then, "_spread").sortWithinPartitions(key, *then, "_spread").drop("_spread")
    (out.write.mode("overwrite").option("parquet.block.size", row_group_bytes)
     .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path))


def stored_container_lookup(spark: SparkSession, path: str, container: str, tracking_type: str | None = None) -> DataFrame:
    """Point access to what `write_lookup_snapshot` stored: the container (and
    type) are pushed to the scan."""
    return container_lookup(spark.read.parquet(path), container, tracking_type)
