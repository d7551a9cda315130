"""Keyed lookups: first-wins / last-wins dimensions and left lookup joins.

A spreadsheet lookup keeps one value per key: the last duplicate
(`dict(zip(keys, values))`) or the first one (`drop_duplicates(keep="first")`).
Here "first"/"last" mean lowest/highest `ordinal`, and the winning *row* is
kept, even when some of its values are null.

The de-duplication is `min_by`/`max_by` over a struct in a grouped
aggregate, which Spark combines per map partition before the shuffle, so a
key holding a large share of the dimension does not concentrate in one task.
The join itself is left to the planner: AQE broadcasts the de-duplicated
side when its measured size is under `spark.sql.autoBroadcastJoinThreshold`
and falls back to a shuffle join otherwise, with null keys spread and hot
keys split (`_left_join`).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.upsert import HOT_KEY_ROWS, HOT_KEY_SAMPLE, key_sample
from quayside.session import shuffle_partitions_for


def dedupe_by_key(dim: DataFrame, key: str, cols, keep: str = "last", ordinal: str = "ordinal",
                  key_alias: str | None = None) -> DataFrame:
    """One row per non-null `key`: the row with the highest (`last`) or
    lowest (`first`) ordinal; returns `key_alias` (default `key`) + cols."""
    cols = list(cols)
    pick = F.max_by if keep == "last" else F.min_by
    if keep not in ("first", "last"):
        raise ValueError(keep)
    packed = F.struct(*[F.col(c) for c in cols])
    out = (dim.filter(F.col(key).isNotNull())
           .groupBy(key).agg(pick(packed, F.col(ordinal)).alias("_v")))
    return out.select(F.col(key).alias(key_alias or key), *[F.col("_v").getField(c).alias(c) for c in cols])


def lookup_join(base: DataFrame, dim: DataFrame, base_key, dim_key: str, cols: dict[str, str] | list,
                keep: str = "last", ordinal: str = "ordinal", broadcast: bool = False) -> DataFrame:
    """Left-join `dim` values onto `base` by key with a first/last-wins rule.

    `cols` maps dimension column -> output column (a list keeps names).
    `base_key` is a column name or expression; nulls never match.
    `broadcast=True` is for dimensions whose size is bounded by construction
    (literal reference tables).
    """
    mapping = dict(cols) if isinstance(cols, dict) else {c: c for c in cols}
    d = dedupe_by_key(dim, dim_key, list(mapping), keep, ordinal, key_alias="_lk")
    return _left_join(base, d.select("_lk", *[F.col(s).alias(t) for s, t in mapping.items()]),
                      base_key, broadcast)


# Places over which base rows with a null key are spread.
NULL_PLACES = 256


def _placed(base: DataFrame, key: Column) -> DataFrame:
    """`base` with `_place`: 0, or for a null key a place by the row's hash."""
    spread = F.pmod(F.xxhash64(*base.columns), F.lit(NULL_PLACES - 1)) + 1
    return base.withColumn("_place", F.when(key.isNull(), spread).otherwise(F.lit(0)).cast("bigint"))


def _zero(key: str) -> Column:
    # always 0, but not a constant that could be folded out of the join key
    return F.pmod(F.xxhash64(key), F.lit(1)).cast("bigint")


def _left_join(base: DataFrame, d: DataFrame, base_key, broadcast: bool = False) -> DataFrame:
    """Left join on `d._lk` (a column name is kept as the base's column).

    The join key is (key, place): 0 for every value, and for a null key a
    place by the row's hash, so null-key rows (which never match) are spread
    over the reducers instead of meeting in one.  Having its own key, the join
    also shuffles the de-duplicated side anew, and adaptive execution can
    split the partition of a hot key.
    """
    if broadcast:
        d = F.broadcast(d)
    key = F.col(base_key) if isinstance(base_key, str) else base_key
    if broadcast:
        return base.join(d, key == d["_lk"], "left").drop("_lk")
    b = _placed(base, key)
    d = d.withColumn("_zero", _zero("_lk"))
    return b.join(d, (key == d["_lk"]) & (b["_place"] == d["_zero"]), "left").drop("_lk", "_place", "_zero")


def join_dimension(base: DataFrame, dim: DataFrame, base_key, dim_key: str, cols: dict[str, str],
                   broadcast: bool = False) -> DataFrame:
    """Left-join an already de-duplicated dimension (one row per key).

    Used for role-playing dimensions: one de-duplicated dimension definition
    (every column any role needs) joined once per role, so the identical
    de-dup shuffles are planned once and reused (ReusedExchange), and for
    literal reference tables whose keys are unique."""
    d = dim.select(F.col(dim_key).alias("_lk"), *[F.col(s).alias(t) for s, t in cols.items()])
    return _left_join(base, d, base_key, broadcast)


class Sheet(NamedTuple):
    """Rows by `key` with the columns that its last row (highest `ordinal`)
    and its first one give, as source column -> output column.  Of several last
    rows with one ordinal, the hash of the `tie` columns decides."""

    rows: DataFrame
    key: str
    last: dict[str, str] | None = None
    first: dict[str, str] | None = None
    tie: tuple[str, ...] = ()
    ordinal: str = "ordinal"


# The second grouping key of `dedupe_sheets`, for `join_grouped`.
SHARD = "_shard"
# Rows of the sheets of one initial shuffle partition.
TASK_SHEET_ROWS = 200_000


def _hot_combined(tall: DataFrame, key: str, picks: list[tuple]) -> DataFrame:
    """`tall` with one row, of the winners, for each key that a large share of
    its sample repeats (combined per map partition); all rows of the other keys.
    `picks` has (value, rank, rule of the value, rule of the rank).  The shuffles
    start with a partition per `TASK_SHEET_ROWS` rows, as the sample counts them."""
    seen = key_sample(tall.select(key)).groupBy(key).count()
    rows, hot = seen.agg(F.coalesce(F.sum("count"), F.lit(0)),
                         F.collect_list(F.when(F.col("count") > HOT_KEY_ROWS * HOT_KEY_SAMPLE, F.col(key)))).first()
    shuffle_partitions_for(tall.sparkSession, int(rows / HOT_KEY_SAMPLE), TASK_SHEET_ROWS)
    if not hot:
        return tall
    both = [x for value, rank, pick, best in picks for x in (pick(value, rank).alias(value), best(rank).alias(rank))]
    top = tall.where(F.col(key).isin(hot)).groupBy(key).agg(*both)
    return tall.where(~F.col(key).isin(hot)).unionByName(top)


def dedupe_sheets(*sheets: Sheet, key_alias: str) -> DataFrame:
    """One row per key that any sheet has, with all sheets' columns, and
    `SHARD`: the sheets' rows are grouped as one tall table, so they are
    shuffled once and their columns need no join.  Most keys have a row or two
    of a sheet, so they are not combined, which sorts them, before the shuffle;
    the rows of keys that repeat very often are."""
    tall, picks, out = None, [], []
    for k, sheet in enumerate(sheets):
        o = F.col(sheet.ordinal)
        ranked = F.when(o.isNotNull(), F.struct(o, F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in sheet.tie])))
        cols, order = [], ranked if sheet.tie else o
        for rule, pick, best, by, wanted in (("l", F.max_by, F.max, order, sheet.last), ("f", F.min_by, F.min, o, sheet.first)):
            if not wanted:
                continue
            value, rank = f"_{rule}{k}", f"_{rule}o{k}"
            cols += [F.struct(*[F.col(c) for c in wanted]).alias(value), by.alias(rank)]
            picks.append((value, rank, pick, best))
            out += [F.col(value).getField(c).alias(name) for c, name in wanted.items()]
        rows = sheet.rows.filter(F.col(sheet.key).isNotNull()).select(F.col(sheet.key).alias(key_alias), *cols)
        tall = rows if tall is None else tall.unionByName(rows, allowMissingColumns=True)
    tall = _hot_combined(tall, key_alias, picks).withColumn(SHARD, _zero(key_alias)).repartition(key_alias, SHARD)
    grouped = tall.groupBy(key_alias, SHARD).agg(*[pick(value, rank).alias(value) for value, rank, pick, _ in picks])
    return grouped.select(key_alias, SHARD, *out)


def join_grouped(base: DataFrame, grouped: DataFrame, key: str) -> DataFrame:
    """Left-join `base` with rows made by `dedupe_sheets`, null keys spread.
    The grouped rows stay where their grouping left them; only `base` is
    shuffled."""
    d = grouped.withColumnRenamed(key, "_lk")
    b = _placed(base, F.col(key))
    return b.join(d, (b[key] == d["_lk"]) & (b["_place"] == d[SHARD]), "left").drop("_lk", "_place", SHARD)


def dedupe_rules(dim: DataFrame, key: str, last: dict[str, str] | None = None, first: dict[str, str] | None = None,
                 ordinal: str = "ordinal", key_alias: str | None = None) -> DataFrame:
    """One grouped pass over `dim` serving both rules for the same key: the
    `last` columns from the highest-ordinal row and the `first` columns from
    the lowest."""
    return dedupe_sheets(Sheet(dim, key, last, first, ordinal=ordinal), key_alias=key_alias or key).drop(SHARD)


def reference_table(spark, rows, schema: str) -> DataFrame:
    """A literal reference table (bounded size, safe to broadcast)."""
    return spark.createDataFrame(list(rows), schema)
