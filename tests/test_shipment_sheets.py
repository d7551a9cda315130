"""The sheets of a shipment are grouped once and their wide rows stay there."""

import re

from pyspark.sql import functions as F

from quayside.operators import lookups as L
from quayside.plans import report as RP
from quayside.sources.catalog import load_inputs

from conftest import SMALL


def test_the_report_shuffles_its_wide_rows_once(spark):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {c: spark.conf.get(c) for c in off}
    for c, v in off.items():
        spark.conf.set(c, v)
    try:
        plan = RP.master_report(load_inputs(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert plan.count("Exchange hashpartitioning") <= 30
    # the base rows, the sheets' grouping, the lookups' grouping and their way back
    assert len(re.findall(r"Exchange hashpartitioning\(lsc_tracking_number#\d+L, _(?:shard|place)", plan)) == 4
    # the wide rows are grouped and then joined where they are
    way = plan[plan.index("SortMergeJoin [lsc_tracking_number"):]
    left = way[way.index("_shard", way.index("], LeftOuter")):]
    assert left.index("SortAggregate") < left.index("Exchange hashpartitioning")


def _sheets(spark):
    a = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, None, 1), (3, "n", None), (None, "z", 1)], "k bigint, v string, ordinal int")
    b = spark.createDataFrame([(1, 10, 7), (1, 20, 8), (4, 30, 1)], "k bigint, w int, ordinal int")
    return L.Sheet(a, "k", last={"v": "last_v"}, first={"v": "first_v"}), L.Sheet(b, "k", first={"w": "w"})


def test_sheets_side_by_side(spark):
    out = L.dedupe_sheets(*_sheets(spark), key_alias="id").drop(L.SHARD)
    assert out.columns == ["id", "last_v", "first_v", "w"]
    assert sorted(map(tuple, out.collect())) == [(1, "y", "x", 10), (2, None, None, None), (3, None, None, None), (4, None, None, 30)]


def test_rows_join_their_group_and_null_keys_stay(spark):
    grouped = L.dedupe_sheets(*_sheets(spark), key_alias="id")
    base = spark.createDataFrame([(1, "a"), (1, "b"), (9, "c"), (None, "d")], "id bigint, n string")
    out = L.join_grouped(base, grouped, "id").select("id", "n", "last_v", "w").collect()
    assert sorted(map(tuple, out), key=lambda r: r[1]) == [(1, "a", "y", 10), (1, "b", "y", 10), (9, "c", None, None), (None, "d", None, None)]


def test_lookups_see_the_winning_row_of_equal_ordinals(spark):
    """Equal ordinals with other lookup keys: the values looked up belong to
    the keys shown, however the rows are dealt."""
    n = 40
    columns = list(RP.MASTER_LAST) + ["lane_id"]
    numbers = {"number_of_packages", "vol1", "weight1", "vol2", "weight2"}
    rows = spark.range(n).select(
        (F.col("id") % 4).alias("sti"), F.lit(5).cast("bigint").alias("ordinal"),
        *[F.lit(1.0).alias(c) if c in numbers else F.concat(F.lit(c), F.col("id").cast("string")).alias(c) for c in columns]).repartition(7)
    notes = spark.range(n).select(F.concat(F.lit("scac_code"), F.col("id").cast("string")).alias("carrier_scac"),
                                  F.concat(F.lit("scac_code"), F.col("id").cast("string")).alias("name"), F.lit(1).alias("ordinal"))

    from quayside.sources.inputs import NamedInputs

    t = NamedInputs(spark, {"shipment_master": rows, "carrier_notes": notes})
    ship = RP.looked_up(RP.per_shipment(RP.master_sheet(t)), t, RP.with_notes)
    got = ship.select("steamship_line_scac", "steamship_line").collect()
    assert len(got) == 4 and all(r.steamship_line == r.steamship_line_scac for r in got)


def test_sheets_are_not_sorted_before_their_shuffle(spark):
    plan = L.dedupe_sheets(*_sheets(spark), key_alias="id")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan and "Aggregate" not in plan[plan.index("Exchange"):]


def test_rows_of_hot_keys_are_combined_first(spark, monkeypatch):
    want = sorted(map(tuple, L.dedupe_sheets(*_sheets(spark), key_alias="id").collect()))
    seen = []
    monkeypatch.setattr(L, "HOT_KEY_ROWS", 100)
    monkeypatch.setattr(L, "key_sample", lambda df: df)
    combined = L._hot_combined
    monkeypatch.setattr(L, "_hot_combined", lambda tall, *a: seen.append(combined(tall, *a)) or seen[-1])
    got = L.dedupe_sheets(*_sheets(spark), key_alias="id").collect()
    assert sorted(map(tuple, got)) == want
    assert sorted(r.id for r in seen[0].collect()) == [1, 2, 3, 4]  # of 6 rows, the four of key 1 are one
