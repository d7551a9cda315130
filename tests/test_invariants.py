"""Invariants over the derived inputs and stream = batch."""

from pyspark.sql import functions as F

import __spark_entry__ as ent
from quayside import config as C
from quayside.plans import report as RP
from quayside.plans import tracking as TR
from quayside.sources import standins as S
from quayside.sources.catalog import load_inputs, read_csv_export

from conftest import SMALL


def test_one_current_per_container_with_past_events(spark):
    ex = TR.hlcu_export(load_inputs(spark, SMALL))
    per = ex.groupBy("container_number").agg(
        F.count_if(F.col("type_of_tracking") == C.CURRENT).alias("cur"),
        F.count_if(F.col("event_ts") <= F.lit(C.AS_OF)).alias("past"))
    bad = per.filter(((F.col("past") > 0) & (F.col("cur") != 1)) | ((F.col("past") == 0) & (F.col("cur") != 0)))
    assert bad.count() == 0


def test_at_most_one_latest_per_group(spark):
    ex = TR.hlcu_export(load_inputs(spark, SMALL))
    per = ex.groupBy("concat_2").agg(F.count(F.lit(1)).alias("n"),
                                     F.count_if(F.col("duplicates") == C.LATEST).alias("latest"))
    assert per.filter((F.col("latest") > 1) | ((F.col("n") == 1) & (F.col("latest") > 0))).count() == 0


def test_left_lookups_keep_base_row_count(spark):
    t = load_inputs(spark, SMALL)
    assert RP.master_report(t).count() == S.intransit(t).count()


def test_union_count_is_sum_of_parts(spark):
    t = load_inputs(spark, SMALL)
    assert TR.fct_tracking_events(t).count() == TR.stg_hlcu(t).count() + TR.stg_maeu(t).count()


def test_stream_upsert_equals_batch_upsert(spark):
    q = ent.queries()
    a = q["event_upsert"](spark, SMALL)
    b = q["stream_upsert"](spark, SMALL).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_upsert_replay_is_idempotent(spark):
    from quayside.operators.upsert import upsert
    from quayside.plans.registry_more import KEYS, upsert_inputs

    target, batch = upsert_inputs(load_inputs(spark, SMALL))
    once = upsert(target, batch, KEYS)
    twice = upsert(once, batch, KEYS)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_csv_export_reader(spark, tmp_path):
    p = str(tmp_path / "exp")
    S.watchlist(load_inputs(spark, SMALL)).write.option("header", True).csv(p)
    df = read_csv_export(spark, p, "ordinal bigint, container_number string")
    assert df.count() == load_inputs(spark, SMALL).customer.count()


def test_preview_reports(spark):
    from quayside.operators import events as E

    ex = TR.hlcu_export(load_inputs(spark, SMALL))
    prev = E.latest_duplicates_preview(ex)
    rows = prev.collect()
    want = sorted(r.ordinal for r in ex.filter(F.col("duplicates") == C.LATEST).collect())[:10]
    assert [r.ordinal for r in rows] == want
    summ = E.container_summary_preview(E.container_summary(ex))
    names = [r.container_number for r in summ.collect()]
    assert names == sorted(names) and len(names) == min(20, ex.select("container_number").distinct().count())


def test_stored_high_water_mark(spark, tmp_path):
    import datetime as dt

    from quayside.streaming.ingest import HighWaterMark

    schema = "k string, last_updated timestamp_ntz"
    t1, t2, t3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
    snap = spark.createDataFrame([("a", t1), ("b", t2)], schema)
    hwm = HighWaterMark(spark, str(tmp_path / "wm"))
    first = hwm.changes(snap)
    assert first.count() == 2
    hwm.commit(first)
    assert hwm.changes(snap).count() == 0
    snap2 = snap.unionByName(spark.createDataFrame([("c", t3)], schema))
    assert [r.k for r in hwm.changes(snap2).collect()] == ["c"]
