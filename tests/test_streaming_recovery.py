"""Merges into the stored snapshot survive crashes, replays and other writers."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quayside.operators import upsert as U
from quayside.plans import registry_more as RM
from quayside.session import scratch_path
from quayside.sources.catalog import load_inputs
from quayside.streaming import ingest as ING

from conftest import SMALL

SCHEMA = ("carrier string, _id string, ordinal bigint, container_number string, status string, place string, "
          "date string, time string, transport string, last_updated string, seq bigint")


def _stored_target(spark):
    target, batch = RM.upsert_inputs(load_inputs(spark, SMALL))
    first = RM.with_event_partition(U.latest_per_key(target, RM.KEYS))
    path = scratch_path(spark, "t-recover")
    U.write_partitions(first, path, RM.PARTITIONS)
    return target, batch, first, path


def _prepare(columns):
    def prepare(df):
        return RM.with_event_partition(df.withColumn("last_updated", F.to_timestamp_ntz("last_updated"))).select(*columns)
    return prepare


def _same(got, want):
    got = got.select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("when", ["after_stage", "after_merge"])
def test_stream_upsert_survives_a_crash(spark, when):
    """A micro-batch that dies between its two writes, or after them but
    before the stream commits its offset, is run again on restart."""
    target, batch, first, path = _stored_target(spark)
    src, ckpt = scratch_path(spark, "t-recover-src"), scratch_path(spark, "t-recover-ckpt")
    batch.withColumn("last_updated", F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss")) \
        .repartition(4, "ordinal").write.json(src)

    def crash(epoch):
        if epoch == 1:
            raise RuntimeError("simulated loss")

    run = dict(schema=SCHEMA, max_files_per_trigger=2)
    with pytest.raises(StreamingQueryException):
        ING.upsert_available(spark, src, path, RM.KEYS, RM.PARTITIONS, _prepare(first.columns), ckpt, **run, **{when: crash})
    # Another writer merges before the stream comes back.
    extra = first.orderBy(*RM.KEYS).limit(1).withColumns({"_id": F.lit("other|x|2024-01-05|1"), "date": F.lit("2024-01-05"), "last_updated": F.lit(dt.datetime(2024, 2, 1))})
    extra = RM.with_event_partition(extra.drop(*RM.PARTITIONS)).select(*first.columns)
    U.merge_snapshot(path, extra, RM.KEYS, RM.PARTITIONS, scratch_path(spark, "t-other"))
    ING.upsert_available(spark, src, path, RM.KEYS, RM.PARTITIONS, _prepare(first.columns), ckpt, **run)
    want = U.upsert(U.upsert(target, batch, RM.KEYS), extra.drop(*RM.PARTITIONS), RM.KEYS).drop("seq")
    _same(U.read_snapshot(spark, path, first.schema).drop("seq", *RM.PARTITIONS), want)


def test_a_daily_merge_and_a_new_stream_keep_each_others_rows(spark):
    target, batch, first, path = _stored_target(spark)
    rows = RM.with_event_partition(batch).select(*first.columns)
    U.merge_snapshot(path, rows.filter("seq % 4 = 0"), RM.KEYS, RM.PARTITIONS, scratch_path(spark, "t-daily"))
    src = scratch_path(spark, "t-new-src")
    batch.filter("seq % 4 != 0").withColumn("last_updated", F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss")).write.json(src)
    ING.upsert_available(spark, src, path, RM.KEYS, RM.PARTITIONS, _prepare(first.columns), scratch_path(spark, "t-new-ckpt"), schema=SCHEMA)
    _same(U.read_snapshot(spark, path, first.schema).drop("seq", *RM.PARTITIONS), U.upsert(target, batch, RM.KEYS).drop("seq"))


def _rows(spark, rows):
    schema = ("carrier string, _id string, date string, container_number string, status string, "
              "last_updated timestamp_ntz, seq bigint")
    return RM.with_event_partition(spark.createDataFrame(rows, schema))


def test_padded_dates_and_blank_carriers_share_their_keys_partition(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    path = scratch_path(spark, "t-odd")
    first = _rows(spark, [("HLCU", "a", "2024-01-05 ", "C", "old", t1, 1), ("", "b", "", "C", "old", t1, 2),
                          (" ", "c", "x/y=z", "C", "old", t1, 3)])
    U.write_partitions(first, path, RM.PARTITIONS)
    batch = _rows(spark, [("HLCU", "a", "2024-01-05", "C", "new", t2, 4), ("", "b", None, "C", "new", t2, 5)])
    U.merge_snapshot(path, batch, RM.KEYS, RM.PARTITIONS, scratch_path(spark, "t-odd-staged"))
    got = sorted((r._id, r.status) for r in U.read_snapshot(spark, path, first.schema).collect())
    assert got == [("a", "new"), ("b", "new"), ("c", "old")]


def test_only_a_missing_path_reads_as_empty(spark, tmp_path):
    schema = spark.range(1).schema
    assert U.read_snapshot(spark, str(tmp_path / "none"), schema).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        U.read_snapshot(spark, str(tmp_path / "bad"), schema).count()


def test_rows_that_arrive_late_with_the_marks_time_are_read(spark, tmp_path):
    t1 = dt.datetime(2024, 1, 1)
    schema = "k string, last_updated timestamp_ntz"
    a = spark.createDataFrame([("a", t1)], schema)
    mark = ING.HighWaterMark(spark, str(tmp_path / "mark"))
    mark.commit(mark.changes(a))
    both = a.unionByName(spark.createDataFrame([("late", t1)], schema))
    changes = mark.changes(both)
    assert [r.k for r in changes.collect()] == ["late"]
    mark.commit(changes)
    assert mark.changes(both).count() == 0


def test_fields_absent_from_a_batch_survive_and_failures_count(spark):
    schema = "k string, v string, w string, last_updated timestamp_ntz, seq bigint"
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    target = spark.createDataFrame([("a", "old", "keep", t1, 1)], schema)
    batch = spark.createDataFrame([("a", "new", t2, 2), ("a", "new", t2, 3), ("b", "x", t2, 4), (None, "lost", t2, 5)],
                                  "k string, v string, last_updated timestamp_ntz, seq bigint")
    got = sorted((r.k, r.v, r.w) for r in U.upsert(target, batch, ["k"]).collect())
    assert got == [("a", "new", "keep"), ("b", "x", None)]
    m = U.upsert_metrics(target, batch, ["k"]).first()
    assert (m.inserted, m.updated, m.total_processed, m.failed) == (1, 1, 4, 1)


def test_a_batch_that_differs_at_each_evaluation_loses_nothing(spark):
    """The carrier, and with it the partition, is drawn anew whenever the batch
    is evaluated; every merge reads one written copy of it."""
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    draw = F.udf(lambda: __import__("random").choice(["HLCU", "MAEU"])).asNondeterministic()
    for run in range(4):
        path = scratch_path(spark, "t-drawn")
        first = _rows(spark, [(c, f"{c}{k}", "2024-01-05", "C", "old", t1, k) for c in ("HLCU", "MAEU") for k in range(10)])
        U.write_partitions(first, path, RM.PARTITIONS)
        batch = _rows(spark, [("x", f"new{run}", "2024-01-05", "C", "new", t2, 1)]).withColumn("carrier", draw())
        batch = RM.with_event_partition(batch.drop(*RM.PARTITIONS)).select(*first.columns)
        got = U.merge_snapshot(path, batch, RM.KEYS, RM.PARTITIONS, scratch_path(spark, "t-drawn-staged"))
        assert U.read_snapshot(spark, path, first.schema).count() == 21
        assert got == {"inserted": 1, "matched": 0, "modified": 0, "total_processed": 1, "failed": 0}


def test_a_merge_reads_only_the_partitions_it_touches(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    path = scratch_path(spark, "t-pruned")
    days = [f"2024-01-{d:02d}" for d in range(1, 21)]
    first = _rows(spark, [("HLCU", f"{d}|{k}", d, "C", "old", t1, k) for d in days for k in range(3)])
    U.write_partitions(first, path, RM.PARTITIONS)
    batch = _rows(spark, [("HLCU", f"{days[4]}|1", days[4], "C", "new", t2, 9), ("MAEU", "n", days[5], "C", "new", t2, 9),
                          ("HLCU", f"{days[7]}|1", days[7], "C", "old", t2, 9)])
    snapshot = U.read_snapshot(spark, path, first.schema)
    read = U.touched_partitions(snapshot, batch, RM.PARTITIONS)
    plan = read._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [" in plan.toString() and "_pday" in plan.toString().split("PartitionFilters: ")[1]
    files = {r[0].split("/part-")[0][-10:] for r in read.select(F.input_file_name()).distinct().collect()}
    assert files == {days[4], days[7]}
    # Files that the scan itself opened, from its metrics.
    scan = read.select("_id")._jdf.queryExecution()
    scan.executedPlan().executeCollect()
    leaves = scan.executedPlan().collectLeaves()
    opened = [leaves.apply(k).metrics().apply("numFiles").value() for k in range(leaves.size())]
    assert sum(opened) == 2 < len(list(snapshot.inputFiles()))
    before = {r.file: r.n for r in U.read_snapshot(spark, path, first.schema).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n")).collect()}
    got = U.merge_snapshot(path, batch, RM.KEYS, RM.PARTITIONS, scratch_path(spark, "t-pruned-staged"))
    assert got == {"inserted": 1, "matched": 2, "modified": 1, "total_processed": 3, "failed": 0}
    after = {r[0] for r in U.read_snapshot(spark, path, first.schema).select(F.input_file_name()).distinct().collect()}
    kept = {f for f in before if f.split("/part-")[0][-10:] not in (days[4], days[7])}
    assert kept <= after and U.read_snapshot(spark, path, first.schema).count() == 61


def test_many_touched_partitions_are_reduced_by_a_join(spark, monkeypatch):
    monkeypatch.setattr(U, "NAMED_PARTITIONS", 1)
    t1 = dt.datetime(2024, 1, 1)
    first = _rows(spark, [("HLCU", f"{d}", f"2024-01-0{d}", "C", "old", t1, d) for d in range(1, 6)])
    read = U.touched_partitions(first, first.where("seq < 4"), RM.PARTITIONS)
    assert sorted(r._id for r in read.collect()) == ["1", "2", "3"]


def test_a_finished_batch_is_merged_once(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    path, ledger = scratch_path(spark, "t-once"), scratch_path(spark, "t-once-ledger")
    U.write_partitions(_rows(spark, [("HLCU", "a", "2024-01-05", "C", "old", t1, 1)]), path, RM.PARTITIONS)
    batch = _rows(spark, [("HLCU", "a", "2024-01-05", "C", "new", t2, 1), (None, "b", "2024-01-05", "C", "new", t2, 1)])
    merge = lambda: U.merge_snapshot(path, batch, RM.KEYS, RM.PARTITIONS, scratch_path(spark, "t-once-staged"), ledger=ledger)
    assert merge() == {"inserted": 0, "matched": 1, "modified": 1, "total_processed": 2, "failed": 1}
    files = sorted(U.read_snapshot(spark, path, batch.schema).inputFiles())
    assert merge() is None and sorted(U.read_snapshot(spark, path, batch.schema).inputFiles()) == files
