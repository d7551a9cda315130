"""Hot keys: one container with most of the rows."""

import datetime as dt

from pyspark.sql import functions as F

from quayside import config as C
from quayside.operators import events as E


def _hot_frame(spark, n=3000):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        c = "HOT" if i % 10 < 8 else f"C{i % 7}"
        ts = base + dt.timedelta(hours=(i * 7919) % 500) if i % 13 else None
        rows.append((i, c, ts, f"S{i % 5}"))
    return spark.createDataFrame(rows, "ordinal bigint, container_number string, event_ts timestamp_ntz, "
                                       "status string"), rows


def _timeline(rows):
    want, by_c = {}, {}
    for o, c, ts, s in rows:
        if ts is not None:
            by_c.setdefault(c, []).append((ts, o, s))
    for c, evs in by_c.items():
        prev = None
        for k, (ts, o, s) in enumerate(sorted(evs, key=lambda e: e[:2]), start=1):
            want[o] = (k, prev)
            prev = s
    return want


def test_timeline_splits_a_hot_container_and_stays_exact(spark):
    df, rows = _hot_frame(spark)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    out = E.journey_timeline(df)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before  # no job while the plan is built
    assert {r.ordinal: (r.step, r.prev_status) for r in out.collect()} == _timeline(rows)
    # No window orders the events of a whole container: the hot one is many slices.
    hot = df.filter("container_number = 'HOT' and event_ts is not null")
    assert hot.select(F.date_trunc("minute", "event_ts")).distinct().count() >= 400


def test_timeline_within_minutes_and_with_null_statuses(spark):
    base = dt.datetime(2024, 3, 30, 23, 58)
    rows = [(i, "A" if i % 3 else None, base + dt.timedelta(seconds=(i * 37) % 400), None if i % 4 == 0 else f"S{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "ordinal bigint, container_number string, event_ts timestamp_ntz, status string")
    got = {r.ordinal: (r.step, r.prev_status) for r in E.journey_timeline(df).collect()}
    assert got == _timeline(rows)


def test_classify_with_a_hot_container(spark):
    df, rows = _hot_frame(spark)
    out = E.classify_tracking(df, dt.datetime(2024, 1, 15))
    cur = out.filter(F.col("type_of_tracking") == C.CURRENT).groupBy("container_number").count()
    assert all(r["count"] == 1 for r in cur.collect())
    hot_cur = out.filter((F.col("container_number") == "HOT") & (F.col("type_of_tracking") == C.CURRENT)).first()
    past = [(ts, -o) for o, c, ts, s in rows if c == "HOT" and ts is not None and ts <= dt.datetime(2024, 1, 15)]
    assert hot_cur.ordinal == -max(past)[1]


def _skewed(spark, kind, n=4000):
    key = {"null": lambda i: None if i % 3 else f"k{i % 50}", "hot": lambda i: "hot" if i % 3 == 0 else f"k{i % 50}"}[kind]
    base = spark.createDataFrame([(i, key(i), "x" * 40) for i in range(n)], "i int, key string, pad string").repartition(8)
    dim = spark.createDataFrame([(f"k{j % 50}", f"v{j}", j) for j in range(200)] + [("hot", "vh", 1)], "k string, v string, ordinal int")
    return base, dim


def test_null_keys_are_spread_over_reducers(spark):
    from quayside.operators import lookups as L

    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        base, dim = _skewed(spark, "null")
        out = L.lookup_join(base, dim, "key", "k", {"v": "v"})
        sizes = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        assert max(r["count"] for r in sizes) < 0.4 * 4000
        want = {f"k{j % 50}": f"v{150 + j % 50}" for j in range(50)}
        assert all(r.v == want.get(r.key) for r in out.collect()) and out.count() == 4000
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_a_hot_lookup_key_is_split(spark):
    from quayside.operators import lookups as L

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {c: spark.conf.get(c, None) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        base, dim = _skewed(spark, "hot")
        out = L.lookup_join(base, dim, "key", "k", {"v": "v"})
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert len(rows) == 4000 and all((r.v == "vh") == (r.key == "hot") for r in rows)
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
