"""Business rules on small hand-made frames: golden rows and edge cases."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from quayside import config as C
from quayside.functions import status as ST
from quayside.functions import text as T
from quayside.functions import timeparse as TP
from quayside.operators import events as E
from quayside.operators import lookups as L
from quayside.operators import report as R
from quayside.operators import upsert as U

AS_OF = dt.datetime(2024, 1, 20)


def one(df, col):
    return [r[col] for r in df.collect()]


def test_trim_ws_strips_all_whitespace(spark):
    df = spark.createDataFrame([("\t a b \n",), (None,)], "s string")
    assert one(df.select(T.trim_ws("s").alias("x")), "x") == ["a b", None]


def test_composite_id_keeps_its_places(spark):
    df = spark.createDataFrame(
        [("BOXU0000011", "Gate in", "2023-02-03", "04:05"), ("X", None, " 1 ", None)],
        "c string, s string, d string, t string")
    got = one(df.select(T.composite_id("c", "s", "d", "t").alias("x")), "x")
    assert got == ["BOXU0000011|Gate in|2023-02-03|04:05", "X||1|"]


def test_concat_keys(spark):
    df = spark.createDataFrame([("BOXU0000011", "Arrival in", "NORTH STAR 7", C.HISTORIC),
                                ("BOXU0000011", "Gate in", "NORTH STAR 7", C.HISTORIC)],
                               "container_number string, status string, transport string, type_of_tracking string")
    rows = E.with_concat_keys_hlcu(df).collect()
    assert rows[0].concat_1 == "BOXU0000011Arrival inNORTH STAR 7" + C.HISTORIC
    assert rows[0].concat_2 == "BOXU0000011Arrival inNORTH STAR 7"
    assert rows[0].concat_3 == "BOXU0000011" + C.HISTORIC
    assert rows[1].concat_2 == "BOXU0000011Gate in"  # transport only for arrival/departure
    m = spark.createDataFrame([("BOXU0000029", "Off rail", C.CURRENT)],
                              "container_number string, status string, type_of_tracking string")
    assert E.with_concat_keys_maeu(m).first().concat_2 == "BOXU0000029Off rail"


def test_vessel_extraction(spark):
    df = spark.createDataFrame([("Load on X",), ("Vessel departure (X)",), ("vessel ARRIVAL(X)",), ("Gate in",),
                                ("",)], "status string")
    v = T.extract_vessel("status")
    rows = df.select(v["status"].alias("s"), v["vessel_name"].alias("v")).collect()
    assert [(r.s, r.v) for r in rows] == [("Load on", "X"), ("Vessel departure", "X"), ("Vessel arrival", "X"),
                                          ("Gate in", ""), ("", "")]


def test_card_parse(spark):
    parts = [["Port Quill", "North Basin", "Discharge", "11 Feb 2031 07:45"],
             ["", "11 Feb 2031 07:45", "Load on EVER X", "Port A", "Port A"],
             ["Gate in"]]
    df = spark.createDataFrame([(p,) for p in parts], "parts array<string>")
    p = T.parse_card_parts("parts")
    rows = df.select(*[c.alias(k) for k, c in p.items()]).collect()
    assert (rows[0].location, rows[0].status, rows[0].date, rows[0].time) == (
        "Port Quill - North Basin", "Discharge", "11 Feb 2031", "07:45")
    # blank line skipped; terminal equal to location is not repeated
    assert (rows[1].location, rows[1].status, rows[1].vessel_name) == ("Port A", "Load on", "EVER X")
    assert (rows[2].location, rows[2].date, rows[2].time) == ("", "", "")


def test_timestamp_parsers(spark):
    df = spark.createDataFrame([("2024-1-5", "6:00"), ("", "06:00"), ("2024-02-31", "00:00")], "d string, t string")
    got = one(df.select(TP.hlcu_event_ts("d", "t").alias("x")), "x")
    assert got == [dt.datetime(2024, 1, 5, 6, 0), None, None]
    m = spark.createDataFrame([("06 oct 2025",), ("31 Feb 2025",)], "d string")
    assert one(m.select(TP.maeu_event_date("d").alias("x")), "x") == [dt.datetime(2025, 10, 6), None]


def _events(spark, rows):
    return spark.createDataFrame(rows, "ordinal bigint, container_number string, event_ts timestamp_ntz")


def test_classify(spark):
    d = dt.datetime
    rows = [(1, "A", d(2024, 1, 10)), (2, "A", d(2024, 1, 15)), (3, "A", d(2024, 1, 15)),
            (4, "A", d(2024, 1, 25)), (5, "A", None), (6, "B", d(2024, 2, 1))]
    got = {r.ordinal: r.type_of_tracking for r in E.classify_tracking(_events(spark, rows), AS_OF).collect()}
    assert got == {1: C.HISTORIC, 2: C.CURRENT, 3: C.HISTORIC, 4: C.FUTURE, 5: C.FUTURE, 6: C.FUTURE}


def test_flag_latest(spark):
    d = dt.datetime
    df = spark.createDataFrame(
        [(1, "g1", d(2024, 1, 1)), (2, "g1", d(2024, 1, 3)), (3, "g1", d(2024, 1, 3)),
         (4, "g2", None), (5, "g2", None), (6, "g3", d(2024, 1, 1))],
        "ordinal bigint, concat_2 string, event_ts timestamp_ntz")
    h = {r.ordinal: r.duplicates for r in E.flag_latest(df, fallback_first=True).collect()}
    assert h == {1: "", 2: "Latest", 3: "", 4: "Latest", 5: "", 6: ""}
    m = {r.ordinal: r.duplicates for r in E.flag_latest(df, fallback_first=False).collect()}
    assert m == {1: "", 2: "Latest", 3: "", 4: "", 5: "", 6: ""}


def test_normalize_id(spark):
    df = spark.createDataFrame([(45000.0, "45000"), (20000.0, " 12 "), (90000.0, "1_000"), (None, "1d"),
                                (45000.75, "abc")], "n double, s string")
    rows = df.select(TP.normalize_id_numeric("n").alias("a"), TP.normalize_id_text("s").alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [(20230315.0, 45000.0), (20000.0, 12.0), (90000.0, 1000.0),
                                          (None, None), (20230315.0, None)]


def test_volume_fill_cap_and_fallback(spark):
    cap = 31.1
    exact = cap / C.FT3_TO_M3
    df = spark.createDataFrame([(None, exact, None, cap, 9.0), (None, 5000.0, 6000.0, cap, 9.0),
                                (None, 10.0, 20.0, None, 7.0), (1.5, 1.0, 1.0, cap, 9.0)],
                               "prev double, v1 double, v2 double, cap double, csp double")
    got = one(df.select(R.volume_fill("prev", "v1", "v2", "cap", "csp").alias("x")), "x")
    assert abs(got[0] - exact * C.FT3_TO_M3) < 1e-9 and got[0] <= cap or got[0] == 9.0
    assert got[1:] == [9.0, 7.0, 1.5]


def test_mbol_and_lane_blank_rules(spark):
    df = spark.createDataFrame([("", "CSP1", "", "Q3", None), (None, "CSP2", None, "", "C")],
                               "mbol string, csp string, y string, q3 string, c string")
    rows = df.select(R.mbol_fill("mbol", "csp").alias("m"), R.lane_fill("y", "q3", "c").alias("l")).collect()
    assert [(r.m, r.l) for r in rows] == [(None, "Q3"), ("CSP2", "C")]


def test_padded_cca_keeps_duns_but_routes_plant(spark):
    df = spark.createDataFrame([(" CCA ", "LCL", "United States of America", "D1", "IO", None, "PLANT")],
                               "cca string, sl string, country string, dun string, io string, loc string, "
                               "name string")
    dd = R.destination_duns("cca", "sl", "country", "dun")
    r = df.select(dd.alias("d"), R.plant_name("cca", "io", "loc", dd, "name").alias("p")).first()
    assert (r.d, r.p) == ("D1", "PLANT")
    r2 = df.withColumn("cca", F.lit("CCA")).select(
        R.plant_name("cca", "io", "loc", R.destination_duns("cca", "sl", "country", "dun"), "name").alias("p")).first()
    assert r2.p == C.CCA_DOCK_NAME


def test_status_all_512_null_patterns(spark):
    """The status is the label of the highest stage that has a date."""
    day = dt.datetime(2024, 1, 1)
    stages = [c for c, _ in ST.WATERFALL]  # highest first
    label = dict(ST.WATERFALL)
    pats = [tuple(day if b else None for b in bits) for bits in itertools.product([0, 1], repeat=len(stages))]
    df = spark.createDataFrame(pats, ", ".join(f"{c} timestamp_ntz" for c in stages))
    got = df.select(*stages, ST.shipment_status(*[F.col(c) for c in stages]).alias("s")).collect()
    assert len(got) == 512
    for r in got:
        assert r.s == next((label[c] for c in stages if r[c] is not None), None), r


def test_lookup_first_and_last(spark):
    dim = spark.createDataFrame([("k", "a", 1), ("k", None, 2), (None, "z", 0)], "key string, v string, ordinal int")
    base = spark.createDataFrame([("k",), (None,)], "key2 string")
    last = L.lookup_join(base, dim, "key2", "key", {"v": "v_last"}, keep="last")
    first = L.lookup_join(base, dim, "key2", "key", {"v": "v_first"}, keep="first")
    assert sorted(one(last, "v_last"), key=str) == [None, None]  # last row wins even when null
    assert sorted(one(first, "v_first"), key=str) == [None, "a"]


def test_upsert_idempotent_and_batch_order(spark):
    schema = "k string, v string, last_updated timestamp_ntz, seq bigint"
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    target = spark.createDataFrame([("a", "old", t1, 1), ("b", "keep", t1, 2)], schema)
    batch = spark.createDataFrame([("a", "new1", t2, 3), ("a", "new2", t2, 4), ("c", "ins", t2, 5)], schema)
    once = U.upsert(target, batch, ["k"])
    twice = U.upsert(once, batch, ["k"])
    want = {("a", "new2"), ("b", "keep"), ("c", "ins")}
    assert {(r.k, r.v) for r in once.collect()} == want
    assert {(r.k, r.v) for r in twice.collect()} == want
    m = U.upsert_metrics(target, batch, ["k"]).first()
    assert (m.inserted, m.updated, m.total_processed, m.failed) == (1, 2, 3, 0)


def test_column_helpers(spark):
    from quayside.operators.columns import reorder, select_existing, to_snake_case

    df = spark.createDataFrame([(1, 2)], "`Bill to Code` int, b int")
    assert select_existing(df, ["b", "zz", "Bill to Code"]).columns == ["b", "Bill to Code"]
    assert reorder(df, ["zz", "b"], fill_missing=True).columns == ["zz", "b"]
    assert to_snake_case(df).columns == ["bill_to_code", "b"]


def test_materialize_layers(spark, tmp_path):
    """Two loads: RAW keeps both, the layers above hold every event once."""
    from quayside.plans.warehouse import materialize_layers
    from quayside.plans import tracking as TR
    from quayside.sources.catalog import load_inputs

    t = load_inputs(spark, "/root/testdata/sf0.001")
    paths = materialize_layers(t, str(tmp_path), AS_OF, AS_OF)
    raw = spark.read.parquet(paths["raw/hlcu_tracking"])
    assert raw.columns[:3] == ["container_number", "concat_1", "concat_2"]
    n = raw.count()
    facts = spark.read.parquet(paths["analytics/fct_tracking_events"])
    columns = ["event_id", "type_of_tracking", "vessel_name", "last_updated", "ordinal"]
    want = TR.fct_tracking_events(t, AS_OF).select(*columns)
    assert facts.select(*columns).exceptAll(want).count() == 0 and facts.count() == want.count()
    materialize_layers(t, str(tmp_path), AS_OF + dt.timedelta(days=1), AS_OF)
    assert spark.read.parquet(paths["raw/hlcu_tracking"]).count() == 2 * n
    again = spark.read.parquet(paths["analytics/fct_tracking_events"])
    assert again.select(*columns).exceptAll(want).count() == 0 and again.count() == want.count()


def test_staging_reads_new_loads_only(spark, tmp_path):
    """The second run reads the second load's files, merges only the days it
    touches, and a third run without a load changes nothing."""
    from quayside.plans import warehouse as WH
    from quayside.sources.catalog import load_inputs

    t, root = load_inputs(spark, "/root/testdata/sf0.001"), str(tmp_path)
    exports = {n: df.cache() for n, df in WH.layer_exports(t, AS_OF).items()}
    events = exports["hlcu_tracking"]
    days = events.where("status is not null and date != ''").groupBy("date").count().orderBy(F.desc("count"), "date").limit(2).collect()
    first = {**exports, "hlcu_tracking": events.where(~F.col("date").isin([r.date for r in days]))}
    WH.load_raw(first, root, AS_OF)
    paths, counts = WH.run_layers(spark, root, t)
    assert counts["stg_hlcu_tracking"]["inserted"] == spark.read.parquet(paths["staging/stg_hlcu_tracking"]).count()
    files = {f for f in spark.read.parquet(paths["staging/stg_hlcu_tracking"]).inputFiles()}
    late = events.where(F.col("date").isin([r.date for r in days]))
    WH.load_raw({"hlcu_tracking": late}, root, AS_OF + dt.timedelta(days=1))
    rows, loads = WH.new_loads(spark, root, "hlcu_tracking")
    assert len(loads) == 1 and rows.count() == late.count()
    assert {f.split("load=")[1].split("/")[0] for f in (r[0] for r in rows.select(F.input_file_name()).distinct().collect())} == set(loads)
    paths, counts = WH.run_layers(spark, root, t)
    assert counts["stg_maeu_tracking"] is None and counts["stg_shipments"] is None
    n = counts["stg_hlcu_tracking"]
    assert n["inserted"] > 0 and n["matched"] == n["modified"] == 0
    after = {f for f in spark.read.parquet(paths["staging/stg_hlcu_tracking"]).inputFiles()}
    assert files <= after and {f.split("_part=")[1].split("/")[0] for f in after - files} == {r.date for r in days}
    want = spark.read.parquet(paths["staging/stg_hlcu_tracking"]).count()
    assert want == WH.TR.stage_hlcu(WH.E.with_hlcu_ts(events)).count()
    assert all(c is None for c in WH.run_layers(spark, root, t)[1].values())
    for df in exports.values():
        df.unpersist()


def test_a_load_after_a_crashed_merge_is_not_lost(spark, tmp_path, monkeypatch):
    """A run dies between the merge's two writes; the next one, with a further
    load, takes both.  Layers read RAW in place, so no staged batch stands in
    for the loads."""
    import pytest

    from quayside.plans import warehouse as WH

    root = str(tmp_path)
    stage = lambda raw: raw.select("k", "v", "_loaded_at", "seq")
    take = lambda: WH.stage_new(spark, root, "r", "staging/s", stage, ["k"], F.col("k") % 3, "seq")

    def load(rows, days):
        WH.load_raw({"r": spark.createDataFrame(rows, "k int, v string, seq int")}, root, AS_OF + dt.timedelta(days=days))

    def dies(*a, **kw):
        def crash():
            raise RuntimeError("crash")
        return U.merge_snapshot(*a, **kw, after_stage=crash)

    load([(1, "a", 1), (1, "b", 2), (2, "c", 1), (4, None, 1)], 0)
    with monkeypatch.context() as m:
        m.setattr(WH, "merge_snapshot", dies)
        with pytest.raises(RuntimeError):
            take()
    load([(2, "d", 0), (3, "e", 1)], 1)
    take()
    want = [(1, "b"), (2, "d"), (3, "e"), (4, None)]
    assert sorted((r.k, r.v) for r in spark.read.parquet(f"{root}/staging/s").collect()) == want
    load([(1, "b", 2), (2, "f", 0), (2, "g", 1), (5, "h", 1)], 2)
    assert take() == {"inserted": 1, "matched": 2, "modified": 1, "total_processed": 3, "failed": 0}


def test_a_snapshot_merge_shuffles_its_rows_once(spark, tmp_path, monkeypatch):
    """One exchange, by ranges of partition and key, serves the grouping and the
    write; the swap has none.  Hot keys are combined before it, to the same result."""
    monkeypatch.setattr(U, "HOT_KEY_ROWS", 100)
    monkeypatch.setattr(U, "HOT_KEY_SAMPLE", 0.5)
    rows = [(7 if i % 2 else i, i % 5, i) for i in range(2000)] + [(None, 0, 1)]
    batch = spark.createDataFrame([(k, k if k is None else k % 4, v, 1, s) for k, v, s in rows], "k int, p int, v int, last_updated int, seq int")
    assert U.hot_keys_combined(batch, U.key_sample(batch), ["k"]).where("k = 7").count() == 1
    plans = []

    def plan(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    observed, swap = U._observed_merge, U.swap_partitions
    monkeypatch.setattr(U, "hot_keys_combined", lambda rows, *a: rows)
    monkeypatch.setattr(U, "_observed_merge", lambda *a: plan(observed(*a)))
    monkeypatch.setattr(U, "swap_partitions", lambda df, *a: swap(plan(df), *a))
    counts = U.merge_snapshot(str(tmp_path / "t"), batch, ["k"], ["p"], str(tmp_path / "s"))
    assert [p.count("Exchange") for p in plans] == [1, 0] and "rangepartitioning(p" in plans[0]
    assert counts == {"inserted": 1000 + 1, "matched": 0, "modified": 0, "total_processed": 2001, "failed": 1}
    got = {r.k: (r.p, r.seq) for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert got == {k: (k % 4, 1999 if k == 7 else k) for k, _, _ in rows if k is not None}


def test_report_and_run_exports(spark, tmp_path):
    """The report sink writes parquet and CSV; a run's export is partitioned by
    carrier and run stamp, and a second run is added."""
    from quayside.plans import warehouse as WH

    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, name string")
    WH.write_report(df, str(tmp_path / "report"), csv_copy=True)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "report/parquet")).collect())) == [(1, "a,b"), (2, None)]
    back = spark.read.option("header", True).csv(str(tmp_path / "report/csv"))
    assert back.columns == ["id", "name"] and back.count() == 2
    for day in (1, 2):
        WH.write_export(df, str(tmp_path / "runs"), "HLCU", dt.datetime(2024, 1, day, 3))
    runs = spark.read.parquet(str(tmp_path / "runs"))
    assert runs.groupBy("carrier").count().collect()[0]["count"] == 4 and runs.select("scraped_at").distinct().count() == 2


def test_cluster_conf_scales_with_input():
    from quayside.session import cluster_conf

    small, big = cluster_conf(10 << 30), cluster_conf(100 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == 65536
    assert int(cluster_conf(1 << 40)["spark.sql.shuffle.partitions"]) == 4096
    assert big["spark.sql.adaptive.autoBroadcastJoinThreshold"] == str(64 << 20)


def test_plain_ids_are_no_serial_dates(spark):
    df = spark.createDataFrame([(45000,)], "n bigint")
    r = df.select(TP.id_key("n").alias("plain"), TP.id_key("n", spreadsheet=True).alias("cell")).first()
    assert (r.plain, r.cell) == (45000, 20230315)


def test_no_local_fallback_off_local_mode():
    from types import SimpleNamespace as N

    import pytest

    from quayside.session import checkpoint_root

    conf = N(get=lambda key, default=None: default)
    sc = N(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError):
        checkpoint_root(N(sparkContext=sc))


def test_a_merge_counts_its_batch_with_its_partitions(spark, tmp_path, monkeypatch):
    """The pass that finds the touched partitions counts the batch, also beyond
    the number of partitions that are named; content is hashed as it is."""
    schema = "k int, p int, at timestamp_ntz, a string, b string, x double, last_updated int, seq int"
    def rows(day, a, b, x=1.0):
        return [(k, k, dt.datetime(2024, 1, day), a, b, x, day, k) for k in range(3)] + [(None, None, None, a, b, x, day, 0)]

    for named in (20_000, 2):
        monkeypatch.setattr(U, "NAMED_PARTITIONS", named)
        path = str(tmp_path / f"t{named}")
        merge = lambda r: U.merge_snapshot(path, spark.createDataFrame(r, schema), ["k"], ["p"], f"{path}-s")
        assert merge(rows(1, "v", None)) == {"inserted": 3, "matched": 0, "modified": 0, "total_processed": 4, "failed": 1}
        assert merge(rows(1, "v", None))["modified"] == 0
        assert merge(rows(1, None, "v")) == {"inserted": 0, "matched": 3, "modified": 3, "total_processed": 4, "failed": 1}
        assert [merge(rows(1, None, "v", x))["modified"] for x in (float("nan"), float("nan"), None)] == [3, 0, 3]
    text = spark.createDataFrame([], schema).select(U._digest(spark.createDataFrame([], schema)))._jdf.queryExecution().analyzed().toString()
    assert text.count("cast(") == text.count("cast(x")


def test_ids_of_digits_need_no_pattern(spark):
    ids = ["7", "007", "12345678901234567890123", "", " 7", "7 ", "7.", "1_0", "1e2", "٣", "7\n", "\x007", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in ids], "v string").select(TP.normalize_id_text("v")).collect()]
    assert got == [7.0, 7.0, float("12345678901234567890123"), None, 7.0, 7.0, 7.0, 10.0, 100.0, None, 7.0, None, None]
    plan = spark.range(1).select(TP.normalize_id_text(F.lit("7")))._jdf.queryExecution().analyzed().toString()
    assert plan.index("trim") < plan.index("regexp_replace")


def test_ids_and_types_may_be_numbers_where_text_is_expected(spark):
    for kind, ids in (("bigint", [7, None]), ("double", [7.0, None])):
        rows = spark.createDataFrame([(x,) for x in ids], f"v {kind}")
        for rule in (TP.normalize_id_text, T.standardize_tracking_type):
            assert [r[0] for r in rows.select(rule("v").alias("x")).collect()] == [7.0, None]


def test_layers_generate_methods_that_are_compiled(spark, tmp_path):
    from quayside.plans import warehouse as WH

    limit = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "65535")
        WH.load_raw({"r": spark.createDataFrame([(1,)], "k int")}, str(tmp_path), AS_OF)
        assert int(spark.conf.get(limit)) == 8000
    finally:
        spark.conf.set(limit, old)
