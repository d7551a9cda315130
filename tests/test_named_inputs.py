"""Plans on hand-made inputs instead of the derived ones."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from quayside import config as C
from quayside.plans import report as RP
from quayside.plans import tracking as TR
from quayside.operators import tms as TM
from quayside.sources import inputs as SRC
from quayside.sources.catalog import load_inputs

from conftest import SMALL


def frames(spark, names):
    """Empty frames in the derived inputs' layouts."""
    t = load_inputs(spark, SMALL)
    return {n: spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in t.domain(n).schema])) for n in names}


def filled(frame, spark, *rows):
    """Rows given as dicts; columns left out are null."""
    return spark.createDataFrame([[r.get(c) for c in frame.columns] for r in rows], frame.schema)


def test_master_report_on_given_sheets(spark):
    f = frames(spark, SRC.SHEETS)
    f["intransit"] = filled(f["intransit"], spark, {"sti": 45000, "service_level": "lcl", "part_number": "P1"}, {"sti": 7})
    f["shipment_master"] = filled(f["shipment_master"], spark,
                                  {"sti": 45000, "ordinal": 1, "dest_dun": "D1", "hbl": "H1", "lane_id": "L1", "cont_type": None},
                                  {"sti": 45000, "ordinal": 2, "dest_dun": "D1", "hbl": "H2", "lane_id": "L2"})
    f["locations"] = filled(f["locations"], spark, {"location_alias": "D1", "name": "Plant", "country_name": C.USA, "ordinal": 1},
                            {"location_alias": C.CCA_DOCK_DUNS, "name": "Dock", "city": "Town", "ordinal": 2})
    f["cca_sheet"] = filled(f["cca_sheet"], spark, {"duns_number": "D1", "cca": C.CCA_MARK, "supplier_name": "S", "ordinal": 1})
    f["csp_sheet"] = filled(f["csp_sheet"], spark, {"hwb": "H2", "cubic_meters": 3.5, "ordinal": 1})
    f["milestone_export"] = filled(f["milestone_export"], spark,
                                   {"EM_SHIPMENT_ID": 45000, "Depart Consol Center": dt.datetime(2024, 1, 2), "ordinal": 1})
    rows = {r.lsc_tracking_number: r for r in RP.master_report(SRC.NamedInputs(spark, f)).collect()}
    r = rows[45000]
    assert (r.hbol, r.ocean_or_air_lane_id, r.cbm) == ("H2", "L1", 3.5)  # last wins, first wins, fill
    assert (r.destination_duns, r.final_delivery_location_name, r.plant_name) == (C.CCA_DOCK_DUNS, "Dock", C.CCA_DOCK_NAME)
    assert r.status_of_container == "4. Outgate CFS" and rows[7].dest_dun is None and len(rows) == 2


def test_tms_extract_on_given_tables(spark):
    f = frames(spark, SRC.TMS + ("intransit",))
    f["em_shipment"] = filled(f["em_shipment"], spark, {"em_shipment_id": 1, "current_state_type_id": C.ACTIVE_STATE},
                              {"em_shipment_id": 2, "current_state_type_id": C.ACTIVE_STATE + 1},
                              {"em_shipment_id": 3, "current_state_type_id": C.ACTIVE_STATE})
    f["intransit"] = filled(f["intransit"], spark, {"sti": 1}, {"sti": 2})
    f["shipment_refs"] = filled(f["shipment_refs"], spark, *[
        {"em_shipment_id": 1, "reference_type_id": C.REF_MODE, "reference_number": m} for m in ("A", "B", "A")])
    f["shipment_milestones"] = filled(f["shipment_milestones"], spark, {"em_shipment_id": 1, "master_unitload_id": 9})
    f["unitload_refs"] = filled(f["unitload_refs"], spark, {"master_unitload_id": 9, "reference_type_id": C.REF_HBL, "reference_number": "H"})
    t = SRC.NamedInputs(spark, f)
    out = TM.shipment_extract(*[getattr(SRC, n)(t) for n in (
        "em_shipment", "shipment_refs", "shipment_milestones", "unitload_refs", "container_assn", "container_attributes",
        "status_docs", "status_doc_refs", "orders_assn", "order_packages", "location_entities", "intransit")]).collect()
    assert sorted((r.sti, r.mode, r.hbl) for r in out) == [(1, "A", "H"), (1, "B", "H")]


def test_tms_extract_partitions_follow_the_shipments(spark, monkeypatch):
    initial, joined = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    f = frames(spark, SRC.TMS + ("intransit",))
    f["em_shipment"] = filled(f["em_shipment"], spark, *[{"em_shipment_id": k, "current_state_type_id": C.ACTIVE_STATE + (k > 38)} for k in range(60)])
    f["intransit"] = filled(f["intransit"], spark, *[{"sti": k} for k in range(60)])
    f["shipment_refs"] = filled(f["shipment_refs"], spark, *[
        {"em_shipment_id": k, "reference_type_id": C.REF_MODE, "reference_number": "A"} for k in range(60)])
    t = SRC.NamedInputs(spark, f)
    extract = lambda: TM.shipment_extract(*[getattr(SRC, n)(t) for n in (
        "em_shipment", "shipment_refs", "shipment_milestones", "unitload_refs", "container_assn", "container_attributes",
        "status_docs", "status_doc_refs", "orders_assn", "order_packages", "location_entities", "intransit")])
    had, size = spark.conf.get(initial, None), spark.conf.get(joined)
    try:
        spark.conf.unset(initial)
        few = extract().collect()
        assert spark.conf.get(initial, None) is None  # few shipments: the session's own number
        monkeypatch.setattr(TM, "TASK_SHIPMENTS", 1)
        df = extract()
        assert spark.conf.get(joined) == str(16 << 20)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_id" in plan and ", 39)" in plan and ", 8)" not in plan
        assert sorted(df.collect()) == sorted(few) and len(few) == 39
    finally:
        spark.conf.set(initial, had) if had else spark.conf.unset(initial)
        spark.conf.set(joined, size)


def test_events_of_a_carrier_come_from_the_common_table(spark):
    rows = [(1, C.HLCU, "B1", "Gate in", "P", "2024-01-01", "10:00", "", "", "20240101_000000", 1)]
    t = load_inputs(spark, SMALL)
    ev = spark.createDataFrame(rows, t.domain("tracking_events").schema)
    df = TR.hlcu_classified(SRC.NamedInputs(spark, {"tracking_events": ev}))
    assert df.first().type_of_tracking == C.CURRENT


def test_loading_from_files(spark, tmp_path):
    load_inputs(spark, SMALL).domain("watchlist").coalesce(1).write.option("header", True).csv(str(tmp_path / "watchlist.csv"))
    t = SRC.load_named(spark, str(tmp_path), ["watchlist"], "csv", {"watchlist": "ordinal bigint, container_number string"})
    assert SRC.watchlist(t).count() == load_inputs(spark, SMALL).customer.count()
    with pytest.raises(ValueError):
        SRC.load_named(spark, str(tmp_path), ["watchlist"], "csv")
    with pytest.raises(KeyError):
        SRC.intransit(t)
    with pytest.raises(ValueError):
        SRC.NamedInputs(spark, {"no_such_sheet": t.domain("watchlist")})
