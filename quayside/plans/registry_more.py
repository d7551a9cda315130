"""Further registered queries (report, TMS, ingest, streaming, quality)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from quayside import config as C
from quayside.functions import text as T
from quayside.functions import timeparse as TP
from quayside.operators import events as E
from quayside.operators import quality as Q
from quayside.operators import tms as TM
from quayside.operators import upsert as U
from quayside.plans import report as RP
from quayside.plans import tracking as TR
from quayside.plans import warehouse as WH
from quayside.plans.registry import query
from quayside.session import drop_scratch, scratch_path
from quayside.sources import pages as PG
from quayside.sources import payload as PL
from quayside.sources import inputs as SRC
from quayside.sources.catalog import load_inputs, read_csv_export, write_csv_export
from quayside.streaming import ingest as ING

K = RP.KEY


# ---------------------------------------------------------------- report
@query("base_fields")
def q_base_fields(spark, d):
    return RP.base_fields(load_inputs(spark, d)).drop("actual_arrival_final_dest")


@query("normalize_id")
def q_normalize_id(spark, d):
    m = SRC.mixed_ids(load_inputs(spark, d))
    return m.select("o_orderkey",
                    TP.normalize_id_numeric("id_number").alias("from_number"),
                    TP.normalize_id_text("id_text").alias("from_text"),
                    TP.normalize_id_timestamp("id_ts").alias("from_timestamp"))


@query("lookup_last")
def q_lookup_last(spark, d):
    t = load_inputs(spark, d)
    ship = RP.per_shipment(RP.master_sheet(t, first=False), RP.trailers_sheet(t))
    df = RP.attach(RP.base_fields(t), RP.looked_up(ship, t, RP.with_notes))
    cols = [K] + [v for v in RP.MASTER_LAST.values() if v != "q3_cca_location"] + [
        "steamship_line", "outbound_trailer", "outbound_tms"]
    return df.select(*cols)


@query("lookup_first")
def q_lookup_first(spark, d):
    t = load_inputs(spark, d)
    ship = RP.looked_up(RP.per_shipment(RP.master_sheet(t), RP.yesterday_sheet(t)), t, RP.with_csp)
    cols = ["hbol", "yesterday_cbm", "yesterday_weight_kg", "yesterday_lane_id", "q3_lane_id",
            "csp_cbm", "csp_weight_kg", "csp_lane_id", "csp_mbol"]
    return RP.attach(RP.base_fields(t), ship).select(K, *cols)


def _routed(t):
    """Base rows with supplier and destination."""
    ship = RP.looked_up(RP.per_shipment(RP.master_sheet(t, first=False)), t, RP.with_supplier_location, RP.with_dest)
    return RP.with_destination(RP.attach(RP.base_fields(t), ship), t)


@query("role_locations")
def q_role_locations(spark, d):
    df = _routed(load_inputs(spark, d))
    return df.select(K, "supplier_duns", "supplier_name", "origin_supplier_city", "origin_supplier_province",
                     "origin_supplier_country", "dest_dun", "dest_country", "destination_duns",
                     "final_delivery_location_name", "destination_city", "destination_state",
                     "destination_country")


@query("destination_duns")
def q_destination_duns(spark, d):
    t = load_inputs(spark, d)
    ship = RP.looked_up(RP.per_shipment(RP.master_sheet(t, first=False)), t, RP.with_dest)
    df = RP.with_destination(RP.attach(RP.base_fields(t), ship), t)
    return df.select(K, "cca", "service_level", "dest_country", "dest_dun", "destination_duns")


@query("plant_name")
def q_plant_name(spark, d):
    t = load_inputs(spark, d)
    ship = RP.looked_up(RP.per_shipment(RP.master_sheet(t, first=False)), t, RP.with_dest, RP.with_io)
    df = RP.with_plant(RP.with_destination(RP.attach(RP.base_fields(t), ship), t))
    return df.select(K, "cca", "bill_to_code", "destination_duns", "plant_name")


def _of_shipments(t, ship, *cols):
    return RP.attach(RP.base_fields(t).select(K), ship).select(K, *cols)


@query("container_ref")
def q_container_ref(spark, d):
    t = load_inputs(spark, d)
    ship = RP.with_container_caps(RP.per_shipment(RP.master_sheet(t, first=False)), spark)
    return _of_shipments(t, ship, "container_type", "max_cbm", "max_weight")


@query("origin_consol_name")
def q_origin_consol_name(spark, d):
    t = load_inputs(spark, d)
    ship = RP.with_origin_consol(RP.per_shipment(RP.master_sheet(t, first=False)), spark)
    return _of_shipments(t, ship, "origin_consol_duns", "origin_consol")


@query("milestone_merge")
def q_milestone_merge(spark, d):
    t = load_inputs(spark, d)
    return _of_shipments(t, RP.per_shipment(RP.milestones_sheet(t)), *[c for _, c in RP.MILESTONE_COLUMNS])


def _filled(t, spark, col):
    ship = RP.looked_up(RP.per_shipment(RP.master_sheet(t), RP.yesterday_sheet(t)), t, RP.with_csp)
    return _of_shipments(t, RP.with_fills(RP.with_container_caps(ship, spark)), col)


@query("cbm_fill")
def q_cbm_fill(spark, d):
    return _filled(load_inputs(spark, d), spark, "cbm")


@query("weight_fill")
def q_weight_fill(spark, d):
    return _filled(load_inputs(spark, d), spark, "weight_in_kg")


@query("lane_fill")
def q_lane_fill(spark, d):
    return _filled(load_inputs(spark, d), spark, "ocean_or_air_lane_id")


@query("mbol_fill")
def q_mbol_fill(spark, d):
    return _filled(load_inputs(spark, d), spark, "mbol")


@query("shipment_status")
def q_shipment_status(spark, d):
    t = load_inputs(spark, d)
    df = RP.with_status(RP.attach(RP.base_fields(t), RP.per_shipment(RP.milestones_sheet(t))))
    return df.select(K, "status_of_container")


@query("master_report")
def q_master_report(spark, d):
    return RP.master_report(load_inputs(spark, d))


@query("dim_suppliers")
def q_dim_suppliers(spark, d):
    return RP.dim_suppliers(load_inputs(spark, d)).select(
        F.col("location_alias"), "name", "city", "state", "country_name")


# ------------------------------------------------------------------- TMS

EAV_TYPES = {C.REF_MODE: "mode", C.REF_CCA_LOCATION: "cca_location", C.REF_PRN: "prn", C.REF_SO: "so"}


@query("eav_references")
def q_eav_references(spark, d):
    t = load_inputs(spark, d)
    es = SRC.em_shipment(t).select("em_shipment_id")
    attrs = TM.eav_attributes(SRC.shipment_refs(t), "em_shipment_id", EAV_TYPES)
    return es.join(attrs, "em_shipment_id", "left")


@query("mbl_priority")
def q_mbl_priority(spark, d):
    t = load_inputs(spark, d)
    return TM.priority_pick(SRC.unitload_refs(t), "master_unitload_id", dict(C.MBL_PRIORITY), "mbl")


@query("consol_dun")
def q_consol_dun(spark, d):
    t = load_inputs(spark, d)
    return TM.consol_locations(SRC.shipment_milestones(t), SRC.location_entities(t))


@query("sti_semi_join")
def q_sti_semi_join(spark, d):
    t = load_inputs(spark, d)
    return TM.restrict_to_ids(SRC.em_shipment(t), SRC.intransit(t), "em_shipment_id", "sti").select(
        "em_shipment_id", "shipment_id_number", "current_state_type_id")


@query("tms_extract")
def q_tms_extract(spark, d):
    t = load_inputs(spark, d)
    return TM.shipment_extract(
        SRC.em_shipment(t), SRC.shipment_refs(t), SRC.shipment_milestones(t), SRC.unitload_refs(t),
        SRC.container_assn(t), SRC.container_attributes(t), SRC.status_docs(t), SRC.status_doc_refs(t),
        SRC.orders_assn(t), SRC.order_packages(t), SRC.location_entities(t), SRC.intransit(t))


# ------------------------------------------------- ingest, upsert, files


# Load times of the two daily loads used by the upsert queries.
T1 = C.AS_OF - _dt.timedelta(days=1)
T2 = C.AS_OF
MAX_RECORDS_PER_PAYLOAD = 50000
RECORD_COLS = ["carrier", "_id", "ordinal", "container_number", "status", "place", "date", "time", "transport"]


def _ts(v):
    return TP.ntz_lit(v)


def upsert_inputs(t):
    """Target = events with ordinal % 3 != 0 loaded at T1; batch = ordinals
    with ordinal % 4 < 2 and those outside the target (both carriers) loaded
    at T2, so every event is in the target, the batch or both.  Ordinals with
    ordinal % 20 < 2 are sent twice (the second copy, with a later sequence,
    carries a changed transport), ordinals with ordinal % 20 = 4 twice alike."""
    ev = E.with_event_id(SRC.tracking_events(t)).select(*RECORD_COLS)
    o = F.col("ordinal")
    target = ev.filter(o % 3 != 0).withColumns({"last_updated": _ts(T1), "seq": o * 2})
    sent = (o % 4 < 2) | (o % 3 == 0)
    first = ev.filter(sent).withColumns({"last_updated": _ts(T2), "seq": o * 2})
    again = ev.filter(sent & ((o % 20 < 2) | (o % 20 == 4))).withColumns(
        {"transport": F.when(o % 20 < 2, F.concat(F.col("transport"), F.lit(" (resent)"))).otherwise(F.col("transport")),
         "last_updated": _ts(T2), "seq": o * 2 + 1})
    return target, first.unionByName(again)


KEYS = ["carrier", "_id"]


@query("event_upsert")
def q_event_upsert(spark, d):
    target, batch = upsert_inputs(load_inputs(spark, d))
    return U.upsert(target, batch, KEYS).drop("seq")


@query("upsert_metrics")
def q_upsert_metrics(spark, d):
    target, batch = upsert_inputs(load_inputs(spark, d))
    return U.upsert_metrics(target, batch, KEYS, group=["carrier"])


# Snapshot partitions: the carrier and the event's day, both functions of the
# key (its trimmed parts), never null or blank, so an event id never changes
# partition; text that is no date shares one partition.
PARTITIONS = ["_pcarrier", "_pday"]


def with_event_partition(df):
    text = T.trim_ws("date")
    day = F.coalesce(TP.parse_ntz(text, "yyyy-M-d"), TP.parse_ntz(text, "d MMM yyyy"))
    return df.withColumns({
        "_pcarrier": F.when(T.is_blank("carrier"), F.lit("none")).otherwise(T.trim_ws("carrier")),
        "_pday": F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit("undated"))})


@query("incremental_read")
def q_incremental_read(spark, d):
    """Snapshot = target, consumed once by a downstream reader (its stored
    high-water mark is the target's load time); merge the batch (rewriting
    touched partitions only); the reader then sees exactly what changed."""
    target, batch = upsert_inputs(load_inputs(spark, d))
    path, mark = scratch_path(spark, "events"), scratch_path(spark, "events-mark")
    first = with_event_partition(U.latest_per_key(target, KEYS))
    U.write_partitions(first, path, PARTITIONS, sort_by=["container_number"])
    reader = ING.HighWaterMark(spark, mark)
    reader.commit(reader.changes(U.read_snapshot(spark, path, first.schema)))
    U.merge_snapshot(path, with_event_partition(batch).select(*first.columns), KEYS, PARTITIONS,
                     scratch_path(spark, "events-staged"), sort_by=["container_number"])
    return reader.changes(U.read_snapshot(spark, path, first.schema)).drop("seq", *PARTITIONS)


@query("layer_run")
def q_layer_run(spark, d):
    """Two daily loads through the layers: a first export without a third of
    the events, then the whole export.  The second run stages the second load
    alone; the fact then holds every event once, as the second load has it."""
    t, root = load_inputs(spark, d), scratch_path(spark, "layers")
    exports = WH.layer_exports(t)
    first = {n: df.where(F.col("ordinal") % 3 != 0) if n.endswith("_tracking") else df for n, df in exports.items()}
    for load, loaded_at in ((first, T1), (exports, T2)):
        WH.load_raw(load, root, loaded_at)
        paths, _ = WH.run_layers(spark, root, t)
    return spark.read.schema(TR.fct_tracking_events(t).schema).parquet(paths["analytics/fct_tracking_events"])


@query("report_export")
def q_report_export(spark, d):
    """The master report as its sink stores it, read back."""
    path = scratch_path(spark, "report")
    report = RP.master_report(load_inputs(spark, d))
    WH.write_report(report, path)
    return spark.read.schema(report.schema).parquet(f"{path}/parquet")


@query("raw_append")
def q_raw_append(spark, d):
    """Daily CSV exports (header row) loaded into one append-only RAW table."""
    target, batch = upsert_inputs(load_inputs(spark, d))
    path = scratch_path(spark, "raw")
    for df, ts in ((target, T1), (batch, T2)):
        export = scratch_path(spark, "export-csv")
        rows = df.drop("last_updated")
        write_csv_export(rows, export)
        loaded = read_csv_export(spark, export, rows.schema).withColumn("_loaded_at", _ts(ts))
        loaded.write.mode("append").parquet(path)
        drop_scratch(spark, export)
    return spark.read.parquet(path)


@query("watchlist_scan")
def q_watchlist_scan(spark, d):
    w = SRC.watchlist(load_inputs(spark, d))
    h = w.filter(F.col("container_number").isNotNull()).select(F.lit(C.HLCU).alias("carrier"), "ordinal",
                                                                "container_number")
    m = w.select(F.lit(C.MAEU).alias("carrier"), "ordinal", "container_number")
    return h.unionByName(m)


def _export_events(t):
    """Events of both carriers in export columns."""
    h = E.with_concat_keys_hlcu(E.constant_tracking(SRC.tracking_events(t).filter(F.col("carrier") == C.HLCU)))
    m = E.with_concat_keys_maeu(E.constant_tracking(SRC.tracking_events(t).filter(F.col("carrier") == C.MAEU)))
    return h.withColumn("place_of_activity", F.col("place")).unionByName(
        m.withColumn("location", F.col("place")), allowMissingColumns=True)


@query("payload_build")
def q_payload_build(spark, d):
    path = scratch_path(spark, "payload-lines")
    PL.write_event_lines(_export_events(load_inputs(spark, d)), path)
    return PL.payload_manifest(spark, path)


@query("payload_explode")
def q_payload_explode(spark, d):
    path = scratch_path(spark, "payload-env")
    PL.write_envelopes(PL.build_envelopes(_export_events(load_inputs(spark, d)), MAX_RECORDS_PER_PAYLOAD), path)
    return _payload_columns(PL.load_payloads(spark, path, scratch_path(spark, "payload-rejects")))


def _payload_columns(out):
    return out.select(F.col("payload_carrier").alias("carrier"), "scraped_at", "ordinal",
                      *[F.col(f).alias(f.lower()) for f in ("Container_Number", "Concat_1", "Concat_2", "Concat_3",
                                                            "Status", "Date", "Time")])


@query("dq_payload")
def q_dq_payload(spark, d):
    """Payloads with planted defects: runs of days % 5 = 0 declare one record
    too many; carrier-M runs of days % 11 = 0 lack total_events; each
    carrier-H day % 7 = 0 adds one truncated envelope."""
    ev = _export_events(load_inputs(spark, d))
    env = PL.build_envelopes(ev, MAX_RECORDS_PER_PAYLOAD).join(
        ev.select("carrier", "scraped_at", "scrape_day").distinct(), ["carrier", "scraped_at"])
    total = F.when(F.col("scrape_day") % 5 == 0, F.col("total_events") + 1).otherwise(F.col("total_events"))
    env = env.withColumn("total_events", F.when(~((F.col("carrier") == C.MAEU) & (F.col("scrape_day") % 11 == 0)), total))
    path = scratch_path(spark, "payload-dq")
    PL.write_envelopes(env, path)
    bad = (ev.filter((F.col("carrier") == C.HLCU) & (F.col("scrape_day") % 7 == 0))
           .select("scraped_at").distinct()
           .select(F.concat(F.lit('{"carrier": "HLCU", "scraped_at": "'), F.col("scraped_at"),
                            F.lit('", "total_events": 3, "records": [{"Status": ')).alias("value")))
    bad.write.mode("append").text(path)
    return PL.payload_checks(PL.read_envelopes(spark, path))


@query("latest_file_per_carrier")
def q_latest_file_per_carrier(spark, d):
    """One file per run, named and dated by the run, and notes beside them;
    the pick is made from the folder's listing."""
    runs = SRC.tracking_events(load_inputs(spark, d)).groupBy("carrier", "scraped_at").agg(F.count(F.lit(1)).alias("total_events"))
    path = scratch_path(spark, "payload-files")
    names = F.array(PL.run_file_name(), F.concat(F.lit("notes_"), F.col("scraped_at"), F.lit(".txt")))
    PL.write_named_files(runs.select(F.explode(names).alias("name"), F.lit(0).alias("place"),
                                     F.to_json(F.struct("carrier", "scraped_at", "total_events")).alias("value")), path)
    return PL.latest_file_per_carrier(PL.list_files(spark, path)).select("carrier", "file_name")


@query("payload_round_trip")
def q_payload_round_trip(spark, d):
    """All runs written as one named file each, the latest of each carrier
    picked by the folder's listing and loaded again."""
    path = scratch_path(spark, "payload-runs")
    PL.write_run_files(PL.build_envelopes(_export_events(load_inputs(spark, d)), MAX_RECORDS_PER_PAYLOAD), path)
    out = PL.load_latest(spark, path, scratch_path(spark, "payload-rejects"), multi_line=False)
    return _payload_columns(out)


@query("extract_table_rows")
def q_extract_table_rows(spark, d):
    caps = PG.event_table_pages(SRC.hlcu_events(load_inputs(spark, d)))
    return PG.extract_table_rows(caps)


@query("extract_list_cards")
def q_extract_list_cards(spark, d):
    return PG.extract_list_items(load_inputs(spark, d).pages)


@query("stream_ingest")
def q_stream_ingest(spark, d):
    ev = _export_events(load_inputs(spark, d))
    src, ckpt = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-ckpt")
    PL.write_event_lines(ev, src)
    out = ING.ingest_available(spark, src, scratch_path(spark, "stream-out"), ckpt)
    drop_scratch(spark, src, ckpt)
    return out.select("carrier", "scraped_at", "ordinal", F.col("Container_Number").alias("container_number"),
                      F.col("Status").alias("status"), F.col("Date").alias("date"), F.col("Time").alias("time"))


@query("stream_upsert")
def q_stream_upsert(spark, d):
    """Target snapshot + the batch streamed in as files, every batch file
    delivered twice; must equal the one-shot upsert."""
    target, batch = upsert_inputs(load_inputs(spark, d))
    path, src, ckpt = (scratch_path(spark, n) for n in ("stream-events", "stream-batch", "stream-ckpt"))
    first = with_event_partition(U.latest_per_key(target, KEYS))
    U.write_partitions(first, path, PARTITIONS, sort_by=["container_number"])
    lines = batch.withColumn("last_updated", F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    for copy in ("a", "b"):
        lines.write.json(f"{src}/copy={copy}")
    schema = ("carrier string, _id string, ordinal bigint, container_number string, status string, "
              "place string, date string, time string, transport string, last_updated string, seq bigint, "
              "copy string")

    def prepare(df):
        rows = df.drop("copy").withColumn("last_updated", F.to_timestamp_ntz("last_updated"))
        return with_event_partition(rows).select(*first.columns)

    ING.upsert_available(spark, src, path, KEYS, PARTITIONS, prepare, ckpt, schema=schema, sort_by=["container_number"])
    drop_scratch(spark, src, ckpt, f"{ckpt}-staged", f"{ckpt}-ledger")
    return U.read_snapshot(spark, path, first.schema).drop("seq", *PARTITIONS)


# ---------------------------------------------------------------- quality
@query("dq_duplicate_events")
def q_dq_duplicate_events(spark, d):
    """Duplicate natural keys in the raw events: one grouped pass."""
    ev = SRC.tracking_events(load_inputs(spark, d)).filter(F.col("status").isNotNull())
    ts = F.when(F.col("carrier") == C.HLCU, TP.hlcu_event_ts("date", "time")).otherwise(TP.maeu_event_ts("date", "time"))
    return Q.duplicate_events(ev.withColumn("event_timestamp", ts))


@query("dq_tracking_types")
def q_dq_tracking_types(spark, d):
    return Q.tracking_type_check(TR.fct_tracking_events(load_inputs(spark, d)))


@query("dq_required_columns")
def q_dq_required_columns(spark, d):
    t = load_inputs(spark, d)
    return Q.required_columns({"hlcu_export": TR.hlcu_rows(t), "maeu_export": TR.maeu_rows(t),
                               "tracking_cards": SRC.tracking_cards(t)})
