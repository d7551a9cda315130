"""Domain inputs derived from the driver tables.

The freight pipeline consumes carrier event exports, tracking cards, TMS
tables and report input sheets.  The test harness ships TPC-H-like tables
instead, so each domain input is *derived* from them with plain projections
(modulo arithmetic only, no randomness), which keeps every query's work
proportional to the driver tables.  The same derivations are written as
DuckDB SQL in `quayside.plans.oracle`.

All derivations are narrow (row-local) except `locations`, which joins the
nation table (AQE broadcasts it after measuring its runtime size).

Row-order semantics ("first/last duplicate wins", "input order") use an
explicit `ordinal` column; Spark has no row order of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import config as C
from quayside.functions import timeparse as TP
from quayside.sources.catalog import Inputs

H, M = C.HLCU, C.MAEU

CONTAINER_TYPES = [c[0] for c in C.CONTAINER_REF]
UNKNOWN_CONTAINER_TYPE = "Flat Rack"
CONSOL_DUNS = [d for d, _ in C.ORIGIN_CONSOL]
SERVICE_LEVELS = ["LCL", "lcl", "FCL"]
PACKAGING = ["PALLET", "CARTON", "CRATE"]
UL_REF_TYPES = [100000, 100006, 100183, 100352]


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pick(values, idx: Column) -> Column:
    """values[idx] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _day(ts: Column, days) -> Column:
    return F.date_add(ts, days).cast("timestamp_ntz")


# ---------------------------------------------------------------- events
def tracking_events(t: Inputs) -> DataFrame:
    """Carrier event rows (both carriers) from `events`.

    container = 'CONT' + 7-digit user_id; carrier HLCU for even event_id,
    MAEU for odd; timestamps floored to 6-hour slots so that ties and
    repeated composite ids occur; date '' when event_id % 97 = 0; status
    null when event_id % 101 = 0.  Carrier-M statuses carry vessel text.
    """
    e = t.events
    eid = F.col("event_id")
    n = _s(eid % 40)
    is_h = (eid % 2) == 0
    et = F.col("event_type")
    h_status = (F.when(et == "view", "Arrival in").when(et == "click", "Departure from")
                .when(et == "signup", "Gate in").when(et == "error", "Discharge")
                .when(et == "purchase", "Gate out"))
    m_status = (F.when(et == "view", F.concat(F.lit("Load on VESSEL "), n))
                .when(et == "click", F.concat(F.lit("Vessel arrival (VESSEL "), n, F.lit(")")))
                .when(et == "signup", F.lit("Gate in")).when(et == "error", F.lit("Discharge"))
                .when(et == "purchase", F.concat(F.lit("Vessel departure (VESSEL "), n, F.lit(")"))))
    slot = (F.floor(F.hour("ts") / 6) * 6).cast("bigint")
    return e.select(
        eid.alias("ordinal"),
        F.when(is_h, F.lit(H)).otherwise(F.lit(M)).alias("carrier"),
        F.concat(F.lit("CONT"), F.lpad(_s("user_id"), 7, "0")).alias("container_number"),
        F.when(eid % 101 == 0, F.lit(None).cast("string"))
         .when(is_h, h_status).otherwise(m_status).alias("status"),
        F.concat(F.lit("PORT_"), _s(eid % 25)).alias("place"),
        F.when(eid % 97 == 0, F.lit(""))
         .when(is_h, F.date_format("ts", "yyyy-MM-dd"))
         .otherwise(F.date_format("ts", "dd MMM yyyy")).alias("date"),
        F.concat(F.lpad(_s(slot), 2, "0"), F.lit(":00")).alias("time"),
        F.when(is_h, F.concat(F.lit("VESSEL "), n)).otherwise(F.lit("")).alias("transport"),
        F.lit("").alias("vessel_name"),
        F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("_235900")).alias("scraped_at"),
        F.dayofmonth("ts").cast("bigint").alias("scrape_day"),
    )


def _last_updated() -> Column:
    return TP.parse_ntz(F.col("scraped_at"), "yyyyMMdd_HHmmss").alias("last_updated")


def hlcu_events(t: Inputs) -> DataFrame:
    return (tracking_events(t).filter(F.col("carrier") == H)
            .select("ordinal", "container_number", "status",
                    F.col("place").alias("place_of_activity"), "date", "time", "transport", _last_updated()))


def maeu_events(t: Inputs) -> DataFrame:
    return (tracking_events(t).filter(F.col("carrier") == M)
            .select("ordinal", "container_number", "status", F.col("place").alias("location"),
                    "date", "time", "vessel_name", "transport", _last_updated()))


def tracking_cards(t: Inputs) -> DataFrame:
    """Multi-line tracking cards (carrier M page items) from odd `events`.

    Lines: place, terminal (absent when id % 3 = 0), status phrase (lower-case
    when id % 11 = 0), date-time (absent when id % 97 = 0); a leading blank
    line when id % 5 = 0; the lines are rotated by id % 4.  Cards with
    id % 53 = 0 carry a "No results" page text instead.
    """
    e = t.events.filter((F.col("event_id") % 2) == 1)
    eid = F.col("event_id")
    n = _s(eid % 40)
    et = F.col("event_type")
    phrase = (F.when(et == "view", F.concat(F.lit("Load on VESSEL "), n))
              .when(et == "click", F.concat(F.lit("Vessel arrival (VESSEL "), n, F.lit(")")))
              .when(et == "signup", F.concat(F.lit("Vessel departure (VESSEL "), n, F.lit(")")))
              .when(et == "error", F.lit("Discharge")).otherwise(F.lit("Gate out")))
    phrase = F.when(eid % 11 == 0, F.lower(phrase)).otherwise(phrase)
    lines = F.filter(F.array(
        F.when(eid % 5 == 0, F.lit("")),
        F.concat(F.lit("Port "), _s(eid % 25)),
        F.when(eid % 3 != 0, F.concat(F.lit("Terminal "), _s(eid % 7))),
        phrase,
        F.when(eid % 97 != 0, F.date_format("ts", "dd MMM yyyy HH:mm")),
    ), lambda x: x.isNotNull())
    e = e.withColumn("_lines", lines)
    size = F.size("_lines")
    r = ((eid % 4) % size).cast("int")
    rotated = F.concat(F.slice("_lines", r + 1, size - r), F.slice("_lines", F.lit(1), r))
    container = F.concat(F.lit("CONT"), F.lpad(_s("user_id"), 7, "0"))
    text = (F.when(eid % 53 == 0, F.concat(F.lit("No results found for "), container))
            .otherwise(F.array_join(rotated, "\n")))
    return e.select(eid.alias("card_id"), container.alias("container_number"), text.alias("text"))


# ------------------------------------------------------------ TMS tables
def em_shipment(t: Inputs) -> DataFrame:
    o = F.col("o_orderkey")
    vol = (F.col("o_custkey") % 4000).cast("double")
    return t.orders.select(
        o.alias("em_shipment_id"),
        F.concat(F.lit("SID"), _s(o)).alias("shipment_id_number"),
        (o % 20 + 1).cast("bigint").alias("shipment_pieces"),
        _s(o % 200).alias("ultimate_origin_alias"),
        _s("o_custkey").alias("ultimate_dest_alias"),
        F.when(o % 7 == 0, F.lit(None).cast("double")).otherwise(vol).alias("shipment_cube"),
        F.when(o % 7 == 0, F.lit(None).cast("double")).otherwise(vol * 10).alias("shipment_weight"),
        F.when(F.col("o_orderstatus").isin("O", "P"), F.lit(100000)).otherwise(F.lit(100002))
         .cast("bigint").alias("current_state_type_id"),
    )


def shipment_refs(t: Inputs) -> DataFrame:
    """Tall (shipment, reference type, value) rows; mode doubled when % 50 = 0."""
    o = F.col("o_orderkey")
    base = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")

    def part(cond, type_id, value):
        df = base if cond is None else base.filter(cond)
        return df.select(o.alias("em_shipment_id"), F.lit(type_id).cast("bigint").alias("reference_type_id"),
                         value.alias("reference_number"))

    return (part(None, C.REF_MODE, F.col("o_orderpriority"))
            .unionByName(part(o % 50 == 0, C.REF_MODE, F.concat("o_orderpriority", F.lit("/ALT"))))
            .unionByName(part(o % 5 == 0, C.REF_CCA_LOCATION, F.concat(F.lit("LOC_"), _s(F.col("o_custkey") % 50))))
            .unionByName(part(o % 3 != 0, C.REF_PRN, F.concat(F.lit("PRN"), _s(o))))
            .unionByName(part(o % 2 == 0, C.REF_SO, F.concat(F.lit("SO"), _s("o_custkey")))))


def unitload_refs(t: Inputs) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("master_unitload_id"),
        _pick(UL_REF_TYPES, F.col("l_linenumber") % 4).cast("bigint").alias("reference_type_id"),
        _s("l_partkey").alias("reference_number"),
    )


def shipment_milestones(t: Inputs) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("em_shipment_id"),
        F.col("l_orderkey").alias("master_unitload_id"),
        F.col("l_suppkey").alias("location_entity_id"),
        F.when(F.col("l_linenumber") == 1, F.lit(C.CONSOL_MILESTONE_TYPE)).otherwise(F.lit(100002))
         .cast("bigint").alias("operational_milestone_type_id"),
    )


def container_assn(t: Inputs) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("master_unitload_id"),
                           F.col("o_custkey").alias("container_attributes_id"))


def container_attributes(t: Inputs) -> DataFrame:
    p = F.col("p_partkey")
    return t.part.select(
        p.alias("container_attributes_id"),
        F.concat(F.lit("CONT"), F.lpad(_s(p % 150), 7, "0")).alias("conveyance_id_number"),
        F.when(p % 13 < 11, _pick(CONTAINER_TYPES, p % 13)).otherwise(F.lit(UNKNOWN_CONTAINER_TYPE))
         .alias("conveyance_type_desc"),
        (F.col("p_size") * 100).cast("double").alias("conveyance_cube"),
        (F.col("p_size") * 250).cast("double").alias("conveyance_weight"),
    )


def status_docs(t: Inputs) -> DataFrame:
    o = F.col("o_orderkey")
    return t.orders.filter(o % 3 != 0).select(o.alias("status_doc_id"), o.alias("master_unitload_id"))


def status_doc_refs(t: Inputs) -> DataFrame:
    o = F.col("o_orderkey")
    base = t.orders.filter(o % 3 != 0)
    lane = base.select(o.alias("status_doc_id"), F.lit(C.REF_LANE).cast("bigint").alias("reference_type_id"),
                       F.concat(F.lit("LANE"), _s(o % 30)).alias("reference_number"))
    other = base.select(o.alias("status_doc_id"), F.lit(100795).cast("bigint").alias("reference_type_id"),
                        F.lit("OTHER").alias("reference_number"))
    return lane.unionByName(other)


def orders_assn(t: Inputs) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("em_shipment_id"), F.col("o_orderkey").alias("order_id"))


def order_packages(t: Inputs) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("order_id"),
                             F.concat(F.lit("PKG"), _s(F.col("l_linenumber") % 3)).alias("package_id_number"))


def location_entities(t: Inputs) -> DataFrame:
    s = F.col("s_suppkey")
    return t.supplier.select(
        s.alias("entity_id"),
        F.when(s % 6 < 4, _pick(CONSOL_DUNS, s % 6)).otherwise(_s(s)).alias("location_alias"),
    )


# ------------------------------------------------------- report inputs
def intransit(t: Inputs) -> DataFrame:
    """Base report rows: one per lineitem (several per shipment)."""
    k = F.col("l_orderkey")
    supplier_present = ((k % 10) > 0) & ((k % 7) != 0)
    delivered_present = ((k % 10) == 9) & (((k + 8) % 7) != 0)
    return t.lineitem.select(
        k.alias("sti"),
        F.concat(F.lit("SID"), _s(k)).alias("shipment_id_number"),
        F.concat(F.lit("P"), _s("l_partkey")).alias("part_number"),
        F.col("l_quantity").cast("double").alias("quantity"),
        _pick(SERVICE_LEVELS, k % 3).alias("service_level"),
        F.when(supplier_present, F.col("l_shipdate").cast("timestamp_ntz")).alias("shipment_datetime"),
        F.when(delivered_present, _day(F.col("l_shipdate"), 24)).alias("actual_arrival_final_dest"),
    )


def shipment_master(t: Inputs) -> DataFrame:
    """Shipment master sheet ("Query 3"): one row per order plus a revised
    second row (later ordinal) for orders with key % 13 = 0."""
    o = F.col("o_orderkey")
    ck = F.col("o_custkey")
    vol1 = (ck % 4000).cast("double")
    vol2 = ((ck * 3) % 4000).cast("double")
    cols = {
        "sti": o,
        "ordinal": o * 2,
        "origin_dun": _s(o % 200),
        "so": F.concat(F.lit("SO"), _s(ck)),
        "number_of_packages": (o % 20 + 1).cast("double"),
        "packaging_type": _pick(PACKAGING, o % 3),
        "prn": F.concat(F.lit("PRN"), _s(o)),
        "hbl": F.concat(F.lit("H"), _s(o % 500)),
        "mbl": F.when(o % 4 == 0, F.lit(None).cast("string")).when(o % 8 == 1, F.lit(""))
                .otherwise(F.concat(F.lit("M"), _s(o))),
        "cont_id": F.concat(F.lit("CONT"), F.lpad(_s(ck % 150), 7, "0")),
        "cont_type": F.when(o % 13 < 11, _pick(CONTAINER_TYPES, o % 13)).otherwise(F.lit(UNKNOWN_CONTAINER_TYPE)),
        "btc": F.concat(F.lit("BTC"), _s(ck % 30)),
        "vol1": F.when(o % 7 == 0, F.lit(None).cast("double")).otherwise(vol1),
        "weight1": F.when(o % 7 == 0, F.lit(None).cast("double")).otherwise(vol1 * 10),
        "vol2": F.when(o % 11 == 0, F.lit(None).cast("double")).otherwise(vol2),
        "weight2": F.when(o % 11 == 0, F.lit(None).cast("double")).otherwise(vol2 * 10),
        "consol_dun": F.when(o % 6 < 4, _pick(CONSOL_DUNS, o % 6)).otherwise(F.lit("000000000")),
        "dest_dun": _s(ck),
        "manifest": F.concat(F.lit("MAN"), _s(o % 1000)),
        "master_unitload_id": _s(o),
        "scac_code": F.concat(F.lit("SC"), _s(ck % 25)),
        "vessel_name": F.concat(F.lit("VESSEL "), _s(o % 40)),
        "path": F.when(o % 2 == 0, F.lit("DIRECT")).otherwise(F.lit("TRANSSHIP")),
        "cca_location": F.when(o % 5 == 0, F.concat(F.lit("LOC_"), _s(ck % 50)))
                         .when(o % 5 == 1, F.lit("")).otherwise(F.lit(None).cast("string")),
        "lane_id": F.when(o % 9 == 0, F.lit("")).when(o % 4 == 0, F.lit(None).cast("string"))
                    .otherwise(F.concat(F.lit("LANE"), _s(o % 30))),
    }
    first = t.orders.select(*[v.alias(k) for k, v in cols.items()])
    revised = dict(cols)
    revised.update({
        "ordinal": o * 2 + 1,
        "origin_dun": _s((o + 1) % 200),
        "so": F.lit(None).cast("string"),
        "hbl": F.concat(F.lit("H"), _s((o + 7) % 500)),
        "vessel_name": F.lit("VESSEL X"),
        "lane_id": F.lit("LANE-DUP"),
    })
    second = t.orders.filter(o % 13 == 0).select(*[v.alias(k) for k, v in revised.items()])
    return first.unionByName(second)


def locations(t: Inputs) -> DataFrame:
    """Location sheet from customer x nation; a second, later row for
    customers with key % 100 = 0 (last one wins)."""
    nation = t.nation.select("n_nationkey", "n_name")  # AQE broadcasts it after measuring its size
    c = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    k = F.col("c_custkey")
    country = F.when(F.col("c_nationkey") % 3 == 0, F.lit("United States of America")).otherwise(F.col("n_name"))
    first = c.select(_s(k).alias("location_alias"), F.col("c_name").alias("name"),
                     F.concat(F.lit("CITY_"), _s("c_nationkey")).alias("city"),
                     F.col("c_mktsegment").alias("state"), country.alias("country_name"),
                     (k * 2).alias("ordinal"))
    second = c.filter(k % 100 == 0).select(
        _s(k).alias("location_alias"), F.concat("c_name", F.lit(" II")).alias("name"),
        F.concat(F.lit("CITY_"), _s("c_nationkey")).alias("city"),
        F.col("c_mktsegment").alias("state"), country.alias("country_name"), (k * 2 + 1).alias("ordinal"))
    return first.unionByName(second)


def cca_sheet(t: Inputs) -> DataFrame:
    k = F.col("c_custkey")
    m = k % 16
    cca = (F.when(m == 0, F.lit("CCA")).when(m == 4, F.lit(" CCA ")).when(m == 8, F.lit(""))
           .otherwise(F.lit("OTHER")))
    return t.customer.filter(k % 4 == 0).select(
        _s(k).alias("duns_number"), cca.alias("cca"),
        F.concat(F.lit("PLANT "), F.col("c_name")).alias("supplier_name"), k.alias("ordinal"))


def io_sheet(t: Inputs) -> DataFrame:
    s = F.col("s_suppkey")
    return t.supplier.select(F.concat(F.lit("BTC"), _s(s % 30)).alias("code"),
                             F.col("s_name").alias("supplier_name"), s.alias("ordinal"))


def carrier_notes(t: Inputs) -> DataFrame:
    n = F.col("n_nationkey")
    return t.nation.select(F.concat(F.lit("SC"), _s(n)).alias("carrier_scac"),
                           F.col("n_name").alias("name"), n.cast("bigint").alias("ordinal"))


def trailers(t: Inputs) -> DataFrame:
    o = F.col("o_orderkey")
    return t.orders.filter(o % 4 == 1).select(
        o.alias("lsc_tracking_number"), F.concat(F.lit("TRL"), _s(o % 300)).alias("outbound_trailer"),
        F.concat(F.lit("TMS"), _s(o)).alias("outbound_tms"), o.alias("ordinal"))


def yesterday(t: Inputs) -> DataFrame:
    """Previous report: orders % 3 = 0, plus a later second row when % 9 = 0."""
    o = F.col("o_orderkey")
    base = t.orders.filter(o % 3 == 0)
    first = base.select(
        o.alias("lsc_tracking_number"),
        F.when(o % 6 == 0, F.lit(None).cast("double")).otherwise((o % 60).cast("double") + 0.5).alias("cbm"),
        F.when(o % 15 == 0, F.lit(None).cast("double"))
         .otherwise((F.col("o_custkey") % 900).cast("double") * 10).alias("weight_kg"),
        F.when(o % 12 == 0, F.lit("")).otherwise(F.concat(F.lit("YLANE"), _s(o % 17))).alias("lane_id"),
        (o * 2).alias("ordinal"))
    second = base.filter(o % 9 == 0).select(
        o.alias("lsc_tracking_number"), ((o % 60).cast("double") + 1.5).alias("cbm"),
        F.lit(1.0).alias("weight_kg"), F.lit("YLANE-B").alias("lane_id"), (o * 2 + 1).alias("ordinal"))
    return first.unionByName(second)


def csp_sheet(t: Inputs) -> DataFrame:
    o = F.col("o_orderkey")
    return t.orders.filter(o % 2 == 0).select(
        F.concat(F.lit("H"), _s(o % 500)).alias("hwb"),
        ((o % 50).cast("double") + 0.25).alias("cubic_meters"),
        ((o % 700).cast("double") * 2).alias("actual_wt_kgs"),
        F.when(o % 46 == 0, F.lit("")).otherwise(F.concat(F.lit("CLANE"), _s(o % 23))).alias("lane_id"),
        F.concat(F.lit("CM"), _s(o)).alias("last_mb_number"),
        o.alias("ordinal"))


def milestone_dates(key: Column, base: Column) -> list[Column]:
    """Nine stage dates (supplier ... delivered): base + 3k days, present iff
    k < key % 10 and (key + k) % 7 != 0."""
    out = []
    for k in range(9):
        present = (F.lit(k) < key % 10) & (((key + k) % 7) != 0)
        out.append(F.when(present, _day(base, 3 * k)))
    return out


def milestone_export(t: Inputs) -> DataFrame:
    """Milestone sheet ("Query 4"), source column names; orders % 5 != 0;
    a second, later row (dates + 1 day) for % 25 = 1 (first one wins)."""
    o = F.col("o_orderkey")
    od = F.col("o_orderdate")
    base = t.orders.filter(o % 5 != 0)

    def build(shift: int, ordinal: Column):
        d = milestone_dates(o, od)
        sh = (lambda c: F.date_add(c, shift).cast("timestamp_ntz")) if shift else (lambda c: c)
        exp = lambda n: _day(od, n + shift)
        cols = [
            (F.col("o_orderkey"), "EM_SHIPMENT_ID"),
            (sh(F.date_add(d[1], -1).cast("timestamp_ntz")), " Arrived at Consol"),
            (sh(d[1]), "Depart Consol Center"),
            (sh(d[2]), "Actual Arrived at Port of Departure"),
            (exp(10), "Expected Arrived at Transshipment Port"),
            (sh(_day(d[3], 1)), "Actual Arrived at Transshipment Port"),
            (exp(11), "Expected Departed Transshipment Port"),
            (sh(_day(d[3], 2)), "Actual Departed Transshipment Port"),
            (exp(9), "Expected Depart Origin Port"),
            (sh(d[3]), "Actual Depart Origin Port"),
            (exp(12), "Expected Arrived at Port of Entry"),
            (sh(d[4]), "Actual Arrived at Port of Entry"),
            (exp(15), "Expected Outgate"),
            (sh(d[5]), "Actual Outgate"),
            (exp(18), "expected Arrived Destination Rail Ramp"),
            (sh(d[6]), "Actual Arrived Destination Rail Ramp"),
            (exp(21), "Expected Departed Destination Rail Ramp"),
            (sh(d[7]), "Actual Departed Destination Rail Ramp"),
            (F.concat(F.lit("POL"), _s(o % 9)), "POL"),
            (F.concat(F.lit("TS"), _s(o % 5)), "Transshipment Port"),
            (F.concat(F.lit("POD"), _s(o % 11)), "POD"),
            (ordinal, "ordinal"),
        ]
        return [c.alias(n) for c, n in cols]

    first = base.select(*build(0, o * 2))
    second = base.filter(o % 25 == 1).select(*build(1, o * 2 + 1))
    return first.unionByName(second)


def staged_shipments_raw(t: Inputs) -> DataFrame:
    """RAW shipments export (warehouse design): one row per order with the
    nine stage dates, plus a later reload (``_loaded_at`` + 1 day, new vessel)
    for orders with key % 13 = 0."""
    o = F.col("o_orderkey")
    od = F.col("o_orderdate")
    d = milestone_dates(o, od)
    cols = {
        "sti_number": _s(o),
        "shipment_id_number": F.concat(F.lit("SID"), _s(o)),
        "container_number": F.concat(F.lit("CONT"), F.lpad(_s(F.col("o_custkey") % 150), 7, "0")),
        "hbl": F.concat(F.lit("H"), _s(o % 500)),
        "mbl": F.when(o % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("M"), _s(o))),
        "scac_code": F.concat(F.lit("SC"), _s(F.col("o_custkey") % 25)),
        "vessel_name": F.concat(F.lit("VESSEL "), _s(o % 40)),
        "pol": F.concat(F.lit("POL"), _s(o % 9)),
        "pod": F.concat(F.lit("POD"), _s(o % 11)),
        "origin_dun": _s(o % 200),
        "dest_dun": _s("o_custkey"),
        "lane_id": F.concat(F.lit("LANE"), _s(o % 30)),
        "ship_date_from_supplier": d[0],
        "actual_departure_consol": d[1],
        "actual_arrival_pol": d[2],
        "actual_departure_pol": d[3],
        "actual_arrival_pod": d[4],
        "actual_outgate_pod": d[5],
        "actual_arrival_dest_rail": d[6],
        "actual_departure_dest_rail": d[7],
        "actual_arrival_final_dest": d[8],
        "eta": _day(od, 12),
        "cbm": F.when(o % 7 == 0, F.lit(None).cast("double")).otherwise((o % 60).cast("double") + 0.5),
        "weight_kg": F.when(o % 11 == 0, F.lit(None).cast("double")).otherwise((F.col("o_custkey") % 900).cast("double") * 10),
        "_loaded_at": od.cast("timestamp_ntz"),
    }
    first = t.orders.select(*[v.alias(k) for k, v in cols.items()])
    rev = dict(cols)
    rev.update({"vessel_name": F.lit("VESSEL RELOAD"), "_loaded_at": _day(od, 1)})
    second = t.orders.filter(o % 13 == 0).select(*[v.alias(k) for k, v in rev.items()])
    return first.unionByName(second)


def mixed_ids(t: Inputs) -> DataFrame:
    """Shipment ids as they arrive in spreadsheets: numbers (incl. serial
    dates and the exact bounds), free text, and timestamps."""
    o = F.col("o_orderkey")
    m10 = o % 10
    num = (F.when(m10 == 0, F.lit(20000.0)).when(m10 == 1, F.lit(90000.0))
           .when(m10 == 2, (F.lit(45000) + o % 1000).cast("double"))
           .when(m10 == 3, F.lit(None).cast("double")).when(m10 == 4, F.lit(45000.75))
           .otherwise(o.cast("double")))
    m8 = o % 8
    txt = (F.when(m8 == 0, F.lit("45000")).when(m8 == 1, F.lit(" 12 ")).when(m8 == 2, F.lit("abc"))
           .when(m8 == 3, F.lit(None).cast("string")).when(m8 == 4, F.lit("1_000"))
           .when(m8 == 5, F.lit("1e3")).when(m8 == 6, F.lit("1d")).otherwise(_s(o)))
    return t.orders.select(o.alias("o_orderkey"), num.alias("id_number"), txt.alias("id_text"),
                           F.col("o_orderdate").cast("timestamp_ntz").alias("id_ts"))


def watchlist(t: Inputs) -> DataFrame:
    """Container watch list from `customer`: one row per customer (so ids
    repeat nothing but can miss), container null when key % 37 = 0."""
    k = F.col("c_custkey")
    return t.customer.select(
        k.alias("ordinal"),
        F.when(k % 37 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("CONT"), F.lpad(_s(k), 7, "0"))).alias("container_number"))
