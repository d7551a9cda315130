"""Master shipment report: base rows enriched by lookups, routing, fills and
status.

Join layout: the sheets keyed by the shipment id (master sheet, trailers,
milestones, previous report) are grouped by it in one pass.  The lookups by a
shipment's own attributes (locations, CCA, notes, bill-to, CSP) run over narrow
rows of its id and lookup keys, whose results come back to the wide rows by the
id.  The base rows, several per shipment, join the result once.  So the wide
rows are shuffled once, by their grouping.  Only routing needs a column of the base row:
both outcomes are carried and chosen after that join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import config as C
from quayside.functions import status as ST
from quayside.functions import timeparse as TP
from quayside.operators import lookups as L
from quayside.operators import report as R
from quayside.session import stored
from quayside.sources import inputs as SRC

KEY = "lsc_tracking_number"

MASTER_LAST = {
    "origin_dun": "supplier_duns", "so": "so_number", "manifest": "manifest",
    "master_unitload_id": "mti", "scac_code": "steamship_line_scac", "vessel_name": "vessel_name",
    "path": "path", "number_of_packages": "number_of_packages", "packaging_type": "packaging_type",
    "prn": "prn_number", "hbl": "hbol", "mbl": "mbol", "cont_id": "container_number",
    "cont_type": "container_type", "btc": "bill_to_code", "vol1": "vol1", "weight1": "weight1",
    "vol2": "vol2", "weight2": "weight2", "consol_dun": "origin_consol_duns", "dest_dun": "dest_dun",
    "cca_location": "q3_cca_location",
}
# The master's columns by which other sheets are looked up.
LOOKUP_KEYS = {c: MASTER_LAST[c] for c in ("origin_dun", "dest_dun", "scac_code", "btc", "hbl")}
MASTER_FIRST = {"lane_id": "q3_lane_id"}

MILESTONE_COLUMNS = [(src, C.snake(dst)) for src, dst in C.MILESTONE_RENAMES]

STATUS_INPUTS = [
    "actual_arrival_final_dest",
    "actual_departure_from_dest_rail",
    "actual_arrival_date_to_destination_rail_yard",
    "actual_outgate_date_from_destination_port",
    "actual_date_of_arrival_to_destination_port",
    "actual_date_of_departure_from_origin_port",
    "actual_date_of_arrival_to_the_origin_port",
    "departed_consol_actual_date_time",
    "ship_date_from_supplier",
]


def container_ref(spark: SparkSession) -> DataFrame:
    return L.reference_table(spark, C.CONTAINER_REF,
                             "container_type string, max_cbm double, max_weight double")


def consol_ref(spark: SparkSession) -> DataFrame:
    return L.reference_table(spark, C.ORIGIN_CONSOL, "origin_consol_duns string, origin_consol string")


# ------------------------------------------------------------------ steps
def base_fields(t) -> DataFrame:
    it = SRC.intransit(t)
    lit = C.BASE_LITERALS
    return it.select(
        TP.id_key("sti").alias(KEY),
        F.lit(lit["lsc"]).alias("lsc"),
        F.lit(lit["specialized_transport"]).alias("specialized_transport"),
        F.col("shipment_id_number").alias("sid_number"),
        "part_number", "quantity", "service_level",
        F.col("shipment_datetime").alias("ship_date_from_supplier"),
        F.lit(lit["mode"]).alias("mode"),
        F.lit(lit["provider_lane_id"]).alias("provider_lane_id"),
        "actual_arrival_final_dest",
    )


def master_sheet(t, last=True, first=True) -> L.Sheet:
    """The shipment master, by shipment id."""
    m = SRC.shipment_master(t).withColumn("_k", TP.id_key("sti"))
    return L.Sheet(m, "_k", MASTER_LAST if last else None, MASTER_FIRST if first else None, tie=tuple(LOOKUP_KEYS))


def trailers_sheet(t) -> L.Sheet:
    tr = SRC.trailers(t).withColumn("_k", TP.id_key("lsc_tracking_number"))
    return L.Sheet(tr, "_k", last={c: c for c in ("outbound_trailer", "outbound_tms")})


def milestones_sheet(t) -> L.Sheet:
    q4 = SRC.milestone_export(t).withColumn("_k", TP.id_key("EM_SHIPMENT_ID"))
    return L.Sheet(q4, "_k", first=dict(MILESTONE_COLUMNS))


def yesterday_sheet(t) -> L.Sheet:
    y = SRC.yesterday(t).withColumn("_k", TP.id_key("lsc_tracking_number"))
    return L.Sheet(y, "_k", first={"cbm": "yesterday_cbm", "weight_kg": "yesterday_weight_kg", "lane_id": "yesterday_lane_id"})


def per_shipment(*sheets: L.Sheet) -> DataFrame:
    """Sheets keyed by the shipment id side by side: one row for every id of
    any of them."""
    return L.dedupe_sheets(*sheets, key_alias=KEY)


def looked_up(ship: DataFrame, t, *steps) -> DataFrame:
    """`ship` (with the master's columns) with what the lookup `steps` add.
    They run over rows of the shipment id and its lookup keys alone; only their
    results meet the wide rows, which stay where they were grouped.  Both see
    the same master row, because the lookup keys decide among equal ordinals."""
    master = master_sheet(t)._replace(last=LOOKUP_KEYS, first=None)
    narrow = per_shipment(master)
    for step in steps:
        narrow = step(narrow, t)
    return ship.join(narrow.drop(*LOOKUP_KEYS.values()), [KEY, L.SHARD], "left")


def attach(base: DataFrame, shipments: DataFrame) -> DataFrame:
    """The base rows with all columns of their shipment."""
    return L.join_grouped(base, shipments, KEY)


LOCATION_COLS = ["name", "city", "state", "country_name"]
CCA_COLS = ["cca", "supplier_name"]


def locations_dim(t) -> DataFrame:
    """Location sheet, last row per alias, every column any role uses."""
    return L.dedupe_by_key(SRC.locations(t), "location_alias", LOCATION_COLS, keep="last")


def cca_dim(t) -> DataFrame:
    return L.dedupe_by_key(SRC.cca_sheet(t), "duns_number", CCA_COLS, keep="last")


def _sheet_dim(sheet: DataFrame, key: str, cols: list[str], keep: str) -> DataFrame:
    """A sheet's winners, stored: the planner knows their size before the
    shipments are shuffled for the join, so small ones are broadcast."""
    return stored(L.dedupe_by_key(sheet, key, cols, keep=keep), f"dim-{key}")


# Enrichments of the shipment rows by their own attributes.
def with_notes(df: DataFrame, t) -> DataFrame:
    notes = _sheet_dim(SRC.carrier_notes(t), "carrier_scac", ["name"], "last")
    return L.join_dimension(df, notes, "steamship_line_scac", "carrier_scac", {"name": "steamship_line"})


def with_supplier_location(df: DataFrame, t) -> DataFrame:
    return L.join_dimension(df, locations_dim(t), "supplier_duns", "location_alias", {
        "name": "supplier_name", "city": "origin_supplier_city", "state": "origin_supplier_province",
        "country_name": "origin_supplier_country"})


def with_dest(df: DataFrame, t) -> DataFrame:
    """Location and CCA entry of the shipment's own destination."""
    df = L.join_dimension(df, locations_dim(t), "dest_dun", "location_alias", {
        "name": "dest_name", "city": "dest_city", "state": "dest_state", "country_name": "dest_country"})
    return L.join_dimension(df, cca_dim(t), "dest_dun", "duns_number", {"cca": "cca", "supplier_name": "dest_plant"})


def with_io(df: DataFrame, t) -> DataFrame:
    return L.join_dimension(df, _sheet_dim(SRC.io_sheet(t), "code", ["supplier_name"], "last"), "bill_to_code", "code",
                            {"supplier_name": "io_name"})


def with_csp(df: DataFrame, t) -> DataFrame:
    names = {"cubic_meters": "csp_cbm", "actual_wt_kgs": "csp_weight_kg", "lane_id": "csp_lane_id", "last_mb_number": "csp_mbol"}
    return L.join_dimension(df, _sheet_dim(SRC.csp_sheet(t), "hwb", list(names), "first"), "hbol", "hwb", names)


def with_container_caps(df: DataFrame, spark: SparkSession) -> DataFrame:
    # Literal table with unique keys: no de-dup needed, bounded size -> broadcast.
    return L.join_dimension(df, container_ref(spark), "container_type", "container_type",
                            {"max_cbm": "max_cbm", "max_weight": "max_weight"}, broadcast=True)


# Routing of the base rows: the service level is theirs, the rest their
# shipment's, so both outcomes are at hand and the row chooses.
def dock_dim(t) -> DataFrame:
    """The cross dock's location and CCA name: one row at most."""
    loc = L.dedupe_by_key(SRC.locations(t).filter(F.col("location_alias") == C.CCA_DOCK_DUNS), "location_alias", LOCATION_COLS)
    cca = L.dedupe_by_key(SRC.cca_sheet(t).filter(F.col("duns_number") == C.CCA_DOCK_DUNS), "duns_number", ["supplier_name"],
                          key_alias="location_alias")
    dock = loc.join(cca, "location_alias", "full")
    return dock.select(F.col("location_alias").alias("dock"), F.col("name").alias("dock_name"), F.col("city").alias("dock_city"),
                       F.col("state").alias("dock_state"), F.col("country_name").alias("dock_country"),
                       F.col("supplier_name").alias("dock_plant"))


def with_destination(df: DataFrame, t) -> DataFrame:
    df = df.withColumn("destination_duns",
                       R.destination_duns("cca", "service_level", "dest_country", "dest_dun"))
    at_dock = F.when(F.col("destination_duns") == C.CCA_DOCK_DUNS, F.col("destination_duns"))
    df = L.join_dimension(df.withColumn("_at_dock", at_dock), dock_dim(t), "_at_dock", "dock",
                          {c: c for c in ("dock_name", "dock_city", "dock_state", "dock_country", "dock_plant")}, broadcast=True)

    def chosen(name: str):
        return F.when(F.col("_at_dock").isNotNull(), F.col(f"dock_{name}")).otherwise(F.col(f"dest_{name}"))

    return df.withColumns({
        "final_delivery_location_name": chosen("name"), "destination_city": chosen("city"),
        "destination_state": chosen("state"), "destination_country": chosen("country"),
        "cca_plant_name": chosen("plant")}).drop("_at_dock")


def with_plant(df: DataFrame) -> DataFrame:
    return df.withColumn("plant_name", R.plant_name("cca", "io_name", "q3_cca_location",
                                                    "destination_duns", "cca_plant_name"))


def with_fills(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "cbm": R.volume_fill("yesterday_cbm", "vol1", "vol2", "max_cbm", "csp_cbm"),
        "weight_in_kg": R.weight_fill("yesterday_weight_kg", "weight1", "weight2", "max_weight",
                                      "csp_weight_kg"),
        "ocean_or_air_lane_id": R.lane_fill("yesterday_lane_id", "q3_lane_id", "csp_lane_id"),
        "mbol": R.mbol_fill("mbol", "csp_mbol"),
    })


def with_origin_consol(df: DataFrame, spark: SparkSession) -> DataFrame:
    return L.join_dimension(df, consol_ref(spark), "origin_consol_duns", "origin_consol_duns",
                            {"origin_consol": "origin_consol"}, broadcast=True)


def with_status(df: DataFrame) -> DataFrame:
    return df.withColumn("status_of_container", ST.shipment_status(*[F.col(c) for c in STATUS_INPUTS]))


REPORT_COLUMNS = (
    [KEY, "lsc", "specialized_transport", "sid_number", "part_number", "quantity", "service_level",
     "ship_date_from_supplier", "mode", "provider_lane_id", "supplier_duns", "so_number", "manifest",
     "mti", "steamship_line_scac", "vessel_name", "path", "number_of_packages", "packaging_type",
     "supplier_name", "origin_supplier_city", "origin_supplier_province", "origin_supplier_country",
     "prn_number", "hbol", "mbol", "container_number", "container_type", "bill_to_code", "vol1",
     "weight1", "vol2", "weight2", "origin_consol_duns", "dest_dun", "dest_country", "cca",
     "steamship_line", "outbound_trailer", "outbound_tms"]
    + [c for _, c in MILESTONE_COLUMNS]
    + ["actual_arrival_final_dest", "destination_duns", "final_delivery_location_name",
       "destination_city", "destination_state", "destination_country", "plant_name", "cbm",
       "weight_in_kg", "ocean_or_air_lane_id", "origin_consol", "status_of_container"]
)


def master_report(t) -> DataFrame:
    spark = t.spark
    # One row per shipment, enriched by its own attributes; the wide base
    # rows are joined once.
    ship = per_shipment(master_sheet(t), trailers_sheet(t), milestones_sheet(t), yesterday_sheet(t))
    ship = looked_up(ship, t, with_supplier_location, with_dest, with_notes, with_io, with_csp)
    ship = with_origin_consol(with_fills(with_container_caps(ship, spark)), spark)
    df = attach(base_fields(t), ship)
    df = with_status(with_plant(with_destination(df, t)))
    return df.select(*REPORT_COLUMNS)


def dim_suppliers(t) -> DataFrame:
    """Locations (last row per alias) that are some shipment's origin."""
    return suppliers_of(SRC.locations(t), SRC.shipment_master(t))


def suppliers_of(locations: DataFrame, master: DataFrame) -> DataFrame:
    loc = L.dedupe_by_key(locations, "location_alias", ["name", "city", "state", "country_name"], keep="last")
    origins = master.select(F.col("origin_dun").alias("location_alias"))
    return loc.join(origins, "location_alias", "left_semi")
