"""TMS extract operators: entity-attribute-value references, priority pick,
consolidation location, and the full shipment extract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import config as C
from quayside.session import shuffle_partitions_for, stored

# Active shipments of one initial shuffle partition.
TASK_SHIPMENTS = 20_000


def eav_attributes(refs: DataFrame, id_col: str, types: dict[int, str],
                   type_col: str = "reference_type_id", value_col: str = "reference_number") -> DataFrame:
    """Tall (id, type, value) rows -> one row per id with one column per type.

    A pivot over a fixed list of types: Spark plans it as one grouped
    aggregate with a conditional `max` per type (partially aggregated before
    the shuffle).  Multi-valued types keep their greatest value.
    """
    r = refs.filter(F.col(type_col).isin(list(types)))
    p = r.groupBy(id_col).pivot(type_col, list(types)).agg(F.max(value_col))
    return p.select(id_col, *[F.col(str(k)).alias(v) for k, v in types.items()])


def priority_pick(refs: DataFrame, id_col: str, priorities: dict[int, int], out: str,
                  type_col: str = "reference_type_id", value_col: str = "reference_number") -> DataFrame:
    """Best reference per id by type priority (ties: smallest value).

    `min(struct(priority, value, type))` per id is a partial aggregate, so a
    unit load with very many references is combined map-side.
    """
    prio = None
    for t, p in priorities.items():
        prio = F.when(F.col(type_col) == t, F.lit(p)) if prio is None else prio.when(F.col(type_col) == t, F.lit(p))
    r = refs.filter(F.col(type_col).isin(list(priorities)))
    g = r.groupBy(id_col).agg(F.min(F.struct(prio.alias("p"), F.col(value_col).alias("v"),
                                             F.col(type_col).alias("t"))).alias("_b"))
    return g.select(id_col, F.col("_b.t").alias(f"{out}_type_id"), F.col("_b.v").alias(out))


def consol_locations(milestones: DataFrame, entities: DataFrame) -> DataFrame:
    """Consolidation DUNS per milestone row: only for consolidation-type
    milestones and only known consolidation centres.  The milestone-type
    test stays in the join condition (it must not drop rows)."""
    known = [d for d, _ in C.ORIGIN_CONSOL]
    ent = entities.filter(F.col("location_alias").isin(known)).select(
        F.col("entity_id").alias("_ent"), F.col("location_alias").alias("consol_dun"))
    cond = ((milestones["location_entity_id"] == ent["_ent"])
            & (milestones["operational_milestone_type_id"] == C.CONSOL_MILESTONE_TYPE))
    return milestones.join(ent, cond, "left").drop("_ent")


def restrict_to_ids(df: DataFrame, ids: DataFrame, df_col: str, ids_col: str) -> DataFrame:
    """Keep rows whose id appears in `ids` (IN list as a semi join)."""
    return df.join(ids.select(F.col(ids_col).alias("_id")), F.col(df_col) == F.col("_id"), "left_semi")


def _kinds(**kinds: tuple[DataFrame, Column, list[Column]]) -> DataFrame:
    """Frames of one key as one tall frame: `_id`, and per kind a struct of its
    values, null in the rows of the other kinds (so a struct of nulls is still
    a value)."""
    out = None
    for name, (df, key, values) in kinds.items():
        rows = df.select(key.alias("_id"), F.struct(*values).alias(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def _combined(df: DataFrame, *sets: str) -> DataFrame:
    """Every combination of the values in the set columns; an empty set counts
    as one null."""
    for c in sets:
        df = df.withColumn(c, F.explode_outer(c))
    return df.select(*[c for c in df.columns if c not in sets], *[f"{c}.*" for c in sets])


def shipment_extract(es: DataFrame, srefs: DataFrame, milestones: DataFrame, ul_refs: DataFrame,
                     cassn: DataFrame, cattr: DataFrame, sdocs: DataFrame, sdoc_refs: DataFrame,
                     oassn: DataFrame, opkg: DataFrame, entities: DataFrame, active_ids: DataFrame) -> DataFrame:
    """Shipment master rows as the TMS query returns them: every combination
    of the left-joined attributes (multi-valued references, milestones and
    packages fan out), then DISTINCT over the whole row.

    1. The active shipments are stored once.
    2. What hangs on a shipment (four kinds of references, packages, milestones
       with their consolidation DUNS) is reduced to the active ids by semi
       joins and gathered in one grouped pass into sets of distinct values per
       shipment, also stored: the (shipment, unit load) pairs come from it.
    3. What hangs on a unit load (bills of lading, containers, lanes) is
       reduced to those pairs' loads and gathered in one grouped pass too.

    Only then do the sets fan out.  A set holds the distinct values of one
    shipment or unit load, whose combinations are rows of the result; sets are
    combined before the shuffle.

    All shuffles are by shipment or unit load: they start with a partition per
    `TASK_SHIPMENTS` shipments in the active state."""
    s = es.filter(F.col("current_state_type_id") == C.ACTIVE_STATE)
    shuffle_partitions_for(es.sparkSession, s.count(), TASK_SHIPMENTS)
    s = stored(restrict_to_ids(s, active_ids, "em_shipment_id", "sti").select(
        "em_shipment_id", "shipment_id_number", "shipment_pieces", "ultimate_origin_alias", "ultimate_dest_alias",
        "shipment_cube", "shipment_weight"), "tms-active")

    def active(df: DataFrame) -> DataFrame:
        return restrict_to_ids(df, s, "em_shipment_id", "em_shipment_id")

    sid = F.col("em_shipment_id")
    kinds = {C.REF_MODE: "mode", C.REF_CCA_LOCATION: "cca_location", C.REF_PRN: "prn", C.REF_SO: "so"}
    refs = active(srefs.filter(F.col("reference_type_id").isin(list(kinds))))
    orders = active(oassn).select("em_shipment_id", F.col("order_id").alias("_order"))
    packed = orders.join(opkg.select(F.col("order_id").alias("_op"), "package_id_number"), F.col("_order") == F.col("_op"), "left")
    tall = _kinds(
        shipment=(s, sid, [F.col(c) for c in s.columns]),
        reference=(refs, sid, [F.col("reference_type_id").alias("type"), F.col("reference_number").alias("value")]),
        package=(packed, sid, [F.col("package_id_number").alias("packaging_type")]),
        load=(consol_locations(active(milestones), entities), sid, [F.col("master_unitload_id").alias("unit_load"), F.col("consol_dun")]))
    per = tall.groupBy("_id").agg(*[F.collect_set(c).alias(c) for c in ("shipment", "package", "load")], *[
        F.collect_set(F.when(F.col("reference.type") == k, F.struct(F.col("reference.value").alias(name)))).alias(name)
        for k, name in kinds.items()])
    per = stored(per, "tms-shipments")

    pairs = per.select("_id", F.explode("load").alias("load")).select("_id", "load.*")
    loads = pairs.select("unit_load")

    def loaded(df: DataFrame) -> DataFrame:
        return restrict_to_ids(df, loads, "master_unitload_id", "unit_load")

    ul = F.col("master_unitload_id")
    bills = loaded(ul_refs.filter(F.col("reference_type_id").isin([C.REF_HBL, *dict(C.MBL_PRIORITY)])))
    boxes = loaded(cassn).join(cattr.select(F.col("container_attributes_id").alias("_c"), "conveyance_id_number", "conveyance_type_desc",
                                            "conveyance_cube", "conveyance_weight"), F.col("container_attributes_id") == F.col("_c"), "left")
    lane_refs = sdoc_refs.filter(F.col("reference_type_id") == C.REF_LANE).select(F.col("status_doc_id").alias("_d"), F.col("reference_number").alias("lane_id"))
    lanes = loaded(sdocs).join(lane_refs, F.col("status_doc_id") == F.col("_d"), "left")
    tall = _kinds(
        bill=(bills, ul, [F.col("reference_type_id").alias("type"), F.col("reference_number").alias("value")]),
        container=(boxes, ul, [F.col("conveyance_id_number").alias("cont_id"), F.col("conveyance_type_desc").alias("cont_type"),
                               F.col("conveyance_cube").alias("vol2"), F.col("conveyance_weight").alias("weight2")]),
        lane=(lanes, ul, [F.col("lane_id")]))
    kind, value = F.col("bill.type"), F.col("bill.value")
    rank = F.coalesce(*[F.when(kind == k, F.lit(p)) for k, p in C.MBL_PRIORITY])
    units = tall.groupBy("_id").agg(
        F.collect_set(F.when(kind == C.REF_HBL, F.struct(value.alias("hbl")))).alias("hbl"),
        F.min(F.when(rank.isNotNull(), F.struct(rank.alias("p"), value.alias("v")))).getField("v").alias("mbl"),
        F.collect_set("container").alias("container"), F.collect_set("lane").alias("lane"))
    u = pairs.join(units.withColumnRenamed("_id", "_u"), F.col("unit_load") == F.col("_u"), "left")
    u = _combined(u.drop("unit_load", "_u"), "hbl", "container", "lane").distinct().withColumnRenamed("_id", "_sid")

    per = _combined(per.drop("load"), "shipment", "mode", "cca_location", "prn", "so", "package")
    return per.join(u, per["_id"] == u["_sid"], "left").select(
        F.col("em_shipment_id").alias("sti"), "shipment_id_number",
        F.col("shipment_pieces").alias("number_of_packages"),
        F.col("ultimate_origin_alias").alias("origin_dun"), F.col("ultimate_dest_alias").alias("dest_dun"),
        "mode", "cca_location", "prn", "so", "hbl", "mbl", "cont_id", "cont_type", "lane_id",
        F.col("shipment_cube").alias("vol1"), F.col("shipment_weight").alias("weight1"), "vol2", "weight2",
        "packaging_type", "consol_dun",
    )
