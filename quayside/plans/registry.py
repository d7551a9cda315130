"""Query registry: one callable (spark, data_dir) -> DataFrame per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import config as C
from quayside.operators import events as E
from quayside.plans import tracking as TR
from quayside.session import scratch_path
from quayside.sources import inputs as SRC
from quayside.sources.catalog import load_inputs

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

# Container used by the point-lookup query.
LOOKUP_CONTAINER = "CONT0000007"


def query(name: str):
    def deco(fn):
        _REGISTRY[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # Import side-effect modules that register further queries.
    from quayside.plans import registry_more  # noqa: F401
    return dict(_REGISTRY)


# ---------------------------------------------------------------- events
@query("parse_event_ts")
def q_parse_event_ts(spark, d):
    return TR.parse_event_ts(load_inputs(spark, d))


@query("classify_tracking")
def q_classify_tracking(spark, d):
    df = TR.hlcu_classified(load_inputs(spark, d))
    return df.select("ordinal", "container_number", "status", "date", "time", "event_ts", "type_of_tracking")


@query("concat_keys_hlcu")
def q_concat_keys_hlcu(spark, d):
    df = E.with_concat_keys_hlcu(TR.hlcu_classified(load_inputs(spark, d)))
    return df.select("ordinal", "concat_1", "concat_2", "concat_3")


@query("flag_latest_hlcu")
def q_flag_latest_hlcu(spark, d):
    return TR.hlcu_flagged(load_inputs(spark, d)).select("ordinal", "concat_2", "duplicates")


@query("concat_keys_maeu")
def q_concat_keys_maeu(spark, d):
    return TR.maeu_rows(load_inputs(spark, d)).select("ordinal", "concat_1", "concat_2", "concat_3")


@query("flag_latest_maeu")
def q_flag_latest_maeu(spark, d):
    return TR.maeu_export(load_inputs(spark, d)).select(
        "ordinal", "concat_2", F.col("event_ts").alias("event_date"), "duplicates")


@query("event_id_key")
def q_event_id_key(spark, d):
    ev = E.with_event_id(SRC.tracking_events(load_inputs(spark, d)))
    return ev.select("ordinal", "carrier", "_id")


@query("tracking_type_counts")
def q_tracking_type_counts(spark, d):
    return E.tracking_type_counts(TR.hlcu_classified(load_inputs(spark, d)))


@query("distinct_types")
def q_distinct_types(spark, d):
    return E.distinct_types(TR.hlcu_classified(load_inputs(spark, d)))


@query("container_summary")
def q_container_summary(spark, d):
    return E.container_summary(TR.hlcu_classified(load_inputs(spark, d)))


@query("container_summary_preview")
def q_container_summary_preview(spark, d):
    """The first 20 container summaries (a top-k report)."""
    return E.container_summary_preview(q_container_summary(spark, d))


@query("latest_duplicates_preview")
def q_latest_duplicates_preview(spark, d):
    """The first 10 rows flagged Latest (a top-k report)."""
    df = E.latest_duplicates_preview(TR.hlcu_export(load_inputs(spark, d)))
    return df.select("ordinal", "container_number", "status", "type_of_tracking", "date", "time", "duplicates")


@query("sample_per_type")
def q_sample_per_type(spark, d):
    df = TR.hlcu_classified(load_inputs(spark, d))
    return E.sample_per_type(df).select("ordinal", "container_number", "status", "date", "time",
                                        "type_of_tracking")


@query("current_events")
def q_current_events(spark, d):
    df = TR.hlcu_classified(load_inputs(spark, d))
    return E.current_events(df).select("ordinal", "container_number", "status", "place_of_activity",
                                       "date", "time", "transport", "type_of_tracking")


@query("journey_timeline")
def q_journey_timeline(spark, d):
    df = TR.hlcu_classified(load_inputs(spark, d))
    return E.journey_timeline(df).select("ordinal", "container_number", "event_ts", "status",
                                         "type_of_tracking", "step", "prev_status")


LOOKUP_COLUMNS = ["ordinal", "container_number", "status", "date", "time", "type_of_tracking", "duplicates"]


@query("container_lookup")
def q_container_lookup(spark, d):
    """Point access by container.  Tracking type and duplicate flag are rules
    within one container, so the filter comes before both, right above (for a
    stored column: inside) the scan."""
    t = load_inputs(spark, d)
    rows = E.container_lookup(TR.hlcu_rows(t), LOOKUP_CONTAINER)
    df = E.with_concat_keys_hlcu(E.classify_tracking(rows))
    return E.flag_latest(df, rows=E.with_concat_2_hlcu(rows)).select(*LOOKUP_COLUMNS)


@query("stored_container_lookup")
def q_stored_container_lookup(spark, d):
    """The exported events stored for point access, and one container's rows
    read back."""
    path = scratch_path(spark, "lookup")
    E.write_lookup_snapshot(TR.hlcu_export(load_inputs(spark, d)).select(*LOOKUP_COLUMNS), path)
    return E.stored_container_lookup(spark, path, LOOKUP_CONTAINER)


@query("container_type_lookup")
def q_container_type_lookup(spark, d):
    """Point access by (container, tracking type)."""
    t = load_inputs(spark, d)
    rows = E.classify_tracking(E.container_lookup(TR.hlcu_rows(t), LOOKUP_CONTAINER))
    return E.container_lookup(rows, LOOKUP_CONTAINER, C.HISTORIC).select(*LOOKUP_COLUMNS[:-1])


@query("run_summary")
def q_run_summary(spark, d):
    return TR.run_summary(load_inputs(spark, d))


@query("stg_hlcu")
def q_stg_hlcu(spark, d):
    return TR.stg_hlcu(load_inputs(spark, d))


@query("stg_maeu")
def q_stg_maeu(spark, d):
    return TR.stg_maeu(load_inputs(spark, d))


@query("fct_tracking_events")
def q_fct_tracking_events(spark, d):
    return TR.fct_tracking_events(load_inputs(spark, d))


@query("dim_containers")
def q_dim_containers(spark, d):
    return TR.dim_containers(load_inputs(spark, d))


@query("cross_carrier_counts")
def q_cross_carrier_counts(spark, d):
    return TR.cross_carrier_counts(load_inputs(spark, d))


@query("parse_cards")
def q_parse_cards(spark, d):
    return TR.parse_cards(load_inputs(spark, d))


@query("extract_vessel")
def q_extract_vessel(spark, d):
    return TR.extract_vessel_q(load_inputs(spark, d))


@query("not_found_rows")
def q_not_found_rows(spark, d):
    return TR.not_found_rows(load_inputs(spark, d))




@query("stg_shipments")
def q_stg_shipments(spark, d):
    from quayside.plans.shipments import stg_shipments
    return stg_shipments(load_inputs(spark, d))


@query("fct_shipment_status")
def q_fct_shipment_status(spark, d):
    from quayside.plans.shipments import fct_shipment_status
    return fct_shipment_status(load_inputs(spark, d))
