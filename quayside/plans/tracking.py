"""Carrier-event plans: scrape exports, staging, unified fact, container dim."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import config as C
from quayside.functions import text as T
from quayside.functions import timeparse as TP
from quayside.operators import events as E
from quayside.sources import inputs as SRC
from quayside.sources.catalog import Inputs


# The exports are built from small steps (rows with their time, tracking
# type, keys, duplicate flag); each query takes only the steps whose columns it
# selects, because the planner cannot drop the join behind an unused step.
def hlcu_rows(t: Inputs) -> DataFrame:
    """Carrier-H rows with their parsed time."""
    return E.with_hlcu_ts(SRC.hlcu_events(t))


def hlcu_classified(t: Inputs, as_of=None, rows: DataFrame | None = None) -> DataFrame:
    """Carrier-H rows with time and tracking type."""
    return E.classify_tracking(hlcu_rows(t) if rows is None else rows, as_of)


def hlcu_flagged(t: Inputs, rows: DataFrame | None = None) -> DataFrame:
    """Carrier-H rows with time, duplicate key and flag."""
    return E.flag_latest(E.with_concat_2_hlcu(hlcu_rows(t) if rows is None else rows), fallback_first=True)


def hlcu_export(t: Inputs, as_of=None) -> DataFrame:
    """Carrier-H export rows: parsed time, tracking type, keys, flag.  The
    flag's winners come from the unclassified rows."""
    df = E.with_concat_keys_hlcu(hlcu_classified(t, as_of))
    return E.flag_latest(df, fallback_first=True, rows=E.with_concat_2_hlcu(hlcu_rows(t)))


def maeu_rows(t: Inputs) -> DataFrame:
    """Carrier-M rows: constant Current, keys, date-only time."""
    df = E.with_concat_keys_maeu(E.constant_tracking(SRC.maeu_events(t)))
    return E.with_maeu_ts(df, date_only=True)


def maeu_export(t: Inputs) -> DataFrame:
    """Carrier-M export rows: constant Current, keys, date-only latest flag."""
    return E.flag_latest(maeu_rows(t), fallback_first=False)


def parse_event_ts(t: Inputs) -> DataFrame:
    ev = SRC.tracking_events(t)
    ts = F.when(F.col("carrier") == C.HLCU, TP.hlcu_event_ts("date", "time")) \
          .otherwise(TP.maeu_event_ts("date", "time"))
    return ev.select("ordinal", "carrier", ts.alias("event_ts"))


def _present(df: DataFrame, *columns: str) -> list:
    """The given columns that `df` has."""
    return [F.col(c) for c in columns if c in df.columns]


def stage_hlcu(df: DataFrame, every_row: bool = False) -> DataFrame:
    """Carrier-H export rows (with or without tracking type and flag) ->
    staged events: snake_case, one event_timestamp, no null status, normalised
    container and type, de-duplicated on (container, status, event_timestamp)
    keeping the latest row; events without a time are told apart by their raw
    date and time text.  `every_row` leaves the de-duplication to a merge and
    keeps the key's hidden part, `_undated`."""
    df = df.filter(F.col("status").isNotNull())
    typed = [T.standardize_tracking_type("type_of_tracking").alias("type_of_tracking")] if "type_of_tracking" in df.columns else []
    df = df.select(
        T.normalize_container("container_number").alias("container_number"),
        "status", "place_of_activity",
        F.col("date").alias("event_date"), F.col("time").alias("event_time"),
        F.col("event_ts").alias("event_timestamp"), "transport",
        *typed, *_present(df, "duplicates", "last_updated", "_loaded_at"), "ordinal", _undated("date", "event_ts"))
    return df if every_row else _dedupe_natural(df)


def stage_maeu(df: DataFrame, every_row: bool = False) -> DataFrame:
    """Carrier-M export rows (with or without flag) -> staged events: vessel
    split out of the status, date text reformatted to yyyy-MM-dd, one
    event_timestamp, de-duplicated as carrier H."""
    df = df.filter(F.col("status").isNotNull())
    v = T.extract_vessel("status")
    ts = TP.maeu_event_ts("date", "time")
    df = df.select(
        T.normalize_container("container_number").alias("container_number"),
        v["status"].alias("status"), "location",
        TP.iso_date_text(TP.maeu_event_date("date")).alias("event_date"),
        F.col("time").alias("event_time"),
        ts.alias("event_timestamp"),
        F.when(T.is_blank("vessel_name"), v["vessel_name"]).otherwise(F.col("vessel_name")).alias("vessel_name"),
        "transport",
        T.standardize_tracking_type("type_of_tracking").alias("type_of_tracking"),
        *_present(df, "duplicates", "last_updated", "_loaded_at"), "ordinal", _undated("date", ts))
    return df if every_row else _dedupe_natural(df)


def _undated(date: str, ts) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    text = F.concat(F.coalesce(F.col(date), F.lit("")), F.lit("|"), F.coalesce(F.col("time"), F.lit("")))
    return F.when(ts.isNull(), text).alias("_undated")


def _dedupe_natural(df: DataFrame) -> DataFrame:
    """One row per natural key, the latest."""
    keys = ["container_number", "status", "event_timestamp", "_undated"]
    rest = [c for c in df.columns if c not in keys]
    latest = F.struct("_loaded_at", "ordinal") if "_loaded_at" in df.columns else F.col("ordinal")
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), latest).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*[c for c in df.columns if c != "_undated"])


def stg_hlcu(t: Inputs, as_of=None) -> DataFrame:
    return stage_hlcu(hlcu_export(t, as_of))


def stg_maeu(t: Inputs) -> DataFrame:
    return stage_maeu(maeu_export(t))


def unified_events(h: DataFrame, m: DataFrame) -> DataFrame:
    """Staged events of both carriers in one layout, with a surrogate
    `event_id` whose fields keep their places when a part is null."""
    kept = [c for c in ("type_of_tracking", "last_updated") if c in h.columns]
    h = h.select("container_number", F.lit(C.HLCU).alias("carrier"), "status",
                 F.col("place_of_activity").alias("location"), "event_timestamp", F.lit("").alias("vessel_name"),
                 "transport", *kept, "ordinal")
    m = m.select("container_number", F.lit(C.MAEU).alias("carrier"), "status", "location", "event_timestamp",
                 "vessel_name", F.lit("").alias("transport"), *kept, "ordinal")
    u = h.unionByName(m)
    parts = ["carrier", "container_number", "status", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm")]
    eid = F.concat_ws("|", *[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts])
    return u.select(eid.alias("event_id"), *u.columns)


def fct_tracking_events(t: Inputs, as_of=None) -> DataFrame:
    """All carrier events unified, with their tracking type and the time of
    their last upsert.  The duplicate flag is not part of the fact."""
    return unified_events(stage_hlcu(hlcu_classified(t, as_of)), stage_maeu(maeu_rows(t)))


def carrier_events(t: Inputs) -> DataFrame:
    """All carrier events unified, without tracking type or duplicate flag."""
    return unified_events(stage_hlcu(hlcu_rows(t)), stage_maeu(maeu_rows(t)))


def latest_per_container(ship: DataFrame) -> DataFrame:
    """Latest staged shipment per container (by load time, then sti)."""
    k = F.struct(F.col("_loaded_at"), F.col("sti_number"))
    g = (ship.filter(F.col("container_number").isNotNull())
         .groupBy("container_number").agg(F.max_by(F.struct("pol", "pod"), k).alias("_s")))
    return g.select("container_number", F.col("_s.pol").alias("pol"), F.col("_s.pod").alias("pod"))


def dim_containers(t: Inputs, events: DataFrame | None = None, shipments: DataFrame | None = None) -> DataFrame:
    """One row per (container, carrier): latest event time and status, the
    vessel of that event, and POL/POD of the container's latest shipment.
    Neither tracking type nor duplicate flag takes part."""
    f = carrier_events(t) if events is None else events
    key = F.struct(F.col("event_timestamp").isNotNull().alias("has"),
                   F.col("event_timestamp").alias("t"), F.col("ordinal").alias("o"))
    g = f.groupBy("container_number", "carrier").agg(
        F.max("event_timestamp").alias("latest_event_time"),
        F.max_by(F.struct("status", "vessel_name"), key).alias("_l"))
    g = g.select("container_number", "carrier", F.col("_l.vessel_name").alias("vessel_name"),
                 "latest_event_time", F.col("_l.status").alias("current_status"))
    if shipments is None:
        from quayside.plans.shipments import stg_shipments

        shipments = stg_shipments(t)
    pp = latest_per_container(shipments)
    return g.join(pp, "container_number", "left").select(
        "container_number", "carrier", "vessel_name", "pol", "pod", "latest_event_time", "current_status")


def cross_carrier_counts(t: Inputs, as_of=None) -> DataFrame:
    f = fct_tracking_events(t, as_of)
    return f.groupBy("carrier", "type_of_tracking").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct("container_number").alias("n_containers"))


def parse_cards(t: Inputs) -> DataFrame:
    """Tracking cards -> event fields (not-found cards become marker rows)."""
    cards = SRC.tracking_cards(t).withColumn("_kinds", T.card_line_kinds(F.split(T.trim_ws("text"), "\n")))
    p = T.card_fields("_kinds")
    not_found = F.col("text").rlike(C.NOT_FOUND_PATTERN)

    def nf(c, default):
        return F.when(not_found, F.lit(default)).otherwise(c)

    return cards.select(
        "card_id", "container_number",
        F.lit(C.CURRENT).alias("type_of_tracking"),
        nf(p["status"], C.NOT_FOUND_STATUS).alias("status"),
        nf(p["location"], "").alias("location"),
        nf(p["date"], "").alias("date"),
        nf(p["time"], "").alias("time"),
        nf(p["vessel_name"], "").alias("vessel_name"),
        F.lit("").alias("transport"),
    )


def extract_vessel_q(t: Inputs) -> DataFrame:
    """Vessel split on the raw status text of carrier-M export rows."""
    ev = SRC.maeu_events(t)
    v = T.extract_vessel("status")
    return ev.select("ordinal", F.col("status").alias("raw_status"),
                     v["status"].alias("status"), v["vessel_name"].alias("vessel_name"))


def not_found_rows(t: Inputs) -> DataFrame:
    """Marker rows only: the page-text test runs before any card parsing."""
    cards = SRC.tracking_cards(t).filter(F.col("text").rlike(C.NOT_FOUND_PATTERN))
    return cards.select(
        "card_id", "container_number", F.lit(C.CURRENT).alias("type_of_tracking"),
        F.lit(C.NOT_FOUND_STATUS).alias("status"), *[F.lit("").alias(c) for c in
                                                      ("location", "date", "time", "vessel_name", "transport")])


def run_summary(t: Inputs, as_of=None) -> DataFrame:
    """Run totals for carrier H: watch-list size, containers with events,
    failures, success rate, events, tracking-type counts and Latest flags."""
    wl = SRC.watchlist(t).filter(F.col("container_number").isNotNull())
    ev = hlcu_export(t, as_of)
    per = ev.groupBy("container_number").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("type_of_tracking") == C.HISTORIC).alias("_h"),
        F.count_if(F.col("type_of_tracking") == C.CURRENT).alias("_c"),
        F.count_if(F.col("type_of_tracking") == C.FUTURE).alias("_f"),
        F.count_if(F.col("duplicates") == C.LATEST).alias("_l"))
    # Every watch-list entry is one scrape, so a repeated container counts
    # (and contributes its events) once per entry, as in the export.
    j = wl.join(per, "container_number", "left")

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    out = j.agg(
        F.count(F.lit(1)).alias("total_containers"),
        F.count_if(F.coalesce(F.col("_n"), F.lit(0)) > 0).alias("successful"),
        total("_n").alias("total_events"),
        F.count_distinct(F.when(F.col("_n") > 0, F.col("container_number"))).alias("unique_containers"),
        total("_h").alias("historic_events"), total("_c").alias("current_events"),
        total("_f").alias("future_events"), total("_l").alias("latest_flags"))
    return out.select(
        "total_containers", "successful",
        (F.col("total_containers") - F.col("successful")).alias("failed"),
        F.round(F.lit(100.0) * F.col("successful") / F.col("total_containers"), 1).alias("success_rate_pct"),
        "total_events", "unique_containers", "historic_events", "current_events", "future_events",
        "latest_flags")
