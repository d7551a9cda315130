"""DuckDB SQL oracles: the same results as the registered queries, written
independently as plain SQL over the driver tables.

Each stand-in input of `quayside.sources.standins` appears once here as a
CTE; every oracle query is `WITH <the CTEs it needs> SELECT ...`.
Windows are fine here: the oracle only checks results at small scale.
"""

from __future__ import annotations

from quayside import config as C

AS_OF = C.AS_OF_SQL

CTE: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, deps: tuple[str, ...] = ()):
    CTE[name] = (body, deps)


def with_ctes(*names: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTE[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return ""
    return "WITH " + ",\n".join(f"{n} AS (\n{CTE[n][0]}\n)" for n in order) + "\n"


def trim_ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


# ------------------------------------------------------------- events
cte("trk", """
SELECT event_id AS ordinal,
  CASE WHEN event_id % 2 = 0 THEN 'HLCU' ELSE 'MAEU' END AS carrier,
  'CONT' || lpad(CAST(user_id AS VARCHAR), 7, '0') AS container_number,
  CASE WHEN event_id % 101 = 0 THEN NULL
       WHEN event_id % 2 = 0 THEN
         CASE event_type WHEN 'view' THEN 'Arrival in' WHEN 'click' THEN 'Departure from'
              WHEN 'signup' THEN 'Gate in' WHEN 'error' THEN 'Discharge' WHEN 'purchase' THEN 'Gate out' END
       ELSE
         CASE event_type WHEN 'view' THEN 'Load on VESSEL ' || CAST(event_id % 40 AS VARCHAR)
              WHEN 'click' THEN 'Vessel arrival (VESSEL ' || CAST(event_id % 40 AS VARCHAR) || ')'
              WHEN 'signup' THEN 'Gate in' WHEN 'error' THEN 'Discharge'
              WHEN 'purchase' THEN 'Vessel departure (VESSEL ' || CAST(event_id % 40 AS VARCHAR) || ')' END
  END AS status,
  'PORT_' || CAST(event_id % 25 AS VARCHAR) AS place,
  CASE WHEN event_id % 97 = 0 THEN ''
       WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d')
       ELSE strftime(ts, '%d %b %Y') END AS date,
  lpad(CAST((hour(ts) // 6) * 6 AS VARCHAR), 2, '0') || ':00' AS time,
  CASE WHEN event_id % 2 = 0 THEN 'VESSEL ' || CAST(event_id % 40 AS VARCHAR) ELSE '' END AS transport,
  '' AS vessel_name,
  strftime(ts, '%Y%m%d') || '_235900' AS scraped_at,
  CAST(day(ts) AS BIGINT) AS scrape_day
FROM events""")

cte("hx0", """
SELECT ordinal, container_number, status, place AS place_of_activity, date, time, transport,
  strptime(scraped_at, '%Y%m%d_%H%M%S') AS last_updated,
  try_strptime(date || ' ' || time, '%Y-%m-%d %H:%M') AS event_ts
FROM trk WHERE carrier = 'HLCU'""", ("trk",))

cte("hx1", f"""
SELECT *,
  CASE WHEN event_ts IS NULL OR event_ts > {AS_OF} THEN 'Future Tracking'
       WHEN row_number() OVER (PARTITION BY container_number, (event_ts <= {AS_OF})
                               ORDER BY event_ts DESC, ordinal ASC) = 1 THEN 'Current Tracking'
       ELSE 'Historic Tracking' END AS type_of_tracking
FROM hx0""", ("hx0",))

_HPART = ("CASE WHEN contains(coalesce(status, ''), 'Arrival in') OR contains(coalesce(status, ''), 'Departure from') "
          "THEN coalesce(transport, '') ELSE '' END")

cte("hx2", f"""
SELECT *,
  container_number || coalesce(status, '') || {_HPART} || type_of_tracking AS concat_1,
  container_number || coalesce(status, '') || {_HPART} AS concat_2,
  container_number || type_of_tracking AS concat_3
FROM hx1""", ("hx1",))

cte("hexp", """
SELECT *,
  CASE WHEN count(*) OVER (PARTITION BY concat_2) > 1
        AND row_number() OVER (PARTITION BY concat_2 ORDER BY event_ts DESC NULLS LAST, ordinal ASC) = 1
       THEN 'Latest' ELSE '' END AS duplicates
FROM hx2""", ("hx2",))

cte("mx0", """
SELECT ordinal, container_number, status, place AS location, date, time, vessel_name, transport,
  strptime(scraped_at, '%Y%m%d_%H%M%S') AS last_updated,
  'Current Tracking' AS type_of_tracking,
  container_number || coalesce(status, '') || 'Current Tracking' AS concat_1,
  container_number || coalesce(status, '') AS concat_2,
  container_number || 'Current Tracking' AS concat_3,
  try_strptime(date, '%d %b %Y') AS event_ts
FROM trk WHERE carrier = 'MAEU'""", ("trk",))

cte("mexp", """
SELECT *,
  CASE WHEN count(*) OVER (PARTITION BY concat_2) > 1 AND event_ts IS NOT NULL
        AND row_number() OVER (PARTITION BY concat_2 ORDER BY event_ts DESC NULLS LAST, ordinal ASC) = 1
       THEN 'Latest' ELSE '' END AS duplicates
FROM mx0""", ("mx0",))


def _vessel(s: str) -> tuple[str, str]:
    t = trim_ws(s)
    p1, p2, p3 = "(?i)^Load on\\s+(.+)$", "(?i)^Vessel departure\\s*\\((.+)\\)$", "(?i)^Vessel arrival\\s*\\((.+)\\)$"
    status = (f"CASE WHEN coalesce({s}, '') = '' THEN {s} "
              f"WHEN regexp_matches({t}, '{p1}') THEN 'Load on' "
              f"WHEN regexp_matches({t}, '{p2}') THEN 'Vessel departure' "
              f"WHEN regexp_matches({t}, '{p3}') THEN 'Vessel arrival' ELSE {s} END")
    vessel = (f"CASE WHEN coalesce({s}, '') = '' THEN '' "
              f"WHEN regexp_matches({t}, '{p1}') THEN {trim_ws(f'regexp_extract({t}, {chr(39)}{p1}{chr(39)}, 1)')} "
              f"WHEN regexp_matches({t}, '{p2}') THEN {trim_ws(f'regexp_extract({t}, {chr(39)}{p2}{chr(39)}, 1)')} "
              f"WHEN regexp_matches({t}, '{p3}') THEN {trim_ws(f'regexp_extract({t}, {chr(39)}{p3}{chr(39)}, 1)')} "
              f"ELSE '' END")
    return status, vessel


_VS, _VV = _vessel("status")

cte("stg_h", """
SELECT container_number, status, place_of_activity, event_date, event_time, event_timestamp, transport,
       type_of_tracking, duplicates, last_updated, ordinal FROM (
  SELECT upper(regexp_replace(container_number, '[^A-Za-z0-9]', '', 'g')) AS container_number, status,
    place_of_activity, date AS event_date, time AS event_time, event_ts AS event_timestamp, transport,
    type_of_tracking, duplicates, last_updated, ordinal,
    row_number() OVER (PARTITION BY upper(regexp_replace(container_number, '[^A-Za-z0-9]', '', 'g')),
                       status, event_ts, CASE WHEN event_ts IS NULL THEN coalesce(date, '') || '|' || coalesce(time, '') END
                       ORDER BY ordinal DESC) AS rn
  FROM hexp WHERE status IS NOT NULL) WHERE rn = 1""", ("hexp",))

cte("stg_m", f"""
SELECT container_number, status, location, event_date, event_time, event_timestamp, vessel_name, transport,
       type_of_tracking, duplicates, last_updated, ordinal FROM (
  SELECT *, row_number() OVER (PARTITION BY container_number, status, event_timestamp,
      CASE WHEN event_timestamp IS NULL THEN coalesce(date, '') || '|' || coalesce(event_time, '') END ORDER BY ordinal DESC) AS rn
  FROM (
    SELECT upper(regexp_replace(container_number, '[^A-Za-z0-9]', '', 'g')) AS container_number,
      {_VS} AS status, location,
      strftime(try_strptime(date, '%d %b %Y'), '%Y-%m-%d') AS event_date, date,
      time AS event_time,
      try_strptime(date || ' ' || time, '%d %b %Y %H:%M') AS event_timestamp,
      CASE WHEN {trim_ws("coalesce(vessel_name, '')")} = '' THEN {_VV} ELSE vessel_name END AS vessel_name,
      transport, type_of_tracking, duplicates, last_updated, ordinal
    FROM mexp WHERE status IS NOT NULL))
WHERE rn = 1""", ("mexp",))

cte("fct", """
SELECT carrier || '|' || container_number || '|' || status || '|' ||
         coalesce(strftime(event_timestamp, '%Y-%m-%d %H:%M'), '') AS event_id, * FROM (
  SELECT container_number, 'HLCU' AS carrier, status, place_of_activity AS location, event_timestamp,
         type_of_tracking, '' AS vessel_name, transport, last_updated, ordinal FROM stg_h
  UNION ALL
  SELECT container_number, 'MAEU' AS carrier, status, location, event_timestamp,
         type_of_tracking, vessel_name, '' AS transport, last_updated, ordinal FROM stg_m)""", ("stg_h", "stg_m"))

# Card table (carrier M page items).
cte("cards0", """
SELECT event_id AS card_id,
  'CONT' || lpad(CAST(user_id AS VARCHAR), 7, '0') AS container_number,
  list_filter([
    CASE WHEN event_id % 5 = 0 THEN '' END,
    'Port ' || CAST(event_id % 25 AS VARCHAR),
    CASE WHEN event_id % 3 <> 0 THEN 'Terminal ' || CAST(event_id % 7 AS VARCHAR) END,
    CASE WHEN event_id % 11 = 0 THEN lower(ph) ELSE ph END,
    CASE WHEN event_id % 97 <> 0 THEN strftime(ts, '%d %b %Y %H:%M') END
  ], lambda x: x IS NOT NULL) AS lines
FROM (SELECT *, CASE event_type
    WHEN 'view' THEN 'Load on VESSEL ' || CAST(event_id % 40 AS VARCHAR)
    WHEN 'click' THEN 'Vessel arrival (VESSEL ' || CAST(event_id % 40 AS VARCHAR) || ')'
    WHEN 'signup' THEN 'Vessel departure (VESSEL ' || CAST(event_id % 40 AS VARCHAR) || ')'
    WHEN 'error' THEN 'Discharge' ELSE 'Gate out' END AS ph
  FROM events WHERE event_id % 2 = 1)""")

cte("cards", """
SELECT card_id, container_number,
  CASE WHEN card_id % 53 = 0 THEN 'No results found for ' || container_number
       ELSE array_to_string(list_concat(list_slice(lines, r + 1, len(lines)), list_slice(lines, 1, r)), chr(10))
  END AS text
FROM (SELECT *, CAST((card_id % 4) % len(lines) AS BIGINT) AS r FROM cards0)""", ("cards0",))

_DT = "\\d{1,2}\\s+[A-Za-z]{3}\\s+\\d{4}\\s+\\d{2}:\\d{2}"
_KW = ("(?i)(Gate out Empty|Gate out for delivery|Gate out|Gate in|Load on|Discharge|Vessel arrival|"
       "Vessel departure|On rail|Off rail|Rail departure|Rail arrival|Empty container return)")

cte("cards_p0", f"""
SELECT card_id, container_number, text,
  coalesce(list_filter(parts, lambda x: regexp_matches(x, '{_DT}'))[-1], '') AS dt_text,
  coalesce(list_filter(parts, lambda x: NOT regexp_matches(x, '{_DT}') AND regexp_matches(x, '{_KW}'))[-1], '') AS st,
  list_filter(parts, lambda x: NOT regexp_matches(x, '{_DT}') AND NOT regexp_matches(x, '{_KW}') AND x <> '') AS other
FROM (SELECT *, string_split({trim_ws('text')}, chr(10)) AS parts FROM cards)""", ("cards",))

_CS, _CV = _vessel("st")

cte("cards_p", f"""
SELECT card_id, container_number, text,
  {_CS} AS status, {_CV} AS vessel_name,
  CASE WHEN terminal <> '' AND terminal <> location THEN
       CASE WHEN location <> '' THEN location || ' - ' || terminal ELSE terminal END
       ELSE location END AS location,
  CASE WHEN contains(m, ' ') THEN regexp_extract(m, '^(.*) ([^ ]*)$', 1) ELSE '' END AS date,
  CASE WHEN contains(m, ' ') THEN regexp_extract(m, '^(.*) ([^ ]*)$', 2) ELSE '' END AS time
FROM (SELECT *, coalesce(other[1], '') AS location, coalesce(other[2], '') AS terminal,
             regexp_extract(dt_text, '{_DT}', 0) AS m FROM cards_p0)""", ("cards_p0",))

cte("cards_out", """
SELECT card_id, container_number, 'Current Tracking' AS type_of_tracking,
  CASE WHEN nf THEN 'Container Not Found' ELSE status END AS status,
  CASE WHEN nf THEN '' ELSE location END AS location,
  CASE WHEN nf THEN '' ELSE date END AS date,
  CASE WHEN nf THEN '' ELSE time END AS time,
  CASE WHEN nf THEN '' ELSE vessel_name END AS vessel_name,
  '' AS transport
FROM (SELECT *, regexp_matches(text, 'No results|not found|could not be found') AS nf FROM cards_p)""",
    ("cards_p",))

cte("watch", """
SELECT c_custkey AS ordinal,
  CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE 'CONT' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') END
    AS container_number
FROM customer""")


SQL: dict[str, str] = {}


def q(name: str, needs: tuple[str, ...], body: str):
    SQL[name] = with_ctes(*needs) + body


q("parse_event_ts", ("trk",), """
SELECT ordinal, carrier,
  CASE WHEN carrier = 'HLCU' THEN try_strptime(date || ' ' || time, '%Y-%m-%d %H:%M')
       ELSE try_strptime(date || ' ' || time, '%d %b %Y %H:%M') END AS event_ts
FROM trk""")

q("classify_tracking", ("hexp",),
  "SELECT ordinal, container_number, status, date, time, event_ts, type_of_tracking FROM hexp")
q("concat_keys_hlcu", ("hexp",), "SELECT ordinal, concat_1, concat_2, concat_3 FROM hexp")
q("flag_latest_hlcu", ("hexp",), "SELECT ordinal, concat_2, duplicates FROM hexp")
q("concat_keys_maeu", ("mexp",), "SELECT ordinal, concat_1, concat_2, concat_3 FROM mexp")
q("flag_latest_maeu", ("mexp",), "SELECT ordinal, concat_2, event_ts AS event_date, duplicates FROM mexp")

q("event_id_key", ("trk",), f"""
SELECT ordinal, carrier,
  coalesce({trim_ws('container_number')}, '') || '|' || coalesce({trim_ws('status')}, '') || '|' ||
  coalesce({trim_ws('date')}, '') || '|' || coalesce({trim_ws('time')}, '') AS _id
FROM trk""")

q("tracking_type_counts", ("hexp",),
  "SELECT type_of_tracking, count(*) AS n_events FROM hexp GROUP BY type_of_tracking")

q("container_summary", ("hexp",), """
SELECT a.container_number, a.events, a.first_date, a.last_date, b.tracking_types FROM (
  SELECT container_number, count(status) AS events,
    arg_min(date, ordinal) FILTER (WHERE date IS NOT NULL) AS first_date,
    arg_max(date, ordinal) FILTER (WHERE date IS NOT NULL) AS last_date
  FROM hexp GROUP BY container_number) a
LEFT JOIN (
  SELECT container_number, string_agg(type_of_tracking, ', ' ORDER BY f) AS tracking_types
  FROM (SELECT container_number, type_of_tracking, min(ordinal) AS f FROM hexp
        WHERE type_of_tracking IS NOT NULL GROUP BY 1, 2)
  GROUP BY container_number) b ON a.container_number = b.container_number""")

q("sample_per_type", ("hexp",), """
SELECT ordinal, container_number, status, date, time, type_of_tracking FROM (
  SELECT *, row_number() OVER (PARTITION BY type_of_tracking ORDER BY ordinal) AS rn FROM hexp)
WHERE rn <= 3""")

q("current_events", ("hexp",), """
SELECT ordinal, container_number, status, place_of_activity, date, time, transport, type_of_tracking
FROM hexp WHERE type_of_tracking = 'Current Tracking'""")

q("journey_timeline", ("hexp",), """
SELECT ordinal, container_number, event_ts, status, type_of_tracking,
  row_number() OVER w AS step, lag(status) OVER w AS prev_status
FROM hexp WHERE event_ts IS NOT NULL
WINDOW w AS (PARTITION BY container_number ORDER BY event_ts, ordinal)""")

q("distinct_types", ("hexp",), "SELECT type_of_tracking, min(ordinal) AS first_ordinal FROM hexp GROUP BY type_of_tracking")
SQL["container_summary_preview"] = SQL["container_summary"] + " ORDER BY a.container_number LIMIT 20"
q("latest_duplicates_preview", ("hexp",), f"""
SELECT ordinal, container_number, status, type_of_tracking, date, time, duplicates
FROM hexp WHERE duplicates = '{C.LATEST}' ORDER BY ordinal LIMIT 10""")
q("container_type_lookup", ("hexp",), f"""
SELECT ordinal, container_number, status, date, time, type_of_tracking
FROM hexp WHERE container_number = 'CONT0000007' AND type_of_tracking = '{C.HISTORIC}'""")

q("container_lookup", ("hexp",), """
SELECT ordinal, container_number, status, date, time, type_of_tracking, duplicates
FROM hexp WHERE container_number = 'CONT0000007'""")

SQL["stored_container_lookup"] = SQL["container_lookup"]

q("run_summary", ("hexp", "watch"), """
SELECT total_containers, successful, total_containers - successful AS failed,
  round(100.0 * successful / total_containers, 1) AS success_rate_pct,
  total_events, unique_containers, historic_events, current_events, future_events, latest_flags
FROM (
  SELECT count(*) AS total_containers,
    count(*) FILTER (WHERE coalesce(n, 0) > 0) AS successful,
    CAST(coalesce(sum(n), 0) AS BIGINT) AS total_events,
    count(DISTINCT CASE WHEN n > 0 THEN w.container_number END) AS unique_containers,
    CAST(coalesce(sum(h), 0) AS BIGINT) AS historic_events,
    CAST(coalesce(sum(c), 0) AS BIGINT) AS current_events,
    CAST(coalesce(sum(f), 0) AS BIGINT) AS future_events,
    CAST(coalesce(sum(l), 0) AS BIGINT) AS latest_flags
  FROM watch w LEFT JOIN (
    SELECT container_number, count(*) AS n,
      count(*) FILTER (WHERE type_of_tracking = 'Historic Tracking') AS h,
      count(*) FILTER (WHERE type_of_tracking = 'Current Tracking') AS c,
      count(*) FILTER (WHERE type_of_tracking = 'Future Tracking') AS f,
      count(*) FILTER (WHERE duplicates = 'Latest') AS l
    FROM hexp GROUP BY container_number) e ON w.container_number = e.container_number
  WHERE w.container_number IS NOT NULL)""")

q("stg_hlcu", ("stg_h",), "SELECT * FROM stg_h")
q("stg_maeu", ("stg_m",), "SELECT * FROM stg_m")
q("fct_tracking_events", ("fct",), "SELECT * FROM fct")

SQL["layer_run"] = SQL["fct_tracking_events"]
q("cross_carrier_counts", ("fct",), """
SELECT carrier, type_of_tracking, count(*) AS n_events, count(DISTINCT container_number) AS n_containers
FROM fct GROUP BY carrier, type_of_tracking""")

q("parse_cards", ("cards_out",), "SELECT * FROM cards_out")
q("not_found_rows", ("cards_out",), "SELECT * FROM cards_out WHERE status = 'Container Not Found'")

_ES, _EV = _vessel("status")
q("extract_vessel", ("trk",), f"""
SELECT ordinal, status AS raw_status, {_ES} AS status, {_EV} AS vessel_name
FROM trk WHERE carrier = 'MAEU'""")


# ------------------------------------------------------------ shipments
def _d(k: int, key: str = "o_orderkey", base: str = "o_orderdate") -> str:
    return (f"CASE WHEN {k} < {key} % 10 AND ({key} + {k}) % 7 <> 0 "
            f"THEN {base} + INTERVAL ({3 * k}) DAY END")


_SHIP_COLS = f"""
  CAST(o_orderkey AS VARCHAR) AS sti_number,
  'SID' || CAST(o_orderkey AS VARCHAR) AS shipment_id_number,
  'CONT' || lpad(CAST(o_custkey % 150 AS VARCHAR), 7, '0') AS container_number,
  'H' || CAST(o_orderkey % 500 AS VARCHAR) AS hbl,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'M' || CAST(o_orderkey AS VARCHAR) END AS mbl,
  'SC' || CAST(o_custkey % 25 AS VARCHAR) AS scac_code,
  {{vessel}} AS vessel_name,
  'POL' || CAST(o_orderkey % 9 AS VARCHAR) AS pol,
  'POD' || CAST(o_orderkey % 11 AS VARCHAR) AS pod,
  CAST(o_orderkey % 200 AS VARCHAR) AS origin_dun,
  CAST(o_custkey AS VARCHAR) AS dest_dun,
  'LANE' || CAST(o_orderkey % 30 AS VARCHAR) AS lane_id,
  {_d(0)} AS ship_date_from_supplier, {_d(1)} AS actual_departure_consol,
  {_d(2)} AS actual_arrival_pol, {_d(3)} AS actual_departure_pol, {_d(4)} AS actual_arrival_pod,
  {_d(5)} AS actual_outgate_pod, {_d(6)} AS actual_arrival_dest_rail, {_d(7)} AS actual_departure_dest_rail,
  {_d(8)} AS actual_arrival_final_dest,
  o_orderdate + INTERVAL 12 DAY AS eta,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 60 AS DOUBLE) + 0.5 END AS cbm,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 900 AS DOUBLE) * 10 END AS weight_kg,
  {{loaded}} AS _loaded_at"""

cte("ship_raw", "SELECT " + _SHIP_COLS.format(vessel="'VESSEL ' || CAST(o_orderkey % 40 AS VARCHAR)",
                                              loaded="o_orderdate") + " FROM orders\nUNION ALL\nSELECT "
    + _SHIP_COLS.format(vessel="'VESSEL RELOAD'", loaded="o_orderdate + INTERVAL 1 DAY")
    + " FROM orders WHERE o_orderkey % 13 = 0")

cte("stg_ship", """
SELECT * EXCLUDE (rn) FROM (
  SELECT CAST(TRY_CAST(trim(sti_number) AS DOUBLE) AS BIGINT) AS sti, *,
    row_number() OVER (PARTITION BY CAST(TRY_CAST(trim(sti_number) AS DOUBLE) AS BIGINT)
                       ORDER BY _loaded_at DESC, vessel_name DESC) AS rn
  FROM ship_raw) WHERE rn = 1 AND sti IS NOT NULL""", ("ship_raw",))

q("stg_shipments", ("stg_ship",), "SELECT * FROM stg_ship")

q("fct_shipment_status", ("stg_ship", "fct"), f"""
SELECT sti_number, container_number, scac_code AS carrier,
  CASE WHEN actual_arrival_final_dest IS NOT NULL THEN '12. Delivered'
       WHEN actual_departure_dest_rail IS NOT NULL THEN '11. Outgate Destination Rail'
       WHEN actual_arrival_dest_rail IS NOT NULL THEN '10. Arrived Destination Rail'
       WHEN actual_outgate_pod IS NOT NULL THEN '9. Outgate POD'
       WHEN actual_arrival_pod IS NOT NULL THEN '7. Arrived POD'
       WHEN actual_departure_pol IS NOT NULL THEN '6. Departed POL'
       WHEN actual_arrival_pol IS NOT NULL THEN '5. Arrived POL'
       WHEN actual_departure_consol IS NOT NULL THEN '4. Outgate CFS'
       WHEN ship_date_from_supplier IS NOT NULL THEN '2. Departed Supplier'
  END AS status_of_container,
  pol, pod, s.vessel_name, eta, actual_arrival_pod, cbm, weight_kg,
  ship_date_from_supplier, actual_departure_consol, actual_arrival_pol, actual_departure_pol, actual_outgate_pod,
  actual_arrival_dest_rail, actual_departure_dest_rail, actual_arrival_final_dest,
  e.carrier AS tracking_carrier, e.status AS tracking_status, e.location AS tracking_location, e.event_timestamp AS tracking_time
FROM stg_ship s LEFT JOIN (
  SELECT container_number AS box, carrier, status, location, event_timestamp,
    row_number() OVER (PARTITION BY container_number ORDER BY event_timestamp DESC, ordinal DESC) AS rn
  FROM fct WHERE event_timestamp <= {AS_OF}) e ON s.container_number = e.box AND e.rn = 1""")

q("dim_containers", ("fct", "stg_ship"), """
SELECT g.container_number, g.carrier, g.vessel_name, p.pol, p.pod, g.latest_event_time, g.current_status
FROM (
  SELECT container_number, carrier, vessel_name, status AS current_status,
    max(event_timestamp) OVER (PARTITION BY container_number, carrier) AS latest_event_time,
    row_number() OVER (PARTITION BY container_number, carrier
                       ORDER BY event_timestamp DESC NULLS LAST, ordinal DESC) AS rn
  FROM fct) g
LEFT JOIN (
  SELECT container_number, pol, pod FROM (
    SELECT container_number, pol, pod,
      row_number() OVER (PARTITION BY container_number ORDER BY _loaded_at DESC, sti_number DESC) AS rn
    FROM stg_ship WHERE container_number IS NOT NULL) WHERE rn = 1) p
  ON g.container_number = p.container_number
WHERE g.rn = 1""")


# --------------------------------------------------------------- report
def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def nk(x: str) -> str:
    """Shipment id of a table column declared as an integer: kept plain."""
    return f"CAST({x} AS BIGINT)"


def dedupe(src: str, key: str, cols: str, keep: str = "last", ordinal: str = "ordinal") -> str:
    order = "DESC" if keep == "last" else "ASC"
    return (f"SELECT * EXCLUDE (rn_) FROM (SELECT {key} AS k, {cols}, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {ordinal} {order}) AS rn_ FROM {src} WHERE {key} IS NOT NULL) "
            f"WHERE rn_ = 1")


_CT = "[" + ", ".join("'" + c[0].replace("'", "''") + "'" for c in
                      __import__("quayside.config", fromlist=["x"]).CONTAINER_REF) + "]"
_CONSOL = "['528177112', '544931926', '543129368', '687767889']"

cte("it", f"""
SELECT l_orderkey AS sti, 'SID' || {s('l_orderkey')} AS shipment_id_number,
  'P' || {s('l_partkey')} AS part_number, CAST(l_quantity AS DOUBLE) AS quantity,
  ['LCL', 'lcl', 'FCL'][l_orderkey % 3 + 1] AS service_level,
  CASE WHEN l_orderkey % 10 > 0 AND l_orderkey % 7 <> 0 THEN l_shipdate END AS shipment_datetime,
  CASE WHEN l_orderkey % 10 = 9 AND (l_orderkey + 8) % 7 <> 0 THEN l_shipdate + INTERVAL 24 DAY END
    AS actual_arrival_final_dest
FROM lineitem""")

_Q3 = f"""
  o_orderkey AS sti, {{ordinal}} AS ordinal, {{origin}} AS origin_dun, {{so}} AS so,
  CAST(o_orderkey % 20 + 1 AS DOUBLE) AS number_of_packages,
  ['PALLET', 'CARTON', 'CRATE'][o_orderkey % 3 + 1] AS packaging_type,
  'PRN' || {s('o_orderkey')} AS prn, {{hbl}} AS hbl,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 8 = 1 THEN '' ELSE 'M' || {s('o_orderkey')} END AS mbl,
  'CONT' || lpad({s('o_custkey % 150')}, 7, '0') AS cont_id,
  CASE WHEN o_orderkey % 13 < 11 THEN {_CT}[o_orderkey % 13 + 1] ELSE 'Flat Rack' END AS cont_type,
  'BTC' || {s('o_custkey % 30')} AS btc,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 4000 AS DOUBLE) END AS vol1,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 4000 AS DOUBLE) * 10 END AS weight1,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST((o_custkey * 3) % 4000 AS DOUBLE) END AS vol2,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST((o_custkey * 3) % 4000 AS DOUBLE) * 10 END AS weight2,
  CASE WHEN o_orderkey % 6 < 4 THEN {_CONSOL}[o_orderkey % 6 + 1] ELSE '000000000' END AS consol_dun,
  {s('o_custkey')} AS dest_dun, 'MAN' || {s('o_orderkey % 1000')} AS manifest,
  {s('o_orderkey')} AS master_unitload_id, 'SC' || {s('o_custkey % 25')} AS scac_code,
  {{vessel}} AS vessel_name,
  CASE WHEN o_orderkey % 2 = 0 THEN 'DIRECT' ELSE 'TRANSSHIP' END AS path,
  CASE WHEN o_orderkey % 5 = 0 THEN 'LOC_' || {s('o_custkey % 50')} WHEN o_orderkey % 5 = 1 THEN '' END
    AS cca_location,
  {{lane}} AS lane_id"""

cte("q3", "SELECT " + _Q3.format(
    ordinal="o_orderkey * 2", origin=s("o_orderkey % 200"), so="'SO' || " + s("o_custkey"),
    hbl="'H' || " + s("o_orderkey % 500"), vessel="'VESSEL ' || " + s("o_orderkey % 40"),
    lane=f"CASE WHEN o_orderkey % 9 = 0 THEN '' WHEN o_orderkey % 4 = 0 THEN NULL "
         f"ELSE 'LANE' || {s('o_orderkey % 30')} END")
    + " FROM orders UNION ALL SELECT " + _Q3.format(
    ordinal="o_orderkey * 2 + 1", origin=s("(o_orderkey + 1) % 200"), so="CAST(NULL AS VARCHAR)",
    hbl="'H' || " + s("(o_orderkey + 7) % 500"), vessel="'VESSEL X'", lane="'LANE-DUP'")
    + " FROM orders WHERE o_orderkey % 13 = 0")

cte("loc", f"""
SELECT {s('c_custkey')} AS location_alias, c_name AS name, 'CITY_' || {s('c_nationkey')} AS city,
  c_mktsegment AS state,
  CASE WHEN c_nationkey % 3 = 0 THEN 'United States of America' ELSE n_name END AS country_name,
  c_custkey * 2 AS ordinal
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT {s('c_custkey')}, c_name || ' II', 'CITY_' || {s('c_nationkey')}, c_mktsegment,
  CASE WHEN c_nationkey % 3 = 0 THEN 'United States of America' ELSE n_name END, c_custkey * 2 + 1
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 100 = 0""")

cte("ccs", f"""
SELECT {s('c_custkey')} AS duns_number,
  CASE c_custkey % 16 WHEN 0 THEN 'CCA' WHEN 4 THEN ' CCA ' WHEN 8 THEN '' ELSE 'OTHER' END AS cca,
  'PLANT ' || c_name AS supplier_name, c_custkey AS ordinal
FROM customer WHERE c_custkey % 4 = 0""")

cte("io", f"SELECT 'BTC' || {s('s_suppkey % 30')} AS code, s_name AS supplier_name, s_suppkey AS ordinal FROM supplier")
cte("notes", f"SELECT 'SC' || {s('n_nationkey')} AS carrier_scac, n_name AS name, n_nationkey AS ordinal FROM nation")
cte("trl", f"""
SELECT o_orderkey AS lsc_tracking_number, 'TRL' || {s('o_orderkey % 300')} AS outbound_trailer,
  'TMS' || {s('o_orderkey')} AS outbound_tms, o_orderkey AS ordinal
FROM orders WHERE o_orderkey % 4 = 1""")
cte("yst", f"""
SELECT o_orderkey AS lsc_tracking_number,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderkey % 60 AS DOUBLE) + 0.5 END AS cbm,
  CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE CAST(o_custkey % 900 AS DOUBLE) * 10 END AS weight_kg,
  CASE WHEN o_orderkey % 12 = 0 THEN '' ELSE 'YLANE' || {s('o_orderkey % 17')} END AS lane_id,
  o_orderkey * 2 AS ordinal
FROM orders WHERE o_orderkey % 3 = 0
UNION ALL
SELECT o_orderkey, CAST(o_orderkey % 60 AS DOUBLE) + 1.5, 1.0, 'YLANE-B', o_orderkey * 2 + 1
FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 9 = 0""")
cte("csp", f"""
SELECT 'H' || {s('o_orderkey % 500')} AS hwb, CAST(o_orderkey % 50 AS DOUBLE) + 0.25 AS cubic_meters,
  CAST(o_orderkey % 700 AS DOUBLE) * 2 AS actual_wt_kgs,
  CASE WHEN o_orderkey % 46 = 0 THEN '' ELSE 'CLANE' || {s('o_orderkey % 23')} END AS lane_id,
  'CM' || {s('o_orderkey')} AS last_mb_number, o_orderkey AS ordinal
FROM orders WHERE o_orderkey % 2 = 0""")


def _q4(shift: int, ordinal: str, where: str) -> str:
    def sh(x):
        return f"{x} + INTERVAL {shift} DAY" if shift else x

    def exp(n):
        return f"o_orderdate + INTERVAL {n + shift} DAY"

    return f"""
SELECT CAST(o_orderkey AS DOUBLE) AS em_shipment_id,
  {sh(f"({_d(1)}) - INTERVAL 1 DAY")} AS arrived_at_consol_actual_date_time,
  {sh(_d(1))} AS departed_consol_actual_date_time,
  {sh(_d(2))} AS actual_date_of_arrival_to_the_origin_port,
  {exp(10)} AS expected_arrival_date_to_transshipment_port,
  {sh(f"({_d(3)}) + INTERVAL 1 DAY")} AS actual_arrival_date_to_transshipment_port,
  {exp(11)} AS expected_departure_date_from_transshipment_port,
  {sh(f"({_d(3)}) + INTERVAL 2 DAY")} AS actual_departure_date_from_transshipment_port,
  {exp(9)} AS expected_date_of_departure_from_origin_port,
  {sh(_d(3))} AS actual_date_of_departure_from_origin_port,
  {exp(12)} AS expected_date_of_arrival_to_destination_port,
  {sh(_d(4))} AS actual_date_of_arrival_to_destination_port,
  {exp(15)} AS expected_outgate_date_from_destination_port,
  {sh(_d(5))} AS actual_outgate_date_from_destination_port,
  {exp(18)} AS estimated_arrival_date_to_destination_rail_yard,
  {sh(_d(6))} AS actual_arrival_date_to_destination_rail_yard,
  {exp(21)} AS expected_departure_date_from_destination_rail_yard,
  {sh(_d(7))} AS actual_departure_from_dest_rail,
  'POL' || {s('o_orderkey % 9')} AS port_of_loading_code,
  'TS' || {s('o_orderkey % 5')} AS transshipment_port_name,
  'POD' || {s('o_orderkey % 11')} AS port_of_destination_code,
  {ordinal} AS ordinal
FROM orders WHERE {where}"""


cte("q4", _q4(0, "o_orderkey * 2", "o_orderkey % 5 <> 0") + "\nUNION ALL\n"
    + _q4(1, "o_orderkey * 2 + 1", "o_orderkey % 5 <> 0 AND o_orderkey % 25 = 1"))

_MS = ("arrived_at_consol_actual_date_time, departed_consol_actual_date_time, "
       "actual_date_of_arrival_to_the_origin_port, expected_arrival_date_to_transshipment_port, "
       "actual_arrival_date_to_transshipment_port, expected_departure_date_from_transshipment_port, "
       "actual_departure_date_from_transshipment_port, expected_date_of_departure_from_origin_port, "
       "actual_date_of_departure_from_origin_port, expected_date_of_arrival_to_destination_port, "
       "actual_date_of_arrival_to_destination_port, expected_outgate_date_from_destination_port, "
       "actual_outgate_date_from_destination_port, estimated_arrival_date_to_destination_rail_yard, "
       "actual_arrival_date_to_destination_rail_yard, expected_departure_date_from_destination_rail_yard, "
       "actual_departure_from_dest_rail, port_of_loading_code, transshipment_port_name, port_of_destination_code")

cte("q3l", dedupe("q3", nk("sti"), "origin_dun, so, manifest, master_unitload_id, scac_code, vessel_name, path, "
                  "number_of_packages, packaging_type, prn, hbl, mbl, cont_id, cont_type, btc, vol1, weight1, "
                  "vol2, weight2, consol_dun, dest_dun, cca_location", "last"), ("q3",))
cte("q3f", dedupe("q3", nk("sti"), "lane_id", "first"), ("q3",))
cte("locl", dedupe("loc", "location_alias", "name, city, state, country_name", "last"), ("loc",))
cte("ccal", dedupe("ccs", "duns_number", "cca, supplier_name", "last"), ("ccs",))
cte("iol", dedupe("io", "code", "supplier_name", "last"), ("io",))
cte("notesl", dedupe("notes", "carrier_scac", "name", "last"), ("notes",))
cte("trll", dedupe("trl", nk("lsc_tracking_number"), "outbound_trailer, outbound_tms", "last"), ("trl",))
cte("ystf", dedupe("yst", nk("lsc_tracking_number"), "cbm, weight_kg, lane_id", "first"), ("yst",))
cte("cspf", dedupe("csp", "hwb", "cubic_meters, actual_wt_kgs, lane_id, last_mb_number", "first"), ("csp",))
cte("q4f", dedupe("q4", nk("em_shipment_id"), _MS, "first"), ("q4",))

_CREF = " UNION ALL ".join(
    f"SELECT '{t.replace(chr(39), chr(39) * 2)}' AS container_type, CAST({c} AS DOUBLE) AS max_cbm, "
    f"CAST({w} AS DOUBLE) AS max_weight"
    for t, c, w in __import__("quayside.config", fromlist=["x"]).CONTAINER_REF)
cte("cref", _CREF)
cte("consol", " UNION ALL ".join(
    f"SELECT '{d}' AS origin_consol_duns, '{n}' AS origin_consol"
    for d, n in __import__("quayside.config", fromlist=["x"]).ORIGIN_CONSOL))

cte("rep0", f"""
SELECT {nk('it.sti')} AS lsc_tracking_number, 'CEVV' AS lsc, 'NO' AS specialized_transport,
  it.shipment_id_number AS sid_number, it.part_number, it.quantity, it.service_level,
  it.shipment_datetime AS ship_date_from_supplier, 'OCEAN' AS mode, 'MGOB' AS provider_lane_id,
  it.actual_arrival_final_dest,
  q3l.origin_dun AS supplier_duns, q3l.so AS so_number, q3l.manifest, q3l.master_unitload_id AS mti,
  q3l.scac_code AS steamship_line_scac, q3l.vessel_name, q3l.path, q3l.number_of_packages,
  q3l.packaging_type, q3l.prn AS prn_number, q3l.hbl AS hbol, q3l.mbl AS mbol_q3, q3l.cont_id AS container_number,
  q3l.cont_type AS container_type, q3l.btc AS bill_to_code, q3l.vol1, q3l.weight1, q3l.vol2, q3l.weight2,
  q3l.consol_dun AS origin_consol_duns, q3l.dest_dun, q3l.cca_location AS q3_cca_location,
  q3f.lane_id AS q3_lane_id,
  trll.outbound_trailer, trll.outbound_tms,
  q4f.* EXCLUDE (k),
  ystf.cbm AS yesterday_cbm, ystf.weight_kg AS yesterday_weight_kg, ystf.lane_id AS yesterday_lane_id
FROM it
LEFT JOIN q3l ON q3l.k = {nk('it.sti')}
LEFT JOIN q3f ON q3f.k = {nk('it.sti')}
LEFT JOIN trll ON trll.k = {nk('it.sti')}
LEFT JOIN q4f ON q4f.k = {nk('it.sti')}
LEFT JOIN ystf ON ystf.k = {nk('it.sti')}""", ("it", "q3l", "q3f", "trll", "q4f", "ystf"))

cte("rep1", """
SELECT r.*, notesl.name AS steamship_line,
  ls.name AS supplier_name, ls.city AS origin_supplier_city, ls.state AS origin_supplier_province,
  ls.country_name AS origin_supplier_country, ld.country_name AS dest_country, c1.cca
FROM rep0 r
LEFT JOIN notesl ON notesl.k = r.steamship_line_scac
LEFT JOIN locl ls ON ls.k = r.supplier_duns
LEFT JOIN locl ld ON ld.k = r.dest_dun
LEFT JOIN ccal c1 ON c1.k = r.dest_dun""", ("rep0", "notesl", "locl", "ccal"))

cte("rep2", """
SELECT *, CASE WHEN cca = 'CCA' AND upper(service_level) = 'LCL'
                AND upper(dest_country) = 'UNITED STATES OF AMERICA' THEN '101452410' ELSE dest_dun END
  AS destination_duns
FROM rep1""", ("rep1",))

cte("rep3", f"""
SELECT r.*, lf.name AS final_delivery_location_name, lf.city AS destination_city,
  lf.state AS destination_state, lf.country_name AS destination_country,
  iol.supplier_name AS io_name, c2.supplier_name AS cca_plant_name,
  cspf.cubic_meters AS csp_cbm, cspf.actual_wt_kgs AS csp_weight_kg, cspf.lane_id AS csp_lane_id,
  cspf.last_mb_number AS csp_mbol, cref.max_cbm, cref.max_weight, consol.origin_consol
FROM rep2 r
LEFT JOIN locl lf ON lf.k = r.destination_duns
LEFT JOIN iol ON iol.k = r.bill_to_code
LEFT JOIN ccal c2 ON c2.k = r.destination_duns
LEFT JOIN cspf ON cspf.k = r.hbol
LEFT JOIN cref ON cref.container_type = r.container_type
LEFT JOIN consol ON consol.origin_consol_duns = r.origin_consol_duns""",
    ("rep2", "locl", "iol", "ccal", "cspf", "cref", "consol"))

cte("rep", f"""
SELECT *,
  coalesce(CASE WHEN coalesce({trim_ws('cca')}, '') = '' THEN io_name
                WHEN {trim_ws('cca')} = 'CCA' THEN
                  CASE WHEN coalesce({trim_ws('q3_cca_location')}, '') <> '' THEN q3_cca_location
                       WHEN destination_duns = '101452410' THEN 'UNIVERSAL PONTIAC CROSS DOCK'
                       ELSE cca_plant_name END END, '') AS plant_name,
  coalesce(yesterday_cbm,
           CASE WHEN least(vol1, vol2) * CAST(0.02831685 AS DOUBLE) <= max_cbm
                THEN least(vol1, vol2) * CAST(0.02831685 AS DOUBLE) END, csp_cbm) AS cbm,
  coalesce(yesterday_weight_kg,
           CASE WHEN least(weight1, weight2) * CAST(0.45359237 AS DOUBLE) <= max_weight
                THEN least(weight1, weight2) * CAST(0.45359237 AS DOUBLE) END, csp_weight_kg) AS weight_in_kg,
  coalesce(nullif(yesterday_lane_id, ''), nullif(q3_lane_id, ''), nullif(csp_lane_id, '')) AS ocean_or_air_lane_id,
  nullif(coalesce(mbol_q3, csp_mbol), '') AS mbol,
  CASE WHEN actual_arrival_final_dest IS NOT NULL THEN '12. Delivered'
       WHEN actual_departure_from_dest_rail IS NOT NULL THEN '11. Outgate Destination Rail'
       WHEN actual_arrival_date_to_destination_rail_yard IS NOT NULL THEN '10. Arrived Destination Rail'
       WHEN actual_outgate_date_from_destination_port IS NOT NULL THEN '9. Outgate POD'
       WHEN actual_date_of_arrival_to_destination_port IS NOT NULL THEN '7. Arrived POD'
       WHEN actual_date_of_departure_from_origin_port IS NOT NULL THEN '6. Departed POL'
       WHEN actual_date_of_arrival_to_the_origin_port IS NOT NULL THEN '5. Arrived POL'
       WHEN departed_consol_actual_date_time IS NOT NULL THEN '4. Outgate CFS'
       WHEN ship_date_from_supplier IS NOT NULL THEN '2. Departed Supplier' END AS status_of_container
FROM rep3""", ("rep3",))

_K = "lsc_tracking_number"
q("base_fields", ("rep0",), f"""SELECT {_K}, lsc, specialized_transport, sid_number, part_number, quantity,
  service_level, ship_date_from_supplier, mode, provider_lane_id FROM rep0""")
q("lookup_last", ("rep",), f"""SELECT {_K}, supplier_duns, so_number, manifest, mti, steamship_line_scac,
  vessel_name, path, number_of_packages, packaging_type, prn_number, hbol, mbol_q3 AS mbol, container_number,
  container_type, bill_to_code, vol1, weight1, vol2, weight2, origin_consol_duns, dest_dun, steamship_line,
  outbound_trailer, outbound_tms FROM rep""")
q("lookup_first", ("rep",), f"""SELECT {_K}, hbol, yesterday_cbm, yesterday_weight_kg, yesterday_lane_id,
  q3_lane_id, csp_cbm, csp_weight_kg, csp_lane_id, csp_mbol FROM rep""")
q("role_locations", ("rep",), f"""SELECT {_K}, supplier_duns, supplier_name, origin_supplier_city,
  origin_supplier_province, origin_supplier_country, dest_dun, dest_country, destination_duns,
  final_delivery_location_name, destination_city, destination_state, destination_country FROM rep""")
q("destination_duns", ("rep",), f"SELECT {_K}, cca, service_level, dest_country, dest_dun, destination_duns FROM rep")
q("plant_name", ("rep",), f"SELECT {_K}, cca, bill_to_code, destination_duns, plant_name FROM rep")
q("container_ref", ("rep",), f"SELECT {_K}, container_type, max_cbm, max_weight FROM rep")
q("origin_consol_name", ("rep",), f"SELECT {_K}, origin_consol_duns, origin_consol FROM rep")
q("milestone_merge", ("rep",), f"SELECT {_K}, {_MS} FROM rep")
q("cbm_fill", ("rep",), f"SELECT {_K}, cbm FROM rep")
q("weight_fill", ("rep",), f"SELECT {_K}, weight_in_kg FROM rep")
q("lane_fill", ("rep",), f"SELECT {_K}, ocean_or_air_lane_id FROM rep")
q("mbol_fill", ("rep",), f"SELECT {_K}, mbol FROM rep")
q("shipment_status", ("rep",), f"SELECT {_K}, status_of_container FROM rep")
q("master_report", ("rep",), f"""SELECT {_K}, lsc, specialized_transport, sid_number, part_number, quantity,
  service_level, ship_date_from_supplier, mode, provider_lane_id, supplier_duns, so_number, manifest, mti,
  steamship_line_scac, vessel_name, path, number_of_packages, packaging_type, supplier_name,
  origin_supplier_city, origin_supplier_province, origin_supplier_country, prn_number, hbol, mbol,
  container_number, container_type, bill_to_code, vol1, weight1, vol2, weight2, origin_consol_duns,
  dest_dun, dest_country, cca, steamship_line, outbound_trailer, outbound_tms, {_MS},
  actual_arrival_final_dest, destination_duns, final_delivery_location_name, destination_city,
  destination_state, destination_country, plant_name, cbm, weight_in_kg, ocean_or_air_lane_id,
  origin_consol, status_of_container FROM rep""")
SQL["report_export"] = SQL["master_report"]
q("dim_suppliers", ("locl", "q3"), """SELECT k AS location_alias, name, city, state, country_name FROM locl
WHERE k IN (SELECT origin_dun FROM q3)""")

_NUM = "CAST(id_number AS DOUBLE)"
_TXT0 = trim_ws("id_text")
_TXT = (f"CASE WHEN regexp_matches({_TXT0}, '^[+-]?\\d+(_\\d+)*(\\.(\\d+(_\\d+)*)?)?$') "
        f"THEN replace({_TXT0}, '_', '') ELSE {_TXT0} END")
q("normalize_id", (), f"""
SELECT o_orderkey,
  CASE WHEN {_NUM} > 20000 AND {_NUM} < 90000 THEN CAST(strftime(DATE '1899-12-30' +
    CAST(floor({_NUM}) AS INTEGER), '%Y%m%d') AS DOUBLE) ELSE {_NUM} END AS from_number,
  CASE WHEN regexp_matches({_TXT}, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$')
       THEN TRY_CAST({_TXT} AS DOUBLE) END AS from_text,
  CAST(strftime(o_orderdate, '%Y%m%d') AS DOUBLE) AS from_timestamp
FROM (SELECT o_orderkey, o_orderdate,
  CASE o_orderkey % 10 WHEN 0 THEN 20000.0 WHEN 1 THEN 90000.0 WHEN 2 THEN CAST(45000 + o_orderkey % 1000 AS DOUBLE)
    WHEN 3 THEN NULL WHEN 4 THEN 45000.75 ELSE CAST(o_orderkey AS DOUBLE) END AS id_number,
  CASE o_orderkey % 8 WHEN 0 THEN '45000' WHEN 1 THEN ' 12 ' WHEN 2 THEN 'abc' WHEN 3 THEN NULL
    WHEN 4 THEN '1_000' WHEN 5 THEN '1e3' WHEN 6 THEN '1d' ELSE CAST(o_orderkey AS VARCHAR) END AS id_text
  FROM orders)""")


# ------------------------------------------------------------------ TMS
cte("es", f"""
SELECT o_orderkey AS em_shipment_id, 'SID' || {s('o_orderkey')} AS shipment_id_number,
  CAST(o_orderkey % 20 + 1 AS BIGINT) AS shipment_pieces, {s('o_orderkey % 200')} AS ultimate_origin_alias,
  {s('o_custkey')} AS ultimate_dest_alias,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 4000 AS DOUBLE) END AS shipment_cube,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 4000 AS DOUBLE) * 10 END AS shipment_weight,
  CAST(CASE WHEN o_orderstatus IN ('O', 'P') THEN 100000 ELSE 100002 END AS BIGINT) AS current_state_type_id
FROM orders""")
cte("srefs", f"""
SELECT o_orderkey AS em_shipment_id, CAST(100033 AS BIGINT) AS reference_type_id, o_orderpriority AS reference_number FROM orders
UNION ALL SELECT o_orderkey, 100033, o_orderpriority || '/ALT' FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT o_orderkey, 100265, 'LOC_' || {s('o_custkey % 50')} FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, 100318, 'PRN' || {s('o_orderkey')} FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT o_orderkey, 100742, 'SO' || {s('o_custkey')} FROM orders WHERE o_orderkey % 2 = 0""")
cte("ulrefs", f"""
SELECT l_orderkey AS master_unitload_id,
  CAST([100000, 100006, 100183, 100352][l_linenumber % 4 + 1] AS BIGINT) AS reference_type_id,
  {s('l_partkey')} AS reference_number FROM lineitem""")
cte("oms", """
SELECT l_orderkey AS em_shipment_id, l_orderkey AS master_unitload_id, l_suppkey AS location_entity_id,
  CAST(CASE WHEN l_linenumber = 1 THEN 100001 ELSE 100002 END AS BIGINT) AS operational_milestone_type_id
FROM lineitem""")
cte("cassn", "SELECT o_orderkey AS master_unitload_id, o_custkey AS container_attributes_id FROM orders")
cte("cattr", f"""
SELECT p_partkey AS container_attributes_id, 'CONT' || lpad({s('p_partkey % 150')}, 7, '0') AS conveyance_id_number,
  CASE WHEN p_partkey % 13 < 11 THEN {_CT}[p_partkey % 13 + 1] ELSE 'Flat Rack' END AS conveyance_type_desc,
  CAST(p_size * 100 AS DOUBLE) AS conveyance_cube, CAST(p_size * 250 AS DOUBLE) AS conveyance_weight
FROM part""")
cte("sdoc", "SELECT o_orderkey AS status_doc_id, o_orderkey AS master_unitload_id FROM orders WHERE o_orderkey % 3 <> 0")
cte("sdocref", f"""
SELECT o_orderkey AS status_doc_id, CAST(100794 AS BIGINT) AS reference_type_id,
  'LANE' || {s('o_orderkey % 30')} AS reference_number FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT o_orderkey, 100795, 'OTHER' FROM orders WHERE o_orderkey % 3 <> 0""")
cte("oassn", "SELECT o_orderkey AS em_shipment_id, o_orderkey AS order_id FROM orders")
cte("opkg", f"SELECT l_orderkey AS order_id, 'PKG' || {s('l_linenumber % 3')} AS package_id_number FROM lineitem")
cte("lent", f"""
SELECT s_suppkey AS entity_id,
  CASE WHEN s_suppkey % 6 < 4 THEN {_CONSOL}[s_suppkey % 6 + 1] ELSE {s('s_suppkey')} END AS location_alias
FROM supplier""")

q("eav_references", ("es", "srefs"), """
SELECT es.em_shipment_id, p.mode, p.cca_location, p.prn, p.so FROM es LEFT JOIN (
  SELECT em_shipment_id,
    max(reference_number) FILTER (WHERE reference_type_id = 100033) AS mode,
    max(reference_number) FILTER (WHERE reference_type_id = 100265) AS cca_location,
    max(reference_number) FILTER (WHERE reference_type_id = 100318) AS prn,
    max(reference_number) FILTER (WHERE reference_type_id = 100742) AS so
  FROM srefs WHERE reference_type_id IN (100033, 100265, 100318, 100742) GROUP BY em_shipment_id) p
ON es.em_shipment_id = p.em_shipment_id""")

cte("mblp", """
SELECT master_unitload_id, reference_type_id AS mbl_type_id, reference_number AS mbl FROM (
  SELECT *, row_number() OVER (PARTITION BY master_unitload_id ORDER BY
    CASE WHEN reference_type_id = 100000 THEN 1 WHEN reference_type_id = 100006 THEN 2
         WHEN reference_type_id = 100183 THEN 3 ELSE 4 END, reference_number) AS rn
  FROM ulrefs WHERE reference_type_id IN (100000, 100006, 100183)) WHERE rn = 1""", ("ulrefs",))
q("mbl_priority", ("mblp",), "SELECT * FROM mblp")

q("consol_dun", ("oms", "lent"), """
SELECT E5.em_shipment_id, E5.master_unitload_id, E5.location_entity_id, E5.operational_milestone_type_id,
  L.location_alias AS consol_dun
FROM oms E5 LEFT JOIN lent L ON L.entity_id = E5.location_entity_id
  AND E5.operational_milestone_type_id = 100001
  AND L.location_alias IN ('528177112', '544931926', '543129368', '687767889')""")

q("sti_semi_join", ("es", "it"), """
SELECT em_shipment_id, shipment_id_number, current_state_type_id FROM es
WHERE em_shipment_id IN (SELECT sti FROM it)""")

q("tms_extract", ("es", "srefs", "oms", "ulrefs", "mblp", "cassn", "cattr", "sdoc", "sdocref", "oassn", "opkg",
                  "lent", "it"), """
SELECT DISTINCT
  ES.em_shipment_id AS sti, ES.shipment_id_number, ES.shipment_pieces AS number_of_packages,
  ES.ultimate_origin_alias AS origin_dun, ES.ultimate_dest_alias AS dest_dun,
  E1.reference_number AS mode, E2.reference_number AS cca_location, E3.reference_number AS prn,
  E4.reference_number AS so, U.reference_number AS hbl, U2.mbl AS mbl,
  C.conveyance_id_number AS cont_id, C.conveyance_type_desc AS cont_type, S.reference_number AS lane_id,
  ES.shipment_cube AS vol1, ES.shipment_weight AS weight1, C.conveyance_cube AS vol2, C.conveyance_weight AS weight2,
  OP.package_id_number AS packaging_type, L.location_alias AS consol_dun
FROM es ES
LEFT JOIN srefs E1 ON E1.em_shipment_id = ES.em_shipment_id AND E1.reference_type_id = 100033
LEFT JOIN srefs E2 ON E2.em_shipment_id = ES.em_shipment_id AND E2.reference_type_id = 100265
LEFT JOIN srefs E3 ON E3.em_shipment_id = ES.em_shipment_id AND E3.reference_type_id = 100318
LEFT JOIN srefs E4 ON E4.em_shipment_id = ES.em_shipment_id AND E4.reference_type_id = 100742
LEFT JOIN oms E5 ON E5.em_shipment_id = ES.em_shipment_id
LEFT JOIN ulrefs U ON U.master_unitload_id = E5.master_unitload_id AND U.reference_type_id = 100352
LEFT JOIN mblp U2 ON U2.master_unitload_id = E5.master_unitload_id
LEFT JOIN cassn V ON V.master_unitload_id = E5.master_unitload_id
LEFT JOIN cattr C ON C.container_attributes_id = V.container_attributes_id
LEFT JOIN sdoc T ON T.master_unitload_id = E5.master_unitload_id
LEFT JOIN sdocref S ON S.status_doc_id = T.status_doc_id AND S.reference_type_id = 100794
LEFT JOIN oassn E6 ON E6.em_shipment_id = ES.em_shipment_id
LEFT JOIN opkg OP ON OP.order_id = E6.order_id
LEFT JOIN lent L ON L.entity_id = E5.location_entity_id AND E5.operational_milestone_type_id = 100001
  AND L.location_alias IN ('528177112', '544931926', '543129368', '687767889')
WHERE ES.current_state_type_id = 100000 AND ES.em_shipment_id IN (SELECT sti FROM it)""")


# ------------------------------------------------ ingest, upsert, files
_ID = (f"coalesce({trim_ws('container_number')}, '') || '|' || coalesce({trim_ws('status')}, '') || '|' || "
       f"coalesce({trim_ws('date')}, '') || '|' || coalesce({trim_ws('time')}, '')")
T1 = "TIMESTAMP '2024-01-19 00:00:00'"
cte("ev", f"SELECT carrier, {_ID} AS _id, ordinal, container_number, status, place, date, time, transport FROM trk",
    ("trk",))
cte("tgt", f"SELECT *, {T1} AS last_updated, ordinal * 2 AS seq FROM ev WHERE ordinal % 3 <> 0", ("ev",))
_SENT = "(ordinal % 4 < 2 OR ordinal % 3 = 0)"
cte("bat", f"""
SELECT *, {AS_OF} AS last_updated, ordinal * 2 AS seq FROM ev WHERE {_SENT}
UNION ALL
SELECT carrier, _id, ordinal, container_number, status, place, date, time,
  CASE WHEN ordinal % 20 < 2 THEN transport || ' (resent)' ELSE transport END,
  {AS_OF}, ordinal * 2 + 1 FROM ev WHERE {_SENT} AND (ordinal % 20 < 2 OR ordinal % 20 = 4)""", ("ev",))
cte("ups", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY carrier, _id ORDER BY last_updated DESC, seq DESC) AS rn
  FROM (SELECT * FROM tgt UNION ALL SELECT * FROM bat)) WHERE rn = 1""", ("tgt", "bat"))

q("event_upsert", ("ups",), "SELECT * EXCLUDE (seq) FROM ups")
q("stream_upsert", ("ups",), "SELECT * EXCLUDE (seq) FROM ups")
q("incremental_read", ("ups",), f"SELECT * EXCLUDE (seq) FROM ups WHERE last_updated > {T1}")
q("upsert_metrics", ("tgt", "bat"), """
, per AS (
  SELECT b.carrier, b._id, b.n, b.contents, t._id IS NULL AS is_new FROM (
    SELECT carrier, _id, count(*) AS n,
      count(DISTINCT (ordinal, container_number, status, place, date, time, transport)) AS contents
    FROM bat GROUP BY carrier, _id) b
  LEFT JOIN (SELECT DISTINCT carrier, _id FROM tgt) t ON b.carrier = t.carrier AND b._id = t._id)
SELECT carrier, count(*) FILTER (WHERE is_new) AS inserted,
  CAST(sum(contents) - count(*) FILTER (WHERE is_new) AS BIGINT) AS updated,
  CAST(sum(n) AS BIGINT) AS total_processed, CAST(0 AS BIGINT) AS failed
FROM per GROUP BY carrier""")
q("raw_append", ("tgt", "bat"), f"""
SELECT * EXCLUDE (last_updated), {T1} AS _loaded_at FROM tgt
UNION ALL SELECT * EXCLUDE (last_updated), {AS_OF} AS _loaded_at FROM bat""")

q("watchlist_scan", ("watch",), """
SELECT 'HLCU' AS carrier, ordinal, container_number FROM watch WHERE container_number IS NOT NULL
UNION ALL SELECT 'MAEU', ordinal, container_number FROM watch""")

q("payload_build", ("trk",), "SELECT carrier, scraped_at, count(*) AS total_events FROM trk GROUP BY carrier, scraped_at")
_PAYLOAD = f"""
SELECT carrier, scraped_at, row_number() OVER (PARTITION BY carrier, scraped_at ORDER BY ordinal) - 1 AS ordinal,
  container_number, container_number || coalesce(status, '') || part || '{C.CURRENT}' AS concat_1,
  container_number || coalesce(status, '') || part AS concat_2, container_number || '{C.CURRENT}' AS concat_3,
  status, date, time
FROM (SELECT *, CASE WHEN carrier = '{C.HLCU}' THEN {_HPART} ELSE '' END AS part FROM trk)"""
q("payload_explode", ("trk",), _PAYLOAD)
q("payload_round_trip", ("trk",), f"SELECT * FROM ({_PAYLOAD}) p WHERE scraped_at = (SELECT max(scraped_at) FROM trk WHERE trk.carrier = p.carrier)")
q("stream_ingest", ("trk",), "SELECT carrier, scraped_at, ordinal, container_number, status, date, time FROM trk")

q("dq_payload", ("trk",), f"""
, env AS (SELECT carrier, scraped_at, scrape_day, count(*) AS n FROM trk GROUP BY carrier, scraped_at, scrape_day)
, chk AS (
  SELECT CASE WHEN carrier = '{C.MAEU}' AND scrape_day % 11 = 0 THEN 'missing_field'
              WHEN scrape_day % 5 = 0 THEN 'count_mismatch' ELSE 'ok' END AS check_name, n FROM env
  UNION ALL
  SELECT 'corrupt_json', 0 FROM (SELECT DISTINCT scraped_at FROM trk WHERE carrier = '{C.HLCU}' AND scrape_day % 7 = 0))
SELECT check_name, count(*) AS n_payloads, CAST(sum(n) AS BIGINT) AS n_records FROM chk GROUP BY check_name""")

_NAMES = {c["carrier"]: c["pattern"].split("*") for c in C.CARRIER_FILES}
q("latest_file_per_carrier", ("trk",), f"""
SELECT carrier, CASE carrier WHEN '{C.HLCU}' THEN '{_NAMES[C.HLCU][0]}' ELSE '{_NAMES[C.MAEU][0]}' END
  || max(scraped_at) || '.json' AS file_name
FROM trk GROUP BY carrier""")

_TD = "'<td> ' || coalesce({c}, '') || ' </td>'"
q("extract_table_rows", ("trk",), f"""
, pg AS (
  SELECT CAST(floor(ordinal / 8) AS BIGINT) AS page_id,
    '<html><body><table>' || string_agg('<tr>' || {_TD.format(c='status')} || {_TD.format(c='place')} ||
      {_TD.format(c='date')} || {_TD.format(c='time')} ||
      CASE WHEN ordinal % 13 = 0 THEN '' ELSE {_TD.format(c='transport')} END || '</tr>', '' ORDER BY ordinal)
      || '</table></body></html>' AS html
  FROM trk WHERE carrier = 'HLCU' GROUP BY 1)
, r AS (SELECT page_id, unnest(l) AS tr, unnest(range(len(l))) AS row_no
        FROM (SELECT page_id, regexp_extract_all(html, '(?s)<tr(?:\\s[^>]*)?>(.*?)</tr>', 1) AS l FROM pg))
, c AS (SELECT page_id, row_no, regexp_extract_all(tr, '(?s)<td(?:\\s[^>]*)?>(.*?)</td>', 1) AS cells FROM r)
SELECT page_id, CAST(row_no AS BIGINT) AS row_no, {trim_ws('cells[1]')} AS status,
  {trim_ws('cells[2]')} AS place_of_activity, {trim_ws('cells[3]')} AS date, {trim_ws('cells[4]')} AS time,
  {trim_ws('cells[5]')} AS transport
FROM c WHERE len(cells) >= 5""")

q("extract_list_cards", (), f"""
SELECT page_id, item_no, raw_data, CAST(len(string_split(raw_data, chr(10))) AS BIGINT) AS n_parts FROM (
  SELECT page_id, CAST(item_no AS BIGINT) AS item_no,
    {trim_ws("regexp_replace(li, '<[^>]*>', '', 'g')")} AS raw_data
  FROM (SELECT page_id, unnest(l) AS li, unnest(range(len(l))) AS item_no
        FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1) AS l FROM pages)))
WHERE raw_data <> ''""")

# ---------------------------------------------------------------- quality
q("dq_duplicate_events", ("hexp", "trk"), """
SELECT carrier, container_number, status, event_timestamp, count(*) AS n_events FROM (
  SELECT 'HLCU' AS carrier, container_number, status, event_ts AS event_timestamp FROM hexp
  UNION ALL
  SELECT 'MAEU', container_number, status, try_strptime(date || ' ' || time, '%d %b %Y %H:%M') FROM trk
  WHERE carrier = 'MAEU')
WHERE status IS NOT NULL
GROUP BY carrier, container_number, status, event_timestamp HAVING count(*) > 1""")

q("dq_tracking_types", ("fct",), """
SELECT carrier, type_of_tracking,
  coalesce(type_of_tracking IN ('Historic Tracking', 'Current Tracking', 'Future Tracking'), false) AS accepted,
  count(*) AS n_events
FROM fct GROUP BY carrier, type_of_tracking""")

q("dq_required_columns", ("hexp", "mexp", "cards"), """
SELECT 'hlcu_export' AS source, 'container_number' AS column_name, true AS present, count(*) AS n_rows, count(*) FILTER (WHERE coalesce(regexp_replace(container_number, '^\\s+|\\s+$', '', 'g'), '') = '') AS n_missing FROM hexp
UNION ALL
SELECT 'hlcu_export' AS source, 'status' AS column_name, true AS present, count(*) AS n_rows, count(*) FILTER (WHERE coalesce(regexp_replace(status, '^\\s+|\\s+$', '', 'g'), '') = '') AS n_missing FROM hexp
UNION ALL
SELECT 'hlcu_export' AS source, 'date' AS column_name, true AS present, count(*) AS n_rows, count(*) FILTER (WHERE coalesce(regexp_replace(date, '^\\s+|\\s+$', '', 'g'), '') = '') AS n_missing FROM hexp
UNION ALL
SELECT 'hlcu_export' AS source, 'time' AS column_name, true AS present, count(*) AS n_rows, count(*) FILTER (WHERE coalesce(regexp_replace(time, '^\\s+|\\s+$', '', 'g'), '') = '') AS n_missing FROM hexp
UNION ALL
SELECT 'maeu_export' AS source, 'container_number' AS column_name, true AS present, count(*) AS n_rows, count(*) FILTER (WHERE coalesce(regexp_replace(container_number, '^\\s+|\\s+$', '', 'g'), '') = '') AS n_missing FROM mexp
UNION ALL
SELECT 'maeu_export' AS source, 'status' AS column_name, true AS present, count(*) AS n_rows, count(*) FILTER (WHERE coalesce(regexp_replace(status, '^\\s+|\\s+$', '', 'g'), '') = '') AS n_missing FROM mexp
UNION ALL
SELECT 'maeu_export' AS source, 'date' AS column_name, true AS present, count(*) AS n_rows, count(*) FILTER (WHERE coalesce(regexp_replace(date, '^\\s+|\\s+$', '', 'g'), '') = '') AS n_missing FROM mexp
UNION ALL
SELECT 'maeu_export' AS source, 'time' AS column_name, true AS present, count(*) AS n_rows, count(*) FILTER (WHERE coalesce(regexp_replace(time, '^\\s+|\\s+$', '', 'g'), '') = '') AS n_missing FROM mexp
UNION ALL
SELECT 'tracking_cards', 'container_number', true, count(*), count(*) FILTER (WHERE coalesce(regexp_replace(container_number, '^\\s+|\\s+$', '', 'g'), '') = '') FROM cards
UNION ALL
SELECT 'tracking_cards', 'status', false, count(*), count(*) FROM cards
UNION ALL
SELECT 'tracking_cards', 'date', false, count(*), count(*) FROM cards
UNION ALL
SELECT 'tracking_cards', 'time', false, count(*), count(*) FROM cards""")

