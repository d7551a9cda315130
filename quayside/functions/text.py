"""String column functions (all JVM-side, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside import config as C


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Strip leading/trailing whitespace of any kind (like Python str.strip).

    Spark's trim/btrim only remove spaces, so tabs and newlines need a regex.
    """
    return F.regexp_replace(col_(c), r"^\s+|\s+$", "")


def is_blank(c) -> Column:
    """Null, or nothing but whitespace."""
    return F.coalesce(trim_ws(c), F.lit("")) == ""


def null_if_empty(c) -> Column:
    """'' -> null, everything else unchanged."""
    return F.nullif(col_(c), F.lit(""))


def composite_id(*cols) -> Column:
    """Pipe-joined key of stripped values; missing parts become ''.

    concat_ws silently drops nulls, so each part is coalesced first to keep
    the field positions stable.
    """
    return F.concat_ws("|", *[F.coalesce(trim_ws(c), F.lit("")) for c in cols])


def _s(c) -> Column:
    return F.coalesce(col_(c), F.lit(""))


def hlcu_transport_part(status, transport) -> Column:
    """Transport text, only for arrival/departure statuses (case-sensitive)."""
    cond = None
    for s in C.TRANSPORT_STATUSES:
        term = _s(status).contains(s)
        cond = term if cond is None else (cond | term)
    return F.when(cond, _s(transport)).otherwise(F.lit(""))


def concat_keys_hlcu(container, status, transport, tracking_type) -> dict[str, Column]:
    part = hlcu_transport_part(status, transport)
    return {
        "concat_1": F.concat(_s(container), _s(status), part, _s(tracking_type)),
        "concat_2": F.concat(_s(container), _s(status), part),
        "concat_3": F.concat(_s(container), _s(tracking_type)),
    }


def concat_keys_maeu(container, status, tracking_type) -> dict[str, Column]:
    return {
        "concat_1": F.concat(_s(container), _s(status), _s(tracking_type)),
        "concat_2": F.concat(_s(container), _s(status)),
        "concat_3": F.concat(_s(container), _s(tracking_type)),
    }


def status_keyword_regex() -> str:
    """Case-insensitive substring test for any status keyword."""
    import re

    return "(?i)(" + "|".join(re.escape(k) for k in C.STATUS_KEYWORDS) + ")"


def is_card_datetime(c) -> Column:
    return F.coalesce(col_(c).rlike(C.CARD_DATETIME_PATTERN), F.lit(False))


def is_card_status(c) -> Column:
    return F.coalesce(col_(c).rlike(status_keyword_regex()), F.lit(False))


def extract_vessel(status) -> dict[str, Column]:
    """Split a vessel-bearing status into (clean status, vessel name).

    Statuses that match none of the patterns are returned unchanged with an
    empty vessel name.
    """
    s = trim_ws(status)
    clean = None
    vessel = None
    for pattern, canonical in C.VESSEL_PATTERNS:
        hit = s.rlike(pattern)
        name = trim_ws(F.regexp_extract(s, pattern, 1))
        clean = F.when(hit, F.lit(canonical)) if clean is None else clean.when(hit, F.lit(canonical))
        vessel = F.when(hit, name) if vessel is None else vessel.when(hit, name)
    blank = F.coalesce(col_(status), F.lit("")) == ""
    return {
        "status": F.when(blank, col_(status)).otherwise(clean.otherwise(col_(status))),
        "vessel_name": F.when(blank, F.lit("")).otherwise(vessel.otherwise(F.lit(""))),
    }


def parse_card_parts(parts) -> dict[str, Column]:
    """Classify the text lines of one tracking card.

    Per line, in order: a date-time line (last one wins), else a status line
    (last one wins), else the first remaining non-blank line is the location
    and the second the terminal.  Returns status (with vessel split off),
    location, date, time and vessel name.  Each line is classified once
    (one pass of the two pattern tests), then picked by its kind.
    """
    return card_fields(card_line_kinds(parts))


def card_line_kinds(parts) -> Column:
    """array<struct<t, k>>: each line with its kind (1 date-time, 2 status,
    3 other non-blank, 0 blank).  Materialise it as a column before
    `card_fields` so the pattern tests run once per line."""
    return F.transform(col_(parts), lambda x: F.struct(
        x.alias("t"),
        F.when(is_card_datetime(x), F.lit(1)).when(is_card_status(x), F.lit(2))
         .when(F.coalesce(x, F.lit("")) != "", F.lit(3)).otherwise(F.lit(0)).alias("k")))


def card_fields(kinds) -> dict[str, Column]:
    """Card fields from classified lines (see `parse_card_parts`)."""
    kinds = col_(kinds)

    def texts(kind):
        return F.transform(F.filter(kinds, lambda e: e["k"] == kind), lambda e: e["t"])

    dt_text = F.coalesce(F.try_element_at(texts(1), F.lit(-1)), F.lit(""))
    status = F.coalesce(F.try_element_at(texts(2), F.lit(-1)), F.lit(""))
    other = texts(3)
    location = F.coalesce(F.get(other, 0), F.lit(""))
    terminal = F.coalesce(F.get(other, 1), F.lit(""))
    matched = F.regexp_extract(dt_text, C.CARD_DATETIME_PATTERN, 0)
    has_space = matched.contains(" ")
    date = F.when(has_space, F.regexp_extract(matched, r"^(.*) ([^ ]*)$", 1)).otherwise(F.lit(""))
    time = F.when(has_space, F.regexp_extract(matched, r"^(.*) ([^ ]*)$", 2)).otherwise(F.lit(""))
    full_location = (
        F.when((terminal != "") & (terminal != location),
               F.when(location != "", F.concat(location, F.lit(" - "), terminal)).otherwise(terminal))
        .otherwise(location)
    )
    v = extract_vessel(status)
    return {
        "status": v["status"],
        "location": full_location,
        "date": date,
        "time": time,
        "vessel_name": v["vessel_name"],
    }


def normalize_container(c) -> Column:
    """Upper-case container number with separators removed."""
    return F.upper(F.regexp_replace(col_(c), r"[^A-Za-z0-9]", ""))


def standardize_tracking_type(c) -> Column:
    """Map any casing/spacing of the three labels onto the canonical one."""
    k = F.lower(trim_ws(c))
    out = F.when(col_(c).cast("string").isin(*C.TRACKING_TYPES), col_(c))  # as it should be
    for label in C.TRACKING_TYPES:
        out = out.when(k == label.lower(), F.lit(label))
    return out.otherwise(col_(c))


def strip_tags(c) -> Column:
    return F.regexp_replace(col_(c), r"<[^>]*>", "")
