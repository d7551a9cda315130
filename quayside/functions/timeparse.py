"""Date/time parsing and shipment-id normalisation column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside import config as C
from quayside.functions.text import col_, trim_ws


def ntz_lit(v) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime or text, never passing
    through a time zone (PySpark maps naive datetimes via the machine's
    local zone, and LTZ -> NTZ casts via the session zone)."""
    if isinstance(v, Column):
        return v.cast("timestamp_ntz")
    text = v.isoformat(sep=" ") if hasattr(v, "isoformat") else str(v)
    return F.lit(text).cast("timestamp_ntz")


def parse_ntz(text: Column, fmt: str) -> Column:
    """Parse local date-time text to TIMESTAMP_NTZ; unparseable -> null.

    `try_to_timestamp` validates (null instead of an error under ANSI) and
    `to_timestamp_ntz` parses, so the value never passes through the session
    time zone (no daylight-saving gaps, same result in any session)."""
    ok = F.try_to_timestamp(text, F.lit(fmt)).isNotNull()
    return F.when(ok, F.to_timestamp_ntz(text, F.lit(fmt)))


def hlcu_event_ts(date, time) -> Column:
    """'yyyy-MM-dd' + 'HH:mm' -> timestamp; anything unparseable -> null.

    One-letter pattern fields accept one or two digits, like the reference's
    strptime-based parser.
    """
    text = F.concat_ws(" ", F.coalesce(col_(date), F.lit("")), F.coalesce(col_(time), F.lit("")))
    return parse_ntz(text, "yyyy-M-d H:m")


def maeu_event_date(date) -> Column:
    """'06 Oct 2025' -> timestamp at midnight; invalid -> null."""
    return parse_ntz(F.coalesce(col_(date), F.lit("")), "d MMM yyyy")


def maeu_event_ts(date, time) -> Column:
    """'06 Oct 2025' + '20:19' -> timestamp; invalid -> null."""
    text = F.concat_ws(" ", F.coalesce(col_(date), F.lit("")), F.coalesce(col_(time), F.lit("")))
    return parse_ntz(text, "d MMM yyyy H:m")


def iso_date_text(ts) -> Column:
    return F.date_format(col_(ts), "yyyy-MM-dd")


def serial_to_yyyymmdd(v) -> Column:
    """Spreadsheet serial day number -> yyyymmdd integer (time of day dropped)."""
    day = F.date_add(F.lit(C.SERIAL_EPOCH).cast("date"), F.floor(col_(v)).cast("int"))
    return F.date_format(day, "yyyyMMdd").cast("bigint")


def normalize_id_numeric(v) -> Column:
    """Numeric shipment id -> double; serial dates in (20000, 90000) -> yyyymmdd."""
    x = col_(v).cast("double")
    is_serial = (x > C.SERIAL_LOW) & (x < C.SERIAL_HIGH)
    return F.when(x.isNull(), F.lit(None).cast("double")).when(
        is_serial, serial_to_yyyymmdd(x).cast("double")).otherwise(x)


_PY_FLOAT_WITH_UNDERSCORES = r"^[+-]?\d+(_\d+)*(\.(\d+(_\d+)*)?)?$"
_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def normalize_id_text(v) -> Column:
    """Text shipment id -> double the way Python's float() reads it; else null.

    Text is never taken as a serial date.  Surrounding whitespace is ignored
    and digit-group underscores are accepted; forms Spark's cast would take
    but Python would not (such as a trailing 'd') give null.
    """
    v = col_(v).cast("string")
    digits = (v != "") & (F.btrim(v, F.lit("0123456789")) == "")  # most ids; no pattern is needed
    s = trim_ws(v)
    s = F.when(s.rlike(_PY_FLOAT_WITH_UNDERSCORES), F.regexp_replace(s, "_", "")).otherwise(s)
    return F.when(digits, v.try_cast("double")).when(s.rlike(_DECIMAL), s.try_cast("double")).otherwise(F.lit(None).cast("double"))


def normalize_id_timestamp(v) -> Column:
    """Timestamp shipment id -> yyyymmdd as double."""
    return F.date_format(col_(v), "yyyyMMdd").cast("double")


def id_key(v, spreadsheet: bool = False) -> Column:
    """Shipment id as a bigint join key (exact for integral ids).  Numbers in
    spreadsheet cells may be serial dates (`spreadsheet`); ids of staged tables
    are declared integers and stay what they are."""
    return normalize_id_numeric(v).cast("bigint") if spreadsheet else col_(v).cast("bigint")


def run_stamp(v) -> Column:
    """A run's time as file names carry it: yyyyMMdd_HHmmss."""
    return F.date_format(ntz_lit(v), "yyyyMMdd_HHmmss")
