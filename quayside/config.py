"""Business constants and fixed reference values.

Everything a run needs beyond its input tables lives here, so that the
operators stay pure functions of (DataFrame, parameters).
"""

from __future__ import annotations

import datetime as _dt

# Default "now" for every tested query: classification compares against an
# explicit point in time instead of the wall clock.
AS_OF = _dt.datetime(2024, 1, 20, 0, 0, 0)
AS_OF_SQL = "TIMESTAMP '2024-01-20 00:00:00'"

# ---------------------------------------------------------------------------
# FIXED VALUES -- must equal the reference's for right results.
# ---------------------------------------------------------------------------

# Carrier codes.
HLCU = "HLCU"
MAEU = "MAEU"

# Tracking-type labels.
HISTORIC = "Historic Tracking"
CURRENT = "Current Tracking"
FUTURE = "Future Tracking"
TRACKING_TYPES = (HISTORIC, CURRENT, FUTURE)
LATEST = "Latest"
NOT_FOUND_STATUS = "Container Not Found"

# Column order of the per-run carrier files.
HLCU_EXPORT_COLUMNS = ("container_number", "concat_1", "concat_2", "concat_3", "type_of_tracking", "status",
                       "place_of_activity", "date", "time", "transport", "duplicates")
MAEU_EXPORT_COLUMNS = ("container_number", "concat_1", "concat_2", "concat_3", "type_of_tracking", "status",
                       "location", "date", "time", "vessel_name", "transport", "duplicates")

# Payload files: name pattern per carrier, and record fields.
CARRIER_FILES = (
    {"pattern": "hapag_lloyd_tracking_*.json", "carrier": "HLCU"},
    {"pattern": "maersk_tracking_*.json", "carrier": "MAEU"},
)
RECORD_FIELDS = ("Container_Number", "Concat_1", "Concat_2", "Concat_3", "Type_of_Tracking", "Status",
                 "Place_of_Activity", "Location", "Date", "Time", "Vessel_Name", "Transport", "Duplicates")

# Statuses whose concat key carries the transport text (carrier H).
TRANSPORT_STATUSES = ("Arrival in", "Departure from")

# Card parsing (carrier M): date-time pattern, status keywords (matched
# case-insensitively as substrings), vessel-bearing status patterns, and the
# page texts that mean "no result".
CARD_DATETIME_PATTERN = r"\d{1,2}\s+[A-Za-z]{3}\s+\d{4}\s+\d{2}:\d{2}"
STATUS_KEYWORDS = (
    "Gate out Empty", "Gate out for delivery", "Gate out", "Gate in",
    "Load on", "Discharge", "Vessel arrival", "Vessel departure",
    "On rail", "Off rail", "Rail departure", "Rail arrival",
    "Empty container return",
)
VESSEL_PATTERNS = (
    (r"(?i)^Load on\s+(.+)$", "Load on"),
    (r"(?i)^Vessel departure\s*\((.+)\)$", "Vessel departure"),
    (r"(?i)^Vessel arrival\s*\((.+)\)$", "Vessel arrival"),
)
NOT_FOUND_PATTERN = r"No results|not found|could not be found"

# Master-report literals.
BASE_LITERALS = {"lsc": "CEVV", "specialized_transport": "NO",
                 "mode": "OCEAN", "provider_lane_id": "MGOB"}

# Destination routing.
CCA_DOCK_DUNS = "101452410"
CCA_DOCK_NAME = "UNIVERSAL PONTIAC CROSS DOCK"
CCA_MARK = "CCA"
LCL = "LCL"
USA = "UNITED STATES OF AMERICA"

# Unit conversions: cubic feet -> cubic metres, pounds -> kilograms.
FT3_TO_M3 = 0.02831685
LB_TO_KG = 0.45359237

# Container reference: type, max CBM, max weight (kg).
CONTAINER_REF = (
    ("20' Standard", 31.1, 19550.0),
    ("40' Standard ISO", 63.6, 19550.0),
    ("40' High Cube", 72.2, 19550.0),
    ("20' Standard NON-Operating Reefer", 28.2, 16330.0),
    ("40' Standard NON-Operating Reefer", 65.6, 16330.0),
    ("40' High Cube NON-Operating Reefer", 63.9, 16330.0),
    ("20' Standard Reefer", 28.2, 16330.0),
    ("40' Standard Container Reefer", 65.6, 16330.0),
    ("40' High Cube Reefer", 63.9, 16330.0),
    ("45' High Cube", 88.28, 19550.0),
    ("45' High Cube Reefer", 88.28, 19550.0),
)

# Origin consolidation centres: DUNS, name.
ORIGIN_CONSOL = (
    ("528177112", "CEVA Logistics - Shenzhen CC"),
    ("544931926", "CEVA Logistics - Shanghai CC"),
    ("543129368", "CEVA Logistics - Tianjin Xingang CC"),
    ("687767889", "CEVA Logistics - Busan CC"),
)

# TMS reference-type ids.
REF_MODE = 100033
REF_CCA_LOCATION = 100265
REF_PRN = 100318
REF_SO = 100742
REF_HBL = 100352
REF_LANE = 100794
MBL_PRIORITY = ((100000, 1), (100006, 2), (100183, 3))
CONSOL_MILESTONE_TYPE = 100001
ACTIVE_STATE = 100000

# Spreadsheet serial dates: strict bounds and epoch.
SERIAL_LOW = 20000
SERIAL_HIGH = 90000
SERIAL_EPOCH = "1899-12-30"

# Milestone export (Query 4) source column -> report column.  The leading
# space and the lower-case "expected" are part of the source names.
MILESTONE_RENAMES = (
    (" Arrived at Consol", "Arrived at Consol Actual Date/Time"),
    ("Depart Consol Center", "Departed Consol Actual Date/Time"),
    ("Actual Arrived at Port of Departure", "Actual Date of arrival to the origin port "),
    ("Expected Arrived at Transshipment Port", "Expected Arrival Date To Transshipment Port"),
    ("Actual Arrived at Transshipment Port", "Actual Arrival Date To Transshipment Port"),
    ("Expected Departed Transshipment Port", "Expected Departure Date From Transshipment Port"),
    ("Actual Departed Transshipment Port", "Actual Departure Date From Transshipment Port"),
    ("Expected Depart Origin Port", "Expected Date Of Departure From Origin Port"),
    ("Actual Depart Origin Port", "Actual Date Of Departure From Origin Port"),
    ("Expected Arrived at Port of Entry", "Expected Date of Arrival To Destination Port"),
    ("Actual Arrived at Port of Entry", "Actual Date of Arrival To Destination Port"),
    ("Expected Outgate", "Expected Outgate Date From Destination Port"),
    ("Actual Outgate", "Actual Outgate Date From Destination Port"),
    ("expected Arrived Destination Rail Ramp", "Estimated Arrival Date To Destination Rail Yard"),
    ("Actual Arrived Destination Rail Ramp", "Actual Arrival Date To Destination Rail Yard"),
    ("Expected Departed Destination Rail Ramp", "Expected Departure Date From Destination Rail Yard"),
    ("Actual Departed Destination Rail Ramp", "Actual Departure from Dest Rail"),
    ("POL", "Port of Loading Code"),
    ("Transshipment Port", "Transshipment Port Name"),
    ("POD", "Port of Destination Code"),
)

# Shipment status waterfall: (milestone column, label), highest stage first.
STATUS_WATERFALL = (
    ("actual_arrival_final_dest", "12. Delivered"),
    ("actual_departure_dest_rail", "11. Outgate Destination Rail"),
    ("actual_arrival_dest_rail", "10. Arrived Destination Rail"),
    ("actual_outgate_pod", "9. Outgate POD"),
    ("actual_arrival_pod", "7. Arrived POD"),
    ("actual_departure_pol", "6. Departed POL"),
    ("actual_arrival_pol", "5. Arrived POL"),
    ("actual_departure_consol", "4. Outgate CFS"),
    ("ship_date_from_supplier", "2. Departed Supplier"),
)

# Columns every carrier event export must carry.
REQUIRED_EVENT_COLUMNS = ("container_number", "status", "date", "time")
# ---------------------------------------------------------------------------


def snake(name: str) -> str:
    """Report column name -> snake_case identifier."""
    import re

    s = re.sub(r"[^0-9A-Za-z]+", "_", name.strip()).strip("_").lower()
    return re.sub(r"_+", "_", s)
