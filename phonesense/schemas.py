"""Fixed values of the phone-sensing data model.

Everything in the block below must stay equal to what the phone probes emit
and to what the original analysis expects; they are data, not tuning knobs.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must match the probe payload format and the original output)
# ---------------------------------------------------------------------------
# Probe names are matched on their final dotted segment.
LOCATION_PROBE = "LocationProbe"
COMM_LOG_PROBE = "CommunicationLogProbe"
COMM_EVENT_PROBE = "CommunicationEventProbe"

# Top-level keys of every probe object.
KEY_PROBE, KEY_TIMESTAMP, KEY_GUID = "PROBE", "TIMESTAMP", "GUID"

# Nested log arrays inside a CommunicationLogProbe object.
SMS_ARRAY, CALLS_ARRAY = "SMS_MESSAGES", "PHONE_CALLS"

# Communication types and directions, in output column order.
COMM_TYPES = ("PHONE", "SMS")
PHONE_DIRECTIONS = ("INCOMING", "MISSED", "OUTGOING")
SMS_DIRECTIONS = ("INCOMING", "OUTGOING")
RATIO_NUMERATOR, RATIO_DENOMINATOR = "OUTGOING", "INCOMING"

# Time-of-day labels: half-open hour ranges [start, end); any other hour
# (22-23 and 0-2) is "Late Night".
TIME_OF_DAY_BUCKETS = (
    (3, 6, "Early Morning"),
    (6, 12, "Morning"),
    (12, 19, "Afternoon"),
    (19, 22, "Night"),
)
TIME_OF_DAY_OTHER = "Late Night"

# Availability flag values and flag column names of the participant matrix.
AVAILABLE, NOT_AVAILABLE = "Available", "NotAvailable"
POPULATION_FLAGS = ("location", "calls", "sms", "event")

# Marker value of the longest-call flag column.
MAX_TIME_MARK = "max_time"

# Column of a NULL category, and of all values that a declared list leaves out.
NULL_CATEGORY_LABEL = "<NA>"
OTHER_CATEGORY_LABEL = "OTHER"

# Field lists of the typed probe tables: (output column, JSON key, Spark type).
LOCATION_FIELDS = (
    ("gpsAvailable", "GPS_AVAILABLE", "boolean"),
    ("latitude", "LATITUDE", "double"),
    ("longitude", "LONGITUDE", "double"),
    ("networkAvailable", "NETWORK_AVAILABLE", "boolean"),
    ("accuracy", "ACCURACY", "double"),
)
SMS_FIELDS = (
    ("numberName", "NUMBER_NAME", "string"),
    ("messageDirection", "MESSAGE_DIRECTION", "string"),
    ("number", "NUMBER", "string"),
    ("messageTimestamp", "MESSAGE_TIMESTAMP", "double"),
)
CALL_FIELDS = (
    ("numberName", "NUMBER_NAME", "string"),
    ("callDuration", "CALL_DURATION", "double"),
    ("numberLabel", "NUMBER_LABEL", "string"),
    ("numberType", "NUMBER_TYPE", "string"),
    ("number", "NUMBER", "string"),
    ("callTimestamp", "CALL_TIMESTAMP", "double"),
)
EVENT_FIELDS = (
    ("comm_timestamp", "COMM_TIMESTAMP", "string"),
    ("comm_direction", "COMMUNICATION_DIRECTION", "string"),
    ("number", "NUMBER", "string"),
    ("communication_type", "COMMUNICATION_TYPE", "string"),
)
# ---------------------------------------------------------------------------
