"""Typed event tables extracted from the parsed payload ``pl``.

Each extractor is Filter -> (Generate) -> Project on the VARIANT column: no
shuffle, and the probe-family filter runs before any field is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from phonesense.functions.time import epoch_millis_to_ts, epoch_seconds_to_ts, with_hour_date
from phonesense.functions.variant import fields_select, get_array, get_field
from phonesense.operators.payload import filter_probe
from phonesense.schemas import (
    CALL_FIELDS, CALLS_ARRAY, COMM_EVENT_PROBE, COMM_LOG_PROBE, EVENT_FIELDS,
    LOCATION_FIELDS, LOCATION_PROBE, SMS_ARRAY, SMS_FIELDS,
)


def _field(doc: str, fields, name: str):
    """Getter of the field whose output column is ``name``."""
    key, type_name = {n: (k, t) for n, k, t in fields}[name]
    return get_field(doc, key, type_name)


def _typed(rows: DataFrame, lead: list, doc: str, fields, ts_name: str, ts, hour_tz: str,
           date_tz: str) -> DataFrame:
    """One projection for the typed fields and the instant, one for the
    derived hour and date (few plan nodes: each DataFrame step re-analyses)."""
    typed = rows.select(*lead, *fields_select(doc, fields), ts.alias(ts_name))
    return with_hour_date(typed, ts_name, hour_tz, date_tz)


def probe_location(pl: DataFrame, hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    """Location fixes. Probe timestamps here are epoch *seconds*.

    Columns: user_id, timestamp, gpsAvailable, latitude, longitude,
    networkAvailable, accuracy, event_timestamp, event_hour, event_date.
    """
    return _typed(filter_probe(pl, LOCATION_PROBE), ["user_id", "timestamp"], "json", LOCATION_FIELDS,
                  "event_timestamp", epoch_seconds_to_ts("timestamp"), hour_tz, date_tz)


def _log_entries(pl: DataFrame, array_key: str) -> DataFrame:
    """One row per element of a nested log array of CommunicationLogProbe
    objects. Objects lacking the array (missing, null, empty, not an array)
    give no rows."""
    return filter_probe(pl, COMM_LOG_PROBE).select(
        "user_id", F.explode(get_array("json", array_key)).alias("entry"))


def probe_sms(pl: DataFrame, hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    """SMS log entries. Columns: user_id, numberName, messageDirection, number,
    messageTimestamp, msg_timestamp, event_hour, event_date."""
    millis = _field("entry", SMS_FIELDS, "messageTimestamp")
    return _typed(_log_entries(pl, SMS_ARRAY), ["user_id"], "entry", SMS_FIELDS,
                  "msg_timestamp", epoch_millis_to_ts(millis), hour_tz, date_tz)


def probe_calls(pl: DataFrame, hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    """Call log entries. Columns: user_id, numberName, callDuration,
    numberLabel, numberType, number, callTimestamp, call_timestamp,
    event_hour, event_date."""
    millis = _field("entry", CALL_FIELDS, "callTimestamp")
    return _typed(_log_entries(pl, CALLS_ARRAY), ["user_id"], "entry", CALL_FIELDS,
                  "call_timestamp", epoch_millis_to_ts(millis), hour_tz, date_tz)


def probe_event(pl: DataFrame, hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    """Communication events. ``comm_timestamp`` is epoch milliseconds kept as
    text (the probe sends either text or a number).

    Columns: user_id, comm_timestamp, comm_direction, number,
    communication_type, event_timestamp, event_hour, event_date.
    """
    millis = _field("json", EVENT_FIELDS, "comm_timestamp").try_cast("double")
    return _typed(filter_probe(pl, COMM_EVENT_PROBE), ["user_id"], "json", EVENT_FIELDS,
                  "event_timestamp", epoch_millis_to_ts(millis), hour_tz, date_tz)
