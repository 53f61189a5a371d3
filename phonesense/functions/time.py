"""Column functions for epoch conversion, local hour/date and time-of-day labels.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from phonesense.schemas import TIME_OF_DAY_BUCKETS, TIME_OF_DAY_OTHER

_EPOCH_NTZ = "1970-01-01 00:00:00"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds_to_ts(seconds) -> Column:
    """Epoch seconds (DOUBLE, fractional) -> TIMESTAMP, exact to the microsecond.

    ``timestamp_micros(round(s * 1e6))`` rather than a cast, so fractional
    milliseconds are not truncated; out-of-range values give NULL.
    """
    micros = F.round(_col(seconds) * F.lit(1_000_000.0)).try_cast("bigint")
    return F.timestamp_micros(micros)


def epoch_millis_to_ts(millis) -> Column:
    """Epoch milliseconds (DOUBLE) -> TIMESTAMP (the ``/1000`` of the probes
    that report milliseconds)."""
    micros = F.round(_col(millis) * F.lit(1000.0)).try_cast("bigint")
    return F.timestamp_micros(micros)


def utc_wall_clock(ts) -> Column:
    """UTC wall-clock time of an instant as TIMESTAMP_NTZ, derived from its
    epoch microseconds (no session zone involved)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def wall_clock(ts, tz: str = "UTC") -> Column:
    """Local wall-clock time of an instant in zone ``tz`` as TIMESTAMP_NTZ.

    Independent of the session time zone and exact around daylight-saving
    changes: the conversion starts from the UTC wall clock, which has no
    ambiguous or missing hours.
    """
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall_clock(ts))


# Zone names that always mean offset zero.
UTC_ZONES = frozenset({"UTC", "Etc/UTC", "GMT", "Etc/GMT", "UCT", "Etc/UCT", "Zulu", "Z", "+00:00"})
_HOUR_US = 3_600_000_000
_DAY_US = 24 * _HOUR_US


def local_hour(ts, tz: str = "UTC") -> Column:
    """Hour of day (INT) of an instant in zone ``tz``.

    For UTC it is integer arithmetic on epoch microseconds (no zone rules per
    row, several times cheaper than a zone conversion); other zones go
    through :func:`wall_clock`.
    """
    if tz in UTC_ZONES:
        us = F.unix_micros(_col(ts))
        return (F.pmod(us, F.lit(_DAY_US)) / F.lit(_HOUR_US)).cast("int")
    return F.hour(wall_clock(ts, tz))


def local_date(ts, tz: str = "UTC") -> Column:
    """Calendar date (DATE) of an instant in zone ``tz`` (UTC: arithmetic)."""
    if tz in UTC_ZONES:
        us = F.unix_micros(_col(ts))
        days = F.call_function("div", us - F.pmod(us, F.lit(_DAY_US)), F.lit(_DAY_US))
        return F.date_from_unix_date(days.cast("int"))
    return F.to_date(wall_clock(ts, tz))


def with_hour_date(df, ts_col: str, hour_tz: str = "UTC", date_tz: str = "UTC"):
    """Append ``event_hour`` (INT) and ``event_date`` (DATE) derived from
    ``ts_col``; each may use its own zone."""
    return df.withColumns({
        "event_hour": local_hour(ts_col, hour_tz),
        "event_date": local_date(ts_col, date_tz),
    })


def time_of_day(hour) -> Column:
    """Label an hour of the day. A NULL hour stays NULL (it does not fall
    through to the last label)."""
    h = _col(hour)
    expr = F.when(h.isNull(), F.lit(None).cast("string"))
    for start, end, label in TIME_OF_DAY_BUCKETS:
        expr = expr.when((h >= start) & (h < end), F.lit(label))
    return expr.otherwise(F.lit(TIME_OF_DAY_OTHER))
