"""JSON form of every result: parsed payload in, one JSON object per row out.

Each function composes an extractor, the table operator and the one JSON sink
(:func:`phonesense.sources.json_sink.to_json_rows`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from phonesense.operators import metrics, probes
from phonesense.operators.population import sensor_population_from_payload
from phonesense.schemas import COMM_TYPES, PHONE_DIRECTIONS, SMS_DIRECTIONS
from phonesense.sources.json_sink import to_json_rows


def _rows(table: DataFrame, digits: int | None, hour_tz: str) -> DataFrame:
    """Instants print in the zone of ``event_hour``, so the two agree."""
    return to_json_rows(table, digits, tz=hour_tz)


def json_probelocation(pl: DataFrame, digits: int | None = 4, hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    return _rows(probes.probe_location(pl, hour_tz, date_tz), digits, hour_tz)


def json_probesms(pl: DataFrame, digits: int | None = 4, hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    return _rows(probes.probe_sms(pl, hour_tz, date_tz), digits, hour_tz)


def json_probecalls(pl: DataFrame, digits: int | None = 4, hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    return _rows(probes.probe_calls(pl, hour_tz, date_tz), digits, hour_tz)


def json_probeevent(pl: DataFrame, digits: int | None = 4, hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    return _rows(probes.probe_event(pl, hour_tz, date_tz), digits, hour_tz)


def json_sensorpop(pl: DataFrame, register: DataFrame, order_col: str = "_source_order",
                   digits: int | None = 4, **options) -> DataFrame:
    """Availability matrix of ``register`` against the probes in ``pl``."""
    return to_json_rows(sensor_population_from_payload(register, pl, order_col, **options), digits)


def json_commtype(pl: DataFrame, digits: int | None = 4, types: Sequence[str] | None = COMM_TYPES,
                  hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    return _rows(metrics.count_commtype(probes.probe_event(pl, hour_tz, date_tz), types), digits, hour_tz)


def json_statsphone(pl: DataFrame, digits: int | None = 4, directions: Sequence[str] | None = PHONE_DIRECTIONS,
                    hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    return _rows(metrics.stats_phone(probes.probe_event(pl, hour_tz, date_tz), directions), digits, hour_tz)


def json_statssms(pl: DataFrame, digits: int | None = 4, directions: Sequence[str] | None = SMS_DIRECTIONS,
                  hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    return _rows(metrics.stats_sms(probes.probe_event(pl, hour_tz, date_tz), directions), digits, hour_tz)


def json_ratiophone(pl: DataFrame, digits: int | None = 4, directions: Sequence[str] | None = PHONE_DIRECTIONS,
                    hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    return _rows(metrics.ratio_phone(probes.probe_event(pl, hour_tz, date_tz), directions), digits, hour_tz)


def json_ratiosms(pl: DataFrame, digits: int | None = 4, directions: Sequence[str] | None = SMS_DIRECTIONS,
                  hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    return _rows(metrics.ratio_sms(probes.probe_event(pl, hour_tz, date_tz), directions), digits, hour_tz)


def json_callduration(pl: DataFrame, digits: int | None = 4, hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    return _rows(metrics.call_duration(probes.probe_calls(pl, hour_tz, date_tz)), digits, hour_tz)


def json_uniquetext(pl: DataFrame, digits: int | None = 4, hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    return _rows(metrics.unique_texts(probes.probe_event(pl, hour_tz, date_tz)), digits, hour_tz)


def json_uniquecalls(pl: DataFrame, digits: int | None = 4, hour_tz: str = "UTC", date_tz: str = "UTC") -> DataFrame:
    return _rows(metrics.unique_calls(probes.probe_event(pl, hour_tz, date_tz)), digits, hour_tz)
