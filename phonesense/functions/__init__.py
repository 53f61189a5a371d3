"""Column-level functions (all built-in Spark expressions)."""

from phonesense.functions.time import (
    epoch_millis_to_ts, epoch_seconds_to_ts, local_date, local_hour, time_of_day,
    wall_clock, with_hour_date,
)
from phonesense.functions.variant import (
    get_array, get_boolean, get_double, get_field, get_string, parse_payload,
)

__all__ = [
    "epoch_millis_to_ts", "epoch_seconds_to_ts", "local_date", "local_hour", "time_of_day",
    "wall_clock", "with_hour_date", "get_array", "get_boolean", "get_double", "get_field",
    "get_string", "parse_payload",
]
