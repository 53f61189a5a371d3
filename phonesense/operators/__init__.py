"""Relational operators: payload explode, probe extractors, daily measures,
availability matrix and their JSON forms."""

from phonesense.operators.export import (
    json_callduration, json_commtype, json_probecalls, json_probeevent, json_probelocation,
    json_probesms, json_ratiophone, json_ratiosms, json_sensorpop, json_statsphone,
    json_statssms, json_uniquecalls, json_uniquetext,
)
from phonesense.operators.grouped import attach_group_values, null_safe_join
from phonesense.operators.membership import id_filter, maybe_members
from phonesense.operators.metrics import (
    call_duration, category_columns, category_counts, count_commtype, direction_counts, ratio_phone, ratio_sms, stats_phone,
    stats_sms, unique_calls, unique_contacts, unique_texts,
)
from phonesense.operators.payload import filter_probe, probe_types, sensor_raw
from phonesense.operators.population import (
    first_row_per_user, payload_presence, sensor_population, sensor_population_from_payload,
    sensor_population_of_known,
)
from phonesense.operators.probes import probe_calls, probe_event, probe_location, probe_sms

__all__ = [
    "sensor_raw", "filter_probe", "probe_types",
    "probe_location", "probe_sms", "probe_calls", "probe_event",
    "sensor_population", "sensor_population_from_payload", "first_row_per_user", "payload_presence",
    "id_filter", "maybe_members", "sensor_population_of_known", "category_counts", "category_columns",
    "count_commtype", "stats_phone", "stats_sms", "ratio_phone", "ratio_sms", "direction_counts",
    "call_duration", "unique_texts", "unique_calls", "unique_contacts",
    "attach_group_values", "null_safe_join",
    "json_probelocation", "json_probesms", "json_probecalls", "json_probeevent", "json_sensorpop",
    "json_commtype", "json_statsphone", "json_statssms", "json_ratiophone", "json_ratiosms",
    "json_callduration", "json_uniquetext", "json_uniquecalls",
]
