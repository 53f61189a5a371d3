"""The registered queries: every exported function of the package, applied
to the payload and register derived from the driver tables.

Each plan takes the parsed payload ``pl`` and a zero-argument function that
builds the participant register (only the availability queries call it) and
returns a DataFrame; :func:`bind` attaches the sources (raw text parsed on
the fly, or a written payload table) and normalises the output for
comparison (the VARIANT column is dropped, instants become TIMESTAMP_NTZ).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from phonesense.functions.time import time_of_day, utc_wall_clock
from phonesense.operators import export, metrics, probes
from phonesense.operators.objects import object_rejects
from phonesense.operators.ordering import with_position
from phonesense.operators.payload import probe_types, sensor_raw, upload_rejects, upload_report
from phonesense.operators.population import first_row_per_user, sensor_population_from_payload, sensor_population_of_known
from phonesense.plans import state
from phonesense.schemas import COMM_TYPES
from phonesense.session import remove_at_exit, scratch_path
from phonesense.sources.fixtures import (
    damaged_uploads, fixture_register, fixture_uploads, read_driver_table, uploads_from_events, uploads_with_bad_objects,
    write_register_files,
)
from phonesense.sources.uploads import read_register, read_uploads

REGISTER_ORDER = "row_no"
EAST = "Africa/Nairobi"

Plan = Callable[[DataFrame, Callable[[], DataFrame]], DataFrame]


def _time_of_day(pl: DataFrame, _register: DataFrame) -> DataFrame:
    calls = probes.probe_calls(pl)
    return calls.select("user_id", "call_timestamp", "event_hour",
                        time_of_day("event_hour").alias("time_of_day"))


def _on_events(fn):
    return lambda pl, _register: fn(probes.probe_event(pl))


def _map_as_json(counted: DataFrame) -> DataFrame:
    """Maps as JSON text, to compare them."""
    return counted.withColumn("counts", F.to_json("counts"))


PLANS: dict[str, Plan] = {
    "sensor_raw": lambda pl, _r: pl.drop("json"),
    "probe_types": lambda pl, _r: probe_types(pl),
    "probe_location": lambda pl, _r: probes.probe_location(pl),
    "probe_sms": lambda pl, _r: probes.probe_sms(pl),
    "probe_calls": lambda pl, _r: probes.probe_calls(pl),
    "probe_event": lambda pl, _r: probes.probe_event(pl),
    "sensor_population": lambda pl, r: sensor_population_from_payload(r(), pl, order_col=REGISTER_ORDER),
    "count_commtype": _on_events(metrics.count_commtype),
    "commtype_long": _on_events(metrics.commtype_long),
    "directions_long": _on_events(metrics.directions_long),
    "commtype_map": _on_events(lambda event: _map_as_json(metrics.category_counts(event, "communication_type"))),
    "contacts_map": _on_events(lambda event: _map_as_json(metrics.category_counts(event, "number"))),
    "commtype_from_map": _on_events(
        lambda event: metrics.category_columns(metrics.category_counts(event, "communication_type"), COMM_TYPES)),
    "stats_phone": _on_events(metrics.stats_phone),
    "stats_sms": _on_events(metrics.stats_sms),
    "ratio_phone": _on_events(metrics.ratio_phone),
    "ratio_sms": _on_events(metrics.ratio_sms),
    "call_duration": lambda pl, _r: metrics.call_duration(probes.probe_calls(pl)),
    "unique_texts": _on_events(metrics.unique_texts),
    "unique_calls": _on_events(metrics.unique_calls),
    "time_of_day": _time_of_day,
    "json_probelocation": lambda pl, _r: export.json_probelocation(pl),
    "json_probesms": lambda pl, _r: export.json_probesms(pl),
    "json_probecalls": lambda pl, _r: export.json_probecalls(pl),
    "json_probeevent": lambda pl, _r: export.json_probeevent(pl),
    "json_probeevent_nairobi": lambda pl, _r: export.json_probeevent(pl, hour_tz=EAST, date_tz=EAST),
    "json_sensorpop": lambda pl, r: export.json_sensorpop(pl, r(), order_col=REGISTER_ORDER),
    "json_commtype": lambda pl, _r: export.json_commtype(pl),
    "json_statsphone": lambda pl, _r: export.json_statsphone(pl),
    "json_statssms": lambda pl, _r: export.json_statssms(pl),
    "json_ratiophone": lambda pl, _r: export.json_ratiophone(pl),
    "json_ratiosms": lambda pl, _r: export.json_ratiosms(pl),
    "json_callduration": lambda pl, _r: export.json_callduration(pl),
    "json_uniquetext": lambda pl, _r: export.json_uniquetext(pl),
    "json_uniquecalls": lambda pl, _r: export.json_uniquecalls(pl),
}


def normalise(df: DataFrame) -> DataFrame:
    """Comparable output: instants as TIMESTAMP_NTZ (UTC wall clock)."""
    if not any(isinstance(f.dataType, T.TimestampType) for f in df.schema.fields):
        return df
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = utc_wall_clock(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def payload_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_raw(fixture_uploads(spark, sf_dir))


def register_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_register(spark, sf_dir)


def bind(name: str, payload: Callable[[SparkSession, str], DataFrame] = payload_from_tables
         ) -> Callable[[SparkSession, str], DataFrame]:
    plan = PLANS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalise(plan(payload(spark, sf_dir), lambda: register_from_tables(spark, sf_dir)))

    run.__name__ = name
    return run


def rejects_of_damaged_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected uploads of the fixture with a part of them damaged."""
    return upload_rejects(damaged_uploads(spark, sf_dir))


def report_of_damaged_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upload_report(damaged_uploads(spark, sf_dir))


def recovered_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All good objects of uploads of which single objects are bad."""
    return sensor_raw(uploads_with_bad_objects(spark, sf_dir), mode="RECOVER").drop("json")


def rejected_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return object_rejects(uploads_with_bad_objects(spark, sf_dir))


def events_by_way_of_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``probe_event`` of the uploads written and read again as CSV."""
    path = scratch_path(spark, "uploads-csv")
    fixture_uploads(spark, sf_dir).write.options(header=True, quote='"', escape='"', nullValue="NA").csv(path)
    remove_at_exit(spark, path)
    return normalise(probes.probe_event(sensor_raw(read_uploads(spark, path))))


def population_by_way_of_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sensor_population`` of a register written and read again as CSV, whose
    first rows are told by its order column."""
    path = scratch_path(spark, "register-csv")
    fixture_register(spark, sf_dir).write.options(header=True, quote='"', escape='"', nullValue="NA").csv(path)
    remove_at_exit(spark, path)
    register = read_register(spark, path).drop("_source_order")
    return sensor_population_from_payload(register, payload_from_tables(spark, sf_dir), order_col=REGISTER_ORDER)


def population_of_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sensor_population`` with the uploads of unknown participants left out before they are parsed."""
    return sensor_population_of_known(fixture_register(spark, sf_dir), fixture_uploads(spark, sf_dir), order_col=REGISTER_ORDER)


def appended(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A daily result after its uploads came in two batches, one of them in part first and then whole."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = remove_at_exit(spark, scratch_path(spark, "daily"))
        uploads = uploads_from_events(read_driver_table(spark, sf_dir, "events"), "event_id")
        of = lambda n, rest: uploads.where(F.pmod("event_id", F.lit(rest)) == n)
        for batch, raw in (("a", of(0, 2)), ("b", of(1, 6)), ("b", of(1, 2))):
            state.add_batch(raw.select("user_id", "payload"), out, batch, names=(name,))
        return normalise(state.read_result(spark, out, name))

    run.__name__ = f"appended_{name}"
    return run


def ranked(plan: Callable[[DataFrame], DataFrame], by: tuple[str, ...]) -> Callable[[SparkSession, str], DataFrame]:
    """A result with each row's position in its order."""
    return lambda spark, sf_dir: normalise(with_position(plan(payload_from_tables(spark, sf_dir)), by))


def register_in_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each participant in twelve multi-line register files, by file order alone."""
    path = remove_at_exit(spark, scratch_path(spark, "register-files"))
    write_register_files(spark, sf_dir, path)
    register = read_register(spark, path, multiLine=True)
    return first_row_per_user(register.select("user_id", "email", "key", "name", "_source_order"), "_source_order").drop("_source_order")


SOURCES = {
    "longest_calls_ranked": ranked(lambda pl: metrics.call_duration(probes.probe_calls(pl), ordered=False), ("call_timestamp",)),
    "stats_phone_ranked": ranked(lambda pl: metrics.stats_phone(probes.probe_event(pl)), ("user_id", "event_date")),
    "register_file_order": register_in_file_order,
    "appended_count_commtype": appended("count_commtype"),
    "appended_stats_phone": appended("stats_phone"),
    "appended_unique_texts": appended("unique_texts"),
    "appended_call_duration": appended("call_duration"),
    "sensor_population_known": population_of_known,
    "upload_rejects": rejects_of_damaged_uploads,
    "upload_report": report_of_damaged_uploads,
    "recovered_objects": recovered_objects,
    "object_rejects": rejected_objects,
    "csv_uploads_event": events_by_way_of_csv,
    "csv_register_population": population_by_way_of_csv,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: bind(name) for name in PLANS} | SOURCES
