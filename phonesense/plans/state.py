"""Daily measures kept up to date: mergeable partial state of upload batches.

A batch of uploads is named by an id. Its parsed payload, its event tables and a small partial state are
written under ``batch=<id>``, and writing an id again replaces all of that: a retried or
repeated append changes nothing. The state is counts and maxima that add up over batches:

* ``events``: rows of each (participant, day, type, direction, contact) - from it come the counts, means,
  ratios and distinct contacts, as the number of contacts is the number of merged rows;
* ``calls``: the longest calls of each participant-day, and one row of unknown duration where there is
  any - the longest of several batches are among the longest of each;
* ``presence``: which participants have rows in which table;
* ``probes``: objects of each probe.

``refresh`` merges the state of the days that a batch touches, and of no others: state and results are
partitioned by ``event_date``, so Spark prunes all other days from the read and replaces only the
touched partitions of the result. Days that a batch touched before it was replaced are kept in a
log, written before the state; if one of them is no longer in the batch's state, everything is refreshed. So
is a result in which a touched day had rows and has none now, as replacing partitions leaves that day's as it was.

Uploads are parsed once: one write makes the objects, and the uploads that give none, as partitions
of one table. In ``RECOVER`` mode the good objects of those are added from that table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from phonesense.functions.variant import get_double, get_string
from phonesense.operators import metrics, probes
from phonesense.operators.objects import object_rejects, recovered_rows
from phonesense.operators.payload import probe_types, upload_elements, upload_state_of
from phonesense.operators.population import merged_presence, presence_of
from phonesense.plans.bronze import BRONZE_SCHEMA, FAMILY_COL, probe_family
from phonesense.schemas import KEY_GUID, KEY_PROBE, KEY_TIMESTAMP
from phonesense.session import remove_at_exit, scratch_path

DAY = "event_date"
N = "n"
EVENT_KEY = ("user_id", DAY, "communication_type", "comm_direction", "number")
STATE_SCHEMAS = {
    "events": "user_id string, communication_type string, comm_direction string, number string, n long, event_date date",
    "calls": "user_id string, call_timestamp timestamp, callDuration double, event_hour int, event_date date",
    "presence": "user_id string, _has_location boolean, _has_calls boolean, _has_sms boolean, _has_event boolean",
    "probes": "probe string, n long",
}
#: Results that merge by day, from the merged events.
FROM_EVENTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "count_commtype": lambda e: metrics.count_commtype(e, weight=N),
    "commtype_long": lambda e: metrics.commtype_long(e, weight=N),
    "directions_long": lambda e: metrics.directions_long(e, weight=N),
    "stats_phone": lambda e: metrics.stats_phone(e, weight=N),
    "stats_sms": lambda e: metrics.stats_sms(e, weight=N),
    "ratio_phone": lambda e: metrics.ratio_phone(e, weight=N),
    "ratio_sms": lambda e: metrics.ratio_sms(e, weight=N),
    "unique_texts": lambda e: metrics.unique_texts(e, weight=N),
    "unique_calls": lambda e: metrics.unique_calls(e, weight=N),
}
DAILY = (*FROM_EVENTS, "call_duration")
EVENT_TABLES = ("probe_location", "probe_sms", "probe_calls", "probe_event")
OBJECT_STATES = ("parsed", "recovered")


def _folder(out: str, *parts: str) -> str:
    return "/".join([out.rstrip("/"), *parts])


def batch_folder(batch: str) -> str:
    """Partition folder of a batch; ids hold letters, digits, ``.``, ``_`` and ``-``."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
        raise ValueError(f"a batch id holds letters, digits, '.', '_' and '-' only, got {batch!r}")
    return "batch=" + quote(batch)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


# -- parsed payload ------------------------------------------------------------------------------

PAYLOAD_SCHEMA = f"{BRONZE_SCHEMA}, payload STRING, state STRING"


def write_payload(raw: DataFrame, out: str, batch: str, mode: str = "FAILFAST") -> None:
    """Parse ``raw`` once and write it as the payload of ``batch``.

    One row for each object, and one for each upload that gives none, under its ``state`` (``parsed``,
    ``empty``, ``malformed``, ``oversize``; with its text where it is bad). ``FAILFAST`` raises on a malformed
    upload. ``RECOVER`` adds the good objects of bad uploads under the state ``recovered``."""
    spark, path = raw.sparkSession, _folder(out, "payload", batch_folder(batch))
    parsed = raw.select(F.col("user_id").cast("string").alias("user_id"), "payload", upload_elements("payload", mode).alias("elements"))
    state = upload_state_of("payload", "elements")
    bad = state.isin("malformed", "oversize")
    each = parsed.select("user_id", state.alias("state"), F.when(bad, F.col("payload")).alias("payload"),
                         F.posexplode_outer("elements").alias("pos", "json"))
    rows = each.select("user_id", (F.col("pos") + 1).alias("array_index"), get_string("json", KEY_PROBE).alias("probe"),
                       get_double("json", KEY_TIMESTAMP).alias("timestamp"), get_string("json", KEY_GUID).alias("guid"),
                       "json", "payload", "state")
    _write_rows(rows, path, "overwrite")
    if mode.upper() == "RECOVER":
        rejected = rejected_uploads(spark, out, batch).select("user_id", "payload")
        _write_rows(recovered_rows(rejected).withColumns({"payload": F.lit(None).cast("string"), "state": F.lit("recovered")}), path, "append")


def _write_rows(rows: DataFrame, path: str, how: str) -> None:
    family = F.coalesce(probe_family(), F.lit(""))
    rows.withColumn(FAMILY_COL, family).write.mode(how).partitionBy("state", FAMILY_COL).parquet(path)


def read_payload(spark: SparkSession, out: str, batch: str | None = None) -> DataFrame:
    """The objects of one batch, or of all, as ``sensor_raw`` gives them (with ``probe_family``)."""
    rows = _payload(spark, out, batch).where(F.col("state").isin(*OBJECT_STATES) & F.col("array_index").isNotNull())
    return rows.select("user_id", "array_index", "probe", "timestamp", "guid", "json", FAMILY_COL)


def rejected_uploads(spark: SparkSession, out: str, batch: str | None = None) -> DataFrame:
    """The uploads that do not parse as a whole: ``user_id, reason, payload``."""
    rows = _payload(spark, out, batch).where(F.col("state").isin("malformed", "oversize"))
    return rows.select("user_id", F.col("state").alias("reason"), "payload")


def rejected_objects(spark: SparkSession, out: str, batch: str | None = None) -> DataFrame:
    """The single objects that ``RECOVER`` leaves out, with their places."""
    return object_rejects(rejected_uploads(spark, out, batch))


def upload_counts(spark: SparkSession, out: str, batch: str | None = None) -> DataFrame:
    """How many uploads are in each state: ``state, n``. An upload's first row stands for it."""
    rows = _payload(spark, out, batch).where((F.col("state") != "recovered") & (F.coalesce("array_index", F.lit(1)) == 1))
    return rows.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def _payload(spark: SparkSession, out: str, batch: str | None) -> DataFrame:
    if batch is not None:
        return _read(spark, _folder(out, "payload", batch_folder(batch)), PAYLOAD_SCHEMA)
    return _read(spark, _folder(out, "payload"), f"{PAYLOAD_SCHEMA}, batch STRING").drop("batch")


# -- state of a batch ----------------------------------------------------------------------------

def batch_state(location: DataFrame, sms: DataFrame, calls: DataFrame, event: DataFrame, objects: DataFrame) -> dict[str, DataFrame]:
    """The partial state of one batch's event tables and objects."""
    unknown = calls.where("callDuration is null").select("user_id", DAY).distinct()
    own = calls.select("user_id", DAY, "call_timestamp", "callDuration", "event_hour")
    return {
        "events": event.groupBy(*EVENT_KEY).agg(F.count(F.lit(1)).alias(N)),
        "calls": metrics.longest_calls(own).unionByName(
            unknown.select("user_id", DAY, F.lit(None).cast("timestamp").alias("call_timestamp"),
                           F.lit(None).cast("double").alias("callDuration"), F.lit(None).cast("int").alias("event_hour"))),
        "presence": presence_of(location, calls, sms, event),
        "probes": probe_types(objects),
    }


def write_state(state: dict[str, DataFrame], out: str, batch: str) -> None:
    """Write a batch's state in place of what it had. The days touched, before or now, are logged first."""
    spark = state["events"].sparkSession
    days = state["events"].select(DAY).union(state["calls"].select(DAY)).distinct()
    had = _batch_days(spark, out, batch)
    days.union(had).distinct().coalesce(1).write.mode("append").parquet(_folder(out, "state", "touched", batch_folder(batch)))
    for name, df in state.items():
        path = _folder(out, "state", name, batch_folder(batch))
        if DAY in df.columns:
            df.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)


def _batch_days(spark: SparkSession, out: str, batch: str) -> DataFrame:
    parts = [_read(spark, _folder(out, "state", name, batch_folder(batch)), STATE_SCHEMAS[name]).select(DAY) for name in ("events", "calls")]
    return parts[0].union(parts[1]).distinct()


def read_state(spark: SparkSession, out: str, name: str) -> DataFrame:
    """State rows of all batches."""
    return _read(spark, _folder(out, "state", name), STATE_SCHEMAS[name] + ", batch string").drop("batch")


# -- results -------------------------------------------------------------------------------------

def merged_events(state: DataFrame) -> DataFrame:
    return state.groupBy(*EVENT_KEY).agg(F.sum(N).alias(N))


def daily_results(spark: SparkSession, out: str, days: DataFrame | None = None, names: Sequence[str] = DAILY) -> dict[str, DataFrame]:
    """The daily measures from the merged state; of ``days`` (a column ``event_date``) only, if given."""

    def read(name: str) -> DataFrame:
        rows = read_state(spark, out, name)
        if days is None:
            return rows
        own = days.select(F.col(DAY).alias("_day")).distinct()
        # Plain equality first: it prunes partitions; days without a date are a partition of their own.
        dated = rows.join(own, F.col(DAY) == F.col("_day"), "left_semi")
        undated = rows.where(F.col(DAY).isNull()).join(own.where("_day is null").limit(1), how="left_semi")
        return dated.unionByName(undated)

    events = merged_events(read("events"))
    out_ = {n: FROM_EVENTS[n](events) for n in names if n in FROM_EVENTS}
    if "call_duration" in names:
        out_["call_duration"] = metrics.call_duration(read("calls"), ordered=False)
    return out_


def refresh(spark: SparkSession, out: str, batch: str | None = None, names: Sequence[str] = DAILY) -> dict[str, str]:
    """Bring the written daily results up to date with the state: the days that ``batch`` touches, or all.
    Returns the results' folders."""
    days = None
    if batch is not None:
        days = _read(spark, _folder(out, "state", "touched", batch_folder(batch)), f"{DAY} date").distinct()
        now = _batch_days(spark, out, batch).select(F.col(DAY).alias("_now"))
        if days.join(now, F.col(DAY).eqNullSafe(F.col("_now")), "left_anti").limit(1).count():
            days = None  # a day has left the batch: its results may have no rows any more
    paths = {}
    for name, df in daily_results(spark, out, days, names).items():
        paths[name] = _folder(out, "tables", name)
        partitions = "static" if days is None else "dynamic"
        if days is not None:
            kept = remove_at_exit(spark, scratch_path(spark, name))
            df.write.parquet(kept)
            df = spark.read.schema(df.schema).parquet(kept)
            if _emptied(_read(spark, paths[name], f"{DAY} date"), days, df):
                df, partitions = daily_results(spark, out, names=(name,))[name], "static"
        df.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", partitions).partitionBy(DAY).parquet(paths[name])
    return paths


def _emptied(written: DataFrame, days: DataFrame, rows: DataFrame) -> bool:
    """Whether one of ``days`` is among the rows written before, but not among the new ``rows``."""
    had, touched, now = (df.select(F.col(DAY).alias(alias)).distinct() for df, alias in ((written, "_had"), (days, "_touched"), (rows, "_now")))
    left = had.join(touched, F.col("_had").eqNullSafe(F.col("_touched")), "left_semi")
    return left.join(now, F.col("_had").eqNullSafe(F.col("_now")), "left_anti").limit(1).count() > 0


def read_result(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A written daily result, with the columns and the order of the operator's own."""
    df = daily_results(spark, out, names=(name,))[name]
    partition_last = [f for f in df.schema.fields if f.name != DAY] + [df.schema[DAY]]
    return spark.read.schema(type(df.schema)(partition_last)).parquet(_folder(out, "tables", name)).select(*[F.col(f"`{c}`") for c in df.columns])


# -- a batch from uploads to results -------------------------------------------------------------

def typed_tables(pl: DataFrame, hour_tz: str = "UTC", date_tz: str = "UTC") -> dict[str, DataFrame]:
    return {"probe_location": probes.probe_location(pl, hour_tz, date_tz), "probe_sms": probes.probe_sms(pl, hour_tz, date_tz),
            "probe_calls": probes.probe_calls(pl, hour_tz, date_tz), "probe_event": probes.probe_event(pl, hour_tz, date_tz)}


def add_batch(raw: DataFrame, out: str, batch: str, mode: str = "FAILFAST", hour_tz: str = "UTC", date_tz: str = "UTC",
              names: Sequence[str] = DAILY) -> None:
    """Take in a batch of uploads: payload, event tables, state and the results (``names``) of the days it touches."""
    spark = raw.sparkSession
    write_payload(raw, out, batch, mode)
    pl = read_payload(spark, out, batch)
    tables = {}
    for name, df in typed_tables(pl, hour_tz, date_tz).items():
        path = _folder(out, "tables", name, batch_folder(batch))
        df.write.mode("overwrite").parquet(path)
        tables[name] = spark.read.schema(df.schema).parquet(path)
    write_state(batch_state(*[tables[t] for t in EVENT_TABLES], objects=pl), out, batch)
    refresh(spark, out, batch, names)


def read_events(spark: SparkSession, out: str, name: str) -> DataFrame:
    """An event table of all batches."""
    pl = spark.createDataFrame([], BRONZE_SCHEMA)
    schema = typed_tables(pl)[name].schema
    return spark.read.schema(schema.add("batch", "string")).parquet(_folder(out, "tables", name)).drop("batch")


def presence(spark: SparkSession, out: str) -> DataFrame:
    return merged_presence(read_state(spark, out, "presence"))


def probe_counts(spark: SparkSession, out: str) -> DataFrame:
    return read_state(spark, out, "probes").groupBy("probe").agg(F.sum("n").alias("n"))
