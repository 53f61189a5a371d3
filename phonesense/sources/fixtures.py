"""Derive phone-upload and participant-register tables from the driver's
generic ``events`` and ``customer`` tables.

Every derived column is a plain function of one source row, so the build is
a row-local Project (no shuffle) and grows with the source tables. The same
derivation is written independently in DuckDB SQL for the oracle checks; the
oracle never parses the JSON built here.

Mapping (one upload row per event, payload = main object "," battery object):

* ``k`` = integer inside ``props``; participant ``u<user_id>``, unknown when
  ``k = 97``; ``ms`` = epoch milliseconds of ``ts`` (floor).
* ``number`` = ``n<event_id % 7>``, omitted when ``k % 10 = 0``.
* ``name``: text with a quote, a backslash, a line break and a letter outside
  ASCII, omitted when ``k % 7 = 0``; label and type of the number by ``k``.
* click -> CommunicationEventProbe, PHONE (type omitted when ``k % 19 = 0``),
  direction by ``k % 3``, REJECTED when ``k % 29 = 0``.
* view -> CommunicationEventProbe, SMS (MMS when ``k % 23 = 0``), direction by
  ``k % 2``, MISSED when ``k % 31 = 0``, omitted when ``k % 11 = 0``.
* both leave their time out when ``k % 13 = 0``.
* purchase (``user_id % 3 <> 0``) -> CommunicationLogProbe with two calls
  (duration ``k`` omitted when ``k % 17 = 0``, at ``ms``, which is omitted when
  ``k % 41 = 0``; duration ``k % 5`` at ``ms + 60000``).
* signup (``user_id % 5 <> 0``) -> CommunicationLogProbe with
  ``PHONE_CALLS = []`` and one SMS.
* error (``user_id % 2 = 0``) -> LocationProbe.
* anything else -> BatteryProbe (ignored by every extractor).

The ``user_id`` conditions give some participants no data for a probe, which the
availability matrix needs; no row is dropped. Participants, and so
participant-days, grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

PROBE_PREFIX = "sensing.probe.builtin."
REGISTER_ROWS = 4


def _obj(probe: str, *fields: str) -> str:
    """SQL text of one probe object: common head fields then ``fields``
    (alternating key, SQL expression)."""
    head = [f"'PROBE', '{PROBE_PREFIX}{probe}'", "'TIMESTAMP', ms / 1000", "'GUID', guid"]
    return "to_json(named_struct(" + ", ".join(head + list(fields)) + "))"


def _comm_event(kind: str, direction: str) -> str:
    return _obj("CommunicationEventProbe", f"'COMMUNICATION_TYPE', {kind}",
                f"'COMMUNICATION_DIRECTION', {direction}", "'NUMBER', number",
                "'COMM_TIMESTAMP', IF(k % 13 = 0, NULL, CAST(ms AS STRING))")


_CALLS = ("array("
          "named_struct('CALL_DURATION', CAST(IF(k % 17 <> 0, k, NULL) AS DOUBLE), "
          "'CALL_TIMESTAMP', IF(k % 41 = 0, NULL, ms), 'NUMBER', number, 'NUMBER_NAME', name, "
          "'NUMBER_LABEL', label, 'NUMBER_TYPE', kind), "
          "named_struct('CALL_DURATION', CAST(k % 5 AS DOUBLE), "
          "'CALL_TIMESTAMP', ms + 60000, 'NUMBER', number, 'NUMBER_NAME', name, "
          "'NUMBER_LABEL', label, 'NUMBER_TYPE', kind))")
_SMS = ("array(named_struct('NUMBER', number, 'NUMBER_NAME', name, 'MESSAGE_DIRECTION', dir_sms, "
        "'MESSAGE_TIMESTAMP', ms))")
_NO_CALLS = "CAST(array() AS ARRAY<STRUCT<CALL_DURATION: DOUBLE>>)"
_BATTERY = _obj("BatteryProbe", "'LEVEL', k")

_DERIVED = [
    "event_id", "event_type", "value", "user_id AS ub",
    "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k",
]
# Epoch milliseconds (floor) of ``ts``, independent of the session zone: a
# TIMESTAMP_NTZ wall clock is read as UTC, a TIMESTAMP is already an instant.
_MS_FROM_NTZ = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS ms"
_MS_FROM_LTZ = "unix_millis(ts) AS ms"
_KEYED = [
    "*",
    "IF(k = 97, NULL, concat('u', CAST(ub AS STRING))) AS uid",
    "concat('g', CAST(event_id AS STRING)) AS guid",
    "IF(k % 10 = 0, NULL, concat('n', CAST(event_id % 7 AS STRING))) AS number",
    "IF(k % 7 = 0, NULL, concat('J', chr(252), 'rg ', chr(34), CAST(k % 5 AS STRING), chr(34), chr(92), chr(10), '/')) AS name",
    "element_at(array('home', 'work'), CAST(k % 2 + 1 AS INT)) AS label",
    "CAST(k % 4 AS STRING) AS kind",
    "IF(k % 29 = 0, 'REJECTED', element_at(array('INCOMING', 'OUTGOING', 'MISSED'), CAST(k % 3 + 1 AS INT))) AS dir_phone",
    "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 31 = 0 THEN 'MISSED' WHEN k % 2 = 0 THEN 'INCOMING' ELSE 'OUTGOING' END AS dir_sms",
    "IF(k % 19 = 0, NULL, 'PHONE') AS type_phone",
    "IF(k % 23 = 0, 'MMS', 'SMS') AS type_sms",
]
_MAIN = f"""CASE
  WHEN event_type = 'click' THEN {_comm_event('type_phone', 'dir_phone')}
  WHEN event_type = 'view' THEN {_comm_event('type_sms', 'dir_sms')}
  WHEN event_type = 'purchase' AND ub % 3 <> 0 THEN {_obj('CommunicationLogProbe', "'PHONE_CALLS'", _CALLS)}
  WHEN event_type = 'signup' AND ub % 5 <> 0 THEN {_obj('CommunicationLogProbe', "'PHONE_CALLS'", _NO_CALLS,
                                                        "'SMS_MESSAGES'", _SMS)}
  WHEN event_type = 'error' AND ub % 2 = 0 THEN {_obj('LocationProbe', "'GPS_AVAILABLE'", "k % 2 = 0",
                                                      "'LATITUDE'", "value", "'LONGITUDE'", "-value",
                                                      "'NETWORK_AVAILABLE'", "k % 3 <> 0",
                                                      "'ACCURACY'", "CAST(IF(k % 10 <> 0, k, NULL) AS DOUBLE)")}
  ELSE {_BATTERY}
END"""


def uploads_from_events(events: DataFrame, *extra: str) -> DataFrame:
    """``events`` -> uploads ``(user_id STRING, payload STRING)``; NULL fields
    are left out of the JSON objects."""
    ms = _MS_FROM_NTZ if events.schema["ts"].dataType.typeName() == "timestamp_ntz" else _MS_FROM_LTZ
    keyed = events.selectExpr(*_DERIVED, ms).selectExpr(*_KEYED)
    return keyed.selectExpr("uid AS user_id", f"concat_ws(',', {_MAIN}, {_BATTERY}) AS payload", *extra)


def register_from_customers(customer: DataFrame) -> DataFrame:
    """``customer`` -> participant register ``(user_id, row_no, name, email)``.

    ``row_no`` (= ``c_custkey``) is the register's row order, unknown for one
    row of some participants; each id stands there ``REGISTER_ROWS`` times, the
    unknown participant among them, and many have no uploads.
    """
    return customer.select(
        F.expr(f"IF(c_custkey < {REGISTER_ROWS}, NULL, concat('u', CAST(c_custkey DIV {REGISTER_ROWS} - 1 AS STRING)))")
        .alias("user_id"),
        F.expr("IF(c_custkey % 9 = 0, NULL, c_custkey)").alias("row_no"),
        F.col("c_name").alias("name"),
        F.concat(F.col("c_name"), F.lit("@x")).alias("email"),
    )


def read_driver_table(spark, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver's (read-only) tables, as it is now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_uploads(spark, sf_dir: str, spread: int | None = None) -> DataFrame:
    """The uploads; ``spread`` deals the narrow event rows to that many tasks before the text is built from them (the
    driver's table is one row group, so one task would build and parse all of it)."""
    events = read_driver_table(spark, sf_dir, "events")
    return uploads_from_events(events.repartition(spread) if spread else events)


def fixture_register(spark, sf_dir: str) -> DataFrame:
    return register_from_customers(read_driver_table(spark, sf_dir, "customer"))


def damaged_uploads(spark, sf_dir: str) -> DataFrame:
    """The uploads with some of them damaged: cut short where ``event_id`` is a
    multiple of 7, emptied where it is one of 11."""
    uploads = uploads_from_events(read_driver_table(spark, sf_dir, "events"), "event_id")
    short = F.concat(F.lit('{"PROBE":"'), F.col("event_id").cast("string"))
    return uploads.select("user_id", F.when(F.col("event_id") % 7 == 0, short)
                          .when(F.col("event_id") % 11 == 0, F.lit("")).otherwise(F.col("payload")).alias("payload"))


def uploads_with_bad_objects(spark, sf_dir: str) -> DataFrame:
    """Uploads of four events each (``event_id DIV 4``, the participant that of the first), two objects an
    event, with single objects spoilt: the first one is cut short inside a text where ``event_id``
    is a multiple of 7, after a nested object for 11, has a bad literal for 13 and a brace too
    many for 17. The good ones hold a text that looks like the end of an object."""
    events = read_driver_table(spark, sf_dir, "events")
    e = F.col("event_id")
    head = F.concat(F.lit(f'{{"PROBE":"{PROBE_PREFIX}EventProbe","GUID":"g'), e.cast("string"))
    log = F.lit('","LOG":[{"A":"x},{y"},{"B":[1,2]}]')
    main = (F.when(e % 7 == 0, head)
            .when(e % 11 == 0, F.concat(head, F.lit('","LOG":[{"A":1},{"B":2}')))
            .when(e % 13 == 0, F.concat(head, F.lit('","TIMESTAMP":tru}')))
            .when(e % 17 == 0, F.concat(head, log, F.lit("}}")))
            .otherwise(F.concat(head, log, F.lit(',"TIMESTAMP":'), e.cast("string"), F.lit("}"))))
    battery = F.concat(F.lit(f'{{"PROBE":"{PROBE_PREFIX}BatteryProbe","GUID":"b'), e.cast("string"), F.lit('","LEVEL":{"V":1}}'))
    each = events.select(e, "user_id", F.concat(main, F.lit(","), battery).alias("objects"))
    own = each.groupBy(F.floor(e / 4).alias("upload")).agg(
        F.min_by("user_id", "event_id").alias("user_id"), F.array_sort(F.collect_list(F.struct("event_id", "objects"))).alias("all"))
    return own.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"),
                      F.array_join(F.transform("all", lambda o: o["objects"]), ",").alias("payload"))


def write_register_files(spark, sf_dir: str, path: str, files: int = 12) -> None:
    """The register as CSV files ``file=1`` to ``file=12``, a participant's rows in several of them, in falling
    order of ``c_custkey``; names hold line breaks, and the column ``key`` tells the row."""
    customer = read_driver_table(spark, sf_dir, "customer")
    register = register_from_customers(customer).drop("name", "row_no")
    key = F.regexp_extract("email", r"([0-9]+)", 1).cast("long")
    rows = register.withColumn("key", key).withColumn("name", F.concat(F.lit("line one,\nline \"two\" of "), key.cast("string")))
    rows = rows.withColumn("file", F.pmod(key * 5, F.lit(files)) + 1)
    rows.repartition("file").sortWithinPartitions("file", F.desc("key")).write.partitionBy("file").options(
        header=True, quote='"', escape='"', nullValue="NA").csv(path)
