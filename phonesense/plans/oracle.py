"""Independent DuckDB SQL for every registered query.

The oracle computes each result from the driver tables directly (the same
row mapping as :mod:`phonesense.sources.fixtures`, written again in SQL); it
never builds or parses the JSON payload, so it checks the parse path too.
"""

from __future__ import annotations

PREFIX = "sensing.probe.builtin."

BASE = f"""
WITH ev AS (
  SELECT event_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         user_id AS ub,
         epoch_us(ts) // 1000 AS ms
  FROM events
), d AS (
  SELECT *, CASE WHEN k <> 97 THEN 'u' || CAST(ub AS VARCHAR) END AS user_id,
         CASE WHEN k % 10 = 0 THEN NULL ELSE 'n' || CAST(event_id % 7 AS VARCHAR) END AS number,
         CASE WHEN k % 7 <> 0 THEN 'J' || chr(252) || 'rg "' || CAST(k % 5 AS VARCHAR) || '"' || chr(92) || chr(10) || '/'
              END AS name,
         CASE k % 2 WHEN 0 THEN 'home' ELSE 'work' END AS label, CAST(k % 4 AS VARCHAR) AS kind,
         CASE WHEN k % 29 = 0 THEN 'REJECTED' WHEN k % 3 = 0 THEN 'INCOMING' WHEN k % 3 = 1 THEN 'OUTGOING'
              ELSE 'MISSED' END AS dir_phone,
         CASE WHEN k % 11 = 0 THEN NULL WHEN k % 31 = 0 THEN 'MISSED' WHEN k % 2 = 0 THEN 'INCOMING'
              ELSE 'OUTGOING' END AS dir_sms,
         CASE WHEN event_type IN ('click', 'view') THEN 'CommunicationEventProbe'
              WHEN event_type = 'purchase' AND ub % 3 <> 0 THEN 'CommunicationLogProbe'
              WHEN event_type = 'signup' AND ub % 5 <> 0 THEN 'CommunicationLogProbe'
              WHEN event_type = 'error' AND ub % 2 = 0 THEN 'LocationProbe'
              ELSE 'BatteryProbe' END AS main_probe
  FROM ev
), raw AS (
  SELECT user_id, CAST(1 AS INTEGER) AS array_index, '{PREFIX}' || main_probe AS probe,
         ms / 1000 AS timestamp, 'g' || CAST(event_id AS VARCHAR) AS guid
  FROM d
  UNION ALL
  SELECT user_id, CAST(2 AS INTEGER), '{PREFIX}BatteryProbe', ms / 1000, 'g' || CAST(event_id AS VARCHAR)
  FROM d
), event_src AS (
  SELECT *, CASE WHEN k % 13 <> 0 THEN ms END AS at_ms FROM d WHERE event_type IN ('click', 'view')
), event AS (
  SELECT user_id, CAST(at_ms AS VARCHAR) AS comm_timestamp,
         CASE WHEN event_type = 'click' THEN dir_phone ELSE dir_sms END AS comm_direction,
         number,
         CASE WHEN event_type = 'view' THEN CASE WHEN k % 23 = 0 THEN 'MMS' ELSE 'SMS' END
              WHEN k % 19 <> 0 THEN 'PHONE' END AS communication_type,
         make_timestamp(at_ms * 1000) AS event_timestamp,
         CAST(hour(make_timestamp(at_ms * 1000)) AS INTEGER) AS event_hour,
         CAST(make_timestamp(at_ms * 1000) AS DATE) AS event_date
  FROM event_src
), call_src AS (
  SELECT user_id, number, name, label, kind, CASE WHEN k % 17 <> 0 THEN CAST(k AS DOUBLE) END AS dur,
         CASE WHEN k % 41 <> 0 THEN ms END AS at_ms
  FROM d WHERE main_probe = 'CommunicationLogProbe' AND event_type = 'purchase'
  UNION ALL
  SELECT user_id, number, name, label, kind, CAST(k % 5 AS DOUBLE), ms + 60000
  FROM d WHERE main_probe = 'CommunicationLogProbe' AND event_type = 'purchase'
), calls AS (
  SELECT user_id, name AS numberName, dur AS callDuration,
         label AS numberLabel, kind AS numberType, number,
         CAST(at_ms AS DOUBLE) AS callTimestamp, make_timestamp(at_ms * 1000) AS call_timestamp,
         CAST(hour(make_timestamp(at_ms * 1000)) AS INTEGER) AS event_hour,
         CAST(make_timestamp(at_ms * 1000) AS DATE) AS event_date
  FROM call_src
), sms AS (
  SELECT user_id, name AS numberName, dir_sms AS messageDirection, number,
         CAST(ms AS DOUBLE) AS messageTimestamp, make_timestamp(ms * 1000) AS msg_timestamp,
         CAST(hour(make_timestamp(ms * 1000)) AS INTEGER) AS event_hour,
         CAST(make_timestamp(ms * 1000) AS DATE) AS event_date
  FROM d WHERE main_probe = 'CommunicationLogProbe' AND event_type = 'signup'
), loc AS (
  SELECT user_id, ms / 1000 AS timestamp, (k % 2 = 0) AS gpsAvailable, value AS latitude,
         -value AS longitude, (k % 3 <> 0) AS networkAvailable,
         CASE WHEN k % 10 <> 0 THEN CAST(k AS DOUBLE) END AS accuracy,
         make_timestamp(ms * 1000) AS event_timestamp,
         CAST(hour(make_timestamp(ms * 1000)) AS INTEGER) AS event_hour,
         CAST(make_timestamp(ms * 1000) AS DATE) AS event_date
  FROM d WHERE main_probe = 'LocationProbe'
), reg AS (
  SELECT CASE WHEN c_custkey >= 4 THEN 'u' || CAST(c_custkey // 4 - 1 AS VARCHAR) END AS user_id,
         CASE WHEN c_custkey % 9 <> 0 THEN c_custkey END AS row_no, c_name AS name,
         c_name || '@x' AS email
  FROM customer
)
"""

TOD = """CASE WHEN {h} IS NULL THEN NULL
     WHEN {h} >= 3 AND {h} < 6 THEN 'Early Morning'
     WHEN {h} >= 6 AND {h} < 12 THEN 'Morning'
     WHEN {h} >= 12 AND {h} < 19 THEN 'Afternoon'
     WHEN {h} >= 19 AND {h} < 22 THEN 'Night'
     ELSE 'Late Night' END"""



def cells(col: str, values: list[str]) -> str:
    """A count for each value, one for all others and one for NULL; none of a kind is NULL."""
    listed = ", ".join(f"'{v}'" for v in values)
    hits = [(f'"{v}"', f"{col} = '{v}'") for v in values]
    hits += [('"OTHER"', f"{col} NOT IN ({listed})"), ('"<NA>"', f"{col} IS NULL")]
    return ", ".join(f"NULLIF(count(*) FILTER (WHERE {hit}), 0) AS {name}" for name, hit in hits)


MEAN = "CAST(ceil(count(*) * 1.0 / count(DISTINCT coalesce(comm_direction, '<NA>'))) AS BIGINT)"
UNIQUE = """
    SELECT e.user_id, e.number, e.event_date, u.count_unique FROM event e JOIN (
      SELECT user_id, event_date, count(DISTINCT coalesce(number, '<NA>')) AS count_unique
      FROM event WHERE communication_type = '{kind}' GROUP BY user_id, event_date) u
    ON e.user_id IS NOT DISTINCT FROM u.user_id AND e.event_date IS NOT DISTINCT FROM u.event_date
    WHERE e.communication_type = '{kind}'"""

TABLES = {
    "sensor_raw": "SELECT * FROM raw",
    "probe_types": "SELECT probe, count(*) AS n FROM raw GROUP BY probe",
    "probe_location": "SELECT * FROM loc",
    "probe_sms": "SELECT * FROM sms",
    "probe_calls": "SELECT * FROM calls",
    "probe_event": "SELECT * FROM event",
    "time_of_day": f"SELECT user_id, call_timestamp, event_hour, {TOD.format(h='event_hour')} AS time_of_day FROM calls",
    "sensor_population": """
        SELECT f.user_id, f.row_no, f.name,
          CASE WHEN EXISTS (SELECT 1 FROM loc x WHERE x.user_id IS NOT DISTINCT FROM f.user_id) THEN 'Available' ELSE 'NotAvailable' END AS location,
          CASE WHEN EXISTS (SELECT 1 FROM calls x WHERE x.user_id IS NOT DISTINCT FROM f.user_id) THEN 'Available' ELSE 'NotAvailable' END AS calls,
          CASE WHEN EXISTS (SELECT 1 FROM sms x WHERE x.user_id IS NOT DISTINCT FROM f.user_id) THEN 'Available' ELSE 'NotAvailable' END AS sms,
          CASE WHEN EXISTS (SELECT 1 FROM event x WHERE x.user_id IS NOT DISTINCT FROM f.user_id) THEN 'Available' ELSE 'NotAvailable' END AS event
        FROM (SELECT * FROM reg QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY row_no NULLS LAST) = 1) f""",
    "commtype_long": """
        SELECT user_id, event_date, communication_type AS category, count(*) AS n FROM event GROUP BY ALL""",
    "directions_long": """
        SELECT user_id, event_date, communication_type, comm_direction AS category, count(*) AS n
        FROM event GROUP BY ALL""",
    "count_commtype": f"""
        SELECT user_id, event_date, {cells('communication_type', ['PHONE', 'SMS'])}
        FROM event GROUP BY user_id, event_date""",
    "stats_phone": f"""
        SELECT user_id, event_date, {MEAN} AS average_no_calls,
          {cells('comm_direction', ['INCOMING', 'MISSED', 'OUTGOING'])}
        FROM event WHERE communication_type = 'PHONE' GROUP BY user_id, event_date""",
    "stats_sms": f"""
        SELECT user_id, event_date, {MEAN} AS average_no_messages,
          {cells('comm_direction', ['INCOMING', 'OUTGOING'])}
        FROM event WHERE communication_type = 'SMS' GROUP BY user_id, event_date""",
    "ratio_phone": f"""
        SELECT *, OUTGOING / INCOMING AS ratio FROM (
          SELECT user_id, event_date, {cells('comm_direction', ['INCOMING', 'MISSED', 'OUTGOING'])}
          FROM event WHERE communication_type = 'PHONE' GROUP BY user_id, event_date)""",
    "ratio_sms": f"""
        SELECT *, OUTGOING / INCOMING AS ratio FROM (
          SELECT user_id, event_date, {cells('comm_direction', ['INCOMING', 'OUTGOING'])}
          FROM event WHERE communication_type = 'SMS' GROUP BY user_id, event_date)""",
    "call_duration": f"""
        SELECT user_id, call_timestamp, event_date, callDuration, 'max_time' AS max_time,
               {TOD.format(h='event_hour')} AS time_of_day
        FROM (SELECT *, max(callDuration) OVER day AS longest, count(*) OVER day AS n, count(callDuration) OVER day AS known
              FROM calls WINDOW day AS (PARTITION BY user_id, event_date))
        WHERE n = known AND callDuration = longest""",
    "unique_texts": UNIQUE.format(kind='SMS'),
    "unique_calls": UNIQUE.format(kind='PHONE'),
    "upload_rejects": """
        SELECT user_id, 'malformed' AS reason, '{"PROBE":"' || CAST(event_id AS VARCHAR) AS payload
        FROM d WHERE event_id % 7 = 0""",
    "upload_report": """
        SELECT CASE WHEN event_id % 7 = 0 THEN 'malformed' WHEN event_id % 11 = 0 THEN 'empty' ELSE 'parsed' END AS state,
               count(*) AS n
        FROM d GROUP BY ALL""",
}
# Four events an upload, each with a first object, of which some are bad, and a battery object.
BAD_OBJECTS = f"""
    e AS (
      SELECT event_id, event_id // 4 AS upload, first_value(user_id) OVER (PARTITION BY event_id // 4 ORDER BY event_id) AS ub,
        CASE WHEN event_id % 7 = 0 THEN 'text' WHEN event_id % 11 = 0 THEN 'nested' WHEN event_id % 13 = 0 THEN 'literal'
             WHEN event_id % 17 = 0 THEN 'brace' ELSE 'good' END AS kind,
        '{{"PROBE":"{PREFIX}EventProbe","GUID":"g' || event_id AS head,
        '","LOG":[{{"A":"x}},{{y"}},{{"B":[1,2]}}]' AS log,
        '{{"PROBE":"{PREFIX}BatteryProbe","GUID":"b' || event_id || '","LEVEL":{{"V":1}}}}' AS battery
      FROM events
    ), m AS (
      SELECT *, 'u' || ub AS user_id, CASE kind WHEN 'text' THEN head WHEN 'nested' THEN head || '","LOG":[{{"A":1}},{{"B":2}}'
        WHEN 'literal' THEN head || '","TIMESTAMP":tru}}' WHEN 'brace' THEN head || log || '}}}}'
        ELSE head || log || ',"TIMESTAMP":' || event_id || '}}' END AS main
      FROM e
    ), o AS (
      SELECT *, coalesce(sum(2) OVER before, 0) AS n,
        coalesce(sum(len(main) + len(battery) + 2) OVER before, 0) AS spot
      FROM m WINDOW before AS (PARTITION BY upload ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    )"""
TABLES["recovered_objects"] = f"""
    SELECT * FROM (WITH {BAD_OBJECTS}
      SELECT user_id, CAST(n + 1 AS INTEGER) AS array_index, '{PREFIX}EventProbe' AS probe, CAST(event_id AS DOUBLE) AS timestamp,
        'g' || event_id AS guid FROM o WHERE kind = 'good'
      UNION ALL
      SELECT user_id, CAST(n + 2 AS INTEGER), '{PREFIX}BatteryProbe', NULL, 'b' || event_id FROM o)"""
TABLES["object_rejects"] = f"""
    SELECT * FROM (WITH {BAD_OBJECTS}
      SELECT user_id, CAST(n + 1 AS INTEGER) AS array_index, CAST(spot AS BIGINT) AS position, 'malformed' AS reason,
        main AS object FROM o WHERE kind <> 'good')"""
TABLES["longest_calls_ranked"] = f"""
    SELECT *, row_number() OVER (ORDER BY call_timestamp NULLS LAST, user_id NULLS LAST, event_date NULLS LAST, callDuration,
      max_time, time_of_day NULLS LAST) AS position FROM ({TABLES['call_duration']})"""
TABLES["stats_phone_ranked"] = f"""
    SELECT *, row_number() OVER (ORDER BY user_id NULLS LAST, event_date NULLS LAST) AS position FROM ({TABLES['stats_phone']})"""
# Customer keys are in the names; a participant's first row is that of the first file, there that of the largest key.
TABLES["register_file_order"] = """
    SELECT user_id, email, key, 'line one,' || chr(10) || 'line "two" of ' || key AS name FROM (
      SELECT *, CAST(regexp_extract(email, '([0-9]+)', 1) AS BIGINT) AS key FROM reg)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY key * 5 % 12, key DESC) = 1"""
for _name in ("count_commtype", "stats_phone", "unique_texts", "call_duration"):
    TABLES[f"appended_{_name}"] = TABLES[_name]
for _name, _col in (("commtype_map", "communication_type"), ("contacts_map", "number")):
    TABLES[_name] = f"""
        SELECT user_id, event_date,
          '{{' || coalesce(string_agg(CASE WHEN c IS NOT NULL THEN '"' || c || '":' || n END, ',' ORDER BY c), '') || '}}' AS counts,
          CAST(max(CASE WHEN c IS NULL THEN n END) AS BIGINT) AS unknown
        FROM (SELECT user_id, event_date, {_col} AS c, count(*) AS n FROM event GROUP BY ALL) GROUP BY user_id, event_date"""
TABLES["commtype_from_map"] = TABLES["count_commtype"]
TABLES["sensor_population_known"] = TABLES["sensor_population"]
TABLES["csv_uploads_event"] = TABLES["probe_event"]
TABLES["csv_register_population"] = TABLES["sensor_population"]
EAST = """
    SELECT * EXCLUDE (event_timestamp, event_hour, event_date), east AS event_timestamp,
      CAST(hour(east) AS INTEGER) AS event_hour, CAST(east AS DATE) AS event_date
    FROM (SELECT *, event_timestamp + INTERVAL 3 HOUR AS east FROM event)"""
TABLES["json_probeevent_nairobi"] = EAST


def java_double_text(x: str) -> str:
    """DuckDB expression printing a DOUBLE the way the JVM JSON writer does:
    shortest digits, plain below 1e7, ``d.dddE<n>`` from 1e7 on (the fixture
    has no non-zero magnitude below 1e-3)."""
    s = f"CAST(abs({x}) AS VARCHAR)"
    ip, fp = f"split_part({s}, '.', 1)", f"split_part({s}, '.', 2)"
    digits = f"rtrim({ip} || {fp}, '0')"
    mant = (f"left({digits}, 1) || '.' || CASE WHEN length({digits}) > 1 "
            f"THEN substr({digits}, 2) ELSE '0' END")
    sci = (f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END) || {mant} || 'E' || "
           f"CAST(length({ip}) - 1 AS VARCHAR)")
    return f"(CASE WHEN abs({x}) >= 1e7 THEN {sci} ELSE CAST({x} AS VARCHAR) END)"


def _piece(name: str, kind: str) -> str:
    col = f'"{name}"'
    if kind == "str":
        value = f"CASE WHEN {col} IS NOT NULL THEN CAST(to_json({col}) AS VARCHAR) END"
    elif kind in ("int", "bool"):
        value = f"CAST({col} AS VARCHAR)"
    elif kind == "dbl":
        value = java_double_text(f"round({col}, 4)")
    elif kind == "date":
        value = f"'\"' || strftime({col}, '%Y-%m-%d') || '\"'"
    elif kind == "ts":
        value = f"'\"' || strftime({col}, '%Y-%m-%d %H:%M:%S') || '\"'"
    else:
        raise ValueError(kind)
    return f"""'"{name}":' || {value}"""


def json_rows(source_sql: str, fields: list[tuple[str, str]]) -> str:
    pieces = ", ".join(_piece(n, k) for n, k in fields)
    return f"SELECT '{{' || concat_ws(',', {pieces}) || '}}' AS json FROM ({source_sql}) AS src"


S, I, B, D, DT, TS = "str", "int", "bool", "dbl", "date", "ts"
REST = [("OTHER", I), ("<NA>", I)]
JSON = {
    "json_probelocation": ("probe_location", [("user_id", S), ("timestamp", D), ("gpsAvailable", B),
                           ("latitude", D), ("longitude", D), ("networkAvailable", B), ("accuracy", D),
                           ("event_timestamp", TS), ("event_hour", I), ("event_date", DT)]),
    "json_probesms": ("probe_sms", [("user_id", S), ("numberName", S), ("messageDirection", S),
                      ("number", S), ("messageTimestamp", D), ("msg_timestamp", TS), ("event_hour", I),
                      ("event_date", DT)]),
    "json_probecalls": ("probe_calls", [("user_id", S), ("numberName", S), ("callDuration", D),
                        ("numberLabel", S), ("numberType", S), ("number", S), ("callTimestamp", D),
                        ("call_timestamp", TS), ("event_hour", I), ("event_date", DT)]),
    "json_probeevent": ("probe_event", [("user_id", S), ("comm_timestamp", S), ("comm_direction", S),
                        ("number", S), ("communication_type", S), ("event_timestamp", TS),
                        ("event_hour", I), ("event_date", DT)]),
    "json_sensorpop": ("sensor_population", [("user_id", S), ("row_no", I), ("name", S),
                       ("location", S), ("calls", S), ("sms", S), ("event", S)]),
    "json_commtype": ("count_commtype", [("user_id", S), ("event_date", DT), ("PHONE", I), ("SMS", I), *REST]),
    "json_statsphone": ("stats_phone", [("user_id", S), ("event_date", DT), ("average_no_calls", I),
                        ("INCOMING", I), ("MISSED", I), ("OUTGOING", I), *REST]),
    "json_statssms": ("stats_sms", [("user_id", S), ("event_date", DT), ("average_no_messages", I),
                      ("INCOMING", I), ("OUTGOING", I), *REST]),
    "json_ratiophone": ("ratio_phone", [("user_id", S), ("event_date", DT), ("INCOMING", I),
                        ("MISSED", I), ("OUTGOING", I), *REST, ("ratio", D)]),
    "json_ratiosms": ("ratio_sms", [("user_id", S), ("event_date", DT), ("INCOMING", I),
                      ("OUTGOING", I), *REST, ("ratio", D)]),
    "json_callduration": ("call_duration", [("user_id", S), ("call_timestamp", TS), ("event_date", DT),
                          ("callDuration", D), ("max_time", S), ("time_of_day", S)]),
    "json_uniquetext": ("unique_texts", [("user_id", S), ("number", S), ("event_date", DT),
                        ("count_unique", I)]),
    "json_uniquecalls": ("unique_calls", [("user_id", S), ("number", S), ("event_date", DT),
                         ("count_unique", I)]),
}


JSON["json_probeevent_nairobi"] = ("json_probeevent_nairobi", JSON["json_probeevent"][1])


def oracle_sql() -> dict[str, str]:
    out = {name: BASE + body for name, body in TABLES.items()}
    for name, (table, fields) in JSON.items():
        out[name] = BASE + json_rows(TABLES[table], fields)
    return out
