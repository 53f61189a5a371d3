"""Random event tables (NULLs in every key) against a plain-Python statement
of each rule."""

import datetime as dt
import math
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings, strategies as st

from phonesense.operators import metrics

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

event_rows = st.lists(st.tuples(
    st.sampled_from(["a", "b", None]), st.sampled_from([D1, D2, None]),
    st.sampled_from(["PHONE", "SMS", "FAX", None]), st.sampled_from(["INCOMING", "OUTGOING", "MISSED", None]),
    st.sampled_from(["x", "y", "z", None])), min_size=0, max_size=60)

call_rows = st.lists(st.tuples(
    st.sampled_from(["a", "b", None]), st.sampled_from([D1, D2, None]),
    st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5, 7.0])), st.integers(0, 23)), min_size=0, max_size=40)

EVENT = "user_id string, event_date date, communication_type string, comm_direction string, number string"


def _key(v):
    return (v is None, v if v is not None else "")


def _groups(rows, pred):
    g = defaultdict(list)
    for r in rows:
        if pred(r):
            g[(r[0], r[1])].append(r)
    return g


@SETTINGS
@given(event_rows)
def test_daily_counts_stats_ratio(spark, rows):
    ev = spark.createDataFrame(rows, EVENT)
    want_ct = {k: tuple((sum(1 for r in v if r[2] == t) or None) for t in ("PHONE", "SMS"))
               + tuple((sum(1 for r in v if hit(r[2])) or None) for hit in (
                   lambda t: t not in ("PHONE", "SMS", None), lambda t: t is None))
               for k, v in _groups(rows, lambda r: True).items()}
    got_ct = {(r.user_id, r.event_date): tuple(r)[2:] for r in metrics.count_commtype(ev).collect()}
    assert got_ct == want_ct

    want_stats, want_ratio = {}, {}
    for k, v in _groups(rows, lambda r: r[2] == "PHONE").items():
        c = Counter(r[3] for r in v)
        known = ("INCOMING", "MISSED", "OUTGOING")
        other = sum(n for d, n in c.items() if d is not None and d not in known) or None
        cells = (*[c.get(d) for d in known], other, c.get(None))
        want_stats[k] = (math.ceil(len(v) / len(c)),) + cells
        out, inc = c.get("OUTGOING"), c.get("INCOMING")
        want_ratio[k] = cells + ((out / inc) if out and inc else None,)
    got_stats = {(r.user_id, r.event_date): tuple(r)[2:] for r in metrics.stats_phone(ev).collect()}
    got_ratio = {(r.user_id, r.event_date): tuple(r)[2:] for r in metrics.ratio_phone(ev).collect()}
    assert got_stats == want_stats and got_ratio == want_ratio


@SETTINGS
@given(event_rows)
def test_unique_contacts(spark, rows):
    ev = spark.createDataFrame(rows, EVENT)
    groups = _groups(rows, lambda r: r[2] == "SMS")
    want = sorted(((r[0], r[4], r[1], len({x[4] for x in groups[(r[0], r[1])]})) for r in rows if r[2] == "SMS"),
                  key=lambda t: tuple(map(_key, t)))
    got = sorted(map(tuple, metrics.unique_texts(ev).collect()), key=lambda t: tuple(map(_key, t)))
    assert got == want


@SETTINGS
@given(call_rows)
def test_longest_call(spark, rows):
    base = dt.datetime(2024, 1, 1)
    full = [(u, d, base + dt.timedelta(minutes=i), dur, h) for i, (u, d, dur, h) in enumerate(rows)]
    calls = spark.createDataFrame(
        full, "user_id string, event_date date, call_timestamp timestamp, callDuration double, event_hour int")
    want = []
    for (u, d), v in _groups(full, lambda r: True).items():
        if any(r[3] is None for r in v):
            continue
        top = max(r[3] for r in v)
        want += [(u, r[2], d, r[3]) for r in v if r[3] == top]
    got = [(r.user_id, r.call_timestamp, r.event_date, r.callDuration) for r in metrics.call_duration(calls).collect()]
    assert [g[1] for g in got] == sorted(g[1] for g in got)
    assert sorted(got, key=lambda t: t[1]) == sorted(want, key=lambda t: t[1])


reg_rows = st.lists(st.tuples(st.sampled_from([1, 2, 3, None]), st.sampled_from(["p", "q", None])),
                    min_size=0, max_size=25)
presence = st.lists(st.sampled_from(["1", "2", "4", None]), max_size=6)


@SETTINGS
@given(reg_rows, presence, presence, presence, presence)
def test_availability_matrix(spark, reg, loc, calls, sms, event):
    from phonesense.operators.population import sensor_population
    register = spark.createDataFrame([(u, s, f"e{i}", i) for i, (u, s) in enumerate(reg)],
                                     "user_id int, site string, email string, ord int")
    tables = [spark.createDataFrame([(u,) for u in t], "user_id string") for t in (loc, calls, sms, event)]
    got = {(r.user_id, r.site, r.ord, r.location, r.calls, r.sms, r.event)
           for r in sensor_population(register, *tables, order_col="ord").collect()}
    want, seen = set(), set()
    for i, (u, s) in enumerate(reg):
        key = None if u is None else str(u)
        if key in seen:
            continue
        seen.add(key)
        flags = tuple("Available" if key in set(t) else "NotAvailable" for t in (loc, calls, sms, event))
        want.add((key, s, i) + flags)
    assert got == want


_calls_value = st.one_of(
    st.just("MISSING"), st.none(), st.just({}), st.just("text"),
    st.lists(st.one_of(st.none(), st.fixed_dictionaries({}, optional={
        "CALL_DURATION": st.one_of(st.none(), st.sampled_from([0, 3, 12.5])),
        "NUMBER": st.one_of(st.none(), st.sampled_from(["a", "b"])),
        "CALL_TIMESTAMP": st.integers(1_400_000_000_000, 1_800_000_000_000)})), max_size=3))
_objects = st.lists(st.fixed_dictionaries({
    "PROBE": st.sampled_from(["a.CommunicationLogProbe", "CommunicationLogProbe", "b.x.CommunicationLogProbe",
                              "a.CommunicationLogProbeX", None]),
    "PHONE_CALLS": _calls_value}), min_size=0, max_size=4)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["u1", "u2"]), _objects), min_size=1, max_size=6))
def test_parse_and_explode_calls(spark, uploads_rows):
    import json as _json

    from phonesense.operators.payload import sensor_raw
    from phonesense.operators.probes import probe_calls
    rows, want = [], []
    for user, objs in uploads_rows:
        texts = []
        for o in objs:
            d = {k: v for k, v in o.items() if v != "MISSING"}
            texts.append(_json.dumps(d))
            probe, calls = d.get("PROBE"), d.get("PHONE_CALLS")
            if probe and probe.endswith(".CommunicationLogProbe") and isinstance(calls, list):
                for c in calls:
                    c = c or {}
                    dur = c.get("CALL_DURATION")
                    want.append((user, None if dur is None else float(dur), c.get("NUMBER"),
                                 None if c.get("CALL_TIMESTAMP") is None else float(c["CALL_TIMESTAMP"])))
        rows.append((user, ",".join(texts)))
    df = probe_calls(sensor_raw(spark.createDataFrame(rows, "user_id string, payload string")))
    got = [(r.user_id, r.callDuration, r.number, r.callTimestamp) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


json_rows = st.lists(st.tuples(
    st.one_of(st.none(), st.text(alphabet="ab\"\\/é\n", max_size=4)),
    st.one_of(st.none(), st.integers(-10**12, 10**12)),
    st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)),
    st.one_of(st.none(), st.dates(dt.date(1990, 1, 1), dt.date(2040, 1, 1))),
    st.one_of(st.none(), st.datetimes(dt.datetime(1990, 1, 1), dt.datetime(2040, 1, 1)))), max_size=8)


def _half_up(x: float) -> float:
    """Spark's round(x, 4): half-up on the shortest decimal form of x."""
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(x)).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)) + 0.0  # -0.0 prints as 0.0


@SETTINGS
@given(json_rows)
def test_json_rows_round_trip(spark, rows):
    import json as _json

    from phonesense.sources.json_sink import to_json_rows
    df = spark.createDataFrame(rows, "s string, n bigint, x double, d date, t timestamp_ntz")
    got = sorted((_json.loads(r.json) for r in to_json_rows(df).collect()), key=repr)
    want = []
    for s, n, x, d, t in rows:
        obj = {"s": s, "n": n, "x": None if x is None else _half_up(x),
               "d": None if d is None else d.isoformat(),
               "t": None if t is None else t.strftime("%Y-%m-%d %H:%M:%S")}
        want.append({k: v for k, v in obj.items() if v is not None})
    assert got == sorted(want, key=repr)
