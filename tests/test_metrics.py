import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from phonesense.operators import grouped, metrics

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
EVENT = "user_id string, event_date date, communication_type string, comm_direction string, number string"
CALLS = "user_id string, event_date date, call_timestamp timestamp, callDuration double, event_hour int"


def events(spark, rows):
    return spark.createDataFrame(rows, EVENT)


def calls(spark, rows):
    base = dt.datetime(2024, 1, 1, 0, 0)
    return spark.createDataFrame(
        [(u, d, base + dt.timedelta(minutes=i), dur, h) for i, (u, d, dur, h) in enumerate(rows)], CALLS)


def test_count_commtype_absent_cells_are_null(spark):
    ev = events(spark, [("a", D1, "PHONE", "IN", None), ("a", D1, "PHONE", "IN", None), ("a", D2, "SMS", None, None)])
    got = {(r.user_id, r.event_date): (r.PHONE, r.SMS) for r in metrics.count_commtype(ev).collect()}
    assert got == {("a", D1): (2, None), ("a", D2): (None, 1)}
    assert metrics.count_commtype(ev).columns == ["user_id", "event_date", "PHONE", "SMS", "OTHER", "<NA>"]


def test_count_commtype_dynamic_columns_include_null_label(spark):
    ev = events(spark, [("a", D1, "PHONE", None, None), ("a", D1, None, None, None), ("a", D1, "FAX", None, None)])
    df = metrics.count_commtype(ev, types=None)
    assert df.columns == ["user_id", "event_date", "FAX", "PHONE", "<NA>"]
    assert tuple(df.first())[2:] == (1, 1, 1)


def test_stats_mean_over_directions_present(spark):
    ev = events(spark, [("a", D1, "PHONE", "INCOMING", None)] * 2 + [("a", D1, "PHONE", "OUTGOING", None)])
    r = metrics.stats_phone(ev).first()
    assert metrics.stats_phone(ev).columns == ["user_id", "event_date", "average_no_calls",
                                               "INCOMING", "MISSED", "OUTGOING", "OTHER", "<NA>"]
    assert (r.average_no_calls, r.INCOMING, r.MISSED, r.OUTGOING) == (2, 2, None, 1)


def test_stats_null_direction_is_a_direction(spark):
    ev = events(spark, [("a", D1, "SMS", "INCOMING", None), ("a", D1, "SMS", None, None)])
    r = metrics.stats_sms(ev).first()
    assert metrics.stats_sms(ev).columns == ["user_id", "event_date", "average_no_messages", "INCOMING", "OUTGOING",
                                             "OTHER", "<NA>"]
    assert (r.average_no_messages, r.INCOMING, r.OUTGOING, r.OTHER, r["<NA>"]) == (1, 1, None, None, 1)


def test_ratio(spark):
    ev = events(spark, [("a", D1, "PHONE", "INCOMING", None)] * 2 + [("a", D1, "PHONE", "OUTGOING", None)]
                + [("b", D1, "PHONE", "OUTGOING", None)])
    got = {r.user_id: r.ratio for r in metrics.ratio_phone(ev).collect()}
    assert got == {"a": 0.5, "b": None}
    assert metrics.ratio_phone(ev).columns == ["user_id", "event_date", "INCOMING", "MISSED", "OUTGOING",
                                               "OTHER", "<NA>", "ratio"]
    assert metrics.ratio_sms(ev.filter("false")).columns == ["user_id", "event_date", "INCOMING", "OUTGOING",
                                                             "OTHER", "<NA>", "ratio"]


def test_ratio_only_outgoing_everywhere_is_null_not_an_error(spark):
    ev = events(spark, [("a", D1, "SMS", "OUTGOING", None)])
    assert metrics.ratio_sms(ev).first().ratio is None


def test_call_duration_keeps_ties_and_drops_days_with_unknown_duration(spark):
    c = calls(spark, [("a", D1, 9.0, 4), ("a", D1, 9.0, 13), ("a", D1, 5.0, 20),
                      ("b", D1, 4.0, 1), ("b", D1, None, 1), ("b", D2, 7.0, 23)])
    df = metrics.call_duration(c)
    assert df.columns == ["user_id", "call_timestamp", "event_date", "callDuration", "max_time", "time_of_day"]
    rows = df.collect()
    assert [(r.user_id, r.event_date, r.callDuration, r.max_time, r.time_of_day) for r in rows] == [
        ("a", D1, 9.0, "max_time", "Early Morning"), ("a", D1, 9.0, "max_time", "Afternoon"),
        ("b", D2, 7.0, "max_time", "Late Night")]
    ts = [r.call_timestamp for r in rows]
    assert ts == sorted(ts)


def test_call_duration_poisoned_day_spread_over_many_tasks(spark):
    rows = [("h", D1, float(i % 50), 10) for i in range(4000)] + [("h", D1, None, 10)] * 300
    c = calls(spark, rows).repartition(16)
    assert metrics.call_duration(c).count() == 0
    clean = calls(spark, [r for r in rows if r[2] is not None]).repartition(16)
    assert metrics.call_duration(clean).count() == 80  # 4000 / 50 calls tie at 49


def test_unique_contacts_counts_null_once(spark):
    ev = events(spark, [("a", D1, "SMS", None, "x"), ("a", D1, "SMS", None, "x"), ("a", D1, "SMS", None, None),
                        ("a", D1, "PHONE", None, "y"), ("a", D2, "SMS", None, "z")])
    df = metrics.unique_texts(ev)
    assert df.columns == ["user_id", "number", "event_date", "count_unique"]
    got = sorted((r.event_date, r.number or "", r.count_unique) for r in df.collect())
    assert got == [(D1, "", 2), (D1, "x", 2), (D1, "x", 2), (D2, "z", 1)]
    assert metrics.unique_calls(ev).first().count_unique == 1


def test_unique_contacts_on_hot_and_null_groups(spark):
    rows = ([("hot", D1, "PHONE", None, f"n{i % 37}") for i in range(3000)]
            + [(f"c{i % 40}", D1 + dt.timedelta(days=i % 3), "PHONE", None, f"m{i % 7}") for i in range(600)]
            + [(None, None, "PHONE", None, None)] * 3)
    ev = events(spark, rows).repartition(8)
    df = metrics.unique_calls(ev)
    got = {}
    for r in df.collect():
        got.setdefault((r.user_id, r.event_date), set()).add(r.count_unique)
    assert Counter((r.user_id, r.number, r.event_date) for r in df.collect()) == Counter((u, n, d) for u, d, _, _, n in rows)
    assert got[("hot", D1)] == {37} and got[(None, None)] == {1}
    assert all(v == {5} for k, v in got.items() if k[0] and k[0].startswith("c"))


def test_attach_group_values_and_write_out(spark, monkeypatch):
    monkeypatch.setattr(grouped, "PIECE", 7)
    data = [("k1", i % 3) for i in range(50)] + [("k2", None)] * 5 + [(None, 1)] * 2
    rows = spark.createDataFrame(data, "k string, x int").repartition(4)
    out = grouped.attach_group_values(grouped.counted(rows, ["k"]), ["k"], kinds=(F.count(F.lit(1)), "sum"), top=(F.max("x"), "max"))
    got = Counter(map(tuple, grouped.written_out(out).collect()))
    kinds = {"k1": (3, 2), "k2": (1, None), None: (1, 1)}
    assert got == Counter((k, x, *kinds[k]) for k, x in data)


def test_every_event_is_in_one_column(spark):
    """The counts of a day add up to its events, whatever the categories."""
    rows = [("a", D1, "PHONE", "REJECTED", None), ("a", D1, "MMS", "INCOMING", None), ("a", D1, None, None, None),
            ("a", D1, "SMS", "MISSED", None), ("a", D1, "SMS", None, None), ("a", D1, "SMS", "INCOMING", None)]
    ev = events(spark, rows)
    r = metrics.count_commtype(ev).first()
    assert (r.PHONE, r.SMS, r.OTHER, r["<NA>"]) == (1, 3, 1, 1)
    r = metrics.stats_sms(ev).first()
    assert (r.average_no_messages, r.INCOMING, r.OUTGOING, r.OTHER, r["<NA>"]) == (1, 1, None, 1, 1)
    r = metrics.stats_phone(ev).first()
    assert (r.INCOMING, r.MISSED, r.OUTGOING, r.OTHER, r["<NA>"]) == (None, None, None, 1, None)
    r = metrics.ratio_sms(ev, directions=["OUTGOING"]).first()
    assert (r.OUTGOING, r.OTHER, r["<NA>"], r.ratio) == (None, 2, 1, None)
    assert sum(r.n for r in metrics.commtype_long(ev).collect()) == len(rows)
    long = {(r.communication_type, r.category): r.n for r in metrics.directions_long(ev).collect()}
    assert long == {("PHONE", "REJECTED"): 1, ("MMS", "INCOMING"): 1, (None, None): 1, ("SMS", "MISSED"): 1,
                    ("SMS", None): 1, ("SMS", "INCOMING"): 1}


def test_data_derived_columns_have_no_limit(spark):
    ev = events(spark, [("a", D1, f"T{i}", None, None) for i in range(1200)])
    assert len(metrics.count_commtype(ev, types=None).columns) == 1202


def test_ordered_output_and_data_derived_directions(spark):
    ev = events(spark, [("b", D2, "PHONE", "OUTGOING", None), ("a", D2, "PHONE", "BUSY", None),
                        ("a", D1, "PHONE", None, None), ("a", D1, "PHONE", "INCOMING", None)])
    df = metrics.stats_phone(ev, directions=None, ordered=True)
    assert df.columns == ["user_id", "event_date", "average_no_calls", "BUSY", "INCOMING", "OUTGOING", "<NA>"]
    assert [(r.user_id, r.event_date) for r in df.collect()] == [("a", D1), ("a", D2), ("b", D2)]
    first = df.first()
    assert (first.average_no_calls, first.INCOMING, first["<NA>"], first.BUSY) == (1, 1, 1, None)
    ratio = metrics.ratio_phone(ev, directions=None, ordered=True)
    assert ratio.columns[-1] == "ratio" and "<NA>" in ratio.columns
    assert [r.ratio for r in ratio.collect()] == [None, None, None]
    ct = metrics.count_commtype(ev, ordered=True)
    assert [(r.user_id, r.event_date, r.PHONE) for r in ct.collect()] == [("a", D1, 2), ("a", D2, 1), ("b", D2, 1)]


def test_ordered_outputs_put_missing_values_last(spark):
    c = spark.createDataFrame([("a", D1, None, 5.0, 3), ("b", D1, dt.datetime(2024, 1, 1, 9), 2.0, 9)], CALLS)
    assert [r.user_id for r in metrics.call_duration(c).collect()] == ["b", "a"]
    ev = events(spark, [(None, D1, "SMS", None, None), ("a", None, "SMS", None, None), ("a", D1, "SMS", None, None)])
    got = [(r.user_id, r.event_date) for r in metrics.count_commtype(ev, ordered=True).collect()]
    assert got == [("a", D1), ("a", None), (None, D1)]


def test_unique_contacts_with_no_rows_of_that_type(spark):
    ev = events(spark, [("a", D1, "PHONE", None, "x")])
    df = metrics.unique_texts(ev)
    assert df.columns == ["user_id", "number", "event_date", "count_unique"] and df.count() == 0
    assert metrics.call_duration(calls(spark, [])).count() == 0


def test_data_derived_columns_on_empty_input(spark):
    ev = events(spark, [])
    assert metrics.count_commtype(ev, types=None).columns == ["user_id", "event_date"]
    assert metrics.stats_sms(ev, directions=None).columns == ["user_id", "event_date", "average_no_messages"]
    assert metrics.ratio_sms(ev, directions=None).columns == ["user_id", "event_date", "ratio"]
