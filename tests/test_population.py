import pytest

from phonesense.operators.population import sensor_population, sensor_population_from_payload
from phonesense.operators.payload import sensor_raw


def test_first_row_kept_flags_and_email_dropped(spark):
    reg = spark.createDataFrame([("u1", "first", "a@x", 2), ("u1", "second", "b@x", 5), ("u2", "other", "c@x", 3),
                                 ("u1", "zeroth", "d@x", 9)], "user_id string, name string, email string, ord int")
    loc = spark.createDataFrame([("u1",)], "user_id string")
    empty = spark.createDataFrame([], "user_id string")
    ev = spark.createDataFrame([("u2",), ("u2",)], "user_id string")
    df = sensor_population(reg, loc, empty, empty, ev, order_col="ord")
    assert df.columns == ["user_id", "name", "ord", "location", "calls", "sms", "event"]
    got = {r.user_id: tuple(r) for r in df.collect()}
    assert got == {"u1": ("u1", "first", 2, "Available", "NotAvailable", "NotAvailable", "NotAvailable"),
                   "u2": ("u2", "other", 3, "NotAvailable", "NotAvailable", "NotAvailable", "Available")}


def test_null_ids_match_and_ids_compare_as_text(spark):
    reg = spark.createDataFrame([(None, "n@x", 1), (7, "s@x", 2)], "user_id bigint, email string, ord int")
    loc = spark.createDataFrame([(None,), ("7",)], "user_id string")
    empty = spark.createDataFrame([], "user_id string")
    df = sensor_population(reg, loc, empty, empty, empty, order_col="ord", keep_order_col=False)
    assert df.columns == ["user_id", "location", "calls", "sms", "event"]
    assert {(r.user_id, r.location) for r in df.collect()} == {(None, "Available"), ("7", "Available")}


def test_payload_form_matches_table_form(spark, uploads):
    from phonesense.operators.probes import probe_calls, probe_event, probe_location, probe_sms
    up = uploads([
        ("u1", '{"PROBE":"a.CommunicationLogProbe","PHONE_CALLS":[],"SMS_MESSAGES":[{"NUMBER":"1"}]}'),
        ("u2", '{"PROBE":"a.CommunicationLogProbe","PHONE_CALLS":[{"NUMBER":"1"}]}'),
        ("u3", '{"PROBE":"a.LocationProbe"},{"PROBE":"a.CommunicationEventProbe"}'),
        ("u4", '{"PROBE":"a.BatteryProbe"}')])
    pl = sensor_raw(up)
    reg = spark.createDataFrame([(f"u{i}", i) for i in range(1, 6)], "user_id string, ord int")
    a = sensor_population(reg, probe_location(pl), probe_calls(pl), probe_sms(pl), probe_event(pl), order_col="ord")
    b = sensor_population_from_payload(reg, pl, order_col="ord")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert {r.user_id: (r.location, r.calls, r.sms, r.event) for r in b.collect()}["u1"] == (
        "NotAvailable", "NotAvailable", "Available", "NotAvailable")


def test_register_columns_with_dots_and_spaces(spark):
    reg = spark.createDataFrame([("u1", "a@x", "s", 1), ("u1", "b@x", "t", 0)],
                                "user_id string, email string, `site.name` string, `row no` int")
    empty = spark.createDataFrame([], "user_id string")
    df = sensor_population(reg, empty, empty, empty, empty, order_col="row no")
    assert df.columns == ["user_id", "site.name", "row no", "location", "calls", "sms", "event"]
    assert df.first()["site.name"] == "t"


def test_register_without_order_column_is_refused(spark):
    reg = spark.createDataFrame([("u1", "a@x", "first")], "user_id string, email string, site string")
    empty = spark.createDataFrame([], "user_id string")
    with pytest.raises(ValueError, match="order"):
        sensor_population(reg, empty, empty, empty, empty)


def test_row_without_position_is_last_but_not_lost(spark):
    reg = spark.createDataFrame([("u1", "late", None), ("u1", "first", 3), ("u2", "only", None)],
                                "user_id string, name string, ord int")
    empty = spark.createDataFrame([], "user_id string")
    got = {r.user_id: r.name for r in sensor_population(reg, empty, empty, empty, empty, order_col="ord").collect()}
    assert got == {"u1": "first", "u2": "only"}
