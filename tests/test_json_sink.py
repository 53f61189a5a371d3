import datetime as dt
import json

from phonesense.operators import export
from phonesense.operators.payload import sensor_raw
from phonesense.sources.json_sink import to_json_rows, write_json_rows


def test_null_fields_omitted_doubles_rounded_dates_formatted(spark):
    df = spark.createDataFrame([(2, None, 36.8219462, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 600000))],
                               "a int, b string, lat double, d date, t timestamp")
    text = to_json_rows(df).first().json
    assert text == '{"a":2,"lat":36.8219,"d":"2024-01-02","t":"2024-01-02 03:04:05"}'
    assert to_json_rows(df, digits=None).first().json.count("36.8219462") == 1


def test_write_json_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.123456)], "a int, x double")
    write_json_rows(df, str(tmp_path / "out"))
    lines = [ln for p in (tmp_path / "out").glob("part-*") for ln in p.read_text().splitlines()]
    assert [json.loads(ln) for ln in lines] == [{"a": 1, "x": 0.1235}]


def test_json_wrappers_return_one_text_column(spark, uploads):
    pl = sensor_raw(uploads([("u1", '{"PROBE":"a.CommunicationEventProbe","COMM_TIMESTAMP":"1499856123456",'
                                    '"COMMUNICATION_TYPE":"PHONE","COMMUNICATION_DIRECTION":"INCOMING","NUMBER":"5"}')]))
    reg = spark.createDataFrame([("u1", "e@x", 1)], "user_id string, email string, ord int")
    for fn in (export.json_probeevent, export.json_commtype, export.json_statsphone, export.json_ratiophone,
               export.json_uniquecalls):
        out = fn(pl)
        assert out.columns == ["json"] and json.loads(out.first().json)["user_id"] == "u1"
    assert json.loads(export.json_commtype(pl).first().json) == {
        "user_id": "u1", "event_date": "2017-07-12", "PHONE": 1}
    assert json.loads(export.json_sensorpop(pl, reg, order_col="ord").first().json) == {
        "user_id": "u1", "ord": 1, "location": "NotAvailable", "calls": "NotAvailable", "sms": "NotAvailable",
        "event": "Available"}


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(0.00005,), (-0.00005,), (2.00015,)], "x double")
    import json as _json
    assert [_json.loads(r.json)["x"] for r in to_json_rows(df).collect()] == [0.0001, -0.0001, 2.0002]
