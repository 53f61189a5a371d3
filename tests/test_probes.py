import datetime as dt

from conftest import obj
from phonesense.operators.payload import sensor_raw
from phonesense.operators.probes import probe_calls, probe_event, probe_location, probe_sms


def _pl(uploads, *objects):
    return sensor_raw(uploads([("u1", ",".join(objects))]))


def test_log_arrays_missing_null_empty_or_object_give_no_rows(uploads):
    pl = _pl(uploads, obj("CommunicationLogProbe"), obj("CommunicationLogProbe", PHONE_CALLS="null"),
             obj("CommunicationLogProbe", PHONE_CALLS="[]"), obj("CommunicationLogProbe", PHONE_CALLS="{}"),
             obj("CommunicationLogProbe", SMS_MESSAGES="null"))
    assert probe_calls(pl).count() == 0 and probe_sms(pl).count() == 0


def test_null_array_element_gives_an_all_null_row(uploads):
    pl = _pl(uploads, obj("CommunicationLogProbe",
                          PHONE_CALLS='[{"CALL_DURATION":3,"NUMBER":"a"},null,{"CALL_DURATION":4}]'))
    rows = probe_calls(pl).collect()
    assert len(rows) == 3
    assert sorted((r.callDuration is None, r.number or "") for r in rows) == [(False, ""), (False, "a"), (True, "")]


def test_calls_schema_and_coercions(uploads):
    pl = _pl(uploads, obj("CommunicationLogProbe", PHONE_CALLS='[{"CALL_DURATION":"1.5","NUMBER":5,'
                          '"CALL_TIMESTAMP":1499856123456},{"CALL_DURATION":"abc"}]'))
    df = probe_calls(pl)
    assert df.columns == ["user_id", "numberName", "callDuration", "numberLabel", "numberType", "number",
                          "callTimestamp", "call_timestamp", "event_hour", "event_date"]
    rows = sorted(df.collect(), key=lambda r: r.callDuration is None)
    assert rows[0].callDuration == 1.5 and rows[0].number == "5"
    assert rows[0].call_timestamp == dt.datetime(2017, 7, 12, 10, 42, 3, 456000)
    assert rows[1].callDuration is None


def test_sms_schema(uploads):
    pl = _pl(uploads, obj("CommunicationLogProbe", PHONE_CALLS="[]", SMS_MESSAGES=(
        '[{"NUMBER":"n","MESSAGE_DIRECTION":"INCOMING","MESSAGE_TIMESTAMP":1499856123456}]')))
    df = probe_sms(pl)
    assert df.columns == ["user_id", "numberName", "messageDirection", "number", "messageTimestamp",
                          "msg_timestamp", "event_hour", "event_date"]
    r = df.first()
    assert (r.messageDirection, r.event_hour, r.event_date) == ("INCOMING", 10, dt.date(2017, 7, 12))


def test_location_booleans_numbers_and_seconds(uploads):
    pl = _pl(uploads, obj("LocationProbe", TIMESTAMP="1499856123.456", GPS_AVAILABLE="1",
                          LATITUDE='"1.5"', LONGITUDE='"abc"', ACCURACY="3"))
    df = probe_location(pl)
    assert df.columns == ["user_id", "timestamp", "gpsAvailable", "latitude", "longitude",
                          "networkAvailable", "accuracy", "event_timestamp", "event_hour", "event_date"]
    r = df.first()
    assert (r.gpsAvailable, r.latitude, r.longitude, r.networkAvailable, r.accuracy) == (True, 1.5, None, None, 3.0)
    assert r.event_timestamp == dt.datetime(2017, 7, 12, 10, 42, 3, 456000)


def test_comm_timestamp_as_text_or_number_is_the_same_instant(uploads):
    pl = _pl(uploads,
             obj("CommunicationEventProbe", COMM_TIMESTAMP='"1499856123456"', COMMUNICATION_TYPE='"SMS"'),
             obj("CommunicationEventProbe", COMM_TIMESTAMP="1499856123456", COMMUNICATION_TYPE='"SMS"'))
    df = probe_event(pl)
    assert df.columns == ["user_id", "comm_timestamp", "comm_direction", "number", "communication_type",
                          "event_timestamp", "event_hour", "event_date"]
    rows = df.collect()
    assert {r.comm_timestamp for r in rows} == {"1499856123456"}
    assert {r.event_timestamp for r in rows} == {dt.datetime(2017, 7, 12, 10, 42, 3, 456000)}


def test_bad_comm_timestamp_gives_null_instant(uploads):
    pl = _pl(uploads, obj("CommunicationEventProbe", COMM_TIMESTAMP='"soon"'))
    r = probe_event(pl).first()
    assert r.event_timestamp is None and r.event_hour is None and r.event_date is None


def test_hour_and_date_zones_are_independent(uploads):
    pl = _pl(uploads, obj("CommunicationEventProbe", COMM_TIMESTAMP='"1499898123457"'))
    utc = probe_event(pl).first()
    assert (utc.event_hour, utc.event_date) == (22, dt.date(2017, 7, 12))
    nbo = probe_event(pl, hour_tz="Africa/Nairobi").first()
    assert (nbo.event_hour, nbo.event_date) == (1, dt.date(2017, 7, 12))
    both = probe_event(pl, hour_tz="Africa/Nairobi", date_tz="Africa/Nairobi").first()
    assert both.event_date == dt.date(2017, 7, 13)
