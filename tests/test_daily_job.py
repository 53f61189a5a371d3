import csv
import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))


def test_daily_job_end_to_end(spark, tmp_path):
    from daily_job import main
    up = tmp_path / "uploads.csv"
    with open(up, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["user_id", "payload"])
        w.writerow(["u1", '{"PROBE":"a.CommunicationEventProbe","COMM_TIMESTAMP":"1499856123456",'
                          '"COMMUNICATION_TYPE":"PHONE","COMMUNICATION_DIRECTION":"INCOMING","NUMBER":"5"},'
                          '{"PROBE":"a.CommunicationLogProbe","PHONE_CALLS":[{"CALL_DURATION":4,'
                          '"CALL_TIMESTAMP":1499856123456,"NUMBER":"5"}]}'])
        w.writerow(["u2", "{broken"])
    reg = tmp_path / "register.csv"
    reg.write_text("user_id,email\nu1,a@x\nu3,b@x\n")
    out = tmp_path / "out"
    main(["--uploads", str(up), "--register", str(reg), "--out", str(out), "--json", "--mode", "PERMISSIVE"])
    assert [(r.user_id, r.reason) for r in spark.read.parquet(str(out / "rejects")).collect()] == [("u2", "malformed")]
    assert {r.state: r.n for r in spark.read.parquet(str(out / "upload_report")).collect()} == {"parsed": 1, "malformed": 1}
    counts = spark.read.parquet(str(out / "tables" / "count_commtype")).collect()
    assert [(r.user_id, r.PHONE, r.SMS) for r in counts] == [("u1", 1, None)]
    pop = {r.user_id: (r.calls, r.event) for r in spark.read.parquet(str(out / "tables" / "sensor_population")).collect()}
    assert pop == {"u1": ("Available", "Available"), "u3": ("NotAvailable", "NotAvailable")}
    lines = [json.loads(x) for p in (out / "json" / "call_duration").glob("part-*") for x in p.read_text().splitlines()]
    assert lines == [{"user_id": "u1", "call_timestamp": "2017-07-12 10:42:03", "event_date": "2017-07-12",
                      "callDuration": 4.0, "max_time": "max_time", "time_of_day": "Morning"}]


def test_daily_job_parquet_uploads_without_register(spark, tmp_path):
    from daily_job import main
    src = tmp_path / "uploads"
    spark.createDataFrame(
        [(7, '{"PROBE":"a.LocationProbe","TIMESTAMP":1499856123.456,"LATITUDE":1.25,"GPS_AVAILABLE":1}', "x")],
        "user_id bigint, payload string, device string").write.parquet(str(src))
    out = tmp_path / "out"
    main(["--uploads", str(src), "--format", "parquet", "--out", str(out), "--hour-tz", "Africa/Nairobi"])
    loc = spark.read.parquet(str(out / "tables" / "probe_location")).first()
    assert (loc.user_id, loc.latitude, loc.gpsAvailable, loc.event_hour) == ("7", 1.25, True, 13)
    assert not (out / "tables" / "sensor_population").exists()


def test_daily_job_stops_on_malformed_uploads_and_adds_new_ones(spark, tmp_path):
    from daily_job import main
    up, out = tmp_path / "uploads.csv", tmp_path / "out"
    event = '{""PROBE"":""a.CommunicationEventProbe"",""COMM_TIMESTAMP"":""%d"",""COMMUNICATION_TYPE"":""SMS"",\n""NUMBER"":""1""}'
    up.write_text("user_id,payload\nu1,\"" + event % 1499856123456 + '"\n')
    main(["--uploads", str(up), "--out", str(out), "--multi-line"])
    new = tmp_path / "new.csv"
    new.write_text("payload,user_id\n\"" + event % 1499856123456 + '",u1\n"' + event % 1499856123456 + '",u2\n')
    main(["--uploads", str(new), "--out", str(out), "--multi-line", "--append"])
    counts = {r.user_id: r.SMS for r in spark.read.parquet(str(out / "tables" / "count_commtype")).collect()}
    assert counts == {"u1": 2, "u2": 1}
    bad = tmp_path / "bad.csv"
    bad.write_text('user_id,payload\nu1,"{broken"\n')
    with pytest.raises(Exception, match="MALFORMED"):
        main(["--uploads", str(bad), "--out", str(tmp_path / "out2")])
