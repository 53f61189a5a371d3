import pytest

from phonesense.operators.metrics import count_commtype
from phonesense.operators.probes import probe_event
from phonesense.plans.bronze import read_bronze
from phonesense.streaming import read_upload_stream, start_payload_ingest, start_reject_log

EV = ('{{"PROBE":"a.CommunicationEventProbe","COMM_TIMESTAMP":"{ms}","COMMUNICATION_TYPE":"{t}",'
      '"COMMUNICATION_DIRECTION":"INCOMING"}}')


def test_stream_ingest_is_incremental_and_exactly_once(spark, tmp_path):
    land, out, ckpt = tmp_path / "land", tmp_path / "pl", tmp_path / "ckpt"
    land.mkdir()
    batch1 = spark.createDataFrame([("u1", EV.format(ms=1499856123456, t="PHONE")),
                                    ("u2", '{"PROBE":"a.BatteryProbe"},' + EV.format(ms=1499856123456, t="SMS"))],
                                   "user_id string, payload string")
    batch1.write.mode("append").parquet(str(land))
    q = start_payload_ingest(read_upload_stream(spark, str(land), fmt="parquet"), str(out), str(ckpt),
                             trigger={"availableNow": True})
    q.awaitTermination(120)
    assert read_bronze(spark, str(out)).count() == 3

    spark.createDataFrame([("u1", EV.format(ms=1499942523456, t="PHONE")), ("u3", "{broken")],
                          "user_id string, payload string").write.mode("append").parquet(str(land))
    uploads = read_upload_stream(spark, str(land), fmt="parquet")
    q = start_payload_ingest(uploads, str(out), str(ckpt), trigger={"availableNow": True}, mode="PERMISSIVE")
    q.awaitTermination(120)
    pl = read_bronze(spark, str(out))
    assert pl.count() == 4  # earlier files not re-ingested; the malformed upload gives no rows
    q = start_reject_log(uploads, str(tmp_path / "rejects"), str(tmp_path / "ck2"), trigger={"availableNow": True})
    q.awaitTermination(120)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == [("u3", "malformed", "{broken")]
    days = {(r.user_id, str(r.event_date)): (r.PHONE, r.SMS) for r in count_commtype(probe_event(pl)).collect()}
    assert days == {("u1", "2017-07-12"): (1, None), ("u2", "2017-07-12"): (None, 1),
                    ("u1", "2017-07-13"): (1, None)}


def test_stream_from_quoted_csv_files(spark, tmp_path):
    import csv
    land, out = tmp_path / "land", tmp_path / "pl"
    land.mkdir()
    with open(land / "part-0.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["user_id", "payload", "device"])
        w.writerow(["u1", EV.format(ms=1499856123456, t="SMS") + ',{"PROBE":"a.BatteryProbe"}', "phone-1"])
        w.writerow(["u2", "NA", "phone-2"])
    q = start_payload_ingest(read_upload_stream(spark, str(land), fmt="csv"), str(out), str(tmp_path / "ck"),
                             trigger={"availableNow": True})
    q.awaitTermination(120)
    pl = read_bronze(spark, str(out))
    assert sorted(r.probe for r in pl.collect()) == ["a.BatteryProbe", "a.CommunicationEventProbe"]


def test_malformed_upload_stops_the_stream_by_default(spark, tmp_path):
    land = tmp_path / "land"
    spark.createDataFrame([("u3", "{broken")], "user_id string, payload string").write.parquet(str(land))
    q = start_payload_ingest(read_upload_stream(spark, str(land), fmt="parquet"), str(tmp_path / "out"),
                             str(tmp_path / "ck"), trigger={"availableNow": True})
    with pytest.raises(Exception, match="MALFORMED"):
        q.awaitTermination(120)


def test_stream_columns_are_found_by_name(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.csv").write_text('device,payload,user_id\nd1,"{""PROBE"":""a.B""}",u1\n')
    uploads = read_upload_stream(spark, str(land))
    q = start_payload_ingest(uploads, str(tmp_path / "pl"), str(tmp_path / "ck"), trigger={"availableNow": True})
    q.awaitTermination(120)
    assert [(r.user_id, r.probe) for r in read_bronze(spark, str(tmp_path / "pl")).collect()] == [("u1", "a.B")]
    (land / "b.csv").write_text('user_id,payload,device\nu2,"{""PROBE"":""a.B""}",d1\n')
    q = start_payload_ingest(uploads, str(tmp_path / "pl"), str(tmp_path / "ck"), trigger={"availableNow": True})
    with pytest.raises(Exception):
        q.awaitTermination(120)
