import csv

import pytest

from phonesense.operators.payload import sensor_raw, upload_rejects, upload_report
from phonesense.operators.population import sensor_population
from phonesense.sources.uploads import read_register, read_uploads


def test_quoted_csv_payload_is_read_whole(spark, tmp_path):
    payloads = ['{"PROBE":"a.X","T":1},{"PROBE":"a.Y","NOTE":"comma, and \\"quote\\""}', None, ""]
    path = tmp_path / "uploads.csv"
    with open(path, "w", newline="") as f:
        w = csv.writer(f, quoting=csv.QUOTE_MINIMAL)
        w.writerow(["user_id", "payload", "extra"])
        w.writerow(["u1", payloads[0], "x"])
        w.writerow(["u2", "NA", "y"])
        w.writerow(["u3", "", "z"])
    up = read_uploads(spark, str(path))
    assert up.columns == ["user_id", "payload"]
    got = {r.user_id: r.payload for r in up.collect()}
    assert got["u1"] == payloads[0] and got["u2"] is None
    assert sensor_raw(up).count() == 2


def test_register_keeps_first_row_in_file_order(spark, tmp_path):
    path = tmp_path / "register.csv"
    path.write_text("user_id,email,site\nu2,a@x,s1\nu1,b@x,s2\nu2,c@x,s3\n")
    reg = read_register(spark, str(path))
    loc = spark.createDataFrame([("u1",)], "user_id string")
    empty = spark.createDataFrame([], "user_id string")
    df = sensor_population(reg, loc, empty, empty, empty)
    assert df.columns == ["user_id", "site", "location", "calls", "sms", "event"]
    assert {r.user_id: (r.site, r.location) for r in df.collect()} == {
        "u2": ("s1", "NotAvailable"), "u1": ("s2", "Available")}


def test_parquet_uploads(spark, tmp_path):
    src = spark.createDataFrame([(1, '{"PROBE":"a.B"}', 3)], "user_id bigint, payload string, other int")
    src.write.parquet(str(tmp_path / "up"))
    up = read_uploads(spark, str(tmp_path / "up"), fmt="parquet")
    assert up.dtypes == [("user_id", "string"), ("payload", "string")]
    assert "other" not in up._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_catalog_table_uploads(spark):
    spark.createDataFrame([("u9", '{"PROBE":"a.B"}')], "user_id string, payload string") \
        .createOrReplaceTempView("phone_uploads")
    up = read_uploads(spark, "phone_uploads", fmt="table")
    assert sensor_raw(up).first().probe == "a.B"


def test_register_order_follows_files_then_lines(spark, tmp_path):
    d = tmp_path / "reg"
    d.mkdir()
    (d / "part-b.csv").write_text("user_id,email,site\nu1,x@x,late\nu3,y@x,only\n")
    (d / "part-a.csv").write_text("user_id,email,site\n" + "".join(f"u9,{i}@x,filler{i}\n" for i in range(200))
                                  + "u1,z@x,early\n")
    reg = read_register(spark, str(d))
    empty = spark.createDataFrame([], "user_id string")
    got = {r.user_id: r.site for r in sensor_population(reg, empty, empty, empty, empty).collect()}
    assert got == {"u1": "early", "u3": "only", "u9": "filler0"}


def test_declared_csv_schema_must_agree_with_the_header(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text('payload,user_id\n"{""PROBE"":""a.B""}",u1\n')
    assert read_uploads(spark, str(path)).first().user_id == "u1"
    with pytest.raises(Exception):
        read_uploads(spark, str(path), schema="user_id string, payload string").collect()


def test_every_upload_is_accounted_for(spark):
    raw = spark.createDataFrame([("a", '{"PROBE":"x.B"}'), ("a", None), ("b", ""), ("b", "  "), ("c", "{bad"), (None, "}"),
                                 ("d", '{"a":1},{"b":2}')], "user_id string, payload string")
    report = {r.state: r.n for r in upload_report(raw).collect()}
    assert report == {"parsed": 2, "empty": 3, "malformed": 2}
    assert sorted((r.user_id or "", r.reason, r.payload) for r in upload_rejects(raw).collect()) == [
        ("", "malformed", "}"), ("c", "malformed", "{bad")]
    assert sensor_raw(raw, mode="PERMISSIVE").count() == 3


def test_oversize_is_told_from_malformed(spark, monkeypatch):
    monkeypatch.setattr("phonesense.operators.payload.VARIANT_LIMIT", 100)
    raw = spark.createDataFrame([("a", '{"PROBE":"' + "x" * 200 + '"}'), ("b", "{bad")], "user_id string, payload string")
    assert {r.user_id: r.reason for r in upload_rejects(raw).collect()} == {"a": "oversize", "b": "malformed"}
