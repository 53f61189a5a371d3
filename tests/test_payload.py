import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from conftest import obj
from phonesense.operators.payload import filter_probe, probe_types, sensor_raw


def test_two_objects_get_one_based_index(uploads):
    pl = sensor_raw(uploads([("u1", obj("A", TIMESTAMP="1.5", GUID='"g1"') + "," + obj("B"))]))
    rows = pl.drop("json").orderBy("array_index").collect()
    assert [(r.array_index, r.probe, r.timestamp, r.guid) for r in rows] == [
        (1, "x.y.A", 1.5, "g1"), (2, "x.y.B", None, None)]
    assert dict(pl.dtypes)["array_index"] == "int"


def test_null_and_empty_payload_give_no_rows(uploads):
    assert sensor_raw(uploads([("u1", None), ("u2", "")])).count() == 0


def test_malformed_failfast_raises_permissive_drops(uploads):
    bad = uploads([("u1", '{"PROBE":'), ("u2", obj("A"))])
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)malformed"):
        sensor_raw(bad).collect()
    assert [r.user_id for r in sensor_raw(bad, mode="PERMISSIVE").collect()] == ["u2"]


def test_duplicate_key_counts_as_malformed(uploads):
    dup = uploads([("u1", '{"PROBE":"x","PROBE":"y"}')])
    assert sensor_raw(dup, mode="PERMISSIVE").count() == 0


def test_user_id_read_as_text(spark):
    raw = spark.createDataFrame([(7, obj("A"))], "user_id bigint, payload string")
    assert sensor_raw(raw).first().user_id == "7"


def test_suffix_match_is_anchored_after_a_dot(uploads):
    pl = sensor_raw(uploads([("u", '{"PROBE":"a.LocationProbe"},{"PROBE":"a.SimpleLocationProbe"},'
                                   '{"PROBE":"LocationProbe"},{"GUID":"no-probe"}')]))
    kept = filter_probe(pl, "LocationProbe")
    assert kept.count() == 1 and "probe" not in kept.columns


def test_probe_types_counts(uploads):
    pl = sensor_raw(uploads([("u", obj("A") + "," + obj("A") + "," + obj("B"))]))
    assert {(r.probe, r.n) for r in probe_types(pl).collect()} == {("x.y.A", 2), ("x.y.B", 1)}
