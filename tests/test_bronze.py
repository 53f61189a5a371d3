from phonesense.operators.payload import sensor_raw
from phonesense.operators.probes import probe_event, probe_location
from phonesense.plans.bronze import materialize_payload, read_bronze, write_bronze


def test_written_payload_gives_same_results_and_prunes_partitions(spark, uploads, tmp_path):
    up = uploads([("u1", '{"PROBE":"a.LocationProbe","TIMESTAMP":1.5,"LATITUDE":2},'
                         '{"PROBE":"a.CommunicationEventProbe","COMM_TIMESTAMP":"1000","NUMBER":"7"}'),
                  ("u2", '{"PROBE":"LocationProbe"},{"GUID":"no-probe"},{"PROBE":"a.b.LocationProbe"}')])
    pl = sensor_raw(up)
    path = write_bronze(pl, str(tmp_path / "pl"))
    bronze = read_bronze(spark, path)
    for fn in (probe_location, probe_event):
        assert sorted(map(tuple, fn(bronze).collect())) == sorted(map(tuple, fn(pl).collect()))
    plan = probe_location(bronze)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(probe_family" in plan and "LocationProbe" in plan


def test_materialize_under_checkpoint_dir(spark, uploads):
    pl = sensor_raw(uploads([("u1", '{"PROBE":"a.B"}')]))
    again = materialize_payload(spark, pl)
    assert again.count() == 1
    assert spark.conf.get("spark.checkpoint.dir") in again.inputFiles()[0]


def test_variant_is_written_shredded_per_family(spark, uploads, tmp_path):
    import glob

    import pyarrow.parquet as pq
    up = uploads([(f"u{i}", '{"PROBE":"a.CommunicationEventProbe","COMM_TIMESTAMP":"%d","NUMBER":"7"}' % i)
                  for i in range(50)])
    path = write_bronze(sensor_raw(up), str(tmp_path / "pl"))
    files = glob.glob(f"{path}/probe_family=CommunicationEventProbe/*.parquet")
    cols = {pq.ParquetFile(f).schema.column(i).path for f in files for i in range(len(pq.ParquetFile(f).schema))}
    assert "json.typed_value.COMM_TIMESTAMP.typed_value" in cols
