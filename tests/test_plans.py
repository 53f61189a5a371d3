"""Plan shape of the registered queries: JVM-only, few shuffles, pruned scans."""

import re

import pytest

from phonesense.operators import metrics, probes
from phonesense.operators.payload import sensor_raw
from phonesense.plans import catalog

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "AggregateInPandas", "WindowInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))


@pytest.mark.parametrize("name", sorted(catalog.PLANS))
def test_no_python_in_any_registered_query(spark, name):
    plan = _plan(catalog.bind(name)(spark, SF))
    assert not [n for n in PYTHON_NODES if n in plan]


def _uploads(spark, tmp_path):
    path = str(tmp_path / "uploads")
    spark.createDataFrame(
        [("u1", '{"PROBE":"a.CommunicationEventProbe","COMM_TIMESTAMP":"1000","COMMUNICATION_TYPE":"SMS"},'
                '{"PROBE":"a.CommunicationLogProbe","PHONE_CALLS":[{"CALL_DURATION":4,"CALL_TIMESTAMP":1000}]}', "x")],
        "user_id string, payload string, extra string").write.parquet(path)
    return spark.read.parquet(path)


def test_extractors_read_two_columns_and_never_shuffle(spark, tmp_path):
    pl = sensor_raw(_uploads(spark, tmp_path))
    for fn in (probes.probe_event, probes.probe_location, probes.probe_sms, probes.probe_calls):
        plan = _plan(fn(pl))
        assert "ReadSchema: struct<user_id:string,payload:string>" in plan
        assert _exchanges(plan) == 0


def test_shuffle_counts(spark, tmp_path):
    ev = probes.probe_event(sensor_raw(_uploads(spark, tmp_path)))
    assert _exchanges(_plan(metrics.count_commtype(ev))) == 1
    assert _exchanges(_plan(metrics.stats_phone(ev))) == 2
    assert _exchanges(_plan(metrics.ratio_sms(ev))) == 2
    calls = probes.probe_calls(sensor_raw(spark.read.parquet(str(tmp_path / "uploads"))))
    plan = _plan(metrics.call_duration(calls, ordered=False))
    assert plan.count("Exchange hashpartitioning") <= 4


def _scans_that_ran(df) -> tuple[int, int]:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    reused = re.findall(r"ReusedExchange", final)
    return len(re.findall(r"Scan parquet", final)), len(reused)


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_skew_safe_measures_run_nothing_when_built_and_reuse_their_exchanges(spark, tmp_path, broadcast):
    ev = probes.probe_event(sensor_raw(_uploads(spark, tmp_path)))
    calls = probes.probe_calls(sensor_raw(spark.read.parquet(str(tmp_path / "uploads"))))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(f"building{broadcast}", "building")
        built = [metrics.unique_texts(ev), metrics.call_duration(calls, ordered=False)]
        [df.explain() for df in built]
        assert not tracker.getJobIdsForGroup(f"building{broadcast}")
        # The longest calls read their source for the days' maxima and again for the rows, whose shuffle is the only one of rows.
        for df, most in zip(built, (1, 2), strict=True):
            spark.sparkContext.setJobGroup("", "")
            scans, reused = _scans_that_ran(df)
            assert scans <= most and reused >= 1
    finally:
        spark.sparkContext.setJobGroup("", "")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_registered_population_scans_the_events_once(spark):
    plan = _plan(catalog.bind("sensor_population")(spark, SF))
    assert len(re.findall(r"events\.parquet", plan)) == 1


def test_no_stale_reads(spark, tmp_path):
    """Files that join a table between two calls are read."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.write.parquet(f"{tmp_path}/events.parquet")
    first = catalog.bind("sensor_raw")(spark, str(tmp_path)).count()
    events.write.mode("append").parquet(f"{tmp_path}/events.parquet")
    assert catalog.bind("sensor_raw")(spark, str(tmp_path)).count() == 2 * first
