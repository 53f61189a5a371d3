"""Every registered query against its independent DuckDB oracle (sf0.001),
plus the driver's entry smoke check."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT / "tools"))

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver test data not present")


def test_every_query_has_an_oracle():
    from phonesense.plans import catalog, oracle
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert len(catalog.queries()) == 49


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["user_id", "event_date", "PHONE", "SMS", "OTHER", "<NA>"]
    assert df.count() > 0


def test_all_queries_match_oracle(spark):
    from compare_oracle import compare
    from phonesense.plans import catalog
    report = compare(spark, SF, list(catalog.queries()), verbose=False)
    bad = {k: v for k, v in report.items() if not v["ok"]}
    assert not bad, bad


def test_results_do_not_depend_on_the_session_zone(spark):
    from compare_oracle import compare
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        report = compare(spark, SF, ["probe_event", "probe_location", "count_commtype", "call_duration",
                                     "json_probelocation", "json_callduration", "json_uniquecalls", "json_probeevent_nairobi"], verbose=False)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    bad = {k: v for k, v in report.items() if not v["ok"]}
    assert not bad, bad
