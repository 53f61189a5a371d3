import pytest

from phonesense.operators import metrics
from phonesense.operators.membership import id_filter, maybe_members
from phonesense.operators.population import sensor_population_from_payload, sensor_population_of_known
from phonesense.operators.payload import sensor_raw
from pyspark.sql import functions as F


def test_no_member_is_lost_and_few_others_pass(spark):
    ids = spark.range(20_000).select((F.col("id") * 3).alias("user_id"))
    df = spark.range(60_000).select(F.col("id").cast("string").alias("user_id"), F.lit(1).alias("block"), F.lit(2).alias("bits"))
    got = maybe_members(df, id_filter(ids, blocks=8), blocks=8)
    assert got.columns == df.columns
    passed = {int(r.user_id) for r in got.collect()}
    assert set(range(0, 60_000, 3)) <= passed
    assert len(passed) - 20_000 < 0.05 * 40_000  # 20,000 ids set 80,000 of 262,144 bits


@pytest.mark.parametrize("ids, passes", [([None, "a"], {None, "a"}), (["a"], {"a"}), ([], set())])
def test_null_ids_and_empty_registers(spark, ids, passes):
    register = spark.createDataFrame([(i,) for i in ids], "user_id string")
    df = spark.createDataFrame([(None,), ("a",), ("b",)], "user_id string")
    assert {r.user_id for r in maybe_members(df, id_filter(register)).collect()} == passes


def test_repeated_rows_stay(spark):
    register = spark.createDataFrame([("a",), ("a",)], "user_id string")
    df = spark.createDataFrame([("a",)] * 5 + [("b",)], "user_id string")
    assert maybe_members(df, id_filter(register)).count() == 5


def test_filter_size_is_bounded(spark):
    with pytest.raises(ValueError, match="blocks"):
        id_filter(spark.range(1).toDF("user_id"), blocks=5000)


def test_matrix_is_that_of_all_uploads_and_unknown_users_go_before_any_shuffle(spark, tmp_path):
    rows = [(f"u{i}", '{"PROBE":"a.LocationProbe"},{"PROBE":"a.CommunicationEventProbe"}') for i in range(40)]
    spark.createDataFrame([*rows, (None, '{"PROBE":"a.LocationProbe"}')], "user_id string, payload string").write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    reg = spark.createDataFrame([("u1", 1), ("u1", 2), ("u99", 3), (None, 4)], "user_id string, ord int")
    a = sensor_population_from_payload(reg, sensor_raw(raw), order_col="ord")
    b = sensor_population_of_known(reg, raw, order_col="ord")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    lines = b._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, x in enumerate(lines) if "FileScan parquet" in x)
    above = [x for x in lines[:at] if "Exchange hashpartitioning" in x or "LeftSemi" in x or "parse_json" in x]
    # Read upwards from the scan of the uploads: the filter comes first, then the parse, then the shuffle.
    assert "LeftSemi" in above[-1] and any("Exchange" in x for x in above[:-1])


def test_a_hundred_thousand_categories_in_one_pass(spark):
    event = spark.range(200_000).select(
        F.lit("u").alias("user_id"), F.lit("2024-01-05").cast("date").alias("event_date"),
        F.when(F.col("id") >= 10, F.concat(F.lit("c"), (F.col("id") % 100_000).cast("string"))).alias("communication_type"))
    spark.sparkContext.setJobGroup("counting", "counting")
    counted = metrics.category_counts(event, "communication_type")
    wide = metrics.category_columns(counted, ["c10", "c3", "none"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("counting")
    spark.sparkContext.setJobGroup("", "")
    (r,) = counted.select(F.size("counts").alias("n"), "unknown", F.map_values("counts").alias("v")).collect()
    assert (r.n, r.unknown, sum(r.v)) == (100_000, 10, 199_990)
    (w,) = wide.collect()
    assert (w["c10"], w["c3"], w["none"], w["OTHER"], w["<NA>"]) == (2, 1, None, 199_987, 10)


def test_category_maps_keep_clashing_and_missing_names(spark):
    rows = [("u", "<NA>"), ("u", None), ("u", ""), ("u", "<NA>"), ("v", None)]
    event = spark.createDataFrame(rows, "user_id string, communication_type string").withColumn("event_date", F.lit(None).cast("date"))
    got = {r.user_id: (r.counts, r.unknown) for r in metrics.category_counts(event, "communication_type").collect()}
    assert got == {"u": ({"": 1, "<NA>": 2}, 1), "v": ({}, 1)}
    assert metrics.category_counts(event.limit(0), "communication_type").collect() == []
    wide = metrics.category_columns(metrics.category_counts(event, "communication_type"), [])
    assert {r.user_id: (r["OTHER"], r["<NA>"]) for r in wide.collect()} == {"u": (3, 1), "v": (None, 1)}
