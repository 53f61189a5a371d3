from pyspark.sql import functions as F

from phonesense.functions.time import epoch_millis_to_ts, epoch_seconds_to_ts, time_of_day


def test_time_of_day_buckets(spark):
    hours = [2, 3, 5, 6, 11, 12, 18, 19, 21, 22, 23, None]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hours)], "i int, h int")
    got = [r.t for r in df.select("i", time_of_day("h").alias("t")).orderBy("i").collect()]
    assert got == ["Late Night", "Early Morning", "Early Morning", "Morning", "Morning", "Afternoon",
                   "Afternoon", "Night", "Night", "Late Night", "Late Night", None]


def test_seconds_and_millis_agree_to_the_microsecond(spark):
    df = spark.range(0, 2000).select(
        (F.lit(1499856123456) + F.col("id") * 7919).alias("ms"))
    out = df.select((epoch_seconds_to_ts(F.col("ms") / 1000) == F.timestamp_millis("ms")).alias("a"),
                    (epoch_millis_to_ts(F.col("ms").cast("double")) == F.timestamp_millis("ms")).alias("b"))
    assert out.filter(~F.col("a") | ~F.col("b")).count() == 0


def test_out_of_range_epoch_is_null(spark):
    df = spark.createDataFrame([(1e300,)], "x double")
    assert df.select(epoch_seconds_to_ts("x").alias("t")).first().t is None


def test_utc_arithmetic_matches_zone_conversion(spark):
    from phonesense.functions.time import local_date, local_hour, wall_clock
    df = spark.range(-3000, 3000).select(
        F.timestamp_micros(F.col("id") * F.lit(1_234_567_891) + F.lit(-86_400_000_000)).alias("ts"))
    got = df.select(
        (local_hour("ts", "UTC") == F.hour(wall_clock("ts", "UTC"))).alias("h"),
        (local_date("ts", "UTC") == F.to_date(wall_clock("ts", "UTC"))).alias("d"))
    assert got.filter(~F.col("h") | ~F.col("d")).count() == 0
    assert dict(df.select(local_hour("ts").alias("h"), local_date("ts").alias("d")).dtypes) == {
        "h": "int", "d": "date"}


def test_zone_conversion_is_exact_in_the_repeated_hour_whatever_the_session_zone(spark):
    from phonesense.functions.time import local_hour
    # 01:30 EDT and 01:30 EST on 2024-11-03 in New York: one hour apart.
    df = spark.createDataFrame([(1730611800000,), (1730615400000,)], "ms long").select(
        F.timestamp_millis("ms").alias("ts"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            got = [(r.t, r.p) for r in df.select(local_hour("ts", "Asia/Tokyo").alias("t"),
                                                  local_hour("ts", "Europe/Paris").alias("p")).collect()]
            assert got == [(14, 6), (15, 7)], session_zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
