"""Skew check: run the grouped operators on a copy of ``events`` where one
participant-day holds a third of all rows (many of them identical, with
unknown call durations), and report from Spark's event log the largest
number of shuffle records any single task read, per query.

    python tools/skew_check.py [sf_dir] [scratch_dir]

The skewed copy is made by Spark from the driver table (rows with
``event_id % 3 = 0`` are moved to participant 1 on 2024-01-05 with the same
``props``), so nothing is dropped or sampled.
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pyspark.sql import functions as F  # noqa: E402

from phonesense.operators import metrics, probes  # noqa: E402
from phonesense.operators.payload import sensor_raw  # noqa: E402
from phonesense.operators.population import sensor_population  # noqa: E402
from phonesense.session import get_session  # noqa: E402
from phonesense.sources.fixtures import register_from_customers, uploads_from_events  # noqa: E402


def skewed_events(events):
    hot = F.col("event_id") % 3 == 0
    day = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    time_of_day = F.col("ts") - F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    return events.select(
        "event_id",
        F.when(hot, day + time_of_day).otherwise(F.col("ts")).alias("ts"),
        F.when(hot, F.lit(1)).otherwise(F.col("user_id")).alias("user_id"),
        "event_type", "value",
        F.when(hot, F.lit('{"k": 34}')).otherwise(F.col("props")).alias("props"))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="skew-")
    log_dir = f"{scratch}/eventlog"
    Path(log_dir).mkdir(parents=True, exist_ok=True)
    # Coalescing off, so each post-shuffle task reads exactly one hash partition
    # and the largest one shows where a hot key landed.
    spark = get_session("local[8]", shuffle_partitions=32, conf={
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.checkpoint.dir": f"{scratch}/ckpt"})
    spark.sparkContext.setLogLevel("ERROR")
    events = skewed_events(spark.read.parquet(f"{sf_dir}/events.parquet")).repartition(8, "event_id")
    # Written once as an 8-file table, so the shuffles measured below are the
    # operators' own and not the derivation's.
    uploads_from_events(events).write.parquet(f"{scratch}/uploads")
    pl = sensor_raw(spark.read.parquet(f"{scratch}/uploads"))
    register = register_from_customers(spark.read.parquet(f"{sf_dir}/customer.parquet"))
    ev, calls = probes.probe_event(pl), probes.probe_calls(pl)
    hot_rows = ev.filter((F.col("user_id") == "u1") & (F.col("event_date") == "2024-01-05")).count()
    total_rows = ev.count()
    hot_day = (F.col("user_id") == "u1") & (F.col("event_date") == "2024-01-05")
    jobs = {
        "count_commtype": lambda: metrics.count_commtype(ev),
        "stats_phone": lambda: metrics.stats_phone(ev),
        "ratio_sms": lambda: metrics.ratio_sms(ev),
        "call_duration": lambda: metrics.call_duration(calls),
        "unique_calls": lambda: metrics.unique_calls(ev),
        "call_duration_all_tied": lambda: metrics.call_duration(
            calls.withColumn("callDuration", F.when(hot_day, 9.0).otherwise(F.col("callDuration")))),
        "sensor_population": lambda: sensor_population(
            register, probes.probe_location(pl), calls, probes.probe_sms(pl), ev, order_col="row_no"),
    }
    groups = {}
    spark.sparkContext.setJobGroup("setup", "setup")
    for name, build in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
        groups[name] = name
    app = spark.sparkContext.applicationId
    spark.stop()

    log = sorted(glob.glob(f"{log_dir}/*{app}*"))[0]
    job_group, stage_job, task_reads = {}, {}, {}
    for line in open(log):
        e = json.loads(line)
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e["Stage IDs"]:
                stage_job[sid] = g
        elif kind == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            reads = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
            task_reads.setdefault(e["Stage ID"], []).append(reads)
    report = {"participant_day_rows": hot_rows, "event_rows": total_rows, "queries": {}}
    for sid, reads in task_reads.items():
        g = stage_job.get(sid)
        if g in groups and sum(reads) > 0:
            q = report["queries"].setdefault(g, {"max_task_shuffle_records": 0, "shuffle_records": 0})
            q["max_task_shuffle_records"] = max(q["max_task_shuffle_records"], max(reads))
            q["shuffle_records"] += sum(reads)
    print(json.dumps(report, indent=1))


if __name__ == "__main__":
    main()
