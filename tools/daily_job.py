"""Batch job: raw uploads -> parsed payload table -> every daily result.

    spark-submit tools/daily_job.py --uploads s3://.../uploads --format csv \\
        --register s3://.../register.csv --out s3://.../phonesense [--json]

Each run takes in one batch of uploads (:mod:`phonesense.plans.state`): it is parsed
once into ``<out>/payload/batch=<id>``, its event tables and its partial state are
written beside it, and the daily results of the days that it touches are brought up to date. A
batch that is run again under its id replaces itself, so a retry changes nothing. Each
output is a written table, so a lost executor only recomputes the tasks of the step it was running.
"""

from __future__ import annotations

import argparse
import hashlib
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from phonesense.operators import export, metrics  # noqa: E402
from phonesense.operators.population import sensor_population_from_presence  # noqa: E402
from phonesense.plans import state  # noqa: E402
from phonesense.session import get_session  # noqa: E402
from phonesense.sources.json_sink import write_json_rows  # noqa: E402
from phonesense.sources.uploads import read_register, read_uploads  # noqa: E402

FOLDERS = ("payload", "tables", "state")


def parsed_args(argv):
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--uploads", required=True, help="upload files (user_id, payload) or a table name")
    ap.add_argument("--format", default="csv", help="csv (default), parquet, json, table, ...")
    ap.add_argument("--register", help="participant register CSV; enables sensor_population")
    ap.add_argument("--out", required=True, help="output folder on shared storage")
    ap.add_argument("--mode", default="FAILFAST", choices=["FAILFAST", "PERMISSIVE", "RECOVER"],
                    help="malformed payloads: stop the job (FAILFAST, default), or leave them out of the results and "
                         "write them to <out>/rejects (PERMISSIVE), or leave out their bad objects only, which "
                         "are written to <out>/object_rejects (RECOVER)")
    ap.add_argument("--multi-line", action="store_true", help="CSV payloads may hold raw line breaks")
    ap.add_argument("--append", action="store_true",
                    help="--uploads holds new uploads only: add them to what <out> holds instead of starting anew")
    ap.add_argument("--batch-id", help="names the batch; running an id again replaces that batch. Default: from --uploads")
    ap.add_argument("--hour-tz", default="UTC", help="time zone of event_hour (default UTC)")
    ap.add_argument("--date-tz", default="UTC", help="time zone of event_date (default UTC)")
    ap.add_argument("--ordered", action="store_true", help="write the daily tables as JSON in the order of their keys")
    ap.add_argument("--json", action="store_true", help="also write every result as JSON Lines")
    ap.add_argument("--master", help="only for local runs; spark-submit sets it on a cluster")
    return ap.parse_args(argv)


def remove(spark, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def main(argv=None) -> None:
    args = parsed_args(argv)
    spark = get_session(args.master, app_name="phonesense-daily")
    out = args.out.rstrip("/")
    batch = args.batch_id or hashlib.sha1(args.uploads.encode()).hexdigest()[:16]
    uploads = read_uploads(spark, args.uploads, fmt=args.format, multi_line=args.multi_line)
    if not args.append:
        for folder in FOLDERS:
            remove(spark, f"{out}/{folder}")
    state.add_batch(uploads, out, batch, args.mode, args.hour_tz, args.date_tz)

    def save(name, df):
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    if args.mode != "FAILFAST":
        save("rejects", state.rejected_uploads(spark, out))
        for r in save("upload_report", state.upload_counts(spark, out)).collect():  # four states
            print(f"uploads {r[0]}: {r[1]}")
    if args.mode == "RECOVER":
        save("object_rejects", state.rejected_objects(spark, out))
    results = {"probe_types": save("tables/probe_types", state.probe_counts(spark, out))}
    if args.register:
        register = read_register(spark, args.register)
        results["sensor_population"] = save("tables/sensor_population",
                                            sensor_population_from_presence(register, state.presence(spark, out)))
    if not args.json:
        return
    results |= {name: state.read_events(spark, out, name) for name in state.EVENT_TABLES}
    results |= {name: state.read_result(spark, out, name) for name in state.DAILY}
    for name, df in results.items():
        if args.ordered and name in state.DAILY:
            df = metrics.in_order(df, *[c for c in ("call_timestamp", "user_id", "event_date") if c in df.columns])
        elif name == "call_duration":
            df = metrics.in_order(df, "call_timestamp")
        write_json_rows(df, f"{out}/json/{name}", mode="overwrite", tz=args.hour_tz)
    if args.register:
        export.json_sensorpop(state.read_payload(spark, out), register).write.mode("overwrite").text(f"{out}/json/sensorpop_from_payload")


if __name__ == "__main__":
    main()
