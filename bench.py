"""Benchmark the registered queries.

Runs every query of ``phonesense.plans.catalog`` on ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` twice over:

* ``queries``: from the raw payload text (derive uploads, parse, extract,
  compute) - the end-to-end figure. The driver's ``events`` table is one row group, which one task would
  build and parse; its narrow rows are dealt to all cores first;
* ``from_written_payload``: from the parsed payload written once as a
  probe-family-partitioned Parquet table (parse cost paid once, reported as
  ``parse_and_write``).

Each query is built (DataFrame construction and planning, including any
size checks it runs) and executed in full with the ``noop`` sink (nothing is
collected to the driver); the reported time covers both and is the median of
``$BENCH_REPEAT`` runs after one warm-up pass. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from phonesense.operators.payload import sensor_raw  # noqa: E402
from phonesense.plans import catalog  # noqa: E402
from phonesense.plans.bronze import read_bronze, write_bronze  # noqa: E402
from phonesense.session import get_session  # noqa: E402
from phonesense.sources.fixtures import fixture_uploads  # noqa: E402


def run_once(build) -> float:
    t0 = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def timed(build, repeat: int) -> float:
    return statistics.median(run_once(build) for _ in range(repeat))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    scratch = tempfile.mkdtemp(prefix="phonesense-bench-")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus, conf={
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        "spark.checkpoint.dir": scratch,
        "spark.local.dir": scratch,
    })
    spark.sparkContext.setLogLevel("ERROR")

    def payload(session, folder):
        return sensor_raw(fixture_uploads(session, folder, spread=cpus))

    names = only or list(catalog.PLANS)
    for name in names:  # warm-up pass: JIT, file listing, codegen caches
        run_once(lambda: catalog.bind(name, payload=payload)(spark, sf_dir))
    per_query = {}
    for name in names:
        q = catalog.bind(name, payload=payload)
        per_query[name] = round(timed(lambda: q(spark, sf_dir), repeat), 3)

    # Parse once into a written table, then run every query from it.
    bronze_path = os.path.join(scratch, "payload")
    t0 = time.perf_counter()
    write_bronze(payload(spark, sf_dir), bronze_path)
    parse_write = time.perf_counter() - t0
    from_written = {}
    for name in names:
        q = catalog.bind(name, payload=lambda s, _d: read_bronze(s, bronze_path))
        from_written[name] = round(timed(lambda: q(spark, sf_dir), repeat), 3)

    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
        "spark": spark.version,
        "from_written_payload": {"parse_and_write": round(parse_write, 3),
                                 "total": round(sum(from_written.values()), 3),
                                 "queries": from_written},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
