"""Parse once, reuse many times: the parsed payload as a written table.

Parsing is the dominant cost of every query; writing ``pl`` once, partitioned
by probe family, turns every later probe filter into partition pruning and
cuts the lineage back to the raw text (a written table in shared storage
survives executor loss, unlike a local checkpoint).

Spark writes the VARIANT column shredded: within a family partition the
objects share their keys, so each key becomes a typed Parquet column
(``json.typed_value.<KEY>.typed_value``), and a query reads only the paths
it uses (``ReadSchema: ... json:struct<0:string,...>``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from phonesense.session import scratch_path

FAMILY_COL = "probe_family"
BRONZE_SCHEMA = ("user_id STRING, array_index INT, probe STRING, timestamp DOUBLE, guid STRING, "
                 "json VARIANT, probe_family STRING")


def probe_family(probe_col: str = "probe"):
    """Last dotted segment of the probe name (what the suffix match tests)."""
    return F.regexp_extract(F.col(probe_col), r"\.([^.]*)$", 1)


def write_bronze(pl: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write ``pl`` (VARIANT column included) as Parquet partitioned by
    probe family.

    Rows of a family are gathered before they are written, so the table has
    files of about the advisory partition size instead of one for each task
    and family; the rebalance splits large families and their skew."""
    pl = pl.withColumn(FAMILY_COL, probe_family()).hint("rebalance", FAMILY_COL)
    pl.write.mode(mode).partitionBy(FAMILY_COL).parquet(path)
    return path


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Read a written payload table (declared schema: no footer inference)."""
    return spark.read.schema(BRONZE_SCHEMA).parquet(path)


def materialize_payload(spark: SparkSession, pl: DataFrame, name: str = "payload") -> DataFrame:
    """Write ``pl`` under the shared checkpoint folder and return the re-read
    table."""
    return read_bronze(spark, write_bronze(pl, scratch_path(spark, name)))
