"""Reading the driver tables and writing intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phonesense.session import remove_at_exit, scratch_path

#: A run of anything but the ASCII white space 0x20, 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate table: lower-cases A-Z and nothing else.
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: computed once,
    read by every later step, and still there when an executor is lost. The
    folder is removed when the application's JVM ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)
