"""A verified global order: each row's position in a sorted result.

A sort alone leaves no trace once rows are written to several files. Here rows are range-partitioned and
sorted, and written with the number of their partition and their place in it; a count for each
partition, added up over the partitions before, makes both a global position. Rows equal in the ordering columns go by
all their other columns, so ties of one value are spread over partitions as other rows are, and a last
arbitrary key parts rows that are alike in all columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from phonesense.session import remove_at_exit, scratch_path

POSITION = "position"


def with_position(df: DataFrame, by: Sequence[str], name: str = POSITION) -> DataFrame:
    """``df`` with its rows' positions, from 1, in ascending order of ``by``, then of all other columns; missing
    values last. The sorted rows are written once, in the shared folder, as positions need two looks at them."""
    spark, columns = df.sparkSession, df.columns
    if name in columns:
        raise ValueError(f"there is a column {name!r} already; choose another name for the position")
    keys = [F.col(f"`{c}`").asc_nulls_last() for c in [*by, *[c for c in columns if c not in by]]]
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    keyed = df.withColumn("_any", F.monotonically_increasing_id())
    parted = keyed.repartitionByRange(*keys, "_any").sortWithinPartitions(*keys, "_any")
    # The id holds the partition above bit 33 and counts its rows below.
    placed = parted.select(row, F.monotonically_increasing_id().alias("id"))
    placed = placed.select("row", F.shiftright("id", 33).cast("int").alias("part"), F.col("id").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    path = remove_at_exit(spark, scratch_path(spark, "ordered"))
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    # One row for each partition, whatever the size of the data.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    at = placed.join(F.broadcast(counts), "part")
    return at.select(*[F.col("row")[c].alias(c) for c in columns], (F.col("before") + F.col("place") + 1).alias(name))
