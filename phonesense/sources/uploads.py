"""Readers for raw uploads and the participant register."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


# Reader options for uploads written the CSV way: the payload is one quoted
# field whose inner quotes are doubled (""), and R-style NA marks missing. A
# declared schema is checked against the header, not laid over it by position.
CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "nullValue": "NA", "mode": "FAILFAST",
               "enforceSchema": "false"}


def read_uploads(spark: SparkSession, path: str | None, fmt: str = "csv", multi_line: bool = False,
                 schema=None, **options) -> DataFrame:
    """Read raw uploads ``(user_id, payload)``; other columns are pruned.

    ``fmt`` is ``csv`` (the phone export), ``table`` (a catalog table name in
    ``path``) or any data source format (``parquet``, ``json``, ``jdbc`` with
    its connection options and ``path=None``...). CSV columns are found by the
    names in the header; a declared ``schema`` must agree with it, else the
    read fails.

    ``multi_line=True`` is needed when payloads contain raw line breaks; it
    makes each CSV file a single split, so it is off by default (a line break
    then fails the read). Spreading a badly split input over more tasks is the
    caller's choice (``.repartition(n)``): it moves all of the text.
    """
    if fmt == "csv":
        # Without a schema every header column is read as text (no inference
        # pass); files may carry more columns than user_id and payload.
        reader = spark.read.options(**CSV_OPTIONS)
        if schema is not None:
            reader = reader.schema(schema)
        reader = reader.option("multiLine", str(bool(multi_line)).lower()).options(**options)
        df = reader.csv(path)
    elif fmt == "table":
        df = spark.table(path)
    else:
        reader = spark.read.format(fmt).options(**options)
        df = reader.load(path) if path is not None else reader.load()
    return df.select(F.col("user_id").cast("string").alias("user_id"),
                     F.col("payload").cast("string").alias("payload"))


def natural_order(path) -> Column:
    """A sortable key of a path in which numbers count by their value: ``part-2`` comes before ``part-10``."""
    pieces = F.regexp_extract_all(path, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))

    def piece(x: Column) -> Column:
        digits = F.ltrim(x, F.lit("0"))
        # The number of digits before the digits: the larger number has more of them, or larger ones.
        return F.when(x.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), 5, "0"), digits)).otherwise(x)

    return F.transform(pieces, piece)


def with_source_order(df: DataFrame, name: str = "_source_order") -> DataFrame:
    """Attach a sortable position = (file in natural order of the paths, split offset,
    row id) that follows file order; must be applied directly on a file scan. A file that can't be split (a
    multi-line CSV) has one offset, and several are read side by side."""
    path = F.input_file_name()
    return df.withColumn(name, F.struct(
        natural_order(path).alias("order"),
        path.alias("file"),
        F.input_file_block_start().alias("offset"),
        F.monotonically_increasing_id().alias("row")))


def read_register(spark: SparkSession, path: str, fmt: str = "csv", schema=None,
                  order_col: str = "_source_order", **options) -> DataFrame:
    """Read the participant register and attach its file-order position in
    ``order_col`` (needed to keep the first row per participant)."""
    if fmt == "csv":
        reader = spark.read.options(**CSV_OPTIONS).options(**options)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
        df = reader.csv(path)
    else:
        df = spark.read.format(fmt).options(**options).load(path)
    return with_source_order(df, order_col)
