"""Incremental ingestion of upload files into the parsed payload table.

Uploads arrive continuously; parsing each file once, as it lands, keeps every
batch query on the columnar payload table instead of the raw text. The
stream is stateless (``sensor_raw`` is Project + Generate), so it needs no
watermark; the file sink plus the checkpoint give exactly-once output and
restart after executor or driver loss.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from phonesense.operators.payload import sensor_raw, upload_rejects
from phonesense.plans.bronze import FAMILY_COL, probe_family
from phonesense.session import ensure_checkpoint_dir
from phonesense.sources.uploads import CSV_OPTIONS


def read_upload_stream(spark: SparkSession, path: str, fmt: str = "csv", schema: str | None = None,
                       max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Stream of ``(user_id, payload)`` from files landing under ``path``.

    CSV columns are found by name: without a ``schema`` the header of the files
    already there is taken (``user_id, payload`` if there are none). A file
    whose header differs stops the stream rather than being read by position.
    """
    if fmt == "csv":
        options = {**CSV_OPTIONS, **options}
        if schema is None:
            schema = _csv_header(spark, path, options)
    reader = spark.readStream.format(fmt)
    reader = reader.schema(schema or "user_id string, payload string").options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(path)
    return df.select(F.col("user_id").cast("string").alias("user_id"),
                     F.col("payload").cast("string").alias("payload"))


def _csv_header(spark: SparkSession, path: str, options: dict):
    try:
        return spark.read.options(**options).csv(path).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def payload_stream(uploads: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Parsed payload rows of a stream, with the probe-family partition column."""
    return sensor_raw(uploads, mode=mode).withColumn(FAMILY_COL, probe_family())


def _checkpoint(spark: SparkSession, checkpoint: str | None, name: str) -> str:
    """The given folder, or one for ``name`` under ``spark.checkpoint.dir`` (the
    shared location the cluster names), so restarts resume and two streams
    never share offsets."""
    if checkpoint is not None:
        return checkpoint
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{hashlib.sha1(name.encode()).hexdigest()[:16]}"


def start_payload_ingest(uploads: DataFrame, out_path: str, checkpoint: str | None = None,
                         trigger: dict | None = None, mode: str = "FAILFAST", query_name: str | None = None):
    """Start writing the parsed payload of ``uploads`` to Parquet at
    ``out_path``, partitioned by probe family.

    A malformed upload stops the stream (``FAILFAST``). With
    ``mode="PERMISSIVE"`` it gives no rows; run :func:`start_reject_log` on the
    same uploads beside it, which keeps every such upload and why it failed.
    ``checkpoint`` defaults to a folder keyed by ``query_name`` or the output
    path. ``trigger`` is passed to ``DataStreamWriter.trigger``, e.g.
    ``{"availableNow": True}`` to drain what has landed and stop, or
    ``{"processingTime": "1 minute"}``.
    """
    checkpoint = _checkpoint(uploads.sparkSession, checkpoint, query_name or out_path)
    writer = (payload_stream(uploads, mode).writeStream.format("parquet")
              .option("path", out_path).option("checkpointLocation", checkpoint)
              .partitionBy(FAMILY_COL).outputMode("append"))
    return _started(writer, query_name, trigger)


def start_reject_log(uploads: DataFrame, out_path: str, checkpoint: str | None = None,
                     trigger: dict | None = None, query_name: str | None = None):
    """Start writing the uploads that ``PERMISSIVE`` ingestion leaves out to
    Parquet at ``out_path``: ``user_id, reason, payload``."""
    checkpoint = _checkpoint(uploads.sparkSession, checkpoint, query_name or out_path)
    writer = (upload_rejects(uploads).writeStream.format("parquet").option("path", out_path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    return _started(writer, query_name, trigger)


def _started(writer, query_name: str | None, trigger: dict | None):
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
