"""Participant data-availability matrix (``sensor_population``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from phonesense.functions.variant import get_array
from phonesense.operators.grouped import null_safe_join
from phonesense.operators.membership import BLOCKS, id_filter, maybe_members
from phonesense.operators.payload import probe_suffix_match, sensor_raw
from phonesense.schemas import (
    AVAILABLE, CALLS_ARRAY, COMM_EVENT_PROBE, COMM_LOG_PROBE, LOCATION_PROBE, NOT_AVAILABLE,
    POPULATION_FLAGS, SMS_ARRAY,
)


def _c(name: str) -> Column:
    """Column by exact name (dots and spaces are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def first_row_per_user(register: DataFrame, order_col: str) -> DataFrame:
    """First register row of each participant in ``order_col`` order.

    ``min_by`` is a partial aggregate: a participant repeated in a large share
    of the register is combined map-side, never sorted in one task. A NULL
    ``user_id`` is one participant, and ids compare as text. A row whose
    position is NULL comes after all that have one.
    """
    others = [c for c in register.columns if c != "user_id"]
    keyed = register.withColumn("user_id", F.col("user_id").cast("string"))
    first = keyed.groupBy("user_id").agg(
        F.min_by(F.struct(*[_c(c) for c in others]),
                 F.struct(_c(order_col).isNull(), _c(order_col))).alias("_first"))
    return first.select("user_id", *[F.col("_first")[c].alias(c) for c in others])


def _flag(hit: Column) -> Column:
    return F.when(F.coalesce(hit, F.lit(False)), F.lit(AVAILABLE)).otherwise(F.lit(NOT_AVAILABLE))


def _matrix(register: DataFrame, presence: DataFrame, order_col: str,
            drop: Sequence[str], keep_order_col: bool) -> DataFrame:
    if order_col not in register.columns:
        raise ValueError(f"the register has no column {order_col!r} to tell which row of a participant is first; "
                         "read it with read_register, which records the file order, or name its order column")
    first = first_row_per_user(register, order_col)
    joined = null_safe_join(first, presence, ["user_id"], "left")
    out_cols = [c for c in register.columns
                if c not in drop and (keep_order_col or c != order_col)]
    return joined.select(*[_c(c) for c in out_cols],
                         *[_flag(F.col(f"_has_{f}")).alias(f) for f in POPULATION_FLAGS])


def sensor_population(register: DataFrame, location: DataFrame, calls: DataFrame, sms: DataFrame,
                      event: DataFrame, order_col: str = "_source_order",
                      drop: Sequence[str] = ("email",), keep_order_col: bool | None = None) -> DataFrame:
    """First register row per participant, without ``email``, plus four
    ``Available``/``NotAvailable`` flags: ``location, calls, sms, event``.

    Presence comes from one union of ``(user_id, table)`` pairs and one
    grouped aggregate (partial, skew-safe), then one join with the
    deduplicated register (one row per key on both sides).
    """
    return sensor_population_from_presence(register, presence_of(location, calls, sms, event), order_col, drop, keep_order_col)


def presence_of(location: DataFrame, calls: DataFrame, sms: DataFrame, event: DataFrame) -> DataFrame:
    """Per participant, whether each of the tables has rows: ``user_id`` and a ``_has_`` column for each."""
    tagged = None
    for name, table in zip(POPULATION_FLAGS, (location, calls, sms, event)):
        part = table.select(F.col("user_id").cast("string").alias("user_id"), F.lit(name).alias("_t"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy("user_id").agg(
        *[F.bool_or(F.col("_t") == F.lit(f)).alias(f"_has_{f}") for f in POPULATION_FLAGS])


def merged_presence(parts: DataFrame) -> DataFrame:
    """Presence of several batches put together."""
    return parts.groupBy("user_id").agg(*[F.bool_or(f"_has_{f}").alias(f"_has_{f}") for f in POPULATION_FLAGS])


def sensor_population_from_presence(register: DataFrame, presence: DataFrame, order_col: str = "_source_order",
                                    drop: Sequence[str] = ("email",), keep_order_col: bool | None = None) -> DataFrame:
    """The matrix from a presence table (one row a participant)."""
    if keep_order_col is None:
        keep_order_col = not order_col.startswith("_")
    return _matrix(register, presence, order_col, drop, keep_order_col)


def payload_presence(pl: DataFrame) -> DataFrame:
    """Per participant, whether each probe table would have rows, from one
    pass over the parsed payload (no extractor is materialised)."""
    log = probe_suffix_match("probe", COMM_LOG_PROBE)

    def has_entries(key: str) -> Column:
        return log & F.coalesce(F.array_size(get_array("json", key)) > 0, F.lit(False))

    hits = {
        "location": probe_suffix_match("probe", LOCATION_PROBE),
        "calls": has_entries(CALLS_ARRAY),
        "sms": has_entries(SMS_ARRAY),
        "event": probe_suffix_match("probe", COMM_EVENT_PROBE),
    }
    return pl.groupBy("user_id").agg(*[F.bool_or(hits[f]).alias(f"_has_{f}") for f in POPULATION_FLAGS])


def sensor_population_from_payload(register: DataFrame, pl: DataFrame, order_col: str = "_source_order",
                                   drop: Sequence[str] = ("email",),
                                   keep_order_col: bool | None = None) -> DataFrame:
    """Same matrix as :func:`sensor_population`, computed straight from the
    parsed payload in a single scan."""
    if keep_order_col is None:
        keep_order_col = not order_col.startswith("_")
    return _matrix(register, payload_presence(pl), order_col, drop, keep_order_col)


def sensor_population_of_known(register: DataFrame, raw: DataFrame, order_col: str = "_source_order",
                               drop: Sequence[str] = ("email",), keep_order_col: bool | None = None,
                               blocks: int = BLOCKS, mode: str = "FAILFAST") -> DataFrame:
    """Same matrix from the raw uploads, for studies in which many uploads are of participants that the
    register doesn't hold: those are left out by a Bloom filter over the register's ids before they are
    parsed or shuffled. The register is read twice (for the filter and for the matrix)."""
    known = maybe_members(raw, id_filter(register, blocks), blocks)
    return sensor_population_from_payload(register, sensor_raw(known, mode=mode), order_col, drop, keep_order_col)
