"""Raw uploads -> one row per probe object (``sensor_raw``) and probe filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from phonesense.functions.variant import get_double, get_string, parse_payload
from phonesense.operators.objects import VARIANT_LIMIT, recovered_rows
from phonesense.schemas import KEY_GUID, KEY_PROBE, KEY_TIMESTAMP


def sensor_raw(raw: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Explode each upload's payload into its probe objects.

    Output: ``user_id STRING, array_index INT (1-based position in the
    payload), probe STRING, timestamp DOUBLE, guid STRING, json VARIANT``.

    Row-local (Project + Generate, no shuffle); only ``user_id`` and
    ``payload`` are read from the source, so a columnar scan prunes the rest.
    NULL and empty payloads give no rows; malformed payloads raise in
    ``FAILFAST`` mode and give no rows in ``PERMISSIVE`` mode. In ``RECOVER``
    mode a payload that does not parse, or is too large to be parsed as one, is
    split into its objects and only the bad ones are left out (see
    :mod:`phonesense.operators.objects`); the source is then read twice.
    """
    if mode.upper() == "RECOVER":
        return sensor_raw(raw, "PERMISSIVE").unionByName(recovered_rows(raw))
    exploded = raw.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.posexplode(upload_elements("payload", mode)).alias("pos", "json"),
    )
    return exploded.select(
        "user_id",
        (F.col("pos") + 1).alias("array_index"),
        get_string("json", KEY_PROBE).alias("probe"),
        get_double("json", KEY_TIMESTAMP).alias("timestamp"),
        get_string("json", KEY_GUID).alias("guid"),
        "json",
    )


def _parsed(payload: str, mode: str) -> Column:
    """The payload's VARIANT array; in ``PERMISSIVE`` mode a larger text than a VARIANT holds is not tried."""
    if mode.upper() == "PERMISSIVE":
        return F.when(F.octet_length(payload) <= VARIANT_LIMIT, parse_payload(payload, mode))
    return parse_payload(payload, mode)


def upload_elements(payload: str = "payload", mode: str = "FAILFAST") -> Column:
    """The objects of a payload as an array of VARIANT; NULL where it does not parse (``FAILFAST`` raises)."""
    mode = "PERMISSIVE" if mode.upper() == "RECOVER" else mode
    return F.try_variant_get(_parsed(payload, mode), "$", "array<variant>")


def upload_state_of(payload: str, elements: str) -> Column:
    """``empty``, ``parsed``, ``oversize`` or ``malformed``, from a payload and its :func:`upload_elements`."""
    text = F.col(payload)
    return (F.when(text.isNull() | (F.trim(text) == ""), F.lit("empty"))
            .when(F.octet_length(text) > VARIANT_LIMIT, F.lit("oversize"))
            .when(F.col(elements).isNotNull(), F.lit("parsed"))
            .otherwise(F.lit("malformed")))


def upload_state(payload: str = "payload") -> Column:
    """``empty``, ``parsed``, ``oversize`` or ``malformed`` for each payload."""
    text = F.col(payload)
    return (F.when(text.isNull() | (F.trim(text) == ""), F.lit("empty"))
            .when(F.octet_length(text) > VARIANT_LIMIT, F.lit("oversize"))
            .when(parse_payload(payload, "PERMISSIVE").isNotNull(), F.lit("parsed"))
            .otherwise(F.lit("malformed")))


def upload_rejects(raw: DataFrame) -> DataFrame:
    """Uploads that give no rows in ``PERMISSIVE`` mode though they hold text:
    ``user_id, reason, payload`` with reason ``malformed`` or ``oversize``."""
    state = raw.select(F.col("user_id").cast("string").alias("user_id"), upload_state().alias("reason"), "payload")
    return state.filter(F.col("reason").isin("malformed", "oversize"))


def upload_report(raw: DataFrame) -> DataFrame:
    """How many uploads are in each state: ``state, n``; all uploads are counted."""
    return raw.groupBy(upload_state().alias("state")).agg(F.count(F.lit(1)).alias("n"))


def probe_suffix_match(probe_col, family: str):
    """True when the probe name ends with ``.<family>`` (NULL never matches)."""
    col = F.col(probe_col) if isinstance(probe_col, str) else probe_col
    return F.coalesce(col.endswith("." + family), F.lit(False))


def filter_probe(pl: DataFrame, family: str) -> DataFrame:
    """Keep the objects of one probe family and drop the ``probe`` column.

    On a payload table written partitioned by ``probe_family`` (the segment
    after the last dot) the test becomes a partition predicate, so the scan
    prunes the other families and never reads ``probe``: for a family name
    without dots, "last segment equals it" is the same test as the suffix
    match.
    """
    if "probe_family" in pl.columns and "." not in family:
        kept = pl.filter(F.col("probe_family") == F.lit(family))
    else:
        kept = pl.filter(probe_suffix_match("probe", family))
    return kept.select(*[c for c in pl.columns if c not in ("probe", "probe_family")])


def probe_types(pl: DataFrame) -> DataFrame:
    """Distinct probe names with their object counts (``probe``, ``n``).

    A partial + final hash aggregate: map-side combining keeps even a probe
    holding most of the rows down to one row per map task before the shuffle.
    """
    return pl.groupBy("probe").agg(F.count(F.lit(1)).alias("n"))
