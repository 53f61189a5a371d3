"""Daily per-participant measures on the typed event tables.

All grouping is by ``(user_id, event_date)``. Counts use partial + final
hash aggregation, so a participant-day holding most of the rows is combined
map-side before any shuffle; nothing collects a group into one task.

``weight`` names a column that tells how many rows each row stands for, so the
measures also take counted rows, such as those of the daily state
(:mod:`phonesense.plans.state`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from phonesense.functions.time import time_of_day
from phonesense.operators.grouped import attach_group_values, counted, with_group_values, written_out
from phonesense.schemas import (
    COMM_TYPES, MAX_TIME_MARK, NULL_CATEGORY_LABEL, OTHER_CATEGORY_LABEL, PHONE_DIRECTIONS,
    RATIO_DENOMINATOR, RATIO_NUMERATOR, SMS_DIRECTIONS,
)

USER_DAY = ("user_id", "event_date")


def discover_categories(df: DataFrame, col: str) -> list[str | None]:
    """Distinct values of a categorical column, sorted, NULL last. Only for the
    data-derived column mode, where they become the schema and so must come to
    the driver; the default columns and the long forms need no such pass."""
    found = [r[0] for r in df.select(col).distinct().collect()]
    return sorted(v for v in found if v is not None) + ([None] if None in found else [])


def _label(value) -> str:
    return NULL_CATEGORY_LABEL if value is None else value


def _matches(col: Column, value) -> Column:
    return col.isNull() if value is None else (col == F.lit(value))


def in_order(df: DataFrame, *cols: str) -> DataFrame:
    """Sorted ascending, missing values last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def _ordered(df: DataFrame, ordered: bool, *cols: str) -> DataFrame:
    """Optionally sort ascending with missing values last (as the original
    analysis orders its tables)."""
    return in_order(df, *cols) if ordered else df


def _category_columns(df: DataFrame, col: str, values: Sequence[str] | None, total) -> list[Column]:
    """One column per category, each ``total`` of the rows that fall in it.

    A declared list is completed by ``OTHER`` (any value not on it) and
    ``<NA>`` (NULL), so every row is in exactly one column; ``values=None``
    makes one column for each value found instead."""
    c = F.col(col)
    if values is None:
        found = discover_categories(df, col)
        return [total(_matches(c, v)).alias(_label(v)) for v in found]
    columns = [total(_matches(c, v)).alias(_label(v)) for v in values]
    named = [F.lit(v) for v in values if v is not None]
    other = c.isNotNull() & ~c.isin(*named) if named else c.isNotNull()
    columns.append(total(other).alias(OTHER_CATEGORY_LABEL))
    return columns if None in values else [*columns, total(c.isNull()).alias(NULL_CATEGORY_LABEL)]


def _number(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def count_commtype(event: DataFrame, types: Sequence[str] | None = COMM_TYPES,
                   ordered: bool = False, weight: str | None = None) -> DataFrame:
    """Events per participant-day, one column per communication type, then
    ``OTHER`` and ``<NA>``.

    A type absent on that day is NULL (not 0). One aggregate, one exchange.
    ``types=None`` derives the columns from the data (NULL type -> ``<NA>``).
    """
    total = ((lambda hit: F.nullif(F.count_if(hit), F.lit(0))) if weight is None
             else (lambda hit: F.sum(F.when(hit, F.col(weight)))))
    counts = _category_columns(event, "communication_type", types, total)
    if not counts:  # no categories at all (empty input in data-derived mode)
        return _ordered(event.groupBy(*USER_DAY).agg(F.count(F.lit(1)).alias("_n")).drop("_n"),
                        ordered, *USER_DAY)
    return _ordered(event.groupBy(*USER_DAY).agg(*counts), ordered, *USER_DAY)


def commtype_long(event: DataFrame, weight: str | None = None) -> DataFrame:
    """Events per participant-day and communication type, one row for each
    type found (NULL included): ``user_id, event_date, category, n``."""
    return event.groupBy(*USER_DAY, F.col("communication_type").alias("category")).agg(
        _number(weight).alias("n"))


def directions_long(event: DataFrame, weight: str | None = None) -> DataFrame:
    """Events per participant-day, type and direction, one row for each that is
    found: ``user_id, event_date, communication_type, category, n``."""
    return event.groupBy(*USER_DAY, "communication_type", F.col("comm_direction").alias("category")).agg(
        _number(weight).alias("n"))


def category_counts(event: DataFrame, col: str, weight: str | None = None) -> DataFrame:
    """Events per participant-day in one map: ``user_id, event_date, counts, unknown``.

    ``counts`` maps each category found in ``col`` that day to its number of events, keys in order;
    ``unknown`` counts the events whose category is NULL (NULL if none). However many categories
    there are, none comes to the driver and the schema doesn't depend on the data: rows are counted
    per category first, so a day's map is gathered from one row a category. :func:`category_columns`
    makes columns of the map for a reader that names them."""
    one = event.groupBy(*USER_DAY, F.col(col).cast("string").alias("category")).agg(_number(weight).alias("n"))
    known = F.when(F.col("category").isNotNull(), F.struct("category", "n"))
    return one.groupBy(*USER_DAY).agg(
        F.map_from_entries(F.array_sort(F.collect_list(known))).alias("counts"),
        F.max(F.when(F.col("category").isNull(), F.col("n"))).alias("unknown"))


def category_columns(counted: DataFrame, values: Sequence[str]) -> DataFrame:
    """A column for each of ``values`` from the maps of :func:`category_counts`, then ``OTHER`` and ``<NA>``;
    what a day has none of is NULL. No shuffle, and no pass over the data to find the columns."""
    listed = F.array(*[F.lit(v) for v in values]).cast("array<string>")
    rest = F.aggregate(F.map_values(F.map_filter("counts", lambda k, _: ~F.array_contains(listed, k))),
                       F.lit(0).cast("long"), lambda total, n: total + n)
    return counted.select(*USER_DAY, *[F.try_element_at("counts", F.lit(v)).alias(v) for v in values],
                          F.nullif(rest, F.lit(0)).alias(OTHER_CATEGORY_LABEL),
                          F.col("unknown").alias(NULL_CATEGORY_LABEL))


def direction_counts(event: DataFrame, comm_type: str, weight: str | None = None) -> DataFrame:
    """``(user_id, event_date, comm_direction, n)`` for one communication type."""
    return (event.filter(F.col("communication_type") == F.lit(comm_type))
            .groupBy(*USER_DAY, "comm_direction").agg(_number(weight).alias("n")))


def _direction_columns(counts: DataFrame, directions) -> list[Column]:
    return _category_columns(counts, "comm_direction", directions,
                             lambda hit: F.sum(F.when(hit, F.col("n"))))


def direction_stats(event: DataFrame, comm_type: str, mean_name: str,
                    directions: Sequence[str] | None, ordered: bool = False, weight: str | None = None) -> DataFrame:
    """Counts per direction plus ``ceil(mean)`` of those counts over the
    direction rows present that day (a NULL direction is one of them)."""
    counts = direction_counts(event, comm_type, weight)
    pivots = _direction_columns(counts, directions)
    out = counts.groupBy(*USER_DAY).agg(F.ceil(F.avg("n")).alias(mean_name), *pivots)
    return _ordered(out, ordered, *USER_DAY)


def stats_phone(event: DataFrame, directions: Sequence[str] | None = PHONE_DIRECTIONS,
                ordered: bool = False, weight: str | None = None) -> DataFrame:
    """PHONE events: ``average_no_calls`` and a count per direction, ``OTHER``
    and ``<NA>`` included."""
    return direction_stats(event, "PHONE", "average_no_calls", directions, ordered, weight)


def stats_sms(event: DataFrame, directions: Sequence[str] | None = SMS_DIRECTIONS,
              ordered: bool = False, weight: str | None = None) -> DataFrame:
    """SMS events: ``average_no_messages`` and a count per direction, ``OTHER``
    and ``<NA>`` included."""
    return direction_stats(event, "SMS", "average_no_messages", directions, ordered, weight)


def direction_ratio(event: DataFrame, comm_type: str, directions: Sequence[str] | None,
                    ordered: bool = False, weight: str | None = None) -> DataFrame:
    """Counts per direction and ``ratio`` = OUTGOING / INCOMING (NULL when
    either side is absent that day)."""
    counts = direction_counts(event, comm_type, weight)
    pivots = _direction_columns(counts, directions)
    d = F.col("comm_direction")
    num = F.max(F.when(d == F.lit(RATIO_NUMERATOR), F.col("n")))
    den = F.max(F.when(d == F.lit(RATIO_DENOMINATOR), F.col("n")))
    out = counts.groupBy(*USER_DAY).agg(*pivots, F.try_divide(num, den).alias("ratio"))
    return _ordered(out, ordered, *USER_DAY)


def ratio_phone(event: DataFrame, directions: Sequence[str] | None = PHONE_DIRECTIONS,
                ordered: bool = False, weight: str | None = None) -> DataFrame:
    return direction_ratio(event, "PHONE", directions, ordered, weight)


def ratio_sms(event: DataFrame, directions: Sequence[str] | None = SMS_DIRECTIONS,
              ordered: bool = False, weight: str | None = None) -> DataFrame:
    return direction_ratio(event, "SMS", directions, ordered, weight)


def longest_calls(calls: DataFrame) -> DataFrame:
    """Rows of the longest call(s) of each participant-day, ties kept, as they are in ``calls``.

    A day with any call of unknown duration has no defined maximum and gives
    no row. The day's maximum is attached to its calls by
    :func:`with_group_values`: calls move once, and a day whose calls all tie stays spread.
    """
    dur = F.col("callDuration")
    top = with_group_values(calls, USER_DAY, _longest=F.max(dur), _unknown=F.bool_or(dur.isNull()))
    return top.filter(~F.col("_unknown") & (dur == F.col("_longest"))).drop("_longest", "_unknown")


def call_duration(calls: DataFrame, ordered: bool = True) -> DataFrame:
    """Longest call(s) of each participant-day (:func:`longest_calls`) with the time-of-day
    label; ordered by ``call_timestamp`` (unknown instants last)."""
    rows = calls.select("user_id", "event_date", "call_timestamp", "callDuration", "event_hour")
    out = longest_calls(rows).select("user_id", "call_timestamp", "event_date", "callDuration",
                                     F.lit(MAX_TIME_MARK).alias("max_time"),
                                     time_of_day("event_hour").alias("time_of_day"))
    return _ordered(out, ordered, "call_timestamp")


def unique_contacts(event: DataFrame, comm_type: str, weight: str | None = None) -> DataFrame:
    """Every event row of ``comm_type`` with ``count_unique`` = number of
    distinct contacts that participant-day (an unknown contact counts once)."""
    own = ["user_id", "number", "event_date"] + ([weight] if weight else [])
    rows = event.filter(F.col("communication_type") == F.lit(comm_type)).select(*own)
    alike = counted(rows, USER_DAY, weight)  # one row per contact of a day
    return written_out(attach_group_values(alike, USER_DAY, count_unique=(F.count(F.lit(1)), "sum"))).select(
        "user_id", "number", "event_date", "count_unique")


def unique_texts(event: DataFrame, weight: str | None = None) -> DataFrame:
    return unique_contacts(event, "SMS", weight)


def unique_calls(event: DataFrame, weight: str | None = None) -> DataFrame:
    return unique_contacts(event, "PHONE", weight)
