"""Attach per-group values back onto every row of the group, skew-safely.

A participant-day may hold a third of all rows, so its rows must not meet in
one task. Rows that are alike are first one row with a count, which partial
aggregation makes before the shuffle. ``HOME``, a hash of the row's other
columns, then cuts a group into at most ``HOMES`` parts: values are computed per
part by partial aggregation, put together over a group's few parts by a window,
and joined to the rows by group and home, so a hot group stays spread. The
counted rows are written out again in pieces of ``PIECE``, dealt evenly.

Nothing runs while a DataFrame is built, nothing is written, and the source is
read once: both uses of the counted rows share one exchange.

:func:`with_group_values` is the form for rows that hardly ever are alike (calls have an
instant each), where counting would gather nothing. Values come from one partial
aggregate, a row a group. Groups that hold over a ``HOT_SHARE``-th of all rows, of which there can be
fewer than ``HOT_SHARE``, are broadcast, so their rows find their values where they are; all other
rows meet theirs in one shuffle, on the partitioning that the aggregate left. Rows move once, no task
gets more than such a share of them, ties and copies or not, and the source is read twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

HOME, TIMES = "_home", "_times"
HOMES = 64
PIECE = 10_000
# A group is hot if it holds more than this part of all rows; so fewer than that many are.
HOT_SHARE = 1024


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; output keeps the left
    key columns only."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    out = left.join(renamed, cond, how)
    if how in ("left_anti", "left_semi", "anti", "semi", "leftanti", "leftsemi"):
        return out
    return out.drop(*[f"__r_{k}" for k in keys])


def counted(rows: DataFrame, keys: Sequence[str], weight: str | None = None) -> DataFrame:
    """Distinct ``rows`` with how often each stands there (``TIMES``; the sum of the column ``weight`` where
    rows are counted already) and its ``HOME`` within its group of ``keys``."""
    columns = [c for c in rows.columns if c != weight]
    rest = [c for c in columns if c not in keys]
    alike = rows.groupBy(*columns).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias(TIMES))
    return alike.withColumn(HOME, F.pmod(F.xxhash64(*rest), F.lit(HOMES)))


def attach_group_values(alike: DataFrame, keys: Sequence[str], **values: tuple[Column, str]) -> DataFrame:
    """``alike`` (as :func:`counted` gives it) with a value of its whole group in
    each of ``values``: a pair of an aggregate over distinct rows and the name
    of the SQL function that puts parts together (``sum``, ``max``...)."""
    # The counts are asked for on this side too, so that Spark reuses the exchange beneath.
    parts = alike.groupBy(*keys, HOME).agg(F.sum(TIMES).alias(TIMES), *[v.alias(c) for c, (v, _) in values.items()])
    group = Window.partitionBy(*keys)
    whole = parts.select(*keys, HOME, (F.col(TIMES) > 0).alias("_any"),
                         *[F.call_function(how, F.col(c)).over(group).alias(c) for c, (_, how) in values.items()])
    return null_safe_join(alike, whole.filter("_any").drop("_any"), [*keys, HOME])


def _plain_keys(rows: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """Columns without NULLs that are equal where ``keys`` are equal or both NULL, so that plain equality joins
    them on the partitioning that is there."""
    blank = {"string": "", "date": "1970-01-01"}
    out = {}
    for k in keys:
        kind = rows.schema[k].dataType
        out[f"_key_{k}"] = F.coalesce(F.col(k), F.lit(blank.get(kind.typeName(), 0)).cast(kind))
        out[f"_none_{k}"] = F.col(k).isNull()
    return out


def with_group_values(rows: DataFrame, keys: Sequence[str], **values: Column) -> DataFrame:
    """``rows`` with the aggregate of its group of ``keys`` in each of ``values``."""
    plain = _plain_keys(rows, keys)
    at = rows.withColumns(plain)
    # Always 0, which the optimizer can't tell: groups are partitioned by it too, as the join below needs them.
    zero = F.coalesce(F.pmod(F.xxhash64(*plain), F.lit(1)), F.lit(0))
    groups = at.groupBy(*plain, zero.alias(HOME)).agg(F.count(F.lit(1)).alias(TIMES), *[v.alias(c) for c, v in values.items()])
    # Every use of the groups asks for all of their columns, so that Spark reuses the exchange beneath.
    total = groups.agg(F.struct(F.sum(TIMES).alias("n"), *[F.count(c).alias(c) for c in [HOME, *values]])).scalar()["n"]
    names = [*plain, HOME, TIMES, *values]
    hot = groups.where(F.col(TIMES) * HOT_SHARE > total).select(*[F.col(c).alias(f"_hot{c}") for c in names])
    at = at.join(F.broadcast(hot), [F.col(c) == F.col(f"_hot{c}") for c in plain], "left")
    # Rows of a hot group need no partner: their home is any but 0.
    away = F.pmod(F.monotonically_increasing_id(), F.lit(HOT_SHARE)) + 1
    at = at.withColumn(HOME, F.when(F.col(f"_hot{HOME}").isNull(), 0).otherwise(away))
    cold = groups.select(*[F.col(c).alias(f"_cold{c}") for c in names])
    at = at.join(cold, [F.col(c) == F.col(f"_cold{c}") for c in [*plain, HOME]], "left")
    own = [F.when(F.col(f"_cold{TIMES}") > 0, F.col(f"_cold{c}")).otherwise(F.col(f"_hot{c}")).alias(c) for c in values]
    return at.select(*rows.columns, *own)


def written_out(alike: DataFrame) -> DataFrame:
    """Each row as often as ``TIMES`` says."""
    n = F.col(TIMES)
    pieces = alike.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / PIECE).cast("int"))))
    dealt = pieces.repartition(*[c for c in alike.columns if c not in (TIMES, HOME)], "_piece")
    size = F.least(F.lit(PIECE), n - F.col("_piece") * PIECE)
    each = dealt.withColumn("_time", F.explode(F.sequence(F.lit(1), size.cast("int"))))
    return each.drop("_piece", "_time", TIMES, HOME)
