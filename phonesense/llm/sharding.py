"""Sharding by sampled splitters: size-weighted quantile ranges of a content key.

A narrow table (id, size, checksum, 64-bit hash of the text) is written once, and
the plan is made from it alone. A size-weighted sample of the hashes gives quantile
boundaries, which cut the key space into many more ranges than shards; each
record falls in one range by an equi-join on the leading bits of its key. The
exact bytes of every range are then summed. Ranges that are overfull are
subdivided: the groups of equal texts that make them heavy become units of
their own, and a group larger than a shard is dealt in pieces by a hash of the
id. Heavy units go to the shards in serpentine order of size; the remaining
ranges, in key order, fill what room each shard has left.

So the law is ``bytes``: shards hold nearly the same number of bytes, and
equal texts share a shard unless their group is larger than one. The plan is
four tables bounded by the number of ranges; whole records find their shard in
them by broadcast, move once, range-partitioned by (shard, unit, part), get their slots there
and are written shard by shard in slot order.

Defined results: a null text has no bytes (size 16, checksum 0); a null id is
hashed as null; rows alike in id and text may swap slots; an empty table gives
no rows. Long texts move whole. All columns are kept as they are, in one struct, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phonesense.session import remove_at_exit, scratch_path

from .common import table, written

SHARDS = 40
RANGES_PER_SHARD = 250
SAMPLE_PER_RANGE = 8
#: A unit of at least a shard's bytes over this is placed by itself.
HEAVY = 64
PREFIX_BITS = 12
PARTS = 16


def measured(docs: DataFrame) -> DataFrame:
    """Each row as a struct ``row``, with its id, size, checksum and key."""
    text = F.col("text")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
                       F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
                       F.xxhash64(text).alias("key"))


def splitters(rows: DataFrame, ranges: int, per_range: int = SAMPLE_PER_RANGE) -> DataFrame:
    """Boundaries ``at`` of the size-weighted quantile ranges. A row is drawn with a chance in
    proportion to its size, by a hash of its id and key, so reruns draw alike; about
    ``ranges * per_range`` rows are expected whatever the input."""
    chance = F.col("size") * F.lit(float(ranges * per_range)) / rows.agg(F.sum("size")).scalar()
    draw = F.pmod(F.xxhash64(F.lit(3), "doc_id", "key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rank = F.row_number().over(Window.orderBy("key"))
    drawn = rows.where(draw < chance).withColumn("rank", rank)
    return drawn.where(F.col("rank") % per_range == 0).select(F.col("key").alias("at")).distinct()


def ranged(rows: DataFrame, at: DataFrame, bits: int = PREFIX_BITS) -> DataFrame:
    """``rows`` with ``lo``, the boundary of the range that holds the key. Each prefix of the
    key lists the ranges that touch it, so the search is an equi-join on the prefix; its
    table has at most a row for each boundary and each prefix."""
    shift = 64 - bits
    ends = at.select(F.col("at").alias("lo")).union(
        at.sparkSession.createDataFrame([(-(1 << 63),)], "lo long"))
    ends = ends.distinct().withColumn("hi", F.lead("lo").over(Window.orderBy("lo")))
    last = F.when(F.col("hi").isNull(), F.lit((1 << (bits - 1)) - 1)).otherwise(F.shiftright("hi", shift))
    touch = ends.withColumn("prefix", F.explode(F.sequence(F.shiftright("lo", shift).cast("int"), last.cast("int"))))
    inside = (F.col("key") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("key") < F.col("hi")))
    return rows.withColumn("prefix", F.shiftright("key", shift).cast("int")).join(
        F.broadcast(touch), "prefix", "left").where(inside).drop("prefix", "hi")


def plan(rows: DataFrame, shards: int = SHARDS, per_shard: int = RANGES_PER_SHARD) -> tuple[DataFrame, ...]:
    """Boundaries, groups dealt by themselves, shards of their pieces, and shards of all other ranges."""
    at = written(splitters(rows, shards * per_shard), "shard-splitters")
    rows = written(ranged(rows, at), "shard-ranges")
    held = rows.groupBy("lo").agg(F.sum("size").alias("held"))
    goal = (F.sum("held").over(Window.partitionBy()) / F.lit(float(shards))).alias("goal")
    held = written(held.select("lo", "held", goal), "shard-held")
    over = held.where(F.col("held") * per_shard > F.col("goal") * 2).select("lo", "goal")
    groups = rows.join(F.broadcast(over), "lo").groupBy("lo", "key").agg(
        F.sum("size").alias("bytes"), F.max("goal").alias("goal")).where(F.col("bytes") * HEAVY >= F.col("goal"))
    pieces = F.when(F.col("bytes") > F.col("goal"), F.ceil(F.col("bytes") * 2 / F.col("goal"))).otherwise(1)
    groups = groups.withColumn("pieces", pieces.cast("int"))
    heavy = groups.select("lo", "key", "goal", "pieces", (F.col("bytes") / F.col("pieces")).alias("bytes"),
                          F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    turn = F.row_number().over(Window.orderBy(F.desc("bytes"), "key", "piece")) - 1
    lap, step = F.floor(turn / shards), F.pmod(turn, F.lit(shards))
    heavy = written(heavy.withColumn("shard", F.when(F.pmod(lap, F.lit(2)) == 0, step).otherwise(shards - 1 - step)
                                     .cast("int")), "shard-heavy")

    # What room each shard has left, as marks on the line of the light ranges' bytes.
    load = heavy.groupBy("shard").agg(F.sum("bytes").alias("load"))
    light = held.join(heavy.groupBy("lo").agg(F.sum("bytes").alias("off")), "lo", "left").select(
        "lo", "goal", (F.col("held") - F.coalesce("off", F.lit(0.0))).alias("bytes"))
    room = rows.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(load, "shard", "left")
    room = room.withColumn("room", F.greatest(F.lit(0.0), held.agg(F.max("goal")).scalar() - F.coalesce("load", F.lit(0.0))))
    scale = light.agg(F.sum("bytes")).scalar() / F.nullif(F.sum("room").over(Window.partitionBy()), F.lit(0.0))
    mark = F.sum(F.col("room") * F.col("scale")).over(Window.orderBy("shard"))
    marks = room.withColumn("scale", scale).select("shard", mark.alias("x"), F.lit(None).cast("long").alias("lo"))
    middle = F.sum("bytes").over(Window.orderBy("lo")) - F.col("bytes") / 2
    line = light.select(F.lit(None).cast("int").alias("shard"), middle.alias("x"), "lo").unionByName(marks)
    # A range goes to the first shard whose mark lies beyond its middle.
    ahead = Window.orderBy(F.col("x"), F.col("shard").asc_nulls_first()).rowsBetween(0, Window.unboundedFollowing)
    spot = F.first("shard", ignorenulls=True).over(ahead)
    light = line.withColumn("to", F.coalesce(spot, F.lit(shards - 1))).where("lo is not null").select(
        "lo", F.col("to").alias("light_shard"))

    return at, heavy.select("key", "lo", "pieces").distinct(), heavy.select(
        "lo", "key", "piece", F.col("shard").alias("heavy_shard")), written(light, "shard-light")


def placed(rows: DataFrame, at: DataFrame, parts: DataFrame, heavy: DataFrame, light: DataFrame) -> DataFrame:
    """``rows`` with ``shard`` and ``unit`` by the tables of :func:`plan`; no row moves."""
    rows = ranged(rows, at).join(F.broadcast(parts), ["lo", "key"], "left")
    rows = rows.withColumn("piece", F.pmod(F.xxhash64(F.lit(5), "doc_id", "key"), F.col("pieces")).cast("int"))
    rows = rows.join(F.broadcast(heavy), ["lo", "key", "piece"], "left").join(F.broadcast(light), "lo", "left")
    unit = F.when(F.col("piece").isNull(), F.struct("lo", F.lit(None).cast("long").alias("key"))).otherwise(
        F.struct("lo", "key"))
    return rows.withColumns({"shard": F.coalesce("heavy_shard", "light_shard"), "unit": F.xxhash64(unit)}).drop(
        "heavy_shard", "light_shard", "pieces", "piece", "lo")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, per_shard: int = RANGES_PER_SHARD,
                 parts: int = PARTS) -> DataFrame:
    """Writes ``docs`` to ``path`` as Parquet, a folder for each shard with its rows in slot order, and reads it
    again: ``row`` (all columns of ``docs``), ``size, text_crc32, slot, shard``.

    The counts that are broadcast have a row for each unit and part: about ``shards * per_shard * parts``. A unit is moved
    to ``parts`` tasks, so raise ``parts`` where a shard's bytes over ``2 * parts`` don't fit on an executor's disk."""
    rows = measured(docs)
    tables = plan(written(rows.drop("row"), "shard-narrow"), shards, per_shard)
    cell = ["shard", "unit", "part"]
    part = F.pmod(F.xxhash64(F.lit(9), "doc_id", "key"), F.lit(parts))
    counts = written(placed(rows.drop("row"), *tables).withColumn("part", part).groupBy(*cell).agg(F.count("*").alias("n")),
                     "shard-counts")
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("unit", "part")) - F.col("n")
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy("key", "doc_id"))
    own = placed(rows, *tables).withColumn("part", part).repartitionByRange(*cell).withColumn("rank", rank)
    own = own.join(F.broadcast(counts.select(*cell, before.alias("before"))), cell)
    own = own.select("row", "size", "text_crc32", (F.col("before") + F.col("rank") - 1).alias("slot"), "shard")
    own.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(own.schema).parquet(path)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = remove_at_exit(spark, scratch_path(spark, "shards"))
    out = write_shards(table(spark, sf_dir, "documents"), path)
    return out.select("row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
