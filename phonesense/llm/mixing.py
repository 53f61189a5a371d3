"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is dealt into a fixed number of blocks by a hash of the row. A
source's target is met by whole repeats of the source, then whole blocks, then
part of one block up to a hash cut-off, so a row's copies follow from the row
and one small record of its source. The drawn blocks (source, block, copy) go
down a binary tree over the output shards: at each node a random permutation
of the node's blocks gives the left half its exact share, so the number of
blocks each source sends left is a multivariate hypergeometric draw and the
quotas of the two halves add up exactly. Inside a shard the rows lie in the
order of a hash: the local shuffle.

Everything is DataFrame functions. The block table has at most ``blocks`` rows
for each source and copy, however large the source is, and is the only thing
sorted in one place. A row-wise window runs over one block of a source only.

Defined results: a null text has size 0; null sources are one source, last in
order; documents of size 0 take 0 words; an empty table gives no rows; other
columns of the input pass through ``mix``. Rows alike in doc_id and text share
one decision.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, table, written

BLOCKS = 256
MAX_REPEAT = 3
SHARDS = 16


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"({WORD})")), F.lit(0)).cast("long")


def place(doc_id: str = "doc_id", text: str = "text", blocks: int = BLOCKS, seed: int = 11) -> tuple[Column, Column]:
    """A row's block and its place inside the block."""
    row = [F.col(doc_id), F.col(text)]
    return (F.pmod(F.xxhash64(F.lit(seed), *row), F.lit(blocks)).cast("int"),
            F.xxhash64(F.lit(seed + 1), *row))


def targets(sizes: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size`` -> with ``target``: shares by weight 1, 2, 3, repeating in
    source order, stopped at ``max_repeat`` sizes, the excess going to the others by weight.

    With sources in order of size / weight, those stopped are the first ones; the level
    that the rest share is the first that its own source can take."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", (F.pmod(F.row_number().over(order) - 1, F.lit(3)) + 1).cast("double"))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    by = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, rest = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(rest))
    ranked = ranked.withColumn("level", level)
    share = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    target = F.least("cap", F.coalesce(share * F.col("weight"), F.col("cap")))
    return ranked.withColumn("target", target).select("source", "source_size", "weight", "target")


def sized(docs: DataFrame, blocks: int = BLOCKS, seed: int = 11) -> DataFrame:
    """The narrow table that all planning reads: the texts are scanned once."""
    block, spot = place(blocks=blocks, seed=seed)
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), block.alias("block"), spot.alias("spot"))


def split_tree(draws: DataFrame, shards: int = SHARDS, seed: int = 11) -> DataFrame:
    """``source, block, copy`` -> with ``shard``: each level deals a node's draws to its two halves."""
    node = Window.partitionBy("shard", "width")
    draws = draws.withColumns({"shard": F.lit(0), "width": F.lit(shards)})
    for level in range(max(0, math.ceil(math.log2(shards)))):
        rank = F.row_number().over(node.orderBy(F.xxhash64(F.lit(seed + 2 + level), "source", "block", "copy"),
                                                "source", "block", "copy"))
        half = F.floor(F.col("width") / 2).cast("int")
        left = rank <= F.round(F.count("*").over(node) * half / F.col("width"))
        draws = draws.withColumn("left", left).withColumns({
            "shard": F.when(F.col("left"), F.col("shard")).otherwise(F.col("shard") + half),
            "width": F.when(F.col("left"), half).otherwise(F.col("width") - half)})
    return draws.select("source", "block", "copy", "shard")


def plan(rows: DataFrame, blocks: int = BLOCKS, shards: int = SHARDS, max_repeat: int = MAX_REPEAT,
         seed: int = 11) -> DataFrame:
    """One record for each source: ``source, source_size, target, repeats, full, cutoff,
    shard_of`` (the shard of block b's copy c at b * (max_repeat + 1) + c)."""
    held = rows.groupBy("source", "block").agg(F.sum("size").alias("held"))
    source = targets(held.groupBy("source").agg(F.sum("held").alias("source_size")), max_repeat)
    source = source.withColumn("repeats", F.when(F.col("source_size") > 0, F.least(
        F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(max_repeat))).otherwise(0).cast("int"))
    source = source.withColumn("left", F.greatest(F.lit(0.0), F.col("target") - F.col("repeats") * F.col("source_size")))
    cum = F.sum("held").over(Window.partitionBy("source").orderBy("block"))
    held = held.withColumn("upto", cum).join(source.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    edge = held.where("upto > left").groupBy("s").agg(F.min("block").alias("full"),
                                                     F.min(F.col("upto") - F.col("held")).alias("before"))
    source = source.join(edge, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    source = source.withColumns({"full": F.coalesce("full", F.lit(blocks)),
                                 "room": F.col("left") - F.coalesce("before", F.lit(0))}).drop("before", "left")
    cut = source.select(F.col("source").alias("s"), "full", "room")
    last = rows.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("full")))
    run = Window.partitionBy("source", "block").orderBy("spot").rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumn("run", F.sum("size").over(run)).where("run - size / 2 <= room")
    last = last.groupBy("s").agg(F.max("spot").alias("cutoff"))
    source = source.join(last, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "room")
    copies = F.col("repeats") + F.when(F.col("block") <= F.col("full"), 1).otherwise(0)
    draws = source.select("source", "repeats", "full", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    draws = draws.where(copies > 0).select("source", "block", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    dealt = split_tree(draws, shards, seed).groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("block") * (max_repeat + 1) + F.col("copy"), "shard"))).alias("shard_of"))
    dealt = dealt.withColumnRenamed("source", "s")
    return source.join(dealt, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def with_copies(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows having ``source, block, spot``, with their source's record and ``copies``."""
    sources = sources.withColumnRenamed("source", "_source")
    extra = (F.col("block") < F.col("full")) | ((F.col("block") == F.col("full")) & (F.col("spot") <= F.col("cutoff")))
    joined = rows.join(sources, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    return joined.withColumn("copies", F.col("repeats") + F.when(extra, 1).otherwise(0))


def mix(docs: DataFrame, blocks: int = BLOCKS, shards: int = SHARDS, max_repeat: int = MAX_REPEAT, seed: int = 11) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, all columns kept,
    laid out shard by shard and shuffled inside each. Adds ``mix_shard``, unless ``docs`` has a
    column of that name, which stays as it is."""
    sources = written(plan(written(sized(docs, blocks, seed), "mix-sizes"), blocks, shards, max_repeat, seed), "mix-plan")
    block, spot = place(blocks=blocks, seed=seed)
    names = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "source", block.alias("block"), spot.alias("spot"))
    taken = with_copies(inner, sources).where("copies > 0")
    taken = taken.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    shard = F.col("shard_of")[F.col("block") * (max_repeat + 1) + F.col("copy")]
    out = taken.select("row", shard.alias("mix_shard"), F.xxhash64(F.lit(seed + 99), "spot", "copy").alias("at"))
    out = out.repartition("mix_shard", F.pmod("at", F.lit(64))).sortWithinPartitions("mix_shard", "at")
    shard = [] if "mix_shard" in map(str.lower, names) else ["mix_shard"]
    return out.select(*[F.col("row")[c].alias(c) for c in names], *shard)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(sized(table(spark, sf_dir, "documents")), "mix-sizes")
    out = with_copies(rows, written(plan(rows), "mix-plan"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                      "copies", F.element_at("shard_of", F.col("block") * (MAX_REPEAT + 1)).alias("first_shard"))
