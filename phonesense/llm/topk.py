"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are quantised to integers. Candidates are grouped by length: ranges of
length, each of at most ``SLAB`` rows (more are split by a hash of the id), are
the units of work, and inside one the rows in falling length make buckets of
``BUCKET``. For a query and a bucket the score still to beat, over both lengths,
is a local cosine threshold:

* it is over 1: no row of the bucket, or of the shorter ones after it, can score;
* it is high: *coordinate* pruning keeps the rows whose largest few coordinates
  lie in the interval that the threshold allows;
* it is low: *length* pruning keeps the rows long enough to reach it.

What is left is verified by whole products. Each query starts from the score
that the longest vectors of the table, a fixed number of them, already give it.

All queries go to every slab: a stated query set in blocks, joined by slab
number and block. Each task holds one slab and one block of queries, both of bounded size,
and returns k rows a query; a partial limit and one final window rank them.

Defined results: a vector that is null, empty or holds null or non-finite
components takes no part, nor does one without a vec_id; rows alike in vec_id
and vector count once; vectors of unlike dimension do not meet; a query never
meets its own vec_id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

SLAB = 16_384
BLOCK = 2048
BUCKET = 1024
SEEDS = 2048
LEVELS = 256
#: Local cosine from which on coordinates prune, and how many are looked at.
STEEP, FOCUS = 0.3, 4
#: Sums of products below this are exact in doubles.
EXACT = 2.0 ** 53


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id, q, dim, length``: floor(scale * component), usable vectors only."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fit = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    q = F.transform("x", lambda c: F.floor(c * scale).cast("long"))
    made = fit.select("vec_id", q.alias("q")).distinct()
    square = F.aggregate("q", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    return made.withColumns({"dim": F.size("q"), "length": F.sqrt(square)})


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in column])


def products(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products as int64 (as Python integers where those could overflow)."""
    bound = float(np.abs(rows).max(initial=0)) * float(np.abs(q).max(initial=0)) * len(q)
    if bound < EXACT:
        return (rows.astype(float) @ q.astype(float)).astype(np.int64)
    return rows @ q if bound < 2.0 ** 62 else rows.astype(object) @ q.astype(object)


class Slab:
    """Rows of one range of lengths, in buckets of falling length."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, bucket: int = BUCKET):
        length = np.sqrt((rows.astype(float) ** 2).sum(1))
        order = np.lexsort((ids, -length))
        self.ids, self.rows, self.length = ids[order], rows[order], length[order]
        self.exact = self.rows.astype(float)
        self.unit = self.exact / np.maximum(self.length, 1e-300)[:, None]
        self.ends = [(a, min(a + bucket, len(ids))) for a in range(0, len(ids), bucket)]
        self.largest = float(np.abs(rows).max(initial=0))

    def top(self, vec_id: int, q: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows that score at least ``floor``."""
        q_length = float(np.sqrt((q.astype(float) ** 2).sum()))
        focus = np.argsort(-np.abs(q))[:FOCUS]
        qu = q / max(q_length, 1e-300)
        exact = self.largest * float(np.abs(q).max(initial=0)) * len(q) < EXACT
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a, b in self.ends:
            reach = q_length * self.length[a]
            local = floor / reach - 1e-9 if reach > 0 else (-np.inf if floor <= 0 else np.inf)
            if local > 1:
                break
            if local >= STEEP:
                keep = np.arange(a, b)
                # The angle between a unit row c and axis f differs from q's by at most acos t.
                for f in focus:
                    wide = np.sqrt(max(0.0, (1 - local * local) * (1 - qu[f] ** 2))) + 1e-9
                    low = -1.1 if qu[f] < -local else qu[f] * local - wide
                    high = 1.1 if qu[f] > local else qu[f] * local + wide
                    c = self.unit[keep, f]
                    keep = keep[(c >= low) & (c <= high)]
                found = self.exact[keep] @ q.astype(float) if exact else products(self.rows[keep], q)
            else:
                # A row shorter than this can't reach the score whatever its direction.
                long = floor / q_length * (1 - 1e-9) if q_length > 0 and floor > 0 else 0.0
                keep = np.arange(a, a + np.searchsorted(-self.length[a:b], -long, "right"))
                found = self.exact[a:a + len(keep)] @ q.astype(float) if exact else products(self.rows[keep], q)
            ok = (found >= floor) & (self.ids[keep] != vec_id)
            if ok.any():
                ids = np.r_[ids, self.ids[keep[ok]]]
                scores = np.r_[scores, found[ok].astype(scores.dtype if exact else found.dtype)]
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
                if len(ids) == k:
                    floor = max(floor, float(scores[-1]) * (1 - 1e-12 * np.sign(float(scores[-1]))))
        return ids, scores


def seeded(queries: DataFrame, rows: DataFrame, k: int, seeds: int = SEEDS) -> DataFrame:
    """``queries`` with ``floor``, the k-th score among the ``seeds`` longest rows of its dimension
    (at most that many are collected, by a partial limit), or null."""
    longest = rows.orderBy(F.desc("length"), "vec_id").limit(seeds).select("vec_id", "q").collect()
    sent = rows.sparkSession.sparkContext.broadcast([(r.vec_id, r.q) for r in longest])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_dim: dict[int, Slab] = {}
        for d in {len(q) for _, q in sent.value}:
            own = [(i, q) for i, q in sent.value if len(q) == d]
            by_dim[d] = Slab(np.array([i for i, _ in own]), np.array([q for _, q in own], np.int64))
        for batch in batches:
            floor = []
            for i, q in zip(batch["vec_id"], batch["q"], strict=True):
                slab = by_dim.get(len(q))
                _, scores = slab.top(i, np.asarray(q, np.int64), k, -np.inf) if slab else ((), ())
                floor.append(float(scores[-1]) if len(scores) == k else None)
            batch["floor"] = pd.Series(floor, dtype="float64", index=batch.index)
            yield batch

    return queries.mapInPandas(run, "vec_id long, q array<long>, dim int, floor double")


def slabs(rows: DataFrame, size: int = SLAB) -> DataFrame:
    """``rows`` with ``slab``: ranges of length within a dimension, none much over ``size`` rows.
    A row's range is its place among at most LEVELS quantiles of length; where there are more
    rows, or equal lengths make a range overfull, a hash of the id splits it."""
    steps = min(LEVELS, rows.count() // size + 1)
    cuts = rows.select(F.percentile_approx("length", [i / steps for i in range(1, steps)] or [1.0], 10_000)).first()[0] or []
    level = sum((F.when(F.col("length") > F.lit(c), 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    leveled = rows.withColumn("level", level)
    counts = leveled.groupBy("dim", "level").agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias("parts"))
    return leveled.join(counts, ["dim", "level"]).withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).drop("parts")


def search(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each of ``queries`` its k best of ``rows`` (both as
    ``quantised`` gives them), ties to the smaller vec_id."""
    rows = written(slabs(rows), "topk-rows")
    queries = written(seeded(queries.select("vec_id", "q", "dim"), rows, k), "topk-queries")
    units = rows.select("dim", "level", "part").distinct()
    blocks = max(1, -(-queries.count() // BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id", "q"), F.lit(blocks)).cast("int"))
    asked = queries.join(units, "dim")
    held = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    held = held.toDF(*held.columns)  # columns of its own, as both sides come from the same rows

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            slab = Slab(right["vec_id"].to_numpy(), matrix(right["q"]))
            for i, q, floor in zip(left["vec_id"], left["q"], left["floor"], strict=True):
                ids, scores = slab.top(i, np.asarray(q, np.int64), k, floor if floor == floor else -np.inf)
                out += [(i, list(q), int(v), int(s)) for v, s in zip(ids, scores, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "q", "vec_id", "score"])

    keys = ["dim", "level", "part", "block"]
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(
        run, "query_id long, q array<long>, vec_id long, score long")
    by = Window.partitionBy("query_id", F.xxhash64("q")).orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(quantised(table(spark, sf_dir, "embeddings")), "topk-quantised")
    return search(rows.where(F.col("vec_id") % 50 == 0), rows, 5)
