"""Centroid clustering (Lloyd's rounds on integer vectors) with a LAESA pivot table.

Each vector's distances to a few fixed pivots are computed once and stored beside it.
In a round the centroids' distances to the same pivots are computed on the driver (centroids
x pivots numbers); the largest difference of a vector's and a centroid's entries is a lower
bound of their distance. The centroid of least bound is measured first, then, in their order, all
whose bound does not exceed the best distance so far: those get the exact integer distance. Bounds
are lowered by more than their rounding error, so no nearest centroid is ever excluded.

A round is one pass over the written table without a shuffle of vectors: a task sends its
centroids' exact sums and counts, which Spark adds up as decimals; what reaches the driver
is the new centroids, bounded by the parameters. Every round reads a written table, so
a lost executor costs tasks of one round.

Defined results: a vector of another number of components, or with a null or non-finite
one, is left out; components are floor(scale * x), held within +-LARGEST, so that every
squared distance of up to 64 components fits a long; a null vec_id stands as no digits in the
starting hash; repeated rows count each time; fewer vectors than centroids make all of them
centroids; an inertia beyond a long is null; an empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

DIM, CENTROIDS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
PIVOTS = 12
#: 64 * (2 * LARGEST) ** 2 < 2 ** 63.
LARGEST = 189_812_531
KEPT = "vec_id long, q array<int>, away array<double>"
FOUND = "vec_id long, cluster int, distance long"


def quantised(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``vec_id, q``: the usable vectors in integers."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fit = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(
        (F.size("x") == dim) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    held = lambda c: F.least(F.greatest(c * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
    return fit.select("vec_id", F.transform("x", lambda c: F.floor(held(c)).cast("int")).alias("q"))


def squares(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Exact squared distances of int64 rows to one vector."""
    apart = rows - one
    return np.einsum("ij,ij->i", apart, apart)


def apart(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows (first axis) to pivots (second)."""
    return np.sqrt(np.stack([squares(rows, p) for p in pivots], 1).astype(float))


def chosen_pivots(points: np.ndarray, n: int) -> np.ndarray:
    """Up to n of the points, each the farthest from those before it."""
    picked = [0]
    least = squares(points, points[0])
    while len(picked) < min(n, len(points)):
        picked.append(int(least.argmax()))
        least = np.minimum(least, squares(points, points[picked[-1]]))
    return points[picked]


def nearest(q: np.ndarray, away: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each row's nearest centroid (of equally near ones the first), its squared distance, and how many distances were taken."""
    entry = apart(centroids, pivots)
    low = np.zeros((len(q), len(centroids)))
    for p in range(len(pivots)):
        a, b = away[:, p, None], entry[None, :, p]
        # Square roots and the difference err by far less than 1e-14 of the two entries.
        np.maximum(low, np.abs(a - b) - 1e-14 * (a + b), out=low)
    low = low * low * (1 - 1e-14)
    cluster = low.argmin(1)
    best = np.empty(len(q), np.int64)
    taken = len(q)
    for c in np.unique(cluster):
        own = np.flatnonzero(cluster == c)
        best[own] = squares(q[own], centroids[c])
    first = cluster.copy()
    for c in range(len(centroids)):
        rows = np.flatnonzero((low[:, c] <= best) & (first != c))
        taken += len(rows)
        d = squares(q[rows], centroids[c])
        closer = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
        best[rows[closer]], cluster[rows[closer]] = d[closer], c
    return cluster, best, taken


def arrays(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass
class Model:
    centroids: np.ndarray
    pivots: np.ndarray

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids.tolist()]


def started(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of least SHA-256 of ``seed:vec_id``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = rows.orderBy(F.sha2(name, 256), "vec_id", "q").limit(k).select("q").collect()
    return np.array([r.q for r in first], np.int64)


def with_pivots(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with ``away``, their distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to = apart(arrays(batch, "q", pivots.shape[1]).astype(np.int64), pivots)
            ends = pa.array(np.arange(len(to) + 1, dtype=np.int32) * len(pivots))
            away = pa.ListArray.from_arrays(ends, pa.array(to.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("q"), away], ["vec_id", "q", "away"])

    return rows.mapInArrow(run, KEPT)


def moved(rows: DataFrame, model: Model) -> np.ndarray:
    """The centroids after one round: the floor of the mean of those assigned; one without any stays."""
    centroids, pivots = model.centroids, model.pivots
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            q = arrays(batch, "q", dim).astype(np.int64)
            cluster, _, _ = nearest(q, arrays(batch, "away", len(pivots)), centroids, pivots)
            np.add.at(total, cluster, q)
            count += np.bincount(cluster, minlength=k)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(count[own]), pa.array(list(total[own]), pa.list_(pa.int64()))],
                                         ["cluster", "n", "sums"])

    parts = rows.select("q", "away").mapInArrow(run, "cluster int, n long, sums array<long>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    sums = each.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(20,0)")).alias("total"))
    new = centroids.copy()
    for r in sums.collect():  # centroids x components at most
        new[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
    return new


def assigned(rows: DataFrame, model: Model) -> DataFrame:
    """``vec_id, cluster, distance`` (squared) of each row."""
    centroids, pivots = model.centroids, model.pivots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = arrays(batch, "q", centroids.shape[1]).astype(np.int64)
            cluster, best, _ = nearest(q, arrays(batch, "away", len(pivots)), centroids, pivots)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(best)],
                                             ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, FOUND)


def clustered(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, pivots: int = PIVOTS) -> tuple[DataFrame, Model | None]:
    """``vec_id, cluster, distance`` of ``quantised`` rows, and the centroids (None without any row)."""
    centroids = started(rows, k, seed)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], FOUND), None
    model = Model(centroids, chosen_pivots(centroids, pivots))
    kept = written(with_pivots(rows, model.pivots), "laesa-table")
    for _ in range(rounds):
        model = Model(moved(kept, model), model.pivots)
    return written(assigned(kept, model), "laesa-clusters"), model


def with_inertia(found: DataFrame, model: Model | None) -> DataFrame:
    """``found`` with its cluster's and the whole inertia and the digest of its centroid."""
    spark = found.sparkSession
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()  # one row a centroid
    whole = sum(int(r["s"]) for r in sums)
    fits = lambda n: n if n < 2 ** 63 else None
    digests = model.digests() if model else []
    small = spark.createDataFrame([(r["cluster"], fits(int(r["s"])), fits(whole), digests[r["cluster"]]) for r in sums],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(small), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(*clustered(quantised(table(spark, sf_dir, "embeddings"))))
