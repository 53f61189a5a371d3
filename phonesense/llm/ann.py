"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are fitted on a sample, drawn by a hash of the id, of at most about
``SAMPLE`` rows (and ``SAMPLE_BYTES``): one task a tree splits the sample at the
median of its projection on the line through two of its points. The forest is
broadcast; its size is bounded by the sample's. Every row of the table is then
indexed: put in its leaf of every tree.

A query walks all trees through one priority queue, nearest side first, until
the leaves it has opened hold a budget of rows by the sample's count. The budget is
measured on the table: for at most ``TRIED`` queries, drawn by a hash, the exact neighbours are found
by one scan, and the budget is what opens the leaf of ``TARGET`` of them. A query's
candidates are the rows of the leaves it opens. Queries and rows meet by leaf, several leaves
to a task, and a task returns the k best of each query there, so no pair of a
query and a candidate is ever shuffled; distances are exact, in double
precision, on the original vectors.

Vectors meet only those of their dimension. The ``FORESTS`` commonest dimensions have a forest each; rows of
all others are searched exactly, in blocks of rows of one dimension.

Of equal vectors only the k + 1 of smallest id can be among a query's k nearest,
so only those are indexed (a limit per vector before the shuffle): copies make
no hot leaf and nothing is lost.

Defined results: a vector that is null, empty, zero or holds null or non-finite
components takes no part, nor does one without a vec_id; rows alike in vec_id and vector count once; a query
never meets its own vec_id; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

TREES = 16
LEAF = 64
TARGET, TRIED = 0.96, 64
FORESTS = 4
SAMPLE = 65_536
SAMPLE_BYTES = 64 << 20
#: Rows of the index that a task reranks at once.
BIN = 8192


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` (doubles) of the rows that take part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fit = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("x", lambda c: c != 0))
    return fit.distinct()


def matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.array([np.asarray(v) for v in column], float).reshape(len(column), dim)


@dataclass
class Tree:
    """Inner node i sends x left if x @ normal[i] <= at[i]; children >= 0 are nodes, others leaf ~child."""

    normal: np.ndarray
    at: np.ndarray
    child: np.ndarray
    held: np.ndarray  # rows of the sample in each leaf

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.normal, self.at, self.child, self.held

    def leaves(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64) if len(self.at) else np.full(len(x), -1)
        while (inner := np.flatnonzero(node >= 0)).size:
            own = node[inner]
            right = np.einsum("ij,ij->i", x[inner], self.normal[own]) > self.at[own]
            node[inner] = self.child[own, right.astype(int)]
        return ~node


def grow(x: np.ndarray, seed: int, leaf: int = LEAF) -> Tree:
    """A tree on the rows of ``x``. A node whose points all project alike stays a leaf."""
    rng = np.random.default_rng(seed)
    normal, at, child, held = [], [], [], []

    def build(rows: np.ndarray) -> int:
        if len(rows) > leaf:
            for _ in range(5):
                a, b = x[rng.choice(rows, 2, replace=False)]
                length = np.linalg.norm(a - b)
                if not length:
                    continue
                line = ((a - b) / length).astype(np.float32)
                p = np.einsum("ij,j->i", x[rows], line.astype(float))
                middle = float(np.median(p))
                right = p > middle
                if 0 < right.sum() < len(rows):
                    i = len(at)
                    normal.append(line)
                    at.append(middle)
                    child.append([0, 0])
                    child[i][0], child[i][1] = build(rows[~right]), build(rows[right])
                    return i
        held.append(len(rows))
        return ~(len(held) - 1)

    build(np.arange(len(x)))
    return Tree(np.array(normal, np.float32).reshape(len(at), x.shape[1]).astype(float), np.array(at), np.array(child, int).reshape(-1, 2),
                np.array(held))


def opened(forest: list[Tree], x: np.ndarray, want: int) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of one priority queue over all trees, until ``want`` rows are held."""
    queue = [(-np.inf, t, 0 if len(tree.at) else -1) for t, tree in enumerate(forest)]
    out, seen = [], 0
    while queue and seen < want:
        far, t, node = heapq.heappop(queue)
        tree = forest[t]
        while node >= 0:
            # Summed as in ``leaves``: by another way a row on the plane may round to the other side.
            beyond = float(np.einsum("ij,ij->i", x[None], tree.normal[node][None])[0]) - tree.at[node]
            near = int(beyond > 0)
            # The other side is as far as the farthest plane crossed on the way to it.
            heapq.heappush(queue, (max(far, abs(beyond)), t, int(tree.child[node, 1 - near])))
            node = int(tree.child[node, near])
        out.append((t, ~node))
        seen += int(tree.held[~node])
    return out


def forest_of(rows: DataFrame, dim: int, trees: int, leaf: int, sample: int, seed: int) -> list[Tree]:
    """The trees, each fitted by a task of its own on the same broadcast sample."""
    spark = rows.sparkSession
    sample = max(1, min(sample, SAMPLE_BYTES // (8 * dim)))
    share = min(1.0, sample / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    got = drawn.select("vec_id", "x").toArrow()
    points = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, dim)[np.argsort(got["vec_id"].to_numpy(), kind="stable")]
    sent = spark.sparkContext.broadcast(points)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [grow(sent.value, seed * 1000 + int(i), leaf) for i in batch["id"]]
            yield pd.DataFrame({"id": batch["id"], "tree": [pickle.dumps(t.arrays()) for t in made]})

    made = spark.range(0, trees, 1, trees).mapInPandas(run, "id long, tree binary").orderBy("id").collect()
    return [Tree(*pickle.loads(r.tree)) for r in made]


def nearest_rows(x: np.ndarray, ids: np.ndarray, at: np.ndarray, asker: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``x`` and distances of the k nearest to ``at``, ties to the smaller id, without the asker itself."""
    score = np.sqrt(((x - at) ** 2).sum(1))
    own = np.flatnonzero(ids != asker)
    best = own[np.lexsort((ids[own], score[own]))[:k]]
    return best, score[best]


def budget(rows: DataFrame, queries: DataFrame, forest: list[Tree], dim: int, k: int, target: float, tried: int, seed: int) -> int:
    """How many rows the leaves opened must hold for ``target`` of the neighbours of at most ``tried`` queries to be in them."""
    some = queries.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(tried).select("vec_id", "x").collect()
    asked = [(r.vec_id, np.array(r.x)) for r in some]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, ids = matrix(batch["x"], dim), batch["vec_id"].to_numpy()
            out = []
            for q, (i, at) in enumerate(asked):
                best, score = nearest_rows(x, ids, at, i, k)
                out += [(q, int(ids[b]), float(s), x[b].tolist()) for b, s in zip(best, score, strict=True)]
            yield pd.DataFrame(out, columns=["q", "vec_id", "score", "x"])

    by = Window.partitionBy("q").orderBy("score", "vec_id")
    found = rows.select("vec_id", "x").mapInPandas(run, "q int, vec_id long, score double, x array<double>")
    found = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("q", "x").collect()
    needs = []
    for q, (_, at) in enumerate(asked):
        near = np.array([r.x for r in found if r.q == q], float).reshape(-1, dim)
        if not len(near):
            continue
        at_leaf = [tree.leaves(near) for tree in forest]
        first, held = np.full(len(near), np.inf), 0
        for t, leaf in opened(forest, at, 1 << 62):
            first[(at_leaf[t] == leaf) & np.isinf(first)] = held + 1
            held += int(forest[t].held[leaf])
            if np.isfinite(first).all():
                break
        needs += first.tolist()
    return max(k, int(np.ceil(np.quantile(needs, target, method="higher")))) if needs else k


FOUND = "query_id long, q long, vec_id long, score double"


def exactly(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """``FOUND`` of queries against all rows of their dimension: rows in parts of about ``BIN``, queries sent to
    each part of their dimension."""
    sizes = rows.groupBy(F.size("x").alias("dim")).agg(F.ceil(F.count("*") / F.lit(BIN)).cast("int").alias("parts"))
    held = rows.withColumn("dim", F.size("x")).join(sizes, "dim")
    held = held.select("dim", F.pmod(F.xxhash64("vec_id", "x"), F.col("parts")).cast("int").alias("part"), "vec_id", "x")
    asked = queries.select(F.size("x").alias("dim"), F.col("vec_id").alias("query_id"), F.xxhash64("x").alias("q"), "x").join(
        sizes.toDF("dim", "parts"), "dim")
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x, ids = matrix(right["x"], key[0]), right["vec_id"].to_numpy()
            for i, q, at in zip(left["query_id"], left["q"], matrix(left["x"], key[0]), strict=True):
                best, score = nearest_rows(x, ids, at, i, k)
                out += [(i, q, ids[b], s) for b, s in zip(best, score, strict=True)]
        return pd.DataFrame(out, columns=["query_id", "q", "vec_id", "score"])

    return asked.groupBy("dim", "part").cogroup(held.groupBy("dim", "part")).applyInPandas(run, FOUND)


def through_forest(queries: DataFrame, rows: DataFrame, dim: int, k: int, trees: int, leaf: int, want: int | None, target: float,
                   sample: int, seed: int) -> DataFrame:
    """``FOUND`` of queries and rows of one dimension."""
    made = forest_of(rows, dim, trees, leaf, sample, seed)
    want = budget(rows, queries, made, dim, k, target, TRIED, seed) if want is None else want
    sent = rows.sparkSession.sparkContext.broadcast([t.arrays() for t in made])

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = [Tree(*t) for t in sent.value]
        for batch in batches:
            x = matrix(batch["x"], dim)
            for t, tree in enumerate(forest):
                yield pd.DataFrame({"tree": t, "leaf": tree.leaves(x), "vec_id": batch["vec_id"], "x": batch["x"]})

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = [Tree(*t) for t in sent.value]
        for batch in batches:
            for i, q, x in zip(batch["query_id"], batch["q"], batch["x"], strict=True):
                out = pd.DataFrame(opened(forest, np.asarray(x), want), columns=["tree", "leaf"]).assign(query_id=i, q=q)
                yield out.assign(x=[x] * len(out))

    def rerank(visits: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(visits) and len(held):
            at, x = matrix(visits["x"], dim), matrix(held["x"], dim)
            asker, q, ids = visits["query_id"].to_numpy(), visits["q"].to_numpy(), held["vec_id"].to_numpy()
            leaves = held.groupby(["tree", "leaf"]).indices
            for key, asking in visits.groupby(["tree", "leaf"]).indices.items():
                own = leaves.get(key, ())
                for i in asking if len(own) else ():
                    best, score = nearest_rows(x[own], ids[own], at[i], asker[i], k)
                    found.append((np.full(len(best), i), own[best], score))
        if not found:
            return pd.DataFrame(columns=["query_id", "q", "vec_id", "score"])
        i, row, score = (np.concatenate(v) for v in zip(*found, strict=True))
        every = pd.DataFrame({"query_id": asker[i], "q": q[i], "vec_id": ids[row], "score": score})
        every = every.drop_duplicates(["query_id", "q", "vec_id"]).sort_values(["query_id", "q", "score", "vec_id"])
        return every[every.groupby(["query_id", "q"]).cumcount() < k]

    bins = max(1, -(-rows.count() * trees // BIN))
    bin_of = F.pmod(F.xxhash64("tree", "leaf"), F.lit(bins)).alias("bin")
    indexed = rows.select("vec_id", "x").mapInPandas(index, "tree int, leaf long, vec_id long, x array<double>").select(bin_of, "*")
    asked = queries.select(F.col("vec_id").alias("query_id"), F.xxhash64("x").alias("q"), "x")
    visits = asked.mapInPandas(ask, "tree int, leaf long, query_id long, q long, x array<double>").select(bin_of, "*")
    return visits.groupBy("bin").cogroup(indexed.groupBy("bin")).applyInPandas(rerank, FOUND)


def search(queries: DataFrame, rows: DataFrame, k: int, trees: int = TREES, leaf: int = LEAF, want: int | None = None,
           sample: int = SAMPLE, seed: int = 7, target: float = TARGET, forests: int = FORESTS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for ``queries`` against ``rows`` (both as ``usable`` gives them); ``want`` sets
    the budget of rows opened instead of having it measured."""
    dim = F.size("x")
    same = Window.partitionBy("x").orderBy("vec_id")
    rows = rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).drop("copy")
    rows = written(rows, "ann-rows")
    asked = queries.select(dim.alias("dim")).distinct()
    common = [r.dim for r in rows.groupBy(dim.alias("dim")).count().join(asked, "dim").orderBy(F.desc("count"), "dim").limit(forests).collect()]
    near = [through_forest(queries.where(dim == d), rows.where(dim == d), d, k, trees, leaf, want, target, sample, seed) for d in common]
    near.append(exactly(queries.where(~dim.isin(*common)), rows.where(~dim.isin(*common)), k))
    every = near[0]
    for more in near[1:]:
        every = every.union(more)
    # A row in a leaf of several trees comes from each of them.
    every = every.groupBy("query_id", "q", "vec_id").agg(F.min("score").alias("score"))
    by = Window.partitionBy("query_id", "q").orderBy("score", "vec_id")
    ranked = every.withColumn("rank", F.row_number().over(by).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(usable(table(spark, sf_dir, "embeddings")), "ann-usable")
    return search(rows.where(F.col("vec_id") % 100 == 0), rows, 10)
