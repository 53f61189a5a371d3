"""Near-duplicate vectors by int8 tile products with quantisation error bounds.

Within a label, vectors are scaled to length one and rounded to int8 with a scale of
their own; the length of what the rounding left is kept for each vector. For two vectors
the scaled integer product differs from their cosine by at most

    |s_a a| e_b + e_a |s_b b| + e_a e_b

(s the scales, a and b the integers, e the lengths left), so a pair whose product plus that
bound stays below the threshold can't be linked. All others, and only those, are
recomputed in double precision from the components as given. Products of int8 are taken as
float32 matrix products over parts of ``EXACT`` components, whose whole sums float32 holds exactly.

A label with more than ``TILE`` vectors is cut into tiles by a hash, and each pair of its tiles
is one unit of work, so a label with any share of the rows is spread over (tiles squared / 2)
tasks of bounded size; small labels share units. No pair leaves a task: it returns, for a
vector with links, their number and one edge to a neighbour in the tile pair's own
components (of a tree with ``FAN`` branches, so no vertex has many edges). Those edges are joined to
whole components. Equal vectors of a label are one node with a count, made by a partial aggregate.

A row of a label with t tiles is shuffled t times (its int8 form, its components as given and
four numbers), which is the price of comparing all rows of a label; work grows with the
square of a label, as the exact answer to "how many links" does.

Defined results: a vector that is null, empty, zero or holds null or non-finite components,
or whose label is null, links with nothing and is its own component; vectors of
unlike length do not link; cosines do not depend on length, so any finite magnitude is fine;
every other row is another vector, repeated rows too; a null vec_id never names a component that has another
id (kept if it has none); an empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written
from .neardup import connected

THRESHOLD = 0.93
TILE = 4096
#: Rows of a tile that are multiplied with another at once.
STRIPE = 1024
FAN = 16
#: 127 * 127 * EXACT < 2 ** 24, so float32 sums of that many products are exact.
EXACT = 1024
#: More than the rounding error of all double-precision steps.
SLACK = 1e-6

NODE = "vec_id long, label int, dim int, node binary, x binary, packed binary, scale double, error double, length double"


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two each, so that their largest component is between 0.5 and 1."""
    with np.errstate(all="ignore"):
        _, power = np.frexp(np.abs(x).max(1))
    return np.ldexp(x, -power[:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, an upper bound of the error's length and of the rounded row's length."""
    u = unit(x)
    scale = np.abs(u).max(1) / 127
    packed = np.rint(u / scale[:, None]).astype(np.int8)
    back = packed * scale[:, None]
    length = lambda v: np.sqrt(np.einsum("ij,ij->i", v, v)) * (1 + 1e-9) + 1e-12
    return packed, scale, length(u - back), length(back)


def nodes(vectors: DataFrame) -> DataFrame:
    """One row for each row: ``node`` names a vector within its label; null where it can't link."""
    wide = dict(vectors.dtypes)["embedding"] != "array<float>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "label": batch["label"].astype("Int32"), "dim": 0})
            rest = {c: np.full(len(batch), None, object) for c in ("node", "x", "packed", "scale", "error", "length")}
            rows = [np.asarray(v, float) + 0.0 if v is not None and len(v) else None for v in batch["embedding"]]  # -0.0 is 0.0
            ok = [v is not None and bool(np.isfinite(v).all() and v.any()) for v in rows]
            ok = np.array(ok, bool) & batch["label"].notna().to_numpy()
            sizes = np.array([0 if v is None else len(v) for v in rows])
            out["dim"] = sizes.astype(np.int32)
            for dim in np.unique(sizes[ok]):
                at = np.flatnonzero(ok & (sizes == dim))
                x = np.stack([rows[i] for i in at])
                packed, scale, error, length = quantised(x)
                given = x if wide else x.astype(np.float32)
                for j, i in enumerate(at):
                    data = given[j].tobytes()
                    rest["x"][i], rest["packed"][i] = data, packed[j].tobytes()
                    rest["node"][i] = hashlib.blake2b(data, digest_size=16, salt=int(batch["label"].iat[i]).to_bytes(8, "little", signed=True)).digest()
                    rest["scale"][i], rest["error"][i], rest["length"][i] = scale[j], error[j], length[j]
            yield out.assign(**rest)

    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), "embedding")
    # A null component becomes NaN on its way to Python, and so can't link.
    return own.mapInPandas(run, NODE)


def tiled(distinct: DataFrame, tile: int) -> DataFrame:
    """Each node once for each pair of tiles of its label that its own tile ``t`` is in; ``unit`` is the unit of work."""
    sizes = distinct.groupBy("label", "dim").agg(F.count("*").alias("rows"))
    parts = sizes.select("label", "dim", F.ceil(F.col("rows") / F.lit(tile)).cast("int").alias("parts"))
    at = distinct.join(parts, ["label", "dim"])
    bins = max(1, -(-distinct.count() // tile))
    at = at.withColumn("t", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    at = at.withColumn("u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    at = at.withColumns({"i": F.least("t", "u"), "j": F.greatest("t", "u")})
    small = F.pmod(F.xxhash64("label", "dim"), F.lit(bins))
    return at.withColumn("unit", F.when(F.col("parts") == 1, small).otherwise(F.xxhash64("label", "dim", "i", "j"))).drop("u", "parts")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows, held as float32 (float64 where a row has over EXACT components)."""
    if a.shape[1] <= EXACT:
        return a.astype(np.float32) @ b.astype(np.float32).T
    return sum((a[:, p:p + EXACT].astype(np.float32) @ b[:, p:p + EXACT].astype(np.float32).T).astype(float)
               for p in range(0, a.shape[1], EXACT))


class Side:
    """The nodes of one tile."""

    def __init__(self, rows: pd.DataFrame, wide: bool):
        dim = int(rows["dim"].iat[0])
        self.packed = np.frombuffer(b"".join(rows["packed"]), np.int8).reshape(-1, dim)
        self.unit = unit(np.frombuffer(b"".join(rows["x"]), np.float64 if wide else np.float32).reshape(-1, dim).astype(float))
        self.scale, self.error, self.length = (rows[c].to_numpy(float) for c in ("scale", "error", "length"))


def linked(a: Side, b: Side, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Linked pairs (places in a and b; each pair once), stripe by stripe, and how many pairs were recomputed."""
    for at in range(0, len(a.packed), STRIPE):
        rows = slice(at, at + STRIPE)
        near = products(a.packed[rows], b.packed) * a.scale[rows, None] * b.scale[None, :]
        near += a.length[rows, None] * b.error[None, :] + a.error[rows, None] * (b.length + b.error)[None, :]
        x, y = np.nonzero(near >= threshold - SLACK)
        x += at
        if same:
            x, y = x[x < y], y[x < y]
        keep = np.zeros(len(x), bool)
        for p in range(0, len(x), 1 << 16):
            part = slice(p, p + (1 << 16))
            keep[part] = np.einsum("ij,ij->i", a.unit[x[part]], b.unit[y[part]]) >= threshold
        yield x[keep], y[keep], len(x)


def forest(size: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each vertex of the pairs (x, y) one neighbour in a tree of its component, -1 at roots and for others.
    Trees have FAN branches and so few levels."""
    least = np.arange(size)
    while True:
        low = np.minimum(least[x], least[y])
        new = least.copy()
        np.minimum.at(new, least[x], low)
        np.minimum.at(new, least[y], low)
        new = np.minimum(new, new[new])
        if (new == least).all():
            break
        least = new
    order = np.argsort(least, kind="stable")
    root = least[order]
    start = np.searchsorted(root, root, "left")
    place = np.arange(size) - start
    parent = np.full(size, -1)
    parent[order] = np.where(place > 0, order[start + np.maximum(place - 1, 0) // FAN], -1)
    return parent


def compared(units: DataFrame, wide: bool, threshold: float) -> DataFrame:
    """``node, links, other``: links of a node found in one tile pair, and a neighbour in its component there."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, _, i, j), own in rows.groupby(["label", "dim", "i", "j"], sort=False):
            left = own[own["t"] == i]
            right = left if i == j else own[own["t"] == j]
            if not len(left) or not len(right):
                continue
            a = Side(left, wide)
            b = a if i == j else Side(right, wide)
            shift = 0 if i == j else len(left)
            names = left["node"].to_numpy() if i == j else np.r_[left["node"].to_numpy(), right["node"].to_numpy()]
            times = left["n"].to_numpy() if i == j else np.r_[left["n"].to_numpy(), right["n"].to_numpy()]
            links, parent = np.zeros(len(names), np.int64), np.full(len(names), -1)
            edges = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for x, y, _ in linked(a, b, i == j, threshold):
                y = y + shift
                np.add.at(links, x, times[y])
                np.add.at(links, y, times[x])
                # A stripe's pairs shrink to a tree at once, so a task never holds all pairs of a group.
                tree = forest(len(names), np.r_[edges[0][0], x], np.r_[edges[0][1], y])
                own_ends = np.flatnonzero(tree >= 0)
                edges, parent = [(own_ends, tree[own_ends])], tree
            at = np.flatnonzero(links)
            out.append(pd.DataFrame({"node": names[at], "links": links[at],
                                     "other": [names[p] if p >= 0 else None for p in parent[at]]}))
        return pd.concat(out) if out else pd.DataFrame(columns=["node", "links", "other"])

    return units.groupBy("unit").applyInPandas(run, "node binary, links long, other binary")


FIRST = -(1 << 63)


def named(vec_id: Column, node: Column) -> Column:
    """A vertex name whose byte order is the order of ids (null last), so that the least name of a component holds its id."""
    number = F.unhex(F.lpad(F.hex(vec_id.bitwiseXOR(F.lit(FIRST))), 16, "0"))
    return F.concat(F.when(vec_id.isNull(), F.lit(b"\1" + bytes(8))).otherwise(F.concat(F.lit(b"\0"), number)), node)


def id_of(name: Column) -> Column:
    """The id in a vertex name."""
    number = F.conv(F.hex(F.substring(name, 2, 8)), 16, 10).cast("decimal(20,0)") + F.lit(FIRST).cast("decimal(20,0)")
    return F.when(F.substring(name, 1, 1) == F.lit(b"\0"), number.cast("long"))


def components(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors`` (``vec_id, embedding, label``)."""
    wide = dict(vectors.dtypes)["embedding"] != "array<float>"
    rows = written(nodes(vectors), "vec-rows")
    distinct = rows.where("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("n"), *[F.max(c).alias(c) for c in ("label", "dim", "x", "packed", "scale", "error", "length")])
    distinct = written(distinct.withColumn("named", named(F.col("least"), F.col("node"))), "vec-nodes")
    units = tiled(distinct.drop("least", "node").withColumnRenamed("named", "node"), tile)
    found = written(compared(units, wide, threshold), "vec-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    at = distinct.select("node", "named", "n").join(links.withColumnRenamed("node", "named"), "named", "left")
    at = at.join(labels.withColumnRenamed("vertex", "named"), "named", "left")
    own = at.select("node", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                    id_of(F.coalesce("label", "named")).alias("component_id"))
    out = rows.select("vec_id", "node").join(own, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      component.eqNullSafe(F.col("vec_id")).alias("kept"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "embeddings"))
