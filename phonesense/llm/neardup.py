"""Near-duplicate detection with SetSketch registers.

A document's distinct word shingles are sketched in one pass: register i holds
the truncated, exponentially spaced minimum floor(1 - log_b(x_i / A)) of
exponential hash values x_i over the shingles. Registers of a union are the
larger of the two, and two documents agree in a register with about the chance
of their similarity, so bands of registers are the keys of a candidate search.

Texts with the same words are one node. In each bucket the nodes meet the
bucket's least node (one row a member, never all pairs); pairs whose similarity,
estimated jointly by likelihood from the registers and set sizes, could reach
the threshold are confirmed on the full sets. Confirmed links are joined to
components. Where a bucket still holds several components, the members outside
its largest one are held against all its members by their registers, in chunks
of bounded size inside Python tasks, several small buckets to a task. First the
likeliest few partners of each are confirmed and joined; then all that is left
is settled at once: members that have any partner by their registers bring their
texts, and a task finds the links of a chunk with an index from shingles to
members. Only links come out, one for each member and component, so no link
that shares a band is lost, nothing is capped, and no group's pairs are emitted.
With BANDS x BAND_ROWS registers a pair at 0.8 shares no band with a chance of
(1 - 0.8^4)^24 = 3e-6.

Hot groups: copies collapse to nodes by a partial aggregate, buckets are joined
with narrow rows (skew-split by adaptive execution), and no bucket is collected
whole. Every step is written to the shared folder, so a lost executor costs
tasks of one step.

Defined results: null texts and texts without words have no shingles, link with
nothing, not even each other, and are their own component; a text with fewer
words than a shingle is one shingle, its whole sequence. Rows alike are copies.
A null doc_id never names a component that has another id; extra columns are
left out of ``components`` and kept by ``one_of_each``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_BYTES, table, written

BANDS, BAND_ROWS = 24, 4
REGISTERS = BANDS * BAND_ROWS
#: Base and offset of the register scale, and the largest register.
BASE, OFFSET, TOP = 1.02, 64.0, 4095
THRESHOLD = (80, 100)
#: A pair is confirmed if its estimate is no more than 0.2 below the threshold: about five
#: standard deviations of the estimate at 0.8.
LEAST = THRESHOLD[0] / THRESHOLD[1] - 0.2
CHUNK = 1000
#: A node is hot if it stands for over 1 in HOT of all rows.
HOT = 1024
#: How many of a straggler's likeliest partners in a chunk are confirmed one by one before all are settled.
TAKE = 4
BIN_BYTES = 8 << 20
#: How many bytes of texts each side of a chunk brings to a task.
PART_BYTES = 8 << 20
SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
PIECE = 1 << 20

_seeded = np.random.default_rng(20)
_odd = lambda n: _seeded.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE, STEP, PLACE, TIMES, PLUS = _odd(256), _odd(1)[0], _odd(64), _odd(REGISTERS), _odd(REGISTERS)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of lower-cased UTF-8 text, in order; long texts a piece at a time."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and not SPACE[data[end]]:
            end = min(len(data), end + 1)
        b = np.frombuffer(data, np.uint8, end - at, at)
        word = ~SPACE[b]
        edge = np.flatnonzero(np.diff(np.r_[False, word, False]))
        starts, lengths = edge[::2], edge[1::2] - edge[::2]
        if len(starts):
            first = np.r_[0, lengths.cumsum()[:-1]]
            spot = np.arange(lengths.sum()) - np.repeat(first, lengths)
            steps = np.multiply.accumulate(np.r_[np.uint64(1), np.full(int(lengths.max()) - 1, STEP, np.uint64)])
            h = np.add.reduceat(BYTE[b[word]] * steps[spot], first)
            out.append(mixed(h + lengths.astype(np.uint64)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the word k-shingles; of fewer words, of the whole sequence."""
    w = word_hashes((text or "").encode(errors="surrogatepass").translate(LOWER_BYTES))
    if not len(w):
        return w
    size = min(k, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for i in range(size):
        h += w[i:len(w) - size + 1 + i] * PLACE[i]
    return np.unique(mixed(h))


def registers(s: np.ndarray) -> np.ndarray:
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 2048):
        least = np.minimum(least, (s[at:at + 2048, None] * TIMES + PLUS).min(0))
    x = -np.log1p(-np.minimum((least.astype(float) + 0.5) / 2.0 ** 64, 1 - 1e-16))
    return np.clip(np.floor(1 - np.log(x / OFFSET) / np.log(BASE)), 0, TOP).astype(np.uint16)


def band_keys(r: np.ndarray) -> np.ndarray:
    rows = r.reshape(BANDS, BAND_ROWS).astype(np.uint64)
    h = np.arange(BANDS, dtype=np.uint64)
    for i in range(BAND_ROWS):
        h = mixed(h * PLACE[i] + rows[:, i] + np.uint64(1))
    return h.view(np.int64)


def similarity(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The Jaccard similarity of greatest likelihood, given in how many registers a's is above and
    below b's, and the set sizes; by ternary search, as the likelihood is concave."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    chance = lambda x: -np.log(np.maximum(1 - x * (BASE - 1) / BASE, 1e-300)) / np.log(BASE)

    def likelihood(j):
        p, q = chance(np.maximum(u - v * j, 0)), chance(np.maximum(v - u * j, 0))
        log = lambda x: np.log(np.maximum(x, 1e-300))
        return above * log(p) + below * log(q) + (REGISTERS - above - below) * log(1 - p - q)

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        left = likelihood(a) > likelihood(b)
        low, high = np.where(left, low, a), np.where(left, b, high)
    return (low + high) / 2


def likely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    return similarity((a > b).sum(-1).astype(float), (a < b).sum(-1).astype(float), n_a.astype(float), n_b.astype(float))


def unpacked(regs) -> np.ndarray:
    return np.frombuffer(b"".join(regs), np.uint16).reshape(-1, REGISTERS)


SKETCH = "doc_id long, content string, node binary, n int, regs binary, keys array<long>"


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """One row for each row of ``docs``; ``node`` names the sequence of words, null without any."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                w = text.encode(errors="surrogatepass").translate(LOWER_BYTES).split() if isinstance(text, str) else []
                if w:
                    s = shingles(text, k)
                    r = registers(s)
                    rows.append((hashlib.blake2b(b" ".join(w), digest_size=16).digest(), len(s), r.tobytes(), band_keys(r)))
                else:
                    rows.append((None, 0, None, None))
            out = pd.DataFrame(rows, columns=["node", "n", "regs", "keys"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            out["doc_id"] = out["doc_id"].astype("Int64")
            out.insert(1, "content", batch["content"].to_numpy())
            yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("content"),
                       "text").mapInPandas(run, SKETCH)


def connected(edges: DataFrame) -> DataFrame:
    """``vertex, label`` of the vertices of ``edges`` (a, b): the least vertex of each component, by
    passing on least labels and following labels' labels until nothing changes."""
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = written(both, "dup-edges")
    labels = written(both.groupBy(F.col("a").alias("vertex")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "dup-labels")
    while True:
        heard = both.join(labels.withColumnRenamed("vertex", "b"), "b").groupBy(F.col("a").alias("vertex")).agg(
            F.min("label").alias("heard"))
        far = labels.select(F.col("vertex").alias("label"), F.col("label").alias("far"))
        new = labels.join(heard, "vertex").join(far, "label", "left")
        new = new.select("vertex", F.least("label", "heard", "far").alias("new"), "label")
        new = written(new, "dup-labels")
        changed = new.where("new < label").limit(1).count()
        labels = new.select("vertex", F.col("new").alias("label"))
        if not changed:
            return labels


def confirmed(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """``a, b, linked`` for each pair, from the full sets of both texts."""
    part, whole = THRESHOLD

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets: dict[bytes, np.ndarray] = {}

            def of(node, text):
                if node not in sets:
                    if len(sets) >= 64:
                        sets.clear()
                    sets[node] = shingles(text, k)
                return sets[node]

            linked = []
            for a, b, x, y in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"], strict=True):
                s, t = of(b, y), of(a, x)
                both = len(np.intersect1d(s, t, assume_unique=True))
                linked.append(whole * both >= part * (len(s) + len(t) - both))
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "linked": linked})

    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"))
    at = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return written(at.mapInPandas(run, "a binary, b binary, linked boolean"), "dup-confirmed")


def hopeful(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs that the set sizes and registers do not rule out."""

    @F.pandas_udf("double")
    def estimate(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        return pd.Series(likely(unpacked(a), unpacked(b), n_a.to_numpy(), n_b.to_numpy()) if len(a) else np.zeros(0))

    side = lambda x: nodes.select(F.col("node").alias(x), F.col("regs").alias(f"regs_{x}"), F.col("n").alias(f"n_{x}"))
    at = pairs.join(side("a"), "a").join(side("b"), "b")
    fit = F.least("n_a", "n_b") * THRESHOLD[1] >= F.greatest("n_a", "n_b") * THRESHOLD[0]
    return at.where(fit).where(estimate("regs_a", "regs_b", "n_a", "n_b") >= LEAST).select("a", "b")


def segments(names: pd.DataFrame, others: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the rows of both frames that are of one bucket chunk (``key, p, q``), chunk by chunk."""
    key = lambda x: pd.MultiIndex.from_frame(x[["key", "p", "q"]])
    at, chunks = pd.factorize(key(others))
    of = chunks.get_indexer(key(names))
    grouped = lambda g: (o := np.argsort(g, kind="stable"), np.searchsorted(g[o], np.arange(len(chunks) + 1)))
    (order, ends), (own, own_ends) = grouped(at), grouped(of)
    for g in np.unique(of[of >= 0]):
        yield own[own_ends[g]:own_ends[g + 1]], order[ends[g]:ends[g + 1]]


def near_pairs(left: pd.DataFrame, right: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of rows of ``left`` and ``right`` that are of one bucket chunk and different
    components and that the set sizes and registers do not rule out, with the estimates."""
    comp = {x: i for i, x in enumerate(pd.unique(pd.concat([left["comp"], right["comp"]])))}
    c_left, c_right = left["comp"].map(comp).to_numpy(), right["comp"].map(comp).to_numpy()
    r_left, r_right = unpacked(left["regs"]), unpacked(right["regs"])
    n_left, n_right = left["size"].to_numpy(), right["size"].to_numpy()
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for a, b in segments(left, right):
        for i in range(0, len(a), 64):
            block = a[i:i + 64]
            alike = (r_left[block][:, None, :] == r_right[b][None, :, :]).sum(-1) >= REGISTERS // 4
            x, y = np.nonzero(alike & (c_left[block][:, None] != c_right[b][None, :]))
            x, y = block[x], b[y]
            fit = np.minimum(n_left[x], n_right[y]) * THRESHOLD[1] >= np.maximum(n_left[x], n_right[y]) * THRESHOLD[0]
            found.append((x[fit], y[fit], np.zeros(fit.sum())))
    i, k, j = (np.concatenate(x) for x in zip(*found, strict=True))
    for x in range(0, len(i), 20_000):
        own, other = i[x:x + 20_000], k[x:x + 20_000]
        j[x:x + 20_000] = likely(r_left[own], r_right[other], n_left[own], n_right[other])
    ok = j >= LEAST
    return i[ok], k[ok], j[ok]


def dealt(members: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members of unsettled buckets: those outside a bucket's largest component, and all; each
    with a chunk ``key, p, q`` in which they meet, several chunks to a ``bin``."""
    sizes = members.groupBy("key", "comp").agg(F.count("*").alias("n"))
    buckets = sizes.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count("*").alias("comps"),
                                       F.sum("n").alias("all"), F.max("n").alias("most")).where("comps > 1")
    regs = nodes.select("node", "regs", F.col("n").alias("size"))
    at = written(members.join(buckets, "key").join(regs, "node"), "dup-unsettled")
    bins = max(1, -(-at.count() // CHUNK))
    parts = lambda n: F.ceil(n / F.lit(CHUNK)).cast("int")
    few, many = parts(F.col("all") - F.col("most")), parts(F.col("all"))
    spot = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    cols = [F.pmod(F.xxhash64("key", "p", "q"), F.lit(bins)).alias("bin"), "key", "p", "q", "node", "comp", "regs", "size"]
    lone = at.where(F.col("comp") != F.col("main")).withColumn("p", spot(few)).withColumn("q", each(many)).select(*cols)
    rest = at.withColumn("q", spot(many)).withColumn("p", each(few)).select(*cols)
    return lone, rest.toDF(*rest.columns)  # columns of its own, as both sides come from the same rows


def stragglers(members: DataFrame, nodes: DataFrame, take: int = TAKE) -> DataFrame:
    """``a, b``: for each member outside its bucket's largest component its ``take`` likeliest
    partners in each chunk."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame(columns=["a", "b"])
        i, k, j = near_pairs(left, right)
        found = pd.DataFrame({"x": left["node"].to_numpy()[i], "y": right["node"].to_numpy()[k], "j": j})
        found = found.drop_duplicates(["x", "y"]).sort_values(["x", "j", "y"], ascending=[True, False, True])
        found = found[found.groupby("x").cumcount() < take]
        first = found["x"] < found["y"]
        return pd.DataFrame({"a": found["x"].where(first, found["y"]), "b": found["y"].where(first, found["x"])})

    lone, rest = dealt(members, nodes)
    found = lone.groupBy("bin").cogroup(rest.groupBy("bin")).applyInPandas(run, "a binary, b binary")
    return written(found.distinct(), "dup-stragglers")


def by_bytes(hopes: DataFrame, texts: DataFrame) -> DataFrame:
    """``hopes`` in chunks of about PART_BYTES of texts a side at most (or one text), with ``bytes``.
    A chunk of more is split by both sides, and each part of one side meets each of the other. Only
    names and lengths are moved; the texts are fetched afterwards."""
    lengths = texts.select("node", (F.octet_length("text") + 64).cast("long").alias("bytes"))
    at = written(hopes.join(lengths, "node"), "dup-hopes")
    sums = at.groupBy("key", "p", "q").agg(F.sum(F.when(F.col("lone"), F.col("bytes"))).alias("own"),
                                           F.sum(F.when(~F.col("lone"), F.col("bytes"))).alias("other"))
    parts = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / F.lit(PART_BYTES))).cast("int")
    at = at.join(sums.select("key", "p", "q", parts("own").alias("few"), parts("other").alias("many")), ["key", "p", "q"])
    spot = lambda n: F.array(F.pmod(F.xxhash64("node"), F.col(n)).cast("int"))
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    side = lambda n, own: F.when(own, spot(n)).otherwise(each(n))
    at = at.withColumn("x", F.explode(side("few", F.col("lone")))).withColumn("y", F.explode(side("many", ~F.col("lone"))))
    # Parts whose keys happen to collide only meet for nothing: a link is confirmed on the full sets.
    return at.select(F.xxhash64("key", "p", "q").alias("key"), F.col("x").alias("p"), F.col("y").alias("q"),
                     "node", "comp", "lone", "bytes")


def settled(members: DataFrame, nodes: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """``a, b``: links between members of different components of a bucket, one at least for every
    two components that have any. Members that have a partner by their registers bring
    their texts; a task finds the links of a chunk with an index from shingles to members, so
    no pair is emitted that is not a link, and one for each member and component."""
    part, whole = THRESHOLD
    kept = "key long, p int, q int, node binary, comp binary, lone boolean"

    def hopeful_rows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["key", "p", "q", "node", "comp"]
        if not len(left) or not len(right):
            return pd.DataFrame(columns=[*names, "lone"])
        i, k, _ = near_pairs(left, right)
        return pd.concat([left.iloc[np.unique(i)][names].assign(lone=True), right.iloc[np.unique(k)][names].assign(lone=False)])

    lone, rest = dealt(members, nodes)
    hopes = lone.groupBy("bin").cogroup(rest.groupBy("bin")).applyInPandas(hopeful_rows, kept)
    hopes = written(by_bytes(hopes, texts), "dup-hopes")
    size = hopes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    bins = max(1, -(-size // BIN_BYTES))

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        out: dict[tuple, tuple] = {}  # a link for each member and component
        sets: dict[bytes, np.ndarray] = {}
        for node, text in zip(rows["node"], rows["text"], strict=True):
            if node not in sets:
                sets[node] = shingles(text, k)
        left, right = rows[rows["lone"]], rows[~rows["lone"]]
        names, comps = right["node"].to_numpy(), right["comp"].to_numpy()
        for a, b in segments(left, right):
            size = np.array([len(sets[n]) for n in names[b]])
            every = np.concatenate([sets[n] for n in names[b]])
            order = np.argsort(every, kind="stable")
            every, of = every[order], np.repeat(np.arange(len(b)), size)[order]
            for node, comp in zip(left["node"].to_numpy()[a], left["comp"].to_numpy()[a], strict=True):
                own = sets[node]
                low, high = np.searchsorted(every, own, "left"), np.searchsorted(every, own, "right")
                n = high - low
                spots = np.repeat(low - np.r_[0, n.cumsum()[:-1]], n) + np.arange(n.sum())
                both = np.bincount(of[spots], minlength=len(b))
                for i in np.flatnonzero(whole * both >= part * (len(own) + size - both)):
                    if comps[b[i]] != comp:
                        out[node, comps[b[i]]] = tuple(sorted((node, names[b[i]])))
        return pd.DataFrame(list(out.values()), columns=["a", "b"])

    at = hopes.withColumn("bin", F.pmod(F.xxhash64("key", "p", "q"), F.lit(bins))).join(texts, "node")
    return written(at.groupBy("bin").applyInPandas(links, "a binary, b binary").distinct(), "dup-links")


def relabelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with ``comp`` replaced by its component under ``labels``."""
    at = members.join(labels.withColumnRenamed("vertex", "comp"), "comp", "left")
    return at.withColumn("comp", F.coalesce("label", "comp")).drop("label")


def grouped(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The sketched rows of ``docs``, and ``node, doc_id, content, copies, component_id`` of each distinct sequence of words."""
    rows = written(sketch(docs, k), "dup-sketches")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")).alias("own"),
        F.count("*").alias("copies"), F.max("n").alias("n"), F.max("regs").alias("regs"), F.max("keys").alias("keys"))
    nodes = written(nodes.select("node", "own.doc_id", "own.content", "copies", "n", "regs", "keys"), "dup-nodes")

    bands = nodes.select("node", F.explode("keys").alias("key"))
    hubs = bands.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = written(bands.join(hubs, "key"), "dup-members")
    needed = members.select("node").distinct().join(nodes.select("node", "doc_id", "content"), "node")
    own = docs.select(F.col("doc_id").cast("long").alias("id"), F.md5(F.col("text").cast("binary")).alias("md5"), "text")
    texts = needed.join(own, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("content") == F.col("md5")))
    texts = written(texts.select("node", "text").dropDuplicates(["node"]), "dup-texts")

    stars = members.where("node != hub").select(F.col("node").alias("b"), F.col("hub").alias("a")).distinct()
    checked = confirmed(written(hopeful(stars, nodes), "dup-stars"), texts, k)
    labels = nodes.select("node", F.col("node").alias("comp"))
    found = connected(checked.where("linked"))
    labels = relabelled(labels, found)
    members = written(relabelled(members.select("key", "node", F.col("node").alias("comp")), found), "dup-members")
    for links in (lambda: confirmed(stragglers(members, nodes), texts, k).where("linked"),
                  lambda: settled(members, nodes, texts, k)):
        comp = labels.select(F.col("node"), "comp")
        edges = links().join(comp.toDF("a", "ca"), "a").join(comp.toDF("b", "cb"), "b").where("ca != cb")
        edges = written(edges.select(F.col("ca").alias("a"), F.col("cb").alias("b")), "dup-edges")
        if edges.limit(1).count():
            found = connected(edges)
            labels = written(relabelled(labels, found), "dup-comps")
            members = written(relabelled(members, found), "dup-members")

    ids = labels.join(nodes.select("node", "doc_id", "content", "copies"), "node")
    names = ids.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return rows, ids.join(names, "comp").drop("comp")


def components(docs: DataFrame, k: int = 5) -> DataFrame:
    """``doc_id, content, node, n_shingles, component_id, kept`` for each row of ``docs``.

    Nodes with over 1 in HOT of all rows (fewer than HOT of them) find their rows by broadcast, so
    the rows of a text with very many copies stay where they are; all others are joined by node."""
    rows, ids = grouped(docs, k)
    ids = written(ids.select("node", "component_id", "copies"), "dup-ids")
    least = rows.count() // HOT
    hot, rest = ids.where(F.col("copies") > least), ids.where(F.col("copies") <= least)
    own = rows.select("doc_id", "content", "node", F.col("n").cast("long").alias("n_shingles"))
    found = own.join(F.broadcast(hot.select("node", "component_id", F.lit(True).alias("hot"))), "node", "left")
    others = own.join(F.broadcast(hot.select("node")), "node", "left_anti").where("node is not null")
    out = found.where("hot or node is null").drop("hot").unionByName(others.join(rest.drop("copies"), "node"))
    named = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "content", "node", "n_shingles", named.alias("component_id"),
                      named.eqNullSafe(F.col("doc_id")).alias("kept"))


def one_of_each(docs: DataFrame, k: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, all columns kept. Rows without
    words are no copies of anything and stay; of rows alike in doc_id and words one stays."""
    rows, ids = grouped(docs, k)
    wordless = rows.where("node is null").select("doc_id", "content", "node").distinct()
    # A component's row is that of its least id; of several nodes with that id each has a row that stays.
    worded = ids.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "content", "node")
    stay = worded.unionByName(wordless).toDF("_id", "_content", "_node")
    names = docs.columns
    at = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").cast("long").alias("_doc"),
                     F.md5(F.col("text").cast("binary")).alias("_md5"))
    at = at.join(stay, F.col("_doc").eqNullSafe(F.col("_id")) & F.col("_md5").eqNullSafe(F.col("_content")))
    worded = at.where("_node is not null").dropDuplicates(["_id", "_node"])
    return at.where("_node is null").unionByName(worded).select(*[F.col("row")[c].alias(c) for c in names])


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents"), k=4).select("doc_id", "n_shingles", "component_id", "kept")
