"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of the whole text are Spark column expressions. Small trees, each
grown on what the earlier ones leave unexplained, are read as rules: every path
from the root to a node is a conjunction of comparisons. A lasso-penalised
logistic regression over the rules keeps few of them, and these are compiled
back to one Spark column expression, so scoring is one pass of built-in
functions without Python.

Only the fit sees a sample: labelled rows are drawn by a hash of their id so
that about ``ROWS`` are expected however many there are, and their statistics
(not texts) come to the driver. The drawn labels, at most that many short rows,
are broadcast to the documents.

Defined results: a null or empty text has all statistics 0 and is scored like
any other; labels that are null, or whose document is missing, are left out; with
no labelled row every score is 1, with labels of one kind every score is that
kind's share (counting one of each kind more); rows alike score alike; an empty
table gives no rows; other columns pass through ``scored``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, table

ROWS = 24_000
TREES = 24
DEPTH = 3
BINS = 24
LEAF = 20
PENALTY = 1e-3
KEEP = 0.7

STATISTICS = ["chars", "words", "word_length", "distinct_words", "repeats", "capitals", "bangs", "symbols", "bars",
              "numbers", "stops", "distinct_lines", "line_words"]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``stat`` of STATISTICS, all doubles and finite."""
    t = F.coalesce(F.col(text), F.lit(""))
    count = lambda pattern: F.regexp_count(t, F.lit(pattern))
    at = docs.withColumn("_words", F.regexp_extract_all(t, F.lit(f"({WORD})")))
    at = at.withColumn("_lines", F.filter(F.split(t, "\n"), lambda x: F.length(x) > 0))
    words, lines = F.col("_words"), F.col("_lines")
    n, n_words, n_lines = F.length(t), F.size(words), F.size(lines)
    per = lambda a, b: a / F.greatest(b, F.lit(1))
    again = F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1)))
    made = {
        "chars": n, "words": n_words, "word_length": per(n, n_words),
        "distinct_words": per(F.size(F.array_distinct(words)), n_words), "repeats": per(again, n_words),
        "capitals": per(count(r"\p{Lu}{3,}"), n_words), "bangs": per(count("!"), n_words),
        "symbols": per(count(r"[#$%&*^~<>{}=@\\]"), n_words), "bars": per(count(r"\|"), n_words),
        "numbers": per(count("[0-9]+"), n_words), "stops": per(count(r"[.,;:?]"), n_words),
        "distinct_lines": per(F.size(F.array_distinct(lines)), n_lines), "line_words": per(n_words, n_lines),
    }
    stat = F.struct(*[made[name].cast("double").alias(name) for name in STATISTICS])
    return at.withColumn("stat", stat).drop("_words", "_lines")


def remainder(doc_id: Column, of: int) -> Column:
    """crc32(doc_id as text) modulo ``of``; a null id is the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(of))


@dataclass(frozen=True)
class Rule:
    """All of ``terms`` hold: (statistic, True if it is above, threshold)."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for f, above, at in self.terms:
            out &= (x[:, f] > at) == above
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for f, above, at in self.terms:
            c = F.col("stat")[STATISTICS[f]]
            out &= (c > F.lit(at)) if above else (c <= F.lit(at))
        return out


def grow(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], terms=(), depth: int = DEPTH) -> tuple[list[Rule], np.ndarray]:
    """Rules of a regression tree on ``y`` and its fitted values."""
    fitted = np.full(len(y), y.mean() if len(y) else 0.0)
    if depth == 0 or len(y) < 2 * LEAF:
        return [], fitted
    best, split = 1e-9, None
    total, n = y.sum(), len(y)
    for f, at in enumerate(cuts):
        if len(at):
            where = np.searchsorted(at, x[:, f])  # x <= at[k] where the place is at most k
            left_n = np.bincount(where, minlength=len(at) + 1).cumsum()[:-1]
            left = np.bincount(where, weights=y, minlength=len(at) + 1).cumsum()[:-1]
            ok = (left_n >= LEAF) & (n - left_n >= LEAF)
            gain = np.where(ok, left ** 2 / np.maximum(left_n, 1) + (total - left) ** 2 / np.maximum(n - left_n, 1), -np.inf) - total ** 2 / n
            k = int(gain.argmax())
            if gain[k] > best:
                best, split = gain[k], (f, float(at[k]))
    if split is None:
        return [], fitted
    f, at = split
    rules = []
    for above in (False, True):
        side = (x[:, f] > at) == above
        more = (*terms, (f, above, at))
        deeper, fitted[side] = grow(x[side], y[side], cuts, more, depth - 1)
        rules += [Rule(more), *deeper]
    return rules, fitted


def lasso(r: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1-penalised logistic regression, by accelerated proximal steps."""
    n, k = r.shape
    if not k:
        return float(np.log((y.sum() + 1) / (n - y.sum() + 1))), np.zeros(0)
    v = np.ones(k) / np.sqrt(k)
    for _ in range(20):  # the largest curvature
        v = r.T @ (r @ v)
        v /= np.linalg.norm(v) + 1e-12
    rate = 4 * n / (np.linalg.norm(r @ v) ** 2 + n)
    w, b = np.zeros(k), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    u, c, t = w, b, 1.0
    for _ in range(steps):
        g = 1 / (1 + np.exp(-(r @ u + c))) - y
        new = u - rate * (r.T @ g) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_b = c - rate * g.mean()
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        u, c = new + (last - 1) / t * (new - w), new_b + (last - 1) / t * (new_b - b)
        w, b = new, new_b
    return b, w


@dataclass(frozen=True)
class Model:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.intercept + sum((w * rule.holds(x) for rule, w in self.rules), np.zeros(len(x)))

    def column(self) -> Column:
        """The score, from the struct ``stat``."""
        out = F.lit(self.intercept)
        for rule, weight in self.rules:
            out += F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, seed: int = 5) -> Model:
    if not len(y):
        return Model(40.0, ())
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if y.min() == y.max():
        return Model(prior, ())
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    # Rare values, such as a share that is 0 nearly everywhere, get cuts of their own.
    cuts = [np.unique(np.r_[c, np.quantile(v[v > c.min()], np.linspace(0, 1, BINS + 1)[:-1])] if (v > c.min()).any() else c)
            for c, v in zip(cuts, x.T, strict=True)]
    rng, found, at = np.random.default_rng(seed), {}, np.full(len(y), prior)
    for _ in range(trees):
        part = rng.random(len(y)) < 0.5
        residual = y - 1 / (1 + np.exp(-at))
        rules, _ = grow(x[part], residual[part], cuts)
        found |= dict.fromkeys(rules)
        fitted = np.zeros(len(y))
        leaves = [a for a in rules if not any(b.terms[:len(a.terms)] == a.terms and b != a for b in rules)]
        for rule in leaves:
            held = rule.holds(x)
            own = held & part
            p = 1 / (1 + np.exp(-at[own]))
            fitted[held] = residual[own].sum() / (np.sum(p * (1 - p)) + 1e-3) if own.any() else 0.0
        at = at + 0.3 * np.clip(fitted, -4, 4)
    rules = list(found)
    b, w = lasso(np.stack([rule.holds(x) for rule in rules], 1).astype(float) if rules else np.zeros((len(y), 0)), y)
    return Model(float(b), tuple((rule, float(v)) for rule, v in zip(rules, w, strict=True) if abs(v) > 1e-6))


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model:
    """Fits ``labels.quality`` (0 or 1) on about ``rows`` labelled documents, held-out ones left out."""
    usable = labels.select("doc_id", F.col("quality").cast("double").alias("quality")).where(
        F.col("quality").isin(0.0, 1.0) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 4) != 2))
    share = min(1.0, rows / max(1, usable.count()))
    drawn = usable.where(F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    known = with_statistics(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id"))
    at = known.select("doc_id", "quality", "stat.*").toArrow().to_pandas().sort_values(["doc_id", "quality", *STATISTICS])
    return fit(at[STATISTICS].to_numpy(float), at["quality"].to_numpy(float))


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the score as column ``name``."""
    names = docs.columns
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").alias("_text"))
    out = with_statistics(kept, "_text").withColumn("_score", model.column())
    return out.select(*[F.col("row")[c].alias(c) for c in names if c != name], F.col("_score").alias(name))


def accepted(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that score at least ``keep``.

    A row is chosen by a generator, as a filter on the score would be pushed below the
    statistics and bring each of them in anew wherever a rule mentions it."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("_text"))
    rows = with_statistics(rows, "_text").withColumn("_score", model.column())
    kept = rows.select(F.explode(F.when(F.col("_score") >= keep, F.array("row"))).alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= KEEP, 1).otherwise(0).alias("predicted"))
