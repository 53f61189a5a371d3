"""Language-model scoring: a log-bilinear neural model, trained with noise-contrastive estimation.

Tokens fall into classes: each of the most frequent words is one, the end of a
text is one, and all other words, known or not, are spread over rare classes by
their last two bytes. The numbers of both grow with the cube root of the training
tokens, from ``FREQUENT`` and ``RARE`` at ``LEAST`` of them. The model predicts a
token's class from the two before it: the context's vectors, each times its place's
weights, add up to a predicted vector whose products with all class vectors, plus
their biases, are normalised. Inside a rare class a word has its share of the
class's training tokens, each word and one unseen word counted once more, so token
probabilities sum to 1.

What the corpus gives is counted or trained over all training tokens. Training goes
in ``ROUNDS``: in each, tasks make noise-contrastive steps over their part of that
round's texts, starting from the same parameters, and the results are averaged by
tokens. Each token is stepped over once at least, more often where that would leave
a task fewer than ``STEPS`` steps; so the steps grow with the corpus. The driver
holds one sum of parameters for each of ``GROUPS``. Scoring works out the normaliser
of a context when it first meets it, at most (classes + 1)^2 numbers in a task.

A word's count is looked up in a broadcast of the at most ``HEAD`` most frequent
(short) words; the occurrences of all others are joined to the table of counts,
so frequent words, hot as they are, never meet in one task, and rare ones do
not have to fit anywhere.

Defined results: a null text is empty and has one token, the end; without
training text all base probabilities are 1 and classes are equally likely; rows
alike score alike, each with its own result row; an empty table gives no rows;
other columns are left out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER_BYTES, table, written
from .quality import remainder

FREQUENT, RARE = 62, 32  # at least
LEAST = 3_000_000
CLASSES = FREQUENT + 1 + RARE
END = FREQUENT
START = CLASSES  # as context only
HEAD = 100_000
LONGEST = 64  # bytes of a word in the head
DIM, STEPS, BATCH, NOISE = 24, 700, 4096, 80
ROUNDS, GROUPS, TASK, HELD = 4, 16, 1_000_000, 2_000_000
#: The end of a text in tables of words: no word holds a line break.
END_WORD = b"\n"
REMEMBERED = 300_000


def tokens(text) -> list[bytes]:
    """Words of the lower-cased text; bytes.split() parts at 0x20 and 0x09-0x0D."""
    return text.encode(errors="surrogatepass").translate(LOWER_BYTES).split() if isinstance(text, str) else []


def sizes(n_tokens: int) -> tuple[int, int]:
    """Frequent and rare classes for so many training tokens."""
    grown = max(1.0, (n_tokens / LEAST) ** (1 / 3))
    return int(FREQUENT * grown), int(RARE * grown)


class Classes(dict):
    """Class of a word; remembers some."""

    def __init__(self, frequent: list[bytes], n_frequent: int = FREQUENT, n_rare: int = RARE):
        self.frequent = {w: i for i, w in enumerate(frequent)}
        self.end, self.n_rare, self.n = n_frequent, n_rare, n_frequent + 1 + n_rare
        super().__init__(self.frequent)

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
            self.update(self.frequent)
        c = self[word] = self.frequent.get(word, self.end + 1 + zlib.crc32(word[-2:]) % self.n_rare)
        return c

    def of(self, words: list[bytes]) -> np.ndarray:
        """Classes of the tokens, after two starts."""
        return np.array([self.n, self.n, *map(self.__getitem__, words), self.end], np.int64)


def triples(c: np.ndarray, n: int) -> np.ndarray:
    """Codes of (two before, one before, token), of ``n`` classes."""
    return (c[:-2] * (n + 1) + c[1:-1]) * n + c[2:]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c`` over all ``docs``, the end of a text included."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                held.update(tokens(text))
                if len(held) > 500_000:
                    yield pd.DataFrame(held.items(), columns=["word", "n"])
                    held.clear()
            held[END_WORD] += len(batch)
        yield pd.DataFrame(held.items(), columns=["word", "n"])

    counted = docs.select("text").mapInPandas(run, "word binary, n long")
    return written(counted.groupBy("word").agg(F.sum("n").alias("c")), "lm-words")


@dataclass
class LogBilinear:
    context: np.ndarray  # a vector for each class and the start
    place: np.ndarray  # weights of the token before, and of the one before that
    target: np.ndarray
    bias: np.ndarray

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.context, self.place, self.target, self.bias

    def predicted(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.context[last] @ self.place[0] + self.context[before] @ self.place[1]

    def normaliser(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Logs of the sums over all classes, for each context."""
        out = np.empty(len(last))
        for i in range(0, len(last), 4096):
            s = self.predicted(before[i:i + 4096], last[i:i + 4096]) @ self.target.T + self.bias
            most = s.max(1)
            out[i:i + 4096] = most + np.log(np.exp(s - most[:, None]).sum(1))
        return out

    def table(self) -> np.ndarray:
        """Normalised log10 probabilities: a row for each (two before, one before)."""
        n = len(self.bias)
        before, last = np.divmod(np.arange((n + 1) ** 2), n + 1)
        s = self.predicted(before, last) @ self.target.T + self.bias
        return ((s - self.normaliser(before, last)[:, None]) / np.log(10)).astype(np.float32)


def initial(share: np.ndarray, seed: int) -> LogBilinear:
    rng = np.random.default_rng(seed)
    n = len(share)
    return LogBilinear(rng.normal(0, 0.1, (n + 1, DIM)), np.stack([np.eye(DIM), 0.5 * np.eye(DIM)]),
                       rng.normal(0, 0.1, (n, DIM)), np.log(share))


def added(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows for each index under ``n``: rows in the order of their index, summed run by run."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(at):
        order = np.argsort(at.astype(np.uint16 if n < 1 << 16 else np.int64), kind="stable")
        own = at[order]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        out[own[starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return out


class Adam:
    """Noise-contrastive steps: each triple's token against ``NOISE`` shared draws of the classes' own shares. In single
    precision, which the steps' own noise far exceeds."""

    def __init__(self, model: LogBilinear, share: np.ndarray, seed: int):
        self.p = {k: np.array(v, np.float32) for k, v in zip(("context", "place", "target", "bias"), model.arrays(), strict=True)}
        self.share, self.rng, self.step = share, np.random.default_rng(seed), 0
        self.log_noise = np.log(NOISE * share).astype(np.float32)
        self.upto = share.cumsum() / share.sum()
        self.first, self.second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))

    def take(self, code: np.ndarray, rate: float) -> None:
        p, n = self.p, len(self.share)
        self.step += 1
        w, last, before = code % n, code // n % (n + 1), code // n // (n + 1)
        noise = np.minimum(np.searchsorted(self.upto, self.rng.random(NOISE), "right"), n - 1)
        in_last, in_before = p["context"][last], p["context"][before]
        q = in_last @ p["place"][0] + in_before @ p["place"][1]
        target = p["target"][w]
        d_true = np.einsum("ij,ij->i", q, target) + p["bias"][w] - self.log_noise[w]
        d_false = q @ p["target"][noise].T
        d_false += p["bias"][noise] - self.log_noise[noise]
        part = np.float32(1 / len(code))
        d_true = (1 / (1 + np.exp(-d_true)) - 1) * part
        np.negative(d_false, out=d_false)
        np.exp(np.minimum(d_false, 80, out=d_false), out=d_false)
        d_false += 1
        np.divide(part, d_false, out=d_false)
        d_q = d_false @ p["target"][noise]
        d_q += d_true[:, None] * target
        g = {"target": added(w, d_true[:, None] * q, n), "bias": np.bincount(w, d_true, n), "context": np.zeros((n + 1, DIM)),
             "place": np.stack([in_last.T @ d_q, in_before.T @ d_q])}
        np.add.at(g["target"], noise, d_false.T @ q)
        np.add.at(g["bias"], noise, d_false.sum(0))
        for i, c in enumerate((last, before)):
            g["context"] += added(c, d_q @ p["place"][i].T, n + 1)
        for k in p:
            self.first[k] += 0.1 * (g[k].astype(np.float32) - self.first[k])
            self.second[k] += 0.001 * (g[k].astype(np.float32) ** 2 - self.second[k])
            p[k] -= np.float32(rate / (1 - 0.9 ** self.step)) * self.first[k] / (np.sqrt(self.second[k] / np.float32(1 - 0.999 ** self.step)) + np.float32(1e-8))


def fit(codes: np.ndarray, counts: np.ndarray, steps: int = STEPS, seed: int = 3) -> LogBilinear:
    """``steps`` over draws from counted triples of ``CLASSES`` classes."""
    share = np.bincount(codes % CLASSES, counts, CLASSES) + 1.0
    share /= share.sum()
    adam, upto = Adam(initial(share, seed), share, seed), counts.cumsum()
    for step in range(1, steps + 1) if len(codes) else ():
        drawn = codes[np.searchsorted(upto, adam.rng.integers(0, upto[-1], BATCH), "right")]
        adam.take(drawn, 0.02 * min(1, 2 * (1 - step / (steps + 1))))
    return LogBilinear(**{k: v.astype(float) for k, v in adam.p.items()})


def train(docs: DataFrame, frequent: list[bytes], sizes: tuple[int, int], share: np.ndarray, n_tokens: int, seed: int = 3) -> LogBilinear:
    """A model of all texts of ``docs``, by rounds of steps in tasks."""
    model = initial(share, seed)
    if not n_tokens:
        return model
    shapes = [x.shape for x in model.arrays()]
    tasks = max(1, min(docs.rdd.getNumPartitions(), n_tokens // TASK))
    passes = max(1, -(-STEPS * BATCH * tasks // n_tokens))
    docs = docs.select("text").coalesce(tasks)
    for turn in range(ROUNDS):
        sent = docs.sparkSession.sparkContext.broadcast([x.astype(np.float32) for x in model.arrays()])
        rate = 0.02 * (1 - turn / ROUNDS)

        def run(batches: Iterator[pd.DataFrame], sent=sent, rate=rate, turn=turn) -> Iterator[pd.DataFrame]:
            part = TaskContext.get().partitionId()
            classes, adam, held, n, all_n = Classes(frequent, *sizes), Adam(LogBilinear(*sent.value), share, seed + 7919 * part + turn), [], 0, 0

            def steps() -> None:
                codes = np.concatenate(held)
                for _ in range(passes):
                    adam.rng.shuffle(codes)
                    for i in range(0, len(codes), BATCH):
                        adam.take(codes[i:i + BATCH], rate)

            for batch in batches:
                for text in batch["text"]:
                    held.append(triples(classes.of(tokens(text)), classes.n))
                    n += len(held[-1])
                    if n > HELD:
                        steps()
                        held, all_n, n = [], all_n + n, 0
            if n:
                steps()
            total = np.concatenate([x.ravel() for x in adam.p.values()]).astype(float) * (all_n + n)
            yield pd.DataFrame({"g": [part % GROUPS], "n": [all_n + n], "p": [total.tobytes()]})

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            total = 0.0
            for x in rows["p"]:
                total = total + np.frombuffer(x)
            return pd.DataFrame({"n": [rows["n"].sum()], "p": [total.tobytes()]})

        own = docs.where(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == turn)
        got = own.mapInPandas(run, "g int, n long, p binary").groupBy("g").applyInPandas(add, "n long, p binary").collect()
        if n := sum(r.n for r in got):
            flat, arrays = sum(np.frombuffer(r.p) for r in got) / n, []
            for shape in shapes:
                arrays.append(flat[:np.prod(shape)].reshape(shape))
                flat = flat[np.prod(shape):]
            model = LogBilinear(*arrays)
    return model


SCORED = ("row long, doc_id long, n_tokens long, head_known long, head_log double, rare_log double, "
          "class_log double, tail array<binary>")


class Scorer:
    """Scores texts many at a time: a word is looked up once, for its class and the log of its count, and a token's
    share of the product of vectors is read from tables of class pairs."""

    def __init__(self, model: LogBilinear, classes: Classes, known: dict[bytes, int], size: np.ndarray, ends: int):
        self.classes, self.model, self.size, self.ends = classes, model, size, ends
        self.places = Places(classes, known)
        self.cls = np.array([classes[w] for w in known], np.int64)
        self.log = np.log10(np.array(list(known.values()), float) + 1)
        self.by_last, self.by_before = ((model.context @ place) @ model.target.T for place in model.place)
        self.norms = np.full((classes.n + 1) ** 2, np.nan)

    def parts(self, ids: pd.Series, texts: pd.Series, most: int = 500_000) -> Iterator[pd.DataFrame]:
        start, found, tails, held = 0, [], [], 0
        for i, text in enumerate(texts):
            own = tokens(text)
            at = np.fromiter(map(self.places.__getitem__, own), np.int64, len(own))
            tails.append([own[j] for j in np.flatnonzero(at < 0)])
            found.append(at)
            held += len(own)
            if held > most or i + 1 == len(texts):
                out = self.scored(found)
                out.insert(0, "doc_id", ids.iloc[start:i + 1].to_numpy())
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out.assign(tail=tails)
                start, found, tails, held = i + 1, [], [], 0

    def scored(self, found: list[np.ndarray]) -> pd.DataFrame:
        n, end = self.classes.n, self.classes.end
        lengths = np.array([len(x) for x in found])
        at = np.concatenate(found)
        log = np.zeros(len(at))
        in_head = at >= 0
        cls = np.where(in_head, 0, -1 - at)
        cls[in_head], log[in_head] = self.cls[at[in_head]], self.log[at[in_head]]
        # Each text after two starts, its end behind it.
        stops = (lengths + 3).cumsum()
        starts = stops - lengths - 3
        c = np.full(stops[-1], n, np.int64)
        inside = np.ones(len(c), bool)
        inside[np.r_[starts, starts + 1, stops - 1]] = False
        c[inside] = cls
        c[stops - 1] = end
        token = np.ones(len(c), bool)
        token[np.r_[starts, starts + 1]] = False
        spot = np.flatnonzero(token)
        before, last, w = c[spot - 2], c[spot - 1], c[spot]
        context = before * (n + 1) + last
        met = np.unique(context)
        new = met[np.isnan(self.norms[met])]
        self.norms[new] = self.model.normaliser(*np.divmod(new, n + 1))
        log_p = (self.by_last[last, w] + self.by_before[before, w] + self.model.bias[w] - self.norms[context]) / np.log(10) - self.size[w]
        doc = np.repeat(np.arange(len(found)), lengths)
        add = lambda x: np.bincount(doc, x, len(found))
        return pd.DataFrame({"n_tokens": lengths + 1, "head_known": add(in_head).astype(np.int64) + int(self.ends > 0),
                             "head_log": add(log) + np.log10(self.ends + 1), "rare_log": add(np.where(cls > end, log, 0.0)),
                             "class_log": np.bincount(np.repeat(np.arange(len(found)), lengths + 1), log_p, len(found))})


class Places(dict):
    """Number of a word of the head; of any other, -1 less its class."""

    def __init__(self, classes: Classes, known: dict[bytes, int]):
        super().__init__((w, i) for i, w in enumerate(known))
        self.classes = classes

    def __missing__(self, word: bytes) -> int:
        return -1 - self.classes[word]


def score(docs: DataFrame, training: DataFrame, head: int = HEAD) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs``, by a
    model of the texts of ``training``."""
    spark = docs.sparkSession
    counts = word_counts(training)
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    words = counts.where(F.col("word") != F.lit(bytearray(END_WORD)))
    n_frequent, n_rare = sizes(total.n)
    end = n_frequent
    frequent = [bytes(r.word) for r in words.where(F.length("word") <= LONGEST).orderBy(F.desc("c"), "word").limit(n_frequent).collect()]

    # Sizes of the rare classes: tokens, and words with one unseen.
    rare = words.where(~F.col("word").isin([bytearray(w) for w in frequent])) if frequent else words
    cls = (F.lit(end + 1) + F.pmod(F.crc32(F.expr("substring(word, -2, 2)")), F.lit(n_rare))).cast("int")
    held = {r.cls: r for r in rare.groupBy(cls.alias("cls")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()}
    size = np.zeros(end + 1 + n_rare)
    share = np.ones(end + 1 + n_rare)
    for c, r in held.items():
        size[c] = np.log10(r.c + r.v + 1)
        share[c] += r.c

    # The head: all words above the smallest count that leaves no more than ``head`` of them.
    short = words.where(F.length("word") <= LONGEST)
    by_count = short.groupBy("c").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy(F.desc("c")))
    least = by_count.withColumn("upto", upto).where(F.col("upto") > head).agg(F.max("c")).first()[0] or 0
    known = short.where(F.col("c") > least).toArrow()
    own = dict(zip(known["word"].to_pylist(), known["c"].to_pylist(), strict=True))
    sent = spark.sparkContext.broadcast(own)
    ends = held_end(counts)
    share[:len(frequent)] += [own.get(w, least) for w in frequent]
    share[end] += ends
    model = train(training, frequent, (n_frequent, n_rare), share / share.sum(), total.n)
    made = spark.sparkContext.broadcast((model.arrays(), frequent, size, ends))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, frequent, size, ends = made.value
        scorer = Scorer(LogBilinear(*model), Classes(frequent, n_frequent, n_rare), sent.value, size, ends)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for some in scorer.parts(batch["doc_id"].astype("Int64"), batch["text"]):
                some.insert(0, "row", np.arange(row, row + len(some)))
                row += len(some)
                yield some

    at = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, SCORED), "lm-rows")
    # A word of the tail appears with its count, or is unknown.
    tail = at.select("row", F.explode("tail").alias("word")).join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("tail_log"), F.count("c").alias("tail_known"))
    out = at.drop("tail").join(tail, "row", "left")
    extra = F.coalesce("tail_log", F.lit(0.0))
    base = F.col("head_log") + extra - F.col("n_tokens") * F.lit(float(np.log10(total.n + total.v + 1)))
    return out.select("doc_id", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
                      F.lit(total.n).cast("long").alias("train_tokens"), base.alias("base_score"),
                      (F.col("class_log") + F.col("rare_log") + extra).alias("score"))


def held_end(counts: DataFrame) -> int:
    """How many texts were counted."""
    found = counts.where(F.col("word") == F.lit(bytearray(END_WORD))).first()
    return found.c if found else 0


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out_of = remainder(F.col("doc_id"), 7) == 2
    scored = score(docs, docs.where(~out_of))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")
