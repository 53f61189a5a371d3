import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from phonesense.llm import lm, quality

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(doc_id, of):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % of


def test_rules_and_columns_agree(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["a", "the", "WORD!!", "x#$%", "7", "line.\n"], int(rng.integers(0, 60)))) for _ in range(400)] + [None, "", "z" * 10000]
    docs = spark.createDataFrame([(i, t, 1, "x", 0.5) for i, t in enumerate(texts)], "doc_id long, text string, words int, stat string, score double")
    at = quality.with_statistics(docs.select("doc_id", "text")).select("doc_id", "stat.*").toPandas().sort_values("doc_id")
    x = at[quality.STATISTICS].to_numpy(float)
    assert np.isfinite(x).all()
    y = (x[:, quality.STATISTICS.index("bangs")] > 0.1).astype(float)
    model = quality.fit(x, y)
    assert 0 < len(model.rules) < 60  # sparse
    want = 1 / (1 + np.exp(-model.logit(x)))
    out = quality.scored(docs, model).collect()
    got = {r.doc_id: r.score for r in out}
    assert [got[i] for i in range(len(texts))] == pytest.approx(want.tolist(), abs=1e-12)
    assert ((want > 0.5) == (y > 0.5)).mean() > 0.97
    assert quality.scored(docs, model, "_s").columns == [*docs.columns, "_s"]


def test_statistics_of_a_text(spark):
    docs = spark.createDataFrame([("One one two TWOS!! 12\n\na | b\na | b",)], "text string")
    s = quality.with_statistics(docs).first().stat
    n = 11  # One one two TWOS!! 12 a | b a | b
    assert (s.chars, s.words, s.bangs, s.bars, s.numbers) == (34, n, 2 / n, 2 / n, 1 / n)
    assert (s.distinct_words, s.repeats, s.capitals, s.distinct_lines, s.line_words) == (8 / n, 0, 1 / n, 2 / 3, n / 3)


@pytest.mark.parametrize("labels, score", [([], 1.0), ([(1, 1), (2, 1)], 3 / 4), ([(1, 0), (2, 0)], 1 / 4), ([(1, None), (None, 1), (99, 1)], 1.0)])
def test_little_to_learn_from(spark, labels, score):
    ids = [i for i in range(1, 40) if crc_mod(i, 4) != 2]
    labels = [(ids[i - 1] if i in (1, 2) else i, q) for i, q in labels]
    docs = spark.createDataFrame([(i, "some text here") for i in ids], "doc_id long, text string")
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert {round(r.score, 9) for r in quality.scored(docs, model).collect()} == {round(score, 9)}


def test_quality_query(spark):
    out = quality.op6_quality(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert Counter(r.doc_id for r in out) == Counter(docs.keys())
    assert all(r.held_out == (crc_mod(r.doc_id, 4) == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    got = {r.doc_id: r for r in out}
    held = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality is not None and got[r.doc_id].held_out]
    assert len(held) > 60 and sum(r.predicted == q for r, q in held) >= 0.95 * len(held)


def saved(spark, rows, path):
    spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, row int, score double").repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def brute_lm(rows):
    words = lambda t: [w for w in re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))]
    count, out = Counter(), []
    for d, t in rows:
        if crc_mod(d, 7) != 2:
            count.update([*words(t), None])
    n, v = sum(count.values()), len(count)
    for d, t in rows:
        own = [*words(t), None]
        out.append((d is None, d or 0, crc_mod(d, 7) == 2, len(own), sum(count[w] > 0 for w in own), n,
                    round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), 6)))
    return sorted(out)


def corpus(n=400):
    rng = np.random.default_rng(6)
    a, b = [f"un{i}" for i in range(150)], [f"DEUX{i}é" for i in range(150)]
    rows = []
    for i in range(n):
        pool = (a, b)[i % 2]
        rows.append((i, " ".join(pool[int(x) % 150] for x in rng.zipf(1.3, int(rng.integers(0, 80))))))
    rows += [(n, None), (n + 1, ""), (n + 2, "never seen before x \x1c y"), (None, "no id"), (n + 3, "q" * 5000), rows[4], rows[4]]
    return rows


@pytest.mark.parametrize("head", [lm.HEAD, 40])
def test_lm_base(spark, tmp_path, monkeypatch, head):
    monkeypatch.setattr(lm.score, "__defaults__", (head,))
    rows = corpus()
    out = lm.op7_lm_score(spark, saved(spark, rows, tmp_path)).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    assert [g[:-1] for g in got] == [w[:-1] for w in brute_lm(rows)]
    assert [g[-1] for g in got] == pytest.approx([w[-1] for w in brute_lm(rows)], abs=1e-5)
    held = [r for r in out if r.held_out and r.n_tokens > 10]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # two languages: context tells


def test_lm_is_normalised():
    """Class probabilities sum to 1 in every context, and so do a rare class's words."""
    rng = np.random.default_rng(0)
    codes = np.unique(rng.integers(0, (lm.CLASSES + 1) ** 2 * lm.CLASSES, 5000))
    model = lm.fit(codes, rng.integers(1, 50, len(codes)), steps=30)
    assert np.allclose((10.0 ** model.table().astype(float)).sum(1), 1, atol=1e-4)


def test_training_fits_contexts():
    """A class that always follows another is learnt."""
    before = np.arange(lm.CLASSES)
    follow = (before * 7 + 3) % lm.CLASSES
    codes = np.sort((np.full(lm.CLASSES, 5) * (lm.CLASSES + 1) + before) * lm.CLASSES + follow)
    table = lm.fit(codes, np.full(len(codes), 100), steps=600).table()
    picked = table[codes // lm.CLASSES].argmax(1)
    assert (picked == codes % lm.CLASSES).mean() > 0.9


def test_lm_empty_tables(spark, tmp_path):
    assert lm.op7_lm_score(spark, saved(spark, [], tmp_path / "none")).collect() == []
    held = next(i for i in range(100) if crc_mod(i, 7) == 2)
    (r,) = lm.op7_lm_score(spark, saved(spark, [(held, "untrained words")], tmp_path / "one")).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and r.score < 0


def test_classes_of_spark_and_python_agree(spark):
    from pyspark.sql import functions as F
    words = ["a", "ab", "été", "日本", "x" * 70, "é"]
    df = spark.createDataFrame([(bytearray(w.encode()),) for w in words], "word binary")
    got = [r[0] for r in df.select(F.lit(lm.END + 1) + F.pmod(F.crc32(F.expr("substring(word, -2, 2)")), F.lit(lm.RARE))).collect()]
    classes = lm.Classes([])
    assert got == [classes[w.encode()] for w in words]


def test_model_grows_with_the_corpus(spark, tmp_path, monkeypatch):
    """More classes and steps with more training tokens, and every token stepped over."""
    assert lm.sizes(1000) == (lm.FREQUENT, lm.RARE) and lm.sizes(8 * lm.LEAST) == (2 * lm.FREQUENT, 2 * lm.RARE)
    monkeypatch.setattr(lm, "LEAST", 1000)
    rows = corpus()
    made = []
    monkeypatch.setattr(lm, "train", lambda *a, f=lm.train: made.append((a, f(*a))) or made[-1][1])
    out = lm.op7_lm_score(spark, saved(spark, rows, tmp_path)).collect()
    ((_, frequent, sizes, share, n), model), = made
    assert sizes == lm.sizes(n) and sizes[0] > lm.FREQUENT and len(frequent) == sizes[0]
    assert len(model.bias) == len(share) == sum(sizes) + 1
    assert np.allclose((10.0 ** model.table().astype(float)).sum(1), 1, atol=1e-4)
    held = [r for r in out if r.held_out and r.n_tokens > 10]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_score_against_one_token_at_a_time(spark, tmp_path, monkeypatch):
    """The model's probability of each token, read from the whole normalised table, times its word's share of a rare class."""
    monkeypatch.setattr(lm.score, "__defaults__", (100,))  # over the frequent words, and some words left to the tail
    rows = corpus()
    made = []
    monkeypatch.setattr(lm, "train", lambda *a, f=lm.train: made.append((a, f(*a))) or made[-1][1])
    out = lm.op7_lm_score(spark, saved(spark, rows, tmp_path)).collect()
    ((_, frequent, sizes, _, _), model), = made
    table, classes = model.table().astype(float), lm.Classes(frequent, *sizes)
    counts = {}
    for i, text in rows:
        if crc_mod(i, 7) != 2:
            for w in lm.tokens(text):
                counts[w] = counts.get(w, 0) + 1
    rare = {}
    for w, c in counts.items():
        if classes[w] > classes.end:
            rare.setdefault(classes[w], []).append(c)
    want = []
    for i, text in rows:
        own, total = lm.tokens(text), 0.0
        c = [classes.n, classes.n, *[classes[w] for w in own], classes.end]
        for j, w in enumerate([*own, None], 2):
            total += table[c[j - 2] * (classes.n + 1) + c[j - 1], c[j]]
            if c[j] > classes.end:
                held = rare.get(c[j], [])
                total += np.log10(counts.get(w, 0) + 1) - (np.log10(sum(held) + len(held) + 1) if held else 0)
        want.append((i is None, i or 0, len(own) + 1, total))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.score) for r in out)
    want.sort()
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], rel=1e-4, abs=1e-3)
