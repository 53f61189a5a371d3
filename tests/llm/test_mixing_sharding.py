import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from phonesense.llm import mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def saved(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    return str(path)


def documents(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    source = rng.choice(["a", "b", "é", "z", None], n, p=[0.4, 0.3, 0.1, 0.1, 0.1])
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), s, "clash", 3) for i, s in enumerate(source)]
    rows += [(n, None, "b", "x", 1), (n + 1, "", None, "x", 1), (n + 2, "one\ttwo two", "z", None, None)]
    return rows + [rows[5], rows[5]]


SCHEMA = "doc_id long, text string, source string, shard string, copies int"


def brute_targets(sizes):
    """Shares by weight, the excess of the stopped sources shared again until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        free = sum(w for s, w in weight.items() if s not in stopped)
        target = {s: 3 * sizes[s] if s in stopped else left * weight[s] / free for s in order}
        over = {s for s in order if target[s] > 3 * sizes[s] and s not in stopped}
        if not over:
            return target
        stopped |= over


@pytest.fixture(scope="module")
def mixed(spark, tmp_path_factory):
    rows = documents()
    path = saved(spark, rows, SCHEMA, tmp_path_factory.mktemp("mix"))
    return rows, path, mixing.op3_mixing(spark, path).collect()


def test_mix_sizes_and_targets(mixed):
    rows, _, out = mixed
    size = defaultdict(int)
    for _, text, source, *_ in rows:
        size[source] += len(WORD.findall(text or ""))
    target = brute_targets(size)
    of = {r[0]: r for r in rows}
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    taken = defaultdict(int)
    for r in out:
        _, text, source, *_ = of[r.doc_id]
        assert r.size == len(WORD.findall(text or "")) and r.source_size == size[source]
        assert r.target == pytest.approx(target[source])
        assert r.taken <= 3 * r.size and r.taken == r.size * r.copies
        taken[source] += r.taken
    for s in size:
        assert abs(taken[s] - target[s]) <= 200  # a few documents of a source


def test_mix_reruns_agree(spark, mixed):
    _, path, out = mixed
    again = mixing.op3_mixing(spark, path).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))


def test_targets_by_chance(spark):
    rng = np.random.default_rng(4)
    for _ in range(3):
        sizes = {s: int(rng.integers(0, 1000) ** 2) for s in "abcdefg"[:int(rng.integers(1, 8))]}
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        assert {r.source: r.target for r in got} == pytest.approx(brute_targets(sizes))


def test_split_tree_deals_everything_evenly(spark):
    draws = [("a", b, c) for b in range(90) for c in range(2)] + [("b", b, 0) for b in range(60)]
    out = mixing.split_tree(spark.createDataFrame(draws, "source string, block int, copy int"), 6).collect()
    assert Counter((r.source, r.block, r["copy"]) for r in out) == Counter(draws)
    sizes = Counter(r.shard for r in out)
    assert set(sizes) == set(range(6)) and max(sizes.values()) - min(sizes.values()) <= 2
    assert all(0 < n < 60 for n in Counter((r.source, r.shard) for r in out).values())


def test_mix_keeps_columns_and_repeats_rows(spark, mixed):
    rows, path, planned = mixed
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "mix_shard"]
    got = Counter(r.doc_id for r in out.collect())
    want = Counter()
    for r in planned:
        want[r.doc_id] += r.copies
    assert got == +want


def test_mix_empty_table(spark, tmp_path):
    assert mixing.op3_mixing(spark, saved(spark, [], SCHEMA, tmp_path)).collect() == []


@pytest.fixture(scope="module")
def sharded(spark, tmp_path_factory):
    rng = np.random.default_rng(2)
    texts = ["".join(map(chr, rng.integers(97, 300, int(rng.integers(0, 400))))) for _ in range(4000)]
    texts += ["copied text " * 20] * 1500 + ["few copies"] * 12 + [None, "", "z" * 30000]
    rows = [(i, t, "s", "k", 0) for i, t in enumerate(texts)] + [(None, "no id", "s", "k", 0)] * 2
    path = saved(spark, rows, "doc_id long, text string, key string, shard string, slot int", tmp_path_factory.mktemp("shard"))
    return rows, path, sharding.op4_sharding(spark, path).collect()


def test_shard_rows(sharded):
    rows, _, out = sharded
    text = {r[0]: r[1] for r in rows}
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    for r in out:
        data = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "bytes", None)


def test_shards_are_even_and_slots_gapless(sharded):
    _, _, out = sharded
    held, slots = Counter(), defaultdict(list)
    for r in out:
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    mean = sum(held.values()) / 40
    assert set(held) <= set(range(40))
    rest = sorted(held.values())[:-1]  # one text alone is larger than a shard's share
    assert max(rest) < 1.25 * mean and min(rest) > 0.6 * mean


def test_small_groups_stay_together(sharded):
    rows, _, out = sharded
    few = {r[0] for r in rows if r[1] == "few copies"}
    assert len({r.shard for r in out if r.doc_id in few}) == 1


def test_shards_rerun_alike(spark, sharded):
    _, path, out = sharded
    assert Counter(map(tuple, sharding.op4_sharding(spark, path).collect())) == Counter(map(tuple, out))


def test_shard_empty_table(spark, tmp_path):
    assert sharding.op4_sharding(spark, saved(spark, [], "doc_id long, text string", tmp_path)).collect() == []


def test_a_column_named_like_the_shard_stays(spark):
    df = spark.createDataFrame([(i, "some words here", "s", f"own{i}") for i in range(20)], "doc_id long, text string, source string, Mix_Shard string")
    got = mixing.mix(df)
    assert got.columns == df.columns and {(r[0], r[3]) for r in got.collect()} == {(i, f"own{i}") for i in range(20)}


def test_written_shards_hold_every_row_in_slot_order(spark, tmp_path):
    """Whole rows, clashing columns and rows alike included, stand in their shard's folder in slot order."""
    rows = [(i % 700 if i % 50 else None, f"text {i % 400} " * (i % 13), "a", i, 1.5, "p") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int, `size` double, `row` string")
    out = sharding.write_shards(df, f"{tmp_path}/out", shards=5, per_shard=20)
    assert Counter(tuple(r.row) for r in out.collect()) == Counter(rows)
    files = {}
    for path in sorted((tmp_path / "out").glob("shard=*/*.parquet")):
        slots = [r.slot for r in spark.read.parquet(str(path)).collect()]
        assert slots == sorted(slots)
        files.setdefault(path.parent.name, []).extend(slots)
    assert len(files) == 5 and all(sorted(s) == list(range(len(s))) for s in files.values())
