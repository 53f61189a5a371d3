from collections import defaultdict

import numpy as np
import pytest

from phonesense.llm import ann, topk

SCHEMA = "vec_id long, embedding array<float>, label int, q string, length string"


def saved(spark, rows, path, parts=3):
    spark.createDataFrame([(*r, 0, "clash", "clash") for r in rows], SCHEMA).repartition(parts).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def vectors(n=1500, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * rng.lognormal(0, 1, (n, 1))
    rows = [(i, [float(v) for v in x[i].astype(np.float32)]) for i in range(n)]
    same = [float(v) for v in x[7].astype(np.float32)]
    rows += [(n + i, same) for i in range(300)]  # copies: ties to the smaller id
    rows += [(5000, None), (5050, [1.0, None] + [0.0] * (dim - 2)), (5100, [float("nan")] * dim), (5150, [float("inf")] * dim),
             (None, [1.0] * dim), (5200, []), (5300, [0.0] * dim), rows[3], rows[3], rows[50], rows[50]]
    return rows


def usable(rows):
    return {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()}


def brute_topk(rows, k=5, every=50):
    out = []
    at = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in sorted(usable(rows))]
    for i, q in at:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in at if j != i)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"SLAB": 100, "BLOCK": 7, "BUCKET": 16, "SEEDS": 20}])
def test_topk_is_exact(spark, tmp_path, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(topk, name, value)
    rows = vectors()
    got = topk.op5_topk(spark, saved(spark, rows, tmp_path)).collect()
    assert sorted(map(tuple, got)) == brute_topk(rows)


def test_pruning_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(60):
        dim, n = int(rng.integers(1, 9)), int(rng.integers(1, 200))
        rows = (rng.normal(size=(n, dim)) * rng.lognormal(0, 1, (n, 1)) * 100).astype(np.int64)
        rows[rng.random(n) < 0.1] = 0
        slab = topk.Slab(np.arange(n), rows, bucket=16)
        q = (rng.normal(size=dim) * 100).astype(np.int64)
        scores = rows @ q
        best = np.lexsort((np.arange(n), -scores))
        best = best[best != 3][:5]
        floor = -np.inf if rng.random() < 0.5 or len(best) < 5 else float(scores[best[-1]])
        ids, got = slab.top(3, q, 5, floor)
        assert ids.tolist() == best.tolist() and got.tolist() == scores[best].tolist()


def test_large_components_do_not_overflow():
    rows = np.array([[2 ** 40, 1], [2 ** 40, 0]], np.int64)
    ids, scores = topk.Slab(np.arange(2), rows).top(9, np.array([2 ** 30, 1]), 2, -np.inf)
    assert list(zip(ids, scores, strict=True)) == [(0, 2 ** 70 + 1), (1, 2 ** 70)]


def test_few_candidates_and_empty_tables(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (50, [0.5, 0.0]), (7, [1.0, 1.0, 1.0])]
    path = saved(spark, rows, tmp_path / "few", 1)
    assert sorted(map(tuple, topk.op5_topk(spark, path).collect())) == [(0, 1, 50, 256 * 128), (50, 1, 0, 256 * 128)]
    path = saved(spark, [], tmp_path / "none", 1)
    assert topk.op5_topk(spark, path).collect() == [] and ann.op10_ann(spark, path).collect() == []


def brute_near(rows, k=10, every=100):
    out = {}
    for dim in {len(v) for _, v in usable(rows)}:
        out |= brute_near_of(sorted((i, v) for i, v in usable(rows) if any(v) and len(v) == dim), k, every)
    return out


def brute_near_of(at, k, every):
    out = {}
    x = np.array([[np.float32(c) for c in v] for _, v in at], float)
    ids = np.array([i for i, _ in at])
    for i, q in zip(ids, x, strict=True):
        if i % every == 0:
            d = np.sqrt(((x - q) ** 2).sum(1))
            keep = ids != i
            best = np.lexsort((ids[keep], d[keep]))[:k]
            out[int(i)] = [(int(ids[keep][b]), float(d[keep][b])) for b in best]
    return out


def found_near(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_ann_is_exact_where_all_leaves_are_opened(spark, tmp_path):
    rows = vectors()
    at = ann.usable(spark.read.parquet(saved(spark, rows, tmp_path) + "/embeddings.parquet"))
    got, want = found_near(ann.search(at.where("vec_id % 100 = 0"), at, 10, want=10 ** 9)), brute_near(rows)
    assert set(got) == set(want)
    for i in want:
        assert [v for v, _ in got[i]] == [v for v, _ in want[i]]
        assert [s for _, s in got[i]] == pytest.approx([s for _, s in want[i]], rel=1e-12)


def test_ann_recall_where_leaves_are_left_out(spark, tmp_path):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(40, 16)) * 3
    x = centre[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16))
    rows = [(i, [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(x)]
    at = ann.usable(spark.read.parquet(saved(spark, rows, tmp_path) + "/embeddings.parquet"))
    got = found_near(ann.search(at.where("vec_id % 100 = 0"), at, 10, trees=8, leaf=32, want=800))
    want = brute_near(rows)
    hits = sum(len({v for v, _ in got[i]} & {v for v, _ in want[i]}) for i in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def mixed_dimensions():
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in rng.normal(size=4).astype(np.float32)]) for i in range(600)]
    rows += [(i, [float(c) for c in rng.normal(size=8).astype(np.float32)]) for i in range(600, 1000)]
    return rows + [(1100, [1.0, 2.0]), (1101, [1.0, 2.5]), (1200, [3.0]), (1300, [0.5] * 9)]


@pytest.mark.parametrize("forests", [4, 1])
def test_ann_of_several_dimensions(spark, tmp_path, monkeypatch, forests):
    rows = mixed_dimensions()
    at = ann.usable(spark.read.parquet(saved(spark, rows, tmp_path) + "/embeddings.parquet"))
    got = found_near(ann.search(at.where("vec_id % 100 = 0"), at, 10, target=1.0, forests=forests))
    want = brute_near(rows)
    assert set(got) == {i for i in want if want[i]} and {600, 700, 800, 900, 1100} <= set(got)
    hits = sum(len({v for v, _ in got[i]} & {v for v, _ in want[i]}) for i in want if want[i])
    assert hits >= 0.97 * sum(map(len, want.values()))
    assert [v for v, _ in got[1100]] == [1101]


def test_ann_recall_at_registered_settings(spark, tmp_path):
    """Vectors without structure, more of them than a query opens by the measured budget."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(6000, 24)).astype(np.float32))]
    got, want = found_near(ann.op10_ann(spark, saved(spark, rows, tmp_path))), brute_near(rows)
    hits = sum(len({v for v, _ in got[i]} & {v for v, _ in want[i]}) for i in want)
    assert set(got) == set(want) and hits >= 0.9 * sum(map(len, want.values()))


def test_trees_put_rows_where_queries_look():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 6))
    tree = ann.grow(x, 3, leaf=20)
    leaves = tree.leaves(x)
    assert np.bincount(leaves, minlength=len(tree.held)).tolist() == tree.held.tolist()
    for i in range(20):  # a row's own leaf is the first that opens
        assert ann.opened([tree], x[i], 1) == [(0, leaves[i])]
    assert sorted(b for _, b in ann.opened([tree], x[0], 10 ** 9)) == list(range(len(tree.held)))
