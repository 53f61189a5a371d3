import hashlib
import math
from pathlib import Path

import duckdb
import numpy as np
import pytest

from phonesense.llm import centroids as ct
from phonesense.llm.oracle import ORACLE_SQL

SCHEMA = "vec_id long, embedding array<float>, q string, away string, cluster string, distance int"


def saved(spark, rows, path, schema=SCHEMA):
    spark.createDataFrame([(*r, "c", "c", "c", 0) for r in rows], schema).repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def brute(rows, k=40, rounds=5):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    if not kept:
        return []
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    points = np.array([q for _, q in kept], object)
    centres = [q for _, q in sorted(kept, key=lambda r: (name(r[0]), r[0] if r[0] is not None else -1, r[1]))[:k]]

    def assign():
        d = np.stack([((points - np.array(c, object)) ** 2).sum(1) for c in centres], 1)
        return [min(range(len(centres)), key=lambda c: (row[c], c)) for row in d], d

    for _ in range(rounds):
        own, _ = assign()
        for c in range(len(centres)):
            of = [q for (_, q), o in zip(kept, own, strict=True) if o == c]
            if of:
                centres[c] = [sum(x) // len(of) for x in zip(*of, strict=True)]
    own, d = assign()
    inertia = [0] * len(centres)
    for row, o in zip(d, own, strict=True):
        inertia[o] += row[o]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, o, row[o], inertia[o], sum(inertia), sha[o]) for (i, _), row, o in zip(kept, d, own, strict=True)), key=repr)


def vectors(n=400, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(9, 64))
    x = middle[rng.integers(0, 9, n)] * spread + rng.normal(size=(n, 64)) * 0.3
    return [(i, [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(x)]


def op(spark, rows, path):
    return sorted(map(tuple, ct.op12_centroids(spark, saved(spark, rows, path)).collect()), key=repr)


def test_against_brute_force(spark, tmp_path):
    rows = vectors()
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [rows[5], rows[5], (None, rows[6][1]), (None, rows[7][1])]
    rows += [(2000, None), (2001, [1.0] * 63), (2002, [None] + [0.0] * 63), (2003, [float("nan")] * 64), (2004, [float("inf")] * 64),
             (2005, []), (2006, [0.0] * 64)]
    got = op(spark, rows, tmp_path)
    assert got == brute(rows) and len(got) == 465


def test_sql_agrees(spark, tmp_path):
    rows = vectors(150, seed=2)
    path = saved(spark, rows, tmp_path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{next(Path(path).glob('*.parquet'))}/*.parquet'")
    assert sorted(con.sql(ORACLE_SQL["op12_centroids"]).fetchall(), key=repr) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, None)], vectors(7)])
def test_few_and_no_vectors(spark, tmp_path, rows):
    assert op(spark, rows, tmp_path) == brute(rows)


def test_empty_clusters_keep_their_centroid(spark, tmp_path):
    same = [1.0] * 64
    rows = [(i, same) for i in range(50)]  # ties go to centroid 0, all others stay empty
    got = op(spark, rows, tmp_path)
    assert got == brute(rows) and {r[1] for r in got} == {0}


def test_large_components_are_held(spark, tmp_path):
    rows = [(0, [3e38] * 64), (1, [-3e38] * 64), (2, [1.0] * 64)]
    got = op(spark, rows, tmp_path)
    assert [r[2] for r in got] == [0, 0, 0]
    assert ct.squares(np.full((1, 64), ct.LARGEST), np.full(64, -ct.LARGEST))[0] == 64 * (2 * ct.LARGEST) ** 2 > 0


def test_bounds_exclude_no_nearest_centroid_and_save_work():
    rng = np.random.default_rng(4)
    saved_any = False
    for trial in range(60):
        dim, n, k = int(rng.integers(1, 20)), int(rng.integers(1, 120)), int(rng.integers(1, 30))
        size = [3, 300, 10 ** 6, ct.LARGEST][trial % 4]
        middle = rng.integers(-size, size + 1, (k, dim))
        q = np.clip(middle[rng.integers(0, k, n)] + rng.integers(-2, 3, (n, dim)), -ct.LARGEST, ct.LARGEST)
        centroids = np.clip(middle + rng.integers(-1, 2, (k, dim)), -ct.LARGEST, ct.LARGEST)
        pivots = ct.chosen_pivots(centroids, 6)
        cluster, best, taken = ct.nearest(q, ct.apart(q, pivots), centroids, pivots)
        d = np.stack([ct.squares(q, c) for c in centroids], 1)
        assert best.tolist() == d.min(1).tolist() and cluster.tolist() == d.argmin(1).tolist()
        saved_any |= taken < n * k / 2
    assert saved_any
