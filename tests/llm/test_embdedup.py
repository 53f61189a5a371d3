from pathlib import Path

import duckdb
import numpy as np
import pytest

from phonesense.llm import embdedup as ed
from phonesense.llm.oracle import ORACLE_SQL

SCHEMA = "vec_id long, embedding array<float>, label int, node string, x string, n string, unit int"


def saved(spark, rows, path, kind="float"):
    df = spark.createDataFrame([(*r, "c", "c", "c", 0) for r in rows], SCHEMA.replace("float", kind))
    df.repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def brute(rows, kind=np.float32):
    at = [(i, None if v is None else [None if x is None else float(kind(x)) for x in v], label) for i, v, label in rows]
    fit = [bool(v) and label is not None and None not in v and bool(np.isfinite(v).all()) and any(v) for _, v, label in at]
    names, links = list(range(len(at))), [0] * len(at)

    def find(i):
        while names[i] != i:
            i = names[i]
        return i

    units = [np.array(v) / max(map(abs, v)) if f else None for (_, v, _), f in zip(at, fit, strict=True)]
    for i in range(len(at)):
        for j in range(i):
            if fit[i] and fit[j] and at[i][2] == at[j][2] and len(units[i]) == len(units[j]):
                a, b = units[i], units[j]
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                    links[i], links[j] = links[i] + 1, links[j] + 1
                    names[find(i)] = find(j)
    least = {}
    for i, (vec_id, _, _) in enumerate(at):
        if vec_id is not None:
            least[find(i)] = min(vec_id, least.get(find(i), vec_id))
    return sorted(((v, links[i], least.get(find(i)), v == least.get(find(i))) for i, (v, _, _) in enumerate(at)), key=repr)


def vectors(seed=0, dim=24, n=300):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(30, dim))
    x = middle[rng.integers(0, 30, n)] + rng.normal(size=(n, dim)) * rng.choice([0.1, 0.25, 0.3, 0.5], (n, 1))
    x *= rng.lognormal(0, 3, (n, 1))
    rows = [(i, [float(c) for c in v.astype(np.float32)], int(rng.integers(0, 3))) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(40)]  # copies
    rows += [(1100 + i, rows[3][1], (rows[3][2] + 1) % 3) for i in range(3)]  # of another label
    rows += [(1200, None, 1), (1201, [1.0, None] + [0.0] * (dim - 2), 1), (1202, [float("nan")] * dim, 1), (1203, [float("inf")] * dim, 1),
             (1204, [], 1), (1205, [0.0] * dim, 1), (1206, [0.0] * dim, 1), (1207, rows[5][1], None), (1208, rows[5][1], None),
             (None, rows[6][1], rows[6][2]), (None, [1.0] + [-1.0] * (dim - 1), 7), rows[8], rows[8],
             (1210, [1.0, 1.0], 1), (1211, [1e30, 1e30], 1), (1212, [1e-30, 1e-30], 1), (1213, [1.0, 0.0, -0.0], 2), (1214, [2.0, -0.0, 0.0], 2)]
    return rows


def op(spark, rows, path, **more):
    return sorted(map(tuple, ed.components(spark.read.parquet(saved(spark, rows, path, **more) + "/embeddings.parquet")).collect()), key=repr)


@pytest.mark.parametrize("tile, stripe", [(4096, 1024), (20, 7)])
def test_against_brute_force(spark, tmp_path, monkeypatch, tile, stripe):
    monkeypatch.setattr(ed, "STRIPE", stripe)
    rows = vectors()
    df = spark.read.parquet(saved(spark, rows, tmp_path) + "/embeddings.parquet")
    want = brute(rows)
    assert sorted(map(tuple, ed.components(df, tile=tile).collect()), key=repr) == want
    assert sum(r[1] for r in want) > 1000 and 0 < sum(r[3] for r in want) < len(want)


def test_names_keep_the_order_of_ids(spark):
    ids = [None, 0, 1, -1, 2 ** 63 - 1, -2 ** 63, 256, 255, 10 ** 15]
    df = spark.createDataFrame([(i, bytearray(b"n")) for i in ids], "i long, node binary")
    got = df.select("i", ed.named(df.i, df.node).alias("name"), ed.id_of(ed.named(df.i, df.node)).alias("back")).orderBy("name").collect()
    assert [r.i for r in got] == [r.back for r in got] == sorted(x for x in ids if x is not None) + [None]


def test_double_components(spark, tmp_path):
    rows = [(0, [1e300, 0.0], 1), (1, [1e-300, 1e-301], 1), (2, [0.0, 1.0], 1), (3, [1e300, 4e299], 1)]
    assert op(spark, rows, tmp_path, kind="double") == brute(rows, float)


def test_sql_agrees(spark, tmp_path):
    rows = [r for r in vectors(3, n=120) if r[0] not in (1211, 1212)]  # DuckDB's cosine under- or overflows there
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{next(Path(saved(spark, rows, tmp_path)).glob('*.parquet'))}/*.parquet'")
    assert sorted(con.sql(ORACLE_SQL["op13_embedding_dedup"]).fetchall(), key=repr) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert ed.op13_embedding_dedup(spark, saved(spark, [], tmp_path)).collect() == []


def test_no_linked_pair_is_ruled_out():
    """The bound holds for every pair, and most pairs far from the threshold are never recomputed."""
    rng = np.random.default_rng(7)
    for dim in (1, 2, 5, 64, 1500):
        middle = rng.normal(size=(20, dim))
        x = middle[rng.integers(0, 20, 200)] + rng.normal(size=(200, dim)) * rng.choice([0.05, 0.27, 0.4], (200, 1))
        packed, scale, error, length = ed.quantised(x)
        u = ed.unit(x)
        cosines = u @ u.T
        product = ed.products(packed, packed) * scale[:, None] * scale
        bound = length[:, None] * error + error[:, None] * (length + error)
        assert (np.abs(cosines - product) <= bound).all()
        assert (ed.products(packed, packed) == packed.astype(np.int64) @ packed.astype(np.int64).T).all()
        if dim >= 64:
            assert ((product + bound >= 0.93).sum() - (cosines >= 0.93).sum()) < 0.2 * cosines.size


def test_trees_join_what_pairs_join():
    rng = np.random.default_rng(2)
    for _ in range(50):
        size = int(rng.integers(1, 80))
        x, y = rng.integers(0, size, (2, int(rng.integers(0, 60))))
        parent = ed.forest(size, x, y)

        def classes(a, b):
            names = list(range(size))
            for i, j in zip(a, b, strict=True):
                i, j = names[i], names[j]
                names = [i if n == j else n for n in names]
            return {frozenset(k for k in range(size) if names[k] == n) for n in names}

        ends = np.flatnonzero(parent >= 0)
        assert classes(x, y) == classes(ends, parent[ends])
        assert np.bincount(parent[ends], minlength=1).max(initial=0) <= ed.FAN
