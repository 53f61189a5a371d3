import json
import random
from collections import Counter

from pyspark.sql import functions as F

from phonesense.operators import objects
from phonesense.operators.objects import object_rejects
from phonesense.operators.payload import sensor_raw, upload_report

GOOD = ['{"PROBE":"a.B","N":1}', '{"PROBE":"a.B","LOG":[{"X":1},{"X":[2,{"Y":"}"}]}]}', '{"PROBE":"a.B","T":"},{\\"PROBE\\":\\"x"}',
        '{"N":[],"PROBE":"q\\\\"}', ' {"PROBE" : "a.B" , "O" : { "P" : [ { } , { } ] } } ', '{"PROBE":"ü","T":"\\u0041,{"}']
BAD = ['{"PROBE":tru}', '{"PROBE":"a","PROBE":"a"}', '{"PROBE":"a",,}', '{"PROBE":"cut', '{"PROBE":"a","LOG":[1,2', '{"PROBE":"a"}}', '{"PROBE":"a"]',
       '{"A":[{"PROBE"', "nonsense}", '{"PROBE":']


def rows(df):
    return sorted((tuple(r) for r in df.select("user_id", "array_index", F.to_json("json")).collect()), key=lambda r: (r[0] or "", r[1]))


def recovered(uploads, payload):
    return [(i, json.loads(j)) for _, i, j in rows(sensor_raw(uploads([("u", payload)]), mode="RECOVER"))]


def test_a_bad_object_costs_itself_only(uploads):
    some = {f"{b:02}-{place}": [*GOOD[:place], bad, *GOOD[place:]] for b, bad in enumerate(BAD) for place in (0, 2, len(GOOD))}
    raw = uploads([(u, ",".join(parts)) for u, parts in some.items()])
    got = [(u, i, json.loads(j)) for u, i, j in rows(sensor_raw(raw, mode="RECOVER"))]
    assert got == [(u, i + 1, json.loads(p)) for u, parts in some.items() for i, p in enumerate(parts) if p in GOOD]
    left = sorted(tuple(r) for r in object_rejects(raw).collect())
    assert left == [(u, i + 1, sum(len(q) + 1 for q in parts[:i]), "malformed", p)
                    for u, parts in some.items() for i, p in enumerate(parts) if p in BAD]


def test_several_bad_objects(uploads):
    rng = random.Random(4)
    some = []
    for n in range(40):
        parts = [rng.choice(GOOD[:2] + GOOD[3:5]) if rng.random() < 0.6 else rng.choice(BAD[:5]) for _ in range(rng.randint(1, 9))]
        some.append((f"u{n:02}", parts))
    raw = uploads([(u, ",".join(parts)) for u, parts in some])
    got = [(u, i, json.loads(j)) for u, i, j in rows(sensor_raw(raw, mode="RECOVER"))]
    assert got == [(u, i + 1, json.loads(p)) for u, parts in some for i, p in enumerate(parts) if p in GOOD]


def test_every_character_is_in_an_object_or_a_reject(uploads):
    """Good and rejected texts, put together in order, are the payload."""
    rng = random.Random(9)
    marks = list('{}[],:"\\ a1') + ['{"PROBE":"a"}', '{"PROBE":"a","L":[{"b":1},{"b":2}]}', '"},{"']
    some = [(str(n), "".join(rng.choice(marks) for _ in range(rng.randint(1, 30)))) for n in range(300)]
    got = objects.split_objects(uploads(some)).orderBy("upload", "at").collect()
    texts = {}
    for r in got:
        texts.setdefault(r.user_id, []).append((r.at, r.text))
    parsed = {r.user_id for r in uploads(some).where(objects._usable(F.col("payload"))).collect()}
    for user, payload in some:
        if user in parsed or not payload.strip():
            assert user not in texts
        else:
            assert ",".join(t for _, t in texts[user]) == payload
            assert all(payload[a:a + len(t)] == t for a, t in texts[user])


def test_good_uploads_are_as_before(uploads):
    raw = uploads([("a", ",".join(GOOD)), ("b", None), ("c", ""), (None, '{"PROBE":"x"},7,[{"PROBE":"y"}]'), ("d", "  ")])
    assert rows(sensor_raw(raw, mode="RECOVER")) == rows(sensor_raw(raw))
    assert object_rejects(raw).collect() == []


def test_fragments_of_a_cut_object_are_not_taken_for_objects(uploads):
    payload = '{"PROBE":"a","LOG":[{"X":1},{"X":2},{"X"' + ',{"PROBE":"b"}'
    assert recovered(uploads, payload) == [(2, {"PROBE": "b"})]
    got = [(r.array_index, r.position, r.reason, r.object) for r in object_rejects(uploads([("u", payload)])).collect()]
    assert got == [(1, 0, "malformed", '{"PROBE":"a","LOG":[{"X":1},{"X":2},{"X"')]


def test_uploads_over_the_limit(uploads, monkeypatch):
    """With a small limit in place of 128 MB: uploads above it are read, objects above it rejected."""
    monkeypatch.setattr(objects, "VARIANT_LIMIT", 100)
    monkeypatch.setattr("phonesense.operators.payload.VARIANT_LIMIT", 100)
    large = '{"PROBE":"a","T":"' + "x" * 200 + '"}'
    nested = '{"PROBE":"a","L":[' + ",".join('{"v":%d}' % i for i in range(40)) + "]}"
    parts = [GOOD[0], GOOD[1], large, GOOD[3], nested, GOOD[0], '{"PROBE":tru}', GOOD[1]]
    raw = uploads([("u", ",".join(parts)), ("v", GOOD[0])])
    got = [(u, json.loads(j)) for u, _, j in rows(sensor_raw(raw, mode="RECOVER"))]
    assert got == [("u", json.loads(p)) for p in parts if p in GOOD] + [("v", json.loads(GOOD[0]))]
    reasons = {r.reason for r in object_rejects(raw).collect()}
    assert "oversize" in reasons and "malformed" in reasons
    assert {r.state: r.n for r in upload_report(raw).collect()} == {"oversize": 1, "parsed": 1}


def test_good_uploads_are_not_shuffled(uploads):
    """Only the branch of bad uploads holds windows, and nothing runs in Python."""
    plan = sensor_raw(uploads([("u", GOOD[0])]), mode="RECOVER")._jdf.queryExecution().optimizedPlan().toString()
    first = plan.split("\n:- ")[1].split("\n+- ")[0]
    assert "Window" not in first and "Python" not in plan and "Arrow" not in plan


def test_more_uploads_make_more_tasks(uploads, monkeypatch):
    """What a task holds does not grow with the uploads: a small share of them each, whatever their text compresses to."""
    monkeypatch.setattr(objects, "TASK_BYTES", 20_000, raising=False)
    parts = [GOOD[0], BAD[0], GOOD[1], BAD[3], GOOD[0]]

    def most(n):
        found = objects.split_objects(uploads([(f"u{i}", ",".join(parts)) for i in range(n)]).repartition(3))
        rows = found.select("user_id", "at", "reason", "text", F.spark_partition_id().alias("task")).collect()
        assert sorted(r.text for r in rows if r.reason is None) == sorted(n * [p for p in parts if p in GOOD])
        assert sorted(r.text for r in rows if r.reason) == sorted(n * [p for p in parts if p in BAD])
        return max(Counter(task for _, task in {(r.user_id, r.task) for r in rows}).values())

    assert most(1000) < 100


def test_uploads_over_the_limit_in_many_tasks(uploads, monkeypatch):
    nested = '{"PROBE":"a","L":[' + ",".join('{"v":%d}' % i for i in range(40)) + "]}"
    raw = uploads([(f"u{i:03}", ",".join([GOOD[0], nested, BAD[0], GOOD[1]][i % 3:])) for i in range(60)])
    monkeypatch.setattr(objects, "VARIANT_LIMIT", 100)
    monkeypatch.setattr("phonesense.operators.payload.VARIANT_LIMIT", 100)
    whole = rows(sensor_raw(raw, mode="RECOVER")), sorted(map(tuple, object_rejects(raw).collect()), key=repr)
    monkeypatch.setattr(objects, "TASK_BYTES", 20_000, raising=False)
    assert (rows(sensor_raw(raw, mode="RECOVER")), sorted(map(tuple, object_rejects(raw).collect()), key=repr)) == whole
    assert any(r[3] == "oversize" for r in whole[1])


def test_recovered_rows_of_more_uploads_come_from_more_tasks(uploads, monkeypatch):
    monkeypatch.setattr(objects, "TASK_BYTES", 20_000, raising=False)
    parts = [GOOD[0], BAD[0], GOOD[1], BAD[3], GOOD[0]]
    raw = uploads([(f"u{i}", ",".join(parts)) for i in range(600)]).repartition(3)
    got = objects.recovered_rows(raw).select("user_id", "array_index", F.spark_partition_id()).collect()
    assert sorted((u, i) for u, i, _ in got) == sorted((f"u{n}", i) for n in range(600) for i in (1, 3, 5))
    assert max(Counter(task for _, task in {(u, task) for u, _, task in got}).values()) < 100
