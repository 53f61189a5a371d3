import random

import pytest
from pyspark.sql import functions as F

from phonesense.operators import metrics, probes
from phonesense.operators.payload import sensor_raw, upload_rejects, upload_report
from phonesense.plans import state

DAY_MS = 86_400_000


def event(rng, day):
    fields = {"COMM_TIMESTAMP": None if day is None else f'"{day * DAY_MS + rng.randrange(DAY_MS)}"',
              "COMMUNICATION_TYPE": rng.choice(['"PHONE"', '"SMS"', '"MMS"', None]),
              "COMMUNICATION_DIRECTION": rng.choice(['"INCOMING"', '"OUTGOING"', '"MISSED"', '"X"', None]), "NUMBER": rng.choice(['"1"', '"2"', '"3"', None])}
    return '{"PROBE":"a.CommunicationEventProbe"' + "".join(f',"{k}":{v}' for k, v in fields.items() if v) + "}"


def log(rng, day):
    calls = ",".join('{"CALL_DURATION":%s,"CALL_TIMESTAMP":%d}' % (rng.choice(["5", "5", "9", "9", "1", "null"] if day % 3 else ["5", "9", "9"]),
                                                                   day * DAY_MS + rng.randrange(4) * 3_600_000) for _ in range(3))
    return '{"PROBE":"a.CommunicationLogProbe","PHONE_CALLS":[%s]}' % calls


def some_uploads(n, seed, days=range(10, 16)):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        day = rng.choice(list(days))
        objects = [event(rng, rng.choice([day, day, None])) for _ in range(rng.randint(0, 3))] + [log(rng, day)]
        out.append((rng.choice(["u1", "u2", "u3", None]), ",".join(objects)))
    return out


SOME = ("stats_phone", "unique_texts", "call_duration")


def recomputed(raw, names):
    pl = sensor_raw(raw, "PERMISSIVE")
    ev, calls = probes.probe_event(pl), probes.probe_calls(pl)
    return {name: metrics.call_duration(calls) if name == "call_duration" else getattr(metrics, name)(ev) for name in names}


def rows(df):
    return df.columns, sorted(map(tuple, df.collect()), key=repr)


def same(spark, out, raw, names=SOME):
    for name, df in recomputed(raw, names).items():
        assert rows(state.read_result(spark, out, name)) == rows(df), name


def test_batches_add_up_to_a_full_recompute(spark, uploads, tmp_path):
    out = str(tmp_path)
    a, b = some_uploads(60, 1), some_uploads(40, 2, range(12, 20))
    state.add_batch(uploads(a), out, "a")
    state.add_batch(uploads(b), out, "b")
    same(spark, out, uploads(a + b), state.DAILY)
    assert rows(state.probe_counts(spark, out))[1] == rows(sensor_raw(uploads(a + b)).groupBy("probe").count())[1]


def test_a_batch_replaces_itself(spark, uploads, tmp_path):
    out = str(tmp_path)
    a, b, other = some_uploads(30, 1), some_uploads(20, 2, range(12, 20)), some_uploads(10, 4, [11, 30])
    state.add_batch(uploads(a), out, "a", names=SOME)
    for again in (b, b, other, []):
        state.add_batch(uploads(again), out, "b", names=SOME)
        same(spark, out, uploads(a + again), SOME if again is other else SOME[2:])


def files(path):
    return {str(f.relative_to(path)) for f in path.rglob("*.parquet")}


def test_only_touched_days_are_written(spark, uploads, tmp_path):
    out = str(tmp_path)
    state.add_batch(uploads(some_uploads(60, 1)), out, "a", names=SOME)
    before = files(tmp_path / "tables" / "stats_phone")
    state.add_batch(uploads(some_uploads(30, 7, [13])), out, "b", names=SOME)
    changed = before ^ files(tmp_path / "tables" / "stats_phone")
    assert {f.split("/")[0] for f in changed} <= {"event_date=1970-01-14", "event_date=__HIVE_DEFAULT_PARTITION__"} and changed


def test_a_stopped_append_can_be_repeated(spark, uploads, tmp_path, monkeypatch):
    out = str(tmp_path)
    a, b = some_uploads(30, 1), some_uploads(20, 2)
    state.add_batch(uploads(a), out, "a", names=SOME)
    with monkeypatch.context() as m:
        m.setattr(state, "refresh", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            state.add_batch(uploads(b), out, "b", names=SOME)
    state.add_batch(uploads(b), out, "b", names=SOME)
    same(spark, out, uploads(a + b))


@pytest.mark.parametrize("mode", ["PERMISSIVE", "RECOVER"])
def test_uploads_are_parsed_once_and_all_accounted_for(spark, uploads, tmp_path, mode):
    out = str(tmp_path)
    good = '{"PROBE":"a.CommunicationEventProbe","COMM_TIMESTAMP":"1","COMMUNICATION_TYPE":"SMS"}'
    some = [("u1", good), ("u2", good + ',{"PROBE":tru}'), ("u3", ""), ("u4", None), ("u5", "{"), ("u6", good + "," + good)]
    state.add_batch(uploads(some), out, "x-1", mode, names=("count_commtype",))
    raw = uploads(some)
    assert rows(state.upload_counts(spark, out)) == rows(upload_report(raw))
    assert rows(state.rejected_uploads(spark, out)) == rows(upload_rejects(raw))
    want = sensor_raw(raw, mode).select("user_id", "array_index", F.to_json("json"))
    assert rows(state.read_payload(spark, out).select("user_id", "array_index", F.to_json("json")))[1] == rows(want)[1]
    texts = {r.user_id: r.SMS for r in state.read_result(spark, out, "count_commtype").collect()}
    assert texts == {"u1": 1, "u6": 2} | ({"u2": 1} if mode == "RECOVER" else {})


def test_batch_ids_are_plain_names(uploads, tmp_path):
    for bad in ("", "a/b", "a b", "x=1"):
        with pytest.raises(ValueError):
            state.add_batch(uploads([]), str(tmp_path), bad)
