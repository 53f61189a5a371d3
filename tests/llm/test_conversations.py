import hashlib
import random
import zlib
from itertools import product
from pathlib import Path

import duckdb
import pytest

from phonesense.llm import conversations as cv
from phonesense.llm.oracle import ORACLE_SQL

SCHEMA = "conv_id long, turn long, role string, text string, conv string, md5 string, n int"
SPACES = " \t\n\x0b\x0c\r"


def plain_cheapest(rows):
    """(cost, audit, lines) by a forward table over (rows passed, state); rows are (role, text, fault)."""
    states = {"": (0, "", [])}  # the letters so far reduced to their last, "" at the start

    def better(table, state, new):
        if state not in table or new[:2] < table[state][:2]:
            table[state] = new

    def step(state, letter):
        legal = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        return letter if letter and letter in legal else None

    def with_inserts(table):
        for _ in range(3):
            for state, (cost, audit, lines) in list(table.items()):
                for letter, role in (("u", "user"), ("a", "assistant")):
                    if step(state, letter):
                        better(table, letter, (cost + 5, audit + "I", lines + [role + ":"]))
        return table

    states = with_inserts(states)
    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, lines) in states.items():
            better(after, state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 * (fault == "truncated")
            if step(state, role[:1]):
                better(after, role[0], (cost + more, audit + "K", lines + [f"{role}:{text}"]))
            for letter, other in (("u", "user"), ("a", "assistant")):
                if step(state, letter) and letter != role[:1]:
                    better(after, letter, (cost + 1 + more, audit + "R", lines + [f"{other}:{text}"]))
        states = with_inserts(after)
    return min(states[s] for s in ("", "a") if s in states)


def brute(rows, spoil=True):
    convs = {}
    for conv_id, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        own = convs.setdefault(conv_id, [])
        d = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20 if spoil else 9
        if d == 0:
            continue
        text = "" if d == 1 else "".join(c for c in text if c not in ".!?") if d == 2 else text
        own += [(turn, "user" if d == 4 else role, text)] * (1 + (d == 3))
    out = []
    for conv_id, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, faulty = set(), []
        for _, role, text in own:
            end = text.rstrip(SPACES)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        letters = [r[:1] for r, _, _ in faulty]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
        cost, audit, lines = plain_cheapest(faulty)
        faults = [f for _, _, f in faulty]
        out.append((conv_id, gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def saved(spark, rows, path):
    spark.createDataFrame([(*r, "c", "m", 1) for r in rows], SCHEMA).repartition(3).write.parquet(f"{path}/conversations.parquet")
    return str(path)


def some_rows(convs=150, longest=14, seed=1):
    rng = random.Random(seed)
    texts = ["Hello there.", "Yes!", "no end", "", " \t\n", "Why?  ", "a. b", None, "ü.\n", "..", "x" * 50]
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User"])
            rows.append((None if c == 7 else c, None if rng.random() < 0.05 else t * rng.choice([1, 1, 1, 2]), role, rng.choice(texts)))
    return rows


def op(spark, rows, path):
    return sorted(map(tuple, cv.op11_conversation_repair(spark, saved(spark, rows, path)).collect()), key=repr)


def test_against_the_plain_table(spark, tmp_path):
    rows = some_rows()
    rows += [r for r in rows if rows.index(r) % 11 == 0]  # repeated rows
    rows += [(1000, t, "user" if t % 2 == 0 else "assistant", "long " * 50_000 + f"{t}.") for t in range(4)]
    assert op(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("block, fan", [(3, 2), (5, 3)])
def test_long_conversations_are_contracted(spark, tmp_path, monkeypatch, block, fan):
    monkeypatch.setattr(cv, "BLOCK", block)
    monkeypatch.setattr(cv, "FAN", fan)
    rows = some_rows(12, 70, seed=3) + [(500, t, "user", "same.") for t in range(40)] + [(501, 1, "user", "all alike.")] * 30
    assert op(spark, rows, tmp_path) == brute(rows)


def test_sql_agrees(spark, tmp_path):
    rows = some_rows(60, seed=5)
    rows = [r for r in rows if r[2] != ""]
    path = saved(spark, rows, tmp_path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{next(Path(path).glob('*.parquet'))}/*.parquet'")
    assert sorted(con.sql(ORACLE_SQL["op11_conversation_repair"]).fetchall(), key=repr) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert op(spark, [], tmp_path) == []


def test_conversation_that_is_dropped_whole(spark, tmp_path):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert op(spark, [(gone, 0, "user", "Hi.")], tmp_path) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "assistant", "Hi."), (1, 3, "assistant", "So?"),
            (2, 5, "user", "cut o"), (None, None, None, "Well."), (3, 0, "user", "Alone.")]
    df = spark.createDataFrame([(*r, "c", "m", 1) for r in rows], SCHEMA)
    got = sorted(map(tuple, cv.repaired(df).collect()), key=repr)
    # A lone last message is cheaper to delete than to answer; so is what a single row would need around it.
    assert got == sorted([(1, 0, "system", "Be kind.", "K"), (1, 1, "user", "Hi.", "R"), (1, 2, "assistant", "So?", "K")], key=repr)


def test_search_finds_least_audit_of_all():
    """Against every sequence of edits, on all short lists of row codes."""

    def walks(codes, most=2):
        found = []

        def walk(i, q, cost, audit, left):
            if i == len(codes) and q in cv.ENDS:
                found.append((cost, audit))
            if i < len(codes):
                for to, more, letter in cv.ROW[codes[i]].out.get(q, ()):
                    walk(i + 1, to, cost + more, audit + letter, left)
            if left:
                for to, more, letter in cv.INSERTS.out.get(q, ()):
                    walk(i, to, cost + more, audit + letter, left - 1)

        walk(0, cv.EMPTY, 0, "", most)
        return min(found)

    for n in range(4):
        for codes in product(cv.ROW, repeat=n):
            assert cv.cheapest([cv.ROW[c] for c in codes], cv.INSERTS, cv.EMPTY, cv.ENDS) == walks(codes)
