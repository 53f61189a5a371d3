"""Repair of conversation structure by a bidirectional Dijkstra search over the edit lattice.

A conversation's rows, in order, are edited so that the role initials read
``(s?(ua)+)?``: Keep costs 0, Rerole (to user or assistant) 1, Delete 2, Insert (an
empty text of user or assistant, anywhere) 5; a truncated row that is not deleted adds
5, blank and duplicate rows must be deleted. Nodes of the lattice are (rows passed,
state of the grammar). Two heaps, one from the start and one from the accepted ends,
grow by turns until no cheaper path and no further equal one can be left; of all
crossings of least cost the one whose concatenated audit is ASCII-least is taken. Equally
cheap ways to a node are never prefixes of one another (only Inserts could follow,
and they cost), so a node need only keep its least audit on either side.

Long conversations: rows are ordered by range partitioning, so one conversation lies in as
many tasks as it needs, and are cut there into blocks of at most ``BLOCK`` rows. A block
becomes one step of a coarser lattice, by searches from each state to each state;
``FAN`` steps at a time are contracted again until one search is left. Only the audit
itself, one letter a row, is ever held whole. Repeats of a row are counted by a partial
aggregate first, and the duplicate test is a join of narrow rows (skew-split by adaptive
execution). The repaired rows of one conversation come in order out of one task, since the digest of
its text is sequential; they stream through it a batch at a time.

A row's first fault counts: blank (no character but white space 0x20, 0x09-0x0D),
duplicate (its role and text stand earlier in the conversation), truncated (the last such
character is not one of ``.!?``).

Defined results: a null role or text is one space, rows without a conv_id are one
conversation; a null turn comes first and is left out of the gaps; rows of one turn
go by role, then by the MD5 of the text; an empty role has no initial and can't be kept. Texts of
any length are taken whole. A table without rows gives none; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
ROLES = {"u": "user", "a": "assistant"}
#: States of the grammar: nothing yet, after s, after u, after a.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (EMPTY, ASSISTANT)
LEGAL = ("su", "ua", "au")
#: Rows of a block, and steps contracted at a time.
BLOCK, FAN = 256, 64
SPACE = " \t\n\x0b\x0c\r"
#: A row's code: its initial (``o`` if it has no place in the grammar), upper case if truncated; ``x`` if it must go.
GONE, OTHER = "x", "o"

Edge = tuple[int, int, int, str]


class Step:
    """One step of a lattice: edges (state, next state, cost, audit), by either end."""

    def __init__(self, edges: list[Edge]):
        self.out: dict[int, list] = {}
        self.into: dict[int, list] = {}
        for a, b, cost, audit in edges:
            self.out.setdefault(a, []).append((b, cost, audit))
            self.into.setdefault(b, []).append((a, cost, audit))


def row_edges(code: str) -> list[Edge]:
    edges = [(q, q, COST[DELETE], DELETE) for q in range(4)]
    if code != GONE:
        more = TRUNCATED if code.isupper() else 0
        for (q, initial), to in NEXT.items():
            if initial == code.lower():
                edges.append((q, to, COST[KEEP] + more, KEEP))
            elif initial in ROLES:  # rerole to the role that it has costs more than keeping it
                edges.append((q, to, COST[REROLE] + more, REROLE))
    return edges


ROW = {code: Step(row_edges(code)) for code in "xsuaoSUAO"}
INSERTS = Step([(q, to, COST[INSERT], INSERT) for (q, initial), to in NEXT.items() if initial in ROLES])
NO_INSERTS = Step([])


def cheapest(steps: list[Step], inserts: Step, start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Least cost and, of that cost, the ASCII-least audit from (0, start) to (len(steps), one of ends)."""
    last = len(steps)
    labels = ({(0, start): (0, "")}, {(last, q): (0, "") for q in ends})
    # Of equal cost the node nearest to its own side comes first: then a node's audit is final once it is popped.
    heaps = [[(0, 0, start)], [(0, -last, q) for q in ends]]
    heapq.heapify(heaps[1])
    popped: tuple[set, set] = (set(), set())
    best = min((0 for v in labels[0] if v in labels[1]), default=float("inf"))
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        back = int(heaps[1][0][0] < heaps[0][0][0])
        cost, i, q = heapq.heappop(heaps[back])
        i = abs(i)
        if (i, q) in popped[back]:
            continue
        popped[back].add((i, q))
        audit = labels[back][i, q][1]
        if back:
            moves = [(i, *m) for m in inserts.into.get(q, ())] + ([(i - 1, *m) for m in steps[i - 1].into.get(q, ())] if i else [])
        else:
            moves = [(i, *m) for m in inserts.out.get(q, ())] + ([(i + 1, *m) for m in steps[i].out.get(q, ())] if i < last else [])
        for j, to, more, part in moves:
            new = (cost + more, part + audit if back else audit + part)
            old = labels[back].get((j, to))
            if old is None or new < old:
                labels[back][j, to] = new
                if old is None or new[0] < old[0]:
                    heapq.heappush(heaps[back], (new[0], -j if back else j, to))
                other = labels[1 - back].get((j, to))
                if other:
                    best = min(best, new[0] + other[0])
    crossings = [a[1] + b[1] for v, a in labels[0].items() if (b := labels[1].get(v)) and a[0] + b[0] == best]
    return (best, min(crossings)) if crossings else None


@lru_cache(100_000)
def of_codes(codes: str, start: int = EMPTY, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    return cheapest([ROW[c] for c in codes], INSERTS, start, ends)


def contracted(search) -> str:
    """All edges from state to state that ``search`` (start, ends) finds, as JSON text."""
    edges = [(q, to, *found) for q in range(4) for to in range(4) if (found := search(q, (to,)))]
    return json.dumps(edges)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with some rows spoilt, by the CRC32 of ``conv_id:turn`` modulo 20: 0 is
    dropped, 1 emptied, 2 loses its ``.!?``, 3 stands twice, 4 becomes the user's."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    text = F.coalesce(F.col("text"), F.lit(" "))
    at = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), kind.alias("kind")).where("kind != 0")
    at = at.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                   F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", ""))
                   .otherwise(F.col("text")).alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"))
    return at.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times")


def keyed(rows: DataFrame) -> DataFrame:
    """``conv`` (text that names the conversation, also one without an id), ``turn, role, text``."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    return rows.select(conv.alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"))


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows of ``keyed`` rows with their number ``n``, the ``fault`` of the first of them, its ``initial`` and
    ``code``. Only the text's MD5 is carried."""
    ending = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    own = F.when(ending == "", "blank").when(~ending.isin(".", "!", "?"), "truncated").otherwise("none")
    alike = rows.select("conv", "turn", "role", F.md5(F.col("text").cast("binary")).alias("md5"), own.alias("own"))
    alike = alike.groupBy("conv", "turn", "role", "md5", "own").agg(F.count("*").alias("n"))
    turn = F.struct(F.col("turn").isNotNull(), "turn")
    first = alike.groupBy("conv", "role", "md5").agg(F.min(turn).alias("first"))
    at = alike.join(first, ["conv", "role", "md5"])
    fault = F.when(F.col("own") == "blank", "blank").when(turn > F.col("first"), "duplicate").otherwise(F.col("own"))
    at = at.withColumn("fault", fault).withColumn("initial", F.left("role", F.lit(1))).drop("own", "first")
    known = F.when(F.col("initial").isin(*"sua"), F.col("initial")).otherwise(F.lit(OTHER))
    return at.withColumn("code", F.when(F.col("fault").isin("blank", "duplicate"), F.lit(GONE))
                         .when(F.col("fault") == "truncated", F.upper(known)).otherwise(known))


BLOCKS = "conv string, part int, seq long, codes string, first string, last string, illegal long"


def in_order() -> list:
    return ["conv", F.asc_nulls_first("turn"), "role", "md5"]


def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of the rows of a sorted partition; ``illegal`` counts the pairs within the partition that end in the block."""
    out: list[tuple] = []
    now = part = None
    seq = illegal = 0
    codes = first = last = ""

    def close() -> None:
        nonlocal seq, codes, illegal
        if codes:
            out.append((now, part, seq, codes, first, last, illegal))
            seq, codes, illegal = seq + 1, "", 0

    for batch in batches:
        for conv, part_, initial, code, n in zip(*(batch[c] for c in ("conv", "part", "initial", "code", "n")), strict=True):
            if conv != now:
                close()
                now, part, seq, last = conv, part_, 0, None
            while n:
                if not codes:
                    first = initial
                illegal += last is not None and last + initial not in LEGAL
                taken = min(n, BLOCK - len(codes))
                codes += code + GONE * (taken - 1)
                illegal += taken - 1  # a role never follows itself
                last, code, n = initial, GONE, n - taken
                if len(codes) >= BLOCK:
                    close()
        if out:
            yield pd.DataFrame(out, columns=["conv", "part", "seq", "codes", "first", "last", "illegal"])
            out.clear()
    close()
    yield pd.DataFrame(out, columns=["conv", "part", "seq", "codes", "first", "last", "illegal"])


def blocks(at: DataFrame) -> DataFrame:
    """The rows of ``faults`` cut into blocks, numbered from 0 within ``conv``; ``of`` blocks it has."""
    rows = at.repartitionByRange(*in_order()).sortWithinPartitions(*in_order())
    made = rows.select("conv", F.spark_partition_id().alias("part"), "initial", "code", "n").mapInPandas(cut, BLOCKS)
    own = Window.partitionBy("conv").orderBy("part", "seq")
    before = F.lag("last").over(own)
    across = (F.col("seq") == 0) & before.isNotNull() & ~F.concat(before, "first").isin(*LEGAL)
    made = made.select("*", (F.row_number().over(own) - 1).alias("number"), F.count("*").over(Window.partitionBy("conv")).alias("of"),
                       across.cast("long").alias("across"))
    return written(made.withColumn("illegal", F.col("illegal") + F.coalesce("across", F.lit(0))), "conv-blocks")


AUDIT = "conv string, cost long, audit string"
STEPS = "conv string, number long, edges string"


def audits(cuts: DataFrame) -> DataFrame:
    """``conv, cost, audit`` of each conversation of ``blocks``."""

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [of_codes(c) for c in batch["codes"]]
            yield pd.DataFrame({"conv": batch["conv"], "cost": [c for c, _ in found], "audit": [a for _, a in found]})

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            edges = [contracted(lambda q, to, c=c: of_codes(c, q, to)) for c in batch["codes"]]
            yield pd.DataFrame({"conv": batch["conv"], "number": batch["number"].astype("int64"), "edges": edges})

    def steps_of(rows: pd.DataFrame) -> list[Step]:
        return [Step([tuple(e) for e in json.loads(text)]) for text in rows.sort_values("number")["edges"]]

    def joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        steps = steps_of(rows)
        return pd.DataFrame([(key[0], key[1], contracted(lambda q, to: cheapest(steps, NO_INSERTS, q, to)))], columns=["conv", "number", "edges"])

    def ended(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *cheapest(steps_of(rows), NO_INSERTS, EMPTY, ENDS))], columns=["conv", "cost", "audit"])

    single = cuts.where("of = 1").select("conv", "codes").mapInPandas(whole, AUDIT)
    most = cuts.agg(F.max("of")).first()[0] or 0
    if most <= 1:
        return single
    level = cuts.where("of > 1").select("conv", "number", "codes").mapInPandas(each, STEPS)
    while most > FAN:
        grouped = level.groupBy("conv", F.floor(F.col("number") / FAN).alias("number"))
        level, most = written(grouped.applyInPandas(joined, STEPS), "conv-steps"), -(-most // FAN)
    return single.union(level.groupBy("conv").applyInPandas(ended, AUDIT))


def edited(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(conv, role, text, edit) of the repaired rows; (conv, None, None, None) first for each conversation."""
    conv, audit, at, state = None, "", 0, EMPTY

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == INSERT:
            initial = next(x for q, x in NEXT if q == state and x in ROLES)
            at, state = at + 1, NEXT[state, initial]
            yield conv, ROLES[initial], "", INSERT

    for batch in batches:
        for name, kind, role, text in zip(*(batch[c] for c in ("conv", "kind", "role", "text")), strict=True):
            if kind == 0:
                yield from inserted()
                conv, audit, at, state = name, text, 0, EMPTY
                yield conv, None, None, None
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == DELETE:
                continue
            initial = role[0] if edit == KEEP else next(x for q, x in NEXT if q == state and x in ROLES)
            state = NEXT[state, initial]
            yield conv, role if edit == KEEP else ROLES[initial], text, edit
    yield from inserted()


def streamed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one partition."""
    order = F.md5(F.col("text").cast("binary")).alias("md5")
    both = found.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                        F.lit("").alias("md5"), F.col("audit").alias("text"))
    both = both.union(rows.select("conv", F.lit(1), "turn", "role", order, "text"))
    return both.repartition("conv").sortWithinPartitions("conv", "kind", F.asc_nulls_first("turn"), "role", "md5").select(
        "conv", "kind", "role", "text")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv, repaired_sha256``: of the repaired ``role:text`` lines, joined by line breaks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, hashed, lines, out = None, None, 0, []
        for name, role, text, _ in edited(batches):
            if role is None:
                if hashed:
                    out.append((conv, hashed.hexdigest()))
                conv, hashed, lines = name, hashlib.sha256(), 0
            else:
                hashed.update(f"{chr(10) * bool(lines)}{role}:{text}".encode(errors="surrogatepass"))
                lines += 1
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])
                out = []
        yield pd.DataFrame(out + ([(conv, hashed.hexdigest())] if hashed else []), columns=["conv", "repaired_sha256"])

    return streamed(rows, found).mapInPandas(run, "conv string, repaired_sha256 string")


def searched(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The ``faults``, ``blocks`` and ``audits`` of ``keyed`` rows, written."""
    at = written(faults(rows), "conv-faults")
    cuts = blocks(at)
    return at, cuts, written(audits(cuts), "conv-audits")


def repaired(rows: DataFrame) -> DataFrame:
    """The conversations (``conv_id, turn, role, text``) repaired: ``conv_id, place`` (from 0)``, role, text, edit``
    (K, R or I)."""
    _, _, found = searched(keyed(rows))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, out = 0, []
        for conv, role, text, edit in edited(batches):
            if role is None:
                place = 0
                continue
            out.append((conv, place, role, text, edit))
            place += 1
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=["conv", "place", "role", "text", "edit"])
                out = []
        yield pd.DataFrame(out, columns=["conv", "place", "role", "text", "edit"])

    made = streamed(keyed(rows), found).mapInPandas(run, "conv string, place long, role string, text string, edit string")
    id_type = rows.schema["conv_id"].dataType
    conv_id = F.when(F.col("conv") != "", F.expr("substr(conv, 2)")).cast(id_type)
    return made.select(conv_id.alias("conv_id"), "place", "role", "text", "edit")


def report(at: DataFrame, cuts: DataFrame, found: DataFrame) -> DataFrame:
    """``conv`` with the numbers of its faults, the least cost and the audit."""
    is_a = lambda kind: F.col("fault") == kind
    counted = at.groupBy("conv").agg(
        F.sum(F.when(is_a("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(is_a("duplicate"), F.col("n")).when(is_a("blank"), 0).otherwise(F.col("n") - 1)).alias("duplicate"),
        F.sum(is_a("truncated").cast("long")).alias("truncated"))
    turns = at.select("conv", "turn").distinct().groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    pairs = cuts.groupBy("conv").agg(F.sum("illegal").alias("illegal"))
    return counted.join(turns, "conv").join(pairs, "conv").join(found, "conv")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = keyed(damaged(original))
    at, cuts, found = searched(rows)
    ids = original.select("conv_id").distinct()
    ids = ids.withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    out = ids.join(report(at, cuts, found), "conv", "left").join(digests(rows, found), "conv", "left")
    longs = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
