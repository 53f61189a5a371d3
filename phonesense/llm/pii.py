"""Personal data: pattern spans, and information-theoretic sanitisation of terms that give them away.

Entities (e-mail and IP addresses, card and phone numbers) are found by pattern
in every whole text. The corpus then tells how much a term discloses: an entity
e holds log2(N / n_e) bits, and seeing term t near it leaves -log2(n_te / n_t)
of them open, where n counts distinct texts: exact copies are one, as copying
alone is no evidence. For the share n_te / n_t stands the lower end of its Wilson
interval at ``Z`` standard errors, so few texts tell less than many with the same
share. A term that discloses at least ``DISCLOSES`` of an entity's bits is marked
wherever it occurs: generalised, or removed from ``REMOVES`` on. In one text every
word of its own stands near the entity, so a pair counts from its second text on.

Three scans: one finds the entities and the terms near them, one counts the
texts of the terms that could disclose enough, one places the few that do. Terms go to the tasks in slices of about ``SLICE``, one pass for each slice,
so what is broadcast stays bounded whatever the corpus. The patterns need time
in proportion to the text, long runs included. All counts are grouped with
partial sums; no group of rows is held in one task. Contents with copies are known to
the tasks by a bitmap of ``BUCKETS`` bits; what shares a bit goes through a shuffle of
(content, term), all else is added up in the task.

Defined results: a null text counts as empty and has no spans; rows alike are
judged alike, each with its own result row; an empty table gives no rows; other
columns are left out of ``find`` and kept by ``sanitise``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, table, written

KINDS = ["email", "ip", "card", "phone"]
TERM_KIND = "term"
NEAR = 8
Z = 1.0
DISCLOSES = 0.9
REMOVES = 0.97
SLICE = 200_000
BUCKETS = 1 << 22

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# Runs are taken whole and start where no digit stands before, which is where the leftmost match starts.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]{3,}")
RUN = re.compile(r"\S+")
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (found := DOMAIN.match(text, at + 1)):
            yield start, found.end()
            free = found.end()
        else:
            free = at + 1  # a local part never reaches over this sign
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    twice = [int(x) * 2 for x in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(x - 9 * (x > 9) for x in twice)) % 10 == 0


def entities(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` by start, then kind as listed; kinds as indexes in KINDS."""
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def near(text: str, spans: list[tuple[int, int, int]], reach: int = NEAR) -> set[tuple[int, str]]:
    """Entity hash and term, for the terms within ``reach`` words of an entity."""
    number = lambda x: int.from_bytes(hashlib.blake2b(x.encode(errors="replace"), digest_size=8).digest(), "big", signed=True)
    out = set()
    words = [m.span() for m in RUN.finditer(text)]
    starts, ends = [a for a, _ in words], [b for _, b in words]
    for start, kind, end in spans:
        entity = number(KINDS[kind] + ":" + text[start:end].translate(ASCII_LOWER))
        upto, past = bisect_left(starts, start), bisect_right(ends, end)
        around = [text[a:min(b, start)] for a, b in words[max(0, upto - reach):upto]] + [text[max(a, end):b] for a, b in words[past:past + reach]]
        out |= {(entity, term) for word in around for term in TERM.findall(word.translate(ASCII_LOWER))}
    return out


FOUND = ("doc_id long, content string, spans array<struct<start:int,kind:int,end:int>>, "
         "near array<struct<entity:long,term:string>>")


def find_entities(docs: DataFrame) -> DataFrame:
    """``doc_id, content, spans, near``, written: the first scan."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [x if isinstance(x, str) else "" for x in batch["text"]]
            spans = [entities(x) for x in texts]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "content": batch["content"],
                "spans": [[{"start": s, "kind": k, "end": e} for s, k, e in x] for x in spans],
                "near": [[{"entity": e, "term": w} for e, w in sorted(near(t, x))] if x else []
                         for t, x in zip(texts, spans, strict=True)]})

    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("content"),
                               "text").mapInPandas(find, FOUND), "pii-found")


HITS = "content string, terms array<struct<term:string,start:int,end:int>>"


def sliced(docs: DataFrame, terms: DataFrame, size: int, run, schema: str) -> DataFrame:
    """``run(batches, terms)`` over ``docs`` with the terms sent out as a set, in as many passes as
    it takes for none to send more than about ``size`` terms."""
    slices = max(1, -(-terms.count() // size))
    out = None
    for i in range(slices):
        own = terms.where(F.pmod(F.xxhash64("term"), F.lit(slices)) == i)
        sent = docs.sparkSession.sparkContext.broadcast(frozenset(own.toArrow()["term"].to_pylist()))
        part = docs.mapInPandas(lambda batches, sent=sent: run(batches, sent.value), schema)
        out = part if out is None else out.unionByName(part)
    return out


def bucket(content: Column) -> Column:
    return F.pmod(F.xxhash64(content), F.lit(BUCKETS)).cast("int")


def copied(found: DataFrame) -> np.ndarray:
    """Bits of the buckets of all contents that more than one row has, packed."""
    again = found.groupBy("content").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    bits = np.zeros(BUCKETS, bool)
    bits[again.select(bucket(F.col("content")).alias("b")).distinct().toArrow()["b"].to_numpy()] = True
    return np.packbits(bits)


def count_terms(docs: DataFrame, terms: DataFrame, size: int = SLICE, copies: np.ndarray | None = None) -> DataFrame:
    """``term, n_t``: in how many rows of ``docs`` each of the terms stands; with the bits of
    ``copied``, in how many distinct texts."""
    sent = docs.sparkSession.sparkContext.broadcast(np.zeros(BUCKETS // 8, np.uint8) if copies is None else copies)

    def run(batches: Iterator[pd.DataFrame], own: frozenset) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        bits, done = sent.value, set()
        for batch in batches:
            rows = []
            at = batch["bucket"].fillna(0).to_numpy(np.int64)
            again = bits[at >> 3] >> (7 - (at & 7)) & 1
            for text, content, many in zip(batch["text"], batch["content"], again, strict=True):
                if own and isinstance(text, str) and not (many and content in done):
                    here = own.intersection(TERM.findall(text.translate(ASCII_LOWER)))
                    if many:
                        if len(done) >= 100_000:
                            done.clear()
                        done.add(content)
                        rows += [(content, term, 1) for term in here]
                    else:
                        held.update(here)
            yield pd.DataFrame(rows, columns=["content", "term", "n"])
        yield pd.DataFrame([(None, *x) for x in held.items()], columns=["content", "term", "n"])

    content = F.md5(F.col("text").cast("binary"))
    counted = sliced(docs.select("text", content.alias("content"), bucket(content).alias("bucket")), terms, size, run,
                     "content string, term string, n long")
    counted = counted.groupBy("content", "term").agg(F.sum("n").alias("n"))
    return counted.groupBy("term").agg(F.sum(F.when(F.col("content").isNull(), F.col("n")).otherwise(1)).alias("n_t"))


def place_terms(docs: DataFrame, terms: DataFrame, size: int = SLICE) -> DataFrame:
    """``content, terms``: where the terms stand in each text, one row for each row of ``docs``
    and slice that has any."""

    def run(batches: Iterator[pd.DataFrame], own: frozenset) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for content, text in zip(batch["content"], batch["text"], strict=True):
                text = text.translate(ASCII_LOWER) if isinstance(text, str) else ""
                if own and not own.isdisjoint(TERM.findall(text)):
                    rows.append((content, [{"term": m[0], "start": m.start(), "end": m.end()}
                                           for m in TERM.finditer(text) if m[0] in own]))
            yield pd.DataFrame(rows, columns=["content", "terms"])

    texts = docs.select(F.md5(F.col("text").cast("binary")).alias("content"), "text")
    return sliced(texts, terms, size, run, HITS)


def least_share(k: Column, n: Column) -> Column:
    """Lower end of the Wilson interval of k / n."""
    p, z = k / n, Z * Z
    return (p + z / (2 * n) - Z * F.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)


def disclosures(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``term, disclosure``: the largest share of an entity's bits that a term gives away, for the
    terms that give away enough of one; written."""
    seen = written(found.where(F.size("near") > 0).select("content", "near").dropDuplicates(["content"]).select("near"), "pii-seen")
    n = found.select("content").distinct().count()
    entities = seen.select(F.explode(F.array_distinct(F.transform(
        "near", lambda p: p["entity"]))).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e"))
    together = seen.select(F.explode("near").alias("p")).groupBy("p.entity", "p.term").agg(F.count("*").alias("n_te"))
    bits = F.log2(n / F.col("n_e"))
    share = lambda n_t: F.when(bits > 0, 1 + F.log2(least_share(F.col("n_te"), n_t)) / F.nullif(bits, F.lit(0.0)))
    # No term stands in fewer texts than near the entity: what isn't enough then never is.
    joint = together.where(F.col("n_te") > 1).join(entities, "entity").where(share(F.col("n_te")) >= DISCLOSES)
    joint = written(joint, "pii-joint")
    terms = written(joint.select("term").distinct(), "pii-terms")
    told = joint.join(count_terms(docs, terms, copies=copied(found)), "term")
    told = told.groupBy("term").agg(F.max(share(F.greatest("n_te", "n_t"))).alias("disclosure")).where(F.col("disclosure") >= DISCLOSES)
    return written(told, "pii-disclosures")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, content, spans, terms`` (array of start, end, removed) for each row of ``docs``."""
    found = find_entities(docs)
    told = disclosures(docs, found)
    hits = place_terms(docs, told.select("term"))
    placed = hits.select("content", F.explode("terms").alias("h")).select("content", "h.*").distinct().join(told, "term")
    placed = placed.groupBy("content").agg(F.sort_array(F.collect_set(F.struct(
        "start", "end", (F.col("disclosure") >= REMOVES).alias("removed")))).alias("terms"))
    out = found.join(placed, "content", "left")
    # A term inside an entity's span is marked with it.
    free = F.filter(F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,removed:boolean>>")),
                    lambda t: ~F.exists("spans", lambda s: (t["start"] < s["end"]) & (s["start"] < t["end"])))
    return out.select("doc_id", "content", "spans", free.alias("terms"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with entities replaced by their kind, disclosing terms by [TERM] or nothing, and
    ``n_chars`` brought up to date where there is such a column; all other columns as they are."""
    marks = find(docs).where((F.size("spans") > 0) | (F.size("terms") > 0)).select(
        F.col("content").alias("_content"), F.col("spans").alias("_spans"), F.col("terms").alias("_terms")).dropDuplicates(["_content"])

    @F.pandas_udf("string")
    def replaced(text: pd.Series, spans: pd.Series, terms: pd.Series) -> pd.Series:
        out = []
        for x, own, more in zip(text, spans, terms, strict=True):
            if isinstance(x, str):
                marks = [(s["start"], s["end"], f"[{KINDS[s['kind']].upper()}]") for s in (own if own is not None else [])]
                marks += [(t["start"], t["end"], "" if t["removed"] else "[TERM]") for t in (more if more is not None else [])]
                parts, at = [], 0
                for start, end, by in sorted(marks):
                    if start >= at:  # an entity inside another's span goes with it
                        parts += [x[at:start], by]
                    at = max(at, end)
                x = "".join([*parts, x[at:]])
            out.append(x)
        return pd.Series(out, dtype=object)

    # The row stays in one struct, so that its columns meet none of those added here.
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.md5(F.col("text").cast("binary")).alias("_content"))
    rows = rows.join(marks, "_content", "left")
    rows = rows.select("row", F.col("_spans").isNotNull().alias("marked"), replaced("row.text", "_spans", "_terms").alias("new"))
    out = {c: F.col("row")[c] for c in names}
    out["text"] = F.col("new")
    if "n_chars" in names:
        length = F.length("new").cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(F.col("marked"), length).otherwise(out["n_chars"])
    return rows.select(*[x.alias(c) for c, x in out.items()])


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    text = lambda x, kind: F.concat_ws(":", kind, x["start"].cast("string"), x["end"].cast("string"))
    base = F.array_join(F.transform("spans", lambda s: text(s, F.get(kinds, s["kind"]))), ",")
    every = F.array_sort(F.concat(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))),
        F.transform("terms", lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), t["end"].alias("end")))))
    named = F.transform(every, lambda s: text(s, F.get(F.array(*[F.lit(k) for k in [*KINDS, TERM_KIND]]), s["kind"])))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        F.array_join(named, ",").alias("spans"), F.size("terms").cast("long").alias("n_term"))
