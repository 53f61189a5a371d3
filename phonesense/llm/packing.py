"""Packing documents into windows of at most 1024 tokens by sum-of-squares placement.

A document's whole windows stand alone; its rest is one item. Items are placed
online: each goes to the fill level (or a new window) after which the sum of
the squared counts of partially filled windows, by level, is smallest. The
counts are a level array, and the open windows of each level a stack. The few
windows still open at the end of a partition are poured together and cut anew,
so a partition leaves at most one window short.

One pass over the scan, without a shuffle: each partition is packed by its own
task, and a window's id is the partition's number and a count within it. A task
holds one Arrow batch and the windows still open, whose number grows with the
root of the items at most; a retried task gives the same rows.

Defined results: a null text counts as empty and is one token, id 0; texts of
any length are cut; an empty table gives no rows; rows alike are packed each by
itself; other columns of the input are left out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

WINDOW = 1024
VOCABULARY = "byte_bpe_50k"
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_length long")
#: Words whose ids a task remembers before it starts anew.
REMEMBERED = 300_000
SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, by a public byte-level BPE vocabulary.

    The vocabulary's pattern never joins a letter, number or sign with a space that
    follows it, so a text whose white space stands alone falls apart at its spaces into
    words that are encoded by themselves and remembered; other texts, and those that
    hold the special token, are encoded whole."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.words = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.runs = re.compile(r"\s\s")
        self.known: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not text or text[-1].isspace() or self.runs.search(text):
            return np.array(self.words.encode_ordinary(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        parts = [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]
        known = self.known
        out = list(map(known.get, parts))
        if None in out:
            if len(known) > REMEMBERED:
                known.clear()
            for i, x in enumerate(out):
                if x is None:
                    part = parts[i]
                    if (x := known.get(part)) is None:
                        x = known[part] = np.array(self.words.encode_ordinary(part), "<u4").tobytes()
                    out[i] = x
        return b"".join(out)


class Packer:
    """Windows of ``size`` tokens, filled online by the sum-of-squares rule."""

    def __init__(self, size: int = WINDOW):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)  # open windows by level; 0 and full never count
        self.open: dict[int, list[list]] = {}

    def place(self, item, length: int) -> list | None:
        """Puts the item in a window; gives the window when that fills it."""
        count, top = self.count, self.size - length
        # Moving a window from level h to h + length changes the sum by 2 (N[h + length] - N[h]) + 2,
        # a new window by 2 N[length] + 1; a full window leaves the sum.
        change = 2 * (count[length:] - count[:top + 1]) + 2
        change[0] = 2 * count[length] + 1
        change[top] = -2 * count[top] + 1
        if top == 0:
            return [item]
        change[1:][count[1:top + 1] == 0] = np.iinfo(np.int64).max
        level = int(change.argmin())
        if level:
            window = self.open[level].pop()
            count[level] -= 1
        else:
            window = []
        window.append(item)
        if level == top:
            return window
        self.open.setdefault(level + length, []).append(window)
        count[level + length] += 1
        return None

    def rest(self) -> Iterator:
        for level in sorted(self.open, reverse=True):
            for window in self.open[level]:
                yield from window


def pack_rows(batches: Iterator[pd.DataFrame], encode, size: int, base: int) -> Iterator[pd.DataFrame]:
    """Pieces of the documents of one partition; window ids count up from ``base``."""
    packer, ids = Packer(size), base
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def frame(windows: list[list]) -> pd.DataFrame:
        nonlocal ids
        out = []
        for window in windows:
            total, offset = sum(x[2] for x in window), 0
            for doc, start, length, crc, tokens in window:
                out.append((doc, start, length, crc, tokens, ids, offset, total))
                offset += length
            ids += 1
        made = pd.DataFrame(out, columns=names)
        made["doc_id"] = made["doc_id"].astype("Int64")
        return made

    def piece(doc, data: bytes, tokens: int, start: int, length: int) -> tuple:
        return doc, start, length, zlib.crc32(data[4 * start:4 * (start + length)]), tokens

    held: dict[int, bytes] = {}  # ids of the open items, for cutting them anew
    number = 0
    for batch in batches:
        full = []
        for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
            doc = None if pd.isna(doc) else int(doc)
            data = encode(text if isinstance(text, str) else "") + b"\0\0\0\0"
            tokens = len(data) // 4
            whole = tokens - tokens % size
            full += [[piece(doc, data, tokens, at, size)] for at in range(0, whole, size)]
            if tokens > whole:
                held[number] = data[4 * whole:]
                done = packer.place((number, doc, whole, tokens), tokens - whole)
                number += 1
                if done:
                    full.append([(d, s, t - s, zlib.crc32(held.pop(n)), t) for n, d, s, t in done])
        if full:
            yield frame(full)
    windows, room = [], 0
    for n, doc, start, tokens in packer.rest():
        data, at = held.pop(n), 0
        while 4 * at < len(data):
            if not room:
                windows.append([])
                room = size
            length = min(room, len(data) // 4 - at)
            windows[-1].append((doc, start + at, length, zlib.crc32(data[4 * at:4 * (at + length)]), tokens))
            at += length
            room -= length
    if windows:
        yield frame(windows)


def pack(docs: DataFrame, size: int = WINDOW, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each piece of a document, with its window (``sequence_id``) and place there."""

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return pack_rows(batches, Encoder(vocabulary), size, TaskContext.get().partitionId() << 33)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(packed, SCHEMA)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
