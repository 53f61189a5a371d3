import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from phonesense.llm import packing

TEXTS = [None, "", " ", "a", "Hello  world", "tabs\tand\n\nlines \n here", "it's we'll 'quoted'", "no break space",
         "trailing ", " leading", "x" * 5000, "né à la carte — “quotes” 日本語 text", "<|endoftext|> inside", "a b c",
         "end\n", "12 345 6,789.0 $%^", "\u0085next", "word " * 3000, "line\nline\nline", "\x1c\x1d sep", "emoji 👍🏽 ok"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_encoder_equals_the_tokenizer(tokenizer):
    encode, rng = packing.Encoder(), random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "1", "!", "'s", " ", "日", "\r\n", "."]
    texts = [x for x in TEXTS if x is not None] + ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_round_trip(spark, tmp_path, tokenizer):
    rows = [(i, t, 1, "x") for i, t in enumerate(TEXTS * 4)] + [(None, "no id", 1, "x")]
    schema = "doc_id long, text string, start int, sequence_id string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = packing.op2_packing(spark, str(tmp_path)).collect()
    windows, docs = defaultdict(list), defaultdict(list)
    for r in out:
        windows[r.sequence_id].append(r)
        docs[r.doc_id].append(r)
    short = 0
    for pieces in windows.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 1024 and {r.sequence_length for r in pieces} == {at}
        short += at < 1024
    assert short <= 3  # one for each partition
    for doc, text in [(r[0], r[1]) for r in rows]:
        want, at = ids(tokenizer, text), 0
        for r in sorted(docs[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(np.array(want[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want)


def brute(items, size):
    """The sum-of-squares rule stated plainly, as the levels after each item."""
    count, out = defaultdict(int), []
    for s in items:
        best = None
        for h in [0, *sorted(h for h, n in count.items() if n and h + s <= size)]:
            new = dict(count)
            if h:
                new[h] -= 1
            if h + s < size:
                new[h + s] = new.get(h + s, 0) + 1
            cost = sum(n * n for n in new.values())
            if best is None or cost < best[0]:
                best = cost, new
        count = defaultdict(int, best[1])
        out.append({h: n for h, n in count.items() if n})
    return out


@pytest.mark.parametrize("seed", range(5))
def test_placement_is_sum_of_squares(seed):
    rng = random.Random(seed)
    items = [rng.randint(1, 12) for _ in range(150)]
    packer = packing.Packer(12)
    for s, levels in zip(items, brute(items, 12), strict=True):
        packer.place((s,), s)
        assert {int(h): int(packer.count[h]) for h in np.flatnonzero(packer.count)} == levels


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert packing.op2_packing(spark, str(tmp_path)).collect() == []
