"""The pipeline stage by stage on a small table, each against plain Python on what the stage was given."""

import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from phonesense.llm import pii

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents():
    rng = random.Random(4)
    pool = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(3000)]
    rows = []
    for i in range(400):
        text = " ".join(rng.choices(pool, k=rng.randint(20, 120))).capitalize() + "."
        if i % 9 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if i % 11 == 0:
            text += f" write to user{i}@mail.example.org"
        rows.append((i, text, "en", "ab"[i % 3 == 0], len(text)))
    rows += [(1000 + i, rows[2][1], "en", "c", 5) for i in range(30)]  # exact copies
    rows += [(2000 + i, rows[4][1] + f" tail{i}", "en", "c", 5) for i in range(5)]  # near copies
    rows += [(3000, None, None, None, None), (3001, "", "en", None, 0), (None, "a text that has no id but words enough", "en", "a", 4), rows[7], rows[7]]
    return rows


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    rows = documents()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 0 if r[1].isupper() else 1, 0) for r in rows[:400]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        given = docs
        stage(spark, docs, path).write.parquet(f"{path}/out{i}")
        docs = spark.read.parquet(f"{path}/out{i}")
        out.append((given.collect(), docs))
    return path, out


def test_stages_are_as_listed():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "near-duplicates", "personal data", "mix sources", "packing"]


def test_all_but_the_last_keep_the_columns(stages):
    for _, docs in stages[1][:-1]:
        assert docs.columns == COLUMNS


def test_quality_rejects_what_shouts(stages):
    given, docs = stages[1][0]
    kept = Counter(r.doc_id for r in docs.collect())
    clean = Counter(r.doc_id for r in given if r.text and not r.text.isupper())
    assert not [i for i in range(0, 400, 9) if i % 11 and kept[i]]  # those with an address are not all capitals
    assert sum((clean - kept).values()) <= 2


def test_near_duplicates_leave_one(stages):
    given, docs = stages[1][1]
    rows = docs.collect()
    kept = Counter(r.doc_id for r in rows)
    assert kept[2] == 1 and not any(kept[1000 + i] for i in range(30)) and not any(kept[2000 + i] for i in range(5))
    assert kept[7] == 1 and kept[None] == 1
    assert {r.doc_id for r in given if r.doc_id is not None and r.doc_id < 1000} == {i for i in kept if i is not None and i < 1000}
    before = {r.doc_id: tuple(r) for r in given}
    assert all(tuple(r) == before[r.doc_id] for r in rows)


def test_personal_data_goes(stages):
    given, docs = stages[1][2]
    rows = {r.doc_id: r for r in docs.collect()}
    assert Counter(r.doc_id for r in given) == Counter(r.doc_id for r in docs.collect())
    for r in given:
        own, text = pii.entities(r.text or ""), rows[r.doc_id].text
        if own:
            assert "@" not in text and "[EMAIL]" in text and rows[r.doc_id].n_chars == len(text)
    assert sum(rows[r.doc_id].text == r.text for r in given) > 0.8 * len(given)


def test_mix_meets_the_targets(stages):
    given, docs = stages[1][3]
    size = lambda t: len([w for w in (t or "").split()])
    before, after = defaultdict(int), defaultdict(int)
    for r in given:
        before[r.source] += size(r.text)
    times = Counter(r.doc_id for r in docs.collect())
    for r in docs.collect():
        after[r.source] += size(r.text)
    assert set(times) <= {r.doc_id for r in given} and max(times.values()) <= 3
    from test_mixing_sharding import brute_targets
    for source, target in brute_targets(before).items():
        assert abs(after[source] - target) <= 200


def test_packing_holds_every_token(stages):
    given, docs = stages[1][4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in given)
    rows = docs.collect()
    assert sum(r.length for r in rows) == want
    held = defaultdict(int)
    for r in rows:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 1024


def test_run_equals_the_stages(spark, stages):
    path, out = stages
    key = lambda r: (r.doc_id, r.doc_tokens)
    ran = corpus_pipeline.run(spark, path).collect()
    assert sum(r.length for r in ran) == sum(r.length for r in out[-1][1].collect())
    assert set(map(key, ran)) == set(map(key, out[-1][1].collect()))
