import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from phonesense.llm import licenses

SCHEMA = "doc_id long, text string, size int, words string"
WORDS = re.compile(licenses.WORD)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def run(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lic"))
    spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    return sorted(tuple(r) for r in licenses.op1_license_scan(spark, path).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect())


def brute(rows):
    out = []
    for doc_id, text in rows:
        words, places, labels = WORDS.findall((text or "").translate(LOWER)), [], set()
        for phrase, label in licenses.PHRASES.items():
            own = phrase.split()
            for i in range(len(words) - len(own) + 1):
                if words[i:i + len(own)] == own:
                    places.append(i)
                    labels.add(label)
        out.append((doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    return sorted(out)


def test_base_places(spark, tmp_path_factory):
    rows = [(1, None), (2, ""), (3, "MIT License"), (4, "cc by cc by cc-by-nc"), (5, "GNU general Public license!"),
            (6, "gnu general public"), (7, "the apache é license apache license"), (8, "mit license"), (8, "mit license"),
            (9, "x " * 30000 + "mit license"), (10, "general public license gnu general public license gnu general")]
    assert run(spark, rows, tmp_path_factory) == brute(rows)


def test_empty_table(spark, tmp_path_factory):
    assert run(spark, [], tmp_path_factory) == []


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("gnu general public license apache mit cc by x".split()), max_size=30), min_size=1, max_size=20))
def test_base_places_by_chance(spark, tmp_path_factory, texts):
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert run(spark, rows, tmp_path_factory) == brute(rows)


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3.0"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
    ("licensed under cc by nd", set()),
    # A long wording with words put in and left out is one verified span.
    (licenses.TEMPLATES[1][1].replace("free of charge", "free of any charge at all").replace("sublicense and", "and"), {"mit"}),
    (" ".join(licenses.TEMPLATES[1][1].split()[:15]), set()),
])
def test_wordings(spark, text, labels):
    docs = spark.createDataFrame([(1, "lead in " + text + " and on")], "doc_id long, text string")
    found = [r for r in licenses.scan(docs).collect() if r.k == 4]
    assert {r.label for r in found} == labels
    assert all(0.7 <= r.cover <= 1 and r.first >= 2 for r in found)
    assert len(found) == len(labels)


def test_long_text_with_many_hits(spark, tmp_path_factory):
    """200,000 words with a phrase at every third: a hit carries its own words only."""
    text = "cc by x " * 66_667
    (row,) = run(spark, [(1, text)], tmp_path_factory)
    assert row == (1, 200_001, 66_667, 0, 199_998, "cc-by")
