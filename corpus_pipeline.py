"""The corpus pipeline: documents -> packed token windows, in five written stages.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's rows as Parquet in the shared checkpoint folder and reads them back as
the next stage's documents, so a lost executor costs tasks of one stage only.
All stages but the last return the columns of ``documents``; what each does with
nulls, empty texts and repeated rows is stated in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phonesense.llm import mixing, neardup, packing, pii, quality
from phonesense.llm.common import table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (word 5-shingles, similarity of 0.8 or more)."""
    return neardup.one_of_each(docs, k=5)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it replaced in the texts."""
    return pii.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents as often as its target weight asks, shuffled shard by shard."""
    return mixing.mix(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in windows of at most 1024."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("personal data", sanitise),
    ("mix sources", mix_sources),
    ("packing", pack),
]

#: The classifier, the sketches and the tokenizer can't be expressed in SQL; tests hold each stage
#: against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
