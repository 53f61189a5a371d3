"""License scans by diagonal voting.

Every rolling word 2-gram and 4-gram of a document is hashed and joined to the
grams of the templates; a hit at word p of the document and word t of the
template is a vote for the diagonal p - t. Votes are kept only if the words
themselves agree with the template's. Votes are counted by diagonal. A phrase
(2-grams) stands where all its grams vote for one diagonal. For a template
(4-grams) diagonals at most ``GAP`` words apart are merged, so that a few words
put in or left out do not split a text, and the span is verified: it must cover
``COVER`` of the template's grams (all of them, for a notice of under ``SHORT``
words, where a version number decides) and be no longer than ``STRETCH`` of its words.

DataFrame functions only; the texts are read and split once. The gram tables
come from the constant templates below, which bounds what is broadcast. Votes
are aggregated by document and diagonal before the shuffle; a document's votes
are in one task before it, as a document is one row.

Defined results: a null or empty text has 0 words and no labels; rows alike in
doc_id and text give one result row each, alike; an empty table gives no rows;
other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, table

# Phrases with their labels, and public license wordings with the
# labels (SPDX style, lower case) that a verified span of them adds.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
            "copies of the software and to permit persons to whom the software is furnished to do so"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the "
                   "license at http www apache org licenses license 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted"),
]
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = 3
COVER = 0.7
SHORT = 16
STRETCH = 1.5


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"))


def hash2(w: Column) -> Column:
    """For each word, the hash of it and the next; null at the last."""
    return F.transform(w, lambda x, i: F.when(i + 1 < F.size(w), F.xxhash64(x, F.get(w, i + 1))))


def hash4(h: Column) -> Column:
    """From those, the hash of four words; null where fewer are left."""
    return F.transform(h, lambda x, i: F.when(F.get(h, i + 2).isNotNull(), F.xxhash64(x, F.get(h, i + 2))))


def templates(spark: SparkSession, phrases: dict[str, str] | None = None, wordings: list | None = None) -> DataFrame:
    """``template, label, k, n, words`` of the phrases (k = 2) and the license wordings (k = 4)."""
    rows = [(label, 2, phrase) for phrase, label in (PHRASES if phrases is None else phrases).items()]
    rows += [(label, 4, text) for label, text in (TEMPLATES if wordings is None else wordings)]
    rows = [(i, *row) for i, row in enumerate(rows)]
    made = spark.createDataFrame(rows, "template int, label string, k int, text string")
    return made.select("template", "label", "k", words(F.col("text")).alias("words")).withColumn("n", F.size("words"))


def gram_table(made: DataFrame, k: int) -> DataFrame:
    """``h<k>, at<k>``: each gram's hash and the array of places it has in templates."""
    grams = made.where(F.col("k") == k).withColumn("h", hash2(F.col("words")))
    grams = grams.withColumn("h", hash4(F.col("h"))) if k == 4 else grams
    grams = grams.select("template", "words", F.posexplode("h").alias("t", "h")).where("h is not null")
    gram = F.array_join(F.slice("words", F.col("t") + 1, F.lit(k)), " ")
    return grams.groupBy(F.col("h").alias(f"h{k}")).agg(F.collect_list(F.struct("template", "t", gram.alias("gram")))
                                                       .alias(f"at{k}"))


def template_hashes(made: DataFrame, k: int) -> list[int]:
    """The distinct gram hashes of the templates, whose number the templates bound."""
    return [r[0] for r in gram_table(made, k).select(f"h{k}").collect()]


def votes(docs: DataFrame, made: DataFrame) -> DataFrame:
    """``doc_id, content, n_words, template, diagonal, places, first, last`` by diagonal, and one
    row for each document with ``template`` null, whose ``rows`` counts its repeats.

    Only places whose hash is one of the templates' leave a document, each with the four words
    there, so a row's size does not depend on the text's."""
    split = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("content"), words(F.col("text")).alias("words"))
    split = split.withColumn("h2", hash2(F.col("words")))
    split = split.withColumn("grams", F.arrays_zip("h2", hash4(F.col("h2")).alias("h4")))
    in2, in4 = template_hashes(made, 2), template_hashes(made, 4)
    placed = F.transform("grams", lambda g, i: F.struct(i.alias("p"), g["h2"].alias("h2"), g["h4"].alias("h4")))
    met = F.filter(placed, lambda g: g["h2"].isin(*in2) | g["h4"].isin(*in4))
    split = split.select("doc_id", "content", "words", F.size("words").alias("n_words"), met.alias("met"))
    own = F.transform("met", lambda g: F.struct(g["p"].alias("p"), g["h2"].alias("h2"), g["h4"].alias("h4"),
                                                F.slice("words", g["p"] + 1, F.lit(4)).alias("here")))
    none = F.struct(F.lit(None).cast("int").alias("p"), F.lit(None).cast("long").alias("h2"), F.lit(None).cast("long").alias("h4"),
                    F.lit(None).cast("array<string>").alias("here"))
    rolled = split.select("doc_id", "content", "n_words", F.concat(F.array(none), own).alias("places"))
    # Outer, though never empty: else a filter on the size would be inferred and pushed below the words, into the lambdas.
    rolled = rolled.select("doc_id", "content", "n_words", F.explode_outer("places").alias("g")).select("doc_id", "content", "n_words", "g.*")
    hit = rolled.join(F.broadcast(gram_table(made, 2)), "h2", "left").join(F.broadcast(gram_table(made, 4)), "h4", "left")
    vote = "array<struct<template:int,t:int,k:int>>"

    def agreeing(at: str, k: int) -> Column:
        own = F.array_join(F.slice("here", F.lit(1), F.lit(k)), " ")
        found = F.filter(F.col(at), lambda x: x["gram"] == own)
        return F.coalesce(F.transform(found, lambda x: F.struct(
            x["template"].alias("template"), x["t"].alias("t"), F.lit(k).alias("k"))), F.array().cast(vote))

    none = F.struct(F.lit(None).cast("int").alias("template"), F.lit(None).cast("int").alias("t"),
                    F.lit(None).cast("int").alias("k"))
    own = F.when(F.col("p").isNull(), F.array(none)).otherwise(F.array().cast(vote))
    hit = hit.select("doc_id", "content", "n_words", F.coalesce(F.col("p"), F.lit(0)).alias("at"),
                     F.explode(F.concat(own, agreeing("at2", 2), agreeing("at4", 4))).alias("v"))
    return hit.groupBy("doc_id", "content", "v.template", (F.col("at") - F.col("v.t")).alias("diagonal")).agg(
        F.max("n_words").alias("n_words"), F.collect_set("v.t").alias("places"), F.min("at").alias("first"),
        F.max(F.col("at") + F.col("v.k")).alias("last"), F.count("*").alias("rows"))


def spans(voted: DataFrame, made: DataFrame) -> DataFrame:
    """``voted`` with neighbouring diagonals of a wording merged and each span verified: adds
    ``label, base, cover``; the documents' own rows pass."""
    voted = voted.join(F.broadcast(made.select(F.col("template"), "label", "k", F.col("n").alias("length"))), "template", "left")
    by = Window.partitionBy("doc_id", "content", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by) > F.when(F.col("k") == 4, GAP).otherwise(0)
    voted = voted.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int"))
    voted = voted.withColumn("span", F.sum("apart").over(by))
    merged = voted.groupBy("doc_id", "content", "template", "label", "k", "length", "span").agg(
        F.max("n_words").alias("n_words"), F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"),
        F.min("diagonal").alias("start"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.max("rows").alias("rows"))
    merged = merged.withColumn("cover", F.col("covered") / (F.col("length") - F.col("k") + 1))
    whole = (F.col("k") == 2) & (F.col("cover") >= 1)
    near = (F.col("k") == 4) & (F.col("cover") >= F.when(F.col("length") < SHORT, 1.0).otherwise(COVER)) & (F.col("last") - F.col("first") <= F.col("length") * STRETCH)
    return merged.where(F.col("template").isNull() | whole | near)


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, wordings: list | None = None) -> DataFrame:
    """Verified spans of license phrases and wordings, ``doc_id, content, label, k, first, last, cover``."""
    made = templates(docs.sparkSession, phrases, wordings)
    return spans(votes(docs, made), made)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.col("k") == 2
    own = F.col("template").isNull()
    names = lambda only: F.array_join(F.array_sort(F.collect_set(only)), ",")
    per_doc = found.groupBy("doc_id", "content").agg(
        F.max("n_words").cast("long").alias("n_words"), F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        names(F.when(base, F.col("label"))).alias("base_labels"), names(F.col("label")).alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        F.max(F.when(own, F.col("rows"))).alias("rows"))
    return per_doc.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows")))).drop("rows", "row", "content")
