"""Licence scan by diagonal voting.

Every run of ``GRAM`` words of a text is hashed and joined with the places where a template has
the same words. A hit at word d of the text and word t of the template votes for the diagonal
d - t. A phrase is found where one diagonal holds all its votes. For a longer notice, diagonals
next to each other are merged (words put in or left out move the rest to another diagonal), and
a merged span counts if enough of the notice is in it and it isn't much longer than the notice.

Templates are a parameter of a few kilobytes, so their places are broadcast; only hits are
shuffled, by document. Built-in functions only.

Defined results: a null text is empty; a row is known by its id and the hash of its text, so
repeated rows each get the same result; a null id works as any other; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from joinscope.llm.common import ascii_lower, text_or_empty

GRAM = 3
#: Share of a notice's word runs that a span must hold, words by which neighbouring diagonals may
#: differ, and the length of a span against its notice.
COVERAGE, BAND, STRETCH = 0.6, 4, 1.5

# What a word is, and the phrases that name a licence.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notices as people put them into files; the label of the licence follows.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 you may not use this file except in compliance with the license": "apache-2",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
}


def _gram_hash(w: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(w, i + k) for k in range(GRAM)])


def _grams(w: Column) -> Column:
    none = F.array().cast("array<bigint>")
    return F.when(F.size(w) < GRAM, none).otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - GRAM), lambda i: _gram_hash(w, i)))


def template_places(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """Hash, template, place, label, word runs of the template and whether it is a phrase."""
    rows = [(k, t.split(), label, k < len(phrases)) for k, (t, label) in enumerate([*phrases.items(), *notices.items()])]
    if short := [r for r in rows if len(r[1]) < GRAM]:
        raise ValueError(f"templates need {GRAM} words at least: {short}")
    # many templates share a run of words, but none counts twice for one place of a text
    return spark.createDataFrame(rows, "template int, w array<string>, label string, phrase boolean").select(
        "template", "label", "phrase", (F.size("w") - GRAM + 1).alias("runs"), F.posexplode(_grams(F.col("w"))).alias("t", "gram")
    )


def hits(docs: DataFrame, id_col: str, text_col: str, places: DataFrame) -> DataFrame:
    """Distinct (doc, digest, template, t, d): the text has the template's words of t at d."""
    text = text_or_empty(text_col)
    w = F.array_remove(F.split(ascii_lower(text), NO_WORD), "")
    grams = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("digest"), w.alias("w"))
    grams = grams.select("doc", "digest", F.posexplode(_grams(F.col("w"))).alias("d", "gram"))
    return grams.join(F.broadcast(places), "gram").drop("gram").distinct()


def spans(found: DataFrame) -> DataFrame:
    """(doc, digest, phrase, label, first, last, coverage) of each verified span, in words."""
    diagonal = (F.col("d") - F.col("t")).alias("diagonal")
    votes = found.withColumn("diagonal", diagonal)
    key = ["doc", "digest", "template", "label", "phrase", "runs"]
    exact = (
        votes.where("phrase")
        .groupBy(*key, "diagonal")
        .agg(F.count("*").alias("n"))
        .where("n = runs")
        .select("doc", "digest", "phrase", "label", F.col("diagonal").alias("first"), (F.col("diagonal") + F.col("runs") + GRAM - 2).alias("last"), F.lit(1.0).alias("coverage"))
    )
    along = Window.partitionBy("doc", "digest", "template").orderBy("diagonal", "d")
    island = F.sum(F.when(F.col("diagonal") - F.lag("diagonal", 1).over(along) > BAND, 1).otherwise(0)).over(along)
    merged = (
        votes.where("not phrase")
        .withColumn("island", island)
        .groupBy(*key, "island")
        .agg(F.size(F.collect_set("t")).alias("n"), F.min("d").alias("first"), (F.max("d") + GRAM - 1).alias("last"))
        .withColumn("coverage", F.col("n") / F.col("runs"))
        .where((F.col("coverage") >= COVERAGE) & (F.col("last") - F.col("first") + 1 <= STRETCH * (F.col("runs") + GRAM - 1) + BAND))
        .select("doc", "digest", "phrase", "label", "first", "last", "coverage")
    )
    return exact.unionByName(merged)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row for each row of ``docs``: the id, ``n_words``, ``spans`` and the sums over them.

    ``spans``: array of (phrase, label, first, last, coverage), null if there is none.
    """
    found = spans(hits(docs, id_col, text_col, template_places(docs.sparkSession, phrases, notices)))
    on_phrase = lambda c: F.when(F.col("phrase"), F.col(c))
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    by_doc = found.groupBy("doc", "digest").agg(
        F.count(on_phrase("first")).alias("n_base"),
        F.min(on_phrase("first")).cast("long").alias("first_word"),
        F.max(on_phrase("first")).cast("long").alias("last_word"),
        labels(on_phrase("label")).alias("base_labels"),
        labels("label").alias("labels"),
        F.max("coverage").alias("score"),
        F.array_sort(F.collect_list(F.struct("phrase", "label", "first", "last", "coverage"))).alias("spans"),
    )
    text = text_or_empty(text_col)
    all_ = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("own"), F.regexp_count(text, F.lit(WORD_ANY_CASE)).cast("long").alias("n_words"))
    joined = all_.join(by_doc, F.col("id").eqNullSafe(F.col("doc")) & (F.col("own") == F.col("digest")), "left")
    return joined.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_labels", "labels")],
        F.coalesce("score", F.lit(0.0)).alias("score"),
        "spans",
    )
