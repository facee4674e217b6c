"""License notices by diagonal voting, with DataFrame functions only.

The hashes of all rolling word grams of all texts are joined to the positions of the templates. A gram at word i of a text that stands
at word j of a template votes for the diagonal i - j. Votes are summed by diagonal; diagonals of one template no more than ``drift``
apart are merged, as a word put in or left out moves the rest of a notice to the next ones; the words behind each vote are
compared, and a merged span counts if the template words it covers are at least ``least`` of the longer of template and span.

A template of fewer than ``GRAM`` words votes by word pairs and is a phrase: each diagonal that all its pairs vote for is a place where its
words stand consecutively. The templates' gram table is built from the templates alone and is broadcast; texts are not
shuffled, only votes and one row per document are, keyed by id and digest.

Defined cases: a null text is empty; a text without words has one row with zero counts and no labels; rows equal in id and text give
equal rows; null ids are kept; an empty table gives an empty result; other columns may have any names.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM, PAIR = 5, 2
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases that name a license, and the opening words of common notices, lower-cased, without punctuation.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc", "licensed under cc by nc 4 0"),
    ("cc", "this work is licensed under a creative commons attribution"),
]
Templates = list[tuple[str, str]]


def words_of(text: Column) -> Column:
    """Runs of letters, digits and all that is not ASCII; A-Z in lower case."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, BETWEEN_WORDS), "")


def gram_size(words: list[str]) -> int:
    return GRAM if len(words) >= GRAM else PAIR


def gram_table(spark: SparkSession, templates: Templates) -> DataFrame:
    """(size, hash, places): where each gram stands in the templates."""
    rows = []
    for number, (_, phrase) in enumerate(templates):
        words = phrase.split(" ")
        size = gram_size(words)
        rows += [(size, number, j, words[j : j + size]) for j in range(len(words) - size + 1)]
    grams = spark.createDataFrame(rows, "size int, template int, at int, gram array<string>")
    return grams.groupBy("size", F.xxhash64(*[F.get("gram", F.lit(i)) for i in range(GRAM)]).alias("hash")).agg(
        F.collect_list(F.struct("template", "at", "gram")).alias("places")
    )


def votes(docs: DataFrame, templates: Templates, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, n_words, template, at, word): a vote per gram found, and per document one row without a template."""
    grams = gram_table(docs.sparkSession, templates)
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest"), words_of(F.col(text)).alias("words"))
    rows = narrow.select("doc_id", "digest", "words", F.size("words").alias("n_words"), F.explode(F.sequence(F.lit(0), F.size("words"))).alias("word"))
    found = []
    for size in sorted({gram_size(phrase.split(" ")) for _, phrase in templates}):
        hashed = F.when(F.col("word") + size <= F.col("n_words"), F.xxhash64(*[F.get("words", F.col("word") + i) for i in range(size)]))
        places = grams.where(F.col("size") == size).select(F.col("hash").alias(f"hash{size}"), F.col("places").alias(f"places{size}"))
        rows = rows.withColumn(f"hash{size}", hashed).join(F.broadcast(places), f"hash{size}", "left")
        found.append(F.col(f"places{size}"))
    last = F.col("word") == F.col("n_words")
    rows = rows.where(reduce(lambda a, b: a | b, [p.isNotNull() for p in found], last))
    whole = "array<struct<template: int, at: int, gram: array<string>>>"
    places = F.concat(*[F.coalesce(p, F.array().cast(whole)) for p in found])
    place = F.explode(F.when(last, F.array(F.lit(None).cast("struct<template: int, at: int, gram: array<string>>"))).otherwise(places))
    rows = rows.select("doc_id", "digest", "n_words", "words", "word", place.alias("place"))
    same = F.slice("words", F.col("word") + 1, F.greatest(F.size("place.gram"), F.lit(0))) == F.col("place.gram")
    return rows.where(F.col("place").isNull() | same).select("doc_id", "digest", "n_words", F.col("place.template").alias("template"), F.col("place.at").alias("at"), "word")


def diagonals(found: DataFrame) -> DataFrame:
    """Votes summed by offset: the template words voted for and the text words they span. Without a template: the rows of the document."""
    offset = (F.col("word") - F.coalesce("at", F.lit(0))).alias("diagonal")
    return found.groupBy("doc_id", "digest", "n_words", "template", offset).agg(
        F.collect_set("at").alias("places"), F.min("word").alias("first"), F.max("word").alias("last"), F.count(F.lit(1)).alias("rows")
    )


def scan(docs: DataFrame, phrases: Templates = PHRASES, notices: Templates = NOTICES, drift: int = 3, least: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its words, the places of phrases, the labels of phrases and of phrases and notices, and the largest share of a template found."""
    templates = [*phrases, *notices]
    lines = diagonals(votes(docs, templates, doc_id, text))
    length = F.element_at(F.array(*[F.lit(len(p.split(" "))) for _, p in templates]), F.col("template") + 1)
    size = F.element_at(F.array(*[F.lit(gram_size(p.split(" "))) for _, p in templates]), F.col("template") + 1)
    label = F.element_at(F.array(*[F.lit(name) for name, _ in templates]), F.col("template") + 1)
    key = ["doc_id", "digest", "n_words"]

    # A document's diagonals of a template in order; a gap wider than the drift begins another span.
    order = Window.partitionBy(*key, "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > drift, F.lit(False))
    marked = lines.withColumn("apart", apart.cast("int"))
    # Phrases are taken by single diagonals, notices by merged ones.
    merged = marked.withColumn("span", F.when(F.col("template") < len(phrases), F.col("diagonal")).otherwise(F.sum("apart").over(order)))
    spans = merged.groupBy(*key, "template", "span").agg(
        F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows")
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda at: F.sequence(at, at + size - 1)))))
    share = covered / F.greatest(length, F.col("last") - F.col("first") + size)
    spans = spans.withColumns({"share": F.when(F.col("template").isNotNull(), share), "label": label})
    base = (F.col("template") < len(phrases)) & (F.col("share") == 1)
    notice = (F.col("template") >= len(phrases)) & (F.col("share") >= least)

    def named(where: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(where, F.col("label")))), ",")

    labelled = spans.groupBy(*key).agg(
        F.max(F.when(F.col("template").isNull(), F.col("rows"))).alias("rows"), F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        named(base).alias("base_labels"), named(base | notice).alias("labels"), F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
    )
    each = labelled.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
