"""Licence scans over a positional index of licence words, in DataFrame operations only.

Licence templates are indexed by word and position. All licence words of a text are looked
up; each posting votes for the place where its template would begin. Where enough of them
agree on one place, the template's mandatory key phrases must stand there too.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import staged

#: Everything but digits, a-z and non-ASCII characters separates words, after A-Z were lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Places where so many licence words agree are candidates (fewer, if the template has fewer).
AGREEING = 2

#: Phrases whose places are counted, and their labels.
BASE_PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key_phrases: tuple[str, ...]  # each stands in ``text``, and must stand at its place in a file


#: Well-known licence notices.
TEMPLATES = [
    Template("mit-notice", "Released under the MIT License", ("mit license",)),
    Template("mit-text", "Permission is hereby granted free of charge to any person obtaining a copy of this "
             "software and associated documentation files the Software to deal in the Software without restriction",
             ("hereby granted free of charge", "without restriction")),
    Template("apache-2.0-notice", "Licensed under the Apache License Version 2.0", ("apache license version 2 0",)),
    Template("apache-2.0-text", "you may not use this file except in compliance with the License You may obtain a "
             "copy of the License at", ("except in compliance",)),
    Template("gpl-3.0-notice", "licensed under the GNU General Public License version 3",
             ("gnu general public license version 3",)),
    Template("gpl-text", "This program is free software you can redistribute it and or modify it under the terms of "
             "the GNU General Public License as published by the Free Software Foundation",
             ("redistribute it and or modify it", "gnu general public license")),
    Template("cc-by-nc-4.0-notice", "Licensed under CC BY NC 4.0", ("cc by nc 4 0",)),
    Template("bsd-text", "Redistribution and use in source and binary forms with or without modification are "
             "permitted provided that the following conditions are met", ("source and binary forms",)),
    Template("mpl-2.0-text", "This Source Code Form is subject to the terms of the Mozilla Public License v 2.0",
             ("source code form", "mozilla public license")),
    Template("isc-text", "Permission to use copy modify and or distribute this software for any purpose with or "
             "without fee is hereby granted", ("with or without fee is hereby granted",)),
]


def _template_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def postings(templates: list[Template] = TEMPLATES) -> list[tuple[str, int, int, bool]]:
    """(word, template, position, whether a key phrase needs it there)."""
    out = []
    for t, template in enumerate(templates):
        words, needed = _template_words(template.text), set()
        for phrase in map(_template_words, template.key_phrases):
            places = [i for i in range(len(words)) if words[i:i + len(phrase)] == phrase]
            needed.update(range(places[0], places[0] + len(phrase)))
        out += [(w, t, i, i in needed) for i, w in enumerate(words)]
    return out


def _with_words(docs: DataFrame) -> DataFrame:
    """Adds ``words``, in a step of its own for each array, so that none is made anew per element."""
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    rows = docs.withColumn("pieces", F.split(lowered, SEPARATORS, -1))
    begin = F.when(F.get("pieces", F.lit(0)) == "", 1).otherwise(0)
    end = F.size("pieces") - F.when((F.size("pieces") > begin) & (F.element_at("pieces", -1) == ""), 1).otherwise(0)
    return rows.withColumn("words", F.slice("pieces", begin + 1, F.greatest(end - begin, F.lit(0)))).drop("pieces")


def word_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents that hold each word of a fixed vocabulary, counted over all documents."""
    held = F.array_intersect("words", F.lit(vocabulary))
    counts = (_with_words(docs.select("text")).select(F.explode(held).alias("word"))
              .groupBy("word").agg(F.count("*").alias("n")))
    return {r["word"]: r["n"] for r in counts.collect()}  # at most a row per word of the templates


def _base(rows: DataFrame, phrases: list[tuple[str, str]]) -> DataFrame:
    """Adds places (sorted starts) and base_labels."""
    def starts(words: list[str]) -> Column:
        """Places of one phrase; null where none starts."""
        def start(w: Column, i: Column) -> Column:
            here = w == words[0]
            for k, other in enumerate(words[1:], 1):
                here = here & F.coalesce(F.get("words", i + k) == other, F.lit(False))
            return F.when(here, i)
        return F.transform("words", start)

    for k, (phrase, _) in enumerate(phrases):
        words = phrase.split()
        rows = rows.withColumn(f"at_{k}", F.when(F.array_contains("words", words[0]), F.filter(
            starts(words), lambda x: x.isNotNull())).otherwise(F.array().cast("array<int>")))
    found = [f"at_{k}" for k in range(len(phrases))]
    labels = F.filter(F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, (_, label) in
                                zip(found, phrases, strict=True)]), lambda x: x.isNotNull())
    return (rows.withColumn("places", F.sort_array(F.flatten(F.array(*found))))
            .withColumn("base_labels", F.sort_array(F.array_distinct(labels))).drop(*found))


def licence_matches(docs: DataFrame, templates: list[Template] = TEMPLATES, agreeing: int = AGREEING) -> DataFrame:
    """rk (hash of doc_id and text), label, place and score of each template found in a text.

    Licence words are those of the templates that at most half of the documents hold, and
    the words of key phrases. The score is the share of the template's weight (the inverse
    document frequencies of its licence words) that stands at its place.
    """
    spark = docs.sparkSession
    index = postings(templates)
    vocabulary = sorted({w for w, *_ in index})
    n = docs.count()
    held = word_frequencies(docs, vocabulary)
    phrase_words = {w for w, _, _, needed in index if needed}
    share = {w: (held.get(w, 0) + 1) / (n + 1) for w in vocabulary}
    kept = [(w, t, q, needed, -log2(share[w])) for w, t, q, needed in index
            if w in phrase_words or share[w] <= 0.5]
    weight, needs = [0.0] * len(templates), [0] * len(templates)
    words_of: list[set[str]] = [set() for _ in templates]
    for w, t, _, needed, idf in kept:
        weight[t] += idf
        needs[t] += needed
        words_of[t].add(w)
    # A template's key phrases hold its rarest key word, so a text without any of these has no match.
    rarest = sorted({min((share[w], w) for w, of, _, needed, _ in kept if needed and of == t)[1]
                     for t in range(len(templates))})
    table = spark.createDataFrame(
        [(*row, templates[row[1]].label, weight[row[1]] or 1.0, needs[row[1]],
          min(agreeing, len(words_of[row[1]]))) for row in kept],
        T._parse_datatype_string("word string, template int, q int, needed boolean, idf double, label string, "
                                 "weight double, n_needed int, enough int"))
    words = spark.createDataFrame(sorted({(w, idf) for w, _, _, _, idf in kept}), "word string, idf double")
    # Both tables hold at most a row per word of the fixed templates.
    # No filter: it would be pushed below the words and make them anew for each use.
    rows = _with_words(docs.select("doc_id", "text")).select(
        F.xxhash64("doc_id", "text").alias("rk"),
        F.posexplode(F.when(F.arrays_overlap("words", F.lit(rarest)), F.col("words"))).alias("p", "word"))
    hits = staged(rows.join(F.broadcast(words), "word"), "licence-words")
    votes = hits.drop("idf").join(F.broadcast(table), "word").withColumn("place", F.col("p") - F.col("q"))
    # One vote for each posting at a place, also where rows repeat.
    votes = votes.groupBy("rk", "template", "label", "place", "q", "word", "needed", "idf", "weight", "n_needed",
                          "enough").agg(F.count("*").alias("_"))
    places = votes.groupBy("rk", "template", "label", "place", "weight", "n_needed", "enough").agg(
        F.count_distinct("word").alias("agree"), F.count_if("needed").alias("stand"), F.sum("idf").alias("held"))
    return places.filter((F.col("agree") >= F.col("enough")) & (F.col("stand") == F.col("n_needed"))).select(
        "rk", "label", "place", F.least(F.col("held") / F.col("weight"), F.lit(1.0)).alias("score"))


def scan_licences(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of the base phrases, first_word and last_word are the smallest
    and largest of them; labels holds the base ones and those of the templates found; score is
    the best template's, 0 without one. Null text is empty: no words, no labels. Rows equal in
    doc_id and text get equal results; null ids are kept.
    """
    rows = _base(_with_words(docs.select("doc_id", "text")), BASE_PHRASES).select(
        "doc_id", F.xxhash64("doc_id", "text").alias("rk"), F.size("words").cast("long").alias("n_words"),
        F.size("places").cast("long").alias("n_base"), F.get("places", F.lit(0)).cast("long").alias("first_word"),
        F.get("places", F.size("places") - 1).cast("long").alias("last_word"), "base_labels")
    found = licence_matches(docs, templates).groupBy("rk").agg(
        F.collect_set("label").alias("own"), F.max("score").alias("best")).withColumnRenamed("rk", "f_rk")
    rows = rows.join(staged(found, "licences"), F.col("rk") == F.col("f_rk"), "left")
    labels = F.array_distinct(F.concat("base_labels", F.coalesce("own", F.array().cast("array<string>"))))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                       F.array_join("base_labels", ",").alias("base_labels"),
                       F.array_join(F.sort_array(labels), ",").alias("labels"),
                       F.coalesce("best", F.lit(0.0)).alias("score"))
