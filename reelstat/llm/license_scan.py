"""License scans with a positional index of rare template words, in DataFrame functions only.

1. Document frequencies of all template words are counted over the whole corpus.
2. Each template is indexed under its ``RARE_PER_TEMPLATE`` words of highest IDF, with their positions.
3. A file looks up all index words that it has (the templates bound their number); each place of such a
   word and each posting of it vote for (template, place of the template's first word).
4. Where enough different places of one template agree, its mandatory key phrases
   must also stand in the file; then the file gets the template's label.

Beside that the base phrases are found in every file by their words alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import docs_of, lower_ascii

# What stands between words, after A-Z have been lower-cased.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
BASE_PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Label, wording, key phrases that a file must have.
TEMPLATES = (
    ("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is "
     "distributed on an as is basis", ("as is basis",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution",)),
    ("cc-by", "licensed under cc by 4 0", ("cc by",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights",
     ("waived all copyright",)),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("general public license",)),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
     "the free software foundation", ("general public license", "free software foundation")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", ("with or without fee",)),
    ("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ("permission is hereby granted free of charge",)),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", ("mozilla public license",)),
    ("public-domain", "this is free and unencumbered software released into the public domain",
     ("released into the public domain",)),
    ("reserved", "copyright all rights reserved", ("all rights reserved",)),
)

RARE_PER_TEMPLATE = 4
LEAST_SHARE = 0.5  # of a template's indexed places that must agree on where it starts


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), BETWEEN_WORDS), "")


def _quoted(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def term_idf(files: DataFrame, templates=TEMPLATES) -> dict[str, float]:
    """IDF of every template word over all files; the words of the templates bound its size."""
    terms = sorted({w for _, text, _ in templates for w in text.split()})
    counted = (
        files.select(F.explode(F.array_intersect("words", _quoted(terms))).alias("term")).groupBy("term").count()
    )
    found = {r["term"]: r["count"] for r in counted.collect()}
    n = files.count()
    return {w: math.log((1 + n) / (1 + found.get(w, 0))) + 1.0 for w in terms}


def rare_index(idf: dict[str, float], templates=TEMPLATES) -> list[tuple[str, int, int, float]]:
    """(term, template number, position, idf) of each template's rarest words; equals in order of the word."""
    postings = []
    for number, (_, text, _) in enumerate(templates):
        words = text.split()
        rare = sorted(set(words), key=lambda w: (-idf[w], w))[:RARE_PER_TEMPLATE]
        postings += [(w, number, k, idf[w]) for k, w in enumerate(words) if w in rare]
    return postings


def _base_starts(words: Column) -> Column:
    """Start places of base phrases, as (place, phrase number)."""

    def starts(number: int, phrase: str) -> Column:
        parts = phrase.split()
        places = F.filter(
            F.sequence(F.lit(0), F.size(words) - len(parts)),
            lambda i: F.forall(
                F.array(*[F.get(words, i + k) == F.lit(w) for k, w in enumerate(parts)]), lambda same: same
            ),
        )
        here = F.transform(places, lambda i: F.struct(i.cast("long").alias("place"), F.lit(number).alias("phrase")))
        none = F.array().cast("array<struct<place:bigint,phrase:int>>")
        has_all = F.size(words) >= len(parts)
        for w in parts:
            has_all = has_all & F.array_contains(words, w)
        return F.when(has_all, here).otherwise(none)

    return F.concat(*[starts(k, p) for k, (p, _) in enumerate(BASE_PHRASES)])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: base places, base labels, all labels, a score and the template hits.

    A null text counts as empty: no words, no labels (empty strings), score 0. Rows that repeat an id with another text each get
    the labels of their own text, equal rows the same. Other columns are not looked at.
    ``score`` is 1 where a base phrase stands, else the best share of a verified template's
    indexed weight that agrees on one place.
    """
    spark = docs.sparkSession
    files = docs_of(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("t"), words_of(F.col("text")).alias("words"))
    idf = term_idf(files, templates)
    postings = rare_index(idf, templates)
    vocabulary = sorted({t for t, *_ in postings})
    index = F.broadcast(  # as large as the templates make it, whatever the corpus
        spark.createDataFrame(postings, "term string, template int, at int, weight double")
    )
    phrases = sorted({p for *_, keys in templates for p in keys})
    present = F.array_compact(
        F.array(*[F.when(F.contains("joined", F.lit(f" {p} ")), F.lit(p)) for p in phrases])
    )
    rules = F.broadcast(
        spark.createDataFrame(
            [
                (k, label, list(keys), sum(w for _, t, _, w in postings if t == k), sum(t == k for _, t, _, _ in postings))
                for k, (label, _, keys) in enumerate(templates)
            ],
            "template int, label string, keys array<string>, whole double, places int",
        )
    )
    places = (
        files.where(F.arrays_overlap("words", _quoted(vocabulary)))
        .select("doc_id", "t", "words", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("joined"))
        .select("doc_id", "t", present.alias("present"), F.posexplode("words").alias("place", "term"))
        .where(F.col("term").isin(vocabulary))
    )
    votes = (
        places.join(index, "term")
        .groupBy("doc_id", "t", "present", "template", (F.col("place") - F.col("at")).alias("start"))
        .agg(F.sort_array(F.collect_set(F.struct("at", "weight"))).alias("agreed"))  # places of one template: bounded; equal rows agree once
        .withColumn("agreeing", F.size("agreed"))
        .withColumn("weight", F.aggregate("agreed", F.lit(0.0), lambda s, x: s + x["weight"]))
    )
    hits = (
        votes.join(rules, "template")
        .where(F.col("agreeing") >= LEAST_SHARE * F.col("places"))
        .where(F.size(F.array_except("keys", "present")) == 0)
        .groupBy(F.col("doc_id").alias("hit_id"), F.col("t").alias("hit_t"))
        .agg(
            F.collect_set("label").alias("found"),  # of the templates' labels: bounded
            F.max(F.least(F.lit(1.0), F.col("weight") / F.col("whole"))).alias("best"),
        )
    )
    names = F.array(*[F.lit(label) for _, label in BASE_PHRASES])
    based = files.select("doc_id", "t", F.size("words").cast("long").alias("n_words"), _base_starts(F.col("words")).alias("b")).select(
        "doc_id",
        "t",
        "n_words",
        F.size("b").cast("long").alias("n_base"),
        F.array_min(F.transform("b", lambda x: x["place"])).alias("first_word"),
        F.array_max(F.transform("b", lambda x: x["place"])).alias("last_word"),
        F.array_sort(F.array_distinct(F.transform("b", lambda x: F.get(names, x["phrase"])))).alias("base"),
    )
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))))
    mine = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("t") == F.col("hit_t"))
    return based.join(hits, mine, "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
