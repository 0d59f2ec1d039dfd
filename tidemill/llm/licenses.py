"""License notices found by diagonal voting, in DataFrame functions alone.

All rolling word k-grams of the documents are joined by hash with those of the templates, word by word equality
included. A hit votes for the diagonal of its template, the offset of its place in the document from its place in the
template. A copy of a template is one diagonal; words put in or left out shift the rest of it to a diagonal near by, so
diagonals at most GAP apart are merged. A merged span is verified: enough of the template's words have to be covered by
its hits, and enough of the span's own words.

Phrases are templates that are found word for word: their grams are of two words, diagonals are not merged, and all
words must be covered, so each place counts.

One pass over the texts; only hits and one row per document are shuffled, once, by the row's number. That number is
made and used in the one plan. The templates are a parameter; they are broadcast, and more than TEMPLATE_CHARS
characters of them are refused. Whatever is gathered for a document is bounded by that document's own words.

Words are runs of digits, a-z and all characters beyond ASCII; only A-Z are lower-cased. A null or empty text has no
words, 0 places and score 0. Repeated rows and rows with null ids give a row each. An empty table gives no rows. Only
the id and the text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Phrases and their labels.
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]

# Notices that licenses ask their users to give, or their first sentences.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version",
    ),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]

TEMPLATE_CHARS = 1 << 20
GAP = 3  # words put in or left out at one place
LEAST_COVERED = 0.75  # of a template's words
LEAST_DENSE = 0.5  # of a span's words
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def rolling(words: str, k: int) -> Column:
    """An array with a struct of each word and its next k - 1, which are null at the end."""
    return F.arrays_zip(F.col(words).alias("0"), *[F.slice(words, F.lit(i + 1), F.size(words)).alias(str(i)) for i in range(1, k)])


def gram_hash(k: int) -> Column:
    """The hash of the first k words of a column `gram`, null where there are fewer."""
    parts = [F.col("gram").getField(str(i)) for i in range(k)]
    return F.when(parts[-1].isNotNull(), F.xxhash64(*parts))


def seeds(df: DataFrame, chosen: list[tuple[str, str]], k: int, name: str) -> DataFrame:
    """(hash, hits): per k-gram hash the places of all templates that have it; of bounded size."""
    if sum(len(text) for _, text in chosen) > TEMPLATE_CHARS:
        raise ValueError(f"templates of more than {TEMPLATE_CHARS} characters")
    listed = [F.struct(F.lit(i).alias("t"), F.lit(label).alias("label"), F.lit(text).alias("text")) for i, (label, text) in enumerate(chosen)]
    rows = df.sparkSession.range(1).select(F.inline(F.array(*listed))).withColumn("words", words_of(F.col("text")))
    rows = rows.select("t", "label", F.size("words").alias("length"), F.posexplode(rolling("words", k)).alias("place", "gram"))
    hit = F.struct("t", "label", "length", "place", F.lit(k).alias("k"), *[F.col("gram").getField(str(i)).alias(f"w{i}") for i in range(k)])
    rows = rows.withColumn("hash", gram_hash(k)).where(F.col("hash").isNotNull())
    return rows.groupBy("hash").agg(F.collect_list(hit).alias(name))


def hits_of(docs: DataFrame, phrases: list[tuple[str, str]], templates: list[tuple[str, str]], k: int, id_col: str, text_col: str) -> DataFrame:
    """(row, id, n_words, pos, hit) of every gram hit, and of every document at least one row, with a null hit."""
    known = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), words_of(F.col(f"`{text_col}`")).alias("words"))
    grams = known.select("row", "id", F.size("words").cast("long").alias("n_words"), F.posexplode_outer(rolling("words", k)).alias("pos", "gram"))
    grams = grams.withColumn("short", gram_hash(2)).withColumn("long", gram_hash(k))
    of_phrases = seeds(docs, phrases, 2, "of_phrases").withColumnRenamed("hash", "short")
    of_templates = seeds(docs, templates, k, "of_templates").withColumnRenamed("hash", "long")
    met = grams.join(F.broadcast(of_phrases), "short", "left").join(F.broadcast(of_templates), "long", "left")
    met = met.where("of_phrases IS NOT NULL OR of_templates IS NOT NULL OR pos IS NULL OR pos = 0")
    kept = ["row", "id", "n_words", "pos"]

    def equal(hit: Column, size: int) -> Column:
        same = F.lit(True)
        for i in range(size):
            same = same & (hit.getField(f"w{i}") == F.col("gram").getField(str(i)))
        return same

    def plain(found: str, size: int) -> Column:
        exact = F.filter(found, lambda hit: equal(hit, size))
        return F.coalesce(F.transform(exact, lambda hit: F.struct(*[hit.getField(c).alias(c) for c in ("t", "label", "length", "place", "k")])), F.array())

    # Phrases are numbered after the templates.
    numbered = F.transform(plain("of_phrases", 2), lambda hit: hit.withField("t", hit.getField("t") + len(templates)))
    return met.select(*kept, F.explode_outer(F.concat(plain("of_templates", k), numbered)).alias("hit"))


def spans_of(hits: DataFrame, first_phrase: int) -> DataFrame:
    """(row, id, n_words, phrase, label, start, end, covered, length) of the verified spans, other columns null where a document has none."""
    key = ["row", "id", "n_words"]
    voted = hits.repartition("row").select(*key, "pos", "hit.*").withColumn("diagonal", F.col("pos") - F.col("place"))
    about = [*key, "t", "label", "length", "k"]
    diagonals = voted.groupBy(*about, "diagonal").agg(
        F.collect_set("place").alias("places"), F.min("pos").alias("low"), F.max("pos").alias("high")
    )
    order = Window.partitionBy("row", "t").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > GAP, F.lit(True)) | (F.col("t") >= first_phrase)
    merged = diagonals.withColumn("apart", apart.cast("int")).withColumn("span", F.sum("apart").over(order))
    spans = merged.groupBy(*about, "span").agg(
        F.flatten(F.collect_list("places")).alias("places"), F.min("low").alias("start"), (F.max("high") + F.max("k")).alias("end")
    )
    words = F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("k") - 1)))
    spans = spans.withColumn("covered", F.size(F.array_distinct(words)))
    good = F.when(F.col("t") >= first_phrase, F.col("covered") == F.col("length")).otherwise(
        (F.col("covered") >= LEAST_COVERED * F.col("length")) & (F.col("covered") >= LEAST_DENSE * (F.col("end") - F.col("start")))
    )
    shown = {"phrase": F.col("t") >= first_phrase, "label": F.col("label"), "start": F.col("start").cast("long")}
    shown |= {"end": F.col("end").cast("long"), "coverage": F.col("covered") / F.col("length")}
    return spans.select(*key, *[F.when(good, value).alias(name) for name, value in shown.items()])


def scan_licenses(
    docs: DataFrame,
    phrases: list[tuple[str, str]] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
    k: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) per row of `docs`.

    n_base counts the places of phrases, first_word and last_word are their smallest and largest starts, labels are
    sorted arrays, score is the largest share of a template or phrase that was found, and spans has (start, end, label,
    coverage) of all verified ones, in words.
    """
    spans = spans_of(hits_of(docs, phrases, templates, k, id_col, text_col), len(templates))
    base = lambda x: F.when(F.col("phrase"), x)
    one = F.struct("start", "end", "label", "coverage")
    return (
        spans.groupBy("row", "id", "n_words")
        .agg(
            F.count(base(F.lit(1))).alias("n_base"),
            F.min(base(F.col("start"))).alias("first_word"),
            F.max(base(F.col("start"))).alias("last_word"),
            F.sort_array(F.collect_set(base(F.col("label")))).alias("base_labels"),
            F.sort_array(F.collect_set("label")).alias("labels"),
            F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
            F.sort_array(F.collect_list(F.when(F.col("label").isNotNull(), one))).alias("spans"),
        )
        .drop("row")
    )
