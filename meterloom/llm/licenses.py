"""License scans by diagonal voting, in DataFrame functions.

Every rolling word pair of every text is joined, by its hash, to the word pairs of the
templates. A hit votes for a diagonal: its place in the text less its place in the
template. Votes are summed by diagonal; diagonals with enough votes that lie next to each
other (a word was added or left out) are merged; a merged span counts if it covers enough
of the template. The words themselves are compared with each hit, so hash collisions do
not count.

Phrases of two or three words need all their pairs on one diagonal; each such diagonal is
one place of the phrase. Texts stay where they are: only hits and one short row for each
text are shuffled. Templates are a fixed list, which is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Phrases whose places are counted.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)

# Notices and opening sentences of common licenses.
NOTICES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

# A diagonal needs this share of a template's pairs to be looked at, a merged span this share to count.
DIAGONAL_SHARE = 0.1
SPAN_SHARE = 0.75
# Words by which neighbouring diagonals may differ.
NEAR = 3


def templates() -> list[tuple[int, str, bool, int, int, str, str]]:
    """Word pairs of all templates: number, label, phrase or not, pairs, place, two words."""
    rows = []
    for number, (label, words) in enumerate((*PHRASES, *NOTICES)):
        words = words.split()
        pairs = list(zip(words, words[1:]))
        rows += [(number, label, number < len(PHRASES), len(pairs), i, *pair) for i, pair in enumerate(pairs)]
    return rows


def words_of_text(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), NOT_WORD), lambda w: w != "")


def _hits(rows: DataFrame) -> DataFrame:
    """Equal word pairs of texts and templates, one row for each place in both."""
    schema = "template int, label string, phrase boolean, pairs int, place int, t1 string, t2 string"
    known = rows.sparkSession.createDataFrame(templates(), schema).withColumn("hash", F.xxhash64("t1", "t2"))
    pairs = F.arrays_zip(F.col("words").alias("w1"), F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))).alias("w2"))
    grams = rows.where(F.size("words") > 1).select("doc_id", "text_hash", F.posexplode(pairs).alias("at", "pair"))
    grams = grams.select("doc_id", "text_hash", "at", F.col("pair.w1").alias("w1"), F.col("pair.w2").alias("w2"))
    same = (F.xxhash64("w1", "w2") == F.col("hash")) & (F.col("w1") == F.col("t1")) & (F.col("w2") == F.col("t2"))
    hits = grams.join(F.broadcast(known), same)
    return hits.select("doc_id", "text_hash", "template", "label", "phrase", "pairs", "place", "at")


def license_spans(rows: DataFrame) -> DataFrame:
    """Spans that count, of rows ``(doc_id, text_hash, words)``: label, phrase or not, first word, share of the template covered."""
    text = ["doc_id", "text_hash"]
    votes = (
        _hits(rows)
        .groupBy(*text, "template", "label", "phrase", "pairs", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.collect_set("place").alias("places"))  # no more than a template has
    )
    votes = votes.where(F.size("places") >= F.greatest(F.lit(1.0), F.col("pairs") * DIAGONAL_SHARE))
    order = Window.partitionBy(*text, "template").orderBy("diagonal")
    # Diagonals of a phrase are never merged: each is a place of its own.
    apart = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(order) > NEAR)
    return (
        votes.withColumn("span", F.sum(F.coalesce(apart, F.lit(False)).cast("int")).over(order))
        .groupBy(*text, "template", "label", "phrase", "pairs", "span")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("covered"),
            F.min("diagonal").alias("first_word"),
        )
        .withColumn("share", F.col("covered") / F.col("pairs"))
        .where(F.col("share") >= F.when(F.col("phrase"), 1.0).otherwise(SPAN_SHARE))
        .select(*text, "label", "phrase", "first_word", "share")
    )


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words, phrase places and labels of every row.

    ``n_base`` counts all places of the phrases, ``first_word`` and ``last_word`` are their
    smallest and largest start (null if none); ``base_labels`` and ``labels`` are distinct,
    sorted and comma-joined (empty if none); ``score`` is the largest share of a template
    that a span covers (0 if none). Null and empty texts have no words. Rows equal in key
    and text get equal results; texts under a null key are told apart by their hash. An
    empty table gives an empty result; other columns play no part.
    """
    rows = docs.select(docs[key].alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of_text(F.col("text")).alias("words"))
    phrase = lambda c: F.when(F.col("phrase"), F.col(c))
    # Repeated rows vote on the same diagonals once: places are sets.
    found = (
        license_spans(rows)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.count(phrase("label")).alias("n_base"),
            F.min(phrase("first_word")).cast("long").alias("first_word"),
            F.max(phrase("first_word")).cast("long").alias("last_word"),
            F.array_join(F.sort_array(F.collect_set(phrase("label"))), ",").alias("base_labels"),
            F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
            F.max("share").alias("score"),
        )
        .withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    )
    sizes = rows.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"))
    same = sizes["doc_id"].eqNullSafe(found["_id"]) & (sizes["text_hash"] == found["_hash"])
    return sizes.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
