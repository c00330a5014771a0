"""License scans by diagonal voting, in DataFrame operations only.

Every pair of neighbouring words of a document (rolling 2-gram hash) is joined
to the places of the templates that hold the same pair (hash and words equal).
A hit at document place p and template place t votes for the diagonal p - t.
Votes are added up by diagonal; from each diagonal on, the neighbouring ones of the
template (words left out or put in) are merged, at most ``reach`` further, so a span
is hardly longer than its template; a merged span is verified: it must hold a given
share of the template's pairs, each counted once. A diagonal that holds the whole
template is thus found whatever its neighbours hold.

The phrases are templates that must match in full on one diagonal. Templates can be
passed in, whole licence texts too. Documents' words are exploded and joined map-side
to the templates' pairs as long as these are few (counted); only hits, and one row
for each document, are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beatline.llm.common import pick
from beatline.session import materialize

#: Base phrases and their labels (fixed values).
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Notices, by label; several wordings for a label.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "apache license version 2 0 january 2004"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "gnu general public license version"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("lgpl", "gnu lesser general public license version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "this work is licensed under a creative commons attribution license"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
    ("no-warranty", "the software is provided as is without warranty of any kind express or implied"),
]
#: Diagonals at most so far apart are merged: so many words may be put in or left out.
REACH = 6
#: Up to so many word pairs of templates are broadcast by hint.
MOST_PAIRS = 200_000
#: A span must hold this share of a template's word pairs.
LEAST_SHARE = 0.8


def word_array(text) -> F.Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def templates(spark: SparkSession, notices: DataFrame | None = None) -> DataFrame:
    """(template, label, exact, n_pairs, t, t1, t2, hash): a row for each word
    pair of each phrase and notice. ``notices``: (label, text) rows, by default
    ``TEMPLATES``. One of fewer than two words, or without a label, has no pairs."""
    if notices is None:
        notices = spark.createDataFrame(TEMPLATES, "label string, text string")
    kinds = "text string, label string, exact boolean"
    texts = spark.createDataFrame([(p, label, True) for p, label in PHRASES.items()], kinds).unionByName(
        pick(notices, text=("text", "string"), label=("label", "string")).withColumn("exact", F.lit(False)))
    return (texts.filter("label is not null")
            .select("label", "exact", word_array(F.col("text")).alias("words"))
            .withColumn("n_pairs", F.size("words") - 1).filter("n_pairs > 0")
            # The same words under the same label are one template.
            .withColumn("template", F.xxhash64("label", "exact", F.array_join("words", " ")))
            .dropDuplicates(["template"])
            .select("template", "label", "exact", "n_pairs", F.posexplode(
                F.arrays_zip(F.slice("words", 1, F.col("n_pairs")).alias("t1"),
                             F.slice("words", 2, F.col("n_pairs")).alias("t2"))).alias("t", "pair"))
            .select("template", "label", "exact", "n_pairs", "t", "pair.t1", "pair.t2")
            .withColumn("hash", F.xxhash64("t1", "t2")))


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least_share: float = LEAST_SHARE, reach: int = REACH,
                  notices: DataFrame | None = None) -> DataFrame:
    """One row for each input row: ``doc_id``, ``n_words``, ``n_base`` (places
    of phrases), ``first_word`` and ``last_word`` (their least and greatest
    start), ``base_labels``, ``labels`` and ``score`` (the greatest share of a
    found template's pairs; 1 with a phrase; else 0). ``notices``: templates as
    (label, text) rows instead of the built-in ones; the phrases always count.

    A null or blank text has no words and no labels (empty strings). Repeated
    rows and null ids each get their own row; an empty table gives none.
    """
    texts = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    words = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", word_array(F.col("text")).alias("words"))
    second = F.expr("slice(words, 2, greatest(size(words) - 1, 0))")
    pairs = words.select("row", "doc_id", F.size("words").cast("long").alias("n_words"),
                         F.arrays_zip(F.col("words").alias("w1"), second.alias("w2")).alias("pairs")) \
        .select("row", "doc_id", "n_words", F.posexplode_outer("pairs").alias("p", "pair")) \
        .select("row", "doc_id", "n_words", "p", F.col("pair.w1").alias("w1"), F.col("pair.w2").alias("w2"))

    places = templates(docs.sparkSession, notices)
    if notices is not None:
        places = materialize(places, "license-templates")
    if notices is None or places.count() <= MOST_PAIRS:
        places = F.broadcast(places)
    # Joined by the hash alone, a compact map of longs; the words decide after it.
    hits = pairs.join(places, F.xxhash64("w1", "w2") == F.col("hash"), "left") \
        .withColumn("template", F.when((F.col("w1") == F.col("t1")) & (F.col("w2") == F.col("t2")), F.col("template"))) \
        .filter("template is not null or p is null or p = 0")  # a row without a hit keeps the document

    of_row = ("row", "doc_id", "n_words")
    of_template = (*of_row, "template", "label", "exact", "n_pairs")
    diagonals = hits.groupBy(*of_template, (F.col("p") - F.col("t")).alias("diagonal")).agg(
        F.min("p").alias("low"), F.collect_list(F.when(F.col("template").isNotNull(), F.col("t"))).alias("held"))
    # A diagonal holds a pair of the template at most once, a merged span counts it once.
    onward = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(0, reach)
    merged = F.when(F.col("exact") | (F.col("n_pairs") == F.size("held")), F.size("held")).otherwise(
        F.size(F.array_distinct(F.flatten(F.collect_list("held").over(onward)))))
    spans = diagonals.withColumn("votes", merged)

    share = F.col("votes") / F.col("n_pairs")
    found = F.when(F.col("exact"), F.col("votes") == F.col("n_pairs")).otherwise(share >= least_share)
    base = F.col("exact") & found
    return spans.groupBy(*of_row).agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("low"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("low"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(found, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(found, share)), F.lit(0.0)).alias("score"),
    ).drop("row")
