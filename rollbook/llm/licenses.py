"""License scan by diagonal voting, in built-in column expressions only.

The rolling hash of every word 3-gram of a text is looked up among those of the licence
templates. A hit at word ``pos`` of the text and ``tpos`` of a template votes for the diagonal
``pos - tpos``; neighbouring diagonals (words put in or left out) are merged. Spans are
verified word by word: hits whose words are not the template's are left out, and a span counts
if the words that it has in line with the template are enough of the template's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.llm.common import keep

# Words, base phrases and their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "cc-by": ("cc", "by"),
    "gpl": ("general", "public", "license"),
    "reserved": ("all", "rights", "reserved"),
}
# Public licence notices, as words.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-notice": "you may not use this file except in compliance with the license you may "
    "obtain a copy of the license at http www apache org licenses license 2 0",
    "mit": "released under the mit license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy "
    "of this software and associated documentation files the software to deal in the software "
    "without restriction",
    "bsd": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "gpl-3": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under "
    "the terms of the gnu general public license as published by the free software foundation",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "all-rights-reserved": "all rights reserved",
}
K = 3
NEAR = 2  # diagonals this close belong to one span
COVER = 0.6  # share of a template's words that a span must hold in line
BROADCAST_GRAMS = 200_000  # template grams up to which the table is broadcast
UPPER = "abcdefghijklmnopqrstuvwxyz".upper()


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case; a null text has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def template_grams(templates: DataFrame) -> DataFrame:
    """(gram, places): the hash of each distinct 3-gram of the templates (label, text), and where
    it stands: label, place, words, and how many words the template has."""
    words = templates.select("label", words_of(F.col("text")).alias("t")).filter(F.size("t") >= K)
    each = words.select("label", "t", F.explode(F.sequence(F.lit(0), F.size("t") - K)).alias("tpos"))
    return (
        each.withColumn("words", F.slice("t", F.col("tpos") + 1, F.lit(K)))
        .groupBy(F.xxhash64(*[F.get("words", F.lit(j)) for j in range(K)]).alias("gram"))
        .agg(F.collect_list(F.struct("label", "tpos", "words", F.size("t").alias("size"))).alias("places"))
    )


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    """(label, text) of the given templates, by default of the notices above."""
    return spark.createDataFrame(list((templates or TEMPLATES).items()), "label string, text string")


def _base(w: Column, pos: Column) -> Column:
    """Label of the base phrase that starts at a word, or null; phrases cannot start together."""
    label = F.lit(None).cast("string")
    for name, phrase in PHRASES.items():
        there = F.lit(True)
        for j, x in enumerate(phrase):
            there = there & F.coalesce(F.get(w, pos + j) == x, F.lit(False))
        label = F.when(there, name).otherwise(label)
    return label


def scan_licenses(
    docs: DataFrame, templates: DataFrame | None = None, cover: float = COVER
) -> tuple[DataFrame, DataFrame]:
    """(documents, spans) of every whole text.

    ``documents``: row_id, doc_id, n_words, n_base, first_word, last_word, base_labels (array).
    ``spans``: row_id, doc_id, label, first_word, last_word, votes, coverage.
    ``templates`` has label and text (default: the notices above); of any number, whole licence
    texts too. Templates of fewer than 3 words are never found.
    Needs doc_id and text; other columns are ignored. Null texts are empty, texts of any length
    are scanned whole. Every row is scanned on its own (``row_id`` tells repeated rows apart). A
    text with hits for many templates has a span for each; overlapping spans all stay. An empty
    table gives no rows.
    """
    if templates is None:
        templates = template_table(docs.sparkSession)
    grams = keep(template_grams(templates), "license-grams")
    if grams.count() <= BROADCAST_GRAMS:
        grams = F.broadcast(grams)
    w = words_of(F.col("text"))
    pos = F.col("pos")
    words = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", w.alias("w"))
    # one row per word, and one at -1 for the document itself
    each = words.select(
        "row_id",
        "doc_id",
        "w",
        F.size("w").cast("long").alias("n_words"),
        F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("pos"),
    ).select(
        "row_id",
        "doc_id",
        "n_words",
        "pos",
        F.when(pos >= 0, F.slice("w", F.greatest(pos, F.lit(0)) + 1, F.lit(K))).alias("words"),
        F.when(pos >= 0, _base(F.col("w"), pos)).alias("base"),
    )
    rolling = F.when(F.size("words") == K, F.xxhash64(*[F.get("words", F.lit(j)) for j in range(K)]))
    met = each.withColumn("rolling", rolling).join(grams, F.col("rolling") == F.col("gram"), "left")
    # a hash may be shared by chance: the words decide
    places = F.filter("places", lambda p: p["words"] == F.col("words"))
    hits = keep(
        met.withColumn("places", places)
        .filter((pos < 0) | F.col("base").isNotNull() | (F.size("places") > 0))
        .select("row_id", "doc_id", "n_words", "pos", "base", "places"),
        "license-hits",
    )
    based = F.col("base").isNotNull()
    documents = hits.groupBy("row_id", "doc_id", "n_words").agg(
        F.count_if(based).alias("n_base"),
        F.min(F.when(based, pos)).cast("long").alias("first_word"),
        F.max(F.when(based, pos)).cast("long").alias("last_word"),
        F.collect_set("base").alias("base_labels"),
    )

    votes = (
        hits.select("row_id", "doc_id", "pos", F.explode("places").alias("at"))
        .groupBy("row_id", "doc_id", "at.label", "at.size", (pos - F.col("at.tpos")).alias("diagonal"))
        .agg(
            F.collect_set("at.tpos").alias("seen"),
            F.min("pos").alias("first_word"),
            (F.max("pos") + K - 1).alias("last_word"),
        )
    )
    along = Window.partitionBy("row_id", "doc_id", "label").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(along) > NEAR
    # template words that stand in the text, in line with a diagonal of the span
    in_line = F.array_distinct(
        F.flatten(F.transform("seen", lambda t: F.transform(F.sequence(F.lit(0), F.lit(K - 1)), lambda j: t + j)))
    )
    spans = (
        votes.withColumn("new", F.coalesce(far, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("new").over(along))
        .groupBy("row_id", "doc_id", "label", "size", "span")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"),
            F.min("first_word").cast("long").alias("first_word"),
            F.max("last_word").cast("long").alias("last_word"),
        )
        .withColumn("votes", F.size("seen"))
        .withColumn("coverage", F.size(in_line) / F.col("size"))
        .filter(F.col("coverage") >= cover)
        .select("row_id", "doc_id", "label", "first_word", "last_word", "votes", "coverage")
    )
    return documents, spans


def license_digest(docs: DataFrame, **options) -> DataFrame:
    """One row per document: base places, base labels, all labels and the best coverage."""
    documents, spans = scan_licenses(docs, **options)
    found = spans.groupBy("row_id").agg(
        F.collect_set("label").alias("found"), F.max("coverage").alias("best")
    )
    nothing = F.array().cast("array<string>")
    both = F.array_union("base_labels", F.coalesce("found", nothing))
    return documents.join(found, "row_id", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"),
    )
