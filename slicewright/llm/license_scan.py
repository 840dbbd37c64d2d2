"""License scan by diagonal voting.

All runs of two words of a document meet the template positions with the same hash in an
equi-join (and are then compared as words).  A hit votes for the diagonal "document position
minus template position"; votes are summed per diagonal, diagonals of one template that lie
within ``GAP`` words of each other are merged (a word may be missing or added), and a merged
span counts if it covers enough of the template without being stretched.  Phrases are
templates too, of which a single diagonal must hold every word.

The templates are a short list given as a parameter: their pairs of words are the small side
of the join, which is broadcast.

Defined results
  null or empty text: no words, no places, empty labels, score 0; overlapping places all
  count; repeated rows: each is returned; null key: kept; empty table: empty result; other
  columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Phrases and labels (fixed values).
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Sentences that mark a license, and their labels (fixed values).
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "under the terms of the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license v 2 0": "mpl",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
GAP = 2
COVERAGE = 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words: ASCII other than digits and small letters (after lower-casing A-Z).
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, _BETWEEN), "")


def template_places(docs: DataFrame, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """(gram, places): every template position of a pair of words."""
    rows = []
    listed = [(t, label, True) for t, label in phrases.items()] + [(t, label, False) for t, label in templates.items()]
    for number, (text, label, exact) in enumerate(listed):
        parts = re.split(" +", text.strip())
        if len(parts) < 2:
            raise ValueError("a template needs two words")
        rows += [(number, label, exact, len(parts), i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
    table = docs.sparkSession.createDataFrame(
        rows, "template int, label string, exact boolean, size int, at int, first string, second string"
    )
    place = F.struct("template", "label", "exact", "size", "at", "first", "second")
    return table.groupBy(F.xxhash64("first", "second").alias("gram")).agg(F.collect_list(place).alias("places"))


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES,
) -> DataFrame:
    """Rows (key, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    places = template_places(docs, phrases, templates)
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), words(F.col(text)).alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    pairs = F.arrays_zip(F.col("words").alias("a"), F.slice("words", 2, F.size("words")).alias("b"))
    grams = (
        rows.select("key", "text_hash", "n_words", F.posexplode_outer(pairs).alias("pos", "pair"))
        .select("key", "text_hash", "n_words", "pos", F.col("pair.a").alias("first_of"), F.col("pair.b").alias("second_of"))
        .withColumn("gram", F.when(F.col("second_of").isNotNull(), F.xxhash64("first_of", "second_of")))
    )
    # one row for each pair of words in the listed templates, whatever the corpus
    met = grams.join(F.broadcast(places), "gram", "left")
    begins = F.coalesce(F.col("pos"), F.lit(0)) == 0
    # each document's first row also stands for the document itself: a null place beside its own
    same = F.filter(
        F.coalesce(F.col("places"), F.array().cast(places.schema["places"].dataType)),
        lambda p: (p["first"] == F.col("first_of")) & (p["second"] == F.col("second_of")),
    )
    nothing = F.array(F.lit(None).cast(places.schema["places"].dataType.elementType))
    votes = (
        met.filter(F.col("places").isNotNull() | begins)
        .select("key", "text_hash", "n_words", "pos", F.explode(F.when(begins, F.concat(same, nothing)).otherwise(same)).alias("p"))
        .withColumn("diagonal", F.col("pos") - F.col("p.at"))
        .groupBy("key", "text_hash", "n_words", "p.template", "p.label", "p.exact", "p.size", "diagonal")
        .agg(F.collect_set("p.at").alias("at"), F.count("*").alias("n"))
    )
    along = Window.partitionBy("key", "text_hash", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > GAP, F.lit(True))
    merged = (
        votes.withColumn("new", F.when(F.col("exact"), True).otherwise(new).cast("int"))
        .withColumn("span", F.sum("new").over(along))
        .groupBy("key", "text_hash", "n_words", "template", "label", "exact", "size", "span")
        .agg(
            F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.max("n").alias("n"),
            F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
        )
    )
    covered = F.size(F.array_union("at", F.transform("at", lambda i: i + 1))) / F.col("size")
    whole = F.coalesce(F.col("exact") & (F.size("at") == F.col("size") - 1), F.lit(False))
    near = F.coalesce(~F.col("exact") & (covered >= COVERAGE) & (F.col("high") - F.col("low") <= F.col("size")), F.lit(False))
    labels = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("label")))), ",")
    return (
        merged.groupBy("key", "text_hash", "n_words")
        .agg(
            F.sum(whole.cast("long")).alias("n_base"),
            F.min(F.when(whole, F.col("low"))).cast("long").alias("first_word"),
            F.max(F.when(whole, F.col("low"))).cast("long").alias("last_word"),
            labels(whole).alias("base_labels"),
            labels(whole | near).alias("labels"),
            F.coalesce(F.max(F.when(whole | near, covered)), F.lit(0.0)).alias("score"),
            F.max(F.when(F.col("template").isNull(), F.col("n"))).alias("copies"),
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(F.col("key").alias(key), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )
