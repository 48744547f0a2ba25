"""License texts in documents by an exact set-similarity join of templates with
blocks of consecutive words, in DataFrame functions only."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .contamination import words_of

BINS = 1 << 17
#: Templates are a parameter that goes into plans and is broadcast.
MOST_TEMPLATE_WORDS = 100_000
#: Positions are scaled by SPAN / words of a template, so that one frame of a
#: window serves templates of all lengths (exact up to 32,768 words).
SPAN = 1 << 30
_WORD = re.compile(r"[a-z0-9\u0080-\U0010FFFF]+")


@dataclass(frozen=True)
class Template:
    """``label`` is found where a block of as many consecutive words as ``text``
    has holds at least ``threshold`` of its distinct words; a ``phrase`` is found
    where its words stand in their order, next to each other."""

    label: str
    text: str
    phrase: bool = False
    threshold: float = 0.8

    @property
    def words(self) -> list[str]:
        return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in self.text))

    @property
    def need(self) -> int:
        """Distinct words that a block must hold."""
        distinct = len(set(self.words))
        return distinct if self.phrase else max(1, math.ceil(round(self.threshold * distinct, 9)))


# The phrases that the task names, with their labels.
PHRASES = (
    Template("gpl", "gnu general public license", phrase=True),
    Template("apache", "apache license", phrase=True),
    Template("cc-by", "cc by", phrase=True),
    Template("mit", "mit license", phrase=True),
)
# Well-known notices of public licenses.
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                    "associated documentation files (the Software), to deal in the Software without restriction"),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                    "General Public License as published by the Free Software Foundation"),
    Template("gpl-3.0", "GNU General Public License, version 3", threshold=1.0),
    Template("gpl-2.0", "GNU General Public License, version 2", threshold=1.0),
    Template("lgpl", "GNU Lesser General Public License", threshold=1.0),
    Template("agpl", "GNU Affero General Public License", threshold=1.0),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                    "is hereby granted"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by", "Creative Commons Attribution License", threshold=1.0),
    Template("cc-by-nc", "CC BY-NC", threshold=1.0),
    Template("cc-by-sa", "CC BY-SA", threshold=1.0),
    Template("cc-by-nd", "CC BY-ND", threshold=1.0),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)


def _listed(word: Column, table: Column) -> Column:
    return F.substring(table, F.pmod(F.hash(word), F.lit(BINS)) + 1, 1) == F.lit(b"\x01")


def _places(words: Column, table: Column) -> Column:
    """Places (from 0) and words of those ``words`` whose bin of the table is set."""
    found = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: _listed(F.get(words, i), table))
    return F.when(F.size(words) > 0, F.transform(found, lambda i: F.struct(i.alias("pos"), F.get(words, i).alias("word"))))


def license_blocks(docs: DataFrame, templates: tuple[Template, ...], id_col: str = "doc_id",
                   text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``rows (row, id_col, n_words)``, one for each row of ``docs``, and
    ``blocks (row, t, start, held, overlap, m, length)``: every block that meets the threshold
    of template number ``t`` and ends with one of its words (the block holds as
    many words as the template, fewer at the start of a text).

    Set-similarity join: the words of all templates are ordered by their count
    in all documents.  A block that holds ``need`` of a template's ``m`` words
    holds one of the ``m - need + 1`` rarest, and two of the ``m - need + 2``
    rarest if it needs two (prefix filter); it lies in a text of at least
    ``need`` words (length filter); rank and number of the rare words met so far
    bound what it can still reach (positional filter).  What passes is counted
    in full."""
    spark = docs.sparkSession
    flat = [(t, w, len(tpl.words), len(set(tpl.words)), tpl.need) for t, tpl in enumerate(templates) for w in set(tpl.words)]
    if not flat or len(flat) > MOST_TEMPLATE_WORDS or max(len(tpl.words) for tpl in templates) ** 2 > SPAN:
        raise ValueError(f"templates with {len(flat)} words; 1 to {MOST_TEMPLATE_WORDS} are possible, of 32,768 words each")
    tokens = spark.createDataFrame(flat, "t int, word string, length int, m int, need int")

    table = bytearray(BINS)
    for (b,) in tokens.select(F.pmod(F.hash("word"), F.lit(BINS))).distinct().collect():
        table[b] = 1
    words = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    scanned = cut(words.select(F.monotonically_increasing_id().alias("row"), "id", F.size("words").cast("long").alias("n_words"),
                               _places(F.col("words"), F.lit(bytes(table))).alias("places")))
    rows = scanned.select("row", F.col("id").alias(id_col), "n_words")

    # The global order: rarest word first.
    counts = scanned.select(F.explode("places.word").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("t").orderBy(F.coalesce("n", F.lit(0)), "word")) - 1
    ranked = cut(tokens.join(counts, "word", "left").withColumn("rank", rank))
    order = ranked.orderBy("t", "rank").collect()
    listed = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(tpl.need).alias("need"),
                                F.array(*(F.lit(r["word"]) for r in order if r["t"] == t and r["rank"] <= r["m"] - r["need"] + 1)
                                        ).alias("prefix")) for t, tpl in enumerate(templates) if tpl.words))

    # Length filter and prefix filter of a whole text, then only its words of the templates that remain.
    own = F.array_distinct("places.word")
    possible = F.filter(listed, lambda x: (F.col("n_words") >= x["need"])
                        & (F.size(F.array_intersect(own, x["prefix"])) >= F.least(F.lit(2), x["need"])))
    texts = scanned.where(F.size("places") > 0).select("row", "places", F.explode(possible).alias("p"))
    met = (texts.select("row", F.col("p.t").alias("t"), F.inline("places"))
           .join(F.broadcast(ranked.select("t", "word", "rank", "length", "m", "need")), ["t", "word"]))

    met = met.withColumn("at", F.col("pos").cast("long") * F.ceil(F.lit(SPAN) / F.col("length")))
    in_text = Window.partitionBy("row", "t").orderBy("at")
    around, block = in_text.rangeBetween(1 - SPAN, SPAN - 1), in_text.rangeBetween(1 - SPAN, 0)
    # Ranks of the rare words within reach: after the j-th of them, no more than j + (m - 1 - its rank) can be met.
    rare = F.array_sort(F.collect_set(F.when(F.col("rank") <= F.col("m") - F.col("need") + 1, F.col("rank"))).over(around))
    reachable = F.forall(F.transform(F.col("rare"), lambda r, j: j + F.col("m") - r), lambda bound: bound >= F.col("need"))
    near = met.withColumn("rare", rare).where((F.size("rare") >= F.least(F.lit(2), "need")) & reachable).drop("rare")
    held = near.withColumn("held", F.collect_list("word").over(block))
    overlap = F.size(F.array_distinct("held"))
    return rows, held.where(overlap >= F.col("need")).select(
        "row", "t", F.greatest(F.col("pos") - F.col("length") + 1, F.lit(0)).cast("long").alias("start"), "held", overlap.alias("overlap"), "m", "length")


def scan_licenses(docs: DataFrame, phrases: tuple[Template, ...] = PHRASES, notices: tuple[Template, ...] = NOTICES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_words, n_base, first_word, last_word, base_labels, labels,
    score)`` for every row.

    ``n_base``: places where a phrase stands, ``first_word`` and ``last_word``
    the least and the greatest of them (words from 0; null if none).  Labels are
    distinct and sorted, with commas between; ``labels`` has those of the notices
    too.  ``score``: the greatest share of a template's distinct words that one
    of the blocks found holds (a phrase: 1), 0 without one.

    Words: letters a-z (A-Z lower-cased), digits and non-ASCII characters.
    Null, empty and wordless texts have no words and no labels.  Texts of any
    length are searched whole; repeated rows and ids, also null ids, give a row
    each; equal shares need no order; an empty table gives none.  No other
    column is read, so names cannot clash."""
    templates = (*phrases, *notices)
    rows, blocks = license_blocks(docs, templates, id_col, text_col)
    # A block as long as its phrase with one word at each place: compare the order.
    spark = docs.sparkSession
    facts = spark.createDataFrame([(t, tpl.label, tpl.phrase, tpl.words) for t, tpl in enumerate(templates)],
                                  "t int, label string, phrase boolean, words array<string>")
    found = blocks.join(F.broadcast(facts), "t")
    exact = F.col("phrase") & (F.size("held") == F.col("length")) & (F.col("held") == F.col("words"))
    found = found.where(~F.col("phrase") | exact)
    start = F.when(F.col("phrase"), F.col("start"))
    per_row = found.groupBy("row").agg(
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))).alias("base"),
        F.array_sort(F.collect_set("label")).alias("every"), F.max(F.col("overlap") / F.col("m")).alias("score"))
    return rows.join(per_row, "row", "left").select(
        id_col, "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce(F.array_join("base", ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join("every", ","), F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
