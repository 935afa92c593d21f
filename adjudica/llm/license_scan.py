"""License scans: an exact set-similarity join of text blocks with license templates.

Words are put in one global order, rare before frequent, by the number of texts of the whole
corpus that hold them. A block contains a template if it holds ``percent`` of the
template's distinct words; then it must hold one of the first n - needed + 1 of them (the
prefix), enough words of the template vocabulary at all (length), and enough of them
from the matching word on (position). Only blocks around a prefix word are cut from
a text; they are joined with the templates on prefix words, and what passes the filters is
verified on the whole sets. Blocks overlap by half, so that a notice of ``stride`` words lies in one.

All steps are DataFrame expressions. Templates are a parameter of bounded size, their words
and ranks are constants of the plan; blocks and hits are ordinary tables.

Defined results: a null or wordless text has no words, no place, no label and score 0; rows
that agree in id and text get the same answer; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import UPPER, raw_text, stored

#: Characters between words; letters are those of A-Z after lower-casing.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases of the base columns (fixed values).
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Notices, as publicly worded by their licenses (fixed values).
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
)
STRIDE = 32


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, GAPS), "")


def places(words: Column, phrase: str) -> Column:
    """Starts at which the words of a phrase stand consecutively."""
    parts = phrase.split()

    def here(i):
        hit = F.get(words, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            hit = hit & (F.get(words, i + k) == p)
        return hit

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.coalesce(here(i), F.lit(False)))


def word_ranks(docs: DataFrame, vocabulary: Sequence[str], text: str) -> dict[str, int]:
    """Rank of each template word in the global order: by texts that hold it, then by the word."""
    words = _words(F.lower(F.col(text).cast("string")))
    held = docs.select(F.explode(F.array_intersect(words, _strings(vocabulary))).alias("word"))
    counts = {r.word: r.n for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    percent: int = 90,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document."""
    spark = docs.sparkSession
    ranks = word_ranks(docs, sorted({w for _, t in templates for w in t.split()}), text)
    listed = []
    for number, (label, notice) in enumerate(templates):
        words = sorted({ranks[w] for w in notice.split()})
        need = math.ceil(percent * len(words) / 100)
        listed.append((number, label, words, need, len(words) - need + 1))
    stride = max([STRIDE, *[len(t.split()) for _, t in templates]])
    by_rank = sorted(ranks, key=ranks.get)
    openers = sorted({by_rank[w] for _, _, words, _, prefix in listed for w in words[:prefix]})

    # one pass over the texts: base columns for all, blocks for those with a prefix word
    value = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("doc_id"), F.md5(raw_text(text)).alias("body"), value.alias("text")).withColumn(
        "lowered", F.coalesce(_words(F.lower("text")), F.array().cast("array<string>"))
    )
    # lower() also changes letters beyond A-Z, but never joins or cuts words or hides an ASCII match
    wanted = F.arrays_overlap("lowered", _strings(sorted({*openers, *[p.split()[0] for p, _ in phrases]})))
    none = F.array().cast("array<string>")
    exact = F.when(wanted, _words(F.translate("text", UPPER, UPPER.lower()))).otherwise(none)
    rows = rows.select("doc_id", "body", F.size("lowered").cast("long").alias("n_words"), exact.alias("words"))
    found = [F.when(F.array_contains("words", p.split()[0]), places(F.col("words"), p)).otherwise(F.array().cast("array<int>")) for p, _ in phrases]
    rows = rows.withColumns({f"p{i}": f for i, f in enumerate(found)})
    every = F.concat(F.array().cast("array<int>"), *[F.col(f"p{i}") for i in range(len(phrases))])
    base = F.array_distinct(F.concat(none, *[F.when(F.size(f"p{i}") > 0, F.array(F.lit(label))).otherwise(none) for i, (_, label) in enumerate(phrases)]))
    starts = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains(_strings(openers), F.get(F.col("words"), i)))
    halves = F.flatten(F.transform(starts, lambda i: F.array(F.floor(i / stride), F.floor(i / stride) - 1)))
    block_numbers = F.filter(F.array_distinct(halves), lambda b: b >= 0)
    rank_of = F.create_map(*[x for w in by_rank for x in (F.lit(w), F.lit(ranks[w]))])

    def ranked(b):
        words = F.slice(F.col("words"), (b * stride + 1).cast("int"), F.lit(2 * stride))
        known = F.array_intersect(words, _strings(by_rank))
        return F.array_sort(F.transform(known, lambda w: F.element_at(rank_of, w)))

    # a text shorter than one stride still has its first block
    blocks = F.when(F.size("words") > 0, F.transform(F.when(F.size(block_numbers) > 0, block_numbers).otherwise(F.array().cast("array<bigint>")), ranked))
    scanned = rows.select(
        "doc_id", "body", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"), F.array_sort(base).alias("base"), blocks.alias("blocks"),
    )
    scanned = stored(scanned, "license-blocks")

    notices = spark.createDataFrame(listed, "number int, label string, words array<int>, need int, prefix int")
    postings = notices.select("number", "label", "words", "need", F.posexplode(F.slice("words", F.lit(1), F.col("prefix"))).alias("i", "word"))
    cut = scanned.select("doc_id", "body", F.explode("blocks").alias("block")).distinct()
    opened = cut.select("*", F.posexplode("block").alias("j", "word"))
    # length: enough template words in the block; position: enough left on both sides from this match on
    left = F.least(F.size("words") - F.col("i"), F.size("block") - F.col("j"))
    candidates = opened.join(F.broadcast(postings), "word").where((F.size("block") >= F.col("need")) & (left >= F.col("need") - F.col("i")))
    overlap = F.size(F.array_intersect("block", "words"))
    hits = candidates.withColumn("share", overlap / F.size("words")).where(overlap >= F.col("need"))
    best = hits.groupBy("doc_id", "body").agg(F.collect_set("label").alias("added"), F.max("share").alias("score"))
    same = F.col("s.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("s.body") == F.col("h.body"))
    joined = scanned.alias("s").join(best.alias("h"), same, "left")
    labels = F.array_sort(F.array_union("s.base", F.coalesce("h.added", none)))
    return joined.select(
        "s.doc_id", "s.n_words", "s.n_base", "s.first_word", "s.last_word", F.array_join("s.base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.coalesce("h.score", F.lit(0.0)).alias("score"),
    )
