"""Licence scan by a positional index of rare words, in built-in functions.

Templates are short, distinctive passages of well-known licences, with a label and mandatory
phrases. The index holds one posting (word, template, position) for each of their words; it is
bounded by the templates, so it is broadcast. A scan keeps, of every whole text, only places
of licence words. The weight of a word is its inverse document frequency, counted over all
documents, smoothed so that it stays above 0. Each template is indexed by its own ``RAREST``
highest-weighted words; a document looks up all its licence words, however many licences it
holds, and the postings are intersected by relative position: matches of one template at one
offset (document position less template position) count together. An offset that holds
``MIN_SHARE`` of the weight of the template's indexed words is a candidate, and the template's label is given if
every mandatory phrase stands in the text. Phrases of ``BASE`` give their labels wherever their
words stand consecutively, whatever the index says.

Score: 1 where a base phrase stands, else the best share of a verified template's weight, else 0.

Defined cases: a null or empty text has no words, no places, empty labels and score 0.
Repeated rows are rows of their own. A text that is one licence word a million times has as many
places, which stay in its row. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm.common import lower_ascii, words
from marginalia.session import materialize

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Label, text of the template, mandatory phrases.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("general public license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("free software", "general public license")),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "this work is licensed under a creative commons attribution license", ("creative commons attribution",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
)
RAREST = 12
MIN_SHARE = 0.6
ROW = "__doc_row"


def postings(weights: dict[str, float]) -> list[tuple[str, int, int, float]]:
    """(word, template, place, weight): the places of each template's ``RAREST`` words, ties by word."""
    rows = []
    for t, (_, text, _) in enumerate(TEMPLATES):
        own = text.split()
        rare = sorted(set(own), key=lambda w: (-weights[w], w))[:RAREST]
        rows += [(w, t, i, weights[w]) for i, w in enumerate(own) if w in rare]
    return rows


def vocabulary() -> list[str]:
    return sorted({w for _, text, _ in TEMPLATES for w in text.split()})


def phrases() -> list[str]:
    return sorted({*BASE, *(p for _, _, own in TEMPLATES for p in own)})


def _places(w: Column, licence: Column, phrase: str) -> Column:
    """Starts of a phrase, found from the places of its first word alone."""
    first, *rest = phrase.split()
    starts = F.transform(F.filter(licence, lambda x: x["word"] == first), lambda x: x["at"])
    return F.filter(starts, lambda i: reduce(
        lambda c, k: c & F.coalesce(F.get(w, i + (k + 1)) == rest[k], F.lit(False)), range(len(rest)), F.lit(True)))


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Per document: n_words, places of licence words, starts of base phrases, phrases that stand in it."""
    known = vocabulary()
    read = docs.withColumn("__w", words(F.col("text")))
    place = lambda x, i: F.when(x.isin(known), F.struct(x.alias("word"), i.alias("at")))
    read = read.withColumn("__licence", F.array_compact(F.transform("__w", place)))
    base = [(label, _places(F.col("__w"), F.col("__licence"), p)) for p, label in BASE.items()]
    stands = [F.when(F.size(_places(F.col("__w"), F.col("__licence"), p)) > 0, F.lit(p)) for p in phrases()]
    read = read.withColumns({f"__b{i}": s for i, (_, s) in enumerate(base)}).withColumn("__stands", F.array_compact(F.array(*stands)))
    base = [(label, F.col(f"__b{i}")) for i, (label, _) in enumerate(base)]
    starts = F.concat(*(s for _, s in base))
    none = F.array().cast("array<struct<word:string,at:int>>")
    return read.select(
        *keep, F.size("__w").cast("long").alias("n_words"),
        F.array_distinct(F.transform("__licence", lambda x: x["word"])).alias("own"),
        # A template needs its mandatory phrases, so a text without any of them is not looked up.
        F.when(F.size("__stands") > 0, F.col("__licence")).otherwise(none).alias("licence"),
        F.size(starts).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_compact(F.array(*(F.when(F.size(s) > 0, F.lit(label)) for label, s in base))).alias("base"),
        F.col("__stands").alias("stands"),
    )


def word_weights(scanned: DataFrame) -> DataFrame:
    """(word, weight): inverse document frequency of each licence word over all documents."""
    spark = scanned.sparkSession
    seen = scanned.select(F.explode("own").alias("word"))
    counts = seen.groupBy("word").agg(F.count("*").alias("df"))
    total = scanned.agg(F.count("*").alias("total"))
    every = spark.createDataFrame([(w,) for w in vocabulary()], "word string")
    # Both are bounded: one row, and one row for each word of the templates.
    joined = every.join(F.broadcast(counts), "word", "left").join(F.broadcast(total))
    return joined.select("word", F.log1p((F.col("total") + 1) / (F.coalesce("df", F.lit(0)) + 1)).alias("weight"))


def find_licences(docs: DataFrame, *, keep: list[str]) -> DataFrame:
    """One row per document: ``keep``, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    scanned = scan(docs.select(*dict.fromkeys([*keep, "text"])), keep)
    scanned = materialize(scanned.withColumn(ROW, F.monotonically_increasing_id()), "licence-scan")
    weights = {r.word: r.weight for r in word_weights(scanned).collect()}
    rows = postings(weights)
    index = spark.createDataFrame(rows, "word string, template int, place int, weight double")
    full = {t: sum(w for _, own, _, w in rows if own == t) for t in range(len(TEMPLATES))}
    # A template whose mandatory phrases do not all stand in a text cannot give its label: it is not looked up there.
    may = F.array_compact(F.array(*(
        F.when(F.forall(F.array(*map(F.lit, must)), lambda p: F.array_contains("stands", p)), F.lit(t))
        for t, (_, _, must) in enumerate(TEMPLATES))))
    looked = scanned.where(F.size("stands") > 0).select(ROW, may.alias("may"), F.explode("licence").alias("x"))
    at = looked.select(ROW, "may", "x.*").join(F.broadcast(index), "word").where(F.array_contains("may", F.col("template")))
    at = at.withColumn("offset", F.col("at") - F.col("place"))
    shares = at.groupBy(ROW, "template", "offset").agg(F.sum("weight").alias("held"))
    rules = spark.createDataFrame(
        [(t, label, full[t]) for t, (label, _, _) in enumerate(TEMPLATES)], "template int, label string, weight_of double")
    share = F.least(F.lit(1.0), F.col("held") / F.col("weight_of"))
    found = shares.join(F.broadcast(rules), "template").withColumn("share", share).where(F.col("share") >= MIN_SHARE)
    each = found.groupBy(ROW).agg(F.collect_set("label").alias("own_labels"), F.max("share").alias("share"))
    out = scanned.join(each, ROW, "left")
    all_labels = F.array_sort(F.array_union("base", F.coalesce("own_labels", F.array().cast("array<string>"))))
    return out.select(
        *keep, "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(all_labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
