"""License scans by diagonal voting.

Every run of `GRAM` words of a document is looked up among the runs of the templates. A hit at document
word p and template word t votes for the diagonal p - t of that template; diagonals at most half the template's
length apart, or `DRIFT`, (words put in or left out) are merged, and a merged diagonal is a match if the template's
runs that it really holds, compared word for word, cover the needed share of the template's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.ngrams import BitTable, candidates, gram_hash, grams, word_hashes
from millwright.llm.tables import words

GRAM = 5
#: Least distance of diagonals that are merged whatever the template's length.
DRIFT = 3
#: Share of a template's words that lie in the runs of a match, at least.
COVER = 0.8

#: Phrases and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Passages of public licenses by label (fixed values).
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the "
               "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
            "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
            "General Public License for more details."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
            "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
            "in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
            "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("cc0", "has dedicated the work to the public domain by waiving all of his or her rights to the work "
            "worldwide under copyright law"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def _phrase_places(found: Column) -> Column:
    """(start, label) of every place where a phrase stands; `found` holds the words."""
    def next_is(k: int, word: str):
        return lambda i: F.get(found, i + k) == word

    parts = []
    for phrase, label in PHRASES.items():
        wanted = phrase.split()
        at = F.array_compact(F.transform(found, _index_of(wanted[0])))
        for k, word in enumerate(wanted[1:], 1):
            at = F.filter(at, next_is(k, word))
        parts.append(F.transform(at, _labelled(label)))
    return F.concat(*parts)


def _index_of(word: str):
    return lambda w, i: F.when(w == word, i)


def _labelled(label: str):
    return lambda i: F.struct(i.alias("start"), F.lit(label).alias("label"))


def _template_runs(spark, templates: list[tuple[str, str]]) -> DataFrame:
    rows = [(n, label, text) for n, (label, text) in enumerate(templates)]
    frame = spark.createDataFrame(rows, "template int, label string, text string")
    frame = frame.withColumn("words", words(F.col("text")))
    return (
        frame.select("template", "label", F.size("words").alias("n"), F.explode(grams(F.col("words"), GRAM)).alias("w"))
        .select(
            "template", "label", "n", F.col("w.start").alias("t"), "w.gram",
            (F.col("n") - GRAM + 1).alias("runs"),
        )
        .withColumn("hash", gram_hash(word_hashes(F.split("gram", " ")), F.lit(0), GRAM))
    )


def _words_under(held: Column, n: Column) -> Column:
    """How many of a template's `n` words lie in the runs that start at `held`."""
    return F.size(F.array_distinct(F.flatten(F.transform(
        held, lambda t: F.sequence(t, F.least(t + GRAM, n) - 1)
    ))))


def licenses(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    Base: all places of the phrases, with the smallest and largest start (null if none). `matches` lists
    (label, start, end, cover) of the template passages found, in words, end exclusive; `cover` is the share of the
    template's words under runs held. `labels` joins both kinds of label. `score` is the best share of a
    template's runs held, which an edit lowers by up to GRAM runs, 1 where a phrase stands. A null text is empty.
    Documents are rows: repeated rows are judged each. The templates are a parameter of bounded size, not
    data; they alone are broadcast.
    """
    spark = documents.sparkSession
    runs = _template_runs(spark, templates)
    table = BitTable(runs, sum(len(text.split()) for _, text in templates))
    none = F.array().cast("array<struct<start:int,label:string>>")
    lower = F.lower("text")
    hinted = F.contains(lower, F.lit("license")) | F.contains(lower, F.lit("cc"))
    scanned = (
        documents.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", hinted.alias("hinted"),
            words(F.col("text")).alias("words"),
        )
        .withColumn("hashes", word_hashes(F.col("words")))
    )
    scanned = (
        candidates(scanned, table, [GRAM], "found")
        .withColumn("base", F.when(F.col("hinted"), _phrase_places(F.col("words"))).otherwise(none))
        .select(
            "row",
            F.struct("doc_id", F.size("words").cast("long").alias("n_words"), "base").alias("doc"),
            F.explode_outer("found").alias("w"),
        )
    )
    votes = (
        scanned.join(F.broadcast(runs.drop("hash")), F.col("w.gram") == F.col("gram"), "left")
        .groupBy("row", "template", (F.col("w.start") - F.col("t")).alias("diagonal"))
        .agg(
            F.first("doc").alias("doc"), F.first("label").alias("label"), F.first("runs").alias("runs"),
            F.first("n").alias("n"), F.collect_set("t").alias("held"),
            F.min("w.start").alias("start"), F.max(F.col("w.start") + GRAM).alias("end"),
        )
    )
    # neighbouring diagonals of a template, in order, become one; each knows the template runs it holds
    merged = F.expr(f"""
        aggregate(diagonals,
          cast(array() as array<struct<diagonal:int,start:int,end:int,held:array<int>>>), (done, d) ->
          if(size(done) > 0 and d.diagonal - element_at(done, -1).diagonal <= greatest({DRIFT}, n div 2),
             concat(slice(done, 1, size(done) - 1), array(struct(
               d.diagonal as diagonal,
               least(element_at(done, -1).start, d.start) as start,
               greatest(element_at(done, -1).end, d.end) as end,
               array_union(element_at(done, -1).held, d.held) as held))),
             concat(done, array(d))))""")
    per_template = (
        votes.groupBy("row", "template").agg(
            F.first("doc").alias("doc"), F.first("label").alias("label"), F.first("runs").alias("runs"),
            F.first("n").alias("n"), F.sort_array(F.collect_list(F.when(
                F.col("template").isNotNull(), F.struct("diagonal", "start", "end", "held")
            ))).alias("diagonals"),
        )
        .withColumn("merged", merged)
        .withColumn("matches", F.filter(
            F.transform("merged", lambda d: F.struct(
                F.col("label").alias("label"), d["start"].alias("start"), d["end"].alias("end"),
                (_words_under(d["held"], F.col("n")) / F.col("n")).alias("cover"),
            )),
            lambda m: m["cover"] >= COVER,
        ))
        .withColumn("best", F.coalesce(F.array_max(F.transform(
            "merged", lambda d: F.size(d["held"]) / F.col("runs"))), F.lit(0.0)))
    )
    per_document = per_template.groupBy("row").agg(
        F.first("doc").alias("doc"), F.flatten(F.collect_list("matches")).alias("matches"),
        F.max("best").alias("best"),
    )
    base = F.col("doc.base")
    base_labels = F.array_distinct(F.transform(base, lambda b: b["label"]))
    both = F.array_union(base_labels, F.transform("matches", lambda m: m["label"]))
    start = F.transform(base, lambda b: b["start"].cast("long"))
    return per_document.select(
        "doc.doc_id", "doc.n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
        F.array_join(F.sort_array(base_labels), ",").alias("base_labels"),
        F.array_join(F.sort_array(both), ",").alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(F.least(F.col("best"), F.lit(1.0))).alias("score"),
        "matches",
    )
