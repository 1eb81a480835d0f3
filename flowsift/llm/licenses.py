"""License scans by diagonal voting; DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.llm.words import ALNUM, ascii_lower
from flowsift.session import stage

# Phrases of the contract and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices as licenses ask for them, and short forms in common use.
NOTICES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or any later version"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
]

#: Words of one gram of phrases and of notices.
PHRASE_GRAM, NOTICE_GRAM = 2, 3
#: Diagonals this near belong to one copy with words put in or left out.
NEAR = 2
#: Share of a notice's grams that must vote, and of its words that the span must have.
VOTES, WORDS = 0.6, 0.8


def template_words(text: str) -> list[str]:
    return re.findall(ALNUM, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def _templates(spark) -> tuple[DataFrame, DataFrame]:
    """``template, label, exact, words`` and the grams ``template, at, gram, size``; fixed small tables."""
    texts = [(label, True, template_words(p)) for p, label in PHRASES.items()] + [(label, False, template_words(t)) for label, t in NOTICES]
    templates = spark.createDataFrame([(i, label, exact, words) for i, (label, exact, words) in enumerate(texts)], "template int, label string, exact boolean, words array<string>")
    grams = []
    for i, (_, exact, words) in enumerate(texts):
        k = PHRASE_GRAM if exact else NOTICE_GRAM
        grams += [(i, at, *(words[at : at + k] + [None] * (3 - k)), k) for at in range(len(words) - k + 1)]
    table = spark.createDataFrame(grams, "template int, at int, w0 string, w1 string, w2 string, size int")
    gram = F.when(F.col("size") == 2, F.xxhash64("w0", "w1")).otherwise(F.xxhash64("w0", "w1", "w2"))
    return templates, table.select("template", "at", gram.alias("gram"), "size")


def _gram(words: str, i: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(F.col(words), i + j) for j in range(size)])


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """License phrases and notices of every whole text.

    Returns the documents (``doc_id, text_hash, n_words``) and the spans found (``doc_id, text_hash,
    label, exact, start, end, coverage``, word positions, end exclusive). All rolling grams of words meet
    the template positions by hash. A gram votes for the diagonal on which the template would begin.
    Phrases need all votes on one diagonal; for notices neighbouring diagonals are taken together.
    Spans are then compared by their words.

    A NULL text is empty. Rows that repeat id and text share their spans, a NULL id is an id like others
    here. An empty table gives no rows; other columns are not read. Only documents with a matching gram
    take part in a shuffle; grams meet the templates inside the scan, votes are summed by document.
    """
    spark = docs.sparkSession
    templates, grams = _templates(spark)
    known = {size: [r.gram for r in grams.where(F.col("size") == size).select("gram").distinct().collect()] for size in (PHRASE_GRAM, NOTICE_GRAM)}
    content = F.coalesce(F.col(text), F.lit(""))
    split = F.array_remove(F.split(ascii_lower(F.col(text)), ALNUM.replace("[^", "[", 1)), "")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(content).alias("text_hash"), split.alias("words"))
    places = F.filter(
        F.sequence(F.lit(0), F.size("words") - PHRASE_GRAM),
        lambda i: _gram("words", i, PHRASE_GRAM).isin(known[PHRASE_GRAM]) | _gram("words", i, NOTICE_GRAM).isin(known[NOTICE_GRAM]),
    )
    places = F.when(F.size("words") >= PHRASE_GRAM, places)
    rows = rows.withColumn("places", places)
    found = F.size("places") > 0
    scanned = stage(
        rows.select("doc_id", "text_hash", F.size("words").cast("bigint").alias("n_words"), F.when(found, F.col("places")).alias("places"), F.when(found, F.col("words")).alias("words")),
        "license-scan",
    )
    documents = scanned.select("doc_id", "text_hash", "n_words")
    hits = scanned.where("places IS NOT NULL").dropDuplicates(["doc_id", "text_hash"])
    hits = hits.select("doc_id", "text_hash", "words", F.explode("places").alias("i"))
    both = F.array(*[F.struct(F.lit(k).alias("size"), _gram("words", F.col("i"), k).alias("gram")) for k in (PHRASE_GRAM, NOTICE_GRAM)])
    hits = hits.select("doc_id", "text_hash", "i", F.inline(both))
    # the templates are a fixed list of this module
    votes = hits.join(F.broadcast(grams), ["size", "gram"]).select("doc_id", "text_hash", "template", "i", "at", (F.col("i") - F.col("at")).alias("diagonal"))
    key = ["doc_id", "text_hash", "template"]
    diagonals = votes.groupBy(*key, "diagonal").agg(F.collect_set("at").alias("voters"), F.min("i").alias("first"), F.max("i").alias("last"))
    diagonals = diagonals.join(F.broadcast(templates.drop("label")), "template").withColumnRenamed("words", "wanted")
    ordered = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(ordered) > F.when(F.col("exact"), 0).otherwise(NEAR), F.lit(True))
    clusters = diagonals.withColumn("cluster", F.sum(apart.cast("int")).over(ordered))
    spans = clusters.groupBy(*key, "cluster", "exact", "wanted").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("voters")))).alias("votes"),
        F.min("first").alias("start"),
        (F.max("last") + F.max(F.when(F.col("exact"), PHRASE_GRAM).otherwise(NOTICE_GRAM))).alias("end"),
    )
    size = F.when(F.col("exact"), PHRASE_GRAM).otherwise(NOTICE_GRAM)
    spans = spans.withColumn("share", F.col("votes") / (F.size("wanted") - size + 1)).where(F.col("share") >= F.when(F.col("exact"), 1.0).otherwise(VOTES))
    texts = scanned.where("places IS NOT NULL").select("doc_id", "text_hash", "words").dropDuplicates(["doc_id", "text_hash"])
    same = spans.doc_id.eqNullSafe(texts.doc_id) & (spans.text_hash == texts.text_hash)
    checked = spans.join(texts, same).select(spans["*"], F.slice("words", F.col("start") + 1, F.col("end") - F.col("start")).alias("span"))
    common = F.size(F.array_intersect("span", "wanted")) / F.size(F.array_distinct("wanted"))
    checked = checked.withColumn("coverage", F.when(F.col("exact"), F.when(F.col("span") == F.col("wanted"), 1.0).otherwise(0.0)).otherwise(common))
    checked = checked.where(F.when(F.col("exact"), F.col("coverage") == 1.0).otherwise((F.col("coverage") >= WORDS) & (F.size("span") <= 2 * F.size("wanted"))))
    # of notices that begin at one word, such as two versions of a license, the nearest stays
    nearest = F.max(F.when(~F.col("exact"), F.col("coverage"))).over(Window.partitionBy("doc_id", "text_hash", "start"))
    checked = checked.withColumn("nearest", nearest).where(F.col("exact") | (F.col("coverage") == F.col("nearest")))
    labelled = checked.join(F.broadcast(templates.select("template", "label")), "template")
    return documents, labelled.select("doc_id", "text_hash", "label", "exact", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "coverage")


def license_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: places of base phrases, labels, and a score.

    ``score`` is the largest coverage of a span, 1 for a base phrase, 0 without a span. Labels are
    empty strings where nothing is found.
    """
    documents, spans = scan_licenses(docs, doc_id, text)
    base = F.when(F.col("exact"), F.col("label"))
    summary = spans.groupBy("doc_id", "text_hash").agg(
        F.count_if("exact").alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score"),
    )
    same = documents.doc_id.eqNullSafe(summary.doc_id) & (documents.text_hash == summary.text_hash)
    return documents.join(summary, same, "left").select(
        documents.doc_id,
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
