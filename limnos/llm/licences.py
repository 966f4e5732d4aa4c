"""License scans: a trained paragraph classifier, and comparison with templates.

A line is a paragraph; a line of more than WINDOW words is cut into overlapping windows, which are all scored. As notices
are often wrapped, each line is also read on into the lines after it, up to the next line without words: its last OVERLAP
words and the OVERLAP words that follow. No template is longer than that.

Paragraphs become sets of word n-grams, each the 64-bit hash of the hashes of its words, put into a sparse vector; a
multinomial logistic regression with an L1 penalty tells licence families from each other and from paragraphs that are no licence. It is trained on the labelled paragraphs
below, with at most BACKGROUND different lines of the corpus as the unknown class, each counting once however often it
occurs. Lines of the corpus fall into two halves: one is for the fit, all different paragraphs of the other calibrate: a
family counts only above the probability that CALIBRATION of them stay below. Paragraphs at or above it are compared with
the templates of their family. All others are compared with every template too, so that a notice that is in the list is
confirmed whatever the classifier says.

Everything runs on columns: SQL functions, and the vector and regression stages of the Spark ML library. Null and
empty texts have no paragraphs. Rows without an id and repeated rows are scanned like others. A corpus without
paragraphs is scanned with the labelled ones alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from limnos.llm.shared import id_and_text, saved

GRAMS = (1, 2, 3)
BUCKETS = 1 << 14
WINDOW, OVERLAP = 128, 64  # words
BACKGROUND = 4000  # most different lines of the corpus that the fit sees
CALIBRATION = 0.999
LEAST_PROBABILITY = 0.5
SIMILARITY = 0.6  # least share of a template's n-grams that a paragraph must hold
RUNS = 1 / 3  # least share of its longest n-grams, where the classifier does not back the comparison
UNKNOWN = "unknown"

# Texts of licences by family; a paragraph is confirmed by one of them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU GPL version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Available under the Creative Commons Attribution-NonCommercial licence.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0 1.0).",
        "This work is in the public domain.",
    ],
    "Proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ],
}

# Paragraphs near the subject that are no licence.
NO_LICENCE = [
    "The driver must carry a license at all times.", "Her fishing licence expired last year.", "The apache helicopters landed at dawn.",
    "He studied at MIT before he moved to Boston.", "A new version of the report will be released next week.", "The public library is open to the general public.",
    "Civil rights movements of the nineteenth century.", "All seats are reserved for guests.", "The foundation was laid in 1887 and the house was free of debt.",
    "Creative people meet in the commons every Tuesday.", "The software was distributed to all schools without delay.", "Permission to enter the building was refused.",
    "The conditions in the camp were terrible and no warranty could help.", "You may use the kitchen until ten in the evening.", "This work took him three years to write.",
    "The source of the river is high in the mountains.", "Version 3 of the plan was rejected by the council.", "The terms of the treaty were published in April.",
    "The law requires every shop to close at eight.", "Copies of the letter were sent to all members.", "The notice on the door was hard to read.",
    "A domain name is not the same as a host name.", "Mozilla is a browser that many people used.", "The wild reserve is home to many birds.", "",
]


@dataclass(frozen=True)
class Scanner:
    model: LogisticRegressionModel
    families: list[str]
    least_probability: float


WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
# Words that tell nothing of licences; an n-gram with any other word is telling.
COMMON = frozenset("a above all an and any are as at be been by following for free from have in into is it law may no not of on or part person published shall should that the this to under use via whom with without work you".split())


def words(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(WORD), F.lit(0))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column through a generator, so that Spark does not compute it anew wherever it is used."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _with_grams(df: DataFrame) -> DataFrame:
    """``df`` with the hashes of all n-grams of its words; fewer words than n have none of that length.

    The hash of n words is that of the hash of n - 1 words and the hash of the last one, so no text is joined.
    """
    df = _once(df, "grams1", F.transform("words", lambda w: F.xxhash64(w)))
    for n in GRAMS[1:]:
        left = F.greatest(F.size("words") - (n - 1), F.lit(0))
        df = _once(df, f"grams{n}", F.zip_with(F.slice(f"grams{n - 1}", 1, left), F.slice("grams1", n, left), lambda g, w: F.xxhash64(g, w)))
    each = [f"grams{n}" for n in GRAMS]
    return _once(df, "grams", F.concat(*each)).drop(*each)


def _gram_hash(gram: Column) -> Column:
    """The hash of one n-gram, given as an array of words."""
    rest = F.slice(gram, 2, F.size(gram))
    return F.aggregate(rest, F.xxhash64(gram[0]), lambda g, w: F.xxhash64(g, F.xxhash64(w)))


def needed_words(share: float) -> list[str]:
    """Words of which a text must hold at least one to hold ``share`` of any template's telling n-grams."""
    needed: set[str] = set()
    for template in (t for texts in TEMPLATES.values() for t in texts):
        own = re.findall(WORD, template.lower())
        all_grams = {g for n in GRAMS for i in range(len(own) - n + 1) if not COMMON.issuperset(g := tuple(own[i : i + n]))}
        left = {g for g in all_grams if needed.isdisjoint(g)}
        while len(left) >= share * len(all_grams):
            needed.add(max({w for g in left for w in g}, key=lambda w: (w not in COMMON, sum(w in g for g in left), w)))
            left = {g for g in left if needed.isdisjoint(g)}
    return sorted(needed)


def _holds_needed(share: float) -> Column:
    needed = needed_words(share)
    return F.exists("words", lambda w: w.isin(needed))


def _windows(words_column: Column) -> Column:
    """All windows of WINDOW words, each beginning OVERLAP before the end of the one before it; a short line is one."""
    size = F.size(words_column)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), size - OVERLAP), F.lit(WINDOW - OVERLAP))
    return F.when(size <= WINDOW, F.array(words_column)).otherwise(F.transform(starts, lambda i: F.slice(words_column, i, WINDOW)))


def _texts(docs: DataFrame, id_column: str, text_column: str, *also: Column) -> DataFrame:
    """(doc_id, row, lines, and columns of the text): the words of all lines of each text."""
    lines = F.transform(F.split("text", "\n"), words)
    texts = id_and_text(docs, id_column, text_column).select("doc_id", F.monotonically_increasing_id().alias("row"), "text", *also)
    return _once(texts, "lines", lines).drop("text")


def _lines(texts: DataFrame, *also: str) -> DataFrame:
    """(doc_id, row, paragraph, line, and columns of the text): each line that has words."""
    return texts.select("doc_id", "row", *also, F.posexplode("lines").alias("paragraph", "line")).where(F.size("line") > 0)


def paragraphs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, row, paragraph, words): the windows of all lines that hold a word; lines are numbered from 0."""
    return _lines(_texts(docs, id_column, text_column)).select("doc_id", "row", "paragraph", F.explode(_windows(F.col("line"))).alias("words"))


def _read_on(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, row, paragraph, words, own, after): the end of each line, and what follows up to a line without words.

    Only where any of these words is needed by a template: texts and lines that are far from such words are left early.
    """
    needed = needed_words(SIMILARITY)
    near = F.transform("lines", lambda line: F.exists(line, lambda w: w.isin(needed)))
    texts = _once(_texts(docs, id_column, text_column), "near", near).where(F.array_contains("near", True))
    close = F.array_contains(F.slice("near", F.col("paragraph") + 1, OVERLAP + 1), True)
    after = F.slice("lines", F.col("paragraph") + 2, OVERLAP)
    stop = F.array_position(F.transform(after, F.size), 0).cast("int")
    after = F.slice(F.flatten(F.when(stop > 0, F.slice(after, 1, F.greatest(stop - 1, F.lit(0)))).otherwise(after)), 1, OVERLAP)
    own = F.slice("line", F.greatest(F.size("line") - OVERLAP, F.lit(0)) + 1, OVERLAP)
    both = _lines(texts, "lines", "near").where(close).select("doc_id", "row", "paragraph", F.inline(F.array(F.struct(own.alias("own"), after.alias("after")))))
    return _once(both.where(F.size("after") > 0), "words", F.concat("own", "after")).where(F.exists("words", lambda w: w.isin(needed)))


def templates(spark: SparkSession) -> DataFrame:
    """(family, template, and its n-grams: all, the longest ones, and the telling ones): a table of fixed size."""
    rows = []
    for family, template in ((f, t) for f, texts in TEMPLATES.items() for t in texts):
        own = re.findall(WORD, template.lower())
        grams = [own[i : i + n] for n in GRAMS for i in range(len(own) - n + 1)]
        rows.append((family, template, grams, [g for g in grams if len(g) == min(GRAMS[-1], len(own))], [g for g in grams if not COMMON.issuperset(g)]))
    kinds = ("template_grams", "template_runs", "template_telling")
    given = spark.createDataFrame(rows, "family string, template string, " + ", ".join(f"{k} array<array<string>>" for k in kinds))
    hashed = [F.array_distinct(F.transform(k, _gram_hash)).alias(k) for k in kinds]
    return saved(given.select("family", "template", *hashed).coalesce(1), "licence-templates")


def _known(spark: SparkSession) -> DataFrame:
    """All templates as one row with one array."""
    return templates(spark).agg(F.collect_list(F.struct("family", "template", "template_grams", "template_runs", "template_telling")).alias("known"))


def _share(of: Column, grams_column: str | Column = "grams") -> Column:
    return F.size(F.array_intersect(grams_column, of)) / F.size(of)


def _certain(telling: Column, runs: Column) -> Column:
    """What a paragraph must hold besides, where no prediction backs the comparison: scattered or common words will not do."""
    return (_share(telling) >= SIMILARITY) & (_share(runs) >= RUNS)


def _vectors(with_grams: DataFrame) -> DataFrame:
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="grams", outputCol="features").transform(with_grams)


def _with_nearness(with_grams: DataFrame, where: Column) -> DataFrame:
    """``near``: whether a paragraph is near a template, looked at only in the rows of ``where``."""
    near = F.exists("known", lambda t: _share(t["template_telling"]) >= SIMILARITY / 2)
    known = F.broadcast(_known(with_grams.sparkSession))
    return _once(with_grams.crossJoin(known), "near", F.when(where & _holds_needed(SIMILARITY / 2), near).otherwise(F.lit(False))).drop("known")


def _not_near(with_grams: DataFrame) -> DataFrame:
    """Without paragraphs that are near a template: they have no place in the unknown class."""
    return _with_nearness(with_grams, F.lit(True)).where(~F.col("near")).drop("near")


def background(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(words, weight): BACKGROUND different lines of the first half, or all if there are fewer.

    A line's place in the order is by its hash; only hashes are shuffled. The windows of a line share its weight of 1.
    """
    lines = id_and_text(docs, id_column, text_column).select(F.explode(F.split("text", "\n")).alias("line")).where(F.lower("line").rlike("[a-z0-9]"))
    hashed = lines.select("line", F.xxhash64(F.lower("line")).alias("hash")).where(F.pmod("hash", F.lit(2)) == 0)
    drawn = saved(hashed.select("hash").distinct().orderBy("hash").limit(BACKGROUND), "licence-drawn")  # of fixed size
    chosen = hashed.join(F.broadcast(drawn), "hash", "left_semi").groupBy("hash").agg(F.min("line").alias("line"))
    cut = chosen.select(F.explode(F.array(_windows(words(F.col("line"))))).alias("cut"))
    return cut.select(F.explode("cut").alias("words"), (F.lit(1.0) / F.size("cut")).alias("weight"))


def _trained(docs: DataFrame, id_column: str, text_column: str) -> tuple[LogisticRegressionModel, list[str]]:
    """The model of the labelled paragraphs and a bounded background of one half, and the names of its classes."""
    spark = docs.sparkSession
    families = [UNKNOWN, *TEMPLATES]
    given = [(t, float(families.index(f))) for f, texts in TEMPLATES.items() for t in texts] + [(t, 0.0) for t in NO_LICENCE]
    labelled = spark.createDataFrame(given, "line string, label double").select(words(F.col("line")).alias("words"), "label", F.lit(20.0).alias("weight"))
    unknown = saved(_not_near(_with_grams(background(docs, id_column, text_column))).select("words", F.lit(0.0).alias("label"), "weight"), "licence-background")
    model = LogisticRegression(family="multinomial", weightCol="weight", regParam=2e-4, elasticNetParam=0.9, maxIter=40).fit(_vectors(_with_grams(labelled.unionByName(unknown).coalesce(1))))
    return model, families


def _threshold(held: DataFrame) -> float:
    """The probability that CALIBRATION of the different held-back paragraphs (hash, best) stay below."""
    each = held.groupBy("hash").agg(F.max("best").alias("best"))
    return max(LEAST_PROBABILITY, each.agg(F.percentile_approx("best", CALIBRATION, 100_000)).first()[0] or 0.0)


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Scanner:
    """Train on the labelled paragraphs and a bounded background of one half, calibrate on all of the other half."""
    model, families = _trained(docs, id_column, text_column)
    lines = id_and_text(docs, id_column, text_column).select(F.explode(F.split("text", "\n")).alias("line")).where(_held_back(F.col("line")))
    held = lines.select(F.explode(F.array(words(F.col("line")))).alias("line")).where(F.size("line") > 0).select(F.explode(_windows(F.col("line"))).alias("words"))
    scored = _with_family(model, families, _vectors(_not_near(_with_grams(held))))
    return Scanner(model, families, _threshold(scored.select(F.xxhash64("words").alias("hash"), "best")))


def _held_back(line: Column) -> Column:
    return F.pmod(F.xxhash64(F.lower(line)), F.lit(2)) == 1


def scan_itself(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``scan(docs, fit(docs))``, but each paragraph is scored once, for the threshold and for the scan.

    What is saved of a paragraph is its probability, where it calibrates, and its words only where it may be a licence.
    """
    model, families = _trained(docs, id_column, text_column)
    texts = _texts(docs, id_column, text_column, F.transform(F.split("text", "\n"), _held_back).alias("halves"))
    cut = _lines(texts, "halves").select("doc_id", "row", "paragraph", F.element_at("halves", F.col("paragraph") + 1).alias("held"), F.explode(_windows(F.col("line"))).alias("words"))
    scored = _with_family(model, families, _vectors(_with_nearness(_with_grams(cut), F.col("held"))))
    scored = _once(scored, "candidate", (F.col("best") >= LEAST_PROBABILITY) | _holds_needed(SIMILARITY)).withColumn("calibrates", F.col("held") & ~F.col("near"))
    kept = scored.where(F.col("candidate") | F.col("calibrates")).select(
        "candidate", "calibrates", "best", F.when(F.col("calibrates"), F.xxhash64("words")).alias("hash"),
        *[F.when(F.col("candidate"), F.col(c)).alias(c) for c in ("doc_id", "row", "paragraph", "words", "licences", "family")])
    kept = saved(kept, "licence-scores")
    scanner = Scanner(model, families, _threshold(kept.where("calibrates").select("hash", "best")))
    return _found(_confirmed(_with_grams(kept.where("candidate").drop("candidate", "calibrates", "hash")), scanner), _wrapped(docs, scanner, id_column, text_column))


def _with_family(model: LogisticRegressionModel, families: list[str], vectors: DataFrame) -> DataFrame:
    """The likeliest licence family, its probability ``best``, and those of all families as ``licences``."""
    licences = F.slice(vector_to_array("probability"), 2, len(families) - 1)
    found = model.transform(vectors).drop("features", "rawPrediction", "prediction").select("*", F.explode(F.array(licences)).alias("licences")).drop("probability")
    found = found.withColumn("best", F.array_max("licences"))
    return found.withColumn("family", F.element_at(F.array(*map(F.lit, families[1:])), F.array_position("licences", F.col("best")).cast("int")))


def _probability(families: list[str], family: Column) -> Column:
    return F.element_at("licences", F.array_position(F.array(*map(F.lit, families[1:])), family).cast("int"))


def _confirmed(scored: DataFrame, scanner: Scanner) -> DataFrame:
    """Lines that are predicted or confirmed, one row each, of scored paragraphs with their n-grams."""
    scored = scored.withColumn("predicted", F.col("best") >= scanner.least_probability).where(F.col("predicted") | _holds_needed(SIMILARITY))
    shares = F.transform("known", lambda t: F.struct(_share(t["template_grams"]).alias("similarity"), (t["family"] == F.col("family")).alias("same"), t["family"].alias("family"),
                                                     t["template"].alias("template"), t["template_runs"].alias("runs"), t["template_telling"].alias("telling")))
    shares = scored.crossJoin(F.broadcast(_known(scored.sparkSession))).select("*", F.explode(F.array(shares)).alias("shares")).drop("known")
    sure = lambda t: (t["similarity"] >= SIMILARITY) & ((F.col("predicted") & t["same"]) | _certain(t["telling"], t["runs"]))
    confirmed, own = F.array_max(F.filter("shares", sure)), F.array_max(F.filter("shares", lambda t: t["same"]))
    nearest = shares.select("*", F.explode(F.array(F.struct(confirmed.isNotNull().alias("confirmed"), F.coalesce(confirmed, own).alias("t")))).alias("nearest"))
    rows = nearest.where(F.col("nearest.confirmed") | F.col("predicted")).select(
        "doc_id", "row", "paragraph", F.struct("nearest.confirmed", F.col("nearest.t.similarity"), _probability(scanner.families, F.col("nearest.t.family")).alias("probability"),
                                        F.col("nearest.t.family"), F.col("nearest.t.template")).alias("found"))
    return rows.groupBy("row", "paragraph").agg(F.first("doc_id").alias("doc_id"), F.max("found").alias("found"))


def _wrapped(docs: DataFrame, scanner: Scanner, id_column: str, text_column: str) -> DataFrame:
    """Templates that are confirmed only where lines are read on, at the line where they begin.

    The line alone and what follows alone must each hold fewer of the template's longest n-grams. Of the readings of a
    template that begin at neighbouring lines the best one stays, the first of equal ones.
    """
    read = _with_grams(_read_on(docs, id_column, text_column))
    grams = read.crossJoin(F.broadcast(templates(docs.sparkSession))).where((_share(F.col("template_grams")) >= SIMILARITY) & _certain(F.col("template_telling"), F.col("template_runs"))).withColumn("similarity", _share(F.col("template_grams")))
    for part in ("own", "after"):
        alone = _with_grams(grams.withColumnsRenamed({"words": "¶words", "grams": "¶grams"}).withColumn("words", F.col(part)))
        grams = alone.where(_share(F.col("template_runs")) < _share(F.col("template_runs"), "¶grams")).drop("words", "grams").withColumnsRenamed({"¶words": "words", "¶grams": "grams"})
    scored = _with_family(scanner.model, scanner.families, _vectors(grams.withColumnRenamed("family", "of"))).select(
        "doc_id", "row", "paragraph", "similarity", _probability(scanner.families, F.col("of")).alias("probability"), F.col("of").alias("family"), "template")
    order = Window.partitionBy("row", "template").orderBy("paragraph")
    near = lambda f: F.coalesce(F.abs(f("paragraph").over(order) - F.col("paragraph")) <= 1, F.lit(False))
    worse = (near(F.lag) & (F.lag("similarity").over(order) >= F.col("similarity"))) | (near(F.lead) & (F.lead("similarity").over(order) > F.col("similarity")))
    return scored.withColumn("worse", worse).where(~F.col("worse")).select(
        "doc_id", "paragraph", F.struct(F.lit(True).alias("confirmed"), "similarity", "probability", "family", "template").alias("found"))


def scan(docs: DataFrame, scanner: Scanner, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each line that is predicted to be of a licence family, or that holds or begins a confirmed notice.

    doc_id, paragraph (the line's number), family, its probability, template and similarity of the nearest template of
    that family, and confirmed: the similarity is SIMILARITY or more.
    """
    scored = _with_family(scanner.model, scanner.families, _vectors(_with_grams(paragraphs(docs, id_column, text_column))))
    return _found(_confirmed(scored, scanner), _wrapped(docs, scanner, id_column, text_column))


def _found(lines: DataFrame, wrapped: DataFrame) -> DataFrame:
    columns = ["doc_id", "paragraph", "found"]
    rows = lines.select(columns).union(wrapped.select(columns))
    return rows.select("doc_id", F.col("paragraph").cast("bigint").alias("paragraph"), *[f"found.{c}" for c in ("family", "probability", "template", "similarity", "confirmed")])
