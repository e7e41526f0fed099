"""Licence scan: trained paragraph classifier with template confirmation, in DataFrame operations (operator 1)."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"
# Notices by licence family.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation."),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("bsd", "Licensed under the 3-Clause BSD License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl", "Licensed under the Mozilla Public License, version 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    *[(f"cc-{short.lower()}", f"This work is licensed under a Creative Commons {long} 4.0 International License.") for short, long in (
        ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))],
    *[(f"cc-{short.lower()}", f"Licensed under CC {short} 4.0.") for short in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")],
    ("cc0", "Licensed under CC0 1.0 Universal."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
# Own examples of paragraphs that share words with notices but grant nothing.
OTHERS = [
    "She renewed her driving license before the trip and asked for a copy of the form.",
    "The general public may visit the library free of charge on any day of the week.",
    "He works for a software company that is known for its version control system.",
    "The conditions of the work were hard, and no permission to leave was granted.",
    "Public domain pictures are easy to find; a license is often needed for other ones.",
    "The council may not use this building without a license from the fire department.",
    "All rights of the author are described in the second version of the contract.",
    "Copyright law differs between countries and is subject to change.",
]
# A paragraph is looked at if it holds one of these; every template does.
ANCHOR = "licen[cs]e|copyright|permission|redistribut|free software|public domain"
# Rows of each kind that the classifier is fitted and calibrated on, at most.
SAMPLE_ROWS = 1_000
VOCABULARY = 1_500
CONFIRM = 0.6
# A line with this share of its word triples (with the two words before or after it) in the templates is part of a notice.
PART = 0.5


def words(text: Column) -> Column:
    # Comment leaders with letters go; the others hold none.
    plain = F.regexp_replace(F.lower(text), r"(?m)^[ \t]*(rem|dnl)[ \t]", "")
    return F.regexp_extract_all(plain, F.lit("([a-z0-9]+)"), F.lit(1))


def grams(tokens: Column, n: int) -> Column:
    """All runs of ``n`` words, each once."""
    last = F.size(tokens) - n
    return F.when(last < 0, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(tokens, i + 1, n), " "))))


def features(tokens: Column) -> Column:
    return F.concat(grams(tokens, 1), grams(tokens, 2))


def _template_triples() -> list[str]:
    every = [re.findall("[a-z0-9]+", text.lower()) for _, text in TEMPLATES]
    return sorted({" ".join(w[i:i + 3]) for w in every for i in range(len(w) - 2)})


def paragraphs(docs: DataFrame) -> DataFrame:
    """``(doc_id, paragraph, start, end, body)`` of the notices and other lines that hold an anchor; places in code points.

    Consecutive lines that are parts of notices are one paragraph, numbered by its first line, so hard-wrapped
    notices are seen whole; a line without words (a comment leader alone) parts them.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        F.lower("text").rlike(ANCHOR))
    cut = rows.select("doc_id", F.split("text", "\n", -1).alias("all"))
    worded = cut.withColumn("_w", F.transform("all", words))
    none, places = F.array().cast("array<string>"), F.sequence(F.lit(0), F.size("all") - 1)
    triples = F.array(*map(F.lit, _template_triples()))

    def part(i: Column) -> Column:
        before, own, after = (F.coalesce(F.get("_w", i + d), none) for d in (-1, 0, 1))
        ends = F.slice(before, F.greatest(F.size(before) - 1, F.lit(1)), F.lit(2)), F.slice(after, 1, 2)
        sides = [grams(x, 3) for x in (F.concat(ends[0], own), F.concat(own, ends[1]))]
        return (F.size(own) > 0) & (F.greatest(*[F.size(F.array_intersect(x, triples)) / F.greatest(F.size(x), F.lit(1)) for x in sides]) >= PART)

    marked = worded.withColumn("_part", F.transform(places, part))

    def longer(found: Column, i: Column) -> Column:
        own, last = F.get("_part", i), F.element_at(found, -1)
        joins = own & (F.size(found) > 0) & last["part"] & (last["last"] == i - 1)
        line = F.array(F.struct(F.when(joins, last["first"]).otherwise(i).alias("first"), i.alias("last"), own.alias("part")))
        rest = F.when(joins, F.slice(found, F.lit(1), F.size(found) - 1)).otherwise(found)
        return F.when(own | F.lower(F.get("all", i)).rlike(ANCHOR), F.concat(rest, line)).otherwise(found)

    runs = F.aggregate(places, F.array().cast("array<struct<first:int,last:int,part:boolean>>"), longer)
    found = marked.select("doc_id", "all", F.explode(runs).alias("_run"))
    lines = found.select("doc_id", "all", F.col("_run.first").alias("paragraph"), F.array_join(
        F.slice("all", F.col("_run.first") + 1, F.col("_run.last") - F.col("_run.first") + 1), "\n").alias("body")).where(F.lower("body").rlike(ANCHOR))
    start = F.aggregate(F.slice("all", F.lit(1), F.col("paragraph")), F.lit(0), lambda a, x: a + F.length(x) + 1)
    return lines.select("doc_id", "paragraph", start.alias("start"), (start + F.length("body")).alias("end"), "body")


@dataclass
class Classifier:
    families: list[str]
    intercept: list[float]
    weight: dict[str, list[float]]
    threshold: float = 0.5

    def _scores(self, tokens: Column) -> Column:
        table = F.create_map(*[c for g, w in self.weight.items() for c in (F.lit(g), F.array(*map(F.lit, w)))])
        zero = F.array(*map(F.lit, self.intercept))
        return F.aggregate(features(tokens), zero, lambda acc, g: F.coalesce(
            F.zip_with(acc, table[g], lambda a, b: a + b), acc))

    def probabilities(self, tokens: Column) -> Column:
        score = self._scores(tokens)
        power = F.transform(score, lambda s: F.exp(s - F.array_max(score)))
        return F.transform(power, lambda p: p / F.aggregate(power, F.lit(0.0), lambda a, x: a + x))

    def apply(self, rows: DataFrame) -> DataFrame:
        """``rows(body, …)`` with ``family``, ``probability``, ``template`` and ``similarity``."""
        scored = rows.withColumn("_t", words(F.col("body"))).withColumn("_p", self.probabilities(F.col("_t")))
        names = F.array(*map(F.lit, self.families))
        known = F.transform(F.arrays_zip("_p", names.alias("f")), lambda x: F.struct(
            F.when(x["f"] == UNKNOWN, F.lit(-1.0)).otherwise(x["_p"]).alias("p"), x["f"].alias("f")))
        best = F.array_max(known)
        tri = grams(F.col("_t"), 3)
        alike = []
        for i, (family, text) in enumerate(TEMPLATES):
            own = grams(words(F.lit(text)), 3)
            alike.append(F.struct(
                F.when(F.col("_best.f") == family, F.size(F.array_intersect("_tri", own)) / F.size(own)).otherwise(-1.0).alias("s"),
                F.lit(i).alias("i")))
        rated = scored.withColumn("_best", best).withColumn("_tri", tri).withColumn("_m", F.array_max(F.array(*alike)))
        sure = F.col("_best.p") >= F.lit(self.threshold)
        confirmed = sure & (F.col("_m.s") >= CONFIRM)
        return rated.select(
            *rows.columns, F.when(confirmed, F.col("_best.f")).otherwise(UNKNOWN).alias("family"),
            F.col("_best.p").alias("probability"), F.when(sure, F.col("_m.i")).alias("template"),
            F.when(sure, F.greatest("_m.s", F.lit(0.0))).alias("similarity"))


def _listed(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("body")) for f, t in rows])))


def train(docs: DataFrame) -> Classifier:
    """Sparse multinomial logistic regression on word n-grams of the templates.

    Positive rows are the templates and parts of them; negative rows are the listed ones and at most
    ``SAMPLE_ROWS`` paragraphs of ``docs`` without an anchor.  Even negatives fit the weights, odd ones set the
    threshold: below it a paragraph's family is unknown.
    """
    spark = docs.sparkSession
    families = [UNKNOWN, *sorted({f for f, _ in TEMPLATES})]
    whole = _listed(spark, TEMPLATES).withColumn("t", words(F.col("body")))
    size = F.size("t")
    parts = whole.select("family", F.explode(F.array(
        F.col("t"), F.slice("t", F.lit(1), F.greatest(F.lit(4), F.ceil(size * 0.7).cast("int"))),
        F.slice("t", F.least(F.floor(size * 0.3).cast("int") + 1, size), size))).alias("t"))
    # A part that another family's template holds too says nothing.
    texts = F.array(*[F.struct(F.lit(f).alias("f"), F.lit(" ".join(["", *re.findall("[a-z0-9]+", t.lower()), ""])).alias("t")) for f, t in TEMPLATES])
    parts = parts.where(~F.exists(texts, lambda x: (x["f"] != F.col("family")) & F.contains(x["t"], F.concat(F.lit(" "), F.array_join("t", " "), F.lit(" ")))))
    total = docs.count()
    share = int(1_000_000 * min(1.0, SAMPLE_ROWS / max(total, 1)))
    plain = docs.select(F.col("text").cast("string").alias("text")).where(
        F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share).select(F.explode(F.split("text", "\n")).alias("body")).where(
        ~F.lower("body").rlike(ANCHOR)).limit(SAMPLE_ROWS)
    negative = _listed(spark, [(UNKNOWN, t) for t in OTHERS]).unionByName(plain.withColumn("family", F.lit(UNKNOWN))).select(
        "family", words(F.col("body")).alias("t"), (F.pmod(F.xxhash64("body"), F.lit(2)) == 0).alias("fit"))
    index = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
    grammed = parts.withColumn("fit", F.lit(True)).unionByName(negative).select(
        "family", "fit", features(F.col("t")).alias("g"), "t", index.alias("label"))
    terms = CountVectorizer(inputCol="g", outputCol="x", vocabSize=VOCABULARY, binary=True).fit(
        grammed.where(F.col("family") != UNKNOWN))
    rows = terms.transform(grammed.where("fit"))
    model = LogisticRegression(featuresCol="x", family="multinomial", regParam=0.003, elasticNetParam=0.5, maxIter=60).fit(rows)
    matrix, intercept = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    families = families[:len(intercept)]
    weight = {g: [float(v) for v in matrix[:, i]] for i, g in enumerate(terms.vocabulary) if abs(matrix[:, i]).max() > 1e-4}
    found = Classifier(families, [float(v) for v in intercept], weight)
    known = F.slice(found.probabilities(F.col("t")), 2, len(families))
    odd = grammed.where(~F.col("fit")).select(F.array_max(known).alias("p"))
    highest = odd.agg(F.max("p")).first()[0]
    found.threshold = min(max(0.5, highest or 0.0), 0.9)
    return found


def scan_licences(docs: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """``(doc_id, paragraph, start, end, family, probability, template, similarity)`` of every candidate paragraph.

    A paragraph is a line, or all lines of a hard-wrapped notice; a candidate holds a licence word.  Its family is the classifier's if its probability
    reaches the calibrated threshold and at least ``CONFIRM`` of a template's word triples occur, else unknown.

    Defined cases: null and empty texts have no candidates; a null doc_id stays null; repeated rows give their
    candidates each; an empty table gives no rows; other columns are ignored.
    """
    return (classifier or train(docs)).apply(paragraphs(docs)).drop("body")
