"""Licence scans: a trained passage classifier, confirmed by comparison with templates.

Everything runs as DataFrame and SQL functions and the DataFrame form of MLlib. A passage is
a sentence of a line. In the result are the passages that the classifier gives a family with a
template that shares a bigram with them, and those with one of the STEMS, whatever they are given.
Only passages that hold a bigram of some template, or a stem, can be of either kind, so one pattern
over the text drops the others before n-grams are made (the result is the same without it).

Training: the sentences of the templates, each again with every single word left out, and the
class `unknown`: sentences that use licence words otherwise, and at most NEGATIVES ordinary
sentences of NEGATIVES / 4 documents (the smallest hashes). Features are hashed word unigrams and bigrams, the
classifier is a sparse multinomial logistic regression. Every fifth variant is held out to fit
the temperature that calibrates the probabilities, `unknown` included.

A prediction stands if its probability is at least MIN_PROBABILITY and the passage holds at
least MIN_SIMILARITY of the word bigrams of a template of that family, or is itself made of
them to that share; every other passage is `unknown`.

Defined cases: null and empty texts have no passages; repeated rows are scanned one by one;
very long lines are split into their sentences; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.llm import common as c

BUCKETS = 1 << 14
NEGATIVES = 2_000
MIN_PROBABILITY = 0.5
MIN_SIMILARITY = 0.6
TEMPERATURES = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]
UNKNOWN = "unknown"

# fixed values: word stems with which a passage is in the result even if its class is `unknown`
STEMS = ("licen", "copyright", "rights reserved", "permission", "redistribut", "warrant", "cc by", "cc-by", "cc0",
         "creative commons", "public domain", "spdx")
# fixed values: notices of well-known licences, by family
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT",
            "This project is available under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction.",
            "The software is provided \"as is\", without warranty of any kind.", "Released under the MIT.",
            "Distributed under MIT.", "Distributed under the MIT.", "Available under the terms of the MIT."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
                   "You may not use this file except in compliance with the License.",
                   "Released under the Apache License 2.0.", "Available under Apache 2.0 terms.",
                   "Distributed under Apache 2.0.",
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.",
            "Licensed under the GNU General Public License version 2.", "SPDX-License-Identifier: GPL-3.0-or-later",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation.",
            "Released under the GNU GPL, a copyleft license, version 3 or later.",
            "Released under the terms of the GNU GPL v3.", "Distributed under the GPL."],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1.",
             "SPDX-License-Identifier: LGPL-2.1-only",
             "You can redistribute it under the terms of the GNU Lesser General Public License."],
    "BSD": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met.", "Released under the BSD 2-Clause license.",
            "Available under BSD terms.", "Distributed under BSD.", "Distributed under the BSD.",
            "Redistributions must retain the above copyright notice, this list of conditions and the following "
            "disclaimer."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
                "This Source Code Form is subject to the terms of the Mozilla Public License."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 "
              "International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons "
                 "Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons "
                 "Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "Public-Domain": ["Dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0",
                      "This is free and unencumbered software released into the public domain."],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved.",
                    "No part of this publication may be reproduced without the prior written permission of the "
                    "copyright holder."],
    UNKNOWN: ["You need a driving licence to rent a car.", "She asked for permission to leave early.",
              "The warranty covers parts and labour for two years.", "Copyright law differs between countries.",
              "The council will issue a licence to sell alcohol.", "Wealth was redistributed after the war.",
              "Permission slips are due on Friday.", "The licence fee went up again this year.",
              "A warrant was issued for his arrest.", "The park is public domain for everyone in town.",
              "His pilot licence was revoked.", "Licensed plumbers must renew every two years."],
}
FAMILIES = sorted(TEMPLATES)


def _words(text):
    return F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda w: w != "")


def _bigrams(words):
    n = F.size(words)
    return F.when(n > 1, F.transform(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), lambda w, i: F.concat_ws(
        " ", w, F.element_at(words, i + 2)))).otherwise(words)


def _stemmed(text):
    lower, out = F.lower(text), F.lit(False)
    for stem in STEMS:
        out = out | F.contains(lower, F.lit(stem))
    return out


def _either(words: list[str]) -> str:
    """A pattern for any of the words, as a tree of their first letters (few branches to try)."""
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[:1], []).append(w[1:])
    parts = [re.escape(h) + (_either(rest) if any(rest) else "") for h, rest in sorted(heads.items()) if h]
    return f"(?:{'|'.join(parts)}){'?' if '' in heads else ''}" if parts else ""


def _may_match(text):
    """Whether a text holds a word bigram of any template of a family, or a stem."""
    after: dict[str, set[str]] = {}
    for family, own in TEMPLATES.items():
        for t in own if family != UNKNOWN else ():
            words = re.findall("[a-z0-9]+", t.lower())
            for a, b in zip(words, words[1:] or words, strict=False):
                after.setdefault(a, set()).add(b)
    firsts: dict[tuple[str, ...], list[str]] = {}  # first words with the same second words
    for a, b in after.items():
        firsts.setdefault(tuple(sorted(b)), []).append(a)
    pairs = "|".join(f"{_either(sorted(a))}[^a-z0-9]+{_either(list(b))}" for b, a in sorted(firsts.items()))
    return F.lower(text).rlike(f"(?<![a-z0-9])(?:{pairs})(?![a-z0-9])") | _stemmed(text)


def _sentences(text):
    """Sentences of the lines of a text, numbered by line and within it."""
    lines = F.posexplode(F.split(text, "\n"))
    return lines, r"(?<=[.!?])\s+"


def sentences(docs: DataFrame) -> DataFrame:
    """doc_id, line, sentence, passage of every passage."""
    lines, end = _sentences("text")
    return (c.texts(docs).select("doc_id", lines.alias("line", "_line"))
            .select("doc_id", "line", F.posexplode(F.split("_line", end)).alias("sentence", "passage")))


def passages(docs: DataFrame) -> DataFrame:
    """doc_id, line, sentence, passage of every passage that has a licence stem."""
    return sentences(docs).filter(_stemmed(F.col("passage")))


def _grams(df: DataFrame) -> DataFrame:
    words = _words(F.col("passage"))
    return df.withColumn("_words", words).withColumn("_bigrams", _bigrams(F.col("_words"))).withColumn(
        "_grams", F.concat("_words", F.transform("_bigrams", lambda b: F.concat(F.lit("2:"), b))))


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f, t) for f in FAMILIES for t in TEMPLATES[f]], "family string, passage string")


def _training(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """family, passage, held: template sentences, their variants, and ordinary sentences."""
    base = templates(spark).withColumn("_w", F.split("passage", " "))
    keep = lambda i: F.array_join(F.concat(F.slice("_w", F.lit(1), i), F.slice("_w", i + 2, F.size("_w"))), " ")
    variants = base.filter(F.size("_w") > 3).select("family", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("_w") - 1), keep)).alias("passage"))
    lines, end = _sentences("text")
    key = F.xxhash64("passage")
    some = c.smallest_hashes(c.texts(docs), NEGATIVES // 4, "doc_id", "text")
    plain = (some.select(lines.alias("_l", "_line"))
             .select(F.explode(F.split("_line", end)).alias("passage"))
             .filter(~_stemmed(F.col("passage")) & (F.length("passage") > 20))
             .distinct().orderBy(key, "passage").limit(NEGATIVES).select(F.lit(UNKNOWN).alias("family"), "passage"))
    rows = base.select("family", "passage").unionByName(variants).unionByName(plain)
    return rows.withColumn("held", F.pmod(F.xxhash64("passage", F.lit(1)), F.lit(5)) == 0)


class Classifier:
    """Hashed n-gram logistic regression over FAMILIES with a fitted temperature."""

    def __init__(self, spark: SparkSession, docs: DataFrame) -> None:
        label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
        self.hash = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=BUCKETS, binary=True)
        rows = self.hash.transform(_grams(c.cut(_training(spark, docs)).coalesce(4))).withColumn("label", label.cast("double"))
        # every family has a template that is not held out: single templates are always trained on
        fit = LogisticRegression(featuresCol="_features", labelCol="label", rawPredictionCol="_raw",
                                 probabilityCol="_p", predictionCol="_at", family="multinomial", regParam=1e-3,
                                 maxIter=40)
        self.model = fit.fit(rows.filter(~F.col("held") | F.col("passage").isin(
            [t for f in FAMILIES for t in TEMPLATES[f]])))
        raw = self.model.transform(rows.filter("held")).withColumn("_z", vector_to_array("_raw"))
        nll = [F.avg(-F.log(F.element_at(_softmax(F.col("_z"), t), (F.col("label") + 1).cast("int")) + 1e-12))
               .alias(str(i)) for i, t in enumerate(TEMPERATURES)]
        losses = raw.agg(*nll).first()
        self.temperature = min(zip([x if x is not None else 0.0 for x in losses], TEMPERATURES))[1]

    def predict(self, df: DataFrame) -> DataFrame:
        """df with predicted and probability."""
        p = _softmax(F.element_at(F.array("_z"), 1), self.temperature)
        out = self.model.transform(self.hash.transform(df)).withColumn("_z", vector_to_array("_raw"))
        out = out.withColumn("_prob", p).withColumn("probability", F.array_max("_prob"))
        at = F.array_position("_prob", F.col("probability")).cast("int")
        return out.withColumn("predicted", F.element_at(F.array(*map(F.lit, FAMILIES)), at))


def _softmax(z, temperature: float):
    top = F.array_max(z)
    e = F.transform(z, lambda v: F.exp((v - top) / temperature))
    total = F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
    return F.transform(e, lambda v: v / total)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, line, sentence, passage, family, predicted, probability, similarity, confirmed
    of every passage that the classifier gives a family with a similar template, or that has a licence stem."""
    spark = docs.sparkSession
    every = _grams(sentences(docs).filter(_may_match(F.col("passage"))))
    found = Classifier(spark, docs).predict(every)
    # a generated column: a filter on it is not moved below the model and computed twice
    found = found.select("doc_id", "line", "sentence", "passage", "_bigrams", F.explode(F.array(
        F.struct("predicted", "probability"))).alias("_found")).select(
        "doc_id", "line", "sentence", "passage", "_bigrams", "_found.*")
    known = _grams(templates(spark).filter(F.col("family") != UNKNOWN)).select(
        "family", F.array_distinct("_bigrams").alias("_t"))
    known = known.groupBy("family").agg(F.collect_list("_t").alias("_ts"))  # TEMPLATES: a fixed table
    own = F.array_distinct("_bigrams")
    share = F.transform("_ts", lambda t: F.greatest(
        F.size(F.array_intersect(t, own)) / F.size(t),
        F.when(F.size(own) > 2, F.size(F.array_intersect(t, own)) / F.size(own)).otherwise(0.0)))
    out = (found.join(F.broadcast(known), found["predicted"] == known["family"], "left").drop("family")
           .withColumn("similarity", F.coalesce(F.array_max(share), F.lit(0.0)))
           .filter((F.col("similarity") > 0) | _stemmed(F.col("passage"))))
    confirmed = ((F.col("predicted") != UNKNOWN) & (F.col("probability") >= MIN_PROBABILITY)
                 & (F.col("similarity") >= MIN_SIMILARITY))
    return out.select("doc_id", "line", "sentence", "passage",
                      F.when(confirmed, F.col("predicted")).otherwise(UNKNOWN).alias("family"),
                      "predicted", "probability", "similarity", confirmed.alias("confirmed"))
