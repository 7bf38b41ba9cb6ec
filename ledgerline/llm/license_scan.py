"""License scan by a trained paragraph classifier, DataFrame functions and Spark ML only.

Paragraphs are the lines of a text that hold a word. Sparse features (hashed words and word pairs) feed a multinomial
logistic regression over the license families and the class unknown. It is trained on variants of the templates below and on at
most ``MAX_UNKNOWN`` paragraphs of the corpus that share no three words in a row with a template, picked by hash.
A third of these rows, held out of a first fit, calibrate it: a second regression turns the score of the best family
into the probability that the family is right; below one half a paragraph is unknown. The scores are then those of a fit to all the rows. What remains is confirmed by comparison: of the word triples of the paragraph or
of a template of that family, whichever are fewer, at least ``CONFIRM`` must be shared.

Every paragraph of every text is scored where it lies; only one row per document is shuffled. The model and the templates
have a fixed size. Row ids and paragraphs come from one pass, so repeated rows and ids stay apart.

Null text is empty: no paragraphs. Without corpus paragraphs the unknown class is trained on fixed neutral sentences
alone. An empty table gives an empty result. Very long paragraphs need memory in proportion to
their length. Further columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, stored

UNKNOWN = "unknown"
FEATURES = 1 << 15
MAX_UNKNOWN = 5_000
#: Longest paragraph, in characters, among the sampled ones.
SAMPLED_LENGTH = 2_000
CONFIRM = 0.6

#: Standard notices of the license families.
TEMPLATES = [
    ("agpl", "licensed under the GNU Affero General Public License, version 3."),
    ("agpl", "GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("apache", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"),
    ("bsd", "Released under the 3-Clause BSD License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program."),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("reserved", "All rights reserved."),
    ("reserved", "All rights reserved. No part of this work may be reproduced without written permission of the publisher."),
]
#: Neutral sentences that speak of rights, versions or permission without granting a license.
NEUTRAL = [
    "He lost his driving license last year and had to take the bus.", "The new version of the program was released in spring.",
    "All people are born free and equal in dignity and rights.", "She asked for permission to leave the room early.",
    "The general public was invited to the opening of the library.", "A copy of the letter was found under the table.",
    "The software company hired fifty people in the following months.", "They signed a license agreement after long negotiations.",
]


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def triples(words: Column) -> Column:
    """Distinct runs of three words; fewer words make one run."""
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - 2)), lambda i: F.array_join(F.slice(words, i, 3), " "))
    return F.array_distinct(runs)


def _literal_rows(spark: SparkSession, rows: list[tuple[str, str]], first: str, second: str) -> DataFrame:
    made = F.array(*[F.struct(F.lit(a).alias(first), F.lit(b).alias(second)) for a, b in rows])
    return spark.range(1).select(F.inline(made))


def templates(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """(family, triples) per template."""
    return _literal_rows(spark, rows, "family", "text").select("family", triples(word_array(F.col("text"))).alias("of_template"))


def featurize(df: DataFrame, words: str, features: str) -> DataFrame:
    """Add hashed words and word pairs of the array column ``words`` as the sparse vector ``features``."""
    pairs, terms = fresh(df, "pairs", "terms")
    both = NGram(n=2, inputCol=words, outputCol=pairs).transform(df).withColumn(terms, F.concat(words, pairs))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol=terms, outputCol=features).transform(both).drop(pairs, terms)


def _thinned(words: Column, every: int) -> Column:
    return F.filter(words, lambda w, i: (i % every) != every - 1)


def _variants(words: Column) -> Column:
    """The words as they are, in part, with every n-th left out, and between neutral words."""
    n = F.size(words)
    most = F.greatest(F.lit(3), F.ceil(n * 0.7).cast("int"))
    without = [_thinned(words, k) for k in (5, 7, 9)]
    ends = [F.concat(F.array(*map(F.lit, before)), words, F.array(*map(F.lit, after))) for before, after in ((["this", "text"], ["see", "above"]), (["c", "2024"], ["end"]))]
    return F.array(words, F.slice(words, F.lit(1), most), F.slice(words, F.greatest(F.lit(1), n - most + 1), most), *without, *ends)


@dataclass(frozen=True)
class Classifier:
    families: list[str]  # by label; the last is unknown
    model: LogisticRegressionModel
    calibration: LogisticRegressionModel
    confirm: DataFrame

    def score(self, paragraphs: DataFrame, words: str = "words") -> DataFrame:
        """Add ``family`` (null if unknown) and ``confidence``, the calibrated probability of the best family."""
        features, raw, probability, prediction = fresh(paragraphs, "features", "raw", "probability", "prediction")
        model = self.model.copy().setFeaturesCol(features).setRawPredictionCol(raw).setProbabilityCol(probability).setPredictionCol(prediction)
        scored = model.transform(featurize(paragraphs, words, features))
        best = best_family(F.col(probability))
        slope, level = float(self.calibration.coefficients[0]), float(self.calibration.intercept)
        confidence = 1 / (1 + F.exp(-(F.lit(slope) * margin(best["p"]) + F.lit(level))))
        scored = scored.withColumns({"confidence": confidence, "family": F.element_at(F.array(*map(F.lit, self.families[:-1])), best["k"] + 1)})
        scored = scored.withColumn("family", F.when(F.col("confidence") >= 0.5, F.col("family")))
        return scored.drop(features, raw, probability, prediction)


def best_family(probability: Column) -> Column:
    """Struct (p, k) of the most probable class but the last."""
    p = vector_to_array(probability)
    known = F.slice(p, F.lit(1), F.size(p) - 1)
    return F.array_max(F.transform(known, lambda x, i: F.struct(x.alias("p"), i.alias("k"))))


def margin(p: Column) -> Column:
    q = F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-9), p))
    return F.log(q / (1 - q))


def paragraphs_of(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    """(…, line, words) for each line of a text that holds a word, and one row with line -1 for each text."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(*more, F.concat(F.array(F.lit("")), F.split(text, "\n")).alias("lines"))  # ids given before the lines part
    each = rows.select(*rows.columns[:-1], F.posexplode("lines").alias("line", "paragraph"))
    each = each.select("*", word_array(F.col("paragraph")).alias("words")).withColumn("line", F.col("line") - 1)
    return each.where((F.col("line") < 0) | (F.size("words") > 0))


def train(docs: DataFrame, text_col: str = "text", rows: list[tuple[str, str]] | None = None, max_unknown: int = MAX_UNKNOWN) -> Classifier:
    """Fit the classifier and its calibration."""
    spark, rows = docs.sparkSession, rows or TEMPLATES
    families = [*sorted({f for f, _ in rows}), UNKNOWN]
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
    known = _literal_rows(spark, rows, "family", "text").select("family", F.explode(_variants(word_array(F.col("text")))).alias("words"))
    neutral = _literal_rows(spark, [(UNKNOWN, t) for t in NEUTRAL], "family", "text").select("family", F.explode(_variants(word_array(F.col("text")))).alias("words"))
    marks = templates(spark, rows).agg(F.array_distinct(F.flatten(F.collect_list("of_template"))).alias("marks")).first()["marks"]  # of the fixed templates
    lines = docs.select(F.explode(F.split(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), "\n")).alias("paragraph"))
    lines = lines.where(F.length("paragraph").between(1, SAMPLED_LENGTH))
    whole = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    n_lines = docs.agg(F.sum(F.length(whole) - F.length(F.replace(whole, F.lit("\n"))) + 1)).first()[0] or 1
    place = F.xxhash64("paragraph").bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)  # uniform in [0, 1), equal for equal lines
    picked = lines.where(place < 2 * max_unknown / n_lines).distinct().orderBy(place, "paragraph").limit(max_unknown)
    picked = picked.select(F.lit(UNKNOWN).alias("family"), word_array(F.col("paragraph")).alias("words")).where(F.size("words") > 0)
    picked = picked.where(~F.arrays_overlap(triples(F.col("words")), F.array(*map(F.lit, marks))))
    examples = known.unionByName(neutral).unionByName(picked).withColumn("label", label)
    held_out = F.pmod(F.xxhash64(F.array_join("words", " ")), F.lit(3)) == 0
    examples = stored(featurize(examples.coalesce(4), "words", "features").withColumn("held_out", held_out), "license-examples")
    per_class = examples.groupBy("label").agg(F.count("*").alias("n"))
    weighed = examples.join(F.broadcast(per_class), "label").withColumn("weight", 1 / F.sqrt("n"))  # a row a family
    regression = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=40, featuresCol="features", labelCol="label", weightCol="weight")
    trial = regression.fit(weighed.where("not held_out"))
    tested = trial.transform(weighed.where("held_out")).withColumn("best", best_family(F.col("probability")))
    right = (F.col("best.k") == F.col("label")).cast("double")
    tested = tested.select("weight", right.alias("right"), margin(F.col("best.p")).alias("margin"))
    tested = VectorAssembler(inputCols=["margin"], outputCol="at").transform(stored(tested, "license-calibration"))
    calibration = LogisticRegression(featuresCol="at", labelCol="right", weightCol="weight", regParam=1e-2, maxIter=40).fit(tested)
    return Classifier(families, regression.fit(weighed), calibration, templates(spark, rows))


def scan(docs: DataFrame, classifier: Classifier, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_paragraphs, licenses (families, sorted), found (line:family, by line), n_unconfirmed."""
    each = paragraphs_of(docs, text_col, F.monotonically_increasing_id().alias("row_id"), F.col(f"`{id_col}`").alias("doc_id"))
    scored = classifier.score(each)
    confirm = classifier.confirm.groupBy("family").agg(F.collect_list("of_template").alias("of_family"))
    scored = scored.join(F.broadcast(confirm), "family", "left")  # a row a family, of fixed templates
    own = triples(F.col("words"))
    shared = F.array_max(F.transform("of_family", lambda t: F.size(F.array_intersect(own, t)) / F.least(F.size(own), F.size(t))))
    confirmed = F.col("family").isNotNull() & (F.col("line") >= 0) & (F.when(F.col("family").isNotNull(), shared) >= CONFIRM)
    scored = scored.select("row_id", "doc_id", "line", "family", confirmed.alias("confirmed"))
    rejected = F.col("family").isNotNull() & ~F.col("confirmed") & (F.col("line") >= 0)
    per_row = scored.groupBy("row_id").agg(
        F.first("doc_id").alias("doc_id"), F.sum((F.col("line") >= 0).cast("long")).alias("n_paragraphs"), F.sum(rejected.cast("long")).alias("n_unconfirmed"),
        F.array_sort(F.collect_list(F.when(F.col("confirmed"), F.struct("line", "family")))).alias("list"))  # of one document
    return per_row.select(
        "doc_id", "n_paragraphs",
        F.array_join(F.array_sort(F.array_distinct(F.col("list.family"))), ",").alias("licenses"),
        F.array_join(F.transform("list", lambda x: F.concat_ws(":", x["line"], x["family"])), ",").alias("found"),
        "n_unconfirmed")
