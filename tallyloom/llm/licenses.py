"""Licence scans: a trained paragraph classifier, confirmed against templates.

A paragraph is a line of a document.  Word n-grams (one to three words, lower-cased) of a fixed
vocabulary, which is that of the templates, feed a sparse multinomial logistic regression with
one class per licence family and one for anything else.  It is trained on the templates, on
variants with words dropped and with prose around them, and on the ordinary paragraphs (those
without an anchor) of one half of all documents.  The probability below which a family counts as
unknown is calibrated on the ordinary paragraphs of the other half.  Both read every document:
paragraphs with the same n-grams of the vocabulary are one weighted row.  A prediction is
confirmed if enough of the word pairs of one of the family's templates occur in the paragraph,
or enough of the paragraph's in it.

Every paragraph is scored.  An anchor (a word such as "license" or "rights reserved") only keeps a
paragraph out of the ordinary ones, and is what ``n_candidates`` counts.

Defined cases: null and empty texts have no licence paragraphs; a document may have several
families; equal rows are rows of their own; an empty table gives an empty table; only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored

# Licence families and sentences that announce them.
TEMPLATES = {
    "mit": (
        "released under the mit license",
        "this software is licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability",
    ),
    "apache-2.0": (
        "licensed under the apache license version 2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at apache.org licenses license-2.0",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    ),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "you should have received a copy of the gnu general public license along with this program",
    ),
    "lgpl": (
        "licensed under the gnu lesser general public license version 3",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
    ),
    "agpl": ("licensed under the gnu affero general public license version 3",),
    "mpl-2.0": (
        "this source code form is subject to the terms of the mozilla public license v 2.0",
        "licensed under the mozilla public license version 2.0",
    ),
    "bsd": (
        "released under the bsd license",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    ),
    "cc-by": (
        "licensed under cc by 4.0",
        "this work is licensed under a creative commons attribution 4.0 international license",
    ),
    "cc-by-sa": (
        "licensed under cc by-sa 4.0",
        "this work is licensed under a creative commons attribution share alike 4.0 international license",
    ),
    "cc-by-nc": (
        "licensed under cc by-nc 4.0",
        "this work is licensed under a creative commons attribution non commercial 4.0 international license",
    ),
    "public-domain": (
        "this is free and unencumbered software released into the public domain",
        "released under cc0 1.0 universal public domain dedication",
    ),
    "proprietary": (
        "all rights reserved",
        "copyright all rights reserved no part of this publication may be reproduced without prior written permission of the publisher",
    ),
}
# Ordinary sentences that hold an anchor.
OTHER = (
    "he lost his driving license in the spring and had to walk",
    "ask your teacher for permission before you leave the room",
    "the shop gives a two year warranty on every bicycle it sells",
    "a fishing license costs less for those who live in the county",
    "copyright law was the subject of the third lecture",
    "the apache helicopter landed behind the hill at noon",
    "the council may redistribute the funds at the end of the year",
    "the gnu grazed near the river while the lions slept",
    "the public library will license the films for another season",
    "she was the first woman with a pilot license in the valley",
    "no warranty can replace a careful look at the engine",
    "the archive holds letters under copyright until next year",
)
# The letters that any of these begins with are looked for first.
ANCHOR = (
    r"(?i)(?=[cglprsw])(?:licen[cs]e|copyright|rights reserved|redistribut|warrant|permission|\bgnu\b|\bgpl|creative commons"
    r"|\bcc[ -]?(?:by|0)|public domain|spdx|law or agreed)"
)
UNKNOWN = "unknown"
FAMILIES = (UNKNOWN, *TEMPLATES)
MAX_WORDS = 3
DROPS = 4
# What all ordinary paragraphs together weigh at most beside the templates and their variants, in rows.
ORDINARY_WEIGHT = 1000
CONFIRM = 0.6
FALSE_RATE = 0.001
LEAST_PROBABILITY = 0.5


def words(paragraph: Column) -> Column:
    """Lower-cased words; marks at a word's end do not belong to it."""
    plain = F.regexp_replace(F.lower(paragraph), r"[,;:!?()\[\]\x22\x27\x{201c}\x{201d}]|[.](?=[\x20\x09-\x0D]|\z)", " ")
    return F.filter(F.split(plain, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def grams(tokens: Column, n: int) -> Column:
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))


def with_grams(paragraphs: DataFrame) -> DataFrame:
    """Adds ``tokens`` and ``grams`` to a table with a column ``paragraph``."""
    tokens = paragraphs.withColumn("tokens", words(F.col("paragraph")))
    return tokens.withColumn("grams", F.concat(F.col("tokens"), *[grams(F.col("tokens"), n) for n in range(2, MAX_WORDS + 1)]))


def templates(spark: SparkSession) -> DataFrame:
    rows = [(FAMILIES.index(f), p) for f, texts in TEMPLATES.items() for p in texts]
    return spark.createDataFrame(rows, "label int, paragraph string")


def ordinary(docs: DataFrame) -> DataFrame:
    """(draw, paragraph) of every document, lines with an anchor left out; equal ids have one draw."""
    # Other columns of the table may have any name.
    draw = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("draw")
    lines = docs.select(draw, F.explode(F.split("text", "\n")).alias("paragraph"))
    return lines.where(F.col("paragraph").rlike(r"[^\x20\x09-\x0D]") & ~F.col("paragraph").rlike(ANCHOR))


def profiles(prose: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(held_out, grams, n): how many paragraphs have which n-grams of the vocabulary."""
    tokens = prose.select((F.substring("draw", 1, 1) >= "8").alias("held_out"), words(F.col("paragraph")).alias("tokens"))
    known = known_grams(tokens, vocabulary).select("held_out", "grams")
    return known.groupBy("held_out", "grams").agg(F.count(F.lit(1)).alias("n"))


def known_grams(table: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Adds ``grams``, the n-grams of ``tokens`` that are in the vocabulary, each once and in order.

    Every word of a longer n-gram is in the vocabulary too, so n-grams are made only where such a word begins them.
    """
    alone = [g for g in vocabulary if " " not in g]
    # The longest n-gram at a place, or what a line's end leaves of it, has the shorter ones in front.
    longest = F.transform(
        "tokens", lambda w, i: F.when(w.isin(alone), F.concat_ws(" ", w, *[F.get("tokens", i + k) for k in range(1, MAX_WORDS)]))
    )
    places = table.withColumn("__places", F.array_compact(longest))
    found = F.flatten(F.transform("__places", lambda g: F.array(*[F.substring_index(g, " ", n) for n in range(1, MAX_WORDS + 1)])))
    known = F.sort_array(F.array_distinct(F.filter(found, lambda g: g.isin(vocabulary))))
    return places.withColumn("grams", known).drop("__places")


def training_set(spark: SparkSession) -> DataFrame:
    """(label, paragraph): templates, their variants, and sentences with an anchor."""
    known = templates(spark)
    tokens = known.withColumn("tokens", words(F.col("paragraph")))
    # Every template with each word dropped in turn, and with a tail of other words.
    drop = tokens.where(F.size("tokens") > DROPS).select(
        "label", F.posexplode("tokens").alias("at", "gone"), "tokens"
    ).select("label", F.array_join(F.transform("tokens", lambda w, i: F.when(i != F.col("at"), w)), " ").alias("paragraph"))
    tail = known.select("label", F.explode(F.array(*[F.lit(t) for t in OTHER[:DROPS]])).alias("tail"), "paragraph").select(
        "label", F.concat_ws(" ", "paragraph", "tail").alias("paragraph")
    )
    other = spark.createDataFrame([(0, p) for p in OTHER], "label int, paragraph string")
    return known.unionByName(drop).unionByName(tail).unionByName(other).unionByName(other)


def train(docs: DataFrame) -> tuple[PipelineModel, float]:
    """The fitted model and the calibrated probability a family needs."""
    spark = docs.sparkSession
    # The vocabulary is that of the templates, in alphabetical order: bounded by their text.
    vocabulary = [
        r["gram"] for r in with_grams(templates(spark)).select(F.explode("grams").alias("gram")).distinct().orderBy("gram").collect()
    ]
    prose = stored(profiles(ordinary(docs), vocabulary))
    learned = prose.where(~F.col("held_out"))
    weight = min(1.0, ORDINARY_WEIGHT / (learned.agg(F.sum("n")).first()[0] or 1))
    made = with_grams(training_set(spark)).select("label", "grams", F.lit(1.0).alias("weight"))
    rows = made.unionByName(learned.select(F.lit(0).alias("label"), "grams", (F.col("n") * weight).alias("weight")))
    count = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features")
    count.setBinary(True)
    regression = LogisticRegression(
        maxIter=60, regParam=0.002, family="multinomial", featuresCol="features", labelCol="label", weightCol="weight"
    )
    model = Pipeline(stages=[count, regression]).fit(stored(rows.repartition("grams")))
    anchored = with_grams(spark.createDataFrame([(p,) for p in OTHER], "paragraph string"))
    calibration = prose.where("held_out").select("grams", "n").unionByName(anchored.select("grams", F.lit(1).cast("bigint").alias("n")))
    scored, p = _probabilities(model, calibration)
    best = F.array_max(F.slice(p, 2, len(FAMILIES) - 1))
    # Values outside the range the level may have are alike, so few different ones are counted.
    within = F.greatest(F.lit(LEAST_PROBABILITY), F.least(F.lit(0.95), best))
    return model, scored.agg(F.percentile(within, 1 - FALSE_RATE, F.col("n"))).first()[0]


def _probabilities(model: PipelineModel, table: DataFrame) -> tuple[DataFrame, Column]:
    return model.transform(table), vector_to_array(F.col("probability"))


def classify(paragraphs: DataFrame, model: PipelineModel, least: float) -> DataFrame:
    """Adds ``family`` (``unknown`` below ``least``), ``probability``, ``likeness`` and ``confirmed``."""
    tokens = paragraphs.withColumn("tokens", words(F.col("paragraph")))
    # The features are those of the vocabulary; no other n-gram counts.
    scored, p = _probabilities(model, known_grams(tokens, model.stages[0].vocabulary))
    scored = scored.withColumn("__p", p).withColumn("probability", F.array_max(F.slice("__p", 2, len(FAMILIES) - 1)))
    named = F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), F.array_position(F.col("__p"), F.col("probability")).cast("int"))
    scored = scored.withColumn("family", F.when(F.col("probability") >= least, named).otherwise(UNKNOWN))
    pairs = F.array_distinct(grams(F.col("tokens"), 2))
    likeness = None
    for family, texts in TEMPLATES.items():
        own = [sorted({" ".join(t.split()[i : i + 2]) for i in range(len(t.split()) - 1)}) for t in texts]
        shares = [
            F.size(F.array_intersect(pairs, F.array(*[F.lit(g) for g in t]))) / F.greatest(F.least(F.lit(len(t)), F.size(pairs)), F.lit(1))
            for t in own
        ]
        best = F.greatest(*shares) if len(shares) > 1 else shares[0]
        likeness = F.when(F.col("family") == family, best) if likeness is None else likeness.when(F.col("family") == family, best)
    likeness = F.coalesce(likeness, F.lit(0.0))
    return scored.withColumn("likeness", likeness).withColumn("confirmed", F.col("likeness") >= CONFIRM)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: paragraphs, those with an anchor, and its confirmed licence families.

    ``spans`` has the line number, family and rounded probability of every confirmed paragraph.
    """
    model, least = train(docs)
    filled = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    # Equal rows have equal licences, so a row is known by its content, whenever it is read.
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))).alias("key")
    paragraphs = docs.select(key, F.posexplode(lines).alias("line", "paragraph")).where(filled(F.col("paragraph")))
    judged = classify(paragraphs, model, least)
    # Probabilities are computed once and only what is confirmed moves; a filter would be computed apart from them.
    confirmed = judged.select(
        "key", "line", F.inline(F.when(F.col("confirmed"), F.array(F.struct("family", F.round("probability", 3).alias("probability")))))
    ).distinct()
    per_key = confirmed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_confirmed"),
        F.sort_array(F.collect_set("family")).alias("families"),
        F.sort_array(F.collect_list(F.struct("line", "family", "probability"))).alias("spans"),
    )
    cut = docs.select(
        key, "doc_id", F.size(F.filter(lines, filled)).cast("long").alias("n_paragraphs"),
        F.size(F.filter(lines, lambda x: x.rlike(ANCHOR))).cast("long").alias("n_candidates"),
    )
    none = F.array().cast("array<struct<line:int,family:string,probability:double>>")
    return cut.join(per_key, "key", "left").select(
        "doc_id", "n_paragraphs", "n_candidates", F.coalesce("n_confirmed", F.lit(0)).cast("long").alias("n_confirmed"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.coalesce("spans", F.when(F.col("n_candidates") > 0, none)).alias("spans"),
    )
