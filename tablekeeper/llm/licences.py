"""Licence scan: a sparse n-gram classifier of paragraphs, confirmed by comparison with templates.

DataFrame and SQL functions only; the model is fitted by Spark's own logistic regression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import stage

SHARE = 0.8
"""Part of a template's word pairs that a paragraph must have to confirm a prediction."""
NEGATIVES = 2_000
"""Paragraphs of the documents that the unknown class is learnt from: those with the smallest hash."""
CERTAIN = 0.5
UNKNOWN = "unknown"

# Notices and opening paragraphs of public licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Apache License Version 2.0, January 2004",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "GNU General Public License Version 3, 29 June 2007",
    ),
    "LGPL-3.0": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "GNU Lesser General Public License Version 3, 29 June 2007",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC0-1.0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
}
# Sentences that use the words of licences for something else.
NOT_LICENCES = (
    "A driver must show a license to the officer on request.",
    "The new version was released under pressure from the public.",
    "The hotel is licensed to serve drinks until midnight.",
    "Researchers at MIT released a report on the work.",
    "Apache helicopters flew over the general.",
    "The software is free of charge for students.",
    "The fishing license costs 4.0 dollars in version 2.0 of the rules.",
    "Permission to use the library is granted by the school.",
    "The foundation published the terms of the public offer.",
    "The commons are open to the public, and the general work is done.",
)
FAMILIES = (UNKNOWN, *TEMPLATES)


def words(text) -> F.Column:
    """Lower-case words; full stops and hyphens inside a word (2.0, by-nc) stay."""
    clean = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.-]+|[.-]+(?![\p{L}\p{N}])|(?<![\p{L}\p{N}])[.-]+", " ")
    return F.filter(F.split(clean, " "), lambda w: w != "")


def pairs(tokens) -> F.Column:
    """Distinct pairs of neighbouring words."""
    n = F.size(tokens)
    both = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat_ws(" ", F.element_at(tokens, i), F.element_at(tokens, i + 1)))
    return F.when(n > 1, F.array_distinct(both)).otherwise(F.array().cast("array<string>"))


def _array(values) -> F.Column:
    return F.array(*[F.lit(x) for x in values]) if values else F.array().cast("array<string>")


@dataclass
class Model:
    """Weights of n-grams by family (only those that are not all 0), the temperature, and what confirms a family."""

    weights: dict[str, list[float]]
    bias: list[float]
    temperature: float
    templates: list[tuple[str, list[str]]]
    needles: list[str]


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(f, t) for f, texts in TEMPLATES.items() for t in texts]
    return spark.createDataFrame(rows, "family string, paragraph string")


def _needles(templates: list[tuple[str, list[str]]]) -> list[str]:
    """Words of which every paragraph that any template can confirm has at least one.

    A confirmed paragraph lacks at most a share of 1 - SHARE of the template's pairs, so of one pair more than that it
    has at least one. Words are taken until so many pairs of every template hold one, the word that most templates
    need first.
    """
    needs = [int((1 - SHARE) * len(own) + 1e-9) + 1 for _, own in templates]
    open_ = [set(own) for _, own in templates]
    every = {w for _, own in templates for p in own for w in p.split()}
    candidates = {w for w in every if len(w) >= 6} or every
    found: list[str] = []
    while any(n > 0 for n in needs):
        def gain(w: str) -> tuple[int, str]:
            return sum(min(n, sum(w in p for p in own)) for n, own in zip(needs, open_, strict=True) if n > 0), w

        best = max(candidates - set(found) or every - set(found), key=gain)
        if not gain(best)[0]:
            candidates = every
            best = max(every - set(found), key=gain)
        found.append(best)
        for k, own in enumerate(open_):
            hit = {p for p in own if best in p}
            needs[k] -= len(hit)
            own -= hit
    return sorted(found)


def _has(text, needles: list[str]) -> F.Column:
    def any_of(low):
        test = F.lit(False)
        for needle in needles:
            test = test | F.contains(low, F.lit(needle))
        return test

    return F.exists(F.array(F.lower(F.coalesce(text, F.lit("")))), any_of)  # an array of one, so the text is folded once


def paragraphs(docs: DataFrame, needles: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, paragraph_no (from 0) and paragraph; only those with one of the ``needles`` if given."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if needles is not None:
        rows = rows.where(_has(F.col("text"), needles))
    rows = rows.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("paragraph_no", "paragraph"))
    return rows.where(_has(F.col("paragraph"), needles)) if needles is not None else rows


def blocks(docs: DataFrame, needles: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, paragraph_no (number of the first line) and paragraph of each run of two or more lines that have words.

    Lines without letters and digits part them, those of a comment sign included. Only those with a needle are listed.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(_has(F.col("text"), needles))
    marked = F.regexp_replace(F.translate("text", "\x01", " "), r"(?md)^[^\p{L}\p{N}\n]*$", "\x01")
    rows = rows.select("doc_id", marked.alias("_marked")).withColumn("_parts", F.split("_marked", "\x01", -1))
    rows = rows.select("doc_id", "_marked", F.posexplode("_parts").alias("_k", "_part"))
    rows = rows.withColumn("paragraph", F.expr("trim(BOTH '\n' FROM _part)"))
    rows = rows.where(F.contains(F.col("paragraph"), F.lit("\n")) & _has(F.col("paragraph"), needles))
    before = F.expr("concat(substring_index(_marked, '\x01', _k), substring(_part, 1, length(_part) - length(trim(LEADING '\n' FROM _part))))")
    return rows.select("doc_id", (F.length(before) - F.length(F.translate(before, "\n", ""))).alias("paragraph_no"), "paragraph")


def versions(own: list[str]) -> list[list[str]]:
    """Pairs of a template that name a version (or number of clauses), each with its other spelling (3 for 3.0)."""
    found = [p for p in own if re.fullmatch(r"\D\S* \d{1,2}(\.\d+|-clause)?", p)]
    return [[p, p.removesuffix(".0") if p.endswith(".0") else p + ".0"] for p in found]


def _share(own_pairs, own: list[str]) -> F.Column:
    """Part of the template's pairs that are there; 0 if what tells its version is not."""
    share = F.size(F.array_intersect(own_pairs, _array(own))) / F.lit(float(len(own)))
    for either in versions(own):
        share = F.when(F.arrays_overlap(own_pairs, _array(either)), share).otherwise(0.0)
    return share


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the templates, alone and inside paragraphs of the documents, against NEGATIVES other paragraphs.

    The features are the words and pairs of the templates; an L1 penalty leaves few of them. A fifth of the rows is
    held out of the fit, and the temperature that makes their loss smallest calibrates the probabilities.
    """
    spark = docs.sparkSession
    texts = _templates(spark).withColumn("tokens", words(F.col("paragraph"))).withColumn("pairs", pairs(F.col("tokens")))
    known = texts.collect()  # the fixed templates
    templates = [(r.family, list(r.pairs)) for r in known]
    needles = _needles(templates)
    vocabulary = sorted({g for r in known for g in [*r.tokens, *r.pairs]})

    clean = paragraphs(docs, None, id_col, text_col).where(~_has(F.col("paragraph"), needles) & (F.length("paragraph") > 0))
    clean = clean.select("paragraph").orderBy(F.xxhash64("paragraph"), "paragraph").limit(NEGATIVES)
    clean = stage(clean.withColumn("k", F.row_number().over(_by_hash()) - 1), "licence-negatives")
    codes = F.create_map(*[x for i, f in enumerate(FAMILIES) for x in (F.lit(f), F.lit(float(i)))])
    noise = clean.where("k < 10").select("k", F.col("paragraph").alias("noise"))
    plain = texts.select("family", "paragraph")
    inside = (
        plain.select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k")).join(noise, "k")
        .select("family", F.concat_ws(" ", "paragraph", "noise").alias("paragraph"))
    )
    others = spark.createDataFrame([(UNKNOWN, t) for t in NOT_LICENCES], "family string, paragraph string")
    others = others.select("family", F.explode(F.array_repeat("paragraph", 10)).alias("paragraph"))
    copies = plain.select("family", F.explode(F.array_repeat("paragraph", 10)).alias("paragraph"))
    rows = copies.unionAll(inside).unionAll(others).unionAll(clean.select(F.lit(UNKNOWN), "paragraph"))
    grams = F.concat(words(F.col("paragraph")), pairs(words(F.col("paragraph"))))
    rows = rows.select("family", codes[F.col("family")].alias("label"), grams.alias("grams"), F.monotonically_increasing_id().alias("id"))
    counter = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features").setBinary(True)
    rows = stage(counter.transform(rows).select("label", "features", "id"), "licence-rows")

    fit = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=5e-4, maxIter=60, standardization=False)
    part = F.pmod(F.xxhash64("id"), F.lit(5))
    model = fit.fit(rows.where(part > 0))
    matrix, bias = model.coefficientMatrix.toArray().tolist(), [float(x) for x in model.interceptVector]
    while len(bias) < len(FAMILIES):
        bias.append(0.0)
        matrix.append([0.0] * len(vocabulary))
    weights = {g: [row[i] for row in matrix] for i, g in enumerate(vocabulary) if any(abs(row[i]) > 1e-6 for row in matrix)}

    raw = model.transform(rows.where(part == 0)).select("label", vector_to_array("rawPrediction").alias("z"))
    losses = []
    for t in (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0):
        own = F.element_at("z", F.col("label").cast("int") + 1) / t
        scaled = F.transform("z", _divider(t))
        total = F.log(F.aggregate(scaled, F.lit(0.0), lambda acc, z: acc + F.exp(z)))
        losses.append(F.coalesce(F.avg(total - own), F.lit(0.0)).alias(str(t)))
    temperature = min(raw.agg(*losses).first().asDict().items(), key=lambda x: (x[1], x[0]))[0]
    return Model(weights, bias, float(temperature), templates, needles)


def _divider(t: float):
    return lambda z: z / t


def _by_hash():
    return Window.orderBy(F.xxhash64("paragraph"), "paragraph")


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence family of every paragraph that may state one.

    A paragraph is a line. Where consecutive lines (parted by lines without words) state a licence together that none
    of them states alone, as in a notice that is broken into lines, they are one paragraph more, under the number of
    their first line; of several such licences in one of these the most probable is given.

    One row per paragraph: ``doc_id``, ``paragraph_no`` (from 0), ``paragraph``, ``predicted`` (family or
    "unknown"), ``probability`` of it, ``similarity`` (largest part of a template of that family that the paragraph has) and
    ``family``: the prediction if its probability is CERTAIN and a template confirms it, else "unknown". A template that
    names a version confirms that version only.

    Paragraphs without any of the model's needles cannot be confirmed by a template and are not listed. NULL and
    empty texts have no paragraphs; repeated rows are scanned each by itself; an empty table gives an empty result. Other columns
    are not read. There is no shuffle.
    """
    vocabulary = sorted(model.weights)
    rows = paragraphs(docs, model.needles, id_col, text_col).withColumn("_joined", F.lit(False))
    rows = rows.unionAll(blocks(docs, model.needles, id_col, text_col).withColumn("_joined", F.lit(True)))
    rows = rows.withColumn("_tokens", words(F.col("paragraph"))).withColumn("_pairs", pairs(F.col("_tokens")))
    rows = rows.withColumn("_grams", F.array_intersect(F.concat("_tokens", "_pairs"), _array(vocabulary)))

    def margin(k: int) -> F.Column:
        if not vocabulary:
            return F.lit(model.bias[k])
        own = F.array(*[F.lit(model.weights[g][k]) for g in vocabulary])
        return F.lit(model.bias[k]) + F.aggregate("_at", F.lit(0.0), lambda acc, i: acc + F.element_at(own, i))

    at = F.transform("_grams", lambda g: F.array_position(_array(vocabulary), g).cast("int"))
    rows = rows.withColumn("_at", at if vocabulary else F.array().cast("array<int>"))
    rows = rows.withColumn("_z", F.array(*[margin(k) / model.temperature for k in range(len(FAMILIES))]))
    rows = rows.withColumn("_e", F.transform("_z", lambda z: F.exp(z - F.array_max("_z"))))
    rows = rows.withColumn("_p", F.transform("_e", lambda e: e / F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)))
    rows = rows.withColumn("probability", F.array_max("_p"))
    rows = rows.withColumn("predicted", F.element_at(_array(FAMILIES), F.array_position("_p", F.array_max("_p")).cast("int")))

    def shares(own_pairs) -> F.Column:
        out = F.lit(0.0)
        for family in TEMPLATES:
            best = F.greatest(F.lit(0.0), F.lit(0.0), *[_share(own_pairs, own) for f, own in model.templates if f == family and own])
            out = F.when(F.col("predicted") == family, best).otherwise(out)
        return out

    rows = rows.withColumn("similarity", shares(F.col("_pairs")))
    sure = (F.col("probability") >= CERTAIN) & (F.col("similarity") >= SHARE)
    by_line = F.transform(F.split("paragraph", "\n", -1), words)
    alone = F.exists(F.transform(by_line, pairs), lambda own: shares(own) >= SHARE)
    listed = F.when(~F.col("_joined") | (sure & ~alone), F.array(F.when(sure, F.col("predicted")).otherwise(F.lit(UNKNOWN))))
    # generated, as a filter would be moved below the projections with copies of all of them
    rows = rows.select("doc_id", "paragraph_no", "paragraph", "predicted", "probability", "similarity", F.explode_outer(listed).alias("family"))
    return rows.where("family IS NOT NULL")
