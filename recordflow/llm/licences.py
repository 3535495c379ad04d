"""Licence scans by a trained paragraph classifier, in DataFrame operations and JVM models only.

A logistic regression over sparse word n-grams tells licence families and an
unknown class apart. It learns from variants of the templates below, from
sentences that only talk about licences, and from paragraphs of the documents.
Its confidence is calibrated on variants and paragraphs it did not learn from: a
family counts when it is right more often than not at that confidence. Each find
is then compared with the templates of its family.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.operators.staging import compute_once

from .common import materialise, named, whole_text

FEATURES = 1 << 15
# Documents whose paragraphs stand for the unknown class, and variants made of each template.
SAMPLE_DOCS, VARIANTS = 1_000, 24
# Share of a template's words that a confirmed paragraph holds.
CONFIRMED = 0.8
WORD = "[a-z0-9]+(?:[.+-][a-z0-9]+)*"
UNKNOWN = "unknown"
# Words that tell nothing of licences, among those of the templates.
COMMON = set("a all an and any as at be by can either for in is it may no not of on or or/and other that the this to with you".split())

# Usual wordings of each family.
TEMPLATES = {
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS basis, without warranties or conditions of any kind, either express or implied.",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "cc": (
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "Released under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Licensed under the GPL-2.0-or-later.",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ),
    "mpl": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright by the authors. All rights reserved.",
        "No part of this publication may be reproduced, distributed or transmitted in any form without the prior written permission of the publisher.",
    ),
    "public_domain": (
        "This work is released into the public domain.",
        "This is free and unencumbered software released into the public domain.",
        "Released under CC0 1.0 Universal.",
    ),
}
# Sentences with the same words that license nothing.
ABOUT = (
    "A driving licence is needed to drive under the terms of the law.",
    "The new version of the software was released in the public library.",
    "They were granted a license to fish in the lake for a small fee.",
    "The general public may use the work of the foundation free of charge.",
    "All of the conditions were met and the copy was distributed to any person.",
    "The source of the river is found in the mountains, without any doubt.",
    "Her permission was required before the notice could appear.",
    "The club license was renewed by the city in version two of the agreement.",
    "Rights and duties of the authors were discussed at length.",
    "MIT is a university, and the Apache are a people of the southwest.",
    "It was released under the bridge, under the old trees, and swam away.",
    "The terms of the contract were published by the press, either way.",
)


def _rows(spark: SparkSession, **columns: list[str]) -> DataFrame:
    """A few fixed rows, as an expression."""
    structs = [
        F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in zip(*columns.values(), strict=True)
    ]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def templates(spark: SparkSession) -> DataFrame:
    pairs = [(f, t) for f, texts in TEMPLATES.items() for t in texts]
    return _rows(spark, family=[f for f, _ in pairs], paragraph=[t for _, t in pairs])


def words(text: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def paragraphs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Lines with a word: doc_id, at (from 0), paragraph, words. Null text has none."""
    rows = named(docs, {"doc_id": doc_id, "_text": text})
    lines = rows.select("doc_id", F.posexplode(F.split(whole_text("_text"), "\r\n|\n|\r")).alias("at", "paragraph"))
    return lines.withColumn("words", words("paragraph")).filter(F.size("words") > 0)


def _fixed(texts: list[str]) -> Column:
    return F.array(*[F.lit(t) for t in texts])


def _template_words() -> list[list[str]]:
    return [list(dict.fromkeys(re.findall(WORD, t.lower()))) for texts in TEMPLATES.values() for t in texts]


def _share(held: Column) -> Column:
    """The largest share of any template's words."""
    return F.array_max(F.transform(F.array(*[_fixed(t) for t in _template_words()]), lambda t: F.size(F.array_intersect(t, held)) / F.size(t)))


def _with(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def candidates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Like ``paragraphs``, with the lines of a wrapped notice as one: doc_id, at (of the first line), paragraph, words.

    Lines are joined within a block (lines without a word between), where together they hold
    CONFIRMED of a template's words and a larger share than its first line alone or the others
    alone. Their lines are left out, but for those that hold CONFIRMED of a template themselves.
    """
    known = _template_words()
    reach = 2 * max(map(len, known))
    telling = _fixed(sorted({w for t in known for w in t} - COMMON))
    rows = named(docs, {"doc_id": doc_id, "_text": text})
    split = F.split(whole_text("_text"), "\r\n|\n|\r")
    line = F.transform(split, lambda p, i: F.struct(i.alias("at"), p.alias("paragraph"), words(p).alias("words")))
    rows = compute_once(rows, {"_lines": line}).select("doc_id", "_lines")
    lines, count = F.col("_lines"), F.size("_lines")
    has = lambda held: F.size(F.array_intersect(telling, held)) >= 2
    ends_kind, stretch_kind = "array<struct<last:int,words:array<string>>>", "array<struct<first:int,last:int>>"

    def ends(i: Column) -> Column:
        """Every line that a notice from line i can end in, with all words up to it; lines between hold no more than two templates."""

        def longer(acc, j):
            here = F.get(lines, j)["words"]
            goes_on = acc["open"] & (F.size(here) > 0) & (acc["inner"] <= reach)
            joined = F.concat(acc["words"], here)
            return F.struct(
                goes_on.alias("open"),
                (acc["inner"] + F.size(here)).alias("inner"),
                F.when(goes_on, joined).otherwise(acc["words"]).alias("words"),
                F.when(goes_on, F.concat(acc["ends"], F.array(F.struct(j.alias("last"), joined.alias("words"))))).otherwise(acc["ends"]).alias("ends"),
            )

        first = F.get(lines, i)["words"]
        start = F.struct((F.size(first) > 0).alias("open"), F.lit(0).alias("inner"), first.alias("words"), F.array().cast(ends_kind).alias("ends"))
        return F.aggregate(F.sequence(i + 1, F.least(count - 1, i + reach + 1)), start, longer, lambda acc: acc["ends"])

    def stretch(i: Column) -> Column:
        """The last line of the notice that begins at line i, or null."""
        first = F.get(lines, i)["words"]

        def judged(found):
            best = F.array_max(F.transform(found, lambda e: F.struct(_share(e["words"]).alias("share"), (-e["last"]).alias("back"), e["words"].alias("words"))))
            others = lambda b: F.slice(b["words"], F.size(first) + 1, F.size(b["words"]))
            last = _with(best, lambda b: F.when((b["share"] > _share(first)) & (b["share"] > _share(others(b))), -b["back"]))
            longest = F.element_at(found, -1)["words"]
            return F.when(F.size(found) > 0, F.when(has(longest), F.when(_share(longest) >= CONFIRMED, last)))

        return _with(ends(i), judged)

    def one_more(acc, i):
        def added(last):
            new = F.array(F.struct(i.alias("first"), last.alias("last")))
            return F.struct(
                F.coalesce(last + 1, acc["busy"]).alias("busy"),
                F.when(last.isNotNull(), F.concat(acc["found"], new)).otherwise(acc["found"]).alias("found"),
            )

        return _with(F.when(i >= acc["busy"], stretch(i)), added)

    none = F.array().cast(stretch_kind)
    start = F.struct(F.lit(0).alias("busy"), none.alias("found"))
    found = F.aggregate(F.sequence(F.lit(0), count - 2), start, one_more, lambda acc: acc["found"])
    rows = compute_once(rows, {"_joined": F.when((count > 1) & has(F.flatten(lines["words"])), found).otherwise(none)})
    covered = lambda x: F.exists("_joined", lambda w: x["at"].between(w["first"], w["last"]))
    single = F.filter(lines, lambda x: (F.size(x["words"]) > 0) & (~covered(x) | (_share(x["words"]) >= CONFIRMED)))
    whole = F.transform(
        "_joined",
        lambda w: _with(
            F.transform(F.sequence(w["first"], w["last"]), lambda j: F.get(lines, j)),
            lambda part: F.struct(w["first"].alias("at"), F.array_join(part["paragraph"], " ").alias("paragraph"), F.flatten(part["words"]).alias("words")),
        ),
    )
    return rows.select("doc_id", F.inline(F.concat(single, whole)))


def _features(rows: DataFrame) -> DataFrame:
    """Sparse counts of words and pairs of words."""
    pairs = NGram(n=2, inputCol="words", outputCol="_pairs").transform(rows)
    grams = pairs.withColumn("_grams", F.concat("words", "_pairs"))
    counted = HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="features").transform(grams)
    return counted.drop("_pairs", "_grams")


def _variants(rows: DataFrame) -> DataFrame:
    """Each row as it is and with some words left out, chosen by hash; ``turn`` is the number of the variant."""
    every = rows.withColumn("words", words("paragraph"))
    every = every.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    kept = F.filter("words", lambda w, i: (F.col("turn") % 2 == 0) | (F.pmod(F.xxhash64("turn", w, i), F.lit(8)) > 0))
    # Every third variant stands within other words, as notices do.
    around = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.substring(F.md5(F.concat_ws(" ", F.col("turn"), i)), 1, 6))
    return every.withColumn("words", F.when(F.col("turn") % 3 == 2, F.concat(kept, around)).otherwise(kept))


@dataclass
class Scanner:
    """A fitted classifier: families in the order of its classes, the regression and the calibration."""

    families: list[str]
    regression: LogisticRegressionModel
    calibration: IsotonicRegressionModel

    def classified(self, rows: DataFrame) -> DataFrame:
        """Rows (with ``words``) with the likeliest family and its calibrated confidence."""
        scored = self.regression.transform(_features(rows)).withColumn("_p", vector_to_array("probability"))
        named_ = F.array(*[F.lit(f) for f in self.families])
        best = scored.withColumns(
            {"family": F.element_at(named_, F.col("prediction").cast("int") + 1), "_top": F.array_max("_p")}
        )
        return self.calibration.transform(best).drop("_p", "_top", "features", "rawPrediction", "probability", "prediction")


def train(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE_DOCS) -> Scanner:
    """A scanner from the templates and the paragraphs of at most ``sample`` documents, drawn by a hash of their id."""
    spark = docs.sparkSession
    families = [UNKNOWN, *sorted(TEMPLATES)]
    about = _rows(spark, family=[UNKNOWN] * len(ABOUT), paragraph=list(ABOUT))
    made = _variants(templates(spark).unionByName(about))
    # Only hashes are sorted; the texts of the chosen ones stay where they are. Repeated rows count once.
    rows = named(docs, {"doc_id": doc_id, "text": text}).withColumn("_draw", F.xxhash64("doc_id", "text"))
    chosen = rows.select("_draw").orderBy("_draw").limit(sample).distinct()
    drawn = rows.join(F.broadcast(chosen), "_draw").dropDuplicates(["_draw"])
    # Of the drawn paragraphs, those that may be notices are no sure examples of the unknown.
    plain = paragraphs(drawn).filter(~F.lower("paragraph").rlike("licen|copyright|cc0|public domain|rights reserved|spdx"))
    plain = plain.withColumn("turn", F.pmod(F.xxhash64("doc_id", "at"), F.lit(VARIANTS)).cast("int"))
    seen = made.select("family", "words", "turn").unionByName(plain.select(F.lit(UNKNOWN).alias("family"), "words", "turn"))
    numbers = F.array(*[F.lit(f) for f in families])
    rows = _features(seen).select("features", "turn", (F.array_position(numbers, F.col("family")) - 1).cast("double").alias("label"))
    # Fixed and drawn rows: bounded, so two partitions do.
    rows = materialise(rows.coalesce(2))
    regression = LogisticRegression(
        family="multinomial", maxIter=30, regParam=2e-3, elasticNetParam=0.5, standardization=False
    ).fit(rows.filter("turn % 4 <> 3"))
    tried = regression.transform(rows.filter("turn % 4 = 3")).select(
        F.array_max(vector_to_array("probability")).alias("_top"),
        F.when(F.col("prediction") == F.col("label"), 1.0).otherwise(0.0).alias("right"),
    )
    # Two fixed points keep the ends of the scale in place whatever was drawn.
    ends = _rows(spark, _top=[0.0, 1.0], right=[0.0, 1.0])
    calibration = IsotonicRegression(featuresCol="_top", labelCol="right", predictionCol="confidence").fit(
        tried.unionByName(ends)
    )
    return Scanner(families, regression, calibration)


def scan(docs: DataFrame, scanner: Scanner, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Paragraphs that license something: doc_id, at, family, confidence, template_share, confirmed, paragraph.

    A paragraph is a line, or the lines of a wrapped notice joined by blanks (see ``candidates``).
    A paragraph counts when its likeliest class is a family and its calibrated confidence
    is a half or more. ``template_share`` is the largest share of a template's words that
    it holds, of the templates of that family; confirmed from CONFIRMED on. Documents
    without such a paragraph, null and empty texts give no row; repeated rows give
    repeated finds. Other columns are not read. No shuffle: model and templates are of
    fixed size, and each paragraph is judged on its own.
    """
    found = scanner.classified(candidates(docs, text, doc_id)).filter(
        (F.col("family") != UNKNOWN) & (F.col("confidence") >= 0.5)
    )
    known = templates(docs.sparkSession).groupBy("family").agg(
        F.collect_list(F.array_distinct(words("paragraph"))).alias("_templates")
    )
    share = F.array_max(
        F.transform("_templates", lambda t: F.size(F.array_intersect(t, F.col("words"))) / F.size(t))
    )
    return (
        found.join(F.broadcast(known), "family")
        .withColumn("template_share", share)
        .select(
            "doc_id",
            "at",
            "family",
            "confidence",
            "template_share",
            (F.col("template_share") >= CONFIRMED).alias("confirmed"),
            "paragraph",
        )
    )
