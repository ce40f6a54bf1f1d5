"""License scans: a trained paragraph classifier, applied by DataFrame operations only.

A paragraph is a line with a word.  Its features are single words and pairs of neighbouring words of
a vocabulary; a multinomial logistic regression over the licence families and ``unknown`` gives its
probabilities, softened by a temperature that is fitted on examples left out of training, with the
least probability that keeps the accepted ones of them right (the calibrated unknown class).  A
prediction counts only if the paragraph also shares enough words with one template of the family.
Notices are often wrapped, so runs of two to ``MOST_LINES`` neighbouring lines, with no line without a
word among them, are judged in the same way where no line of theirs counts by itself; these must share
enough words and pairs, so that words strewn over lines do not count.  The shortest such runs stay,
the first of those that overlap, and each is named by its first line.

The model is trained on the driver from the templates below, varied by rules; it has a few hundred
features and is joined as a broadcast table of that fixed size.  Words are exploded and joined within
one stage, partial sums are made before the shuffle, and only paragraphs with a feature and lines
without a word leave it.

Null and empty texts have no paragraphs.  Rows are judged one by one, so repeated rows stay; of families
of one score the first by name is taken.  An empty table gives an empty one; a very long text is exploded
line by line in its own task.  Other columns are not read.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import written

UNKNOWN = "unknown"
LEAST_SHARED = 0.6  # of the words of a template, stop words aside
MOST_LINES = 8  # of a run; templates of up to 32 words may be wrapped after every fourth, the longest (34) after every fifth
_EVERY = "\u0000"
_GAP = "\u0001"  # stands for a line without a word

# Short notices of each licence family, as they are commonly worded.
TEMPLATES: dict[str, list[str]] = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Released under the BSD license.",
        "This software is distributed under the 3-clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Text is available under the Creative Commons Attribution license.",
        "Published under the CC BY 3.0 license.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Available for noncommercial use under CC BY-NC-SA 4.0.",
        "Shared under the Creative Commons Attribution NonCommercial license.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released into the public domain under CC0 1.0.",
        "This work is in the public domain.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Released under the GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GPLv3.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.",
        "Released under the LGPL version 3.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "Released under the MPL 2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright 2020 Example Company. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ],
}

# Sentences near the subject that state no licence.
OTHERS = [
    "She got her driving license last week.",
    "The shop lost its license to sell beer in version two of the story.",
    "All rights and duties of the king were reserved for his son.",
    "The public library is in the public square of the general hospital.",
    "He asked for permission to use the software at work.",
    "The work is free and the use of it is granted to nobody.",
    "The apache helicopter flew over the source of the river.",
    "MIT published a study on the common use of commons.",
    "A copy of the letter was released under pressure.",
    "The foundation of the house is part of the work.",
    "The terms of the contract are subject to change without notice.",
    "They were licensed under the old law of the land.",
    "The author waived his fee for this publication.",
    "Rights are reserved in the sense of the law.",
    "Released under the moon, the creative spirit of the free people lives.",
    "The version 3 of the file is here, version 4.0 comes later.",
]

_STOP = frozenset("a an and any are as at be by for from in is it its of on or that the this to was were with you may can not will his her he she they".split())


def _words(text: str) -> list[str]:
    import re

    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def features(words: list[str]) -> list[str]:
    """Single words and neighbouring pairs, without those of stop words alone."""
    one = [w for w in words if w not in _STOP]
    return one + [f"{a} {b}" for a, b in zip(words, words[1:]) if a not in _STOP or b not in _STOP]  # noqa: RUF007


def variants(seed: int = 3) -> list[tuple[list[str], str]]:
    """Templates with words around them, words dropped and years changed; other sentences likewise."""
    rng = random.Random(seed)
    noise = lambda n: ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(n)]
    out = []
    for label, texts in [*TEMPLATES.items(), (UNKNOWN, OTHERS)]:
        for text in texts:
            for k in range(10):
                w = _words(text)
                if k >= 3 and len(w) > 6:
                    w.pop(rng.randrange(len(w)))
                if k % 2:
                    w = noise(rng.randint(0, 6)) + w + noise(rng.randint(0, 6))
                if k >= 6 and label == UNKNOWN:
                    rng.shuffle(w)
                out.append((w, label))
    every = [w for texts in TEMPLATES.values() for t in texts for w in _words(t)]
    for _ in range(250):  # bags of the same words without their order state nothing
        out.append((noise(rng.randint(3, 20)) + rng.sample(every, rng.randint(1, 2)) + noise(rng.randint(2, 12)), UNKNOWN))
    return out


class Model:
    def __init__(self, labels: list[str], vocabulary: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float, floor: float):
        self.labels, self.vocabulary, self.weights, self.bias, self.temperature, self.floor = labels, vocabulary, weights, bias, temperature, floor

    def probabilities(self, words: list[str]) -> np.ndarray:
        index = {f: i for i, f in enumerate(self.vocabulary)}
        rows = [index[f] for f in features(words) if f in index]
        z = (self.weights[rows].sum(axis=0) + self.bias) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


@lru_cache(maxsize=1)
def model(epochs: int = 150, rate: float = 1.0, shrink: float = 2e-4) -> Model:
    """Full-batch gradient descent over the variants; every fourth is left out for calibration."""
    data = variants()
    labels = sorted(TEMPLATES) + [UNKNOWN]
    train, held = [d for k, d in enumerate(data) if k % 4], data[::4]
    known = sorted({f for texts in [*TEMPLATES.values(), OTHERS] for t in texts for f in features(_words(t))})
    index = {f: i for i, f in enumerate(known)}

    def matrix(rows):
        x, y = np.zeros((len(rows), len(known))), np.zeros((len(rows), len(labels)))
        for r, (words, label) in enumerate(rows):
            for f in features(words):
                if f in index:
                    x[r, index[f]] += 1
            y[r, labels.index(label)] = 1
        return x, y

    (x, y), (hx, hy) = matrix(train), matrix(held)
    w, b = np.zeros((len(known), len(labels))), np.zeros(len(labels))
    b[-1] = 1.0

    def soft(z):
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    for _ in range(epochs):
        err = soft(x @ w + b) - y
        w -= rate * (x.T @ err / len(x) * 4 + shrink * w)
        b -= rate * err.mean(axis=0)
    truth = hy.argmax(axis=1)
    loss = {t: -np.log(soft((hx @ w + b) / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in np.geomspace(1, 8, 33)}
    temperature = min(loss, key=loss.get)
    p = soft((hx @ w + b) / temperature)
    best = p.argmax(axis=1)
    wrong = p.max(axis=1)[(best != truth) & (best != len(labels) - 1)]
    return Model(labels, known, np.round(w, 6), np.round(b, 6), float(temperature), float(min(0.95, max(0.5, wrong.max(initial=0.0)))))


def _line_words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), "[^a-z0-9]+"), "")


def _templates(spark: SparkSession) -> DataFrame:
    """Families with the words of their templates: one small row each."""
    rows = [(family, [sorted(set(_words(t)) - _STOP) for t in texts], [sorted(set(features(_words(t)))) for t in texts]) for family, texts in TEMPLATES.items()]
    return spark.createDataFrame(rows, "of string, templates array<array<string>>, wholes array<array<string>>")


def _judged(sums: DataFrame, fitted: Model, found: str, templates: str) -> DataFrame:
    """``family``, ``score`` and ``sure`` beside the columns of ``sums`` (class sums s0.., and a set of features)."""
    k = len(fitted.labels)
    z = F.array(*[(F.col(f"s{i}") + float(fitted.bias[i])) / fitted.temperature for i in range(k)])
    scored = sums.withColumn("z", z).withColumn("top", F.array_max("z"))
    total = F.aggregate("z", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("top")))
    best = scored.withColumns({"score": 1 / total, "family": F.element_at(F.array(*map(F.lit, fitted.labels)), F.array_position("z", F.col("top")).cast("int"))})
    best = best.join(F.broadcast(_templates(sums.sparkSession)), F.col("family") == F.col("of"), "left")
    shared = F.array_max(F.transform(templates, lambda t: F.size(F.array_intersect(found, t)) / F.size(t)))
    sure = (F.col("paragraph") > 0) & (F.col("score") >= fitted.floor) & (F.coalesce(shared, F.lit(0.0)) >= LEAST_SHARED)
    return best.withColumn("sure", sure).drop("z", "top", "of", "templates", "wholes")


def licence_paragraphs(docs: DataFrame) -> DataFrame:
    """``row`` (a number of the row), ``doc_id``, ``n_paragraphs`` and each ``paragraph`` (number of its
    line) with the predicted ``family``, its ``score``, whether it is ``confirmed``, and ``runs``: the
    runs of lines from it that are, as structs of last line, family and score; one row with paragraph
    0 for every document."""
    spark, fitted = docs.sparkSession, model()
    k = len(fitted.labels)
    weights = [(f, [float(v) for v in w]) for f, w in zip(fitted.vocabulary, fitted.weights, strict=True)] + [(_EVERY, [0.0] * k), (_GAP, [0.0] * k)]
    table = spark.createDataFrame(weights, "feature string, w array<double>").select(F.col("feature").alias("f"), *[F.col("w")[i].alias(f"w{i}") for i in range(k)])
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    base = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), lines.alias("lines"))
    base = base.withColumn("words", F.transform("lines", _line_words))
    base = base.select("row", "doc_id", F.size(F.filter("words", lambda x: F.size(x) > 0)).cast("long").alias("n_paragraphs"), "words", F.posexplode(F.concat(F.array(F.array(F.lit(_EVERY))), "words")).alias("paragraph", "w"))
    after = F.when(F.col("paragraph") > 0, F.get(F.get("words", F.col("paragraph")), F.lit(0)))
    split = base.select("row", "doc_id", "n_paragraphs", "paragraph", F.when(F.size("w") > 0, F.col("w")).otherwise(F.array(F.lit(_GAP))).alias("w"), after.alias("after"))
    each = split.select("row", "doc_id", "n_paragraphs", "paragraph", "w", "after", F.posexplode("w").alias("pos", "a"))
    inside = F.col("pos") + 1 < F.size("w")
    pair = F.concat_ws(" ", "a", F.when(inside, F.get("w", F.col("pos") + 1)).otherwise(F.col("after")))
    part = lambda g, over: F.struct(g.alias("g"), over.alias("over"))
    grams = each.select("row", "doc_id", "n_paragraphs", "paragraph", F.inline(F.array(part(F.col("a"), F.lit(False)), part(F.when(inside | F.col("after").isNotNull(), pair), ~inside))))
    met = grams.join(F.broadcast(table), F.col("g") == F.col("f"))
    own, over = F.when(~F.col("over"), F.col("g")), F.when(F.col("over"), F.col("g"))
    weight = lambda i, kind: F.coalesce(F.sum(F.when(kind.isNotNull(), F.col(f"w{i}"))), F.lit(0.0))
    sums = met.groupBy("row", "doc_id", "n_paragraphs", "paragraph").agg(
        *[weight(i, own).alias(f"s{i}") for i in range(k)], *[weight(i, over).alias(f"o{i}") for i in range(k)],
        F.collect_set(own).alias("found"), F.collect_set(over).alias("across"), F.max(F.col("g") == _GAP).alias("gap"),
    )
    best = written(_judged(sums, fitted, "found", "templates"), "licence-lines")  # once, as rows are numbered here
    to = lambda n: Window.partitionBy("row").orderBy("paragraph").rangeBetween(0, n)
    ahead = to(MOST_LINES - 1)
    near = F.struct("paragraph", "found", "across", "gap", "sure", F.array(*[f"s{i}" for i in range(k)]).alias("s"), F.array(*[f"o{i}" for i in range(k)]).alias("o"))
    starts = best.withColumn("near", F.collect_list(near).over(ahead)).filter("paragraph > 0 and not gap and not sure and size(near) > 1")
    stop = F.array_min(F.transform(F.filter("near", lambda x: x["gap"] | x["sure"]), lambda x: x["paragraph"]))
    starts = starts.withColumn("near", F.filter("near", lambda x: stop.isNull() | (x["paragraph"] < stop))).filter("size(near) > 1")
    tries = starts.select("row", "paragraph", "near", F.explode(F.sequence(F.lit(2), F.size("near"))).alias("n"))
    some, head = F.slice("near", 1, F.col("n")), F.slice("near", 1, F.col("n") - 1)
    last = F.element_at("near", F.col("n"))["paragraph"]
    both = F.array_distinct(F.concat(F.flatten(F.transform(some, lambda x: x["found"])), F.flatten(F.transform(head, lambda x: x["across"]))))
    add = lambda of, name, i: F.aggregate(of, F.lit(0.0), lambda a, x: a + x[name][i])
    runs = tries.select("row", "paragraph", last.alias("last"), both.alias("both"), *[(add(some, "s", i) + add(head, "o", i)).alias(f"s{i}") for i in range(k)])
    runs = _judged(runs, fitted, "both", "wholes").filter("sure").groupBy("row", "paragraph").agg(F.collect_list(F.struct("last", "family", "score")).alias("runs"))
    return best.select("row", "doc_id", "n_paragraphs", "paragraph", "family", "score", F.col("sure").alias("confirmed")).join(runs, ["row", "paragraph"], "left")


def license_scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_paragraphs, n_licensed``, ``families`` (sorted, distinct) and ``found``, the confirmed
    paragraphs as structs of paragraph, family and score, of every document."""
    hit = F.when(F.col("confirmed"), F.struct("paragraph", "family", F.round("score", 6).alias("score")))
    run = F.transform("runs", lambda r: F.struct((r["last"] - F.col("paragraph")).alias("more"), F.col("paragraph"), r["last"].alias("last"), r["family"].alias("family"), F.round(r["score"], 6).alias("score")))
    per = licence_paragraphs(docs.select("doc_id", "text")).groupBy("row", "doc_id", "n_paragraphs").agg(F.collect_list(hit).alias("lines"), F.array_sort(F.flatten(F.collect_list(run))).alias("runs"))
    apart = lambda kept, r: ~F.exists(kept, lambda o: (o["paragraph"] <= r["last"]) & (r["paragraph"] <= o["last"]))
    kept = F.aggregate("runs", F.slice("runs", 1, 0), lambda kept, r: F.when(apart(kept, r), F.concat(kept, F.array(r))).otherwise(kept))
    found = F.array_sort(F.concat("lines", F.transform(kept, lambda r: F.struct(r["paragraph"].alias("paragraph"), r["family"].alias("family"), r["score"].alias("score")))))
    per = per.withColumn("found", found)
    return per.select("doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_licensed"), F.array_sort(F.array_distinct(F.transform("found", lambda f: f["family"]))).alias("families"), "found")
