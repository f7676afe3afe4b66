"""License scans: a trained paragraph classifier, confirmed by templates; DataFrame functions only.

Paragraphs are what lines without letters or digits part (so wrapped and commented notices are whole); of a paragraph of several lines each line is
a paragraph too.  Sparse word 1- and 2-grams of known notices, of notices of other licences, and of sentences that only sound like
them, train a multinomial logistic regression on the driver; data and weights are as small as the templates.  A scan
takes the n-grams of every paragraph of every text, and bounds in the scan itself how far any class can come out ahead of
no licence: by the most that each n-gram can add, rounded up, first from words alone, then with pairs.  Only paragraphs that are surely no licence
by that are passed over; of the others, n-grams are joined with the weights
(broadcast, their number is fixed by the templates), summed by paragraph and family, and turned into probabilities.

Probabilities are calibrated on notices held out in turn: a temperature, the probability from which a family is
believed, and the probability from which no licence is.  A family also needs a template most of whose n-grams the paragraph has, or that most of a paragraph
of some length comes from.  A paragraph is ``unknown`` if it is most like other licences, or if neither a family nor no licence is sure.
A confirmed notice over several lines stands for its lines.

Defined cases: null, empty and blank texts have no paragraphs; repeated lines count each; a null id is a document of
its own that stands for all rows of null id; equal rows of one id are one document with the paragraphs of all of them;
ties in probability go to the family first by name; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

# Short forms of well-known public licence notices.
TEMPLATES = {
    "agpl-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", "Licensed under the AGPL v3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation."),
    "all-rights-reserved": ("All rights reserved.", "Copyright by the authors. All rights reserved.", "Copyright (c) 2020 the publisher. All rights reserved."),
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "Released under the Apache 2.0 license.", "SPDX-License-Identifier: Apache-2.0"),
    "bsd": ("Released under the BSD License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Available under CC BY 4.0.", "Released under a Creative Commons Attribution licence."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Available under CC BY-NC 4.0."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Released under CC BY-SA 4.0.", "Text is available under the Creative Commons Attribution-ShareAlike License."),
    "cc0": ("To the extent possible under law, the author has waived all copyright and related rights to this work.", "Released under CC0 1.0 Universal public domain dedication.", "Dedicated to the public domain under CC0.", "Licensed under CC0 1.0."),
    "gpl-2.0": ("This work is licensed under the GNU General Public License, version 2.", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2.", "Distributed under the GNU GPL v2.", "SPDX-License-Identifier: GPL-2.0-only", "Licensed under the GPL version 2."),
    "gpl-3.0": ("This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "Distributed under the GNU GPL v3.", "SPDX-License-Identifier: GPL-3.0-or-later", "Licensed under the GPL version 3."),
    "lgpl": ("This library is licensed under the GNU Lesser General Public License.", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.", "Licensed under the LGPL.", "Distributed under the GNU LGPL, version 2.1."),
    "mit": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.", "Licensed under the MIT License.", "License: MIT", "MIT License", "Licensed under MIT.", "SPDX-License-Identifier: MIT"),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0.", "Licensed under MPL 2.0.", "SPDX-License-Identifier: MPL-2.0"),
}
# Notices of licences that have no family of their own, and of terms that aren't public.
OTHERS = (
    "Licensed under the ISC License.", "Released under the Artistic License 2.0.", "This program is made available under the terms of the Eclipse Public License 2.0.",
    "Distributed under the Boost Software License, Version 1.0.", "Licensed under the SIL Open Font License.", "Released under the Unlicense.", "License: WTFPL",
    "Licensed under the Academic Free License version 3.0.", "Subject to the terms of the Common Development and Distribution License.", "Released under the PostgreSQL License.",
    "Licensed under the Microsoft Public License.", "Released under the Open Database License.", "Licensed under the Python Software Foundation License.", "Licensed under the Ruby license.",
    "This software is proprietary and confidential.", "Unauthorized copying of this file, via any medium, is strictly prohibited.", "No part of this software may be reproduced or distributed without prior written permission.",
    "Use of this software is subject to the terms of the license agreement.", "A commercial license is required for use in production.", "Redistribution of this software is not permitted.",
    "For internal use only; do not distribute.", "You may not copy, modify or redistribute this software.", "This code is licensed under a custom license; see the file for the terms.",
    "Licensed under the terms found in the LICENSE file.", "Licensed under the X11 license.", "Released under the Vim license.", "This software may be used for evaluation only; redistribution is prohibited.",
    "Licensed under the Elastic License 2.0.", "Licensed under the Business Source License 1.1.", "Licensed under the CeCILL.", "Licensed under the OSL 3.0.", "SPDX-License-Identifier: EPL-2.0",
)
NOT_LICENCES = (
    "The driver showed the officer a license to drive the truck.", "Her fishing license had expired in the spring.", "The city gave the shop a license to sell wine.",
    "A poetic licence was taken with the facts of the story.", "He asked permission to leave the table.", "They were granted permission to build a house by the river.",
    "The software runs free of errors on the new version of the machine.", "Public transport is free for students under the age of ten.", "The source of the river is under the mountain.",
    "All rights belong to the people, said the speaker.", "The book was released under the title of the first chapter.", "The terms of the contract were read to the workers.",
    "She works in the general office of the public library.", "The commons behind the church were open to all.", "Version two of the report was published in May.",
    "The film was released in the autumn.", "A copy of the letter was found in the file.", "The law was changed by the king in that year.", "The report is available at the office.", "Smoking is prohibited in the hall.",
    "The use of water is limited in summer.", "He may not use the car without his father.", "The new software was used by the workers for the first time.", "Prior to the war the town was open.", "The foundation of the house is of stone.",
    "The author of the book lives in the city.", "The work is done by hand.", "No part of the city was left as it was.", "It was published by the university in two parts.", "The material was written in the open.",
    # Prose of common words, with the German word that looks like a licence's name.
    "Er fuhr mit dem Zug in die Stadt.", "Sie kam mit der Mutter und mit den Kindern an.", "Das Haus mit dem Garten ist alt.", "Komm mit.", "Mit wem?", "Mit.",
    "That is how it was, and they are as old as he is.", "As we are at home, it is late.", "Are you at the end of it?", "That it was for her to be in it or not is as it may be.",
    "He was by the sea with a friend and they had that to eat on the way.", "It is not for you to say what you may do.", "This is the one.", "Is this for this?", "To be or not to be.", "2.0", "Version 3.", "See page 4.", "1.0 and 2.0", "You can do it or not.", "At home in 2020.",
)
NONE, UNKNOWN = "none", "unknown"
TOKEN = "[a-z0-9]+"
BLANK = "\\n[^\\p{L}\\p{N}\\n]*(?=\\n)"  # a line without letters or digits


def _tokens(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


def _grams(tokens: list[str]) -> set[str]:
    return set(tokens) | {f"{a} {b}" for a, b in zip(tokens, tokens[1:], strict=False)}


def _samples() -> list[tuple[set[str], str, int]]:
    """(n-grams, class, fold): notices whole, without their ends and beginnings; all of one notice are in one fold."""
    out = []
    classes = [*TEMPLATES.items(), (UNKNOWN, OTHERS), (NONE, NOT_LICENCES)]
    for family, notices in classes:
        for i, notice in enumerate(notices):
            tokens = _tokens(notice)
            cuts = [tokens, tokens[: max(4, len(tokens) * 3 // 4)], tokens[len(tokens) // 5 :]]
            out += [(_grams(c), family, i % FOLDS) for c in cuts]
    # Text of other words says nothing about licences.
    return out + [(set(), NONE, i % FOLDS) for i in range(20)]


FOLDS = 5
# A template confirms from the first share on, and by itself from the second; a share of a paragraph's n-grams counts only if they are some.
LEAST_OVERLAP, SURE_OVERLAP, LEAST_GRAMS = 0.7, 0.95, 5


class Model:
    """Weights by n-gram and class, template n-grams, what each n-gram can add, and the calibrated probabilities."""

    def __init__(self, rounds: int = 200, rate: float = 2.0, ridge: float = 2e-3):
        samples = _samples()
        self.families = sorted({f for _, f, _ in samples})
        vocabulary = {g: i for i, g in enumerate(sorted(set().union(*(g for g, _, _ in samples))))}
        x = np.zeros((len(samples), len(vocabulary) + 1), np.float32)
        for row, (grams, _, _) in zip(x, samples, strict=True):
            row[[vocabulary[g] for g in grams]] = 4 / math.sqrt(max(1, len(grams)))
            row[-1] = 1
        y = np.array([[f == own for f in self.families] for _, own, _ in samples], np.float32)
        fold = np.array([i for *_, i in samples])

        alike = x @ x.T

        def fitted(rows: np.ndarray) -> np.ndarray:
            """A weight for each sample and class; the weights of n-grams are the samples' sums of them."""
            own, k = y[rows], alike[np.ix_(rows, rows)]
            share = own / own.sum(axis=0)  # classes weigh alike, but for no licence, which is the usual case
            weight = (share * np.where(np.array(self.families) == NONE, 4, 1)).sum(axis=1, keepdims=True, dtype=np.float32)
            a, momentum = np.zeros_like(own), np.zeros_like(own)
            for _ in range(rounds):
                z = k @ a
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                momentum = np.float32(0.9) * momentum - np.float32(rate / len(self.families)) * ((p - own) * weight + np.float32(ridge) * a)
                a += momentum
            out = np.zeros_like(y)
            out[rows] = a
            return out

        held = np.zeros_like(y)
        for i in range(FOLDS):
            held[fold == i] = alike[fold == i] @ fitted(np.flatnonzero(fold != i))
        self.templates = [(f, i, _grams(_tokens(n))) for f, notices in TEMPLATES.items() for i, n in enumerate(notices)]
        self._calibrate(held, y, [g for g, *_ in samples])
        w = x.T @ fitted(np.arange(len(samples)))
        self.weights = {f: {g: float(w[i, j]) for g, i in vocabulary.items()} for j, f in enumerate(self.families)}
        self.bias = {f: float(w[-1, j]) for j, f in enumerate(self.families)}
        # The most that any class gains on no licence: by its bias, and by each n-gram, rounded up to quarters.
        others = [f for f in self.families if f != NONE]
        self.ahead = max(self.bias[f] for f in others) - self.bias[NONE]
        # Where all others together stay this far behind, no licence is sure.
        self.behind = self.temperature * math.log((1 - self.least_none) / (self.least_none * len(others)))
        self.gains = {g: math.ceil(4 * max(self.weights[f][g] - self.weights[NONE][g] for f in others)) / 4 for g in vocabulary}
        # The same without pairs: what a pair can add is charged to that of its words which is rarer in prose.
        prose = Counter(t for n in NOT_LICENCES for t in _tokens(n))
        self.charges: dict[str, float] = {}
        for g, gain in self.gains.items():
            word = min(g.split(), key=lambda w: (prose[w], w))
            self.charges[word] = self.charges.get(word, 0.0) + max(gain, 0.0)

    def overlap(self, grams: set[str], family: str) -> float:
        """The largest share that the n-grams have of a template of the family, or it of theirs if they are some."""
        both = [(len(grams & own), len(own)) for f, _, own in self.templates if f == family]
        return max([max(n / size, n / len(grams) if len(grams) >= LEAST_GRAMS else 0.0) for n, size in both] or [0.0])

    def _calibrate(self, z: np.ndarray, y: np.ndarray, grams: list[set[str]]) -> None:
        """A temperature of the least surprise on held-out samples; then the least probability at which 19 in 20 families that a template confirms are right, and that of no licence which 19 in 20 reach."""

        def softmax(t: float) -> np.ndarray:
            p = np.exp((z - z.max(axis=1, keepdims=True)) / t)
            return p / p.sum(axis=1, keepdims=True)

        self.temperature = float(min(np.geomspace(0.1, 10, 61), key=lambda t: -np.log(np.maximum(1e-12, softmax(t)[y > 0])).mean()))
        p = softmax(self.temperature)
        best, sure = p.argmax(axis=1), p.max(axis=1)
        right = y[np.arange(len(y)), best] > 0
        named = np.array([self.overlap(g, self.families[b]) >= LEAST_OVERLAP for g, b in zip(grams, best, strict=True)])
        order = np.argsort(-sure[named], kind="stable")
        good = np.cumsum(right[named][order]) >= 0.95 * np.arange(1, named.sum() + 1)
        self.least = round(float(sure[named][order][np.flatnonzero(good)[-1]]), 6) if good.any() else 1.0
        none = np.sort(p[y[:, self.families.index(NONE)] > 0, self.families.index(NONE)])
        self.least_none = round(float(none[len(none) // 20]), 6)

    def probabilities(self, grams: set[str]) -> dict[str, float]:
        scale = 4 / math.sqrt(max(1, len(grams)))
        z = {f: (self.bias[f] + scale * sum(self.weights[f].get(g, 0.0) for g in grams)) / self.temperature for f in self.families}
        top = max(z.values())
        e = {f: math.exp(v - top) for f, v in z.items()}
        total = sum(e.values())
        return {f: v / total for f, v in e.items()}


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def _may_win(model: Model, grams: Column, gains: dict[str, float]) -> Column:
    """Whether the paragraph may be anything but surely no licence, from distinct grams and the most that each adds."""
    steps: dict[float, list[str]] = {}
    for g, gain in gains.items():
        if gain:
            steps.setdefault(gain, []).append(g)

    def gain_of(gram: Column) -> Column:
        value = F.lit(0.0)
        for gain, own in steps.items():
            value = F.when(gram.isin(own), F.lit(gain)).otherwise(value)
        return value

    known = [g for own in steps.values() for g in own]
    total = F.aggregate(F.filter(grams, lambda g: g.isin(known)), F.lit(0.0), lambda total, g: total + gain_of(g))
    # A little over, for the order of sums.
    return model.ahead + 4 / F.sqrt(F.greatest(F.size(grams), F.lit(1))) * total + 1e-3 >= model.behind


def paragraphs(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row, document id, place of the paragraph and of the line in it (-1 for a paragraph of several lines as a whole) and the distinct n-grams, of all that aren't surely no licence."""
    whole = df.select(F.monotonically_increasing_id().alias("doc"), F.col(id_col), F.posexplode(F.split(F.col(text_col), BLANK)).alias("paragraph", "whole"))
    lines = F.split("whole", "\n")
    units = F.concat(F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("line"), F.col("whole").alias("unit")))).otherwise(F.array().cast("array<struct<line:int,unit:string>>")), F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("unit"))))
    units = whole.select("doc", id_col, "paragraph", F.explode(units).alias("u")).select("doc", id_col, "paragraph", "u.line", "u.unit")
    # Arrays of one, exploded: filters stay behind them, and don't cut a line into words again for each word.
    words = units.select("doc", id_col, "paragraph", "line", F.explode(F.array(_words(F.col("unit")))).alias("w"))
    words = words.select("doc", id_col, "paragraph", "line", "w", F.explode(F.array(F.array_distinct("w"))).alias("own")).filter(_may_win(model, F.col("own"), model.charges))
    pairs = F.when(F.size("w") > 1, F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.element_at("w", i), F.element_at("w", i + 1)))).otherwise(F.array().cast("array<string>"))
    grams = words.select("doc", id_col, "paragraph", "line", F.explode(F.array(F.array_distinct(F.concat("w", pairs)))).alias("grams"))
    return grams.filter(_may_win(model, F.col("grams"), model.gains))


def scan(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """One row for each paragraph that is a licence or may be: id, paragraph, line, family (or unknown), the best class's probability, overlap."""
    spark, model = df.sparkSession, model or Model()
    weights = spark.createDataFrame([(g, f, float(w)) for f, own in model.weights.items() for g, w in own.items() if abs(w) > 1e-9], "gram string, family string, weight double")
    families = F.explode(F.array(*(F.struct(F.lit(f).alias("family"), F.lit(float(b)).alias("bias")) for f, b in model.bias.items())))
    parts = spark.createDataFrame([(g, f, i, len(own)) for f, i, own in model.templates for g in own], "gram string, family string, template int, n_template int")
    # The id may be null or repeated: a number keeps paragraphs apart.  Only likely paragraphs are kept.
    found = common.checkpointed(paragraphs(df, model, id_col=id_col, text_col=text_col).withColumn("at", F.monotonically_increasing_id()).select("at", "doc", id_col, "paragraph", "line", "grams", F.size("grams").alias("n")))
    grams = found.select("at", F.explode("grams").alias("gram"))
    sums = grams.join(F.broadcast(weights), "gram").groupBy("at", "family").agg(F.sum("weight").alias("sum"))
    shared = grams.join(F.broadcast(parts), "gram").groupBy("at", "family", "template", "n_template").agg(F.count("*").alias("both"))
    head = found.select("at", "doc", id_col, "paragraph", "line", "n")
    z = head.select("at", "n", families.alias("_f")).select("at", "n", "_f.family", "_f.bias").join(sums, ["at", "family"], "left").withColumn("z", (F.col("bias") + 4 / F.sqrt(F.greatest(F.col("n"), F.lit(1))) * F.coalesce("sum", F.lit(0.0))) / model.temperature)
    by = Window.partitionBy("at")
    p = z.withColumn("p", F.exp(F.col("z") - F.max("z").over(by))).withColumn("p", F.col("p") / F.sum("p").over(by))
    best = p.groupBy("at").agg(F.min_by(F.struct("family", "p"), F.struct(-F.col("p"), F.col("family"))).alias("b")).select("at", F.col("b.family").alias("best"), F.col("b.p").alias("probability"))
    share = F.greatest(F.col("both") / F.col("n_template"), F.when(F.col("n") >= LEAST_GRAMS, F.col("both") / F.col("n")).otherwise(0.0))
    near = shared.join(head.select("at", "n"), "at").groupBy("at", F.col("family").alias("best")).agg(F.max(share).alias("overlap"))
    out = head.join(best, "at").join(near, ["at", "best"], "left").withColumn("overlap", F.coalesce("overlap", F.lit(0.0)))
    sure = ~F.col("best").isin(NONE, UNKNOWN) & (F.col("overlap") >= F.when(F.col("probability") >= model.least, LEAST_OVERLAP).otherwise(SURE_OVERLAP))
    judged = out.filter(~((F.col("best") == NONE) & (F.col("probability") >= model.least_none))).withColumn("family", F.when(sure, F.col("best")).otherwise(F.lit(UNKNOWN)))
    # A confirmed notice of several lines stands for them; one that isn't confirmed counts where no line does.
    around = Window.partitionBy("doc", "paragraph")
    whole = F.max(F.when(F.col("line") < 0, F.when(F.col("family") == UNKNOWN, 1).otherwise(2)).otherwise(0)).over(around)
    own_lines = F.max(F.when(F.col("line") >= 0, 1).otherwise(0)).over(around)
    counted = judged.withColumn("_whole", whole).withColumn("_lines", own_lines).filter(F.when(F.col("line") < 0, (F.col("family") != UNKNOWN) | (F.col("_lines") == 0)).otherwise(F.col("_whole") < 2))
    return counted.select(id_col, "paragraph", "line", "family", F.round("probability", 6).alias("probability"), F.round("overlap", 6).alias("overlap"))


def scanned(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document id: the number of licence paragraphs, of unknown ones, and the families by name."""
    found = scan(df, id_col=id_col, text_col=text_col).groupBy(id_col).agg(F.count("*").alias("n_licences"), F.count_if(F.col("family") == UNKNOWN).alias("n_unknown"), F.concat_ws(",", F.array_sort(F.collect_set("family"))).alias("families"))
    ids = df.select(id_col).distinct()
    joined = ids.join(found.withColumnRenamed(id_col, "_id"), ids[id_col].eqNullSafe(F.col("_id")), "left")
    return joined.select(id_col, F.coalesce("n_licences", F.lit(0)).cast("long").alias("n_licences"), F.coalesce("n_unknown", F.lit(0)).cast("long").alias("n_unknown"), F.coalesce("families", F.lit("")).alias("families"))
