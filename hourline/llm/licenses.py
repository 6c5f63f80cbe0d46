"""Licence notices in documents, by a paragraph classifier trained here."""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline.llm.common import query, table

UNKNOWN = "unknown"
MAX_NEGATIVES = 2_000  # paragraphs of the documents that the unknown class is trained on, about; drawn by a hash
VARIANTS = 24
LEAST_PROBABILITY, LEAST_SIMILARITY = 0.5, 0.5
SEED = 7
TOKEN = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
# Phrases by which the licences name themselves.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version.",
    ),
    "lgpl-3.0": (
        "This library is licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-or-later",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    "lgpl-2.1": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or any later version.",
    ),
    "agpl-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    "bsd-3-clause": (
        "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ),
    "mpl-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "cc-by-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc0-1.0": ("Released into the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
}
# Sentences that share words with notices without being one.
DECOYS = (
    "The driver had no license and the car was towed.", "Version 2.0 of the program was released in May.", "This work was published under a false name.",
    "The general public is free to visit the foundation.", "You may not use this door.", "All rights reserved.", "Terms of use and conditions of sale apply.",
    "The software is licensed to the customer under a separate agreement.", "See the license file for details.", "He redistributed the source of income.",
    "The library is open to the public from 9 to 5.", "Attribution of the painting is uncertain.", "A permission slip is required for any person under 18.",
)
COMMON = frozenset("a an and any are as at be by for from in is it may not of on or the this to under with you".split())


def ngrams(words: list[str], longest: int = 3) -> set[str]:
    """Word n-grams, without those made of common words alone."""
    return {
        " ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)
        if not COMMON.issuperset(words[i : i + n])
    }


def tokens(paragraph: str) -> list[str]:
    return TOKEN.findall(paragraph.lower())


@dataclass
class Classifier:
    families: list[str]  # the last is UNKNOWN
    vocabulary: dict[str, int]
    weights: np.ndarray  # (features, families)
    bias: np.ndarray
    temperature: float
    cues: frozenset[str]

    def probabilities(self, words: list[str]) -> np.ndarray:
        known = [self.vocabulary[g] for g in ngrams(words) if g in self.vocabulary]
        scores = (self.weights[known].sum(axis=0) / np.sqrt(max(1, len(known))) + self.bias) / self.temperature
        p = np.exp(scores - scores.max())
        return p / p.sum()

    def find(self, text: str | None) -> tuple[int, list[dict]]:
        """(paragraphs, notices found): a paragraph is a run of lines with words; a notice is one or more lines of it, wherever
        they are wrapped. Spans are code points of the whole text."""
        found, count, at = [], 0, 0
        lines: list[tuple[int, int, list[str]]] = []  # of the paragraph so far: start, stop, words
        for line in [*(text or "").split("\n"), ""]:
            start, at = at, at + len(line) + 1
            if words := tokens(line):
                lines.append((start, start + len(line), words))
            elif lines:
                found += [{"paragraph": count, **notice} for notice in self._notices(lines)]
                count, lines = count + 1, []
        return count, found

    def _notices(self, lines: list[tuple[int, int, list[str]]]) -> list[dict]:
        """The notices of a paragraph: windows of lines, those with most of a template first and of equal ones the shortest, none overlapping."""
        # Without a cue no feature is known, and the bias alone says unknown.
        if all(self.cues.isdisjoint(words) for _, _, words in lines):
            return []
        held = _template_words.intersection(zip(whole := [w for _, _, words in lines for w in words], whole[1:]))
        if not any(len(held & t) >= LEAST_SIMILARITY * len(t) for ts in _template_pairs.values() for t in ts):
            return []
        windows = []
        for i, (start, _, words) in enumerate(lines):
            if self.cues.isdisjoint(words):
                continue
            window: list[str] = []
            for j in range(i, len(lines)):
                if j > i and len(window) + len(lines[j][2]) > WINDOW_WORDS:
                    break
                window = window + lines[j][2]
                own = held.intersection(zip(window, window[1:]))
                if not any(len(own & t) >= LEAST_SIMILARITY * len(t) for ts in _template_pairs.values() for t in ts):
                    continue
                p = self.probabilities(window)
                best = int(p.argmax())
                if best < len(self.families) - 1 and p[best] >= LEAST_PROBABILITY:
                    likeness = similarity(window, self.families[best])
                    if likeness >= LEAST_SIMILARITY:
                        most = max(len(own & t) for t in _template_pairs[self.families[best]] if len(own & t) >= LEAST_SIMILARITY * len(t))
                        windows.append((-most, j - i, i, {"start": start, "stop": lines[j][1], "family": self.families[best],
                                                              "probability": float(p[best]), "similarity": likeness}))
        taken: set[int] = set()
        found = []
        for _, more, i, notice in sorted(windows, key=lambda w: w[:3]):
            if taken.isdisjoint(range(i, i + more + 1)):
                taken.update(range(i, i + more + 1))
                found.append(notice)
        return sorted(found, key=lambda n: n["start"])


def _pairs(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + 2]) for i in range(max(1, len(words) - 1))}


_template_pairs = {f: [_pairs(tokens(t)) for t in ts] for f, ts in TEMPLATES.items()}
_template_words = frozenset(p for ts in _template_pairs.values() for t in ts for p in t)
WINDOW_WORDS = 2 * max(len(tokens(t)) for ts in TEMPLATES.values() for t in ts)  # joined lines hold at most so many; one line, any


def similarity(words: list[str], family: str) -> float:
    """Largest share of a template's word pairs that the paragraph holds."""
    own = _pairs(words)
    return max(len(own & t) / len(t) for t in _template_pairs[family])


def _variants(rng: random.Random, words: list[str]) -> list[list[str]]:
    """Notices as they are met: words lost, doubled or added around them."""
    filler = ["file", "project", "code", "data", "text", "copyright", "2024", "see", "license", "author", "docs", "here"]
    out = [words]
    for _ in range(VARIANTS):
        kept = [w for w in words if rng.random() > 0.08] or words
        head = [rng.choice(filler) for _ in range(rng.randrange(5))]
        out.append(head + kept + [rng.choice(filler) for _ in range(rng.randrange(5))])
    return out


def negatives(df: DataFrame, text: str = "text", most: int = MAX_NEGATIVES) -> list[str]:
    """About `most` paragraphs of the documents, drawn by a hash, unlike any template: bounded, for the driver."""
    rows = df.where(F.col(text).isNotNull())
    share = min(1.0, most / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(SEED), text), F.lit(1_000_000)) < int(share * 1_000_000)).select(
        F.explode(F.slice(F.split(text, "\n"), 1, 1)).alias("p")).where("length(p) > 0")
    lines = [r["p"][:2000] for r in drawn.collect()]
    return sorted(p for p in lines if max(similarity(tokens(p), f) for f in TEMPLATES) < 0.3)


def train(unlike: list[str], seed: int = SEED, rounds: int = 150) -> Classifier:
    """Multinomial logistic regression on the n-grams of the templates' variants; an unknown class from decoys, incomplete
    notices and the given paragraphs; one temperature fitted on a held-out fifth."""
    rng = random.Random(seed)
    families = [*TEMPLATES, UNKNOWN]
    rows: list[tuple[set[str], int]] = []
    for k, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            rows += [(ngrams(w), k) for w in _variants(rng, tokens(template))]
    vocabulary = {g: i for i, g in enumerate(sorted({g for r, _ in rows for g in r}))}
    for decoy in DECOYS:
        rows += [(ngrams(w), len(families) - 1) for w in _variants(rng, tokens(decoy))]
    for p in unlike:
        rows.append((ngrams(tokens(p)), len(families) - 1))
    rows += [(set(), len(families) - 1)] * 20
    rng.shuffle(rows)
    x = np.zeros((len(rows), len(vocabulary)))
    for i, (grams, _) in enumerate(rows):
        known = [vocabulary[g] for g in grams if g in vocabulary]
        x[i, known] = 1 / np.sqrt(max(1, len(known)))
    y = np.eye(len(families))[[k for _, k in rows]]
    cut = len(rows) * 4 // 5
    keep = np.flatnonzero(x.any(axis=1) | (np.arange(len(rows)) % 8 == 0))
    fit, held = keep[keep < cut], keep[keep >= cut]
    w, b = np.zeros((len(vocabulary), len(families))), np.zeros(len(families))
    vw, vb = np.zeros_like(w), np.zeros_like(b)

    def softmax(s):
        p = np.exp(s - s.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    for _ in range(rounds):  # gradient steps with momentum
        gap = (softmax(x[fit] @ w + b) - y[fit]) / len(fit)
        vw = 0.9 * vw - 8.0 * (x[fit].T @ gap + 1e-5 * w)
        vb = 0.9 * vb - 8.0 * gap.sum(axis=0)
        w, b = w + vw, b + vb
    scores = x[held] @ w + b
    loss = lambda t: -np.log(np.maximum((softmax(scores / t) * y[held]).sum(axis=1), 1e-12)).mean()
    temperature = min(np.geomspace(0.25, 4, 33).tolist(), key=loss)
    return Classifier(families, vocabulary, w, b, temperature, frozenset(w for g in vocabulary for w in g.split() if w not in COMMON))


def scan(df: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `df`: key, n_paragraphs, licences (sorted family names) and notices (paragraph number, span, family,
    probability, share of a template's word pairs). NULL and empty texts have none; keys may be NULL or repeat; an empty
    table gives no rows. The whole text is read; other columns are dropped."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    notice = pa.struct([("paragraph", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("family", pa.string()),
                        ("probability", pa.float64()), ("similarity", pa.float64())])

    def run(batches):
        for batch in batches:
            found = [shared.value.find(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([sorted({n["family"] for n in f[1]}) for f in found], pa.list_(pa.string())),
                 pa.array([f[1] for f in found], pa.list_(notice))], [key, "n_paragraphs", "licences", "notices"])

    one = T.StructType.fromDDL("paragraph int, start long, stop long, family string, probability double, similarity double")
    schema = T.StructType([df.schema[key], T.StructField("n_paragraphs", T.LongType()), T.StructField("licences", T.ArrayType(T.StringType())),
                           T.StructField("notices", T.ArrayType(one))])
    return df.select(key, text).mapInArrow(run, schema)


@query("op10_licenses")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, train(negatives(docs)))
