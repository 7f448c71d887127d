"""License scan: a trained paragraph classifier with a calibrated unknown class, confirmed against templates.

A paragraph (line) becomes the set of its word 1- to 3-grams that hold a word of the licence vocabulary: words of the
templates that are no function words. A softmax regression on these sparse features, trained with an L1 penalty so that
few weights remain, tells the licence families from `unknown`. Its training set is made from the templates (rephrased,
cut and mixed into other text) and from a bounded, documented sample of paragraphs of the documents as unknown
(SAMPLE rows by smallest hash, so the same for any order of rows, each of SAMPLE_CHARS characters at most). Temperature and threshold are calibrated on a held-out
part: the predicted family counts only if its probability reaches the threshold, which keeps false alarms there under
FALSE_ALARMS; everything else is `unknown`. A prediction is confirmed if the paragraph holds the words of one of the
family's templates in order, to CONFIRM of them.

A paragraph without licence words has no features and costs one set operation. Nulls: a null text has no paragraphs; a
null doc_id keeps its findings. Empty tables train on the templates alone. Repeated rows are reported each, other columns
are ignored, long texts are read whole.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import hash_sample, slices

UNKNOWN = "unknown"
#: Paragraphs of the documents that the classifier sees as unknown, at most, and their characters (a bound of the sample only).
SAMPLE, SAMPLE_CHARS = 4000, 20000
PER_FAMILY, FALSE_ALARMS, CONFIRM = 240, 0.001, 0.8
FOUND = "doc_id long, paragraph int, family string, probability double, confirmed boolean, template string"

#: Licence families and the texts that state them (fixed values: public licence texts' titles and standard notices).
NOTICES: dict[str, tuple[str, ...]] = {
    "apache-2.0": ("Apache License Version 2.0, January 2004", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "mit": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Use of this source code is governed by a BSD-style license"),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "GNU General Public License version 2 or later",
        "You should have received a copy of the GNU General Public License along with this program",
    ),
    "lgpl": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "You should have received a copy of the GNU Lesser General Public License along with this library",
    ),
    "agpl": ("You should have received a copy of the GNU Affero General Public License along with this program",),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "cc-by": (),
    "cc-by-sa": (),
    "cc-by-nc": ("for non-commercial use only under a Creative Commons license",),
    "cc0": (
        "This work is dedicated to the public domain under CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "Released into the public domain",
    ),
    "proprietary": (
        "All rights reserved",
        "All rights reserved. No part of this publication may be reproduced or transmitted in any form without prior written permission",
        "This document is confidential and proprietary and may not be distributed without permission",
        "Unauthorized copying of this file, via any medium, is strictly prohibited",
    ),
}
#: What a family is called, and how notices name a licence (fixed values); every name goes with every phrase.
NAMES: dict[str, tuple[str, ...]] = {
    "apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0 license"),
    "mit": ("MIT License", "MIT license (MIT)", "MIT", "Expat license"),
    "bsd": ("BSD 3-Clause License", "2-Clause BSD License", "BSD-3-Clause", "BSD-2-Clause", "BSD license"),
    "gpl": ("GNU General Public License, version 3", "GNU General Public License v2.0", "GNU GPL", "GPL-3.0-or-later", "GPL-2.0-only", "GPLv3"),
    "lgpl": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v3", "GNU LGPL", "LGPL-2.1-or-later", "LGPLv3"),
    "agpl": ("GNU Affero General Public License, version 3", "GNU AGPL", "AGPL-3.0-only", "AGPLv3"),
    "mpl": ("Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL-2.0", "MPL 2.0"),
    "cc-by": ("CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License"),
    "cc-by-sa": ("CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike License"),
    "cc-by-nc": ("CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial License"),
    "cc0": ("CC0 1.0 Universal", "CC0-1.0", "CC0 public domain dedication"),
    "proprietary": (),
}
PHRASES = (
    "Licensed under the {}",
    "Released under the {}",
    "This work is licensed under a {}",
    "This software is licensed under the {}",
    "Distributed under the terms of the {}",
    "Available under the {}",
    "SPDX-License-Identifier: {}",
    "This project is subject to the {}",
    "Published under {}",
)


def templates_of(phrases: tuple[str, ...] = PHRASES) -> dict[str, tuple[str, ...]]:
    """Every family's notices, its names in the given phrases, and those names alone that have a number."""
    named = lambda family: (x for n in NAMES[family] for x in (*(p.format(n) for p in phrases), *[n] * (not n.isalpha() and any(map(str.isdigit, n)))))
    return {family: NOTICES[family] + tuple(named(family)) for family in NOTICES}


TEMPLATES = templates_of()
FAMILIES = (UNKNOWN, *TEMPLATES)
#: Words too common to mark a licence (fixed values).
FUNCTION_WORDS = frozenset("a an and any are as at be by for form from have in into is it its may no not of on or that the their this to under use via with without you your work text person following copy files terms project available published part related all".split())
_FRAMES = ("{}", "{}.", "{}. {filler}", "{filler} {}.", "{filler} {}. {filler}", "Note: {}", "* {}", "# {}", "{filler}. {}", "License: {}.")
_GAPS = str.maketrans({c: " " for c in ",;:!?\"'()[]{}<>*#|=`~"})


def tokens(text: str) -> list[str]:
    """Lower-case words; full stops, hyphens and slashes inside words stay, at their ends they go."""
    return [w for x in text.lower().translate(_GAPS).split() if (w := x.strip(".-/_"))]


def licence_words() -> frozenset[str]:
    return frozenset(w for group in TEMPLATES.values() for t in group for w in tokens(t)) - FUNCTION_WORDS


def grams(words: list[str], known: frozenset[str]) -> set[str]:
    """1- to 3-grams with at least one licence word; single ones are licence words themselves."""
    out: set[str] = set()
    for k, w in enumerate(words):
        if w in known:
            out.add(w)
            for a in range(max(0, k - 2), k + 1):
                for n in (2, 3):
                    if a + n > k and a + n <= len(words):
                        out.add(" ".join(words[a : a + n]))
    return out


def in_order(words: list[str], template: list[str]) -> float:
    """Share of the template's words that the paragraph has in order, close together."""
    from pairloom.llm.decontam import lcs

    if not words:
        return 0.0
    span = len(template) * 3 // 2
    return max(lcs(template, words[k : k + span]) for k in range(0, max(1, len(words) - span + 1), max(1, len(template) // 4))) / len(template) if len(words) > span else lcs(template, words) / len(template)


class Classifier:
    """Softmax regression with few non-zero weights, its temperature and its threshold."""

    def __init__(self, weights: dict[str, np.ndarray], bias: np.ndarray, temperature: float, threshold: float) -> None:
        self.weights, self.bias, self.temperature, self.threshold = weights, bias, temperature, threshold
        self.known = licence_words()
        self.templates = {f: [(t, tokens(t)) for t in group] for f, group in TEMPLATES.items()}

    def probabilities(self, text: str) -> np.ndarray:
        z = self.bias.copy()
        for g in grams(tokens(text), self.known):
            if g in self.weights:
                z += self.weights[g]
        z = np.exp((z - z.max()) / self.temperature)
        return z / z.sum()

    def predict(self, text: str) -> tuple[str, float]:
        p = self.probabilities(text)
        best = int(p.argmax())
        return (FAMILIES[best], float(p[best])) if best and p[best] >= self.threshold else (UNKNOWN, float(p[0]))

    def confirm(self, text: str, family: str) -> tuple[bool, str | None]:
        words = tokens(text)
        share, template = max(((in_order(words, t), name) for name, t in self.templates[family]), key=lambda x: x[0])
        return share >= CONFIRM, template if share >= CONFIRM else None


def training_rows(unknown: list[str], seed: int = 3, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> tuple[list[str], list[int]]:
    """Texts and classes: templates in many settings, paragraphs of the corpus, and near misses."""
    rng = random.Random(seed)
    words = [w for t in unknown for w in t.split()] or "some other text stands here with nothing to tell about".split()
    fill = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(3, 25)))
    texts, classes = list(unknown), [0] * len(unknown)
    for k, group in enumerate(templates.values(), 1):
        for t in group:
            for _ in range(max(1, PER_FAMILY // len(group))):
                w = t.split()
                if len(w) > 6 and rng.random() < 0.3:
                    del w[rng.randrange(len(w))]
                body = " ".join(w)
                body = body.upper() if rng.random() < 0.1 else body
                texts.append(rng.choice(_FRAMES).format(body, filler=fill()))
                classes.append(k)
    vocabulary = sorted(w for w in licence_words() if w.isalpha())  # identifiers with numbers are no chance words
    for _ in range(len(texts) // 4):  # licence words in other company are unknown
        words_in = fill().split() + [rng.choice(vocabulary) for _ in range(rng.randint(1, 3))]
        rng.shuffle(words_in)
        texts.append(" ".join(words_in))
        classes.append(0)
    return texts, classes


def train(unknown: list[str], epochs: int = 60, penalty: float = 2e-4, seed: int = 3, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> Classifier:
    """Fits on four fifths of the rows, calibrates on the rest; `templates` may leave some of a family's out, for tests."""
    texts, classes = training_rows(unknown, seed, templates)
    known = licence_words()
    features = [sorted(grams(tokens(t), known)) for t in texts]
    order = list(range(len(texts)))
    random.Random(seed + 1).shuffle(order)
    cut = len(order) * 4 // 5
    fit, held = order[:cut], order[cut:]
    index = {g: k for k, g in enumerate(sorted({g for r in fit for g in features[r]}))}
    ids = [np.array([index[g] for g in features[r] if g in index], np.int64) for r in order]
    y = np.array([classes[r] for r in order])
    row = np.repeat(np.arange(len(order)), [len(x) for x in ids])
    col = np.concatenate(ids) if ids else np.empty(0, np.int64)
    inner = row < cut
    weights, bias = np.zeros((len(index), len(FAMILIES))), np.zeros(len(FAMILIES))
    target = np.eye(len(FAMILIES))[y[:cut]]
    squares = np.full(weights.shape, 1e-6)

    def scores(n: int, r: np.ndarray, c: np.ndarray) -> np.ndarray:
        z = np.zeros((n, len(FAMILIES)))
        np.add.at(z, r, weights[c])
        return z + bias

    def softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    r_in, c_in = row[inner], col[inner]
    for _ in range(epochs):  # proximal AdaGrad over all rows
        gap = (softmax(scores(cut, r_in, c_in)) - target) / cut
        slope = np.zeros_like(weights)
        np.add.at(slope, c_in, gap[r_in])
        squares += slope**2
        step = 0.5 / np.sqrt(squares)
        weights -= step * slope
        weights = np.sign(weights) * np.maximum(0, np.abs(weights) - step * penalty / 20)
        bias -= 2.0 * gap.sum(axis=0)
    z_held = scores(len(order), row, col)[cut:]
    y_held = y[cut:]
    losses = {t: -np.log(np.maximum(1e-12, softmax(z_held / t)[np.arange(len(held)), y_held])).mean() for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)}
    temperature = min(losses, key=losses.get)
    p = softmax(z_held / temperature)
    false = np.sort(p[(y_held == 0)][:, 1:].max(axis=1))[::-1] if (y_held == 0).any() else np.zeros(1)
    threshold = float(max(0.5, min(0.95, false[int(FALSE_ALARMS * len(false))] + 1e-6)))
    kept = {g: weights[k] for g, k in index.items() if np.abs(weights[k]).max() > 0}
    return Classifier(kept, bias, temperature, threshold)


def unknown_sample(docs: DataFrame, n: int = SAMPLE) -> list[str]:
    """At most n paragraphs of the documents, those with the smallest hashes; any that a template confirms are left out."""
    first = docs.select(F.expr("filter(split(text, '\\n'), x -> trim(x) <> '')").alias("p")).select(F.expr("get(p, cast(pmod(xxhash64(size(p), get(p, 0)), greatest(size(p), 1)) as int))").alias("t")).where("t is not null")
    found = [x.t for x in hash_sample(first.select(F.substring("t", 1, SAMPLE_CHARS).alias("t")).distinct(), "t", n, docs.count())]
    check = Classifier({}, np.zeros(len(FAMILIES)), 1.0, 1.0)
    return [t for t in found if not (set(tokens(t)) & check.known and any(check.confirm(t, f)[0] for f in TEMPLATES))]


def scan(docs: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """The paragraphs in which a licence is found: document, paragraph, family, probability, and the template that confirms it."""
    model = classifier or train(unknown_sample(docs))
    given = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the templates and SAMPLE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = given.value
        known = model.known
        for batch in slices(batches):
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for k, line in enumerate(text.split("\n") if text else ()):
                    if known.isdisjoint(line.lower().translate(_GAPS).replace(".", " ").split()) and known.isdisjoint(tokens(line)):
                        continue
                    family, p = model.predict(line)
                    if family != UNKNOWN:
                        sure, template = model.confirm(line, family)
                        out.append((doc, k, family, p, sure, template))
            cols = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in FOUND.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FOUND)
