"""Licence paragraphs: a trained classifier, confirmed by comparison with notices.

A multinomial logistic regression over sparse word n-grams (one to three words) tells licence
families and a class for everything else. It is trained on variations of each family's notices,
on sentences that only look alike, and on paragraphs of a few documents of the corpus; a
temperature calibrates its probabilities, fitted on sentence frames, look-alikes and paragraphs that training
has not seen. A predicted family is confirmed if the text holds most word pairs of one of its notices.

Blank lines end paragraphs. One without any word of a list fixed in advance is of the unknown class and is not scored. In the others,
stretches of 1, 2, 4, … lines that hold such a word are scored, so that a notice is found on a line of its own in the midst of
others as well as wrapped over many; of those that overlap, the one most like its notice counts, then the shortest.

Bounds of the fit: the unknown class learns from at most SAMPLE_DOCUMENTS documents, the first SAMPLE_CHARS
characters of each, and of these from SAMPLE_LINES lines; SAMPLE_WORDS of their words stand around varied notices. What is found in the
documents does not depend on how common words are there otherwise.

Defined cases: null and empty texts have no paragraph; texts are read whole; repeated rows are
judged alike; a null doc_id is carried as null; without documents only notices and look-alikes
train; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkscout.llm.shared import small_batches, texts_of

#: Bound of the corpus sample for the unknown class: documents with the least hashes, and characters of each.
SAMPLE_DOCUMENTS = 300
SAMPLE_CHARS = 4_000
SAMPLE_LINES = 600
SAMPLE_WORDS = 20_000
#: Lines of a scored stretch at most.
MOST_LINES = 32
VARIANTS = 40
STEPS = 120
CACHED_TOKENS = 500_000
LEAST_PROBABILITY = 0.5
LEAST_SIMILARITY = 0.6
UNKNOWN = "unknown"
MAY_BE_NOTICE = re.compile(r"(?i)\blicen[cs]|\bcopyright|\bpublic domain")  # such lines are not for the unknown class
WORD = re.compile(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*")
FOUND = "doc_id long, start long, end long, family string, probability double, similarity double, confirmed boolean"

# Names and usual notices of licence families.
NAMES = {
    "apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0 license"],
    "mit": ["MIT License", "MIT license", "The MIT License (MIT)"],
    "bsd": ["BSD License", "BSD 3-Clause License", "BSD-3-Clause", "BSD 2-Clause License", "Simplified BSD License"],
    "gpl": ["GNU General Public License, version 3", "GNU General Public License", "GNU GPL v3", "GPL-3.0", "GNU General Public License, version 2"],
    "lgpl": ["GNU Lesser General Public License", "GNU LGPL", "LGPL-2.1", "GNU Lesser General Public License, version 3"],
    "agpl": ["GNU Affero General Public License", "AGPL-3.0", "GNU AGPL v3", "GNU Affero General Public License, version 3"],
    "mpl-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "cc-by": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License"],
    "cc-by-sa": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc0": ["CC0 1.0", "CC0 1.0 Universal Public Domain Dedication", "Creative Commons Zero"],
    "isc": ["ISC License"],
    "unlicense": ["The Unlicense", "Unlicense"],
    "zlib": ["zlib License", "zlib/libpng License"],
    "epl": ["Eclipse Public License, version 2.0", "Eclipse Public License 2.0", "EPL-2.0", "Eclipse Public License, version 1.0"],
    "eupl": ["European Union Public Licence, version 1.2", "European Union Public Licence", "EUPL-1.2", "EUPL 1.2"],
    "ofl": ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1", "OFL-1.1"],
    "wtfpl": ["WTFPL", "Do What The Fuck You Want To Public License"],
}
NOTICES = {
    "apache-2.0": [
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    ],
    "mit": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    ],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"],
    "agpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one"],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose"],
    "zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"],
    "epl": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License which accompanies this distribution"],
    "ofl": ["This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is copied below, and is also available with a FAQ at"],
}
#: Words of which a text with a notice has at least one; besides these, names with a hyphen.
ANCHORS = frozenset(
    "license licenses licensed licensing licence licences licenced copyright permission warranty warranties redistribution "
    "redistributions redistribute gnu gpl lgpl agpl affero apache mozilla mpl bsd mit isc cc cc0 commons unlicense unencumbered "
    "zlib eclipse epl eupl ofl sil wtfpl endorse".split()
)
FRAMES = ("Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "Distributed under the terms of the {}.", "License: {}", "This project is available under the {}.")
LOOKALIKES = (
    "The driver showed a valid license and was free to go.",
    "A fishing license costs ten dollars a year.",
    "All rights reserved. No part of this publication may be reproduced without permission.",
    "The company licensed its patents to a rival under secret terms.",
    "This work is licensed under a custom agreement between the parties.",
    "Licensed under the terms of the contract with the publisher.",
    "The software was released under pressure in the spring.",
    "The general public was asked to leave the hall.",
    "The Apache helicopter landed on version two of the pad.",
    "Students at MIT released a study of the free market.",
    "Copyright disputes are common in the film industry.",
    "The commons was full of creative people that evening.",
    "Permission was granted to use the hall free of charge.",
    "Mozilla and other firms published a report on the web.",
    "Redistribution of wealth is a question of conditions.",
)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def ngrams(words: list[str]) -> list[str]:
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def pairs(words: list[str]) -> frozenset:
    return frozenset(zip(words, words[1:], strict=False)) or frozenset((w,) for w in words)


def notices_of(family: str) -> list[str]:
    return [*NAMES[family], *NOTICES.get(family, [])]


def anchors() -> frozenset:
    return ANCHORS | {w for names in NAMES.values() for name in names for w in words_of(name) if "-" in w}


def examples(paragraphs: list[str], seed: int = 5, frames=FRAMES, lookalikes=LOOKALIKES) -> list[tuple[str, str]]:
    """(text, class) for training: varied notices, look-alikes, and paragraphs of the corpus."""
    rng = random.Random(seed)
    filler = [w for p in paragraphs for w in words_of(p)][:SAMPLE_WORDS] or ["lorem", "ipsum", "dolor", "sit", "amet"]

    def varied(text: str) -> str:
        words = [w for w in text.split() if rng.random() > 0.05]
        return " ".join([*rng.choices(filler, k=rng.choice((0, 0, 0, 4, 12))), *words, *rng.choices(filler, k=rng.choice((0, 0, 0, 4, 12)))])

    found = []
    for family in NAMES:
        for _ in range(VARIANTS):
            found.append((varied(rng.choice(frames).format(rng.choice(NAMES[family]))), family))
        for notice in NOTICES.get(family, []):
            words = notice.split()
            found += [(varied(notice), family) for _ in range(VARIANTS // 4)]
            starts = [rng.randrange(max(1, len(words) // 3)) for _ in range(VARIANTS // 4)]  # parts, as lines cut them
            found += [(varied(" ".join(words[at : at + max(8, 2 * len(words) // 3)])), family) for at in starts]
    for text in lookalikes:
        found += [(varied(text), UNKNOWN) for _ in range(VARIANTS // 5)]
    for _ in range(VARIANTS * 2):  # frames around names that are no licence
        found.append((varied(rng.choice(frames).format(" ".join(rng.choices(filler, k=rng.randint(1, 4))))), UNKNOWN))
    found += [(p, UNKNOWN) for p in paragraphs[:SAMPLE_LINES]]
    rng.shuffle(found)
    return found


@dataclass
class Classifier:
    vocabulary: dict[str, int]
    weights: np.ndarray  # features x classes
    bias: np.ndarray
    temperature: float
    classes: list[str]

    def __post_init__(self):
        self.anchors, self.known = anchors(), {}
        self.templates = {f: [pairs(words_of(t)) for t in notices_of(f)] for f in NAMES}

    def __reduce__(self):
        return Classifier, (self.vocabulary, self.weights, self.bias, self.temperature, self.classes)

    def probabilities(self, words: list[str]) -> np.ndarray:
        found = {self.vocabulary[g] for g in ngrams(words) if g in self.vocabulary}
        logits = (self.bias + self.weights[sorted(found)].sum(axis=0)) / self.temperature
        e = np.exp(logits - logits.max())
        return e / e.sum()

    def judge(self, text: str) -> tuple[str, float, float, bool]:
        """Family, its probability, similarity with its nearest notice, and whether that confirms it."""
        words = words_of(text)
        p = self.probabilities(words)
        best = int(p.argmax())
        family, probability = self.classes[best], float(p[best])
        if family == UNKNOWN or probability < LEAST_PROBABILITY:
            return UNKNOWN, float(p[self.classes.index(UNKNOWN)]), 0.0, False
        own = pairs(words) | {(w,) for w in words}  # a name may be one word
        similarity = max(len(own & t) / len(t) for t in self.templates[family])
        return family, probability, similarity, similarity >= LEAST_SIMILARITY

    def scan(self, text: str) -> Iterator[tuple]:
        """start, end, family, probability, similarity, confirmed of each stretch that is not unknown, in order."""
        if not any(map(self.holds_anchor, set(text.split()))):
            return
        for lines in paragraphs_of(text):
            anchored = [any(map(self.holds_anchor, text[start:end].split())) for start, end in lines]
            if any(anchored):
                yield from self.stretches(text, lines, anchored)

    def stretches(self, text: str, lines: list[tuple[int, int]], anchored: list[bool]) -> list[tuple]:
        """The stretches of a paragraph's lines that are not unknown, those most like their notice first among overlapping ones."""
        before = [0, *accumulate(anchored)]
        found = []
        for a, b in windows(len(lines)):
            if before[b] > before[a]:
                start, end = lines[a][0], lines[b - 1][1]
                family, probability, similarity, confirmed = self.judge(text[start:end])
                if family != UNKNOWN:
                    found.append((not confirmed, -similarity, b - a, -probability, a, b, (start, end, family, probability, similarity, confirmed)))
        taken, chosen = [False] * len(lines), []
        for *_, a, b, row in sorted(found):
            if not any(taken[a:b]):
                taken[a:b] = [True] * (b - a)
                chosen.append(row)
        return sorted(chosen)

    def holds_anchor(self, token: str) -> bool:
        """Whether a text's token has a word of notices; remembered by token."""
        found = self.known.get(token)
        if found is None:
            if len(self.known) >= CACHED_TOKENS:
                self.known.clear()
            found = self.known[token] = not self.anchors.isdisjoint(WORD.findall(token.lower()))
        return found


def paragraphs_of(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of lines that are not blank, as (start, end) in code points of each line."""
    lines, at = [], 0
    for line in text.split("\n"):
        if line.strip():
            lines.append((at, at + len(line)))
        elif lines:
            yield lines
            lines = []
        at += len(line) + 1
    if lines:
        yield lines


def windows(lines: int) -> Iterator[tuple[int, int]]:
    """Stretches of so many lines: 1, 2, 4, … of them, each half over the one before."""
    size = 1
    while size <= MOST_LINES:
        step = max(1, size // 2)
        for start in range(0, max(1, lines - size + step), step):
            yield start, min(start + size, lines)
        if size >= lines:
            return
        size *= 2


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class _Sparse:
    """Examples as the numbers of their n-grams, row by row; the last feature is in all rows."""

    def __init__(self, texts: list[str], vocabulary: dict[str, int]):
        rows = [[*sorted({vocabulary[g] for g in ngrams(words_of(t)) if g in vocabulary}), len(vocabulary)] for t in texts]
        self.features = np.array([i for row in rows for i in row])
        self.starts = np.cumsum([0, *map(len, rows)])[:-1]
        self.row = np.repeat(np.arange(len(rows)), list(map(len, rows)))
        self.order = np.argsort(self.features, kind="stable")
        self.present, self.first = np.unique(self.features[self.order], return_index=True)

    def logits(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights[self.features], self.starts)

    def gradient(self, miss: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.zeros_like(weights)
        out[self.present] = np.add.reduceat(miss[self.row[self.order]], self.first)
        return out / len(miss)


def train(paragraphs: list[str]) -> Classifier:
    """Fit the classifier; `paragraphs` are those of a bounded sample of the corpus."""
    fit = examples(paragraphs[::2], 5, FRAMES[:-2], LOOKALIKES[::2])
    held = examples(paragraphs[1::2], 6, FRAMES[-2:], LOOKALIKES[1::2])
    classes = [*NAMES, UNKNOWN]
    grams = [(set(ngrams(words_of(text))), kind) for text, kind in fit]
    known = Counter(g for found, kind in grams if kind != UNKNOWN or len(found) < 80 for g in found)
    vocabulary = {g: i for i, g in enumerate(sorted(g for g, n in known.items() if n >= 4))}
    x, y = _Sparse([t for t, _ in fit], vocabulary), np.array([classes.index(kind) for _, kind in fit])
    wanted = np.eye(len(classes))[y]
    weights = np.zeros((len(vocabulary) + 1, len(classes)))
    speed, shrink = np.zeros_like(weights), np.full((len(weights), 1), 1e-4)
    shrink[-1] = 0
    for _ in range(STEPS):
        speed = 0.9 * speed - 0.5 * (x.gradient(softmax(x.logits(weights)) - wanted, weights) + shrink * weights)
        weights += speed
    logits, truth = _Sparse([t for t, _ in held], vocabulary).logits(weights), [classes.index(kind) for _, kind in held]
    loss = lambda t: -np.log(softmax(logits / t)[np.arange(len(logits)), truth] + 1e-12).mean()
    temperature = min((0.2, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    return Classifier(vocabulary, weights[:-1].astype(np.float32), weights[-1].astype(np.float32), temperature, classes)


def sample_paragraphs(documents: DataFrame) -> list[str]:
    """Lines of the beginnings of a bounded number of documents."""
    rows = documents.select(F.xxhash64("text").alias("key"), "text").where(F.col("text").isNotNull())
    keys = [r.key for r in rows.select("key").distinct().orderBy("key").limit(SAMPLE_DOCUMENTS).collect()]
    if not keys:
        return []
    texts = rows.where(F.col("key").isin(keys)).groupBy("key").agg(F.first(F.substring("text", 1, SAMPLE_CHARS)).alias("text")).collect()
    lines = [line for r in sorted(texts) for line in r.text.split("\n") if words_of(line)]
    return [line for line in lines if not MAY_BE_NOTICE.search(line)]


def _scan(model):
    kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in FOUND.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = model.value
        for batch in small_batches(batches, 512):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), strict=True):
                rows += [(doc_id, *found) for found in classifier.scan(text.decode("utf-8", "replace"))]
            columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _summarise(model):
    names = ["doc_id", "n_predicted", "n_confirmed", "families", "probability", "similarity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = model.value
        for batch in small_batches(batches, 512):
            found = [list(classifier.scan(text.decode("utf-8", "replace"))) for text in texts_of(batch.column("text"))]
            sure = [[f for f in fs if f[5]] for fs in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(f) for f in found], pa.int64()), pa.array([len(f) for f in sure], pa.int64()),
                 pa.array([",".join(sorted({x[2] for x in f})) for f in sure], pa.string()),
                 pa.array([max((x[3] for x in f), default=None) for f in found], pa.float64()),
                 pa.array([max((x[4] for x in f), default=None) for f in found], pa.float64())], names=names,
            )

    return run


def license_paragraphs(documents: DataFrame, model: Classifier) -> DataFrame:
    """Paragraphs of a licence family: place, family, probability, similarity with its notice, and whether confirmed."""
    rows = documents.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return rows.mapInArrow(_scan(documents.sparkSession.sparkContext.broadcast(model)), FOUND)


def license_report(documents: DataFrame, model: Classifier) -> DataFrame:
    """Per document: predicted and confirmed paragraphs, confirmed families, largest probability and similarity."""
    rows = documents.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    schema = "doc_id long, n_predicted long, n_confirmed long, families string, probability double, similarity double"
    return rows.mapInArrow(_summarise(documents.sparkSession.sparkContext.broadcast(model)), schema)
