"""License scans: paragraphs classified by n-grams, confirmed by the licences' own words.

A softmax regression on the word n-grams of known notices tells licence families, an unknown
licence and no licence apart.  It learns from varied notices and a bounded sample of the corpus;
a temperature fitted on examples it has not seen calibrates its probabilities, and what it is
not sure of is unknown.  A family counts only if a paragraph holds most of one of its notices.

A paragraph is a line, or several that follow each other without a blank line between them, since
notices are usually wrapped.  The classifier sees words only, so it learns nothing else from
wrapped notices than from others: what a window of lines has besides a notice is text around it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import SPACE_CHARS, few, pieces, whole

NONE, UNKNOWN = "none", "unknown"

# Notices by licence family, as their texts or their usual users word them.
NOTICES = {
    "agpl": [
        "GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "This software is released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Dedicated to the public domain under CC0 1.0.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "GNU Lesser General Public License, version 2.1.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
# Notices without a family: "{}" stands for words of the corpus.
OTHERS = [
    "Licensed under the {} License.", "This work is licensed under the {} Public License, version 1.",
    "Released under the {} License, version 2.", "All rights reserved by {}.", "SPDX-License-Identifier: {}",
    "You may use this {} only under the terms of its license.",
]

# Paragraphs of the corpus to learn from, characters of each, and variants of each notice.
SAMPLE = 1000
SAMPLE_LENGTH = 1000
VARIANTS = 30
# Probability below which a family is unknown, and share of a notice's n-grams that confirms it.
CONFIDENCE = 0.5
CONFIRMED = 0.7

_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def grams(words: list[str]) -> set[str]:
    """N-grams of one to three words."""
    return {" ".join(words[at:at + n]) for n in (1, 2, 3) for at in range(len(words) - n + 1)}


def split_words(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


@dataclass
class Model:
    """A trained classifier: n-gram numbers, weights [gram, class], bias, and temperature."""

    classes: list[str]
    numbers: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    notices: list[tuple[str, frozenset[str]]]

    def known(self, words: list[str]) -> list[int]:
        """Numbers of the model's n-grams in a paragraph, in order; of others it knows nothing."""
        get, found = self.numbers.get, set()
        single = [get(word) for word in words]
        for at, number in enumerate(single):
            if number is not None:
                found.add(number)
                if at and single[at - 1] is not None:
                    pair = get(f"{words[at - 1]} {words[at]}")
                    if pair is not None:
                        found.add(pair)
                        if at > 1 and single[at - 2] is not None:
                            three = get(f"{words[at - 2]} {words[at - 1]} {words[at]}")
                            if three is not None:
                                found.add(three)
        return sorted(found)

    def probabilities(self, known: list[int]) -> np.ndarray:
        logits = (self.weights[known].sum(axis=0) + self.bias) / self.temperature
        powers = np.exp(logits - logits.max())
        return powers / powers.sum()

    def judge(self, paragraph: str) -> tuple[str, float, float]:
        """Family, `unknown` or `none`, its probability, and the share of a notice's n-grams."""
        words = split_words(paragraph)
        known = self.known(words)
        if not known:
            return NONE, 1.0, 0.0
        chances = self.probabilities(known)
        best = int(chances.argmax())
        family, chance = self.classes[best], float(chances[best])
        if family in (NONE, UNKNOWN):
            return family, chance, 0.0
        own = grams(words)
        share = max(len(notice & own) / len(notice) for of, notice in self.notices if of == family)
        if chance < CONFIDENCE or share < CONFIRMED:
            family = UNKNOWN
        return family, chance, share

    def may_hold(self, known: list[int]) -> bool:
        """Whether a text with these n-grams may hold enough of any notice."""
        have = set(known)
        return any(
            len(have) >= CONFIRMED * len(notice) and len(notice & have) >= CONFIRMED * len(notice)
            for notice in self.numbered
        )

    @cached_property
    def numbered(self) -> list[frozenset[int]]:
        """The n-grams of each notice by number."""
        return [frozenset(self.numbers[gram] for gram in notice) for _, notice in self.notices]

    def scan(self, paragraphs: list[str]) -> tuple[int, list[tuple[int, str, float, float]]]:
        """The number of lines with a word and what they hold, `none` aside: (line, family,
        probability, share); a notice over several lines is told of the first.

        Of a notice over several lines, those between its first and last line have no more words
        than the longest notice.  Of windows that meet, the one with the largest share counts, and
        the shorter of equal ones; windows of two families may share a line.  A window whose family
        one of its lines has adds nothing, and lines of a window that counts are not unknown.
        """
        found, at, block = [], 0, []
        for line in [*paragraphs, ""]:
            if line.strip(SPACE_CHARS):
                block.append(line)
            elif block:
                found += self._block(block, at)
                at, block = at + len(block), []
        return at, found

    def _block(self, lines: list[str], start: int) -> list[tuple[int, str, float, float]]:
        single = [self.judge(line) for line in lines]
        windows = self._windows(lines, single) if len(lines) > 1 else []
        covered = {at for first, last, *_ in windows for at in range(first, last + 1)}
        found = [
            (at, *verdict) for at, verdict in enumerate(single)
            if verdict[0] != NONE and not (verdict[0] == UNKNOWN and at in covered)
        ]
        found += [(first, *verdict) for first, _, *verdict in windows]
        return [(start + at, *verdict) for at, *verdict in sorted(found)]

    def _windows(self, lines: list[str], single: list) -> list[tuple[int, int, str, float, float]]:
        """(first line, last line, family, probability, share) of notices over several lines.

        Lines of marks alone belong to what is around them and count for nothing, so a window has
        as many lines as the longest notice has words at most.
        """
        split = [(at, split_words(line)) for at, line in enumerate(lines)]
        split = [(at, words) for at, words in split if words]
        places, words = [at for at, _ in split], [some for _, some in split]
        if not self.may_hold(self.known([word for some in words for word in some])):
            return []
        longest = max(len(split_words(notice)) for some in NOTICES.values() for notice in some)
        held = []
        for first in range(len(words)):
            last, inner = first + 1, 0
            while last < len(words) and inner <= longest:
                inner += len(words[last])
                last += 1
            if not self.may_hold(self.known([word for some in words[first:last] for word in some])):
                continue
            for end in range(first + 1, last):
                verdict = self.judge("\n".join(lines[places[at]] for at in range(first, end + 1)))
                own = {single[at][0] for at in places[first:end + 1]}
                if verdict[0] not in (NONE, UNKNOWN) and verdict[0] not in own:
                    held.append((places[first], places[end], *verdict))
        kept, taken = [], {}
        for window in sorted(held, key=lambda w: (-w[4], w[1] - w[0], w[0])):
            lines_of = range(window[0], window[1] + 1)
            shared = Counter(other for at in lines_of for other in taken.get(at, ()))
            if all(count <= (0 if kept[other][2] == window[2] else 1) for other, count in shared.items()):
                for at in lines_of:
                    taken.setdefault(at, []).append(len(kept))
                kept.append(window)
        return kept


def examples(sample: list[str], seed: int, variants: int = VARIANTS) -> list[tuple[list[str], str]]:
    """Labelled paragraphs: notices with words left out or text around them, and the sample."""
    draw = np.random.default_rng(seed)
    ordinary = [words for words in map(split_words, sample) if words] or [["text"]]

    def around() -> list[str]:
        words = ordinary[draw.integers(len(ordinary))]
        return words[: draw.integers(0, 30)]

    made = []
    for family, notices in NOTICES.items():
        for notice in notices:
            words = split_words(notice)
            for variant in range(variants):
                kept = [word for word in words if variant == 0 or draw.random() > 0.05]
                made.append(([*around(), *kept, *around()] if variant % 3 else kept, family))
    for notice in OTHERS:
        for variant in range(variants):
            name = " ".join(around()[:3]) or "sample"
            made.append(([*(around() if variant % 2 else []), *split_words(notice.format(name))], UNKNOWN))
    return made + [(words, NONE) for words in ordinary]


def train(sample: list[str], seed: int = 1, steps: int = 200) -> Model:
    """Softmax regression by gradient steps; every fifth example sets the temperature."""
    notices = [
        (family, frozenset(grams(split_words(notice)))) for family, some in NOTICES.items() for notice in some
    ]
    others = set().union(*(grams(split_words(notice.replace("{}", " "))) for notice in OTHERS))
    numbers = {gram: at for at, gram in enumerate(sorted(others.union(*(n for _, n in notices))))}
    classes = [*NOTICES, UNKNOWN, NONE]
    model = Model(
        classes, numbers, np.zeros((len(numbers), len(classes))), np.zeros(len(classes)), 1.0, notices
    )
    made = examples(sample, seed)
    features = np.zeros((len(made), len(numbers)))
    labels = np.zeros((len(made), len(classes)))
    for at, (words, label) in enumerate(made):
        features[at, model.known(words)] = 1
        labels[at, classes.index(label)] = 1
    held = np.arange(len(made)) % 5 == 0
    x, y = features[~held], labels[~held]
    rate, mean_w, mean_b = 1.0, 0.0, 0.0
    for _ in range(steps):
        logits = x @ model.weights + model.bias
        powers = np.exp(logits - logits.max(axis=1, keepdims=True))
        slack = (powers / powers.sum(axis=1, keepdims=True) - y) / len(x)
        mean_w = 0.9 * mean_w + x.T @ slack + 1e-4 * model.weights
        mean_b = 0.9 * mean_b + slack.sum(axis=0)
        model.weights = model.weights - rate * mean_w
        model.bias = model.bias - rate * mean_b
    logits, truth = features[held] @ model.weights + model.bias, labels[held].argmax(axis=1)

    def loss(temperature: float) -> float:
        scaled = logits / temperature
        top = scaled.max(axis=1)
        total = top + np.log(np.exp(scaled - top[:, None]).sum(axis=1))
        return float((total - scaled[np.arange(len(truth)), truth]).mean())

    model.temperature = min((2.0 ** (k / 4) for k in range(-12, 13)), key=loss)
    return model


def corpus_sample(docs: DataFrame, text: str, sample: int = SAMPLE) -> list[str]:
    """At most `sample` paragraphs that show no notice, those whose hashes are smallest in some
    texts drawn by hash, and at most SAMPLE_LENGTH characters of each: a bound of what the driver
    gathers."""
    texts = docs.select(whole(F.col(text)).alias("text"))
    texts = texts.where(few("text", docs.count(), sample))
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).where(
        F.btrim("line", F.lit(SPACE_CHARS)) != ""
    )
    words = F.lower(F.col("line"))
    shows = words.contains("licens") | words.contains("rights") | words.contains("permission")
    drawn = lines.where(~shows).select(F.substring("line", 1, SAMPLE_LENGTH).alias("line"))
    return [row.line for row in drawn.orderBy(F.xxhash64("line"), "line").limit(sample).collect()]


def license_scan(
    docs: DataFrame, id: str = "doc_id", text: str = "text", model: Model | None = None,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_paragraphs and licences, an array of (paragraph,
    family, probability, share).

    Paragraphs are lines with a word, numbered from 0; every one of every text is judged, and so
    are lines that follow each other (see `Model.scan`).  Null, empty and blank texts have none.
    Bytes that are no UTF-8 count as the replacement character.  Repeated rows each give a row;
    other columns are not read.  Of families that are as likely the first by name counts.  A long
    text costs in proportion to its lines.  Without a model one is trained first, which runs a job.
    """
    model = model or train(corpus_sample(docs, text, sample))
    found_type = pa.list_(pa.struct([
        ("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64()),
        ("share", pa.float64()),
    ]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 22):
            counts, found = [], []
            for item in batch.column("text"):
                count, judged = model.scan(item.as_py().decode(errors="replace").split("\n"))
                counts.append(count)
                found.append([
                    {"paragraph": at, "family": family, "probability": round(p, 4), "share": round(share, 4)}
                    for at, family, p, share in judged
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, found_type)],
                ["doc_id", "n_paragraphs", "licences"],
            )

    rows = docs.select(F.col(id).alias("doc_id"), whole(F.col(text)).cast("binary").alias("text"))
    kind = "array<struct<paragraph:long,family:string,probability:double,share:double>>"
    shape = rows.select(
        "doc_id", F.lit(0).cast("long").alias("n_paragraphs"), F.lit(None).cast(kind).alias("licences")
    )
    return rows.mapInArrow(run, shape.schema)
