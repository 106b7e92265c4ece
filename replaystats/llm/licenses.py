"""Licence scan: a paragraph classifier, confirmed by comparison with templates.

A multinomial logistic regression over word 1- and 2-grams sorts lines and groups of lines into a licence
family, "unknown" (speaks of a licence, of no family here) or "none". It is trained in numpy on
variants of the families' notices, on made-up licences, and on at most ``max_plain`` lines of the
corpus (a documented bound), and its confidence is calibrated by a temperature fitted on variants
held back. A family is reported only if its probability reaches ``min_probability`` and the words
agree with one of the family's templates; what reads like a licence and is not confirmed is
"unknown".

A paragraph is a run of lines that are not blank. Its groups are its lines, each alone, and all runs of its lines
that have at most ``GROUP_WORDS`` words, so that a notice is seen whole however it is wrapped and
whatever prose stands around it. Of the confirmed groups that overlap, the one that agrees best counts, then
the shortest, then the first. Other groups that read like a licence give "unknown", the
shortest first; if they touch a confirmed group of the family that the classifier sees in them, they
are the rest of its notice and extend its range.

The scan is a map over all rows, without a shuffle, and judges every line of every text; what is
shipped is the model, whose size is fixed by its templates.

Defined results: null and empty texts have no row; repeated rows give repeated rows; a line of any
length is judged as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replaystats.llm.text import BLANKS, pick, small_batches

# Usual notices of each family.
TEMPLATES = {
    "mit": (
        "released under the mit license",
        "licensed under the mit license",
        "this software is distributed under the terms of the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    ),
    "apache-2.0": (
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
        "released under the apache 2.0 license",
    ),
    "gpl-3.0": (
        "this work is licensed under the gnu general public license version 3",
        "released under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        "licensed under the gnu gpl v3",
    ),
    "gpl-2.0": (
        "licensed under the gnu general public license version 2",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
        "licensed under the gnu gpl v2",
    ),
    "lgpl": (
        "licensed under the gnu lesser general public license version 3",
        "licensed under the gnu lesser general public license version 2.1",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
    ),
    "agpl-3.0": (
        "licensed under the gnu affero general public license version 3",
        "released under the gnu affero general public license",
    ),
    "bsd": (
        "licensed under the bsd license",
        "released under the 3 clause bsd license",
        "use of this source code is governed by a bsd style license",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    ),
    "mpl-2.0": (
        "licensed under the mozilla public license version 2.0",
        "this source code form is subject to the terms of the mozilla public license v 2.0",
    ),
    "cc-by": (
        "licensed under cc by 4.0",
        "this work is licensed under a creative commons attribution 4.0 international license",
    ),
    "cc-by-sa": (
        "licensed under cc by sa 4.0",
        "this work is licensed under a creative commons attribution sharealike 4.0 international license",
    ),
    "cc-by-nc": (
        "licensed under cc by nc 4.0",
        "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    ),
    "cc0": (
        "released under cc0 1.0",
        "to the extent possible under law the author has waived all copyright and related rights to this work",
        "dedicated to the public domain under cc0",
    ),
    "isc": (
        "released under the isc license",
        "licensed under the isc license",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "unlicense": (
        "released under the unlicense",
        "this is free and unencumbered software released into the public domain",
    ),
}
# The identifiers of the families in a short notice.
IDENTIFIERS = {
    "mit": "mit",
    "apache-2.0": "apache 2.0",
    "gpl-3.0": "gpl 3.0 or later",
    "gpl-2.0": "gpl 2.0 only",
    "lgpl": "lgpl 2.1 or later",
    "agpl-3.0": "agpl 3.0 or later",
    "bsd": "bsd 3 clause",
    "mpl-2.0": "mpl 2.0",
    "cc-by": "cc by 4.0",
    "cc-by-sa": "cc by sa 4.0",
    "cc-by-nc": "cc by nc 4.0",
    "cc0": "cc0 1.0",
    "isc": "isc",
    "unlicense": "unlicense",
}
TEMPLATES = {family: (*notices, f"spdx license identifier {IDENTIFIERS[family]}") for family, notices in TEMPLATES.items()}
UNKNOWN, NONE = "unknown", "none"
UNKNOWN_FRAMES = (
    "licensed under the {} license",
    "released under the {} licence version {}",
    "this work is licensed under the {} public license",
    "distributed under the terms of the {} license agreement",
    "use of this software is subject to the {} license",
    "spdx license identifier {} {}",
    "lizenziert unter der {} lizenz",
    "veröffentlicht unter den bedingungen der {} lizenz",
    "distribué sous licence {}",
    "sous les termes de la licence {} {}",
    "publicado bajo la licencia {}",
    "licenciado bajo los términos de la licencia {}",
)
CLASSES = (NONE, UNKNOWN, *TEMPLATES)
GROUP_WORDS = 120  # twice the longest template and more
WORD = regex.compile(r"[\p{L}\p{N}]+(?:\.\p{N}+)*")


def words_in(line: str) -> list[str]:
    return WORD.findall(line.lower())


@dataclass
class Classifier:
    features: dict[str, int]  # word or "word word" to a row of weights
    words: set[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: dict[str, tuple[frozenset, ...]]

    def rows(self, words: list[str]) -> list[int]:
        grams = dict.fromkeys([*words, *map(" ".join, zip(words, words[1:], strict=False))])
        return [i for g in grams if (i := self.features.get(g)) is not None]

    def judge(self, words: list[str]) -> tuple[str, float, float]:
        """Family, calibrated probability and agreement with its nearest template."""
        rows = self.rows(words)
        scores = self.bias + self.weights[rows].sum(0) / np.sqrt(len(rows)) if rows else self.bias
        best = int(scores.argmax())
        if best == 0:
            return NONE, 0.0, 0.0  # the most frequent case; its numbers are not asked for
        scores = scores / self.temperature
        chance = np.exp(scores - scores.max())
        chance /= chance.sum()
        family = CLASSES[best]
        return family, float(chance[best]), self.agreement(words, family)

    def agreement(self, words: list[str], family: str) -> float:
        """Share of a template's word pairs that the line has, at best."""
        pairs = _pairs(words)
        return max((len(pairs & t) / len(t) for t in self.templates.get(family, ())), default=0.0)

    def _logits(self, rows: list[list[int]]) -> np.ndarray:
        out = np.tile(self.bias, (len(rows), 1))
        for i, row in enumerate(rows):
            if row:
                out[i] += self.weights[row].sum(0) / np.sqrt(len(row))
        return out


def _pairs(words: list[str]) -> frozenset:
    return frozenset(zip(["", *words], [*words, ""], strict=True)) if words else frozenset()


def _examples(plain: list[str], rng: np.random.Generator) -> list[tuple[list[str], int]]:
    """(words, class): the templates as they are, with words lost, set in other words; made-up licences; plain lines."""
    fill = [w for line in plain for w in words_in(line)] or ["lorem", "ipsum", "dolor", "sit", "amet"]
    pick_words = lambda n: [fill[i] for i in rng.integers(0, len(fill), n)]
    out = []
    for label, family in enumerate(CLASSES):
        for template in TEMPLATES.get(family, ()):
            words = words_in(template)
            for variant in range(24):
                kept = [w for w in words if variant == 0 or rng.random() > 0.04]
                ends = rng.integers(0, 9, 2) if variant > 4 else (0, 0)
                out.append((pick_words(ends[0]) + kept + pick_words(ends[1]), label))
    for frame in UNKNOWN_FRAMES * 60:
        out.append((words_in(frame.format(" ".join(pick_words(rng.integers(1, 4))), rng.integers(1, 9))), 1))
    known = {_pairs(words_in(t)) for family in TEMPLATES.values() for t in family}
    for line in plain:
        words = words_in(line)
        pairs = _pairs(words)
        if words and max(len(pairs & t) / len(t) for t in known) < 0.5:
            out.append((words, 0))
    for _ in range(200):
        out.append((pick_words(rng.integers(1, 30)), 0))
    return out


def fit(plain: list[str], seed: int = 11, epochs: int = 40) -> Classifier:
    """Train on variants of the templates and plain lines; the order of ``plain`` does not matter."""
    rng = np.random.default_rng(seed)
    examples = _examples(sorted(plain), rng)
    order = rng.permutation(len(examples))
    back = {int(i) for i in order[: len(order) // 5]}
    features: dict[str, int] = {}
    model = Classifier(features, set(), np.zeros(0), np.zeros(len(CLASSES)), 1.0, {})
    licence_words = {w for family in TEMPLATES.values() for t in family for w in words_in(t)}
    licence_words |= {w for f in UNKNOWN_FRAMES for w in words_in(f.format("", ""))}
    for words, _ in examples:
        known = [w if w in licence_words else None for w in words]
        for w, after in zip(known, [*known[1:], None], strict=True):
            if w:
                features.setdefault(w, len(features))
            if w and after:
                features.setdefault(f"{w} {after}", len(features))
    model.words = licence_words
    model.weights = np.zeros((len(features), len(CLASSES)))
    model.templates = {f: tuple(_pairs(words_in(t)) for t in ts) for f, ts in TEMPLATES.items()}
    rows = [model.rows(words) for words, _ in examples]
    labels = np.array([label for _, label in examples])
    size = np.array([max(1, len(r)) for r in rows])
    learn = np.array([i for i in range(len(rows)) if i not in back])
    sums_w, sums_b = np.zeros_like(model.weights), np.zeros(len(CLASSES))
    for epoch in range(epochs):
        for low in range(0, len(learn), 128):
            part = learn[rng.permutation(len(learn))[:128]] if epoch else learn[low : low + 128]
            chance = model._logits([rows[i] for i in part])
            chance = np.exp(chance - chance.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            chance[np.arange(len(part)), labels[part]] -= 1
            chance /= len(part)
            grad = 1e-5 * model.weights
            at = np.concatenate([rows[i] for i in part]).astype(int)
            owner = np.repeat(np.arange(len(part)), [len(rows[i]) for i in part])
            np.add.at(grad, at, chance[owner] / np.sqrt(size[part][owner])[:, None])
            sums_w += grad * grad
            slope = chance.sum(0)
            sums_b += slope * slope
            model.weights -= 0.5 * grad / (np.sqrt(sums_w) + 1e-8)
            model.bias -= 0.5 * slope / (np.sqrt(sums_b) + 1e-8)
    held = sorted(back)
    scores, truth = model._logits([rows[i] for i in held]), labels[held]

    def loss(t: float) -> float:
        z = scores / t
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(held)), truth]).mean())

    model.temperature = min(np.geomspace(0.25, 4, 33), key=loss)
    return model


def train(docs: DataFrame, text_col: str = "text", max_plain: int = 1500, max_chars: int = 2000) -> Classifier:
    """Fit with at most ``max_plain`` distinct lines of the corpus, those of the lowest hash, as plain text,
    of lines of at most ``max_chars`` characters, so that what reaches the driver is bounded. (Fewer if
    copies of few lines make up almost the whole corpus: the bound of the hash counts all lines.)"""
    lines = pick(docs, text_col).toDF("text").select(F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.filter((F.btrim("line", F.lit(BLANKS)) != "") & (F.length("line") <= max_chars))
    lines = lines.select(F.xxhash64("line").alias("h"), "line")
    # Tasks send only lines below a bound of the hash that leaves about four times the wanted number.
    share = min(1.0, 4 * max_plain / max(1, lines.count()))
    bound = int(share * (1 << 64)) - (1 << 63) - 1
    sample = lines.filter(F.col("h") <= bound).distinct().orderBy("h", "line").limit(max_plain).select("line")
    return fit([r["line"] for r in sample.collect()])


def paragraph(model: Classifier, lines: list[list[str]], min_probability: float, min_agreement: float) -> list[tuple]:
    """(first, last, family, probability, agreement) of the notices in the lines of a paragraph, given as words."""
    sure, maybe = [], []
    place = [i for i, words in enumerate(lines) if words]  # lines without a word belong to no group
    solid = [lines[i] for i in place]
    rows = [model.rows(words) for words in solid]
    # joints: the feature that a line makes with the line before it
    joints = [[]] + [[i] if (i := model.features.get(f"{a[-1]} {b[0]}")) is not None else [] for a, b in zip(solid, solid[1:], strict=False)]
    for first in range(len(solid)):
        held: set[int] = set()
        total, length, best = np.zeros(len(CLASSES)), 0, int(model.bias.argmax())
        for last in range(first, len(solid)):
            length += len(solid[last])
            if last > first and length > GROUP_WORDS:
                break
            # Only what the line adds; a group costs no more for the lines before it.
            fresh = set(rows[last] if last == first else [*rows[last], *joints[last]]) - held
            if fresh:
                held |= fresh
                total += model.weights[list(fresh)].sum(0)
                best = int((model.bias + total / np.sqrt(len(held))).argmax())
            if best == 0:
                continue
            family, chance, agreement = model.judge([w for words in solid[first : last + 1] for w in words])
            if family == NONE:
                continue
            found = (place[first], place[last], family, chance, agreement)
            good = family != UNKNOWN and chance >= min_probability and agreement >= min_agreement
            (sure if good else maybe).append(found)
    free = [True] * len(lines)
    out: list[tuple] = []
    for found in sorted(sure, key=lambda x: (-x[4], x[1] - x[0], x[0])):
        _take(found, free, out)
    rest: list[tuple] = []
    for found in sorted(maybe, key=lambda x: (x[1] - x[0], x[0])):
        _take(found, free, rest)
    for found in sorted(rest):
        touched = [i for i, x in enumerate(out) if x[2] == found[2] != UNKNOWN and (x[1] + 1 == found[0] or found[1] + 1 == x[0])]
        if touched:
            x = out[touched[0]]
            out[touched[0]] = (min(x[0], found[0]), max(x[1], found[1]), *x[2:])
        else:
            out.append((*found[:2], UNKNOWN, *found[3:]))
    return sorted(out)


def _take(found: tuple, free: list[bool], out: list[tuple]) -> None:
    """Add ``found`` if all its lines are free."""
    first, last = found[:2]
    if all(free[first : last + 1]):
        free[first : last + 1] = [False] * (last + 1 - first)
        out.append(found)


def scan(
    docs: DataFrame,
    model: Classifier,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_probability: float = 0.5,
    min_agreement: float = 0.7,
) -> DataFrame:
    """(id, line, last_line, family, probability, agreement) per notice; lines count from 0."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kinds = {"line": pa.int64(), "last_line": pa.int64(), "family": pa.string(), "probability": pa.float64(), "agreement": pa.float64()}
    schema = pa.schema(list(kinds.items()))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = sent.value
        for batch in source:
            ids, rows = [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                lines = (text or "").split("\n")
                for solid, numbers in groupby(range(len(lines)), lambda i: bool(lines[i].strip())):  # noqa: B023
                    if not solid:
                        continue
                    part = list(numbers)
                    found = paragraph(judge, [words_in(lines[i]) for i in part], min_probability, min_agreement)
                    ids += [at] * len(found)
                    rows += [(part[0] + first, part[0] + last, *what) for first, last, *what in found]
            columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), *(pa.array(c, f.type) for c, f in zip(columns, schema, strict=True))],
                names=[id_col, *schema.names],
            )

    kind = docs.schema.fields[docs.columns.index(id_col)].dataType.simpleString()
    return pick(docs, id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, line long, last_line long, family string, probability double, agreement double"
    )
