"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

The classifier is a multinomial logistic regression on sparse word n-grams (one to three
words). Its families learn from the templates and from variants of them (other names and
years, left-out words, neighbouring prose); its unknown class learns from a bounded sample of
paragraphs of the corpus that resemble no template, and from templates in random word order,
so that single words do not decide. Probabilities are calibrated on rows kept out of the
training: a temperature by likelihood, and for each family the least probability that at most
``FALSE_SHARE`` of the unknown rows exceed. A prediction is confirmed if enough of the word
triples of one template of that family stand in the paragraph.

A feature holds at least one anchor, a word of the templates that is not a function word, so a
text without anchors has no features and is unknown throughout; such texts are passed quickly.

Paragraphs are lines; one of more than SPAN words is looked at in overlapping spans. A notice
may also be wrapped: successive lines that are not blank form a block, whose overlapping spans
are looked at as well. What a template confirms there, with words of more than one line, counts
for the line of its first word, unless a line of the span gave that family by itself.

A span may name several licences. Each family that a template confirms by triples with a word
of its own, not one of a family found before it, is predicted from the span without the words
of the others.

Defined results. Null and empty texts have no paragraphs and no licence; blank lines are no
paragraphs. Words are runs of letters, digits and bytes beyond ASCII. Rows are independent.
Without any sample paragraphs the unknown class learns from the shuffled templates alone. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork.llm.common import smaller_batches, table, utf8

SAMPLE_ROWS = 3000
SAMPLE_PARAGRAPHS = 8
VARIANTS = 40
SPAN = 80
FALSE_SHARE = 0.001
LEAST_PROBABILITY = 0.5
CONFIRMED = 0.6  # share of a template's word triples
UNKNOWN = "unknown"
FOUND = (
    "doc_id long, n_paragraphs long, n_predicted long, n_confirmed long, families string, score double,"
    " paragraphs array<struct<paragraph:int,family:string,probability:double,likeness:double,confirmed:boolean>>"
)

# Short notices by which the licences are usually named.
TEMPLATES = {
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the terms of the GNU AGPL version 3 or any later version.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License.",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
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
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is distributed under the terms of the GNU LGPL version 2.1 or later.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
        "Licensed under the MPL 2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "This document is confidential and proprietary; no part may be reproduced without prior written permission.",
    ],
}
FUNCTION_WORDS = frozenset(
    b"a an and any are as at by can can be extent following for form forms from has in is it law may met no not of on"
    b" or part possible prior related subject that the this to under use used with without work you your".split()
)

PLAIN = bytearray(range(256))
for _c in range(128):
    if not chr(_c).isalnum() and _c != 10:
        PLAIN[_c] = 32
PLAIN = bytes(PLAIN).translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))


def plain_words(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


TEMPLATE_WORDS = {f: [plain_words(t.encode()) for t in ts] for f, ts in TEMPLATES.items()}
ANCHORS = frozenset(
    w for ts in TEMPLATE_WORDS.values() for t in ts for w in t if w not in FUNCTION_WORDS and not w.isdigit()
)


def grams(words: list[bytes]) -> set[bytes]:
    """One to three successive words with an anchor among them."""
    out = set()
    for i, w in enumerate(words):
        if w in ANCHORS:
            for n in (1, 2, 3):
                for start in range(max(0, i - n + 1), min(i, len(words) - n) + 1):
                    out.add(b" ".join(words[start : start + n]))
    return out


def triples(words: list[bytes]) -> set[tuple]:
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))}


TEMPLATE_TRIPLES = {f: [triples(t) for t in ts] for f, ts in TEMPLATE_WORDS.items()}
ALL_TRIPLES = frozenset(t for ts in TEMPLATE_TRIPLES.values() for own in ts for t in own)
HIDDEN = b"."  # stands for a word that another family explains; never a word itself


def likeness(words: list[bytes], family: str) -> float:
    """The largest share of a template's word triples that the paragraph holds."""
    own = triples(words)
    return max(len(own & t) / len(t) for t in TEMPLATE_TRIPLES[family])


def matches(words: list[bytes], at_least: float = CONFIRMED) -> dict[str, list[tuple[float, set[int], int]]]:
    """For each family its templates as like as that: likeness, places of their words, size."""
    places: dict[tuple, list[int]] = {}
    for i in range(max(1, len(words) - 2)):
        triple = tuple(words[i : i + 3])
        if triple in ALL_TRIPLES:
            places.setdefault(triple, []).append(i)
    out: dict[str, list[tuple[float, set[int], int]]] = {}
    if not places:
        return out
    for family, templates in TEMPLATE_TRIPLES.items():
        for own, template in zip(templates, TEMPLATE_WORDS[family]):
            held = own & places.keys()
            if len(held) / len(own) >= at_least:
                at = {i + k for t in held for i in places[t] for k in range(len(t))}
                out.setdefault(family, []).append((len(held) / len(own), at, len(template)))
    return out


def tightest(places: set[int], size: int) -> set[int]:
    """The places in the first window of about ``size`` words that holds the most of them."""
    width = size + size // 8
    start = max(sorted(places), key=lambda s: sum(s <= x < s + width for x in places))
    return {x for x in places if start <= x < start + width}


def own_likeness(words: list[bytes], family: str, taken: set[int]) -> float:
    """Likeness by triples that hold a word outside ``taken``."""
    own = {
        tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))
        if not taken.issuperset(range(i, min(i + 3, len(words))))
    }
    return max(len(own & t) / len(t) for t in TEMPLATE_TRIPLES[family])


@dataclass
class Classifier:
    families: list[str]  # the last one is the unknown class
    weights: dict[bytes, np.ndarray]
    bias: np.ndarray
    temperature: float
    least: np.ndarray  # for each family, the probability that a prediction needs

    def probabilities(self, words: list[bytes]) -> np.ndarray | None:
        found = [self.weights[g] for g in sorted(grams(words)) if g in self.weights]
        if not found:
            return None
        z = (np.sum(found, 0) / np.sqrt(len(found)) + self.bias) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()

    def predict(self, words: list[bytes]) -> tuple[str, float]:
        p = self.probabilities(words)
        if p is None:
            return UNKNOWN, 1.0
        best = int(p.argmax())
        if self.families[best] != UNKNOWN and p[best] >= self.least[best]:
            return self.families[best], float(p[best])
        return UNKNOWN, float(p[-1])

    def families_of(self, words: list[bytes]) -> dict[str, tuple[float, float, int]]:
        """Likeness, probability and first place of every family predicted; one may be unconfirmed."""
        family, p = self.predict(words)
        out = {} if family == UNKNOWN else {family: (likeness(words, family), p, 0)}
        near = matches(words)
        cover = {f: set().union(*(tightest(at, size) for _, at, size in ts)) for f, ts in near.items()}
        if family in near:
            out[family] = (*out[family][:2], min(cover[family]))
        if len(near) > (family in near):
            rank, taken, seen = self.probabilities(words), set(cover.get(family, ())), {family}
            if rank is None:
                return out
            rest = sorted((f for f in near if f != family), key=lambda f: (-rank[self.families.index(f)], f))
            for f in rest:
                seen.add(f)
                alike = own_likeness(words, f, taken)
                if alike < CONFIRMED:
                    continue
                others = taken.union(*(cover[x] for x in rest if x not in seen)) - cover[f]
                chosen, p = self.predict([HIDDEN if i in others else w for i, w in enumerate(words)])
                if chosen == f:
                    out[f] = (alike, p, min(cover[f] - taken))
                    taken |= cover[f]
        return out


def variants(rng: np.random.Generator, prose: list[list[bytes]]) -> tuple[list[list[bytes]], list[str]]:
    """Training rows of the families and the shuffled templates of the unknown class."""
    rows, labels = [], []
    for family, templates in TEMPLATE_WORDS.items():
        for template in templates:
            for i in range(VARIANTS):
                words = list(template)
                if i % 4 == 1 and len(words) > 5:
                    del words[int(rng.integers(len(words)))]
                if i % 4 == 2:
                    words = [b"copyright", str(1990 + i).encode(), b"holder%d" % i, *words]
                if i % 4 == 3 and prose:
                    other = prose[int(rng.integers(len(prose)))][:12]
                    words = other + words if rng.random() < 0.5 else words + other
                rows.append(words)
                labels.append(family)
                mixed = [words[k] for k in rng.permutation(len(words))]
                if not any(likeness(mixed, f) >= CONFIRMED for f in TEMPLATES):
                    rows.append(mixed)
                    labels.append(UNKNOWN)
                    rows.append(mixed[: max(1, len(mixed) // 2)])
                    labels.append(UNKNOWN)
    return rows, labels


def fit(prose: list[list[bytes]], seed: int = 11) -> Classifier:
    """Trains on four fifths of the rows, calibrates on the rest."""
    rng = np.random.default_rng(seed)
    rows, labels = variants(rng, prose)
    rows += prose
    labels += [UNKNOWN] * len(prose)
    families = [*sorted(TEMPLATES), UNKNOWN]
    place = {f: i for i, f in enumerate(families)}
    y = np.array([place[x] for x in labels])
    found = [grams(r) for r in rows]
    train_row = rng.random(len(rows)) < 0.8
    names = sorted({g for f, t in zip(found, train_row) if t for g in f})
    column = {g: i for i, g in enumerate(names)}
    known = [[column[g] for g in sorted(f) if g in column] for f in found]
    r = np.repeat(np.arange(len(known)), [len(x) for x in known])
    c = np.array([i for x in known for i in x], np.int64)
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(r, minlength=len(found))))
    k = len(families)
    w, b = np.zeros((len(names), k)), np.zeros(k)
    speed_w, speed_b = np.full(w.shape, 1e-6), np.full(k, 1e-6)
    target = np.eye(k)[y]
    weight = train_row / np.bincount(y, minlength=k)[y]
    weight /= weight.sum()

    def scores() -> np.ndarray:
        z = np.zeros((len(found), k))
        np.add.at(z, r, w[c] * scale[r, None])
        return z + b

    def soft(z: np.ndarray) -> np.ndarray:
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    for _ in range(150):
        error = (soft(scores()) - target) * weight[:, None]
        gw = np.zeros_like(w)
        np.add.at(gw, c, error[r] * scale[r, None])
        gw += 1e-6 * w
        gb = error.sum(0)
        speed_w += gw**2
        speed_b += gb**2
        w -= 0.5 * gw / np.sqrt(speed_w)
        b -= 0.5 * gb / np.sqrt(speed_b)
    z, held = scores(), ~train_row
    grid = np.geomspace(0.25, 4, 17)
    loss = [-np.log(soft(z[held] / t)[np.arange(held.sum()), y[held]] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = soft(z / temperature)[held & (y == place[UNKNOWN])]
    least = np.full(k, LEAST_PROBABILITY)
    if len(p):
        least = np.maximum(least, np.minimum(0.95, np.quantile(p, 1 - FALSE_SHARE, axis=0)))
    return Classifier(families, {g: w[i] for g, i in column.items()}, b, temperature, least)


def spans(words: list[bytes]) -> Iterator[list[bytes]]:
    if len(words) <= SPAN:
        yield words
        return
    for at in range(0, len(words) - SPAN // 2, SPAN // 2):
        yield words[at : at + SPAN]


def scan(text: bytes, model: Classifier) -> tuple[int, list[dict]]:
    """Number of paragraphs and the ones with a predicted licence."""
    data = text.translate(PLAIN)
    lines = data.split(b"\n")
    if ANCHORS.isdisjoint(data.split()):
        return sum(1 for x in lines if x and not x.isspace()), []
    number, out = 0, []
    block: list[list[bytes]] = []
    for line in [*lines, b""]:
        words = line.split()
        if words:
            block.append(words)
        elif block:
            out += scan_block(block, number, model)
            number += len(block)
            block = []
    return number, out


def scan_block(block: list[list[bytes]], first: int, model: Classifier) -> list[dict]:
    """Predictions of successive lines, each by itself and then across their ends."""
    out: dict[tuple[int, str], tuple[float, float]] = {}
    for number, words in enumerate(block, first):
        if ANCHORS.isdisjoint(words):
            continue
        for part in spans(words):
            if ANCHORS.isdisjoint(part):
                continue
            for family, (alike, p, _) in model.families_of(part).items():
                out[number, family] = max(out.get((number, family), (0.0, 0.0)), (alike, p))
    if len(block) > 1:
        joined = [w for words in block for w in words]
        line_of = [n for n, words in enumerate(block, first) for _ in words]
        wrapped: dict[tuple[int, str], tuple[float, float]] = {}
        alone = {key for key, (alike, _) in out.items() if alike >= CONFIRMED}
        at = 0
        for part in spans(joined):
            here = line_of[at : at + len(part)]
            if here[0] != here[-1] and not ANCHORS.isdisjoint(part):
                for family, (alike, p, begin) in model.families_of(part).items():
                    if alike >= CONFIRMED and not any((n, family) in alone for n in range(here[0], here[-1] + 1)):
                        key = here[begin], family
                        wrapped[key] = max(wrapped.get(key, (0.0, 0.0)), (alike, p))
            at += SPAN // 2
        for key, found in wrapped.items():
            out[key] = max(out.get(key, (0.0, 0.0)), found)
    return [
        {"paragraph": n, "family": family, "probability": p, "likeness": alike, "confirmed": alike >= CONFIRMED}
        for (n, family), (alike, p) in sorted(out.items())
    ]


def free_lines(lines: list[list[bytes]]) -> list[list[bytes]]:
    """The lines without words that resemble a template, also one wrapped over several lines.

    An empty entry stands for a blank line.
    """
    out, block = [], []
    for words in [*lines, []]:
        if words:
            block.append(words)
            continue
        joined = [w for x in block for w in x]
        line_of = [n for n, x in enumerate(block) for _ in x]
        taken, at = set(), 0
        for part in spans(joined):
            for ts in matches(part, CONFIRMED / 2).values():
                taken |= {line_of[at + i] for _, places, _ in ts for i in places}
            at += SPAN // 2
        out += [x[:SPAN] for n, x in enumerate(block) if n not in taken]
        block = []
    return out


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """The unknown class learns from paragraphs of ``sample_rows`` rows, by hash order.

    The sample's ids are broadcast; of each text the first SAMPLE_PARAGRAPHS paragraphs that
    hold an anchor and resemble no template are taken, or its first two.
    """
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller_batches(batches, 64):
            out = []
            for text in batch.column(0).to_pylist():
                lines = [plain_words(x) for x in text.split(b"\n")]
                free = [w for w in free_lines(lines) if not ANCHORS.isdisjoint(w)]
                plain = [w[:SPAN] for w in lines if w and ANCHORS.isdisjoint(w)][:2]
                out += [b" ".join(w) for w in free[:SAMPLE_PARAGRAPHS] + plain]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["words"])

    rows = (
        docs.join(F.broadcast(chosen), "doc_id").select(utf8("text").alias("text"))
        .mapInArrow(pick, "words binary").orderBy("words").collect()
    )
    return fit([bytes(r["words"]).split() for r in rows])


def licences(docs: DataFrame, model: Classifier) -> DataFrame:
    """One row per document with its licensed paragraphs; nothing is shuffled.

    ``families`` are the confirmed ones, sorted, with commas between; ``score`` is the
    largest probability of a confirmed prediction.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller_batches(batches, 256):
            found = [scan(t, shared.value) for t in batch.column(1).to_pylist()]
            sure = [[x for x in own if x["confirmed"]] for _, own in found]
            kind = pa.list_(pa.struct([
                ("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()),
                ("likeness", pa.float64()), ("confirmed", pa.bool_()),
            ]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([len(own) for _, own in found], pa.int64()),
                    pa.array([len(own) for own in sure], pa.int64()),
                    pa.array([",".join(sorted({x["family"] for x in own})) for own in sure], pa.string()),
                    pa.array([max([x["probability"] for x in own], default=0.0) for own in sure], pa.float64()),
                    pa.array([own for _, own in found], kind),
                ],
                ["doc_id", "n_paragraphs", "n_predicted", "n_confirmed", "families", "score", "paragraphs"],
            )

    return docs.select(F.col("doc_id").cast("long"), utf8("text").alias("text")).mapInArrow(look, FOUND)


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences(docs, train(docs)).drop("paragraphs")
