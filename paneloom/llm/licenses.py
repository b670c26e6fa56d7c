"""Licence families of paragraphs: a trained classifier, confirmed by comparison with templates.

A paragraph is a line with a word, or lines next to each other over which a notice is wrapped. Its
features are the word 1- and 2-grams it shares with the licence texts known here; a multinomial logistic regression over them, with a class for
"no licence" and a temperature fitted on rows held back, gives the family and its probability.
The prediction is confirmed if enough of one of that family's templates stands in the paragraph.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.llm import scan
from paneloom.store import materialise

UNKNOWN = "unknown"

#: Notices by which licence families are announced.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is distributed under the terms of the Apache 2.0 license.",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Released under the GPL version 2 or later.",
    ),
    "agpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "This software is licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL version 3 or later.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Released under the LGPL version 3 or later.",
    ),
    "mit": (
        "Released under the MIT License.",
        "This software is licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released into the public domain under the Unlicense.",
    ),
    "proprietary": ("All rights reserved.", "Copyright. All rights reserved. No part of this publication may be reproduced without permission."),
}


#: Marks by which comments start and end a line; white space stands for them where lines are joined.
COMMENT = r"(?m)^[ \t]*(?:/\*+!?|\*+/|\*+|//+!?|#+|<!--|--+|;+|%+|\"+|'+|(?i:dnl|rem|c)[ \t])[ \t]*|[ \t]*(?:\*+/|-->|\*+)[ \t\r]*$|^[ \t]*[-=*#/~_+]{3,}[ \t\r]*$"


class Paragraphs:
    """The lines with a word of some texts, lower-cased, with their words' hashes; or runs of such lines."""

    def __init__(self, texts: pa.Array, runs: bool = False) -> None:
        self.raw, offsets = scan.buffer(texts)
        letters = scan.LOWER[self.raw]
        # Marks around a word are no part of it; a hyphen or a point within one is.
        marks = np.isin(np.arange(256), np.frombuffer(b".,;:!?\"'()[]{}", np.uint8))
        spaced = scan.IS_SPACE[letters]
        edge = np.append(spaced[1:], True) | np.concatenate([[True], spaced[:-1]])
        letters = np.where(marks[letters] & edge, np.uint8(32), letters)
        words = scan.Words(letters, offsets)
        feeds = np.flatnonzero(self.raw == 10)
        starts = np.concatenate([[0], feeds[:-1] + 1]).astype(np.int64)
        first = np.searchsorted(words.starts, starts)
        last = np.searchsorted(words.starts, feeds)
        some = np.flatnonzero(last > first)
        text = np.searchsorted(offsets, starts, side="right") - 1
        end = some
        if runs and len(some):
            new = np.append(True, (np.diff(some) > 1) | (np.diff(text[some]) > 0))
            some, end = some[new], some[np.append(new[1:], True)]
        self.number = some - np.searchsorted(text, text[some])
        self.text, self.starts, self.ends, self.lines = text[some], starts[some], feeds[end], end - some + 1
        self.counts = last[end] - first[some]
        self.of_word = np.repeat(np.arange(len(self.counts)), self.counts)
        self.hashes = words.hashes
        pair = scan.mix(words.hashes[:-1] * scan.ODD + words.hashes[1:])
        inside = self.of_word[:-1] == self.of_word[1:]
        self.grams = np.concatenate([self.hashes, pair[inside]])
        self.of_gram = np.concatenate([self.of_word, self.of_word[:-1][inside]])

    def __len__(self) -> int:
        return len(self.counts)


@dataclass(frozen=True)
class LicenceModel:
    families: tuple[str, ...]  # the last one is UNKNOWN
    vocabulary: np.ndarray  # sorted hashes of n-grams
    weights: np.ndarray  # (n-grams + the two features of length) x families
    temperature: float
    templates: tuple[tuple[int, np.ndarray], ...]  # family, sorted n-gram hashes


def _features(paragraphs: Paragraphs, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (paragraph, n-gram) hits, and the share of a paragraph's words outside the vocabulary."""
    at = np.minimum(np.searchsorted(vocabulary, paragraphs.grams), len(vocabulary) - 1)
    hit = vocabulary[at] == paragraphs.grams
    words = len(paragraphs.hashes)
    known = np.bincount(paragraphs.of_word[hit[:words]], minlength=len(paragraphs))
    pairs = np.unique(paragraphs.of_gram[hit] * len(vocabulary) + at[hit])
    return pairs // len(vocabulary), pairs % len(vocabulary), 1 - known / np.maximum(paragraphs.counts, 1)


def _logits(paragraphs: Paragraphs, model: LicenceModel) -> np.ndarray:
    row, column, outside = _features(paragraphs, model.vocabulary)
    out = outside[:, None] * model.weights[-2] + model.weights[-1]
    for j in range(out.shape[1]):
        out[:, j] += np.bincount(row, weights=model.weights[column, j], minlength=len(out))
    return out / model.temperature


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_licences(
    docs: DataFrame, text: str = "text", order: str = "doc_id", background: int = 6000, longest: int = 2000, copies: int = 60, seed: int = 7, rounds: int = 400
) -> LicenceModel:
    """Train on perturbed templates against ordinary paragraphs.

    The ordinary paragraphs are at most ``background`` lines of up to ``longest`` characters, chosen by a hash of ``order`` and line,
    without those that hold half of a template; the two bound what reaches the driver. With null or no texts the
    templates' own words alone stand for them. Every fifth row is held back to fit the temperature.
    """
    texts = docs.select(F.col(order).alias("of"), F.explode(F.split(F.col(text).cast("string"), "\n")).alias("line"))
    texts = texts.where((F.length(F.trim("line")) > 0) & (F.char_length("line") <= longest))
    rows = texts.count()
    # About four times the sample goes on to be sorted, whatever the number of lines.
    draw = F.shiftrightunsigned(F.xxhash64("of", "line"), 1) / F.lit(2.0**63)
    near = texts.withColumn("draw", draw).where(F.col("draw") * rows <= 4 * background + 50).select("draw", "line").distinct()
    picked = near.orderBy("draw", "line").limit(background)
    sample = [r.line for r in materialise(picked.select("line"), "licences").collect()]
    sample.sort()  # the fit does not depend on how rows arrive
    families = (*sorted(TEMPLATES), UNKNOWN)
    rng = np.random.default_rng(seed)
    sources = [(families.index(f), t) for f in sorted(TEMPLATES) for t in TEMPLATES[f]]
    known = Paragraphs(pa.array([t for _, t in sources]))
    templates = tuple((f, np.unique(known.grams[known.of_gram == i])) for i, (f, _) in enumerate(sources))
    vocabulary = np.unique(known.grams)

    rows, labels = [], []
    ordinary = [w for t in sample for w in t.split()] or [w for _, t in sources for w in t.split()]
    for family, template in sources:
        words = template.split()
        for _ in range(copies):
            kept = [w for w in words if rng.random() > 0.08]
            extra = [ordinary[i] for i in rng.integers(0, len(ordinary), rng.integers(0, 12))]
            cut = int(rng.integers(0, len(extra) + 1))
            rows.append(" ".join([*extra[:cut], *kept, *extra[cut:]]).replace("\n", " "))
            labels.append(family)
    lines = [line for line in sample if line.strip()]
    if lines:
        plain = Paragraphs(pa.array(lines))
        best = np.zeros(len(lines))
        for _, grams in templates:
            _, share = _shares(plain, grams)
            best[plain.text] = np.maximum(best[plain.text], share)
        ordinary_lines = [line for line, b in zip(lines, best, strict=True) if b < 0.5]
        rows += ordinary_lines
        labels += [len(families) - 1] * len(ordinary_lines)
    words = [w for _, t in sources for w in t.split()]
    for _ in range(8 * copies):  # the templates' words in no order announce nothing
        rows.append(" ".join(words[i] for i in rng.integers(0, len(words), rng.integers(1, 10))))
        labels.append(len(families) - 1)

    paragraphs = Paragraphs(pa.array(rows))
    label = np.array(labels)[paragraphs.text]
    row, column, outside = _features(paragraphs, vocabulary)
    # Sparse rows: the places of their n-grams, and two dense columns of length.
    width, kinds, n = len(vocabulary), len(families), len(paragraphs)

    def forward(w: np.ndarray) -> np.ndarray:
        inside = [np.bincount(row, weights=w[column, j], minlength=n) for j in range(kinds)]
        return np.stack(inside, axis=1) + outside[:, None] * w[-2] + w[-1]

    def backward(error: np.ndarray) -> np.ndarray:
        inside = [np.bincount(column, weights=error[row, j], minlength=width) for j in range(kinds)]
        return np.concatenate([np.stack(inside, axis=1), (outside @ error)[None, :], error.sum(0)[None, :]])

    target = np.eye(kinds)[label]
    balance = 1 / np.bincount(label, minlength=kinds).clip(1)[label]
    held = np.arange(n) % 5 == 0
    share = np.where(held, 0.0, balance) / balance[~held].sum()
    weights = np.zeros((width + 2, kinds))
    speed, moment = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):  # Adam on the balanced cross entropy, with a small penalty
        gradient = backward((_softmax(forward(weights)) - target) * share[:, None]) + 1e-5 * weights
        moment = 0.9 * moment + 0.1 * gradient
        speed = 0.999 * speed + 0.001 * gradient**2
        weights -= 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(speed / (1 - 0.999**step)) + 1e-9)
    grid = np.geomspace(0.25, 4, 33)
    logits = forward(weights)[held]
    loss = [-(np.log(_softmax(logits / t)[np.arange(held.sum()), label[held]] + 1e-12) * balance[held]).sum() for t in grid]
    return LicenceModel(families, vocabulary, weights, float(grid[int(np.argmin(loss))]), templates)


def _shares(paragraphs: Paragraphs, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which n-grams of one template stand in each paragraph: their number and their share."""
    at = np.minimum(np.searchsorted(grams, paragraphs.grams), len(grams) - 1)
    hit = grams[at] == paragraphs.grams
    pairs = np.unique(paragraphs.of_gram[hit] * len(grams) + at[hit])
    found = np.bincount(pairs // len(grams), minlength=len(paragraphs))
    return found, found / len(grams)


def scan_licences(
    docs: DataFrame, model: LicenceModel, keep: Sequence[str] = ("doc_id",), text: str = "text", least: float = 0.5, confirm: float = 0.6
) -> DataFrame:
    """(row, paragraph, family, probability, similarity, confirmed, text): the paragraphs with a licence.

    All paragraphs of all whole texts are classified; one comes out if a family other than
    ``unknown`` is the most probable one with ``least`` or more. ``similarity`` is the largest share
    of one of the family's templates found in the paragraph, ``confirmed`` whether it is
    ``confirm`` or more and above that of every other family's templates. Null and empty texts have no paragraph; repeated rows repeat theirs.
    ``paragraph`` counts all lines of the text from 0. A notice wrapped over several lines comes out
    once, at its first line and as one text without the marks of comments, in place of the lines it
    covers, if more of a template stands in them together than in any one of them.
    """
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).cast("string").alias("text"))
    fields = "paragraph int, family string, probability double, similarity double, confirmed boolean, text string"
    schema = T.StructType([source.schema.fields[0], *T._parse_datatype_string(fields).fields])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in scan.slices(batch, 1):
                yield _found(part, model, least, confirm)

    return source.mapInArrow(find, schema)


def _similarities(texts: pa.Array, family: np.ndarray, model: LicenceModel) -> np.ndarray:
    """The largest share of one of its family's templates in each text; every text is one line with a word."""
    out = np.zeros(len(texts))
    if len(texts):
        alone = Paragraphs(texts)
        for of, grams in model.templates:
            out = np.where(family == of, np.maximum(out, _shares(alone, grams)[1]), out)
    return out


def _rivals(texts: pa.Array, family: np.ndarray, model: LicenceModel) -> np.ndarray:
    """The largest share of a template of any other family in each text."""
    others = [_similarities(texts, np.where(family == of, -1, of), model) for of in sorted({of for of, _ in model.templates})]
    return np.max(others, axis=0) if len(texts) else np.zeros(0)


def _windows(lines: list[str], grams: np.ndarray) -> list[tuple[float, int, int]]:
    """(share, first line, last line) of the best windows of several lines for one template, none over another.

    The template must run on over a line's end and have a larger share in the window than in any of
    its lines. The lines between the first and the last one have no more words than the template twice.
    """
    each = Paragraphs(pa.array(lines))
    ends = np.cumsum(each.counts)
    pair = scan.mix(each.hashes[:-1] * scan.ODD + each.hashes[1:])
    place = lambda hashes: np.where(grams[at := np.minimum(np.searchsorted(grams, hashes), len(grams) - 1)] == hashes, at, -1)
    held: list[set[int]] = [set() for _ in lines]
    for line, gram in zip(each.of_gram.tolist(), place(each.grams).tolist(), strict=True):
        if gram >= 0:
            held[line].add(gram)
    over = [-1, *place(pair[ends[:-1] - 1]).tolist()]  # from the line before
    found = []
    for first in range(len(lines)):
        have, inner, runs_on, alone = set(held[first]), 0, False, len(held[first])
        for last in range(first + 1, len(lines) if have else 0):
            if inner > len(grams):
                break
            inner += int(each.counts[last])
            have |= held[last]
            alone = max(alone, len(held[last]))
            if over[last] >= 0:
                have.add(over[last])
                runs_on = True
            if runs_on and len(have) > alone and 2 * len(have) >= len(grams):
                found.append((len(have) / len(grams), first, last))
    out, taken = [], set()
    for share, first, last in sorted(found, key=lambda x: (-x[0], x[2] - x[1], x[1])):
        if taken.isdisjoint(range(first, last + 1)):
            taken.update(range(first, last + 1))
            out.append((share, first, last))
    return out


def _wrapped(texts: pa.Array, model: LicenceModel, least: float) -> list[tuple]:
    """Notices over several lines: (text, line, family, probability, similarity, joined text, number of lines).

    Only runs of lines that hold half of a template are looked at, by windows, so that neither a
    long run nor a second notice in it hides one.
    """
    runs = Paragraphs(pc.replace_substring_regex(texts, COMMENT, " "), runs=True)
    windows = []
    for of, grams in model.templates if len(runs) else ():
        for i in np.flatnonzero((_shares(runs, grams)[1] >= 0.5) & (runs.lines > 1)).tolist():
            lines = runs.raw[runs.starts[i] : runs.ends[i]].tobytes().decode().split("\n")
            for _, first, last in _windows(lines, grams):
                joined = " ".join(" ".join(lines[first : last + 1]).split())
                windows.append((int(runs.text[i]), int(runs.number[i]) + first, of, joined, last - first + 1))
    if not windows:
        return []
    joined = pa.array([w[3] for w in windows], pa.string())
    probability = _softmax(_logits(Paragraphs(joined), model))
    similarity = _similarities(joined, np.array([w[2] for w in windows]), model)
    out, taken = [], set()
    for i in sorted(range(len(windows)), key=lambda i: (-similarity[i], windows[i][4], windows[i][:3])):
        text, line, of, words, span = windows[i]
        cover = {(text, line + k) for k in range(span)}
        if probability[i].argmax() == of and probability[i, of] >= least and taken.isdisjoint(cover):
            taken |= cover
            out.append((text, line, of, float(probability[i, of]), float(similarity[i]), words, span))
    return out


def _found(part: pa.RecordBatch, model: LicenceModel, least: float, confirm: float) -> pa.RecordBatch:
    paragraphs = Paragraphs(part.column(1))
    probability = _softmax(_logits(paragraphs, model)) if len(paragraphs) else np.zeros((0, len(model.families)))
    family = probability.argmax(1)
    top = probability.max(1) if len(paragraphs) else np.zeros(0)
    hit = np.flatnonzero((family < len(model.families) - 1) & (top >= least))
    lines = pa.array([paragraphs.raw[a:b].tobytes() for a, b in zip(paragraphs.starts[hit], paragraphs.ends[hit], strict=True)], pa.binary()).cast(pa.string())
    similarity = _similarities(lines, family[hit], model)
    found = list(zip(paragraphs.text[hit].tolist(), paragraphs.number[hit].tolist(), family[hit].tolist(), top[hit].tolist(), similarity.tolist(), lines.to_pylist(), strict=True))
    wrapped = _wrapped(part.column(1), model, least)
    if wrapped:
        covers = {(text, line): of for text, line, of, *_, span in wrapped for line in range(line, line + span)}
        inside = lambda x: x[:2] in covers and (covers[x[:2]] == x[2] or x[4] < confirm)
        found = sorted([x for x in found if not inside(x)] + [x[:6] for x in wrapped], key=lambda x: x[:3])
    text, number, family, top, similarity, lines = map(list, zip(*found, strict=True)) if found else ([],) * 6
    names = np.array(model.families, dtype=object)
    rival = _rivals(pa.array(lines, pa.string()), np.array(family, np.int64), model)
    confirmed = [own >= confirm and own > other for own, other in zip(similarity, rival.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            part.column(0).take(pa.array(text, pa.int64())), pa.array(number, pa.int32()), pa.array(names[np.array(family, np.int64)], pa.string()),
            pa.array(top, pa.float64()), pa.array(similarity, pa.float64()), pa.array(confirmed, pa.bool_()), pa.array(lines, pa.string()),
        ],
        names=["row", "paragraph", "family", "probability", "similarity", "confirmed", "text"],
    )
