"""License scans: a trained paragraph classifier with template confirmation.

Paragraphs (``n_paragraphs``) are the non-empty lines of a text; words are
lower-cased runs of letters and digits.  Judged are the lines of at most
``2 * STEPS[-1]`` words and, so that wrapped notices and those inside long lines
are found, the blocks of lines between blank lines: windows of ``2 * step``
words every ``step`` words, for each of ``STEPS``, which cover every word and
hold any run of ``step`` words whole (the longest template has fewer than the last
step).  Below, both are called passages.  A softmax regression over hashed word 1-, 2- and 3-grams
tells licence families from ``unknown``.  It is trained here, by proximal
gradient descent with an L1 penalty (so most weights are exactly 0), on
variants of the templates (words dropped, a few corpus words or those that fill
a window around them) and, for
``unknown``, on a bounded sample of corpus passages (``sample`` of them, in
hash order, drawn from all words of all paragraphs) plus shuffled template
words.  A temperature and the least probability for a family are then fitted on
held-out variants, so that ``unknown`` is calibrated.  A predicted family is
confirmed by comparison with the templates: the share of a template's word
pairs that the passage holds, in order, must reach ``confirm`` and no other
family's template may reach more, so that a word which sets two notices apart
decides between them; unconfirmed passages are ``unknown``.  A notice
is a confirmed line, or a run of overlapping confirmed windows of one family that
touches no confirmed line of that family.

Scoring streams over every text in whole; words are hashed a batch at a time.
A passage with fewer template pairs than any template needs to be confirmed
would be ``unknown`` whatever the classifier says, and is not classified.

Nulls and empty texts have no paragraphs and no licence.  Repeated rows each
get their result; empty tables give empty results (the model is then trained
without corpus paragraphs).  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import alphanumeric, ngram_hashes, ragged, text_chunks

BITS = 16
SAMPLE = 2000
CONFIRM = 0.8
STEPS = (8, 16, 32)
UNKNOWN = "unknown"

#: Notices of the licence families (fixed values).
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-ND-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "EUPL": (
        "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL",
        "SPDX-License-Identifier: EUPL-1.2",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "Public-Domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
        "SPDX-License-Identifier: Unlicense",
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages",
        "Released under the zlib License.",
        "SPDX-License-Identifier: Zlib",
    ),
}


def _word_hashes(texts: list[str]) -> list[np.ndarray]:
    out = []
    for w in text_chunks(pa.array(texts, pa.string()), alphanumeric(), lower=True):
        h = w.hashes()
        out += [h[w.offsets[t]:w.offsets[t + 1]] for t in range(w.n)]
    return out


def _features(h: np.ndarray) -> np.ndarray:
    """Distinct feature numbers of a paragraph's word 1-, 2- and 3-grams."""
    mask = np.uint64((1 << BITS) - 1)
    grams = [(ngram_hashes(h, n) ^ np.uint64(n)) & mask for n in (1, 2, 3)]
    return np.unique(np.concatenate(grams)).astype(np.int64)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class LicenseModel:
    classes: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.5
    pairs: list[tuple[int, np.ndarray]] = field(default_factory=list)

    def logits(self, feature_lists: list[np.ndarray]) -> np.ndarray:
        out = np.tile(self.bias, (len(feature_lists), 1))
        for i, f in enumerate(feature_lists):
            out[i] += self.weights[f].sum(axis=0) / np.sqrt(max(1, len(f)))
        return out

    def similarities(self, h: np.ndarray) -> np.ndarray:
        """By class: the greatest share of a template's word pairs (ordered) that the passage holds."""
        own, out = ngram_hashes(h, 2), np.zeros(len(self.classes))
        if len(self.pairs):
            each = np.concatenate([p for _, p in self.pairs])
            owner = np.repeat(np.arange(len(self.pairs)), [len(p) for _, p in self.pairs])
            share = np.bincount(owner, weights=np.isin(each, own)) / np.bincount(owner)
            np.maximum.at(out, [k for k, _ in self.pairs], share)
        return out

    def confirms(self, klass: int, h: np.ndarray, confirm: float) -> bool:
        """Whether a template of the class is found, and none of another class better."""
        found = self.similarities(h)
        return bool(found[klass] >= confirm and found[klass] >= found.max())

    def fewest(self, confirm: float) -> int:
        """The least number of different template pairs with which a passage can be confirmed."""
        def needed(p):
            share = np.cumsum(np.sort(np.unique(p, return_counts=True)[1])[::-1]) / len(p)
            return int((share < confirm - 1e-9).sum()) + 1
        return min((needed(p) for _, p in self.pairs if len(p)), default=1)


def _training_rows(corpus: list[str], probe: LicenseModel, rng) -> tuple[list[str], np.ndarray]:
    classes = probe.classes
    filler = [w for p in corpus for w in p.split()] or ["text"]

    def some(words, n):
        return [words[i] for i in rng.integers(0, len(words), n)]

    def around(words, most):
        before, after = (some(filler, rng.integers(0, most + 1)) for _ in range(2))
        return " ".join([*before, *words, *after])

    def variant(words, klass):
        """The notice without a word or two, if it is still its family's."""
        kept = [w for w in words if rng.random() > 0.05]
        found = probe.similarities(_word_hashes([" ".join(kept)])[0])
        return kept if found[klass] > np.delete(found, klass).max() else words

    texts, labels = [], []
    for family, notices in TEMPLATES.items():
        for notice in notices:
            words, size = notice.split(), len(_word_hashes([notice])[0])
            for _ in range(40):
                texts.append(around(variant(words, classes.index(family)), 4))
                labels.append(classes.index(family))
            room = 2 * next(s for s in STEPS if s >= size) - size
            for _ in range(40):  # as they stand in a window
                kept = variant(words, classes.index(family))
                more = some(filler, rng.integers(0, room + 1))
                at = int(rng.integers(0, len(more) + 1))
                texts.append(" ".join([*more[:at], *kept, *more[at:]]))
                labels.append(classes.index(family))
    every = [w for ts in TEMPLATES.values() for t in ts for w in t.split()]
    for _ in range(400):  # licence words without a licence
        texts.append(around(some(every, rng.integers(1, 6)), 12))
        labels.append(0)
    texts += corpus
    labels += [0] * len(corpus)
    return texts, np.array(labels)


def train(corpus: list[str], seed: int = 7, rounds: int = 120, l1: float = 2e-5) -> LicenseModel:
    """Fit on template variants and corpus passages (those that hold half of a template's pairs are left out)."""
    rng = np.random.default_rng(seed)
    classes = [UNKNOWN, *sorted(TEMPLATES)]
    pairs = [(classes.index(f), ngram_hashes(h, 2)) for f in sorted(TEMPLATES) for h in _word_hashes(list(TEMPLATES[f]))]
    probe = LicenseModel(classes, np.zeros((0, 0)), np.zeros(0), pairs=pairs)
    plain = [p for p, h in zip(corpus, _word_hashes(corpus), strict=True)
             if probe.similarities(h).max() < 0.5]
    texts, labels = _training_rows(plain, probe, rng)
    lists = [_features(h) for h in _word_hashes(texts)]
    held = rng.random(len(texts)) < 0.2
    size, k = 1 << BITS, len(classes)
    row = np.repeat(np.arange(len(lists)), [len(f) for f in lists])
    col = np.concatenate(lists)
    used, place = np.unique(col, return_inverse=True)
    value = 1 / np.sqrt(np.array([max(1, len(f)) for f in lists]))[row]
    fit_rows = ~held[row]
    r, c, v = row[fit_rows], place[fit_rows], value[fit_rows]
    n_fit = int((~held).sum())
    want = np.eye(k)[labels]
    w, b = np.zeros((len(used), k)), np.log(np.bincount(labels[~held], minlength=k) + 1.0)
    b -= b.max()

    def scores(rr, cc, vv, weights):
        z = np.empty((len(lists), k))
        for j in range(k):
            z[:, j] = np.bincount(rr, weights=vv * weights[cc, j], minlength=len(lists))
        return z

    rate, mom, previous = 8.0, 0.9, np.zeros_like(w)
    for _ in range(rounds):
        ahead = w + mom * (w - previous)
        p = _softmax(scores(r, c, v, ahead) + b)
        err = (p - want) * (~held)[:, None] / n_fit
        grad = np.stack([np.bincount(c, weights=v * err[r, j], minlength=len(used)) for j in range(k)], axis=1)
        previous = w
        w = ahead - rate * grad
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1, 0.0)
        b -= 0.5 * err.sum(axis=0)
    z = scores(row, place, value, w)[held] + b
    truth = labels[held]
    temperature = min(np.geomspace(0.1, 4, 40), key=lambda t: -np.log(
        _softmax(z / t)[np.arange(len(truth)), truth] + 1e-300).mean() + 0.0)
    p = _softmax(z / temperature)
    best = p[:, 1:].max(axis=1)
    wrong = np.sort(best[(p.argmax(axis=1) != truth) & (p.argmax(axis=1) > 0)])
    least = float(max(0.5, min(0.99, wrong[-1] if len(wrong) else 0.5)))
    full = np.zeros((size, k))
    full[used] = w
    return LicenseModel(classes, full, b, float(temperature), least, pairs)


def sample_passages(docs: DataFrame, sample: int = SAMPLE) -> list[str]:
    """At most ``sample`` different passages of ``2 * STEPS[-1]`` words, in hash order, from all paragraphs' words.

    Only training reads this sample; scoring reads every paragraph whole.  The
    passages are counted first, and only about twice the sample, picked by
    their hash, is sorted and sent on, whatever the input's size.
    """
    size = 2 * STEPS[-1]
    passages = docs.select(F.explode(F.split("text", "\n")).alias("line")).selectExpr(
        "filter(split(line, '[ \\\\t\\\\x0B\\\\f\\\\r]+'), w -> w <> '') as words").where("size(words) > 0").selectExpr(
        f"explode(transform(sequence(0, (size(words) - 1) div {size}), i -> slice(words, cast(i * {size} + 1 as int), {size}))) as words")
    n = passages.count()
    share = min(1.0, 2 * sample / max(1, n))
    picked = passages.select(F.array_join("words", " ").alias("p")).withColumn("h", F.xxhash64("p")).where(
        F.pmod("h", F.lit(1 << 40)) < int(share * (1 << 40))).groupBy("h", "p").count()
    return sorted(r["p"] for r in picked.orderBy("h", "p").limit(sample).select("p").collect())


def _runs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each run of equal ids, and the place after it."""
    lo = np.flatnonzero(np.diff(ids, prepend=-1))
    return lo, np.append(lo[1:], len(ids)) if len(lo) else lo


def _passages(line: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, place after the last, whether a line) of all passages, from each word's line and block."""
    lo, hi = _runs(line)
    short = hi - lo <= 2 * STEPS[-1]
    parts = [(lo[short], hi[short])]
    lo, hi = _runs(block)
    for step in STEPS:
        n, at = ragged(np.zeros(len(lo), np.int64), np.maximum(1, -(-(hi - lo) // step) - 1))
        first = lo[n] + at * step
        parts.append((first, np.minimum(first + 2 * step, hi[n])))
    return (*map(np.concatenate, zip(*parts, strict=True)), np.arange(sum(len(x) for x, _ in parts)) < len(parts[0][0]))


def _notices(spans: list[tuple[int, int, bool]]) -> int:
    """Notices of one family in the passages (first, after, whether a line)."""
    lines = [(lo, hi) for lo, hi, is_line in spans if is_line]
    runs: list[list[int]] = []
    for lo, hi, _ in sorted(x for x in spans if not x[2]):
        if runs and lo < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi)
        else:
            runs.append([lo, hi])
    return len(lines) + sum(not any(lo < b and a < hi for a, b in lines) for lo, hi in runs)


def _scan(batches, shared, confirm):
    model: LicenseModel = shared.value
    known, fewest = np.unique(np.concatenate([p for _, p in model.pairs])), model.fewest(confirm)
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        n = len(texts)
        lines = pc.split_pattern(texts, "\n")
        flat, owner = lines.flatten(), pc.list_parent_indices(lines).to_numpy()
        # non-empty lines, whatever their characters
        filled = pc.greater(pc.binary_length(pc.utf8_trim_whitespace(flat)), 0).to_numpy(zero_copy_only=False)
        paragraphs = np.bincount(owner[filled], minlength=n)
        block_of = np.cumsum(~filled | (np.diff(owner, prepend=-1) > 0))
        first_line = np.searchsorted(owner, np.arange(n))
        families: list[set] = [set() for _ in range(n)]
        notices, top = np.zeros(n, np.int64), np.zeros(n)
        for w in text_chunks(texts, alphanumeric(), lower=True):
            h = w.hashes()
            if len(h) < 2:
                continue
            text = np.repeat(np.arange(w.n), w.counts())
            line = first_line[w.first] + np.searchsorted(np.flatnonzero(w.data == 10), w.start) + text
            lo, hi, is_line = _passages(line, block_of[line])
            pairs = np.concatenate([[0], np.cumsum(np.isin(ngram_hashes(h, 2), known))])
            todo = np.flatnonzero(pairs[hi - 1] - pairs[lo] >= fewest)
            if not len(todo):
                continue
            lo, hi, is_line = lo[todo], hi[todo], is_line[todo]
            p = _softmax(model.logits([_features(h[a:b]) for a, b in zip(lo, hi, strict=True)]) / model.temperature)
            best = p[:, 1:].argmax(axis=1) + 1
            found: dict[tuple[int, int], list] = {}
            for i in np.flatnonzero((p.argmax(axis=1) > 0) & (p.max(axis=1) >= model.least)):
                k = int(best[i])
                if model.confirms(k, h[lo[i]:hi[i]], confirm):
                    t = w.first + int(text[lo[i]])
                    families[t].add(model.classes[k])
                    top[t] = max(top[t], p[i, k])
                    found.setdefault((t, k), []).append((int(lo[i]), int(hi[i]), bool(is_line[i])))
            for (t, _), spans in found.items():
                notices[t] += _notices(spans)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(paragraphs, pa.int64()), pa.array(notices, pa.int64()),
            pa.array([",".join(sorted(s)) if s else UNKNOWN for s in families], pa.string()),
            pa.array(np.round(top, 6), pa.float64())],
            names=["doc_id", "n_paragraphs", "n_notices", "families", "probability"])


def scan_licenses(docs: DataFrame, sample: int = SAMPLE, confirm: float = CONFIRM) -> DataFrame:
    """(doc_id, n_paragraphs, n_notices, families, probability) per row of ``docs(doc_id, text)``.

    ``families``: confirmed licence families in order, comma-joined, or ``unknown``.
    """
    model = train(sample_passages(docs, sample))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda it: _scan(it, shared, confirm),
        "doc_id long, n_paragraphs long, n_notices long, families string, probability double")
