"""Licence families that differ by a word, the training sample, and a brute-force scan."""

import re

import numpy as np
import pytest

from itemrank.llm import license_scan as ls

NOTICES = {
    "LGPL": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\n"
            "License as published by the Free Software Foundation; either\nversion 2.1 of the License",
    "AGPL": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public "
            "License as published\nby the Free Software Foundation, either version 3",
    "GPL": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public "
           "License as published\nby the Free Software Foundation, either version 3",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, "
           "provided that the above",
    "CC-BY-SA": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "EUPL": "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by\nthe European Commission - subsequent versions "
            "of the EUPL (the \"Licence\")",
    "MIT": "// SPDX-License-Identifier: MIT",
    "Apache-2.0": "# SPDX-License-Identifier: Apache-2.0",
}


def _docs(spark):
    rng = np.random.default_rng(0)

    def words(n):
        return " ".join(f"w{rng.integers(400)}" for _ in range(n))

    rows = [(i, f"{words(12)}\n\n{t}\n\n{words(25)}") for i, t in enumerate(NOTICES.values())]
    rows += [(100 + i, "\n".join(words(int(rng.integers(1, 40))) for _ in range(4))) for i in range(150)]
    rows += [(300, None), (301, ""), (None, NOTICES["GPL"]), (302, rows[0][1]), (302, rows[0][1])]
    return rows, spark.createDataFrame([(*r, "x", 1.0, 5) for r in rows],
                                       "doc_id long, text string, families string, probability double, n_notices int").repartition(3)


def plain_scan(model, text):
    """Lines, blocks and windows one by one."""
    def words(t):
        return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))]

    lines = (text or "").split("\n")
    spans, at, block, blocks = [], 0, [], []
    for line in [*lines, ""]:
        n = len(words(line))
        if not line.strip():
            blocks.append(block)
            block = []
        else:
            if 0 < n <= 2 * ls.STEPS[-1]:
                spans.append((at, at + n, True))
            block += range(at, at + n)
        at += n
    for b in blocks:
        for step in ls.STEPS:
            for i in range(max(1, -(-len(b) // step) - 1) if b else 0):
                spans.append((b[0] + i * step, min(b[0] + i * step + 2 * step, b[-1] + 1), False))
    every = words(text or "")
    found = {}
    for lo, hi, is_line in spans:
        if hi - lo < 2:
            continue
        [h] = ls._word_hashes([" ".join(w.decode() for w in every[lo:hi])])
        p = ls._softmax(model.logits([ls._features(h)]) / model.temperature)[0]
        k = int(p.argmax())
        if k and p[k] >= model.least:
            pairs = set(zip(every[lo:hi], every[lo + 1:hi]))
            share = {}
            for family, notices in ls.TEMPLATES.items():
                for notice in notices:
                    own = list(zip(words(notice), words(notice)[1:]))
                    share[family] = max(share.get(family, 0), sum(x in pairs for x in own) / len(own))
            if share[model.classes[k]] >= ls.CONFIRM and share[model.classes[k]] >= max(share.values()):
                found.setdefault(model.classes[k], []).append((lo, hi, is_line))
    notices = sum(ls._notices(s) for s in found.values())
    return sum(bool(x.strip()) for x in lines), notices, ",".join(sorted(found)) or "unknown"


@pytest.fixture(scope="module")
def scanned(spark):
    rows, docs = _docs(spark)
    return rows, docs, ls.scan_licenses(docs).collect()


def test_families_that_differ_by_a_word(scanned):
    _, _, got = scanned
    by_id = {r.doc_id: r.families for r in got}
    assert {i: by_id[i] for i in range(len(NOTICES))} == dict(enumerate(NOTICES))


def test_scan_equals_brute_force(scanned):
    rows, docs, got = scanned
    model = ls.train(ls.sample_passages(docs))
    want = sorted(((d is None, d or 0), *plain_scan(model, t)) for d, t in rows)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_paragraphs, r.n_notices, r.families) for r in got) == want


def test_sample_is_bounded_and_from_all_words(spark):
    texts = [(i, " ".join(f"{i}x{j}" for j in range(200)) + f"\nsecond line {i}") for i in range(500)]
    docs = spark.createDataFrame(texts * 2, "doc_id long, text string").repartition(6)
    got = ls.sample_passages(docs, 300)
    assert 200 < len(got) <= 300 and len(set(got)) == len(got)
    assert any(p.startswith("second") for p in got) and any("x199" in p for p in got) and any("x64 " in p for p in got)
    assert all(len(p.split()) <= 64 for p in got)
    assert ls.sample_passages(docs.repartition(2), 300) == got
    assert len(ls.sample_passages(docs.where("doc_id = 1"))) == 5
    assert ls.sample_passages(spark.createDataFrame([], "doc_id long, text string")) == []
