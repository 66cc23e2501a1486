"""Brute-force checks of the text operators on a small table with awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from itemrank.llm import (decontaminate, license_scan, lm_score, minhash_dedup, quality_rules, substring_dedup,
                          textops, token_counts)
from itemrank.llm.fmindex import FMIndex

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id long, text string, lang string, source string, key long, token string, words string"


def make_rows():
    """Copies, near copies, a passage in many documents, nulls, blanks, long and repeated rows."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünder", "naïve", "日本", "x#y", "a|b"]
    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]
    base, passage = words(120), words(45)
    texts = [" ".join(base), " ".join(base), " ".join(words(3)), "", None, " \n\t ", "one", "\n".join(["line a b"] * 30)]
    for i in range(12):  # near copies, further and further away
        own = list(base)
        for _ in range(i):
            own[rng.randrange(len(own))] = f"new{i}{rng.randrange(99)}"
        texts.append(" ".join(own))
    for _ in range(15):  # one passage with its own surroundings each
        texts.append(" ".join(words(rng.randrange(1, 30))) + "\n" + " ".join(passage) + "  " + " ".join(words(rng.randrange(0, 30))))
    texts += [" ".join(words(rng.randrange(30, 200))) for _ in range(20)]
    texts += [" ".join(["same"] * 300), " ".join(words(4000)), "HELLO " + " ".join(base).upper()]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, i, "clash", "clash") for i, t in enumerate(texts)]
    return rows + [rows[0], rows[9], rows[4]]  # repeated rows


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def as_counter(frame):
    return collections.Counter(tuple(r) for r in frame.collect())


def removed(rows, size):
    split = [BLANK.findall(t or "") for _, t, *_ in rows]
    seen = collections.Counter(tuple(w[i:i + size]) for w in split for i in range(len(w) - size + 1))
    out = collections.Counter()
    for (doc, *_), w in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[(doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"shard_words": 50}])
def test_substring_dedup(docs, rows, options):
    assert as_counter(substring_dedup.remove_repeats(docs, 35, **options)) == removed(rows, 35)


def test_substring_dedup_empty(empty):
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_fm_index_against_counting():
    rng = np.random.default_rng(1)
    for _ in range(10):
        sigma, size = int(rng.integers(2, 20)), int(rng.integers(2, 7))
        seqs = [rng.integers(1, sigma, rng.integers(1, 40)) for _ in range(15)]
        weights = rng.integers(1, 3, len(seqs))
        seen = collections.Counter()
        for s, w in zip(seqs, weights, strict=True):
            for i in range(len(s) - size + 1):
                seen[tuple(s[i:i + size])] += int(w)
        for s, got in zip(seqs, FMIndex(seqs, weights).repeated(size), strict=True):
            assert list(got) == [i for i in range(len(s) - size + 1) if seen[tuple(s[i:i + size])] > 1]


def near_classes(rows):
    sets = {}
    for doc, t, *_ in rows:
        w = BLANK.findall((t or "").translate(LOWER))
        sets[doc] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {d: d for d in sets}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sets, {d: find(d) for d in sets}


@pytest.mark.parametrize("block", [(2048, 256), (3, 2)])
def test_near_duplicates(docs, rows, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block[0])
    monkeypatch.setattr(minhash_dedup, "TEXT_BLOCK", block[1])
    sets, comp = near_classes(rows)
    expected = collections.Counter((d, len(sets[d]), comp[d], comp[d] == d) for d, *_ in rows)
    assert as_counter(minhash_dedup.near_duplicates(docs)) == expected


def test_near_duplicates_empty(empty):
    assert minhash_dedup.near_duplicates(empty).count() == 0


def statistics(text):
    w = BLANK.findall(text or "")
    lines = [x for x in (text or "").split("\n") if BLANK.search(x)]
    seen = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    twice = [False] * len(w)
    for i in range(len(w) - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            twice[i:i + 8] = [True] * 8
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), sum(twice))


def test_quality_statistics_and_rules(spark, docs, rows):
    many = [(1000 + i, ("a# b$ c% " if i % 4 == 0 else "good words here ") * 3 + " ".join(f"u{i}x{j}" for j in range(40 + i % 7)),
             "en", None, i, "", "") for i in range(240)]
    both = docs.unionByName(spark.createDataFrame(many, SCHEMA))
    labels = spark.createDataFrame([(1000 + i, 0 if i % 4 == 0 else 1) for i in range(200)] + [(None, 0), (5, None), (99999, 1)],
                                   "doc_id long, quality int")
    got = quality_rules.quality(both, labels).collect()
    expected = collections.Counter((d, *statistics(t)) for d, t, *_ in [*rows, *many])
    assert collections.Counter(tuple(r)[:6] for r in got) == expected
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        if r.doc_id >= 1000:
            assert r.kept == ((r.doc_id - 1000) % 4 != 0), r
        if r.base_failed:
            assert not r.kept


def test_quality_without_labels(spark, docs, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.kept != r.base_failed for r in quality_rules.quality(docs, labels).collect())
    assert quality_rules.quality(empty, labels).count() == 0


def test_decision_list_expression():
    rule = quality_rules.DecisionList(((quality_rules.Condition("symbols_per_word", ">", 0.5),),))
    assert rule.sql() == "case when n_symbols / greatest(n_words, 1) > 0.5D then 0 else cast(null as int) end"


def test_contamination(spark, docs, rows):
    passage = ALNUM.findall(rows[20][1].translate(LOWER))
    items = [(1, " ".join(rows[0][1].split()[10:40])), (2, "one"), (3, None), (4, "--"), (None, "w1 w2"),
             (5, " ".join(passage[:14])), (10, " ".join(passage[:14])), (5, " ".join(passage[:14])), (6, "never seen here at all"),
             (7, " ".join(f"w{i}" for i in range(30))), (8, "same same same")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        for i in range(max(len(w) - 12, 1) if w and item is not None else 0):
            windows[tuple(w[i:i + 13])].add(item)
    expected = collections.Counter()
    for doc, text, *_ in rows:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, found = [False] * len(w), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit[i:i + size] = [True] * size
                    found |= windows[tuple(w[i:i + size])]
        ids = ",".join(sorted(map(str, found)))
        expected[(doc, len(w), sum(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(),
                  sum(hit) > 0 and 20 * sum(hit) >= len(w))] += 1
    assert as_counter(decontaminate.contamination(docs, benchmark)) == expected


def test_contamination_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.contamination(docs, none).collect()} == {0}
    assert decontaminate.contamination(empty, none).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta"), (2, "alpha x x x x x beta"), (3, "beta alpha")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "alpha beta")], "item_id long, text string")
    found = decontaminate.PhraseIndex(docs, items).proximity_matches(slop=3, min_terms=2)
    assert {(r.item_id, r.doc_id) for r in found.collect()} == {(7, 1), (7, 3)}


def test_token_counts_against_tokenizer(docs, rows, empty):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces, byte_pieces = token_counts.read_vocabulary()
    assert byte_pieces
    model = models.Unigram([("<unk>", 0.0), *pieces, *[(f"<0x{i:02X}>", 0.0) for i in range(256)]], 0, True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    expected = collections.Counter((d, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in rows)
    assert as_counter(token_counts.token_counts(docs)) == expected
    assert token_counts.token_counts(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_token_ties_without_byte_pieces(seed):
    from tokenizers import Tokenizer, models, pre_tokenizers

    rng = random.Random(seed)
    pieces = sorted({"".join(rng.choice("ab▁c") for _ in range(rng.randrange(1, 4))) for _ in range(14)} | {"▁", "a"})
    pieces = [(p, float(-rng.randrange(1, 4) * len(p))) for p in pieces if "▁" not in p[1:]]
    tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, False))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counts = token_counts.WordCounts([*pieces, ("<unk>", 0.0)], False)
    for _ in range(200):
        text = "".join(rng.choice("abcdé ") for _ in range(rng.randrange(0, 14)))
        assert counts.of_text(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text


def test_token_counts_of_indented_texts():
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces, byte_pieces = token_counts.read_vocabulary()
    model = models.Unigram([("<unk>", 0.0), *pieces, *[(f"<0x{i:02X}>", 0.0) for i in range(256)]], 0, byte_pieces)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    counts = token_counts.WordCounts(pieces, byte_pieces)
    rng = random.Random(2)
    texts = ["def f():\n    return x", "x        y", "a  b", "  ", " " * 50, "\n    \n", "x  \n  y"]
    texts += ["".join(rng.choice(["x", "return", "é日", "\n", "\t", " ", "  ", " " * 4, " " * 19]) for _ in range(30))
              for _ in range(300)]
    for text in texts:
        assert counts.of_text(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text
    assert [counts.of_text(t) for t in texts[:2]] == [8, 3]


@pytest.mark.parametrize("seed", range(6))
def test_token_ties_with_pieces_over_blanks(seed):
    from tokenizers import Tokenizer, models, pre_tokenizers

    rng = random.Random(seed)
    pieces = sorted({"".join(rng.choice("ab▁c") for _ in range(rng.randrange(1, 5))) for _ in range(14)}
                    - {"▁"} | ({"▁", "a"} if seed % 2 else {"a"}))
    pieces = [(p, float(-rng.randrange(1, 4) * len(p))) for p in pieces]
    tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, False))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    counts = token_counts.WordCounts([*pieces, ("<unk>", 0.0)], False)
    for _ in range(200):
        text = "".join(rng.choice("abcdé  ") for _ in range(rng.randrange(0, 14)))
        assert counts.of_text(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text


def test_lm_scores(docs, rows, empty):
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, *_ in rows}
    split = [(d, BLANK.findall((t or "").translate(LOWER))) for d, t, *_ in rows]
    counts = collections.Counter(x for d, w in split if not held[d] for x in w)
    texts = sum(not held[d] for d, _ in split)
    tokens, different = sum(counts.values()) + texts, len(counts) + 1
    smooth = np.log10(tokens + 0.5 * (different + 1))
    got = sorted(lm_score.score_texts(docs).collect(), key=lambda r: (r.doc_id, r.n_tokens))
    assert len(got) == len(rows)
    for r, (d, w) in zip(got, sorted(split, key=lambda x: (x[0], len(x[1]))), strict=True):
        base = sum(np.log10(counts[x] + 0.5) - smooth for x in w) + np.log10(texts + 0.5) - smooth
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            d, held[d], len(w) + 1, sum(counts[x] > 0 for x in w) + 1, tokens)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    assert lm_score.score_texts(empty).count() == 0


def test_lm_trains_on_every_segment(spark, monkeypatch):
    """More than two million words: the share of the training text must not shrink with the corpus."""
    class Seen(Exception):
        pass

    def train(segments, n_texts, *_):
        found = segments.selectExpr("count(*)", "sum(cast(last as int))", "sum(size(ids))").first()
        raise Seen(*found, n_texts, sum(lm_score.subword_counts(segments).values()))

    monkeypatch.setattr(lm_score, "train", train)
    texts = {i: "the " * (1500 + i % 50) for i in range(2000)}
    big = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    learn = [t.split() for i, t in texts.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    assert sum(map(len, learn)) > 2_000_000
    with pytest.raises(Seen) as seen:
        lm_score.score_texts(big)
    n = sum(map(len, learn))
    assert seen.value.args == (sum(-(-len(w) // 32) for w in learn), len(learn), n, len(learn), n)


def test_licenses(spark, empty):
    texts = ["Some words here.\nReleased under the MIT License.\nMore words.", "Licensed under CC BY-NC 4.0.",
             "This work is licensed under the GNU General Public License, version 3.", "We released the license plate.",
             "", None, "Licensed under the Apache License, Version 2.0.", "under the public license version of work 3"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, families string")
    got = {r.doc_id: (r.n_paragraphs, r.n_notices, r.families) for r in license_scan.scan_licenses(docs).collect()}
    assert got == {0: (3, 1, "MIT"), 1: (1, 1, "CC-BY-NC"), 2: (1, 1, "GPL"), 3: (1, 0, "unknown"), 4: (0, 0, "unknown"),
                   5: (0, 0, "unknown"), 6: (1, 1, "Apache-2.0"), 7: (1, 0, "unknown")}


WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software""",
    "GPL": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""",
    "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:""",
}


def test_wrapped_licenses_and_long_lines(spark):
    rng = random.Random(3)
    def words(n):
        return " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    texts = {i: words(20) + "\n" + words(15) for i in range(100)}
    expected = {i: (2, 0, "unknown") for i in texts}
    for i, (family, notice) in enumerate(WRAPPED.items()):
        texts[200 + i] = f"{words(10)}\n\n{notice}\n\n{words(30)}"
        expected[200 + i] = (2 + notice.count("\n") + 1, 1, family)
        texts[300 + i] = f"{words(3000)} {' '.join(notice.replace('#', '').split())} {words(2000)}"
        expected[300 + i] = (1, 1, family)
        texts[400 + i] = notice.replace("\n", "\n\n")  # blank lines part it
        expected[400 + i] = (notice.count("\n") + 1, 0, "unknown")
    texts[500] = f"{words(700)} Released under the MIT License. {words(800)} Released under the MIT License. {words(90)}"
    expected[500] = (1, 2, "MIT")
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_paragraphs, r.n_notices, r.families) for r in license_scan.scan_licenses(docs).collect()}
    assert got == expected


def test_attention_gradient():
    from itemrank.llm import attention_lm as lm

    shape, rng = lm.Shape(4, 4, 6, 16), np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in lm.start(shape, np.arange(16) + 1.0).items()}
    p["near"], p["w1"], p["w2"] = rng.normal(0, .3, 16), p["w1"] * 20, p["w2"] * 20
    x, y, _ = lm.blocks([rng.integers(2, 18, k) for k in (5, 20, 33)])
    loss, grad = lm.gradient(p, shape, x, y)
    assert loss == pytest.approx(-lm.log_probabilities(p, shape, x, y).sum() / (y >= 0).sum())
    for k in p:
        flat = p[k].reshape(-1)
        i = int(np.argmax(np.abs(grad[k])))
        old = flat[i]
        flat[i] = old + 1e-5
        up = lm.gradient(p, shape, x, y)[0]
        flat[i] = old - 1e-5
        down = lm.gradient(p, shape, x, y)[0]
        flat[i] = old
        assert (up - down) / 2e-5 == pytest.approx(grad[k].reshape(-1)[i], abs=1e-6)


def test_windows_give_a_distribution():
    """Probabilities of all ids after a context add up to one, and a later token does not change an earlier one."""
    from itemrank.llm import attention_lm as lm

    shape = lm.Shape(4, 4, 6, 16)
    p = lm.start(shape, np.arange(16) + 1.0)
    head = [3, 5, 9, 4, 4, 8, 11, 2, 6, 7]
    total = 0.0
    for last in range(2, 2 + shape.ids):
        x, y, _ = lm.blocks([np.array([*head, last], np.int32)])
        got = lm.log_probabilities(p, shape, x, y).ravel()
        got = got[y.ravel() >= 0]
        total += np.exp(got[-1])
        first = got[:-1] if last == 2 else first
        assert np.allclose(first, got[:-1])
    assert total == pytest.approx(1.0, abs=1e-5)


@pytest.mark.parametrize("scale", [1, 40, 400])
def test_later_tokens_never_change_earlier_ones(scale):
    """Also with weights so strong that scores are in the hundreds; probabilities of all ids still add up to one."""
    from itemrank.llm import attention_lm as lm

    shape, rng = lm.Shape(4, 4, 6, 16), np.random.default_rng(5)
    p = {k: (v * scale).astype(np.float32) for k, v in lm.start(shape, np.arange(16) + 1.0).items()}
    p["near"] = rng.normal(0, scale, p["near"].shape).astype(np.float32)
    head = rng.integers(2, 18, 30)
    total, first = 0.0, None
    for last in range(2, 2 + shape.ids):
        x, y, _ = lm.blocks([np.array([*head, last], np.int32)])
        got = lm.log_probabilities(p, shape, x, y).ravel()[y.ravel() >= 0]
        total += np.exp(got[-1])
        first = got[:-1] if first is None else first
        assert np.isfinite(got).all() and np.array_equal(first, got[:-1])
    assert total == pytest.approx(1.0, abs=1e-4)


def test_lm_steps_use_memory_again():
    """After the first steps a gradient asks the system for hardly any page (before: every array anew at each step)."""
    import subprocess
    import sys

    code = """
import resource, numpy as np
from itemrank.llm import attention_lm as lm
if not lm.keep_freed_memory():
    raise SystemExit(print(0))
shape, rng = lm.Shape(), np.random.default_rng(0)
p = lm.start(shape, np.ones(shape.ids))
x, y, _ = lm.blocks([rng.integers(2, shape.ids + 2, 76) for _ in range(96)])
for _ in range(5):
    lm.gradient(p, shape, x, y)
before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
for _ in range(10):
    lm.gradient(p, shape, x, y)
print((resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before) // 10)
"""
    got = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True)
    assert int(got.stdout.split()[-1]) < 500


def test_lm_windows_are_views():
    from itemrank.llm import attention_lm as lm

    rows = np.arange(4 * lm.HALF * 6, dtype=np.float32).reshape(-1, 6)[:, 2:4]
    windows = lm._windows(rows)
    assert np.shares_memory(windows, rows) and windows.shape == (3, 2 * lm.HALF, 2)
    for i, w in enumerate(windows):
        assert (w == rows[i * lm.HALF:(i + 2) * lm.HALF]).all()


def test_lm_takes_each_exponential_once(monkeypatch):
    """One exponential per place and key, and one per target and output (before: two, cluster by cluster)."""
    from itemrank.llm import attention_lm as lm

    shape, rng = lm.Shape(8, 4, 6, 16), np.random.default_rng(0)
    p = lm.start(shape, np.ones(shape.ids))
    x, y, _ = lm.blocks([rng.integers(2, shape.ids + 2, k) for k in (5, 20, 33)])
    taken = []

    class Counted:
        def __getattr__(self, name):
            return getattr(np, name)

        def exp(self, z, **more):
            taken.append(z.size)
            return np.exp(z, **more)

    monkeypatch.setattr(lm, "np", Counted())
    lm.gradient(p, shape, x, y)
    assert sum(taken) <= x.size * 2 * lm.HALF + (y >= 0).sum() * (shape.clusters + shape.members) and len(taken) <= 3


def test_lm_attention_place_by_place():
    """Queries, keys, values and output by their own weights, one place and one key at a time."""
    from itemrank.llm import attention_lm as lm

    shape, rng = lm.Shape(4, 4, 6, 16), np.random.default_rng(7)
    p = {k: rng.normal(0, .5, v.shape) for k, v in lm.start(shape, np.ones(16)).items()}
    text = rng.integers(2, 18, 37)
    x, y, _ = lm.blocks([text])
    e = p["embed"][x.ravel()] + p["pair"][lm._pair_slots(x, shape.pairs)]
    q, k, v = np.split(e @ p["qkv"], 3, axis=1)
    expected = []
    for i, target in enumerate(text - 2, start=lm.HALF):  # the stream begins after an empty block
        keys = [j for j in range(i // lm.HALF * lm.HALF - lm.HALF, i + 1) if j >= lm.HALF]
        w = np.exp([q[i] @ k[j] / np.sqrt(6) + p["near"][i - j] for j in keys])
        h = e[i] + np.tanh((w / w.sum()) @ v[keys] @ p["out"])
        c, m = divmod(target, shape.members)
        first, second = np.exp(h @ p["w1"] + p["b1"]), np.exp(h @ p["w2"][c] + p["b2"][c])
        expected.append(np.log(first[c] / first.sum() * second[m] / second.sum()))
    assert np.allclose(lm.log_probabilities(p, shape, x, y)[y >= 0], expected, atol=1e-6)


def test_lm_row_gradients_are_summed_by_column(monkeypatch):
    """No list of all cells (places times width) is made to sum the gradients of vectors by id, as it was before."""
    from itemrank.llm import attention_lm as lm

    shape, rng = lm.Shape(8, 4, 6, 16), np.random.default_rng(0)
    p = lm.start(shape, np.ones(shape.ids))
    x, y, _ = lm.blocks([rng.integers(2, shape.ids + 2, k) for k in (50, 20, 33)])
    sizes = []

    class Counted:
        def __getattr__(self, name):
            return getattr(np, name)

        def bincount(self, ids, *a, **more):
            sizes.append(len(ids))
            return np.bincount(ids, *a, **more)

    monkeypatch.setattr(lm, "np", Counted())
    lm.gradient(p, shape, x, y)
    assert sizes and max(sizes) <= x.size
    de, ids = rng.normal(size=(40, 3)), rng.integers(0, 5, 40)
    expected = np.zeros((7, 3))
    np.add.at(expected, ids, de)
    assert np.allclose(lm._row_sums(np.ascontiguousarray(de.T), ids, 7, np.float64), expected)


def test_lm_no_target_in_a_batch():
    from itemrank.llm import attention_lm as lm

    shape = lm.Shape(4, 4, 6, 16)
    p = lm.start(shape, np.ones(shape.ids))
    x, y, _ = lm.blocks([np.zeros(0, np.int32)])
    assert lm.log_probabilities(p, shape, x, y).tolist() == [[0.0] * lm.HALF]
    loss, g = lm.gradient(p, shape, x, y)
    assert loss == 0 and all(not v.any() for v in g.values())


@pytest.mark.parametrize("cache", [3, 1000])
def test_lm_words_are_looked_up_by_chunk(monkeypatch, cache):
    """Ids and segments as when each word is encoded by itself, also when the cache is emptied between chunks."""
    monkeypatch.setattr(lm_score, "CACHE", cache)
    monkeypatch.setattr(textops.text_chunks, "__defaults__", (False, 64))
    rng = random.Random(2)
    words = ["The", "quick", "\u00c9t\u00e9", "x" * 70, "\u4e2d\u6587", "a_b", "#"]
    texts = [None, "", " \t\n", *(" ".join(rng.choices(words, k=k)) for k in (1, 31, 32, 33, 64, 100, 5, 5, 5))]
    subwords = lm_score.Subwords(lm_score.TOKENIZER)
    expected = []
    for t in texts:
        w = BLANK.findall((t or "").translate(LOWER))
        parts = [w[i:i + 32] for i in range(0, len(w), 32)] or [[]]
        expected += [([i for x in s for i in subwords.encoding.encode_ordinary(" " + x)], k == len(parts) - 1)
                     for k, s in enumerate(parts)]
    got = []
    for batch in lm_score._segments([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])],
                                    lm_score.TOKENIZER):
        got += [(r["ids"], r["last"]) for r in batch.to_pylist()]
    assert got == expected
    encoded = []

    class Counted:
        def encode_ordinary(self, word):
            encoded.append(word)
            return subwords.encoding.encode_ordinary(word)

    kept = lm_score.Subwords(lm_score.TOKENIZER)
    kept.encoding = Counted()
    for w in textops.text_chunks(pa.array(["a b a b a c", "c b a"] * 50), textops.blank_separated(), chunk=16):
        kept.encode(w, w.hashes())
    assert len(encoded) == 3 and len(kept.known) == 3


def test_lm_streams_close_texts():
    from itemrank.llm import attention_lm as lm

    shape = lm.Shape(4, 4, 6, 16)
    v = lm_score.Vocabulary({5: 9, 7: 4}, 1, shape, 20)
    got = v.streams(np.array([5, 7, 9, 5]), np.array([0, 2, 2, 3, 4]), np.array([False, True, True, False]))
    assert [s.tolist() for s in got] == [[4, 5], [3], [2, 3], [4]]
