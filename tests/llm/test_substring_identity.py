"""Substring dedup tells rows apart by number: null and shared ids, equal 32-bit text hashes."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from itemrank.llm import substring_dedup
from itemrank.llm.fmindex import FMIndex


def removed(rows, size=35):
    words = [(t or "").split() for _, t in rows]
    seen = collections.Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i:i + size])] > 1 for j in range(i, i + size)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return collections.Counter(out)


def test_colliding_null_ids(spark):
    """Two different texts without an id and with one 32-bit hash, each holding another shared passage."""
    rng = random.Random(1)
    passage = [" ".join(f"w{rng.randrange(9999)}" for _ in range(n)) for n in (50, 90)]
    tails = spark.range(400_000).select(F.concat(F.lit(passage[0] + " a "), F.col("id")).alias("x"),
                                        F.concat(F.lit(passage[1] + " b "), F.col("id")).alias("y"))
    left = tails.select("x", F.hash("x").alias("h"))
    pair = left.join(tails.select("y", F.hash("y").alias("h")), "h").select("x", "y").first()
    assert pair is not None  # 400,000 squared pairs over 2**32 hashes
    rows = [(None, pair.x), (None, pair.y), (1, passage[0]), (2, passage[1]), (2, "other text"), (2, passage[1]), (None, None)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert collections.Counter(tuple(r) for r in got) == removed(rows)


@pytest.mark.parametrize("shard_words", [1, 90, 100_000])
def test_shards_end_where_keys_end(spark, shard_words):
    rng = random.Random(2)
    passages = [" ".join(f"w{rng.randrange(500)}" for _ in range(60)) for _ in range(12)]
    rows = [(i, " ".join(rng.choices(passages, k=rng.randrange(1, 4))) + f" end {i}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring_dedup.remove_repeats(docs, shard_words=shard_words).collect()
    assert collections.Counter(tuple(r) for r in got) == removed(rows)


def test_index_from_flat_symbols():
    rng = np.random.default_rng(3)
    seqs = [rng.integers(1, 4, rng.integers(1, 30)) for _ in range(40)]
    weights = rng.integers(1, 3, 40)
    flat = FMIndex.of(np.concatenate(seqs), np.array([len(s) for s in seqs]), weights).repeated(5)
    for a, b in zip(flat, FMIndex(seqs, weights).repeated(5), strict=True):
        assert list(a) == list(b)
