"""The quality classifier: statistics and fit against plain versions, and held-out accuracy."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from itemrank.llm import quality_qda as qda
from itemrank.llm import queries as llm_queries
from itemrank.llm.textops import blank_separated, text_chunks

SCHEMA = "doc_id long, text string, score double, x string, held_out string, quality int"
EXTRA = (0.5, "x", "no", 3)
LABELS = "doc_id long, quality int, toxic int, text string, x int"


def plain_statistics(text):
    data, lines = (text or "").encode(), (text or "").split("\n")
    for c in b"\t\n\x0b\x0c\r":
        text = (text or "").replace(chr(c), " ")
    words = [w.encode() for w in text.split(" ") if w]
    n = max(len(words), 1)
    share = {name: sum(b in bytes(members) for b in data) / max(len(data), 1) for name, members in qda.CLASSES.items()}
    share["long_words"] = sum(len(w) > 20 for w in words) / n
    share["one_byte_words"] = sum(len(w) == 1 for w in words) / n
    share["same_next"] = sum(a == b for a, b in zip(words, words[1:])) / n
    counts = collections.Counter(words)
    share["repeated_words"], share["top_word"] = (len(words) - len(counts)) / n, max(counts.values(), default=0) / n
    kept = [tuple(x for x in line.replace("\t", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x)
            for line in lines]
    kept = [x for x in kept if x]
    share["repeated_lines"] = (len(kept) - len(set(kept))) / max(len(kept), 1)
    triples = list(zip(words, words[1:], words[2:]))
    share["repeated_triples"] = (len(triples) - len(set(triples))) / max(len(triples), 1)
    size = {"words": len(words), "lines": len(kept), "word_bytes": sum(map(len, words)) / n,
            "line_words": len(words) / max(len(kept), 1)}
    return [round(math.log1p(size[s]) * qda.SCALE) for s in qda.SIZES] + [
        round(math.asin(math.sqrt(share[s])) * qda.SCALE) for s in qda.SHARES]


TEXTS = ["A b, c d.\nA b, c d.\n\n  \nlast line here!", "", None, " \t\n ", "x", "aa aa aa aa aa aa", "été |été| ### été\n1 2 3 3",
         "one two three one two three\none\ttwo three\r\n" * 30, "w" * 50 + " end", "long text " * 20_000]


def test_statistics_equal_plain_ones():
    got = np.concatenate([qda.chunk_statistics(w) for w in text_chunks(pa.array(TEXTS, pa.string()), blank_separated(), chunk=40)])
    whole = np.concatenate([qda.chunk_statistics(w) for w in text_chunks(pa.array(TEXTS, pa.string()), blank_separated())])
    expected = np.array([plain_statistics(t) for t in TEXTS])
    assert abs(got - expected).max() <= 1 and (got == whole).all()  # a step where a rounding falls on a half


def test_fit_is_a_shrunk_quadratic_discriminant(spark):
    rng = np.random.default_rng(3)
    d = len(qda.STATISTICS)
    x = np.rint(rng.standard_normal((300, d)) * 200 + rng.integers(0, 500, d)).astype(int)
    good = (rng.random(300) < 0.6).astype(int)
    x[good == 1] += 80
    x[:, 3] = 7  # no spread
    rows = [(int(i % qda.FOLDS), int(g), [int(v) for v in r]) for i, (g, r) in enumerate(zip(good, x))]
    moments = qda._moments(spark.createDataFrame(rows, "fold long, good long, x array<long>").repartition(4))
    for without in (None, 2):
        use = np.array([r[0] != without for r in rows])
        a, g = x[use].astype(float), good[use]
        model = qda.fit(moments, 0.3, 0.1, without)
        sd = a.std(axis=0)
        z = (a - a.mean(axis=0)) / np.where(sd == 0, 1, sd)
        scatter = [np.cov(z[g == k].T, bias=True) for k in (0, 1)]
        pooled = sum((g == k).sum() * scatter[k] for k in (0, 1)) / len(g)
        expected = np.zeros(len(x))
        every = (x - a.mean(axis=0)) / np.where(sd == 0, 1, sd)
        for k, sign in ((0, -1), (1, 1)):
            c = 0.7 * scatter[k] + 0.3 * pooled
            c = 0.9 * c + 0.1 * np.trace(c) / d * np.eye(d)
            off = every - z[g == k].mean(axis=0)
            expected += sign * (-0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(c), off) - 0.5 * np.linalg.slogdet(c)[1])
        assert np.allclose(model.difference(x), expected, atol=1e-6)
        assert math.isclose(model.log_odds, math.log((g == 1).sum() / (g == 0).sum()))


def test_edge_cases(spark):
    """Null and repeated ids, null and conflicting labels, empty tables, clashing columns, one class only."""
    docs = [(i, t, *EXTRA) for i, t in enumerate(TEXTS)] + [(None, "no id here", *EXTRA), (5, TEXTS[5], *EXTRA), (5, "other", *EXTRA)]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)

    def run(labels):
        got = qda.score_quality(frame, spark.createDataFrame(labels, LABELS)).collect()
        assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in docs)
        for r in got:
            assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        return got

    assert {r.score for r in run([])} == {0.5}
    assert {r.score for r in run([(0, None, 0, "t", 1), (None, 1, 0, "t", 1), (77, 1, 0, "t", 1), (1, 9, 0, "t", 1)])} == {0.5}
    n = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in (0, 1, 3))
    assert {r.score for r in run([(i, 1, 0, "t", 1) for i in (0, 1, 3)])} == {(n + 1) / (n + 2)}
    got = run([(i, i % 2, 0, "t", 1) for i in range(10)] + [(4, 1, 1, "t", 1), (4, 0, 1, "t", 1), (4, 0, 1, "t", 1)])
    assert len({r.score for r in got}) > 3
    assert qda.score_quality(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)).collect() == []


def _held_out(spark, sf):
    got = llm_queries.op13_quality_classifier(spark, f"/root/testdata/{sf}")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    return got, got.where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()


def _auc(rows):
    order = sorted(rows, key=lambda r: r.score)
    ranks = collections.defaultdict(list)
    for i, r in enumerate(order, 1):
        ranks[r.score].append(i)
    good = [r for r in rows if r.quality == 1]
    total = sum(sum(ranks[r.score]) / len(ranks[r.score]) for r in good)
    return (total - len(good) * (len(good) + 1) / 2) / (len(good) * (len(rows) - len(good)))


def test_held_out_accuracy(spark):
    got, rows = _held_out(spark, "sf0.1")
    assert got.count() == 10_000
    right = np.mean([r.predicted == r.quality for r in rows])
    assert _auc(rows) > 0.97 and right > 0.96, (_auc(rows), right)


def test_reruns_and_partitions_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    first = qda.score_quality(docs, labels).collect()
    again = qda.score_quality(docs.repartition(7), labels.repartition(3)).collect()
    assert {tuple(r) for r in first} == {tuple(r) for r in again}


@pytest.mark.parametrize("text", ["", "word " * 100_000])
def test_any_text_has_a_score(spark, text):
    labels = [(i, int(i >= 20), 0, "t", 1) for i in range(40)]
    docs = [(i, f"some words of text {i} and more {'# ' * (i < 20)}" * (i + 1), *EXTRA) for i in range(40)] + [(99, text, *EXTRA)]
    got = {r.doc_id: r for r in qda.score_quality(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()}
    assert 0 <= got[99].score <= 1 and got[99].predicted in (0, 1)
