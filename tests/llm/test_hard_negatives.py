"""Hard negatives against plain integer arithmetic."""

import collections
import math
import random

import numpy as np
import pytest

from itemrank.llm import hard_negatives as hn
from itemrank.llm import queries as llm_queries

SCHEMA = "vec_id long, embedding array<float>, label int, score long, tree string, found long"
EXTRA = (7, "t", 9)


def plain(rows):
    best = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        v = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        if sum(x * x for x in v) <= 2 ** 62:
            best[i] = min(best.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in best.items():
        if a % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in best.items() if i != a)
        for s, p, _ in [x for x in scores if x[2] == label][:5]:
            near = [x for x in scores if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a, p, rank, n, -s, -ns) for rank, (ns, n, _) in enumerate(near, 1)]
    return out


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = [tuple(r) for r in hn.hard_negatives(hn.scaled_vectors(docs), **options).collect()]
    assert collections.Counter(got) == collections.Counter(plain(rows))
    return got


def clustered(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, dims))
    return [(int(i), [float(x) for x in centres[rng.integers(5)] + spread * rng.standard_normal(dims)], int(rng.integers(3)), *EXTRA)
            for i in range(n)]


@pytest.mark.parametrize("spread,tree", [(1.0, 256), (0.05, 3), (0.05, 256)])
def test_random_vectors(spark, monkeypatch, spread, tree):
    monkeypatch.setattr(hn, "TILE", 300)
    monkeypatch.setattr(hn, "BLOCK_CELLS", 8 * 500)
    assert check(spark, clustered(5, 2000, 8, spread), tree=tree)


def test_edge_cases(spark):
    """Nulls, non-finite components, ties, repeated ids, uneven lengths, huge and zero vectors, negative ids."""
    rng = random.Random(4)
    rows = [(100 * i, [float(i % 3), 1.0, -2.0], i % 3, *EXTRA) for i in range(-3, 8)]
    rows += [(i, [rng.choice([0.0, 0.5, 1.0]) for _ in range(3)], rng.randrange(3), *EXTRA) for i in range(1, 150)]
    rows += [(200, [9.0, 9.0, 9.0], 2, *EXTRA), (5, [1.0, 1.0, 1.0], 0, *EXTRA), (5, [1.0, 1.0, 1.0], 0, *EXTRA)]
    rows += [(None, [1.0, 1.0, 1.0], 1, *EXTRA), (901, None, 1, *EXTRA), (902, [1.0, 1.0, 1.0], None, *EXTRA),
             (903, [1.0, None, 1.0], 1, *EXTRA), (904, [1.0, math.inf, 1.0], 1, *EXTRA), (905, [math.nan, 1.0, 1.0], 1, *EXTRA),
             (906, [1.0], 1, *EXTRA), (907, [], 1, *EXTRA), (1000, [], 2, *EXTRA), (908, [1e30, 1.0, 0.0], 1, *EXTRA),
             (909, [3e6, 2e6, 1e6], 1, *EXTRA), (1100, [3e6, 2e6, 1e6], 0, *EXTRA), (911, [3e6, 2e6, 1e6 - 1], 0, *EXTRA),
             (912, [3e6, 2e6, 1e6 - 5], 2, *EXTRA), (913, [2147483647.0, 0.0, 0.0], 9, *EXTRA)]
    assert any(r[4] > 2 ** 53 for r in check(spark, rows))
    assert check(spark, []) == []
    largest = [(i, [1.0], 2147483647, *EXTRA) for i in (1, 7, 100)]  # 7 gets the label after it, modulo 10
    assert check(spark, largest) == [(100, 1, 1, 7, 65536, 65536)]


def _tree(vectors, labels):
    order, parent, edge = hn.spanning_tree(vectors.astype(float))
    return {"vector": vectors[order], "parent": parent, "edge": edge, "vec_id": -1 - order, "label": labels[order]}


def test_near_anchors_rescore_few_candidates():
    """The bounds leave most candidates of near anchors alone, and no window loses one."""
    rng = np.random.default_rng(2)
    cands = (256 * rng.standard_normal((3000, 16))).astype(np.int64)
    base = 256 * rng.standard_normal(16)
    anchors = (base + 2 * rng.standard_normal((60, 16))).astype(np.int64)
    block = hn._Block([(np.arange(3000), np.zeros(3000, np.int64), cands)])
    tree = _tree(anchors, np.ones(60, np.int64))
    exact = tree["vector"] @ cands.T
    top = np.sort(exact, axis=1)[:, -3]
    windows = [[hn._Window(-(-80 * int(t) // 100), int(t), 5)] for t in top]
    scored = hn.descend(block, tree, windows, same_label=False)
    for place, [w] in enumerate(windows):
        inside = np.flatnonzero((exact[place] <= top[place]) & (100 * exact[place] >= 80 * top[place]))
        best = inside[np.lexsort((inside, -exact[place][inside]))][:5]
        assert list(w.ids) == list(best) and list(w.scores) == list(exact[place][best])
    assert scored < 0.2 * 60 * 3000


def test_spanning_tree_is_least():
    rng = np.random.default_rng(1)
    v = rng.standard_normal((40, 4))
    order, parent, edge = hn.spanning_tree(v)
    assert sorted(order) == list(range(40)) and parent[0] == -1 and all(parent[i] < i for i in range(40))
    pairs = sorted((float(np.linalg.norm(v[a] - v[b])), a, b) for a in range(40) for b in range(a))
    group, total = list(range(40)), 0.0
    for d, a, b in pairs:  # Kruskal
        if group[a] != group[b]:
            total += d
            group = [group[a] if g == group[b] else g for g in group]
    assert abs(edge.sum() - total) < 1e-6


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(
        "vec_id", "embedding", "label").collect()]
    got = llm_queries.op12_hard_negatives(spark, "/root/testdata/sf0.001").collect()
    assert got and collections.Counter(tuple(r) for r in got) == collections.Counter(plain(rows))
