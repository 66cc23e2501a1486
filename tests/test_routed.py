"""Routed exact kNN: equal to brute force, and how much work the index and the bounds save."""

import numpy as np
import pytest

from itemrank.operators import knn, routed
from tests.test_knn import _brute, _vectors


def _lists(df):
    res = {}
    for r in df.orderBy("item_id", "rank").collect():
        res.setdefault(r.item_id, []).append(r.neighbor_id)
    return res


def _sparse(seed, n, keys, density, metric):
    rng = np.random.default_rng(seed)
    dense = (rng.random((n, keys)) < density) * rng.integers(1, 6, (n, keys)).astype(float)
    dense[rng.random(n) < 0.6, 0] = 2.0            # a key that most items have
    dense[:8] = 0
    dense[:8, 3] = 1.0                             # items of equal vectors
    if metric == "cosine":
        norms = np.linalg.norm(dense, axis=1, keepdims=True)
        dense = dense / np.where(norms == 0, 1, norms)
    return dense


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("indexed", [True, False])
def test_lists_equal_brute_force(spark, monkeypatch, metric, indexed):
    monkeypatch.setattr(routed, "CHUNK_CELLS", 60)
    monkeypatch.setattr(routed, "DENSE_CHUNK_CELLS", 90)
    monkeypatch.setattr(routed, "DENSE_CELLS", 40)
    monkeypatch.setattr(routed, "CHUNK_PRODUCTS", 9)
    monkeypatch.setattr(routed, "MASK_BITS", 3)    # several words of blocks
    dense = _sparse(4, 90, 40, 0.06, metric)
    decimals = 6 if metric == "l2" else 9
    expected = {i: v for i, v in _brute(dense, 4, metric, decimals).items() if v}
    assert _lists(knn.top_k_neighbors(_vectors(spark, dense), 4, metric, decimals, n_blocks=7, indexed=indexed)) == expected


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_seekers_only(spark, metric):
    dense = _sparse(5, 60, 30, 0.1, metric)
    decimals = 6 if metric == "l2" else 9
    asked = [2, 11, 30, 59, 1000]
    expected = {i: v for i, v in _brute(dense, 3, metric, decimals).items() if v and i in asked}
    queries = spark.createDataFrame([(i,) for i in asked], "item_id long")
    for indexed in (True, False):
        got = knn.top_k_neighbors(_vectors(spark, dense), 3, metric, decimals, n_blocks=3, queries=queries, indexed=indexed)
        assert _lists(got) == expected


def test_few_items_and_many_equal_norms(spark):
    """Fewer items than places; more equal norms than places, where the least ids win."""
    one = np.eye(3)
    assert _lists(knn.top_k_neighbors(_vectors(spark, one), 5, "l2", indexed=True)) == _brute(one, 5, "l2", 6)
    same = np.eye(40)
    assert _lists(knn.top_k_neighbors(_vectors(spark, same), 3, "l2", n_blocks=4, indexed=True)) == _brute(same, 3, "l2", 6)


def _communities(n, seed=0):
    """Items of groups of 25, rated by 15 users of the group; one in 25 items has hardly a rating."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        users = rng.choice(15, 1 if i % 25 == 0 else rng.integers(6, 13), replace=False) + 15 * (i // 25)
        rows += [(i, int(u), float(rng.integers(1, 6))) for u in users]
    return rows


def _search(spark, rows, k, metric, decimals, nb):
    vectors = spark.createDataFrame(rows, "item_id long, key long, weight double").cache()
    norms = knn._sizes(vectors).select("item_id", "norm")
    return routed.RoutedSearch(vectors, norms, k, metric, decimals, nb)


def test_routes_grow_with_the_items_not_with_their_pairs(spark):
    """Twice the items in twice the blocks: visits stay below a quarter of the items, where all pairs would be n * n / 50."""
    for n in (250, 500, 1000):
        search = _search(spark, _communities(n), 3, "l2", 6, n // 50)
        assert search.routes().distinct().count() < n / 4


def test_bounds_rule_out_most_pairs(spark, monkeypatch):
    monkeypatch.setattr(routed, "CHUNK_CELLS", 2000)
    monkeypatch.setattr(routed, "DENSE_CHUNK_CELLS", 2000)
    rows = _communities(600)
    search = _search(spark, rows, 3, "l2", 6, 6)
    work = search.work().groupBy().sum("cells", "skipped").first()
    assert work[0] < 0.5 * 600 * 600
    dense = np.zeros((600, 15 * 24))
    for i, u, w in rows:
        dense[i, u] = w
    assert _lists(search.lists()) == _brute(dense, 3, "l2", 6)


def test_frequent_terms_route_nobody(spark):
    """Similarity: every item has the same two terms and four rare ones shared by ten; only rare ones are looked up."""
    rows = []
    for i in range(400):
        terms = {0: 0.2, 1: 0.2} | {10 + 4 * (i // 10) + j: 0.48 for j in range(4)}
        rows += [(i, t, w) for t, w in terms.items()]
    search = _search(spark, rows, 5, "cosine", 9, 8)
    lookups = search.blocks.select("item_id", "norm", "keys", "weights", "blk").mapInArrow(
        routed._lookups(5, 9, True, 1.0), "key long, blk int")
    assert lookups.where("key < 2").count() == 0
    assert search.routes().distinct().count() < 0.2 * 400 * 8
    assert {i: sorted(v) for i, v in _lists(search.lists()).items()}[0] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("tiles", [2048, 7])
def test_signed_vectors_keep_the_block_pairs(spark, monkeypatch, tiles):
    monkeypatch.setattr(knn, "TILE_ITEMS", tiles)
    monkeypatch.setattr(knn, "DENSE_CELLS", 150)
    monkeypatch.setattr(knn, "MERGE_CHUNK_PAIRS", 11)
    rng = np.random.default_rng(8)
    dense = (rng.random((40, 30)) < 0.2) * rng.integers(-5, 6, (40, 30)).astype(float)
    assert _lists(knn.top_k_neighbors(_vectors(spark, dense), 3, "l2", 6, n_blocks=2)) == _brute(dense, 3, "l2", 6)


@pytest.mark.parametrize("told", [64, 2])
def test_mixed_users_route_by_what_a_block_can_bring(spark, monkeypatch, told):
    """Every item shares users with most blocks, but hardly more than one user: sharing alone sends nobody."""
    monkeypatch.setattr(routed, "KEY_BLOCKS", told, raising=False)
    rng = np.random.default_rng(12)
    dense = np.zeros((600, 1200))
    for i in range(600):
        dense[i, rng.choice(1200, 4 if i % 100 == 0 else 12, replace=False)] = rng.integers(1, 6, 4 if i % 100 == 0 else 12)
    rows = [(int(i), int(u), float(dense[i, u])) for i, u in zip(*np.nonzero(dense), strict=True)]
    search = _search(spark, rows, 3, "l2", 6, 40)
    if told == 64:
        assert search.routes().distinct().count() < 0.25 * 600 * 40
    assert _lists(search.lists()) == _brute(dense, 3, "l2", 6)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_an_item_is_sent_once_to_the_blocks_of_a_task(spark, monkeypatch, metric):
    """Items of one community spread over blocks: with four blocks to a task they are sent to fewer tasks than blocks."""
    monkeypatch.setattr(routed, "CHUNK_CELLS", 200)
    monkeypatch.setattr(routed, "WAITING_CHUNKS", 2)
    monkeypatch.setattr(routed, "PART_ENTRIES", 500)
    rows = _communities(400)
    vectors = spark.createDataFrame(rows, "item_id long, key long, weight double").cache()
    norms = knn._sizes(vectors).select("item_id", "norm")
    decimals = 6 if metric == "l2" else 9
    search = routed.RoutedSearch(vectors, norms, 3, metric, decimals, 48, together=4)
    sent = search._rows(20000).where("side = 1")
    assert sent.count() < 0.7 * search.routes().distinct().count()
    assert sent.groupBy("item_id", "grp").count().where("count > 1").count() == 0
    dense = np.zeros((400, 15 * 16))
    for i, u, w in rows:
        dense[i, u] = w
    assert _lists(search.lists()) == _brute(dense, 3, metric, decimals)
    asked = spark.createDataFrame([(i,) for i in range(0, 400, 7)], "item_id long")
    search = routed.RoutedSearch(vectors, norms, 3, metric, decimals, 12, asked, together=5)
    assert _lists(search.lists()) == {i: v for i, v in _brute(dense, 3, metric, decimals).items() if i % 7 == 0 and v}


def test_a_part_is_told_a_key_once(spark, monkeypatch):
    """What a key brings goes to a part of items once, not to each of its items that have the key."""
    plain = routed._reaching

    def noted(n_blocks):
        def run(batches):
            import pyarrow as pa
            rows = pa.Table.from_batches(batches)
            told = rows.filter(rows["side"].to_numpy() == 0)
            assert told.num_rows == len(set(told["key"].to_pylist())) == 15 * 8
            yield from plain(n_blocks)(rows.combine_chunks().to_batches())
        return run

    monkeypatch.setattr(routed, "_reaching", noted)
    search = _search(spark, _communities(200), 3, "l2", 6, 8)
    assert search.routes().count() > 0
