import numpy as np
import pytest

from itemrank.operators import knn


def _vectors(spark, dense):
    rows = [(int(i), int(k), float(dense[i, k])) for i, k in zip(*np.nonzero(dense))]
    return spark.createDataFrame(rows, "item_id long, key long, weight double")


def _brute(dense, k, metric, decimals):
    n = dense.shape[0]
    present = [i for i in range(n) if np.any(dense[i])]
    out = {}
    for i in present:
        cands = []
        for j in present:
            if j == i:
                continue
            if metric == "l2":
                v = round(float(((dense[i] - dense[j]) ** 2).sum()), decimals)
                cands.append((v, j))
            else:
                s = round(float(dense[i] @ dense[j]), decimals)
                if s > 0:
                    cands.append((-s, j))
        out[i] = [j for _, j in sorted(cands)[:k]]
    return out


@pytest.mark.parametrize("n_blocks", [1, 3])
@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_blocked_knn_matches_brute_force(spark, metric, n_blocks):
    rng = np.random.default_rng(7)
    dense = (rng.random((40, 30)) < 0.08) * rng.integers(1, 6, (40, 30)).astype(float)
    if metric == "cosine":
        norms = np.linalg.norm(dense, axis=1, keepdims=True)
        norms[norms == 0] = 1
        dense = dense / norms
    decimals = 6 if metric == "l2" else 9
    got = knn.top_k_neighbors(_vectors(spark, dense), 4, metric, decimals, n_blocks=n_blocks)
    res = {}
    for r in got.orderBy("item_id", "rank").collect():
        res.setdefault(r.item_id, []).append(r.neighbor_id)
    assert res == {i: v for i, v in _brute(dense, 4, metric, decimals).items() if v}


def test_sparse_merge_path_matches_dense(spark, monkeypatch):
    rng = np.random.default_rng(3)
    dense = (rng.random((30, 50)) < 0.1) * rng.integers(1, 6, (30, 50)).astype(float)
    monkeypatch.setattr(knn, "DENSE_CELLS", 1)
    monkeypatch.setattr(knn, "MERGE_CHUNK_PAIRS", 7)
    got = knn.top_k_neighbors(_vectors(spark, dense), 3, "l2", 6, n_blocks=2)
    res = {}
    for r in got.orderBy("item_id", "rank").collect():
        res.setdefault(r.item_id, []).append(r.neighbor_id)
    assert res == _brute(dense, 3, "l2", 6)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_heavy_keys_dense_rest_merged(spark, monkeypatch, metric):
    # a key budget of a few dense columns: hot keys go through BLAS, the rest
    # through the chunked merge, and the sum must equal the brute force
    rng = np.random.default_rng(11)
    dense = (rng.random((40, 60)) < 0.08) * rng.integers(1, 6, (40, 60)).astype(float)
    dense[rng.random(40) < 0.7, 0] = 2.0   # a key in most items
    dense[rng.random(40) < 0.4, 1] = 1.0
    monkeypatch.setattr(knn, "DENSE_CELLS", 150)
    monkeypatch.setattr(knn, "MERGE_CHUNK_PAIRS", 11)
    got = knn.top_k_neighbors(_vectors(spark, dense), 3, metric, 6, n_blocks=2)
    res = {}
    for r in got.orderBy("item_id", "rank").collect():
        res.setdefault(r.item_id, []).append(r.neighbor_id)
    assert res == _brute(dense, 3, metric, 6)


def test_hot_key_shared_by_every_item(spark):
    # one key (a hot user / frequent term) present in every item vector
    dense = np.zeros((25, 5))
    dense[:, 0] = 1.0
    dense[np.arange(25), 1 + np.arange(25) % 4] = np.arange(25) % 3 + 1
    got = knn.top_k_neighbors(_vectors(spark, dense), 3, "l2", 6, n_blocks=4)
    res = {}
    for r in got.orderBy("item_id", "rank").collect():
        res.setdefault(r.item_id, []).append(r.neighbor_id)
    assert res == _brute(dense, 3, "l2", 6)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_small_tiles_match_brute_force(spark, monkeypatch, metric):
    rng = np.random.default_rng(11)
    dense = (rng.random((45, 20)) < 0.15) * rng.integers(1, 4, (45, 20)).astype(float)
    if metric == "cosine":
        norms = np.linalg.norm(dense, axis=1, keepdims=True)
        norms[norms == 0] = 1
        dense = dense / norms
    monkeypatch.setattr(knn, "TILE_ITEMS", 7)
    decimals = 6 if metric == "l2" else 9
    got = knn.top_k_neighbors(_vectors(spark, dense), 5, metric, decimals, n_blocks=2)
    res = {}
    for r in got.orderBy("item_id", "rank").collect():
        res.setdefault(r.item_id, []).append(r.neighbor_id)
    assert res == {i: v for i, v in _brute(dense, 5, metric, decimals).items() if v}


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_hot_items_path_matches_brute_force(spark, metric):
    # a few items rated by almost every key (hot), the rest sparse
    rng = np.random.default_rng(5)
    dense = (rng.random((40, 30)) < 0.1) * rng.integers(1, 6, (40, 30)).astype(float)
    dense[3, :] = rng.integers(1, 6, 30)
    dense[17, :25] = rng.integers(1, 6, 25)
    dense[29, rng.random(30) < 0.8] = 2.0
    if metric == "cosine":
        norms = np.linalg.norm(dense, axis=1, keepdims=True)
        norms[norms == 0] = 1
        dense = dense / norms
    decimals = 6 if metric == "l2" else 9
    got = knn.top_k_neighbors(_vectors(spark, dense), 4, metric, decimals, n_blocks=3, hot_entries=15)
    res = {}
    for r in got.orderBy("item_id", "rank").collect():
        res.setdefault(r.item_id, []).append(r.neighbor_id)
    assert res == {i: v for i, v in _brute(dense, 4, metric, decimals).items() if v}


def test_hot_path_on_fixture_equals_blocked_path(tables):
    from pyspark.sql import functions as F

    from itemrank.operators import similarity

    vec = similarity.cf_vectors(tables.latest).checkpoint(eager=True)
    per_item = vec.groupBy("item_id").count()
    threshold = int(per_item.agg(F.percentile_approx("count", 0.8)).first()[0])
    assert per_item.where(F.col("count") > threshold).count() > 0  # some items take the hot path
    plain = knn.top_k_neighbors(vec, 5, "l2", 6, n_blocks=2)
    hot = knn.top_k_neighbors(vec, 5, "l2", 6, n_blocks=2, hot_entries=threshold)
    cols = ["item_id", "rank", "neighbor_id", "score"]
    assert sorted(map(tuple, plain.select(cols).collect())) == sorted(map(tuple, hot.select(cols).collect()))


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_query_items_match_full_result(spark, metric):
    rng = np.random.default_rng(21)
    dense = (rng.random((50, 25)) < 0.12) * rng.integers(1, 6, (50, 25)).astype(float)
    dense[8, :] = 1.0  # one hot item so both paths are exercised
    if metric == "cosine":
        norms = np.linalg.norm(dense, axis=1, keepdims=True)
        norms[norms == 0] = 1
        dense = dense / norms
    decimals = 6 if metric == "l2" else 9
    vec = _vectors(spark, dense)
    queries = spark.createDataFrame([(i,) for i in (0, 3, 8, 17, 44)], "item_id long")
    got = knn.top_k_neighbors(vec, 4, metric, decimals, hot_entries=20, queries=queries)
    res = {}
    for r in got.orderBy("item_id", "rank").collect():
        res.setdefault(r.item_id, []).append(r.neighbor_id)
    brute = _brute(dense, 4, metric, decimals)
    assert res == {i: brute[i] for i in (0, 3, 8, 17, 44) if brute.get(i)}


def test_more_groups_than_partitions_streams_groups(spark):
    rng = np.random.default_rng(9)
    dense = (rng.random((60, 20)) < 0.15) * rng.integers(1, 6, (60, 20)).astype(float)
    got = knn.top_k_neighbors(_vectors(spark, dense), 4, "l2", 6, n_blocks=5, max_partitions=3)
    res = {}
    for r in got.orderBy("item_id", "rank").collect():
        res.setdefault(r.item_id, []).append(r.neighbor_id)
    assert res == _brute(dense, 4, "l2", 6)


@pytest.mark.parametrize("asked", [None, [0, 3, 17, 59, 1000]])
def test_equal_vectors_are_searched_once(spark, monkeypatch, asked):
    """Similarity by classes of equal vectors gives the lists of brute force; the search itself meets each vector once."""
    rng = np.random.default_rng(21)
    base = (rng.random((12, 20)) < 0.3) * rng.integers(1, 5, (12, 20)).astype(float)
    base[0] = 0
    base[0, 19] = 1.0                               # a class that few share a key with
    dense = base[rng.integers(0, 12, 60)]
    norms = np.linalg.norm(dense, axis=1, keepdims=True)
    dense = dense / np.where(norms == 0, 1, norms)
    expected = {i: v for i, v in _brute(dense, 4, "cosine", 9).items() if v and (asked is None or i in asked)}
    queries = None if asked is None else spark.createDataFrame([(i,) for i in asked], "item_id long")
    inner, met = knn.top_k_neighbors, []

    def spy(vectors, *args, **kwargs):
        met.append(vectors.select("item_id").distinct().count())
        return inner(vectors, *args, **kwargs)

    monkeypatch.setattr(knn, "top_k_neighbors", spy)
    monkeypatch.setattr(knn, "CLASS_ITEMS", 8, raising=False)
    got = {}
    for r in inner(_vectors(spark, dense), 4, "cosine", 9, queries=queries).orderBy("item_id", "rank").collect():
        got.setdefault(r.item_id, []).append(r.neighbor_id)
    assert got == expected
    assert met and max(met) <= 12


@pytest.mark.parametrize("nb", [1, 2, 5])
def test_block_pairs_are_numbered_without_gaps(spark, monkeypatch, nb):
    """One block pair a task: the ids of the pairs are 0, 1, ... and no two share a partition."""
    rng = np.random.default_rng(3)
    dense = rng.normal(size=(40, 6)).round(3)
    inner, seen = knn._run_per_group, []

    def spy(rows, n_groups, *args):
        seen.append((sorted(r.gid for r in rows.select("gid").distinct().collect()), n_groups))
        return inner(rows, n_groups, *args)

    monkeypatch.setattr(knn, "_run_per_group", spy)
    got = {}
    for r in knn.top_k_neighbors(_vectors(spark, dense), 3, "l2", 6, n_blocks=nb).orderBy("item_id", "rank").collect():
        got.setdefault(r.item_id, []).append(r.neighbor_id)
    assert got == _brute(dense, 3, "l2", 6)
    assert seen == [(list(range(nb * (nb + 1) // 2)), nb * (nb + 1) // 2)]


def test_projection_finds_an_items_entries_together(spark, monkeypatch):
    """The projection's dims rows an entry are summed where they are made: no item's entries lie in two partitions."""
    from pyspark.sql import functions as F

    from itemrank.operators import similarity

    rows = [(i % 30, u, 1.0 + (i * u) % 5, 100) for i in range(30) for u in range(40) if (i + u) % 3]
    latest = spark.createDataFrame(rows, "movie_id long, user_id long, rating double, timestamp long").repartition(6, "user_id")
    inner, spread = similarity.projected_vectors, []

    def spy(vectors, *args):
        placed = vectors.select("item_id", F.spark_partition_id().alias("at")).distinct()
        spread.append(placed.groupBy("item_id").count().agg(F.max("count")).first()[0])
        return inner(vectors, *args)

    monkeypatch.setattr(similarity, "projected_vectors", spy)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    try:
        for k in before:
            spark.conf.set(k, "false")
        assert similarity.ann_neighbors(latest, 3).count() == 90
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert spread == [1]


def test_items_are_sized_once(spark, monkeypatch):
    inner, calls = knn._sizes, []
    monkeypatch.setattr(knn, "_sizes", lambda vectors: calls.append(1) or inner(vectors))
    dense = np.random.default_rng(2).integers(0, 3, (30, 12)).astype(float)
    got = knn.top_k_neighbors(_vectors(spark, dense), 3, "l2", 6, n_blocks=3, indexed=True, hot_entries=9)
    res = {}
    for r in got.orderBy("item_id", "rank").collect():
        res.setdefault(r.item_id, []).append(r.neighbor_id)
    assert res == _brute(dense, 3, "l2", 6) and len(calls) == 1


def test_signed_items_are_sent_as_one_row(spark, monkeypatch):
    """A copy of an item is one row, whatever its entries; equal ids add up, and an item without a number has no distance."""
    monkeypatch.setattr(knn, "WHOLE_TILE", (7, 5))
    dense = np.random.default_rng(5).normal(size=(40, 6)).round(1)
    dense[3] = dense[4] = dense[5]
    rows = [(i, k, float(dense[i, k])) for i in range(40) for k in range(6)]
    rows += [(50, 0, 1.0), (50, 1, None), (51, 0, float("nan"))]
    inner, sent = knn._run_per_group, []

    def spy(rows, *args):
        sent.append(rows.count())
        return inner(rows, *args)

    monkeypatch.setattr(knn, "_run_per_group", spy)
    got = {}
    vectors = spark.createDataFrame(rows, "item_id long, key long, weight double")
    for r in knn.top_k_neighbors(vectors, 3, "l2", 6, n_blocks=3).orderBy("item_id", "rank").collect():
        got.setdefault(r.item_id, []).append(r.neighbor_id)
    assert sent == [42 * 3]
    assert got == _brute(dense, 3, "l2", 6)


def test_blocks_of_whole_items_are_few():
    """Replication grows with the blocks: 720000 vectors of 64 numbers are copied 24 times, not 88."""
    assert knn._blocks_for(720_000, 720_000 * 64, 12, knn.WHOLE_ITEMS) <= 24
