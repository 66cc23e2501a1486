"""Similar items: collaborative (R1), content (R2) and hybrid."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from . import knn, prep

CF_DECIMALS = 6       # squared distances are ranked after rounding to 1e-6
CONTENT_DECIMALS = 9  # similarities are ranked after rounding to 1e-9
ANN_WINDOWS = 8       # pairs of windows that one task of the approximate search holds, at most


def _as_items(query_items: DataFrame | None) -> DataFrame | None:
    return None if query_items is None else query_items.select(F.col("movie_id").alias("item_id"))


def cf_vectors(latest: DataFrame) -> DataFrame:
    """Sparse collaborative item vectors: (item_id=movie, key=user, weight=r/sd_u)."""
    n = prep.normalized_ratings(latest)
    return n.select(F.col("movie_id").alias("item_id"), F.col("user_id").alias("key"),
                    F.col("w").alias("weight"))


def cf_neighbors(latest: DataFrame, k: int = 5, n_blocks: int | None = None,
                 query_items: DataFrame | None = None, vectors: knn.Stored | None = None) -> DataFrame:
    """K nearest rated movies by squared L2 over per-user z-scored columns.

    (movie_id, rank, neighbor_id, distance).  Exact: every rated movie is a
    candidate, including movies that share no rater (distance = |a|² + |b|²).
    ``vectors`` are the ``cf_vectors`` of ``latest``, where they are stored already.
    """
    return _cf_lists(knn.top_k_neighbors(vectors or cf_vectors(latest), k, "l2", CF_DECIMALS, n_blocks,
                                         queries=_as_items(query_items)))


def updated_cf_neighbors(previous: DataFrame, latest: DataFrame, raters: DataFrame, k: int = 5,
                         full_share: float = 0.5, vectors: knn.Stored | None = None) -> DataFrame:
    """R1 after some users' ratings changed: the lists of ``previous`` brought up to ``latest``.

    ``raters(user_id)`` are the users with new ratings; ``previous`` are the
    lists of the matrix before, of the same rated movies (a new one changes
    every user's scale: that needs a full search).  A changed rating moves its
    user's scale, so all movies of these users are touched.  Lists to make anew
    are those of touched movies and those that hold one (a look-up of
    ``previous`` by neighbour).  Every other list can only be entered by touched
    movies: its entries, whose distances stand, meet its best ``k`` touched
    ones.  If more than ``full_share`` of the movies are touched, or one is too
    large for a task, all lists are made anew.
    """
    vectors = vectors or knn.Stored(cf_vectors(latest))
    touched = written(latest.join(raters.select("user_id").distinct(), "user_id", "left_semi")
                      .select(F.col("movie_id").alias("item_id")).distinct(), "touched")
    size = vectors.profile
    if touched.count() > full_share * size["n_items"] or size["max_item_nnz"] > knn.HOT_ENTRIES:
        return _cf_lists(knn.top_k_neighbors(vectors, k, "l2", CF_DECIMALS))
    losing = previous.join(touched.select(F.col("item_id").alias("neighbor_id")), "neighbor_id", "left_semi")
    anew = written(touched.unionByName(losing.select(F.col("movie_id").alias("item_id"))).distinct(), "anew")
    rest = written(vectors.sizes.select("item_id").join(anew, "item_id", "left_anti"), "rest")
    made = _cf_lists(knn.top_k_neighbors(vectors, k, "l2", CF_DECIMALS, queries=anew))
    if rest.isEmpty():  # every list is made anew
        return made
    entering = _cf_lists(knn.top_k_neighbors(vectors, k, "l2", CF_DECIMALS, queries=rest, candidates=touched))
    kept = previous.join(anew.select(F.col("item_id").alias("movie_id")), "movie_id", "left_anti")
    best = Window.partitionBy("movie_id").orderBy("distance", "neighbor_id")
    merged = (kept.unionByName(entering).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
    return made.unionByName(merged.select(made.columns))


def _cf_lists(lists: DataFrame) -> DataFrame:
    return lists.select(F.col("item_id").alias("movie_id"), "rank", "neighbor_id", F.col("score").alias("distance"))


def content_vectors(movies: DataFrame, stop_words: bool = True) -> DataFrame:
    """TF-IDF item vectors keyed by a 64-bit hash of the term: the kernel replicates every
    non-zero, and a long is a fraction of the term's text."""
    tf = prep.tfidf_vectors(movies, stop_words)
    return tf.select(F.col("movie_id").alias("item_id"), F.xxhash64("term").alias("key"), "weight")


def content_neighbors(movies: DataFrame, k: int = 5, stop_words: bool = True,
                      n_blocks: int | None = None, query_items: DataFrame | None = None) -> DataFrame:
    """R2: k most TF-IDF-similar movies (cosine > 0), self excluded.

    (movie_id, rank, neighbor_id, similarity).
    """
    nn = knn.top_k_neighbors(content_vectors(movies, stop_words), k, "cosine",
                             CONTENT_DECIMALS, n_blocks, queries=_as_items(query_items))
    return nn.select(F.col("item_id").alias("movie_id"), "rank", "neighbor_id",
                     F.col("score").alias("similarity"))


def hybrid(cf: DataFrame, content: DataFrame, rated: DataFrame, n: int = 5) -> DataFrame:
    """R3 core: union of the two neighbour lists, cut to n per movie.

    best_rank = least(cf_rank, content_rank); order (best_rank, CF first,
    neighbor_id).  Only rated movies (those with a collaborative vector) get a
    list; the union + min is a grouped aggregate, the cut a window top-n.
    """
    # CF lists exist only for rated movies already; content lists are restricted.
    content_rated = content.join(rated.select("movie_id"), "movie_id", "left_semi")
    both = (cf.select("movie_id", "neighbor_id", F.col("rank").alias("cf_rank"),
                      F.lit(None).cast("int").alias("content_rank"))
            .unionByName(content_rated.select("movie_id", "neighbor_id",
                                              F.lit(None).cast("int").alias("cf_rank"),
                                              F.col("rank").alias("content_rank"))))
    merged = both.groupBy("movie_id", "neighbor_id").agg(
        F.min("cf_rank").alias("cf_rank"), F.min("content_rank").alias("content_rank"))
    best = F.least("cf_rank", "content_rank")
    src = F.when(F.col("cf_rank") == best, F.lit(0)).otherwise(F.lit(1))
    w = Window.partitionBy("movie_id").orderBy(best.asc(), src.asc(), F.col("neighbor_id").asc())
    return (merged.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("movie_id", "rank", "neighbor_id", best.alias("best_rank"),
                    F.when(src == 0, F.lit("cf")).otherwise(F.lit("content")).alias("source")))


def hybrid_neighbors(latest: DataFrame, movies: DataFrame, n: int = 5,
                     cf_method: str = "exact", query_items: DataFrame | None = None) -> DataFrame:
    """R3 without item info: (movie_id, rank, neighbor_id, best_rank, source).

    What the recommendation operators consume — no catalogue join.
    ``cf_method="approximate"`` takes the collaborative list from
    ``ann_neighbors`` (work linear in the catalogue) for catalogues where the
    exact all-pairs search is out of reach.  ``query_items`` (DataFrame with
    ``movie_id``) restricts the lists to those movies (the reference's
    per-movie call) at a cost proportional to their number.
    """
    if cf_method == "approximate":
        cf = ann_neighbors(latest, n)
        if query_items is not None:
            cf = cf.join(query_items.select("movie_id"), "movie_id", "left_semi")
    else:
        cf = cf_neighbors(latest, n, query_items=query_items)
    content = content_neighbors(movies, n, query_items=query_items)
    rated = latest.select("movie_id").distinct()
    return hybrid(cf, content, rated, n)


def similar_items(latest: DataFrame, movies: DataFrame, n: int = 5,
                  cf_method: str = "exact", query_items: DataFrame | None = None) -> DataFrame:
    """Hybrid similar items with item info: (movie_id, rank, neighbor_id, title, genres, year)."""
    h = hybrid_neighbors(latest, movies, n, cf_method, query_items)
    return prep.enrich(h, movies, "neighbor_id").select(
        "movie_id", "rank", "neighbor_id", "title", "genres", "year")


def projected_vectors(vectors: DataFrame, dims: int = 32, seed: int = 42) -> DataFrame:
    """Random sign projection of sparse item vectors to ``dims`` dense coordinates.

    Coordinate j of item i is Σ_key w(i,key)·s(key,j)/√dims with s = ±1 from a
    seeded hash of (key, j) — deterministic, no random state to ship.  Squared
    distances are preserved in expectation (Johnson–Lindenstrauss).  The
    expansion is aggregated by (item, j) with map-side partial aggregation.
    """
    j = F.explode(F.sequence(F.lit(0), F.lit(dims - 1))).alias("j")
    sign = F.when(F.pmod(F.xxhash64(F.col("key"), F.col("j"), F.lit(seed)), F.lit(2)) == 0,
                  F.lit(1.0)).otherwise(F.lit(-1.0))
    scale = 1.0 / dims ** 0.5
    return (vectors.select("item_id", "key", "weight", j)
            .groupBy("item_id", "j").agg(F.sum(F.col("weight") * sign * F.lit(scale)).alias("weight"))
            .select("item_id", F.col("j").alias("key"), "weight"))


def _dot(arr: Column, vec) -> Column:
    lit_vec = F.array(*[F.lit(float(x)) for x in vec])
    return F.aggregate(F.zip_with(arr, lit_vec, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)


def ann_neighbors(latest: DataFrame, k: int = 5, tables: int = 2, bits: int = 1,
                  window: int = 512, dims: int = 16, seed: int = 42,
                  low_norms: int = 256, vectors: knn.Stored | None = None) -> DataFrame:
    """Approximate CF neighbours with sorted-window random-projection LSH.

    Per hash table t, every item gets a bucket from ``bits`` random hyperplanes
    and a position along one more random direction (all in a ``dims``-dim
    random projection of its z-scored vector).  Items are globally ordered by
    (bucket, position) with a distributed sort and cut into windows of
    ``window`` items; each pair of adjacent windows is searched exactly on the
    original sparse vectors (``knn.top_k_within_windows``), up to ``ANN_WINDOWS`` pairs in
    a task, so that few items are sent twice.  Work per item is
    O(tables · window), independent of the catalogue size; windows have a fixed
    size, so a crowded bucket is spread over consecutive windows instead of
    forming a hot group.  Distances of returned pairs are exact.

    Second candidate source: the ``low_norms`` items of smallest norm join
    every pair.  d² = |a|² + |b|² − 2·a·b and sparse dots are small, so these
    items are a large share of true neighbours (the same fact behind the exact
    pruning rule: with non-negative weights, pairs sharing no key can only be
    won by the globally smallest norms).  The list is bounded by ``low_norms``.
    (movie_id, rank, neighbor_id, distance).
    """
    from .evaluate import dense_index

    entries = cf_vectors(latest) if vectors is None else vectors.vectors
    # an item's entries in one row: the projection then sums its dims rows an entry before the shuffle
    items = written(entries.groupBy("item_id").agg(F.collect_list(F.struct("key", "weight")).alias("e")), "ann-items")
    proj = projected_vectors(items.select("item_id", F.inline("e")), dims, seed)
    arr = (proj.groupBy("item_id")
           .agg(F.array_sort(F.collect_list(F.struct("key", "weight"))).alias("cells"))
           .select("item_id", F.transform("cells", lambda c: c["weight"]).alias("p")))
    rng = np.random.default_rng(seed)
    keys = []
    for t in range(tables):
        planes = rng.standard_normal((bits, dims))
        direction = rng.standard_normal(dims)
        bucket = F.lit(0)
        for b in range(bits):
            bucket = bucket + F.when(_dot(F.col("p"), planes[b]) >= 0, F.lit(1 << b)).otherwise(F.lit(0))
        keys.append(F.struct(F.lit(t).alias("t"), bucket.alias("bucket"),
                             _dot(F.col("p"), direction).alias("pos")))
    per_table = arr.select("item_id", F.explode(F.array(*keys)).alias("h")).select("item_id", "h.*")
    n_items = arr.count()
    ordered = dense_index(per_table, [F.col("t"), F.col("bucket"), F.col("pos"), F.col("item_id")])
    n_windows = max(1, -(-n_items // window))
    pairs = max(n_windows - 1, 1)
    together = max(1, min(ANN_WINDOWS, tables * pairs // (4 * knn._parallelism(latest))))
    n_groups = -(-pairs // together)
    local = F.col("idx") - F.col("t") * F.lit(n_items)
    win = F.floor(local / window).cast("int").alias("win")
    # a window meets the one before it and the one after it: pairs win - 1 and win
    tasks = F.array_distinct(F.transform(F.array(F.col("win") - 1, F.col("win")), lambda p: F.floor(
        F.least(F.greatest(p, F.lit(0)), F.lit(pairs - 1)) / together).cast("int")))
    groups = ordered.select("item_id", "t", win).select("item_id", "win", "t", F.explode(tasks).alias("g")).select(
        "item_id", "win", (F.col("t") * F.lit(n_groups) + F.col("g")).alias("gid"))
    if low_norms:
        square = F.aggregate("e", F.lit(0.0), lambda acc, x: acc + F.coalesce(x["weight"] * x["weight"], F.lit(0.0)))
        low = items.select("item_id", square.alias("n")).orderBy("n", "item_id").limit(low_norms).select("item_id")
        everywhere = low.select("item_id", F.lit(-1).alias("win"), F.explode(F.sequence(F.lit(0), F.lit(tables * n_groups - 1))).alias("gid"))
        groups = groups.unionByName(everywhere)
    rows = groups.join(items.select("item_id", F.col("e.key").alias("keys"), F.col("e.weight").alias("weights")), "item_id")
    nn = knn.top_k_within_windows(rows, k, pairs, together, tables, "l2", CF_DECIMALS)
    return nn.select(F.col("item_id").alias("movie_id"), "rank", "neighbor_id",
                     F.col("score").alias("distance"))


def dense_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Dense array column -> long sparse form (item_id, key=position, weight).

    ``posexplode`` is row-local (no shuffle); exact zeros are dropped, except at
    the first position, where the cell marks the item's presence: an all-zero
    vector is a query and a candidate like any other.
    """
    return (df.select(F.col(id_col).cast("long").alias("item_id"),
                      F.posexplode(vec_col).alias("key", "weight"))
            .where((F.col("weight") != 0) | (F.col("key") == 0))
            .select("item_id", F.col("key").cast("long").alias("key"),
                    F.col("weight").cast("double").alias("weight")))


def vector_neighbors(df: DataFrame, id_col: str, vec_col: str, k: int = 5) -> DataFrame:
    """Exact L2 (squared) k nearest vectors of a table of dense embeddings.

    The flat-index search of the reference applied to a vector table: the
    blocked kNN operator on the long form.  (id_col, rank, neighbor_id, distance).
    """
    nn = knn.top_k_neighbors(dense_vectors(df, id_col, vec_col), k, "l2", CF_DECIMALS)
    return nn.select(F.col("item_id").alias(id_col), "rank", "neighbor_id",
                     F.col("score").alias("distance"))
