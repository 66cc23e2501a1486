"""The named query catalogue: key -> (spark, sf_dir) -> DataFrame.

Every query reads the shared test-data tables (or tables Spark derives from
them) in full; the only limits are the ones that are the feature (top-n lists).
Output doubles are rounded exactly as in the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import distincts, evaluate, knn, merge, prep, recommend, search, similarity, stats, validate
from ..streaming import batching, ingest, refresh
from ..session import scratch_path
from ..sources import event_folder, files, fixtures, store
from . import params as P
from .tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _r(c: str, d: int = 6):
    return F.round(c, d).alias(c)


# --- S1-S3: `::` scans, round-tripped through files derived from the tables ---

def _round_trip(spark: SparkSession, df: DataFrame, name: str, reader, writer=files.write_dat) -> DataFrame:
    path = scratch_path(spark, name)
    writer(df, path)
    return reader(spark, path)


@register("scan_ratings")
def scan_ratings(spark, sf_dir):
    return _round_trip(spark, Tables(spark, sf_dir).ratings, "ratings-dat", files.read_ratings)


@register("scan_movies")
def scan_movies(spark, sf_dir):
    return _round_trip(spark, Tables(spark, sf_dir).movies_raw, "movies-dat", files.read_movies,
                       files.write_movies_dat)


@register("scan_users")
def scan_users(spark, sf_dir):
    return _round_trip(spark, Tables(spark, sf_dir).users, "users-dat", files.read_users)


# --- projections -------------------------------------------------------------

@register("prep_movies")
def prep_movies(spark, sf_dir):
    return Tables(spark, sf_dir).movies


@register("item_info")
def item_info(spark, sf_dir):
    return prep.item_info(Tables(spark, sf_dir).movies)


@register("item_ids")
def item_ids(spark, sf_dir):
    return prep.item_ids(Tables(spark, sf_dir).movies)


@register("genre_vocabulary")
def genre_vocabulary(spark, sf_dir):
    return prep.genre_vocabulary(Tables(spark, sf_dir).movies)


@register("genre_multi_hot")
def genre_multi_hot(spark, sf_dir):
    return prep.genre_multi_hot(Tables(spark, sf_dir).movies)


@register("latest_ratings")
def latest_ratings(spark, sf_dir):
    return Tables(spark, sf_dir).latest


@register("rating_matrix_slice")
def rating_matrix_slice(spark, sf_dir):
    return prep.rating_matrix_slice(Tables(spark, sf_dir).latest, P.SLICE_USERS)


@register("rating_matrix")
def rating_matrix(spark, sf_dir):
    """A6, whole: every user's cells, in blocks of user columns."""
    blocks = prep.rating_matrix_blocks(Tables(spark, sf_dir).latest, P.MATRIX_BLOCK)
    return blocks.withColumn("cells", F.array_join(F.transform("cells", lambda c: F.concat(
        c["user_id"].cast("string"), F.lit(":"), c["rating"].cast("string"))), ","))


@register("normalized_ratings")
def normalized_ratings(spark, sf_dir):
    n = prep.normalized_ratings(Tables(spark, sf_dir, materialize=True).latest)
    return n.select("movie_id", "user_id", "rating", _r("z"), _r("w"))


# --- statistics ----------------------------------------------------------------

@register("rating_stats")
def rating_stats(spark, sf_dir):
    s = stats.rating_stats(Tables(spark, sf_dir).ratings)
    return s.select("movie_id", "rating_count", _r("rating_mean"), "last_rated")


@register("time_decay")
def time_decay(spark, sf_dir):
    p = stats.popularity_scores(Tables(spark, sf_dir).ratings)
    return p.select("movie_id", "last_rated", _r("time_weight", 9))


@register("popularity_scores")
def popularity_scores(spark, sf_dir):
    p = stats.popularity_scores(Tables(spark, sf_dir).ratings)
    return p.select("movie_id", "rating_count", _r("rating_mean"), "last_rated",
                    _r("time_weight", 9), _r("popularity_score"))


@register("movie_stats")
def movie_stats(spark, sf_dir):
    return stats.movie_stats(Tables(spark, sf_dir).ratings).select(
        "movie_id", "rating_count", _r("rating_mean"))


@register("popularity_share")
def popularity_share(spark, sf_dir):
    return stats.popularity_share(Tables(spark, sf_dir).ratings).select(
        "movie_id", "rating_count", _r("share", 9))


@register("active_users")
def active_users(spark, sf_dir):
    return stats.active_users(Tables(spark, sf_dir).ratings, P.MIN_RATINGS)


@register("top_popular")
def top_popular(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return stats.top_popular(t.ratings, t.movies, P.TOP_N).withColumn(
        "popularity_score", F.round("popularity_score", 6))


def _genre_recs(spark, sf_dir, use_popularity):
    t = Tables(spark, sf_dir)
    out = stats.genre_recommendations(t.ratings, t.movies, P.GENRE_LIST, P.GENRE_N, use_popularity)
    out = out.withColumn("rating_mean", F.round("rating_mean", 6))
    if use_popularity:
        out = out.withColumn("popularity_score", F.round("popularity_score", 6))
    return out


@register("genre_recommendations")
def genre_recommendations(spark, sf_dir):
    return _genre_recs(spark, sf_dir, True)


@register("genre_recommendations_by_count")
def genre_recommendations_by_count(spark, sf_dir):
    return _genre_recs(spark, sf_dir, False)


@register("system_status")
def system_status(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pending = validate.valid_new_ratings(t.rating_events, t.movies)
    # lists of the active users stand in the cache; the last update was at the fixed clock
    active = stats.active_users(t.ratings, P.MIN_RATINGS)
    cache = recommend.build_cache(recommend.user_top_rated(t.latest, P.SEEDS).join(active, "user_id", "left_semi")
                                  .withColumnRenamed("seed_rank", "rank"), P.SEEDS, F.lit(P.CACHE_NOW))
    return stats.system_status(t.ratings, t.movies, cache=cache, queue=pending, last_update=str(P.CACHE_NOW))


# --- search --------------------------------------------------------------------

@register("search_genre")
def search_genre(spark, sf_dir):
    return prep.item_info(search.by_genre(Tables(spark, sf_dir).movies, P.SEARCH_GENRE))


@register("search_year")
def search_year(spark, sf_dir):
    return prep.item_info(search.by_year(Tables(spark, sf_dir).movies, P.SEARCH_YEAR))


@register("search_year_range")
def search_year_range(spark, sf_dir):
    lo, hi = P.SEARCH_YEAR_RANGE
    return prep.item_info(search.by_year_range(Tables(spark, sf_dir).movies, lo, hi))


# --- similar items -------------------------------------------------------------

@register("tfidf_vectors")
def tfidf_vectors(spark, sf_dir):
    return prep.tfidf_vectors(Tables(spark, sf_dir).movies).select("movie_id", "term", _r("weight", 9))


@register("content_neighbors")
def content_neighbors(spark, sf_dir):
    return similarity.content_neighbors(Tables(spark, sf_dir).movies, P.NEIGHBORS)


@register("cf_neighbors")
def cf_neighbors(spark, sf_dir):
    return similarity.cf_neighbors(Tables(spark, sf_dir, materialize=True).latest, P.NEIGHBORS)


@register("similar_items")
def similar_items(spark, sf_dir):
    t = Tables(spark, sf_dir, materialize=True)
    return similarity.similar_items(t.latest, t.movies, P.NEIGHBORS)


@register("ann_neighbors")
def ann_neighbors(spark, sf_dir):
    return similarity.ann_neighbors(Tables(spark, sf_dir).latest, P.NEIGHBORS)



@register("embedding_neighbors")
def embedding_neighbors(spark, sf_dir):
    """R1 on a second input: exact L2 neighbours over the `embeddings` table."""
    from ..sources import fixtures

    emb = fixtures.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return similarity.vector_neighbors(emb, "vec_id", "embedding", P.NEIGHBORS)

# --- recommendations -------------------------------------------------------------

def _similar(t: Tables) -> DataFrame:
    """Hybrid neighbour lists as the recommenders consume them (no item info)."""
    return similarity.hybrid_neighbors(t.latest, t.movies, P.NEIGHBORS)


@register("user_top_rated")
def user_top_rated(spark, sf_dir):
    return recommend.user_top_rated(Tables(spark, sf_dir).latest, P.SEEDS)


@register("user_recommendations")
def user_recommendations(spark, sf_dir):
    t = Tables(spark, sf_dir, materialize=True)
    return recommend.user_recommendations(t.latest, _similar(t), P.REC_N, P.SEEDS)



@register("user_recommendations_by_seed")
def user_recommendations_by_seed(spark, sf_dir):
    """R4 through the per-user path: neighbour searches only for seed movies."""
    t = Tables(spark, sf_dir, materialize=True)
    users = t.latest.select("user_id").distinct()
    return recommend.recommend_for_users(t.latest, t.movies, users, P.REC_N, P.SEEDS, P.NEIGHBORS)

@register("cold_start_recommendations")
def cold_start_recommendations(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return recommend.cold_start_recommendations(t.users, t.ratings, P.REC_N)


@register("recommendations_with_fallback")
def recommendations_with_fallback(spark, sf_dir):
    t = Tables(spark, sf_dir, materialize=True)
    return recommend.recommendations_with_fallback(t.users, t.ratings, t.latest, _similar(t),
                                                   P.REC_N, P.FALLBACK_N)


@register("cached_recommendations")
def cached_recommendations(spark, sf_dir):
    """Cache table written with half the users stale (older than the TTL)."""
    t = Tables(spark, sf_dir, materialize=True)
    sim = _similar(t)
    recs = recommend.user_recommendations(t.latest, sim, P.REC_N, P.SEEDS)
    age = F.when(F.col("user_id") % 2 == 0, F.lit(600)).otherwise(F.lit(P.CACHE_TTL_SECONDS + 900))
    cache = recommend.build_cache(recs, P.REC_N, F.lit(P.CACHE_NOW) - age)
    path = scratch_path(spark, "rec-cache")
    cache.write.mode("overwrite").parquet(path)
    table = spark.read.parquet(path)
    return recommend.cached_recommendations(table, t.latest, None, P.CACHE_NOW,
                                            P.CACHE_TTL_SECONDS, P.REC_N, movies=t.movies)


# --- evaluation --------------------------------------------------------------------

def _eval_inputs(spark, sf_dir):
    t = Tables(spark, sf_dir, materialize=True)
    active = stats.active_users(t.ratings, P.MIN_RATINGS).select("user_id")
    folds = evaluate.assign_folds(active, P.EVAL_FOLDS, P.FOLD_SALT)
    recs = recommend.user_recommendations(t.latest, _similar(t), P.EVAL_K, P.SEEDS, users=active)
    # read three times by the metrics (coverage, diversity, novelty): written
    # once (users x k rows) so the similarity search never runs again
    return t, folds, recs.checkpoint(eager=True)


@register("eval_folds")
def eval_folds(spark, sf_dir):
    t = Tables(spark, sf_dir)
    active = stats.active_users(t.ratings, P.MIN_RATINGS).select("user_id").checkpoint(eager=True)
    return evaluate.assign_folds(active, P.EVAL_FOLDS, P.FOLD_SALT)


@register("eval_coverage")
def eval_coverage(spark, sf_dir):
    t, folds, recs = _eval_inputs(spark, sf_dir)
    return evaluate.fold_coverage(folds, recs, t.movies).select("fold", _r("coverage"))


@register("eval_diversity")
def eval_diversity(spark, sf_dir):
    t, folds, recs = _eval_inputs(spark, sf_dir)
    m = evaluate.per_user_metrics(folds, recs, t.movies, t.ratings)
    return m.select("user_id", "fold", _r("diversity"))


@register("eval_novelty")
def eval_novelty(spark, sf_dir):
    t, folds, recs = _eval_inputs(spark, sf_dir)
    m = evaluate.per_user_metrics(folds, recs, t.movies, t.ratings)
    return m.select("user_id", "fold", _r("novelty"))


@register("evaluate")
def evaluate_query(spark, sf_dir):
    t, folds, recs = _eval_inputs(spark, sf_dir)
    per_fold = evaluate.fold_metrics(folds, recs, t.movies, t.ratings)
    s = evaluate.summarize(per_fold, P.EVAL_FOLDS)
    return s.select("metric", _r("mean"), _r("std"), _r("ci_lower"), _r("ci_upper"))


# --- validation, merges, streaming ---------------------------------------------------

@register("validate_ratings")
def validate_ratings(spark, sf_dir):
    return validate.valid_ratings(Tables(spark, sf_dir).rating_events)


@register("rejected_ratings")
def rejected_ratings(spark, sf_dir):
    return validate.rejected_ratings(Tables(spark, sf_dir).rating_events)


@register("valid_new_ratings")
def valid_new_ratings(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return validate.valid_new_ratings(t.rating_events, t.movies)


@register("merge_ratings_latest")
def merge_ratings_latest(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return merge.merge_latest(t.ratings, validate.valid_new_ratings(t.rating_events, t.movies))


@register("merge_ratings_sum")
def merge_ratings_sum(spark, sf_dir):
    t = Tables(spark, sf_dir)
    out = merge.merge_sum(t.latest, validate.valid_new_ratings(t.rating_events, t.movies))
    return out.select("movie_id", "user_id", _r("rating"))


@register("stream_valid_ratings")
def stream_valid_ratings(spark, sf_dir):
    t = Tables(spark, sf_dir)
    res = ingest.run_ingest(spark, sf_dir, t.movies)
    return res.valid(spark).drop("batch_id")


@register("stream_merge_latest")
def stream_merge_latest(spark, sf_dir):
    t = Tables(spark, sf_dir)
    res = ingest.run_ingest(spark, sf_dir, t.movies)
    return ingest.merged_latest(t.ratings, res.valid(spark))


@register("stream_refresh_popularity")
def stream_refresh_popularity(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = ingest.run_popularity_state(spark, sf_dir, t.movies)
    pop = ingest.refreshed_popularity(t.ratings, ingest.stream_stats(spark.read.parquet(path)))
    return pop.select("movie_id", "rating_count", _r("rating_mean"), "last_rated",
                      _r("popularity_score"))


@register("stream_progress")
def stream_progress(spark, sf_dir):
    t = Tables(spark, sf_dir)
    res = ingest.run_ingest(spark, sf_dir, t.movies)
    # times are wall-clock, so the registered query keeps the
    # deterministic part: which batch read how many events
    return res.progress(spark).select("batch_id", "num_input_rows")



def _split_events(spark, sf_dir):
    """The event table as ``P.STREAM_FILES`` files, so that a stream of one file a trigger runs as many batches."""
    path = scratch_path(spark, "split-events")
    fixtures.table(spark, sf_dir, "events").repartition(P.STREAM_FILES, "event_id").write.option(
        "maxRecordsPerFile", 0).parquet(path)
    return ingest.event_stream(spark, path, max_files=1, pattern="*.parquet")


@register("stream_batches")
def stream_batches(spark, sf_dir):
    """ST2 + ST5 over several micro-batches: how many ran, what they read and accepted."""
    res = ingest.run_ingest(spark, sf_dir, Tables(spark, sf_dir).movies, raw_events=_split_events(spark, sf_dir))
    return res.progress(spark).agg(F.count(F.lit(1)).alias("batches"), F.sum("num_input_rows").alias("input_rows"),
                                   F.sum("num_valid_rows").alias("valid_rows"))


@register("stream_merge_batches")
def stream_merge_batches(spark, sf_dir):
    """ST3 over several micro-batches: the latest matrix of base ratings and log."""
    t = Tables(spark, sf_dir)
    res = ingest.run_ingest(spark, sf_dir, t.movies, raw_events=_split_events(spark, sf_dir))
    return ingest.merged_latest(t.ratings, res.valid(spark))


@register("stream_popularity_batches")
def stream_popularity_batches(spark, sf_dir):
    """ST4 over several micro-batches: running statistics in the state store."""
    t = Tables(spark, sf_dir)
    path = ingest.run_popularity_state(spark, sf_dir, t.movies, raw_events=_split_events(spark, sf_dir))
    pop = ingest.refreshed_popularity(t.ratings, ingest.stream_stats(spark.read.parquet(path)))
    return pop.select("movie_id", "rating_count", _r("rating_mean"), "last_rated", _r("popularity_score"))


@register("stream_model_tail")
def stream_model_tail(spark, sf_dir):
    """ST4: a model published every third batch and at the end holds the batches after the last third."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "model")
    refresh.run_with_refresh(spark, sf_dir, t.ratings, t.movies, path, 3, None, raw_events=_split_events(spark, sf_dir))
    return store.load_model(spark, path)["matrix"].select("movie_id", "user_id", "rating")


@register("stamp_new_ratings")
def stamp_new_ratings(spark, sf_dir):
    """P10: events submitted without a time (odd ids) are stamped with the fixed clock."""
    e = Tables(spark, sf_dir).rating_events
    sent = e.withColumn("timestamp", F.when(F.col("event_id") % 2 == 0, F.col("timestamp"))).withColumn(
        "rating", F.col("rating").cast("string"))
    return validate.stamp_ratings(sent, P.CACHE_NOW).select("event_id", "user_id", "movie_id", _r("rating"), "timestamp")


@register("cache_second_call")
def cache_second_call(spark, sf_dir):
    """The first call fills the stored cache, the second one, a minute later, is served from it."""
    t = Tables(spark, sf_dir, materialize=True)
    sim, path = _similar(t).checkpoint(eager=True), scratch_path(spark, "rec-cache")
    popular = recommend.popular_list(t.ratings, P.REC_N)
    for now in (P.CACHE_NOW, P.CACHE_NOW + 60):
        out = recommend.recommend_through_cache(spark, path, t.latest, sim, t.users, popular, now,
                                                P.CACHE_TTL_SECONDS, P.REC_N, model_version="1")
    return out


@register("model_recommendations")
def model_recommendations(spark, sf_dir):
    """S4 + S5 + R4: lists served from the saved tables alone."""
    t = Tables(spark, sf_dir, materialize=True)
    path = scratch_path(spark, "model")
    store.save_model(spark, path, {
        "matrix": t.latest, "similar": _similar(t),
        "popularity": stats.popularity_scores(t.ratings).select("movie_id", "popularity_score")})
    model = store.load_model(spark, path)
    return recommend.user_recommendations(model["matrix"], model["similar"], P.REC_N, P.SEEDS)


@register("stream_model_refresh")
def stream_model_refresh(spark, sf_dir):
    """ST3 + ST4: stream, merge, publish a model version; return its CF neighbours."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "model")
    refresh.run_with_refresh(spark, sf_dir, t.ratings, t.movies, path, 1, P.NEIGHBORS)
    return store.load_model(spark, path)["neighbors"]


@register("stream_distinct_counts")
def stream_distinct_counts(spark, sf_dir):
    """A5 after several micro-batches: bitmaps of the base ratings and of each batch, merged and counted."""
    t = Tables(spark, sf_dir)
    res = ingest.run_ingest(spark, sf_dir, t.movies, raw_events=_split_events(spark, sf_dir), keep_ids=True)
    return distincts.distinct_counts(distincts.merged_bitmaps(distincts.id_bitmaps(t.ratings), res.id_bitmaps(spark)))


@register("ann_recall")
def ann_recall(spark, sf_dir):
    """R1b against R1: whether the approximate lists hold 0.99 of the exact neighbours of all movies."""
    latest = Tables(spark, sf_dir, materialize=True).latest
    vectors = knn.Stored(similarity.cf_vectors(latest))
    exact = similarity.cf_neighbors(latest, P.NEIGHBORS, vectors=vectors).select("movie_id", "neighbor_id")
    found = similarity.ann_neighbors(latest, P.NEIGHBORS, vectors=vectors).select("movie_id", "neighbor_id", F.lit(1).alias("hit"))
    both = exact.join(found, ["movie_id", "neighbor_id"], "left")
    return both.agg((F.count("hit") >= 0.99 * F.count("*")).alias("recall_reached"), F.count("*").alias("exact_neighbors"))


@register("stream_source_ratings")
def stream_source_ratings(spark, sf_dir):
    """Events put into an event folder in two submissions, read through the streaming source and validated."""
    path = scratch_path(spark, "event-folder")
    raw = fixtures.table(spark, sf_dir, "events")
    for part in (0, 1):
        event_folder.append_events(spark, path, raw.where(F.col("event_id") % 2 == part))
    res = ingest.run_ingest(spark, sf_dir, Tables(spark, sf_dir).movies, raw_events=event_folder.event_folder_stream(spark, path))
    return res.valid(spark).drop("batch_id")


@register("stream_size_or_time")
def stream_size_or_time(spark, sf_dir):
    """ST2: batches of 100 events or of what came in 5 seconds, by lane: their sizes and what set them off."""
    events = fixtures.rating_events_from(ingest.event_stream(spark, sf_dir))
    query, path = batching.start(spark, events)
    try:
        batching.wait_for(spark, query, path, fixtures.table(spark, sf_dir, "events").count())
    finally:
        batching.stop(query)
    return batching.read_batches(spark, path).groupBy("lane", "batch", "set_off_by").agg(F.count("*").alias("events"))


@register("stream_updated_neighbors")
def stream_updated_neighbors(spark, sf_dir):
    """ST4: CF neighbours brought up to date after each of several micro-batches, never searched anew."""
    t = Tables(spark, sf_dir, materialize=True)
    path = scratch_path(spark, "model")
    refresh.run_with_refresh(spark, sf_dir, t.ratings, t.movies, path, 1, P.NEIGHBORS,
                             raw_events=_split_events(spark, sf_dir), full_share=1.0)
    return store.load_model(spark, path)["neighbors"]


# --- fuzzy title search -------------------------------------------------------------

@register("search_title")
def search_title(spark, sf_dir):
    top = search.by_title(Tables(spark, sf_dir).movies, P.TITLE_QUERY, P.TITLE_LIMIT)
    order = [F.col("score").desc(), F.col("movie_id").asc()]
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order))).select(
        "rank", "movie_id", "title", "score")


@register("search_advanced")
def search_advanced(spark, sf_dir):
    years = f"{P.ADVANCED_YEARS[0]}-{P.ADVANCED_YEARS[1]}"
    out = search.advanced(Tables(spark, sf_dir).movies, P.TITLE_QUERY, P.ADVANCED_GENRE, years,
                          P.ADVANCED_TITLE_LIMIT)
    return out.select("movie_id", "title", F.array_join("genres", "|").alias("genres"), "year", "score")


# --- persistence -------------------------------------------------------------------

@register("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """S4 + S5: save the model tables, load the newest version, return the matrix cells."""
    t = Tables(spark, sf_dir, materialize=True)
    feats = prep.normalized_ratings(t.latest)
    path = scratch_path(spark, "model")
    store.save_model(spark, path, {
        "matrix": t.latest.select("movie_id", "user_id", "rating"),
        "features": feats.select("movie_id", "user_id", "w"),
        "movie_ids": t.latest.select("movie_id").distinct(),
        "popularity": stats.popularity_scores(t.ratings).select("movie_id", "popularity_score"),
    })
    model = store.load_model(spark, path)
    return (model["matrix"].join(model["features"], ["movie_id", "user_id"])
            .select("movie_id", "user_id", "rating", _r("w")))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


__all__ = ["queries", "QUERIES", "FLAGSHIP"]
FLAGSHIP = "user_recommendations"
