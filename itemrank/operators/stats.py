"""Rating statistics, popularity and ranked lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from . import prep


def rating_stats(ratings: DataFrame) -> DataFrame:
    """A1: count, mean and last timestamp per movie over raw ratings."""
    return ratings.groupBy("movie_id").agg(
        F.count("rating").alias("rating_count"),
        F.avg("rating").alias("rating_mean"),
        F.max("timestamp").alias("last_rated"))


def popularity_scores(ratings: DataFrame) -> DataFrame:
    """A2: count · mean · 1/(1 + ln(1 + age_days)); now = max timestamp overall.

    The facts are read once, by the per-movie aggregate; it is checkpointed (one
    row per movie), and ``now`` is a scalar subquery over it.
    """
    return scored_popularity(rating_stats(ratings).checkpoint(eager=True))


def scored_popularity(s: DataFrame) -> DataFrame:
    """A2 from the per-movie aggregate of ``rating_stats`` (materialised: it is read twice)."""
    now = s.select(F.max("last_rated")).scalar()
    weight = text.time_decay(now, F.col("last_rated"))
    return s.select("movie_id", "rating_count", "rating_mean", "last_rated",
                    weight.alias("time_weight"),
                    (F.col("rating_count") * F.col("rating_mean") * weight).alias("popularity_score"))


def movie_stats(ratings: DataFrame) -> DataFrame:
    """A3: rating count and mean per movie."""
    return ratings.groupBy("movie_id").agg(F.count("rating").alias("rating_count"),
                                           F.avg("rating").alias("rating_mean"))


def popularity_share(ratings: DataFrame) -> DataFrame:
    """Share of all raw ratings per movie (count / total), the total summed from the counts."""
    counts = ratings.groupBy("movie_id").agg(F.count("*").alias("rating_count")).checkpoint(eager=True)
    total = counts.select(F.sum("rating_count")).scalar()
    return counts.select("movie_id", "rating_count", (F.col("rating_count") / total).alias("share"))


def movie_and_user_stats(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A1 per movie and the rated users, from one pass over the facts (grouping sets)."""
    both = ratings.groupingSets([["movie_id"], ["user_id"]], "movie_id", "user_id").agg(
        F.grouping("movie_id").alias("by_user"), F.count("rating").alias("rating_count"),
        F.avg("rating").alias("rating_mean"), F.max("timestamp").alias("last_rated")).checkpoint(eager=True)
    per_movie = both.where("by_user = 0").select("movie_id", "rating_count", "rating_mean", "last_rated")
    return per_movie, both.where("by_user = 1").select("user_id")


def active_users(ratings: DataFrame, min_ratings: int = 10) -> DataFrame:
    """users with at least ``min_ratings`` raw ratings."""
    return (ratings.groupBy("user_id").agg(F.count("*").alias("rating_count"))
            .where(F.col("rating_count") >= min_ratings))


def top_popular(ratings: DataFrame, movies: DataFrame, n: int = 10) -> DataFrame:
    """The n most popular movies (ties by id), with item info.

    ``orderBy().limit(n)`` plans as TakeOrderedAndProject: each partition keeps
    its own n best and only n·partitions rows reach the final merge.
    """
    pop = popularity_scores(ratings).select("movie_id", "popularity_score")
    top = (pop.orderBy(F.col("popularity_score").desc(), F.col("movie_id").asc()).limit(n)
           .withColumn("rank", F.row_number().over(
               Window.orderBy(F.col("popularity_score").desc(), F.col("movie_id").asc()))))
    return prep.enrich_bounded(top, movies).select("rank", "movie_id", "title", "genres", "year",
                                                   "popularity_score")


def genre_filter(movies: DataFrame, genres: list[str]) -> DataFrame:
    """movies carrying at least one of ``genres`` (exact, case-sensitive)."""
    wanted = F.array(*[F.lit(g) for g in genres])
    return movies.where(F.arrays_overlap("genres", wanted))


def genre_recommendations(ratings: DataFrame, movies: DataFrame, genres: list[str],
                          n: int = 5, use_popularity: bool = True) -> DataFrame:
    """Best n movies having any of ``genres``.

    J1 and J2 are one inner join: the popularity row of a movie carries its
    count and mean, and a movie has one exactly if it has ratings.  Sorted by
    popularity, count, mean (all desc) and id — or by count, mean when
    popularity is not used (T3).
    """
    cand = genre_filter(movies, genres).select("movie_id", "title", "genres", "year")
    if use_popularity:
        rec = cand.join(popularity_scores(ratings).drop("last_rated", "time_weight"), "movie_id")
        order = [F.col("popularity_score").desc(), F.col("rating_count").desc(),
                 F.col("rating_mean").desc(), F.col("movie_id").asc()]
    else:
        rec = cand.join(movie_stats(ratings), "movie_id")
        order = [F.col("rating_count").desc(), F.col("rating_mean").desc(), F.col("movie_id").asc()]
    top = rec.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    cols = ["rank", "movie_id", "title", F.array_join("genres", "|").alias("genres"), "year",
            "rating_count", "rating_mean"]
    if use_popularity:
        cols.append("popularity_score")
    return top.select(*cols)


def system_status(ratings: DataFrame, movies: DataFrame, cache: DataFrame | None = None,
                  queue: DataFrame | None = None, last_update: str | None = None,
                  is_updating: bool = False) -> DataFrame:
    """A5: one-row status; ``last_update_time`` is NULL before the first update.

    Totals over the raw ratings, catalogue size, and — when given — the number
    of users in the recommendation cache table and of validated rating events
    still waiting to be merged (the queue).  Each figure is an aggregate or a
    scalar subquery; nothing is collected.
    """
    r = ratings.agg(F.count("*").alias("total_ratings"),
                    F.countDistinct("user_id").alias("total_users"))
    cols = [F.col("total_ratings"), F.col("total_users"),
            movies.select(F.count("*")).scalar().alias("total_movies")]
    if cache is not None:
        cols.append(cache.select(F.countDistinct("user_id")).scalar().alias("cache_size"))
    if queue is not None:
        cols.append(queue.select(F.count("*")).scalar().alias("batch_queue_size"))
    cols += [F.lit(is_updating).alias("is_updating"), F.lit(last_update).cast("string").alias("last_update_time")]
    return r.select(*cols)
