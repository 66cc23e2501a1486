"""Catalogue preparation and the sparse rating matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def prep_movies(movies_raw: DataFrame) -> DataFrame:
    """movies(movie_id, title, genres ARRAY, year DOUBLE, title_clean)."""
    return movies_raw.select(
        "movie_id", "title",
        text.genre_list(F.col("genres")).alias("genres"),
        text.title_year(F.col("title")).alias("year"),
        text.title_clean(F.col("title")).alias("title_clean"))


def item_info(movies: DataFrame) -> DataFrame:
    """Id -> title, 'A|B' genres, year (the result-row shape)."""
    return movies.select("movie_id", "title",
                         F.array_join("genres", "|").alias("genres"), "year")


def enrich(df: DataFrame, movies: DataFrame, id_col: str = "movie_id") -> DataFrame:
    """Attach item info to rows keyed by ``id_col``.

    The catalogue side is a dimension table; Catalyst broadcasts it only when
    its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
    falls back to a sort-merge join otherwise, so no unchecked broadcast.
    """
    info = item_info(movies).withColumnRenamed("movie_id", id_col)
    return df.join(info, id_col, "left")


def enrich_bounded(df: DataFrame, movies: DataFrame, id_col: str = "movie_id") -> DataFrame:
    """J6 for a result of proven small size (a top-n list).

    A left join keeps the small side and so can only broadcast the catalogue;
    instead the n ids are broadcast to semi-filter the catalogue in one scan
    (no shuffle of the catalogue), and the <= n matching rows are joined back.
    Both broadcasts are bounded by n.
    """
    ids = df.select(F.col(id_col).alias("movie_id")).distinct()
    info = item_info(movies.join(F.broadcast(ids), "movie_id", "left_semi"))
    return df.join(F.broadcast(info.withColumnRenamed("movie_id", id_col)), id_col, "left")


def item_ids(movies: DataFrame) -> DataFrame:
    """P7."""
    return movies.select("movie_id")


def genre_vocabulary(movies: DataFrame) -> DataFrame:
    """Sorted distinct genres (distinct is a partial+final aggregate)."""
    return movies.select(F.explode("genres").alias("genre")).distinct()


def genre_multi_hot(movies: DataFrame) -> DataFrame:
    """P4 in long form: (movie_id, genre, flag) for every movie x vocabulary genre.

    The sorted vocabulary is a scalar subquery (one array, bounded by the
    number of distinct genres) that every movie row explodes against, so the
    dense 0/1 matrix is produced row-locally without a join.
    """
    vocab = (movies.select(F.explode("genres").alias("g"))
             .agg(F.array_sort(F.collect_set("g"))).scalar())
    return (movies.select("movie_id", "genres", F.explode(vocab).alias("genre"))
            .select("movie_id", "genre",
                    F.array_contains("genres", F.col("genre")).cast("int").alias("flag")))


def latest_ratings(ratings: DataFrame) -> DataFrame:
    """Per (movie, user) the rating with the greatest timestamp.

    Two hash aggregates instead of a window or a struct max (which Spark can
    only run as a sort-based aggregate): first the highest rating per
    (movie, user, timestamp), then ``max_by(rating, timestamp)`` per
    (movie, user) — exact, because timestamps are unique within the group
    after the first step.  The facts are moved once, by (movie, user), which
    suits both steps; a key holds only one user's ratings of one movie.  Ties on
    timestamp go to the larger rating.
    """
    facts = ratings.select("movie_id", "user_id", "timestamp", "rating").repartition("movie_id", "user_id")
    per_ts = facts.groupBy("movie_id", "user_id", "timestamp").agg(F.max("rating").alias("rating"))
    return (per_ts.groupBy("movie_id", "user_id")
            .agg(F.max_by("rating", "timestamp").alias("rating"), F.max("timestamp").alias("timestamp"))
            .select("movie_id", "user_id", "rating", "timestamp"))


def _scale(m, s1, s2) -> list:
    """mean and sd of ``m`` cells with the sums ``s1`` of ratings and ``s2`` of squares."""
    mean = s1 / m
    sd = F.sqrt(F.greatest(s2 / m - mean * mean, F.lit(0.0)))
    return [mean.alias("mean"), F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias("sd")]


def user_scale(latest: DataFrame) -> DataFrame:
    """Per-user column statistics of the zero-filled movies x users matrix.

    M = number of rated movies (matrix rows).  mean = Σr/M, population
    sd = sqrt(Σr²/M - mean²), sd = 0 -> 1.  Returns (user_id, mean, sd).
    """
    m = latest.select(F.countDistinct("movie_id")).scalar()
    agg = latest.groupBy("user_id").agg(F.sum("rating").alias("s1"),
                                        F.sum(F.col("rating") * F.col("rating")).alias("s2"))
    return agg.select("user_id", *_scale(m, F.col("s1"), F.col("s2")))


def normalized_ratings(latest: DataFrame) -> DataFrame:
    """Explicit cells of the per-user z-scored matrix.

    (movie_id, user_id, rating, z, w): z = (r - mean_u)/sd_u is the scaled cell;
    w = r/sd_u is the centring-free weight whose pairwise differences equal
    those of z (implicit zero cells all share -mean_u/sd_u).  The scale of
    ``user_scale`` is taken over a user's cells where they stand together, so the
    cells are moved once.
    """
    m = latest.select(F.countDistinct("movie_id")).scalar()
    cells = Window.partitionBy("user_id")
    scale = _scale(m, F.sum("rating").over(cells), F.sum(F.col("rating") * F.col("rating")).over(cells))
    return (latest.where("user_id is not null").select("movie_id", "user_id", "rating", *scale)
            .select("movie_id", "user_id", "rating",
                    ((F.col("rating") - F.col("mean")) / F.col("sd")).alias("z"),
                    (F.col("rating") / F.col("sd")).alias("w")))


def rating_matrix_blocks(latest: DataFrame, block: int = 256) -> DataFrame:
    """A6 for all users: (movie_id, user_block, cells), the rated cells of ``block`` user columns a row.

    A row of the wide matrix is cut into blocks of user ids, so no row or group
    grows with the number of users; cells that are not listed are 0.
    """
    return latest.groupBy("movie_id", F.expr(f"user_id div {block}").alias("user_block")).agg(
        F.array_sort(F.collect_list(F.struct("user_id", "rating"))).alias("cells"))


def rating_matrix_slice(latest: DataFrame, user_ids: list[int]) -> DataFrame:
    """A6 for a bounded list of user columns: movies x users, 0 fill."""
    cols = [int(u) for u in user_ids]
    wide = (latest.where(F.col("user_id").isin(cols))
            .groupBy("movie_id").pivot("user_id", cols).agg(F.first("rating")))
    rated = latest.select("movie_id").distinct()
    out = rated.join(wide, "movie_id", "left").fillna(0.0)
    return out.select("movie_id", *[F.col(str(u)).cast("double").alias(f"u{u}") for u in cols])


def tfidf_vectors(movies: DataFrame, stop_words: bool = True, unicode: bool = True) -> DataFrame:
    """L2-normalised TF-IDF vectors in long form (movie_id, term, weight).

    tf = raw count, idf = ln((1+N)/(1+df)) + 1, N = number of documents; each
    document's vector is divided by its Euclidean norm.  All steps are
    aggregates with partial aggregation; N is a scalar subquery.
    """
    doc = text.document(F.col("title_clean"), F.col("genres"))
    terms = movies.select("movie_id", F.explode(text.tokens(doc, unicode)).alias("term"))
    if stop_words:
        terms = terms.where(~F.col("term").isin(list(text.english_stop_words())))
    n_docs = movies.select(F.count("*")).scalar()
    tf = terms.groupBy("movie_id", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    w = tf.join(df, "term").select("movie_id", "term", (F.col("tf") * idf).alias("w"))
    norm = w.groupBy("movie_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return (w.join(norm, "movie_id")
            .select("movie_id", "term", (F.col("w") / F.col("norm")).alias("weight")))
