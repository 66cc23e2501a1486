from pyspark.sql import functions as F

from itemrank.functions import text
from itemrank.operators import prep


def test_title_parsing(spark):
    df = spark.createDataFrame([(1, "Toy Story (1995)", "Animation|Comedy"),
                                (2, "No Year Here", "Drama"),
                                (3, "Two (1999) Years (2001)", "A|B|C")],
                               "movie_id long, title string, genres string")
    rows = {r.movie_id: r for r in prep.prep_movies(df).collect()}
    assert rows[1].year == 1995.0 and rows[1].title_clean == "Toy Story"
    assert rows[1].genres == ["Animation", "Comedy"]
    assert rows[2].year is None and rows[2].title_clean == "No Year Here"
    assert rows[3].year == 1999.0 and rows[3].title_clean == "Two  Years"
    info = {r.movie_id: r.genres for r in prep.item_info(prep.prep_movies(df)).collect()}
    assert info[3] == "A|B|C"


def test_latest_rating_wins(spark):
    r = spark.createDataFrame([(1, 10, 4.0, 100), (1, 10, 2.0, 200), (1, 10, 5.0, 200),
                               (2, 10, 3.0, 50)],
                              "user_id long, movie_id long, rating double, timestamp long")
    got = {(x.user_id, x.movie_id): (x.rating, x.timestamp) for x in prep.latest_ratings(r).collect()}
    assert got == {(1, 10): (5.0, 200), (2, 10): (3.0, 50)}


def test_normalized_weights_match_dense_zscore(spark):
    import numpy as np

    data = [(1, 1, 4.0, 1), (1, 2, 2.0, 1), (2, 1, 5.0, 1), (2, 3, 1.0, 1), (3, 3, 3.0, 1)]
    r = spark.createDataFrame(data, "user_id long, movie_id long, rating double, timestamp long")
    n = {(x.movie_id, x.user_id): (x.z, x.w) for x in prep.normalized_ratings(r).collect()}
    movies, users = [1, 2, 3], [1, 2, 3]
    dense = np.zeros((3, 3))
    for u, m, v, _ in data:
        dense[movies.index(m), users.index(u)] = v
    mean, sd = dense.mean(axis=0), dense.std(axis=0)
    sd[sd == 0] = 1
    z = (dense - mean) / sd
    for (m, u), (zz, ww) in n.items():
        assert abs(z[movies.index(m), users.index(u)] - zz) < 1e-9
        assert abs(dense[movies.index(m), users.index(u)] / sd[users.index(u)] - ww) < 1e-9


def test_tfidf_smooth_idf_and_norm(spark):
    movies = spark.createDataFrame(
        [(1, "The Matrix", ["Action"], None, "The Matrix"),
         (2, "Matrix Reloaded", ["Action", "Sci-Fi"], None, "Matrix Reloaded"),
         (3, "Heat", ["Crime"], None, "Heat")],
        "movie_id long, title string, genres array<string>, year double, title_clean string")
    v = prep.tfidf_vectors(movies).collect()
    terms = {(r.movie_id, r.term): r.weight for r in v}
    assert (1, "the") not in terms  # English stop word removed
    norms = {}
    for (m, _), w in terms.items():
        norms[m] = norms.get(m, 0.0) + w * w
    assert all(abs(x - 1.0) < 1e-9 for x in norms.values())
    # idf(matrix) = ln(4/3)+1 (df=2), idf(action) = same; movie 1 has both -> equal weights
    assert abs(terms[(1, "matrix")] - terms[(1, "action")]) < 1e-12
    assert text.english_stop_words()[:3]


def test_genre_multi_hot_long_form(spark):
    movies = spark.createDataFrame([(1, ["A", "B"]), (2, ["B"])], "movie_id long, genres array<string>")
    got = sorted((r.movie_id, r.genre, r.flag) for r in prep.genre_multi_hot(movies).collect())
    assert got == [(1, "A", 1), (1, "B", 1), (2, "A", 0), (2, "B", 1)]


def test_fixture_views_have_cold_start_and_unrated(tables):
    rated = tables.ratings.select("movie_id").distinct().count()
    assert rated < tables.movies.count()
    cold = tables.users.join(tables.ratings, "user_id", "left_anti").count()
    assert cold > 0
    assert tables.movies.where(F.col("year").isNull()).count() > 0


def test_unicode_tokens_keep_accented_words(spark):
    df = spark.createDataFrame([("Amélie Poulain|Drama a",)], "doc string")
    got = df.select(text.tokens(F.col("doc"), unicode=True).alias("t")).first().t
    assert got == ["amélie", "poulain", "drama"]
    ascii_tokens = df.select(text.tokens(F.col("doc"), unicode=False).alias("t")).first().t
    assert ascii_tokens == ["am", "lie", "poulain", "drama"]


def _exchanges(df, of="hashpartitioning("):
    return df._jdf.queryExecution().executedPlan().toString().count(of)


def test_latest_rating_moves_the_facts_once(spark):
    rows = [(1, 1, 3.0, 5), (1, 1, 4.0, 5), (1, 1, 1.0, 2), (1, 2, 2.0, 1), (None, 1, 2.5, 1), (None, 1, 3.5, 2), (2, None, 1.0, 1)]
    latest = prep.latest_ratings(spark.createDataFrame(rows, "movie_id long, user_id long, rating double, timestamp long"))
    assert _exchanges(latest) == 1
    got = {(r.movie_id, r.user_id): (r.rating, r.timestamp) for r in latest.collect()}
    assert got == {(1, 1): (4.0, 5), (1, 2): (2.0, 1), (None, 1): (3.5, 2), (2, None): (1.0, 1)}


def test_scaled_cells_are_moved_once(spark):
    rows = [(1, 1, 4.0), (2, 1, 1.0), (1, 2, 5.0), (2, 2, 5.0), (3, 3, 2.0), (None, 3, 1.0), (3, None, 5.0)]
    latest = spark.createDataFrame(rows, "movie_id long, user_id long, rating double")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many users
    try:
        got = prep.normalized_ratings(latest)
        assert _exchanges(got, "hashpartitioning(user_id") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    scale = {r.user_id: (r.mean, r.sd) for r in prep.user_scale(latest).collect()}
    cells = {(r.movie_id, r.user_id): (r.z, r.w) for r in got.collect()}
    assert cells == {(m, u): ((r - scale[u][0]) / scale[u][1], r / scale[u][1]) for m, u, r in rows if u is not None}
