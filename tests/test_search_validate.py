from pyspark.sql import functions as F

from itemrank.functions import text
from itemrank.operators import search, validate


def _movies(spark):
    return spark.createDataFrame(
        [(1, "red widget (1978)", ["PROMO", "Brand7"], 1978.0, "red widget"),
         (2, "blue bolt (1960)", ["ECONOMY", "Sci-Fi"], 1960.0, "blue bolt"),
         (3, "widget (1990)", ["economy"], 1990.0, "widget")],
        "movie_id long, title string, genres array<string>, year double, title_clean string")


def test_lcs_expression(spark):
    df = spark.createDataFrame([("matrix", "the matrix"), ("abcdef", "azced"), ("", "x")], "a string, b string")
    got = [r[0] for r in df.select(text.lcs_length(F.col("a"), F.col("b"))).collect()]
    assert got == [6, 3, 0]


def test_token_sort_score(spark):
    m = _movies(spark)
    scores = {r.movie_id: r.score for r in search.title_scores(m, "widget red 1978!").collect()}
    assert scores[1] == 100
    assert 0 <= scores[2] < scores[3] < 100


def test_genre_search_case_insensitive_and_hyphenated(spark):
    m = _movies(spark)
    assert sorted(r.movie_id for r in search.by_genre(m, "economy").collect()) == [2, 3]
    assert [r.movie_id for r in search.by_genre(m, "sci-fi").collect()] == [2]
    assert search.by_genre(m, "Nope").count() == 0


def test_year_search_and_advanced(spark):
    m = _movies(spark)
    assert [r.movie_id for r in search.by_year(m, 1978).collect()] == [1]
    assert sorted(r.movie_id for r in search.by_year_range(m, 1960, 1978).collect()) == [1, 2]
    # unknown genre and malformed year skip their criteria
    assert search.advanced(m, None, "nope", "19xx").count() == 3
    assert [r.movie_id for r in search.advanced(m, "widget", "economy", "1980-1995").collect()] == [3]


def test_validation_rejects_like_reference(spark):
    ev = spark.createDataFrame(
        [(1, "1", "1", "4.0", "1700000000"),
         (2, "1", "1", "6.0", "1700000000"),
         (3, "1", "1", "not a number", "1700000000"),
         (4, "1", None, "3.0", "1700000000"),
         (5, "1", "1", "NaN", "1700000000")],
        "event_id long, user_id string, movie_id string, rating string, timestamp string")
    checked = {r.event_id: r.reject_reason for r in validate.with_reject_reason(ev).collect()}
    assert checked[1] is None
    assert checked[2] == "rating_outside_scale"
    assert checked[3] == "rating_not_a_number"
    assert checked[4] == "no_movie_id"
    assert checked[5] == "rating_not_a_number"
    assert [r.event_id for r in validate.valid_ratings(ev).collect()] == [1]


def test_bit_parallel_lcs_equals_dp(tables):
    q = text.sort_tokens_py("widget red 1978!")
    a = text.sort_tokens(F.col("title"))
    df = tables.movies.select(text.lcs_length(a, F.lit(q)).alias("dp"),
                              text.lcs_length_const(a, q).alias("bits"))
    assert df.where(F.col("dp") != F.col("bits")).count() == 0
    assert text.sort_tokens_py("Widget, RED 1978!") == "1978 red widget"


def test_stamp_new_ratings(spark):
    import time

    sub = spark.createDataFrame([(7, 3, "4")], "user_id long, movie_id long, rating string")
    row = validate.stamp_ratings(sub).first()
    assert row.rating == 4.0 and abs(row.timestamp - time.time()) < 600
    assert validate.valid_ratings(validate.stamp_ratings(sub)).count() == 1


def test_fuzzy_score_keeps_accented_letters(spark):
    movies = spark.createDataFrame([(1, "Amélie (2001)"), (2, "Amelie (2001)")], "movie_id long, title string")
    scores = {r.movie_id: r.score for r in search.title_scores(movies, "amélie 2001").collect()}
    assert scores[1] == 100 and scores[2] < 100


def test_empty_title_query_finds_nothing(spark):
    assert search.by_title(_movies(spark), "   ", 10).count() == 0
