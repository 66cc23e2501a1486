"""Hand-computed 3-6 row fixtures for the statistics operators."""

import math

from itemrank.operators import stats

DAY = 86400


def _ratings(spark, rows):
    return spark.createDataFrame(rows, "user_id long, movie_id long, rating double, timestamp long")


def test_popularity_formula_by_hand(spark):
    r = _ratings(spark, [(1, 1, 4.0, 0), (2, 1, 2.0, DAY), (1, 2, 5.0, 2 * DAY)])
    got = {x.movie_id: x for x in stats.popularity_scores(r).collect()}
    # now = 2 days; movie 1: count 2, mean 3, last rated 1 day ago
    assert got[1].rating_count == 2 and got[1].rating_mean == 3.0
    assert math.isclose(got[1].popularity_score, 2 * 3.0 / (1 + math.log(2.0)), rel_tol=1e-12)
    assert math.isclose(got[2].popularity_score, 5.0, rel_tol=1e-12)  # rated "now": weight 1


def test_share_and_active_users_by_hand(spark):
    r = _ratings(spark, [(1, 1, 4.0, 0), (1, 2, 3.0, 0), (2, 1, 5.0, 0), (1, 3, 1.0, 0)])
    share = {x.movie_id: x.share for x in stats.popularity_share(r).collect()}
    assert share == {1: 0.5, 2: 0.25, 3: 0.25}
    assert [x.user_id for x in stats.active_users(r, 3).collect()] == [1]


def test_genre_recommendations_order_by_hand(spark):
    movies = spark.createDataFrame(
        [(1, "A (1990)", ["Drama"], 1990.0, "A"), (2, "B (1991)", ["Drama", "War"], 1991.0, "B"),
         (3, "C (1992)", ["Comedy"], 1992.0, "C"), (4, "D (1993)", ["War"], 1993.0, "D")],
        "movie_id long, title string, genres array<string>, year double, title_clean string")
    r = _ratings(spark, [(1, 1, 5.0, 0), (2, 1, 5.0, 0), (1, 2, 4.0, 0), (1, 3, 5.0, 0),
                         (1, 4, 1.0, 0), (2, 4, 1.0, 0), (3, 4, 1.0, 0)])
    got = [x.movie_id for x in stats.genre_recommendations(r, movies, ["Drama", "War"], 5)
           .orderBy("rank").collect()]
    # popularity (all rated at `now`): 1 -> 10, 2 -> 4, 4 -> 3; comedy excluded
    assert got == [1, 2, 4]
    by_count = [x.movie_id for x in stats.genre_recommendations(r, movies, ["Drama", "War"], 2, False)
                .orderBy("rank").collect()]
    assert by_count == [4, 1]  # count desc: 3 ratings, then 2
