"""Usage example: the reference's calls as itemrank operators.

Writes `::` files derived from the sf0.001 test data (ratings, movies, users)
into the checkpoint folder, then runs the snippet below against them.
Run: python scripts/usage_example.py
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from itemrank.session import local_session, scratch_path  # noqa: E402
from itemrank.sources import files, fixtures  # noqa: E402

spark = local_session(8, 8)
data = scratch_path(spark, "usage")
files.write_dat(fixtures.ratings(spark, "/root/testdata/sf0.001"), f"{data}/ratings.dat")
files.write_movies_dat(fixtures.movies_raw(spark, "/root/testdata/sf0.001"), f"{data}/movies.dat")
files.write_dat(fixtures.users(spark, "/root/testdata/sf0.001"), f"{data}/users.dat")

# ---- snippet (paths: replace `data` with the folder holding the .dat files) ----
from itemrank.operators import evaluate, prep, recommend, search, similarity, stats, validate
from itemrank.sources import files

ratings = files.read_ratings(spark, f"{data}/ratings.dat")                 # load_data
movies = prep.prep_movies(files.read_movies(spark, f"{data}/movies.dat"))
users = files.read_users(spark, f"{data}/users.dat")
latest = prep.latest_ratings(ratings)                                     # get_user_movie_matrix (long form)

one_movie = spark.createDataFrame([(2,)], "movie_id long")
similarity.similar_items(latest, movies, 5, query_items=one_movie).show()   # get_similar_movies(2)
one_user = spark.createDataFrame([(4,)], "user_id long")
recommend.recommend_for_users(latest, movies, one_user, 5).show()         # get_user_recommendations(4)
stats.top_popular(ratings, movies, 10).show()                             # get_top_popular_movies(10)
stats.genre_recommendations(ratings, movies, ["PROMO"], 5).show()         # get_genre_recommendations
search.by_title(movies, "red widget", 10).show()                          # fuzzy title search
search.advanced(movies, "widget", "economy", "1960-1990").show()          # advanced search
new = validate.stamp_ratings(spark.createDataFrame([(4, 2, "4.5")], "user_id long, movie_id long, rating string"))
validate.valid_new_ratings(new, movies).show()                            # add_new_rating checks
active = stats.active_users(ratings, 10).select("user_id")                # evaluate(k=10, n_folds=5)
folds = evaluate.assign_folds(active, 5)
recs = recommend.user_recommendations(latest, similarity.hybrid_neighbors(latest, movies, 5), 10, users=active)
evaluate.summarize(evaluate.fold_metrics(folds, recs, movies, ratings), 5).show()

spark.stop()
