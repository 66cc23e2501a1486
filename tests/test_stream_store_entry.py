import os

from itemrank.operators import merge, validate
from itemrank.session import scratch_path
from itemrank.sources import files, store
from itemrank.streaming import ingest
from tests.conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_stream_equals_batch(spark, tables):
    res = ingest.run_ingest(spark, SF_SMALL, tables.movies)
    batch = validate.valid_new_ratings(tables.rating_events, tables.movies)
    cols = ["event_id", "user_id", "movie_id", "rating", "timestamp"]
    assert _rows(res.valid(spark), cols) == _rows(batch, cols)
    merged = ingest.merged_latest(tables.ratings, res.valid(spark))
    assert _rows(merged, ["movie_id", "user_id", "rating"]) == _rows(
        merge.merge_latest(tables.ratings, batch), ["movie_id", "user_id", "rating"])
    assert res.progress(spark).count() >= 1


def test_replayed_batch_is_idempotent(spark, tables):
    sink = scratch_path(spark, "replay")
    ingest.run_ingest(spark, SF_SMALL, tables.movies, sink=sink)
    first = spark.read.parquet(f"{sink}/valid").count()
    # a second run from the same checkpoint processes nothing new
    ingest.run_ingest(spark, SF_SMALL, tables.movies, sink=sink)
    assert spark.read.parquet(f"{sink}/valid").count() == first


def test_merge_sum_is_literal(spark):
    latest = spark.createDataFrame([(1, 1, 4.0)], "movie_id long, user_id long, rating double")
    new = spark.createDataFrame([(1, 1, 4.0, 9), (1, 1, 2.0, 9), (2, 1, 3.0, 9)],
                                "user_id long, movie_id long, rating double, timestamp long")
    got = {(r.movie_id, r.user_id): r.rating for r in merge.merge_sum(latest, new).collect()}
    assert got == {(1, 1): 7.0, (1, 2): 3.0}  # keys are (movie_id, user_id)


def test_latin1_movie_titles_round_trip(spark):
    movies = spark.createDataFrame([(1, "Amélie (2001)", "Comedy|Romance"), (2, "Señor Plain (1990)", "Drama")],
                                   "movie_id long, title string, genres string")
    path = scratch_path(spark, "dat-latin1")
    files.write_movies_dat(movies, path)
    assert sorted(map(tuple, files.read_movies(spark, path).collect())) == sorted(map(tuple, movies.collect()))


def test_dat_readers_round_trip(spark, tables):
    path = scratch_path(spark, "dat")
    files.write_movies_dat(tables.movies_raw, path)
    back = files.read_movies(spark, path)
    assert _rows(back, ["movie_id", "title", "genres"]) == _rows(tables.movies_raw, ["movie_id", "title", "genres"])


def test_model_store_versions(spark, tables):
    path = scratch_path(spark, "model")
    assert store.load_model(spark, path).empty
    store.save_model(spark, path, {"movie_ids": tables.movies.select("movie_id")})
    v2 = store.save_model(spark, path, {"movie_ids": tables.movies.select("movie_id").limit(3)})
    m = store.load_model(spark, path)
    assert m.version == v2 and m["movie_ids"].count() == 3


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    training_data = {k for k in qs if k == "pipeline" or k.startswith("op")}
    assert set(qs) - set(sql) - training_data <= {"ann_neighbors"}
    assert os.path.isdir(SF_SMALL)
