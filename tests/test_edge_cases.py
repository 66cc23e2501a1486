"""Quoted files, untyped events, zero vectors, long queries, the stored cache, streams of several batches."""

import random

import pytest
from pyspark.sql import functions as F

from itemrank import schemas
from itemrank.functions import text
from itemrank.operators import recommend, similarity, validate
from itemrank.sources import files


def test_quotes_are_text(spark, tmp_path):
    lines = ['1::"Great Performances" Cats (1998)::Musical', '6::"E (1996)::Drama', '7::"Whole"::A|B', "bad::B (1990)::Drama"]
    (tmp_path / "movies.dat").write_text("\n".join(lines), encoding="latin-1")
    got = files.read_movies(spark, str(tmp_path)).orderBy("movie_id").collect()
    assert [tuple(r) for r in got] == [(1, '"Great Performances" Cats (1998)', "Musical"), (6, '"E (1996)', "Drama"),
                                       (7, '"Whole"', "A|B")]
    assert files.read_movies(spark, str(tmp_path)).count() == 3
    bad = files.corrupt_lines(spark, str(tmp_path), schemas.MOVIES_RAW, files.MOVIES_ENCODING).collect()
    assert [r.line for r in bad] == ["bad::B (1990)::Drama"]
    out = str(tmp_path / "out")
    files.write_movies_dat(files.read_movies(spark, str(tmp_path / "movies.dat")), out)
    assert sorted(map(tuple, files.read_movies(spark, out).collect())) == sorted(map(tuple, got))


@pytest.mark.parametrize("schema,row,reason", [
    ("user_id double, movie_id double, rating double, timestamp double", (1.7, 2.0, 3.0, 5.0), "user_id_not_whole"),
    ("user_id double, movie_id double, rating double, timestamp double", (1.0, 2.9, 3.0, 5.0), "movie_id_not_whole"),
    ("user_id double, movie_id double, rating double, timestamp double", (1.0, 2.0, 3.0, 5.6), "timestamp_not_whole"),
    ("user_id double, movie_id double, rating double, timestamp double", (1.0, 2.0, 3.0, 5.0), None),
    ("user_id boolean, movie_id long, rating double, timestamp long", (True, 2, 3.0, 5), "user_id_not_whole"),
    ("user_id long, movie_id long, rating boolean, timestamp long", (1, 2, True, 5), "rating_not_a_number"),
    ("user_id string, movie_id string, rating string, timestamp string", ("1", "2", "4.5", "5"), None),
])
def test_typed_checks(spark, schema, row, reason):
    got = validate.with_reject_reason(spark.createDataFrame([row], schema)).first()
    assert got.reject_reason == reason


def test_zero_vector_is_a_neighbour(spark):
    vectors = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [5.0, 5.0])], "id long, v array<double>")
    got = {(r.id, r.neighbor_id): r.distance for r in similarity.vector_neighbors(vectors, "id", "v", 1).collect()}
    assert got == {(1, 2): 1.0, (2, 1): 1.0, (3, 2): 41.0}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


@pytest.mark.parametrize("length", [1, 61, 62, 63, 124, 125, 200])
def test_lcs_of_any_length(spark, length):
    rng = random.Random(length)
    query = "".join(rng.choice("abcd ") for _ in range(length))
    titles = ["", query, query[::-1]] + ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 150))) for _ in range(5)]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = [r[0] for r in df.select(text.lcs_length_const(F.col("t"), query)).collect()]
    assert got == [lcs(t, query) for t in titles]


def test_cache_is_written_back_and_expires(spark, tmp_path):
    latest = spark.createDataFrame([(1, 1, 5.0, 1), (2, 2, 4.0, 1)], "user_id long, movie_id long, rating double, timestamp long")
    similar = spark.createDataFrame([(1, 1, 9), (2, 1, 8)], "movie_id long, rank int, neighbor_id long")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    popular = F.array(F.struct(F.lit(1).alias("rank"), F.lit(7).cast("long").alias("movie_id")))
    def call(now, version="1"):
        out = recommend.recommend_through_cache(spark, str(tmp_path / "cache"), latest, similar, users, popular, now, 100, 1, version)
        return sorted((r.user_id, r.movie_id, r.from_cache) for r in out.collect())
    assert call(1000) == [(1, 9, False), (2, 8, False), (3, 7, False)]
    assert call(1050) == [(1, 9, True), (2, 8, True), (3, 7, True)]
    assert call(1060, "2") == [(1, 9, False), (2, 8, False), (3, 7, False)]  # a new model expires them
    assert call(1100, "2") == [(1, 9, True), (2, 8, True), (3, 7, True)]
    assert call(1161, "2") == [(1, 9, False), (2, 8, False), (3, 7, False)]  # older than the TTL
