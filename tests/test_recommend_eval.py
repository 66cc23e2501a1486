from pyspark.sql import functions as F

from itemrank.operators import evaluate, recommend, similarity, stats


def test_similar_items_only_for_rated_movies(tables):
    sim = similarity.similar_items(tables.latest, tables.movies, 5)
    rated = tables.latest.select("movie_id").distinct()
    assert sim.join(rated, "movie_id", "left_anti").count() == 0
    per = sim.groupBy("movie_id").count().agg(F.max("count")).first()[0]
    assert per <= 5
    assert sim.where(F.col("movie_id") == F.col("neighbor_id")).count() == 0
    # unknown id -> empty
    assert sim.where(F.col("movie_id") == -1).count() == 0


def test_user_recommendations_exclude_rated(tables):
    sim = similarity.similar_items(tables.latest, tables.movies, 5)
    recs = recommend.user_recommendations(tables.latest, sim, 5)
    assert recs.join(tables.latest, ["user_id", "movie_id"], "left_semi").count() == 0
    assert recs.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 5
    assert recs.groupBy("user_id", "movie_id").count().where("count > 1").count() == 0


def test_cold_start_gets_popular(tables):
    cold = recommend.cold_start_recommendations(tables.users, tables.ratings, 5)
    top = [r.movie_id for r in stats.top_popular(tables.ratings, tables.movies, 5).orderBy("rank").collect()]
    some = cold.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("rank", "movie_id"))).alias("l")).first()
    assert [x.movie_id for x in some.l] == top
    assert stats.top_popular(tables.ratings, tables.movies, 10).count() <= 10


def test_fallback_covers_every_user(tables):
    sim = similarity.similar_items(tables.latest, tables.movies, 5)
    out = recommend.recommendations_with_fallback(tables.users, tables.ratings, tables.latest, sim, 5, 10)
    assert out.select("user_id").distinct().count() == tables.users.select("user_id").distinct().count()


def test_folds_equal_sizes(tables):
    active = stats.active_users(tables.ratings, 10).select("user_id")
    folds = evaluate.assign_folds(active, 5, "42")
    sizes = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert folds.count() == active.count()


def test_metrics_ranges_and_empty_lists(spark, tables):
    folds = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "user_id long, fold int")
    recs = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 1, 4)],
                                 "user_id long, rank int, movie_id long")
    m = {r.user_id: r for r in evaluate.per_user_metrics(folds, recs, tables.movies, tables.ratings).collect()}
    assert 0.0 <= m[1].diversity <= 1.0
    assert m[1].novelty >= 0.0
    assert m[2].diversity == 0.0  # fewer than two items
    assert m[3].diversity == 0.0 and m[3].novelty == 0.0  # empty list still counted
    summary = {r.metric: r for r in evaluate.summarize(
        evaluate.fold_metrics(folds, recs, tables.movies, tables.ratings), 2).collect()}
    assert set(summary) == {"coverage", "diversity", "novelty"}
    for r in summary.values():
        assert r.ci_lower <= r.mean <= r.ci_upper


def test_ann_recall(tables):
    exact = similarity.cf_neighbors(tables.latest, 5)
    ann = similarity.ann_neighbors(tables.latest, 5)
    hit = ann.join(exact, ["movie_id", "neighbor_id"]).count()
    assert hit / exact.count() > 0.95


def test_dense_index_is_a_global_permutation(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v"), F.col("id").alias("k"))
    idx = evaluate.dense_index(df, [F.col("v"), F.col("k")], partitions=7)
    got = sorted((r.v, r.idx) for r in idx.collect())
    assert [i for _, i in got] == list(range(1000))  # position == rank of the order key


def test_ntile_formula_matches_sql(spark):
    df = spark.range(0, 23).withColumnRenamed("id", "user_id")
    from pyspark.sql import Window

    sql = df.withColumn("fold", F.ntile(5).over(Window.orderBy("user_id")))
    ours = evaluate.dense_index(df, [F.col("user_id")], partitions=3).select(
        "user_id", evaluate.ntile_from_index(F.col("idx"), 23, 5).alias("fold"))
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, ours.collect()))


def test_per_user_path_equals_batch_rows(spark, tables):
    users = tables.latest.select("user_id").distinct().orderBy("user_id").limit(3)
    ids = [r.user_id for r in users.collect()]
    one = recommend.recommend_for_users(tables.latest, tables.movies, users, 5)
    sim = similarity.hybrid_neighbors(tables.latest, tables.movies, 5)
    full = recommend.user_recommendations(tables.latest, sim, 5).where(F.col("user_id").isin(ids))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, full.collect()))
    one_item = similarity.similar_items(tables.latest, tables.movies, 5,
                                        query_items=spark.createDataFrame([(ids[0] % 7 + 1,)], "movie_id long"))
    assert one_item.select("movie_id").distinct().count() <= 1


def test_ntile_with_fewer_rows_than_buckets(spark):
    from pyspark.sql import Window

    df = spark.range(0, 3).withColumnRenamed("id", "user_id")
    sql = df.withColumn("fold", F.ntile(5).over(Window.orderBy("user_id")))
    ours = evaluate.dense_index(df, [F.col("user_id")], partitions=2).select(
        "user_id", evaluate.ntile_from_index(F.col("idx"), 3, 5).alias("fold"))
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, ours.collect()))


def test_knn_on_empty_input(spark):
    from itemrank.operators import knn

    empty = spark.createDataFrame([], "item_id long, key long, weight double")
    assert knn.top_k_neighbors(empty, 5, "l2").count() == 0


def test_diversity_hand_computed(spark):
    movies = spark.createDataFrame(
        [(1, ["A", "B"]), (2, ["B", "C", "C"]), (3, []), (4, []), (5, ["A"])],
        "movie_id long, genres array<string>")
    recs = spark.createDataFrame(
        [(1, 1, 1), (1, 2, 2), (1, 3, 5),      # pairs: 1-1/3, 1-1/2, 1-0/3
         (2, 1, 3), (2, 2, 4), (2, 3, 1),      # 3-4 both empty: skipped; 3-1, 4-1: distance 1
         (3, 1, 3), (3, 2, 4),                 # only an empty pair: no counted pair
         (4, 1, 99), (4, 2, 1),                # 99 not in the catalogue: empty set
         (5, 1, 2)],                           # one item: no pair
        "user_id long, rank int, movie_id long")
    got = {r.user_id: r.diversity for r in evaluate.user_diversity(recs, movies).collect()}
    assert set(got) == {1, 2, 4}
    assert abs(got[1] - ((1 - 1 / 3) + (1 - 1 / 2) + 1.0) / 3) < 1e-12
    assert got[2] == 1.0 and got[4] == 1.0


def test_fallback_sources_match_plain_split(tables):
    sim = similarity.similar_items(tables.latest, tables.movies, 5)
    personal = recommend.user_recommendations(tables.latest, sim, 5)
    out = recommend.recommendations_with_fallback(tables.users, tables.ratings, tables.latest, sim,
                                                  5, 10, personal=personal)
    per = {r.user_id: (r.s, r.c) for r in out.groupBy("user_id").agg(
        F.collect_set("source").alias("s"), F.count("*").alias("c")).collect()}
    with_personal = {r.user_id: r.c for r in personal.groupBy("user_id").agg(F.count("*").alias("c")).collect()}
    rated = {r.user_id for r in tables.ratings.select("user_id").distinct().collect()}
    everyone = rated | {r.user_id for r in tables.users.select("user_id").collect()}
    assert set(per) == everyone
    for u, (sources, c) in per.items():
        if u in with_personal:
            assert sources == ["personal"] and c == with_personal[u]
        elif u in rated:
            assert sources == ["popular"] and c == 10
        else:
            assert sources == ["cold_start"] and c == 5


def test_approximate_search_sends_few_windows_twice(spark, monkeypatch):
    """Eight pairs of windows a task: only the windows between two tasks travel twice, and the lists stay the same."""
    from itemrank.operators import knn

    rows = [(m, (m * 7 + u * u) % 90, 1.0 + (m * u) % 5, 100) for m in range(200) for u in range(6)]
    latest = spark.createDataFrame(rows, "movie_id long, user_id long, rating double, timestamp long").dropDuplicates(
        ["movie_id", "user_id"]).cache()
    inner, sent = knn._run_per_group, []

    def spy(rows, *args):
        sent.append(rows.count())
        return inner(rows, *args)

    monkeypatch.setattr(knn, "_run_per_group", spy)
    monkeypatch.setattr(knn, "_parallelism", lambda df: 1)

    def lists(low):
        got = similarity.ann_neighbors(latest, 3, window=10, low_norms=low).orderBy("movie_id", "rank").collect()
        return [(r.movie_id, r["rank"], r.neighbor_id) for r in got]

    one, low = lists(0), lists(4)
    assert sent == [2 * (200 + 2 * 10), 2 * (200 + 2 * 10) + 4 * 2 * 3]
    monkeypatch.setattr(similarity, "ANN_WINDOWS", 1)
    assert (lists(0), lists(4)) == (one, low)
