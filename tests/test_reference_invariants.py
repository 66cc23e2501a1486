"""Invariants the reference's own unit tests assert, on our DataFrame API."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemrank.operators import prep, recommend, similarity, stats, validate
from itemrank.session import scratch_path
from itemrank.streaming import ingest
from tests.conftest import SF_SMALL


def test_matrix_width_equals_distinct_users(tables):
    users_in_matrix = tables.latest.select("user_id").distinct().count()
    assert users_in_matrix == tables.ratings.select("user_id").distinct().count()


def test_ids_are_integers(tables):
    fields = {f.name: f.dataType for f in tables.ratings.schema.fields}
    assert isinstance(fields["user_id"], T.LongType) and isinstance(fields["movie_id"], T.LongType)
    assert isinstance(fields["rating"], T.DoubleType)


def test_item_info_keys_and_unknown_id(tables):
    info = prep.item_info(tables.movies)
    assert info.columns == ["movie_id", "title", "genres", "year"]
    assert info.where(F.col("movie_id") == -1).count() == 0


def test_status_keys_and_queue_size(tables):
    pending = validate.valid_new_ratings(tables.rating_events, tables.movies)
    row = stats.system_status(tables.ratings, tables.movies, queue=pending).first().asDict()
    assert set(row) == {"total_ratings", "total_users", "total_movies", "batch_queue_size", "is_updating",
                        "last_update_time"}
    assert row["batch_queue_size"] == pending.count()
    assert row["total_movies"] == tables.movies.count()


def test_unknown_user_gets_a_list(spark, tables):
    stranger = spark.createDataFrame([(-1,)], "user_id long")
    recs = recommend.cold_start_recommendations(stranger, tables.ratings, 5)
    assert recs.count() == 5


def test_cache_hit_serves_stored_lists(spark, tables):
    sim = similarity.similar_items(tables.latest, tables.movies, 5)
    recs = recommend.user_recommendations(tables.latest, sim, 5)
    now = 1_000_000
    cache = recommend.build_cache(recs, 5, F.lit(now - 10))  # all fresh
    out = recommend.cached_recommendations(cache, tables.latest, sim, now, 1800, 5)
    assert out.where(~F.col("from_cache")).count() == 0
    assert out.count() == recs.count()
    stale = recommend.build_cache(recs, 5, F.lit(now - 3600))
    out2 = recommend.cached_recommendations(stale, tables.latest, sim, now, 1800, 5)
    assert out2.where(F.col("from_cache")).count() == 0
    assert out2.count() == recs.count()


def test_trigger_processes_files_in_micro_batches(spark, tables):
    # two event files derived from the events table; one file per trigger
    src = scratch_path(spark, "events-src")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.where("event_id % 2 = 0").coalesce(1).write.parquet(f"{src}/part=a")
    ev.where("event_id % 2 = 1").coalesce(1).write.parquet(f"{src}/part=b")
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", "1")
              .option("recursiveFileLookup", "true").parquet(src))
    from itemrank.sources import fixtures

    checked = ingest.checked_events(fixtures.rating_events_from(stream), tables.movies)
    sink = scratch_path(spark, "events-sink")
    q = (checked.writeStream.foreachBatch(ingest._write_batch(sink))
         .option("checkpointLocation", f"{sink}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 2
    got = spark.read.parquet(f"{sink}/valid").count()
    assert got == validate.valid_new_ratings(tables.rating_events, tables.movies).count()


def test_update_mode_stats_across_micro_batches(spark, tables):
    src = scratch_path(spark, "events-src2")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.where("event_id % 2 = 0").coalesce(1).write.parquet(f"{src}/part=a")
    ev.where("event_id % 2 = 1").coalesce(1).write.parquet(f"{src}/part=b")
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", "1")
              .option("recursiveFileLookup", "true").parquet(src))
    path = ingest.run_popularity_state(spark, SF_SMALL, tables.movies, raw_events=stream)
    changes = spark.read.parquet(path)
    assert changes.select("batch_id").distinct().count() == 2
    got = {r.movie_id: (r.n, round(r.s, 9), r.last) for r in ingest.stream_stats(changes).collect()}
    valid = validate.valid_new_ratings(tables.rating_events, tables.movies)
    want = {r.movie_id: (r.n, round(r.s, 9), r.last) for r in valid.groupBy("movie_id").agg(
        F.count("rating").alias("n"), F.sum("rating").alias("s"), F.max("timestamp").alias("last")).collect()}
    assert got == want


def test_log_compaction_equals_merge_on_read(spark, tables):
    from itemrank.operators import merge

    src = scratch_path(spark, "events-src3")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.where("event_id % 2 = 0").coalesce(1).write.parquet(f"{src}/part=a")
    ev.where("event_id % 2 = 1").coalesce(1).write.parquet(f"{src}/part=b")
    sink = scratch_path(spark, "compact-sink")
    model = scratch_path(spark, "compact-model")
    from itemrank.sources import fixtures

    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", "1")
              .option("recursiveFileLookup", "true").parquet(src))
    checked = ingest.checked_events(fixtures.rating_events_from(stream), ingest.catalogue_ids(tables.movies))
    q = (checked.writeStream.foreachBatch(ingest._write_batch(sink))
         .option("checkpointLocation", f"{sink}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    ingest.compact_log(spark, sink, tables.ratings, model)
    cols = ["movie_id", "user_id", "rating", "timestamp"]
    valid = validate.valid_new_ratings(tables.rating_events, tables.movies)
    want = merge.merge_latest(tables.ratings, valid)
    got = ingest.read_merged(spark, sink, tables.ratings, model)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    # a later batch (re-ratings) lands after the compaction, then a second compaction
    later = valid.where("event_id % 3 = 0").withColumn("timestamp", F.col("timestamp") + 10**9) \
        .withColumn("rating", F.lit(0.5))
    later.select("event_id", "user_id", "movie_id", "rating", "timestamp").write.parquet(
        f"{sink}/valid/batch_id=99")
    want2 = merge.merge_latest(tables.ratings, valid.unionByName(later))
    for _ in range(2):
        got2 = ingest.read_merged(spark, sink, tables.ratings, model)
        assert sorted(map(tuple, got2.select(cols).collect())) == sorted(map(tuple, want2.select(cols).collect()))
        ingest.compact_log(spark, sink, tables.ratings, model)
