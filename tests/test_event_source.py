"""The event folder as a source, and size-or-time micro-batches."""

import collections
import time

from pyspark.sql import functions as F

from itemrank.operators import validate
from itemrank.session import scratch_path
from itemrank.sources import event_folder, fixtures
from itemrank.streaming import batching, ingest
from tests.conftest import SF_SMALL

COLS = ["event_id", "user_id", "movie_id", "rating", "timestamp"]


def _folder(spark, parts=4):
    path = scratch_path(spark, "event-folder")
    events = fixtures.table(spark, SF_SMALL, "events")
    event_folder.append_events(spark, path, events.where("event_id % 2 = 0").repartition(parts))
    event_folder.append_events(spark, path, events.where("event_id % 2 = 1").repartition(parts))
    return path


def _counted(df):
    return collections.Counter(tuple(r) for r in df.select(COLS).collect())


def test_folder_read_as_a_table(spark):
    path = _folder(spark)
    want = fixtures.table(spark, SF_SMALL, "events")
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    got = event_folder.read_event_folder(spark, path).select(cols)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(map(tuple, want.select(cols).collect()))
    assert got.rdd.getNumPartitions() == 8
    empty = scratch_path(spark, "event-folder")
    event_folder.append_events(spark, empty, want.where("event_id < 0"))
    assert event_folder.read_event_folder(spark, empty).count() == 0


def test_stream_equals_batch_and_goes_on_after_new_files(spark, tables):
    path, sink = _folder(spark), scratch_path(spark, "log")
    for _ in range(2):
        result = ingest.run_ingest(spark, SF_SMALL, tables.movies, sink=sink,
                                   raw_events=event_folder.event_folder_stream(spark, path))
        want = validate.valid_new_ratings(fixtures.rating_events_from(event_folder.read_event_folder(spark, path)), tables.movies)
        assert _counted(result.valid(spark)) == _counted(want)
        more = fixtures.table(spark, SF_SMALL, "events").where("event_id % 7 = 0").withColumn("event_id", F.col("event_id") + 10 ** 6)
        event_folder.append_events(spark, path, more)


def test_admission_limit_crash_and_replay(spark, tables):
    """Two files a micro-batch; the third one fails half way; the restart reads every file exactly once."""
    path, sink = _folder(spark), scratch_path(spark, "log")
    movies = ingest.catalogue_ids(tables.movies)
    write = ingest._write_batch(sink)

    def crash(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 2:
            raise RuntimeError("driver lost")

    def run(handler):
        events = fixtures.rating_events_from(event_folder.event_folder_stream(spark, path, 2, f"{path}-progress"))
        q = (ingest.checked_events(events, movies).writeStream.foreachBatch(handler)
             .option("checkpointLocation", f"{sink}/_checkpoint").trigger(processingTime="100 milliseconds").start())
        end = time.monotonic() + 120
        while q.isActive and time.monotonic() < end:
            logged = ingest.IngestResult(sink).progress(spark).agg(F.sum("num_input_rows")).first()[0]
            if handler is write and logged == total:
                break
            time.sleep(0.3)
        q.stop()

    total = event_folder.read_event_folder(spark, path).count()
    run(crash)
    result = ingest.IngestResult(sink)
    assert result.progress(spark).count() == 3
    run(write)
    want = validate.valid_new_ratings(fixtures.rating_events_from(event_folder.read_event_folder(spark, path)), tables.movies)
    assert _counted(result.valid(spark)) == _counted(want)


def test_batches_by_size_and_by_time(spark):
    """250 events: two batches by size, then one by time; what comes later makes a new batch by time."""
    path = scratch_path(spark, "events")
    rows = fixtures.rating_events(spark, SF_SMALL).limit(280).collect()
    frame = spark.createDataFrame(rows, fixtures.rating_events(spark, SF_SMALL).schema)

    def put(lo, hi):
        spark.createDataFrame(rows[lo:hi], frame.schema).coalesce(1).write.mode("append").parquet(path)

    put(0, 250)
    events = spark.readStream.schema(frame.schema).parquet(path)
    query, table = batching.start(spark, events, size=100, wait_seconds=2, lanes=1)
    try:
        batching.wait_for(spark, query, table, 250)
        put(250, 280)
        batching.wait_for(spark, query, table, 280)
    finally:
        batching.stop(query)
    got = batching.read_batches(spark, table)
    sizes = {r.batch: (r.set_off_by, r["count"]) for r in got.groupBy("batch", "set_off_by").count().collect()}
    assert sizes == {0: ("size", 100), 1: ("size", 100), 2: ("time", 50), 3: ("time", 30)}
    assert _counted(got) == _counted(frame)
