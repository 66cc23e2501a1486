"""Commit log, concurrent callers, publishing after a crash, and updated neighbour lists."""

import threading

import numpy as np
import pytest

from itemrank.operators import recommend, similarity
from itemrank.session import scratch_path
from itemrank.sources import fixtures, store
from itemrank.streaming import ingest, refresh
from tests.conftest import SF_SMALL

CACHE = "user_id long, n int, rank int, movie_id long, computed_at long, model_version string"


def _cache(spark, *users):
    return {"cache": spark.createDataFrame([(u, 5, 1, 10 * u, 0, None) for u in users], CACHE)}


def test_second_writer_of_one_version_is_told(spark):
    path = scratch_path(spark, "model")
    assert store.read_model(spark, path).number == 0
    store.save_model(spark, path, _cache(spark, 1), expected=0)
    with pytest.raises(store.ConflictError):
        store.save_model(spark, path, _cache(spark, 2), expected=0)
    assert [r.user_id for r in store.load_model(spark, path)["cache"].collect()] == [1]
    assert store.save_model(spark, path, _cache(spark, 3)) == f"{2:020d}"


def test_interleaved_updates_lose_nothing(spark):
    """Both writers read version 1; the second one to publish computes its change again from the first one's."""
    path = scratch_path(spark, "model")
    store.save_model(spark, path, _cache(spark, 0))
    calls = []

    def other(state):
        return {"cache": state["cache"].unionByName(_cache(spark, 2)["cache"])}

    def mine(state):
        calls.append(state.number)
        if len(calls) == 1:
            store.update_model(spark, path, other)  # comes in between
        return {"cache": state["cache"].unionByName(_cache(spark, 1)["cache"])}

    store.update_model(spark, path, mine)
    assert calls == [1, 2]
    assert sorted(r.user_id for r in store.load_model(spark, path)["cache"].collect()) == [0, 1, 2]


def test_concurrent_cache_calls_keep_all_entries(spark):
    latest = spark.createDataFrame([(m, u, 4.0, 5) for u in range(4) for m in range(3)],
                                   "movie_id long, user_id long, rating double, timestamp long")
    similar = spark.createDataFrame([(m, 1, m + 10, 1, "cf") for m in range(3)],
                                    "movie_id long, rank int, neighbor_id long, best_rank int, source string")
    users = latest.select("user_id").distinct()
    path, errors = scratch_path(spark, "cache"), []
    popular = recommend.popular_list(latest, 5)

    def call(n):
        try:
            recommend.recommend_through_cache(spark, path, latest, similar, users, popular, 1000, 60, n, "1")
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=call, args=(n,)) for n in (3, 4, 5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    kept = store.load_model(spark, path)["cache"].select("user_id", "n").distinct().count()
    assert kept == 3 * 4 and store.load_model(spark, path).number == 3


def _events(spark, n_files):
    path = scratch_path(spark, "events")
    fixtures.table(spark, SF_SMALL, "events").repartition(n_files, "event_id").write.parquet(path)
    return lambda: ingest.event_stream(spark, path, max_files=1, pattern="*.parquet")


def test_publishes_after_a_crash_without_new_events(spark, tables, monkeypatch):
    events, sink, path = _events(spark, 4), scratch_path(spark, "log"), scratch_path(spark, "model")
    save, calls = store.save_model, []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("driver lost before the last publish")
        return save(*args, **kwargs)

    monkeypatch.setattr(store, "save_model", failing)
    with pytest.raises(RuntimeError):
        refresh.run_with_refresh(spark, SF_SMALL, tables.ratings, tables.movies, path, 3, None, sink, events())
    assert store.load_model(spark, path).extra["batch_id"] == 2
    refresh.run_with_refresh(spark, SF_SMALL, tables.ratings, tables.movies, path, 3, None, sink, events())
    state = store.load_model(spark, path)
    assert state.extra["batch_id"] == 3 and len(calls) == 3
    want = ingest.merged_latest(tables.ratings, ingest.IngestResult(sink).valid(spark))
    cols = ["movie_id", "user_id", "rating"]
    assert sorted(map(tuple, state["matrix"].select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    refresh.run_with_refresh(spark, SF_SMALL, tables.ratings, tables.movies, path, 3, None, sink, events())
    assert len(calls) == 3  # nothing new, nothing published


def _lists(df):
    return sorted((r.movie_id, r["rank"], r.neighbor_id, round(r.distance, 5)) for r in df.collect())


def test_updated_lists_equal_a_full_search_and_touch_few(spark, monkeypatch):
    """Groups of movies with raters of their own: a change in one group makes few lists anew."""
    rng = np.random.default_rng(5)
    rows = {(int(m), int(20 * (m // 20) + u)): float(rng.integers(1, 11)) / 2
            for m in range(300) for u in rng.choice(20, rng.integers(3, 9), replace=False)}

    def frame(d):
        return spark.createDataFrame([(m, u, r) for (m, u), r in d.items()], "movie_id long, user_id long, rating double")

    before = similarity.cf_neighbors(frame(rows), 4).checkpoint()
    changed = dict(rows)
    for key in [k for k in rows if k[1] in (5, 6)]:
        changed[key] = 5.5 - changed[key]
    changed[(19, 7)] = 0.5
    raters = spark.createDataFrame([(5,), (6,), (7,)], "user_id long")
    asked = []
    search = similarity.knn.top_k_neighbors
    monkeypatch.setattr(similarity.knn, "top_k_neighbors",
                        lambda *a, **kw: (asked.append((kw["queries"].count(), "candidates" in kw)), search(*a, **kw))[1])
    after = similarity.updated_cf_neighbors(before, frame(changed), raters, 4)
    assert len(asked) == 2 and asked[0][0] < 150 and asked[1][1]
    monkeypatch.undo()
    assert _lists(after) == _lists(similarity.cf_neighbors(frame(changed), 4)) != _lists(before)


def test_base_ratings_are_written_once_for_all_publications(spark, tables, monkeypatch):
    """Every publication reads the base ratings from the same files, not from the lineage of the base tables."""
    inner, files = refresh.refresh_tables, []

    def spy(ratings, *args):
        files.append(sorted(ratings.inputFiles()))
        return inner(ratings, *args)

    monkeypatch.setattr(refresh, "refresh_tables", spy)
    base = tables.ratings.limit(500).localCheckpoint()
    refresh.run_with_refresh(spark, SF_SMALL, base, tables.movies, scratch_path(spark, "model"), 3, None,
                             scratch_path(spark, "log"), _events(spark, 4)())
    assert len(files) == 2 and files[0] and files[0] == files[1]


def test_features_and_neighbours_share_the_scaled_cells(spark, monkeypatch):
    inner, calls = refresh.prep.normalized_ratings, []
    monkeypatch.setattr(refresh.prep, "normalized_ratings", lambda latest: calls.append(1) or inner(latest))
    rows = [(u, m, 1.0 + (u * m) % 4, 10) for u in range(9) for m in range(12) if (u + m) % 3]
    ratings = spark.createDataFrame(rows, "user_id long, movie_id long, rating double, timestamp long")
    tables = refresh.refresh_tables(ratings, ratings.limit(0), 3)
    assert tables["features"].count() == len(rows) and tables["neighbors"].count() == 12 * 3
    assert len(calls) == 1


@pytest.mark.parametrize("every", [False, True])
def test_searches_of_an_update_share_the_stored_items(spark, monkeypatch, every):
    """Vectors and items are written once for both searches; there is one search where every list is made anew."""
    from itemrank.operators import knn, routed

    rows = [(m, 10 * (m // 10) + u, 0.5 + (m * u) % 9 / 2) for m in range(60) for u in range(10) if (m + u) % 3]
    latest = spark.createDataFrame(rows, "movie_id long, user_id long, rating double").cache()
    raters = spark.createDataFrame([(u,) for u in range(60 if every else 2)], "user_id long")
    before = similarity.cf_neighbors(latest, 3).checkpoint()
    names, asked, write, search = [], [], knn.written, knn.top_k_neighbors
    for module in (knn, routed):
        monkeypatch.setattr(module, "written", lambda df, name: names.append(name) or write(df, name))
    monkeypatch.setattr(knn, "SENT_ENTRIES", 0)
    monkeypatch.setattr(knn, "top_k_neighbors", lambda *a, **kw: asked.append(1) or search(*a, **kw))
    after = similarity.updated_cf_neighbors(before, latest, raters, 3, 1.0)
    assert _lists(after) == _lists(before)
    assert (names.count("knn-vectors"), names.count("knn-items"), len(asked)) == (1, 1, 1 if every else 2)
