"""Substring dedup: repeated word windows found by compressed FM-indexes, one per shard.

Sharding.  Equal windows must meet in one shard without every document being
searched in every shard.  Each window is filed under the least hash of its
``GRAM``-word grams; consecutive windows with the same least gram (the same
place) form a run of at most ``size - GRAM + 1`` windows.  Equal windows have
the same least gram, so a key that only one run has can't hold a repeat and
is dropped.  Runs with equal words fold into one segment with a weight, so
copies cost one segment whatever their number.

Shards.  Segments are dealt out by key; a task takes whole keys until a shard
has about ``SHARD_WORDS`` words, numbers the shard's words, builds an FM-index
(``fmindex``) and streams the segments through backward search, which gives
the matching statistics and the windows that occur at least twice by weight.

Hot keys.  A passage that very many documents hold has equal segments inside
(one by weight) but a different one in each document at its borders.  A key
with more than ``HOT`` different segments is split: each of its windows is
filed by its own hash, again folded by weight, and goes through the same
index.  No window is dropped on either way, so the result is exact.

Results are intervals of each document's words.  Whole texts are used, at any
length.  Nulls and empty texts: no words, nothing removed, the hash of the
empty string.  Rows are numbered once and told apart by their number: repeated
rows, null ids and rows that share an id are documents like any others.  Empty
tables give empty results.  Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .fmindex import FMIndex
from .textops import _power_tables, as_long, blank_separated, mix, ngram_hashes, text_chunks

SIZE = 35
GRAM = 8
HOT = 256
SHARD_WORDS = 200_000


def _least_grams(grams: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Least value, and its first place, in every run of ``span`` grams (doubling)."""
    value, place, k = grams, np.arange(len(grams)), 1
    while k < span:
        step = min(k, span - k)
        left, right = value[:-step], value[step:]
        first = left <= right
        value, place = np.where(first, left, right), np.where(first, place[:-step], place[step:])
        k += step
    return value, place


def _prefix_hash(h: np.ndarray) -> np.ndarray:
    power, _ = _power_tables(len(h) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:len(h)], dtype=np.uint64)])


def _slice_hash(sums: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    _, inverse = _power_tables(len(sums))
    return mix((sums[start + length] - sums[start]) * inverse[start] + length.astype(np.uint64))


def _runs(batches, size, gram):
    """(row, text) -> (key, segment hash, row, start, n) per run of windows."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for w in text_chunks(batch.column(1), blank_separated()):
            counts = w.counts()
            if not (counts >= size).any():
                continue
            h = w.hashes()
            value, place = _least_grams(ngram_hashes(h, gram), size - gram + 1)
            windows = np.maximum(counts - size + 1, 0)
            text = np.repeat(np.arange(w.n), windows)
            at = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + w.offsets[text]
            new = np.ones(len(at), bool)
            new[1:] = (place[at[1:]] != place[at[:-1]]) | (text[1:] != text[:-1])
            begin = np.flatnonzero(new)
            n = np.diff(np.append(begin, len(at)))
            start, doc = at[begin], text[begin]
            yield pa.RecordBatch.from_arrays([
                as_long(mix(value[start])), as_long(_slice_hash(_prefix_hash(h), start, n + size - 1)),
                pa.array(ids[w.first + doc], pa.int64()), pa.array(start - w.offsets[doc], pa.int32()), pa.array(n, pa.int32())],
                names=["key", "seg", "row", "start", "n"])


_SEGMENT = pa.struct([("key", pa.int64()), ("run", pa.int64()), ("seg", pa.int64()), ("i", pa.int32()), ("weight", pa.int64()),
                      ("words", pa.string())])


def _texts(batches, size):
    """Documents with the segments they stand for -> figures of the whole text and the segments' words.

    A segment of a hot key comes out as its single windows, filed by their own hash.
    """
    for batch in batches:
        table = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        n_words, shas, segments = [], [], []
        for lo in range(0, batch.num_rows, 512):
            texts = table["text"].slice(lo, 512).to_pylist()
            asked = table["asked"].slice(lo, 512).to_pylist()
            for text, ask in zip(texts, asked, strict=True):
                words = (text or "").encode().split()
                n_words.append(len(words))
                shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
                out = []
                for a in ask or ():
                    own = words[a["start"]:a["start"] + a["n"] + size - 1]
                    if a["hot"]:
                        for i in range(a["n"]):
                            win = b" ".join(own[i:i + size])
                            key = int.from_bytes(hashlib.blake2b(win, digest_size=8).digest(), "little", signed=True)
                            out.append({"key": key, "run": a["key"], "seg": a["seg"], "i": i, "weight": a["weight"],
                                        "words": win.decode()})
                    else:
                        out.append({"key": a["key"], "run": a["key"], "seg": a["seg"], "i": -1, "weight": a["weight"],
                                    "words": b" ".join(own).decode()})
                segments.append(out)
        yield pa.RecordBatch.from_arrays([
            table["doc_id"], table["row"], pa.array(n_words, pa.int64()), pa.array(shas, pa.string()),
            pc.if_else(table["affected"], table["text"], None), pa.array(segments, pa.list_(_SEGMENT))],
            names=["doc_id", "row", "n_words", "sha", "text", "segments"])


def _solve(pieces: list[tuple], size: int) -> pa.RecordBatch:
    """One shard: the starts of repeated windows of those segments that have any."""
    keys, segs, weights = (np.concatenate([p[i] for p in pieces]) for i in (0, 1, 3))
    words = pc.split_pattern(pa.chunked_array([p[2] for p in pieces]).combine_chunks(), " ")
    lengths = np.diff(words.offsets.to_numpy()).astype(np.int64)
    numbers = words.flatten().dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    owner, start = FMIndex.of(numbers, lengths, weights).repeated_runs(size)
    some, first = np.unique(owner, return_index=True)
    offsets = pa.array(np.append(first, len(owner)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[some], pa.int64()), pa.array(segs[some], pa.int64()),
         pa.ListArray.from_arrays(offsets, pa.array(start, pa.int32()))], names=["key", "seg", "starts"])


def _search(batches, size, shard_words):
    """Segments sorted by key -> (key, words hash, starts of repeated windows) of those that have any."""
    held, words, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, segs, weights = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1, 3))
        texts = batch.column(2)
        total = np.concatenate([[0], np.cumsum(pc.count_substring(texts, " ").to_numpy().astype(np.int64) + 1)])
        begins = np.flatnonzero(np.concatenate([[keys[0] != last], keys[1:] != keys[:-1]]))
        at = 0
        while True:  # a shard ends where a key ends, once it is full
            cut = begins[np.searchsorted(begins, np.searchsorted(total, total[at] + shard_words - words)):]
            stop = int(cut[0]) if len(cut) else batch.num_rows
            if stop > at:
                held.append((keys[at:stop], segs[at:stop], texts.slice(at, stop - at), weights[at:stop]))
                words += int(total[stop] - total[at])
            if not len(cut):
                break
            if held:
                yield _solve(held, size)
            held, words, at = [], 0, stop
        last = keys[-1]
    if held:
        yield _solve(held, size)


def _remove(batches, size):
    for batch in batches:
        table = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        hits = table["hits"]
        runs = hits.flatten()
        starts = runs.field("starts")
        each = np.diff(starts.offsets.to_numpy())
        at = starts.flatten().to_numpy(zero_copy_only=False) + np.repeat(runs.field("start").to_numpy(zero_copy_only=False), each)
        ends = np.concatenate([[0], np.cumsum(each)])  # places of the runs before a run
        n_runs = pc.fill_null(pc.list_value_length(hits), 0).to_numpy()
        border = ends[np.concatenate([[0], np.cumsum(n_runs)])]
        removed, shas = np.zeros(batch.num_rows, np.int64), table["sha"].to_pylist()
        for i in np.flatnonzero(border[1:] > border[:-1]):
            words = (table["text"][i].as_py() or "").encode().split()
            mine = at[border[i]:border[i + 1]]
            covered = np.bincount(mine, minlength=len(words) + 1) - np.bincount(mine + size, minlength=len(words) + 1)
            left = np.cumsum(covered[:-1]) == 0
            removed[i] = len(words) - left.sum()
            shas[i] = hashlib.sha256(b" ".join(compress(words, left.tolist()))).hexdigest()
        yield pa.RecordBatch.from_arrays([table["doc_id"], table["n_words"], pa.array(removed, pa.int64()),
                                          pa.array(shas, pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept_sha256"])


class RepeatedWindows:
    """Runs, segments and repeated intervals of ``docs(doc_id, text)``."""

    def __init__(self, docs: DataFrame, size: int = SIZE, gram: int = GRAM, hot: int = HOT,
                 shard_words: int = SHARD_WORDS):
        self.size = size
        rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                   F.monotonically_increasing_id().alias("row"), "text"), "rows", "zstd")
        runs = written(rows.where("text is not null").select("row", "text").mapInArrow(
            lambda it: _runs(it, size, gram), "key long, seg long, row long, start int, n int"), "runs")
        # (written, so that a hot key's runs meet it in a join that Spark can split)
        shared = written(runs.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "keys")
        kept = written(runs.join(shared, "key", "left_semi"), "kept-runs")
        segments = kept.groupBy("key", "seg", "n").agg(
            F.count(F.lit(1)).alias("weight"), F.min(F.struct("row", "start")).alias("at"))
        segments = written(segments.select("key", "seg", "n", "weight", "at.*"), "segments")
        split = segments.groupBy("key").agg(F.count(F.lit(1)).alias("different")).where(F.col("different") > hot)
        asked = segments.join(split.select("key", F.lit(True).alias("hot")), "key", "left").groupBy("row").agg(
            F.collect_list(F.struct("key", "seg", "start", "n", "weight",
                                    F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asked"))
        affected = kept.groupBy("row").agg(F.lit(True).alias("affected"))
        plan = affected.join(asked, "row", "left")
        self.texts = written(rows.join(plan, "row", "left").select(
            "doc_id", "row", "text", F.coalesce("affected", F.lit(False)).alias("affected"), "asked").mapInArrow(
            lambda it: _texts(it, size),
            "doc_id long, row long, n_words long, sha string, text string, "
            "segments array<struct<key long, run long, seg long, i int, weight long, words string>>"), "texts", "zstd")
        pieces = self.texts.select(F.explode("segments").alias("s")).select("s.*")
        whole = pieces.where("i < 0").select("key", "seg", "words", "weight")
        # a window of a hot key that only one document holds once can't repeat
        single = pieces.where("i >= 0").groupBy("key", "words").agg(F.sum("weight").alias("weight")).where(
            "weight > 1").select("key", F.lit(0).cast("long").alias("seg"), "words", "weight")
        self.searched = whole.unionAll(single).repartition("key").sortWithinPartitions("key").mapInArrow(
            lambda it: _search(it, size, shard_words), "key long, seg long, starts array<int>")
        self.kept, self.pieces = kept, pieces

    def intervals(self) -> DataFrame:
        """(row, start, starts): repeated windows of each document, run by run."""
        found = written(self.searched, "found")
        single = self.pieces.where("i >= 0").select(F.col("key").alias("win"), F.col("run").alias("key"), "seg", "i").join(
            found.select(F.col("key").alias("win")), "win", "left_semi").groupBy("key", "seg").agg(
            F.collect_set("i").alias("starts"))
        return self.kept.select("key", "seg", "row", "start").join(
            found.unionByName(single), ["key", "seg"]).select("row", "start", "starts")


def remove_repeats(docs: DataFrame, size: int = SIZE, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row of docs."""
    repeats = RepeatedWindows(docs, size, **options)
    hits = repeats.intervals().groupBy("row").agg(
        F.collect_list(F.struct("start", "starts")).alias("hits"))
    return repeats.texts.select("doc_id", "row", "n_words", "sha", "text").join(
        hits, "row", "left").select("doc_id", "n_words", "sha", "text", "hits").mapInArrow(
        lambda it: _remove(it, size), "doc_id long, n_words long, n_removed long, kept_sha256 string")
