"""Benchmark decontamination through a distributed positional inverted index.

1. Items become lists of word hashes; their windows are ``window`` consecutive
   words (a shorter item is one window).
2. The corpus is counted for test terms only.  A window with a term that the
   corpus lacks can't occur; every other window takes its ``anchors`` rarest
   terms.
3. Postings (term, doc_id, position) are stored for the anchor terms alone, so
   the index holds the rare part of the corpus that can answer the test.
4. Lists are intersected after adjusting each posting by the term's offset in
   its item: (item, document, position - offset).  An alignment where all
   anchors of some window meet is a candidate.
5. Candidates are verified on the whole text, word by word; the result has the
   exact phrase matches.  ``proximity_matches`` reads the same index for rare
   terms of an item that stand near each other in any order.

Which words the mappers pass on is decided by a bit table of fixed size
(``BITS``), the only thing broadcast by this module; false positives fall out
in the join with the true terms, so a large benchmark costs pruning, not
correctness.  Joins are keyed by term, then by (item, document, alignment), then by
document; a term or passage that a third of all documents hold is a skewed
join side, which Spark splits, and no list is grouped by term.

Nulls: a null text has no words; items without words or without an id match
nothing; a null ``doc_id`` never matches.  Repeated document rows give one
result row each; repeated items count once.  Empty tables give empty results
or zero hits.  Columns other than the named ones are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written
from .textops import alphanumeric, as_long, text_chunks

WINDOW = 13
ANCHORS = 2
BITS = 1 << 23


def _item_terms(batches):
    for batch in batches:
        for w in text_chunks(batch.column(1), alphanumeric(), lower=True):
            lists = pa.ListArray.from_arrays(pa.array(w.offsets, pa.int32()), as_long(w.hashes()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.first, w.n), lists],
                                             names=["item_id", "terms"])


def bit_table(terms: DataFrame) -> np.ndarray:
    """A table of ``BITS`` bits with those of ``terms(term)`` set: at most BITS / 64 rows reach the driver."""
    rows = terms.select(F.pmod(F.col("term"), F.lit(BITS)).alias("at")).selectExpr(
        "shiftright(at, 6) as word", "shiftleft(1L, cast(at % 64 as int)) as bit") \
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    table = np.zeros(BITS // 64, np.int64)
    for r in rows:
        table[r["word"]] = r["bits"]
    return table.view(np.uint8)


def _unpacked(shared) -> np.ndarray:
    return np.unpackbits(shared.value, bitorder="little").astype(bool)


def _passing(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places of words whose bit is set."""
    return np.flatnonzero(table[h & np.uint64(BITS - 1)])


def _term_counts(batches, shared):
    table = _unpacked(shared)
    for batch in batches:
        for w in text_chunks(batch.column(0), alphanumeric(), lower=True):
            h = w.hashes()
            term, n = np.unique(h[_passing(h, table)], return_counts=True)
            yield pa.RecordBatch.from_arrays([as_long(term), pa.array(n, pa.int64())], names=["term", "n"])


def _postings(batches, shared):
    table = _unpacked(shared)
    for batch in batches:
        for w in text_chunks(batch.column(1), alphanumeric(), lower=True):
            h = w.hashes()
            at = _passing(h, table)
            text = np.searchsorted(w.offsets, at, side="right") - 1
            yield pa.RecordBatch.from_arrays([
                as_long(h[at]), batch.column(0).slice(w.first, w.n).take(pa.array(text)),
                pa.array(at - w.offsets[text], pa.int32())], names=["term", "doc_id", "pos"])


def _anchor_rows(batches, window, anchors):
    """(item, terms, counts) -> (item, terms, windows as lists of anchor places), windows that can occur only."""
    kind = pa.list_(pa.list_(pa.int32()))
    for batch in batches:
        found = []
        for counts in batch.column(2).to_pylist():
            n = np.asarray(counts, np.int64)
            size = min(window, len(n))
            wins = set()
            for s in range(len(n) - size + 1 if size else 0):
                own = n[s:s + size]
                if own.min() > 0:
                    wins.add(tuple(sorted(s + int(i) for i in np.argsort(own, kind="stable")[:anchors])))
            found.append([list(x) for x in sorted(wins)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, kind)],
                                         names=["item", "terms", "windows"])


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, terms): distinct items with at least one word; ``item`` numbers equal lists of an id."""
    raw = benchmark.where(F.col("item_id").isNotNull()).select("item_id", "text").mapInArrow(
        _item_terms, f"item_id {dict(benchmark.dtypes)['item_id']}, terms array<bigint>")
    return raw.where(F.size("terms") > 0).distinct().withColumn(
        "item", F.xxhash64(F.col("item_id").cast("string"), "terms"))


class PhraseIndex:
    """Postings of a benchmark's rare terms in ``docs(doc_id, text)``; built by Spark, stored in the shared folder."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, anchors: int = ANCHORS):
        spark = docs.sparkSession
        self.docs, self.window, self.anchors = docs, window, anchors
        self.items = written(items_of(benchmark), "items")
        places = self.items.select("item", "item_id", F.posexplode("terms").alias("pos", "term"))
        terms = places.select("term").distinct()
        shared = spark.sparkContext.broadcast(bit_table(terms))
        counts = docs.select("text").mapInArrow(lambda it: _term_counts(it, shared), "term long, n long") \
                     .groupBy("term").agg(F.sum("n").alias("n")).join(terms, "term", "left_semi")
        counted = places.join(counts, "term", "left").groupBy("item").agg(F.transform(
            F.sort_array(F.collect_list(F.struct("pos", F.coalesce("n", F.lit(0)).alias("n")))),
            lambda x: x["n"]).alias("counts"))
        self.anchored = written(
            self.items.join(counted, "item").select("item", "terms", "counts").mapInArrow(
                lambda it: _anchor_rows(it, window, anchors),
                "item long, terms array<bigint>, windows array<array<int>>").where(F.size("windows") > 0), "anchored")
        self.anchor_terms = self.anchored.select(
            "item", F.explode(F.array_distinct(F.flatten("windows"))).alias("offset"), "terms").select(
            "item", "offset", F.col("terms")[F.col("offset")].alias("term"))
        rare = spark.sparkContext.broadcast(bit_table(self.anchor_terms.select("term").distinct()))
        self.postings = written(
            docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null").mapInArrow(
                lambda it: _postings(it, rare), "term long, doc_id long, pos int"), "postings")

    def aligned(self) -> DataFrame:
        """(item, doc_id, start, windows): alignments where all anchors of some window meet."""
        met = self.postings.join(self.anchor_terms, "term").groupBy(
            "item", "doc_id", (F.col("pos") - F.col("offset")).alias("start")).agg(
            F.collect_set("offset").alias("found"))
        return met.join(self.anchored.select("item", "windows"), "item").where(F.exists(
            "windows", lambda w: F.size(F.array_except(w, "found")) == 0)).select("item", "doc_id", "start")

    def phrase_matches(self) -> DataFrame:
        """Per row of docs: (doc_id, n_words, n_hit, item_ids): exact occurrences of item windows."""
        hits = self.aligned().join(self.items.select(
            "item", F.col("item_id").cast("string").alias("item_id"), "terms"), "item").groupBy("doc_id").agg(
            F.collect_list(F.struct("start", "item_id", "terms")).alias("aligned"))
        window = self.window
        return self.docs.select(F.col("doc_id").cast("long"), "text").join(hits, "doc_id", "left").mapInArrow(
            lambda it: _verify(it, window), "doc_id long, n_words long, n_hit long, item_ids array<string>")

    def proximity_matches(self, slop: int, min_terms: int) -> DataFrame:
        """(item_id, doc_id, pos): places from which ``min_terms`` distinct anchor terms of an item
        stand within ``slop`` words, in any order."""
        near = Window.partitionBy("item", "doc_id").orderBy("pos").rangeBetween(0, slop - 1)
        found = self.postings.join(self.anchor_terms.select("item", "term").distinct(), "term").withColumn(
            "n", F.size(F.collect_set("term").over(near)))
        return found.where(F.col("n") >= min_terms).join(self.items.select("item", "item_id"), "item").select(
            "item_id", "doc_id", "pos")


def _verify(batches, window):
    for batch in batches:
        ids, aligned = batch.column(0), batch.column(2)
        for w in text_chunks(batch.column(1), alphanumeric(), lower=True):
            n_words, n_hit, items = w.counts(), np.zeros(w.n, np.int64), [[]] * w.n
            own = aligned.slice(w.first, w.n)
            todo = np.flatnonzero(own.is_valid().to_numpy(zero_copy_only=False))
            h = w.hashes().view(np.int64) if len(todo) else None
            for t in todo:
                words = h[w.offsets[t]:w.offsets[t + 1]]
                covered, found = np.zeros(len(words) + 1, np.int64), set()
                for cand in own[int(t)].as_py():
                    terms = np.asarray(cand["terms"], np.int64)
                    size, start = min(window, len(terms)), cand["start"]
                    lo, hi = max(0, -start), min(len(terms), len(words) - start)
                    if hi - lo < size:
                        continue
                    equal = np.concatenate([[0], np.cumsum(words[start + lo:start + hi] == terms[lo:hi])])
                    at = np.flatnonzero(equal[size:] - equal[:-size] == size) + start + lo
                    if len(at):
                        found.add(cand["item_id"])
                        np.add.at(covered, at, 1)
                        np.add.at(covered, at + size, -1)
                n_hit[t] = np.count_nonzero(np.cumsum(covered)[:-1] > 0)
                items[t] = sorted(found)
            yield pa.RecordBatch.from_arrays([
                ids.slice(w.first, w.n), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(items, pa.list_(pa.string()))], names=["doc_id", "n_words", "n_hit", "item_ids"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per row of docs.

    Contaminated: at least 5 % of a document's words lie in exact occurrences of item windows.
    """
    found = PhraseIndex(docs, benchmark, window).phrase_matches()
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
