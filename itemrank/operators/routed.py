"""Exact top-k nearest items without all pairs: items travel only to the blocks that can use them.

The kNN of ``knn.py`` for sparse vectors with non-negative weights, where most
pairs of items share nothing or too little.  Items that seek neighbours are
cut into blocks in the order of their heaviest key, so that a block's items
share keys.  Whether an item can enter the list of anybody in a block is decided from an
inverted index before any vector moves:

* Distance.  d² = |a|² + |b|² - 2ab, and the k + 1 items of least norm (the
  seed pass) are candidates of every item, so their greatest squared norm T
  bounds the k-th best value of |b|² - 2ab from above.  Item b can only enter a
  list where ab >= (|b|² - T) / 2.  Each key tells the blocks it occurs in to the
  parts of the items that have it, once a part, and
  b goes to the blocks whose keys together can bring that product (weight
  times the key's greatest weight in the block, summed by block), not to all that share one.
  A key of more than ``KEY_BLOCKS`` blocks counts for all of them, so what is told
  is bounded by the entries, however many blocks there are.
* Similarity.  The seed pass searches each block alone and gives each item a
  lower bound t of its k-th best similarity.  The item looks up its keys but
  for the most frequent ones, as long as what is left out, times the longest
  vector, is below t: an item that shares only those has a similarity below t.

For similarity, blocks are told to items as bit masks by key, so the index joins
narrow rows, and frequent keys carry none.  An item is then sent whole, as one row of
arrays, to the blocks that it was routed to, once to those that one task holds.  A task
streams its blocks' candidates in chunks, seeds and small norms first: a chunk's least
norm and greatest weight by key bound what it can bring to each item of the
block, items that can't gain are left out of the product, and chunks that none
can gain from are skipped.  A block's lists are complete when its task ends;
there is no later merge.

Where the entries times the blocks are few (``knn.SENT_ENTRIES``), the index
costs more than it saves: every item is sent to every block, and the bounds of
the chunks alone decide.

Every block is bounded in items and non-zeros, and chunks in cells, whatever
the keys' skew; items with more non-zeros than a task should hold don't come
here (``knn._hot_candidates``).  Ranks are by rounded score, then id.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

# Blocks are searched in executor Python workers: ship this module by value, as knn.py does.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_CELLS = 400_000     # items of a block times candidates of a chunk: a matrix stays in a core's cache
DENSE_CHUNK_CELLS = 1_600_000
CHUNK_PRODUCTS = 1_000_000
DENSE_SHARE = 16          # a key of more than 1/16 of a block's items may go through BLAS
DENSE_CELLS = 4_000_000   # items of a block times such keys
MASK_BITS = 62
LEVELS = 8                # parts of a key's greatest weight that its greatest weights in blocks are told in
KEY_BLOCKS = 64           # a key tells up to so many blocks
WAITING_CHUNKS = 8        # a block of several is offered so many chunks of candidates at once
REACH_CELLS = 4_000_000   # items times blocks whose sums are formed at once
PART_ENTRIES = 1_000_000  # entries of items that are routed by distance in one task
OUT = "item_id long, rank int, neighbor_id long, score double"


def _slack(decimals: int) -> float:
    return 2 * 10.0 ** -decimals


def _expand(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slice, place) of every element of the slices ``starts[i]:starts[i] + counts[i]``."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[of]


class Items:
    """Sparse vectors: ids, squared norms, and the entries of all, one item after the other."""

    def __init__(self, ids, norms, lengths, keys, weights):
        self.ids, self.norms, self.lengths, self.keys, self.weights = ids, norms, lengths, keys, weights

    def take(self, rows: np.ndarray) -> Items:
        starts = np.cumsum(self.lengths) - self.lengths
        _, at = _expand(starts[rows], self.lengths[rows])
        return Items(self.ids[rows], self.norms[rows], self.lengths[rows], self.keys[at], self.weights[at])

    @staticmethod
    def joined(parts: list[Items]) -> Items:
        return Items(*(np.concatenate([getattr(p, c) for p in parts])
                       for c in ("ids", "norms", "lengths", "keys", "weights")))


class Block:
    """Items with their best neighbours so far, and an index of their entries by key."""

    def __init__(self, items: Items, k: int, metric: str, decimals: int):
        self.items, self.k, self.metric, self.decimals = items, k, metric, decimals
        n = len(items.ids)
        self._index()
        self.limit = np.full(n, np.inf)   # what the k-th best has: |b|² - 2ab, or -ab
        self.row = self.ids = np.zeros(0, np.int64)
        self.value = self.rounded = np.zeros(0)
        self.cells = self.skipped = 0

    def _index(self) -> None:
        """Entries by key; the most frequent keys, as far as they fit, also as a dense matrix."""
        n = len(self.items.ids)
        self.uniq, code = np.unique(self.items.keys, return_inverse=True)
        order = np.argsort(code, kind="stable")
        self.entry_row = np.repeat(np.arange(n), self.items.lengths)[order]
        self.entry_weight = self.items.weights[order]
        self.entry_code = code[order]
        self.degree = np.bincount(code, minlength=len(self.uniq))
        frequent = np.flatnonzero(self.degree * DENSE_SHARE > n)
        if len(frequent) * 4 > len(self.uniq):  # few keys: all of them
            frequent = np.arange(len(self.uniq))
        frequent = frequent[np.argsort(-self.degree[frequent], kind="stable")][:DENSE_CELLS // max(1, n)]
        self.slot = np.full(len(self.uniq), -1)
        self.slot[frequent] = np.arange(len(frequent))
        at = self.slot[self.entry_code]
        self.dense = np.zeros((n, len(frequent)))
        self.dense[self.entry_row[at >= 0], at[at >= 0]] = self.entry_weight[at >= 0]
        self.chunk = max(1, (DENSE_CHUNK_CELLS if len(frequent) else CHUNK_CELLS) // max(1, n))

    def _shared(self, other: Items):
        """Entries of ``other`` under keys of the block: (column, key number, weight)."""
        if not len(self.uniq):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        place = np.minimum(np.searchsorted(self.uniq, other.keys), len(self.uniq) - 1)
        known = self.uniq[place] == other.keys
        return np.repeat(np.arange(len(other.ids)), other.lengths)[known], place[known], other.weights[known]

    def products(self, rows: np.ndarray, n_cols: int, col, code, weight) -> np.ndarray:
        """Inner products of the block's ``rows`` with columns given by their entries."""
        n, out = len(rows), None
        every = n == len(self.items.ids)
        slot = self.slot[code]
        if (slot >= 0).any():
            right = np.zeros((self.dense.shape[1], n_cols))
            right[slot[slot >= 0], col[slot >= 0]] = weight[slot >= 0]
            out = ((self.dense if every else self.dense[rows]) @ right).ravel()
        col, code, weight = col[slot < 0], code[slot < 0], weight[slot < 0]
        if len(code):
            if every:
                row, own, degree = self.entry_row, self.entry_weight, self.degree
            else:
                place = np.full(len(self.items.ids), -1)
                place[rows] = np.arange(n)
                row = place[self.entry_row]
                kept = row >= 0
                row, own = row[kept], self.entry_weight[kept]
                degree = np.bincount(self.entry_code[kept], minlength=len(self.uniq))
            start = np.cumsum(degree) - degree
            total = np.cumsum(degree[code])
            edges = np.searchsorted(total, np.arange(1, int(total[-1]) // CHUNK_PRODUCTS + 1) * CHUNK_PRODUCTS)
            for part in np.split(np.arange(len(code)), edges):
                of, at = _expand(start[code[part]], degree[code[part]])
                if len(of):
                    of = part[of]
                    sums = np.bincount(row[at] * n_cols + col[of], weights=own[at] * weight[of], minlength=n * n_cols)
                    out = sums if out is None else out + sums
        return (np.zeros(n * n_cols) if out is None else out).reshape(n, n_cols)

    def reach(self, code, weight) -> np.ndarray:
        """Upper bound of each block item's product with any of the columns: greatest weights by key."""
        top = np.zeros(len(self.uniq))
        np.maximum.at(top, code, weight)
        return np.bincount(self.entry_row, weights=self.entry_weight * top[self.entry_code], minlength=len(self.items.ids))

    def add(self, other: Items) -> None:
        """Offer candidates, a chunk at a time."""
        step = self.chunk
        for first in range(0, len(other.ids), step):
            self._add(other if step >= len(other.ids) else other.take(np.arange(first, min(first + step, len(other.ids)))))

    def _add(self, other: Items) -> None:
        n, m, slack = len(self.items.ids), len(other.ids), _slack(self.decimals)
        shared = self._shared(other)
        reach = self.reach(*shared[1:]) * (1 + 1e-9)
        least = other.norms.min() - 2 * reach if self.metric == "l2" else -reach
        if self.metric != "l2":
            least[reach <= 0] = np.inf  # only positive similarities count
        rows = np.flatnonzero(least <= self.limit + slack)
        self.skipped += (n - len(rows)) * m
        if not len(rows):
            return
        self.cells += len(rows) * m
        dots = self.products(rows, m, *shared)
        limit = self.limit[rows]
        none = np.flatnonzero(np.isinf(limit))
        if len(none) and m > self.k:  # the chunk itself gives the first limits; one place more, as an item may meet itself
            value = other.norms - 2 * dots[none] if self.metric == "l2" else -dots[none]
            limit[none] = np.partition(value, min(self.k, m - 1), axis=1)[:, min(self.k, m - 1)]
        limit = limit + slack
        if self.metric == "l2":
            r, c = np.nonzero(dots >= np.subtract.outer(-limit, -other.norms) / 2)
        else:
            r, c = np.nonzero(dots >= np.maximum(-limit, 0.5 * 10.0 ** -self.decimals)[:, None])
        value = other.norms[c] - 2 * dots[r, c] if self.metric == "l2" else -dots[r, c]
        found = self.items.ids[rows[r]] != other.ids[c]  # an item is no neighbour of itself
        if found.any():
            self._merge(rows[r][found], other.ids[c][found], value[found])

    def _merge(self, row, ids, value) -> None:
        rounded = self.items.norms[row] + value if self.metric == "l2" else value
        row, ids = np.concatenate([self.row, row]), np.concatenate([self.ids, ids])
        value = np.concatenate([self.value, value])
        rounded = np.concatenate([self.rounded, np.round(rounded, self.decimals)])
        order = np.lexsort((ids, rounded, row))
        begins = np.searchsorted(row[order], np.arange(len(self.limit) + 1))
        rank = np.arange(len(order)) - begins[row[order]]
        best = order[rank < self.k]
        self.row, self.ids, self.value, self.rounded = row[best], ids[best], value[best], rounded[best]
        begins = np.searchsorted(self.row, np.arange(len(self.limit) + 1))
        full = np.flatnonzero(np.diff(begins) == self.k)
        if self.k and len(full):
            _, at = _expand(begins[full], np.full(len(full), self.k))
            self.limit[full] = self.value[at].reshape(len(full), self.k).max(axis=1)

    def lists(self) -> pa.RecordBatch:
        begins = np.searchsorted(self.row, np.arange(len(self.limit) + 1))
        rank = np.arange(len(self.row)) - begins[self.row] + 1
        score = self.rounded if self.metric == "l2" else -self.rounded
        return pa.RecordBatch.from_arrays(
            [pa.array(self.items.ids[self.row], pa.int64()), pa.array(rank, pa.int32()), pa.array(self.ids, pa.int64()),
             pa.array(score, pa.float64())], names=["item_id", "rank", "neighbor_id", "score"])


def _items_of(batch: pa.RecordBatch) -> Items:
    keys, weights = batch.column("keys"), batch.column("weights")
    return Items(batch.column("item_id").to_numpy(), batch.column("norm").to_numpy(),
                 np.diff(keys.offsets.to_numpy()).astype(np.int64), keys.flatten().to_numpy(),
                 weights.flatten().to_numpy())


def _pieces(batch: pa.RecordBatch, by: list[str]):
    """(key, slice) of each run of equal ``by`` columns."""
    if not batch.num_rows:
        return
    columns = [batch.column(c).to_numpy() for c in by]
    change = np.zeros(batch.num_rows - 1, bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
    for first, last in zip(cuts, cuts[1:]):
        yield tuple(int(c[first]) for c in columns), batch.slice(first, last - first)


def _lookups(k: int, decimals: int, search: bool, longest: float):
    """Rows of blocks -> (key, blk): the keys that a block's items look up, among vectors of up to ``longest``."""
    def keys_of(number: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        items = Items.joined([_items_of(b) for b in batches])
        bound = np.zeros(len(items.ids))
        if search:
            block = Block(items, k, "cosine", decimals)
            block.add(items)
            bound = np.where(np.isfinite(block.limit), -block.limit, 0.0)
        # entries stand most frequent key first: products with what is left out stay below the bound
        row = np.repeat(np.arange(len(items.ids)), items.lengths)
        squares = np.cumsum(items.weights ** 2)
        before = np.concatenate([[0.0], squares])[np.cumsum(items.lengths) - items.lengths]
        kept = np.sqrt(np.maximum(squares - before[row], 0.0)) * longest >= (bound - _slack(decimals))[row] * (1 - 1e-9)
        keys = np.unique(items.keys[kept])
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.full(len(keys), number), pa.int32())],
                                          names=["key", "blk"])

    def run(batches):
        now, held = None, []
        for batch in batches:
            for (number,), piece in _pieces(batch, ["blk"]):
                if held and number != now:
                    yield keys_of(now, held)
                    held = []
                now = number
                held.append(piece)
        if held:
            yield keys_of(now, held)

    return run


class Told:
    """What keys bring: the greatest weight of each, and the blocks it occurs in with the levels of its weights there."""

    def __init__(self, batches: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        key = rows.column("key").to_numpy()
        rows = rows.take(pa.array(np.argsort(key, kind="stable")))
        blks = rows.column("blks")
        self.key, self.top = rows.column("key").to_numpy(), rows.column("top").to_numpy()
        self.everywhere = blks.is_null().to_numpy(zero_copy_only=False)
        self.counts = blks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.flat = blks.flatten().to_numpy()

    def reached(self, need: np.ndarray, items: Items, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
        """(item, block) where the shares of what an item needs add up to 1."""
        n = len(need)
        place = np.minimum(np.searchsorted(self.key, items.keys), len(self.key) - 1)
        brought = items.weights * self.top[place]
        known = (self.key[place] == items.keys) & (brought > 0)
        item, place, brought = np.repeat(np.arange(n), items.lengths)[known], place[known], brought[known]
        # whoever needs nothing goes wherever it shares a key
        share = np.where(need[item] > 0, brought / np.where(need > 0, need, 1.0)[item], float(LEVELS))
        of, at = _expand(self.starts[place], self.counts[place])
        blk, level = np.divmod(self.flat[at].astype(np.int64), LEVELS)
        sums = np.bincount(item[of] * n_blocks + blk, weights=share[of] * (level + 1) / LEVELS,
                           minlength=n * n_blocks).reshape(n, n_blocks)
        everywhere = self.everywhere[place]
        sums += np.bincount(item[everywhere], weights=share[everywhere], minlength=n)[:, None]
        return np.nonzero(sums * (1 + 1e-9) >= 1)


def _reaching(n_blocks: int):
    """Rows sorted by (part, side), side 0 what the part's keys bring, side 1 its items -> (item_id, own, blk)."""
    step = max(1, REACH_CELLS // n_blocks)

    def run(batches):
        now, held, told = None, [], None
        for batch in batches:
            for (part, side), piece in _pieces(batch, ["part", "side"]):
                if part != now:
                    now, held, told = part, [], None
                if side == 0:
                    held.append(piece.select(["key", "top", "blks"]))
                    continue
                if not held:  # no key of these items is told anything
                    continue
                told = told or Told(held)
                for first in range(0, piece.num_rows, step):
                    some = piece.slice(first, step)
                    item, blk = told.reached(some.column("need").to_numpy(), _items_of(some), n_blocks)
                    at = pa.array(item)
                    yield pa.RecordBatch.from_arrays(
                        [some.column("item_id").take(at), some.column("own").take(at), pa.array(blk, pa.int32())],
                        names=["item_id", "own", "blk"])

    return run


def _search(k: int, metric: str, decimals: int, own: bool, out):
    """Rows sorted by (grp, side, norm) -> ``out(block)`` of each block; side 0 are the items of the group's blocks,
    and ``blks`` are the blocks that a row is for."""
    def run(batches):
        now, held, opened, waiting = None, {}, None, {}

        def blocks():
            made = {}
            for number in sorted(held):
                made[number] = b = Block(Items.joined(held[number]), k, metric, decimals)
                if own and metric != "l2":  # neighbours are near; by distance the stream's small norms set better limits
                    b.add(b.items)
            return made

        def closed():
            for number, b in (blocks() if opened is None else opened).items():
                if number in waiting:
                    b.add(Items.joined(waiting.pop(number)))
                if own and metric == "l2":
                    b.add(b.items)
                yield out(b)

        for batch in batches:
            for (group, side), piece in _pieces(batch, ["grp", "side"]):
                if group != now:
                    yield from closed()
                    now, held, opened, waiting = group, {}, None, {}
                if side == 1 and not held:  # no item of these blocks is left to seek neighbours
                    continue
                items, blks = _items_of(piece), piece.column("blks")
                row = np.repeat(np.arange(piece.num_rows), np.diff(blks.offsets.to_numpy()))
                blk = blks.flatten().to_numpy()
                if side == 1 and opened is None:
                    opened = blocks()
                for number in np.unique(blk).tolist():
                    at = row[blk == number]
                    some = items if len(at) == len(items.ids) else items.take(at)
                    if side == 0:
                        held.setdefault(number, []).append(some)
                    elif number in opened:
                        waiting.setdefault(number, []).append(some)
                        # a chunk's bounds cost the same however few its candidates are
                        if sum(len(x.ids) for x in waiting[number]) >= WAITING_CHUNKS * opened[number].chunk:
                            opened[number].add(Items.joined(waiting.pop(number)))
        yield from closed()

    return run


def _gathered(vectors: DataFrame, entry) -> DataFrame:
    """(item_id, norm, e): one row an item, its entries (structs) in descending order."""
    return vectors.groupBy("item_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("norm"),
                                          F.sort_array(F.collect_list(entry), asc=False).alias("e"))


def rows_of(vectors: DataFrame) -> DataFrame:
    """(item_id, norm, keys, weights, place): one row an item, with its heaviest key as place, for searches by distance."""
    return _as_rows(_gathered(vectors, F.struct("key", "weight")))


def _as_rows(items: DataFrame) -> DataFrame:
    heaviest = F.array_max(F.transform("e", lambda x: F.struct(x["weight"], x["key"])))["key"]
    return items.select("item_id", "norm", F.col("e.key").alias("keys"), F.col("e.weight").alias("weights"), heaviest.alias("place"))


def _placed(rows: DataFrame, n_groups: int, max_partitions: int) -> DataFrame:
    parts = max(1, min(n_groups, max_partitions))
    return rows.select("grp", "side", "blks", "item_id", "norm", "keys", "weights").repartitionById(
        parts, F.col("grp") % parts).sortWithinPartitions("grp", "side", "norm")


class SentToAll:
    """Every item goes to every block, which then decides by its bounds: for few entries times blocks."""

    def __init__(self, vectors: DataFrame, k: int, metric: str, decimals: int, n_blocks: int, seekers: DataFrame | None = None,
                 candidates: DataFrame | None = None):
        self.k, self.metric, self.decimals, self.n_blocks, self.own = k, metric, decimals, n_blocks, seekers is None
        items = _gathered(vectors, F.struct("key", "weight")).select(
            "item_id", "norm", F.col("e.key").alias("keys"), F.col("e.weight").alias("weights"),
            F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)).cast("int").alias("home"))
        every = items.withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        if seekers is None:
            self.rows = every.withColumn("side", F.when(F.col("blk") == F.col("home"), 0).otherwise(1))
        else:
            offered = every if candidates is None else every.join(candidates, "item_id", "left_semi")
            self.rows = offered.withColumn("side", F.lit(1)).unionByName(
                items.join(seekers, "item_id", "left_semi").withColumn("blk", F.col("home")).withColumn("side", F.lit(0)))

    def _rows(self, max_partitions: int) -> DataFrame:
        rows = self.rows.withColumn("grp", F.col("blk")).withColumn("blks", F.array("blk"))
        return _placed(rows, self.n_blocks, max_partitions)

    def lists(self, max_partitions: int = 20000) -> DataFrame:
        """(item_id, rank, neighbor_id, score)."""
        return self._rows(max_partitions).mapInArrow(
            _search(self.k, self.metric, self.decimals, self.own, Block.lists), OUT)

    def work(self, max_partitions: int = 20000) -> DataFrame:
        """(cells, skipped) a block: pairs whose product was formed, and pairs ruled out by the bounds of a chunk."""
        def counts(block):
            return pa.RecordBatch.from_arrays([pa.array([block.cells], pa.int64()), pa.array([block.skipped], pa.int64())],
                                              names=["cells", "skipped"])
        return self._rows(max_partitions).mapInArrow(
            _search(self.k, self.metric, self.decimals, self.own, counts), "cells long, skipped long")


class RoutedSearch(SentToAll):
    """Blocks, routes and search over ``vectors(item_id, key, weight)`` with squared ``norms(item_id, norm)``; ``seekers(item_id)`` get lists, or all items.

    Lists are drawn from ``candidates(item_id)``, or from all items.  A task holds ``together`` blocks, so an item
    that several of them can use is sent once.  ``rows`` are the vectors' ``rows_of``, where they are written already.
    """

    def __init__(self, vectors: DataFrame, norms: DataFrame, k: int, metric: str, decimals: int, n_blocks: int,
                 seekers: DataFrame | None = None, candidates: DataFrame | None = None, together: int = 1,
                 rows: DataFrame | None = None):
        self.k, self.metric, self.decimals, self.n_blocks, self.own = k, metric, decimals, n_blocks, seekers is None
        self.together = max(1, together)
        if candidates is not None:
            norms = norms.join(candidates, "item_id", "left_semi")
        self.seeds = None
        if metric == "l2":
            items = rows_of(vectors) if rows is None else rows
            least = norms.orderBy("norm", "item_id").limit(k + 1).agg(F.max("norm").alias("t"), F.count("*").alias("n")).first()
            self.bound = least["t"] if least["n"] == k + 1 else float("inf")
            # equal norms: the least ids of each; norms so near that rounding may join them all count
            ties = Window.partitionBy(F.round("norm", 9)).orderBy("item_id")
            self.seeds = norms.where(F.col("norm") <= self.bound + _slack(decimals)).withColumn(
                "place", F.row_number().over(ties)).where(F.col("place") <= k + 1).select("item_id")
        else:
            keys = vectors.groupBy("key").agg(F.count("*").alias("degree"))
            items = _as_rows(_gathered(vectors.join(keys, "key"), F.struct("degree", "key", "weight")))
        if self.own:
            self.items = self.blocks = written(self._dealt(items), "knn-items")
        else:
            self.items = (written(items, "knn-items") if rows is None else rows).withColumn("blk", F.lit(-1))
            self.blocks = written(self._dealt(self.items.drop("blk").join(seekers, "item_id", "left_semi")), "knn-blocks")
            if candidates is not None:
                self.items = self.items.join(candidates, "item_id", "left_semi")

    def _dealt(self, items: DataFrame) -> DataFrame:
        return items.repartitionByRange(self.n_blocks, "place", "item_id").drop("place").withColumn("blk", F.spark_partition_id())

    def routes(self) -> DataFrame:
        """(item_id, blk): the blocks, other than its own, that an item is sent to."""
        if self.metric == "l2":
            own = self.items.select("item_id", F.col("blk").alias("own"))
            every = F.explode(F.sequence(F.lit(0), F.lit(self.n_blocks - 1))).alias("blk")
            sent = self._reached().unionByName(own.join(self.seeds, "item_id", "left_semi").select("item_id", "own", every))
            return sent.where("blk <> own").select("item_id", "blk")
        longest = (self.items.agg(F.max("norm")).first()[0] or 0.0) ** 0.5
        lookups = self.blocks.select("item_id", "norm", "keys", "weights", "blk").mapInArrow(
            _lookups(self.k, self.decimals, self.own, longest), "key long, blk int")
        masks = lookups.groupBy("key", F.expr(f"blk div {MASK_BITS}").alias("word")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast(blk % {MASK_BITS} as int))")).alias("mask"))
        posted = self.items.select("item_id", "blk", F.explode("keys").alias("key"))
        told = posted.join(masks, "key").groupBy("item_id", "blk", "word").agg(F.bit_or("mask").alias("mask"))
        bits = F.filter(F.sequence(F.lit(0), F.lit(MASK_BITS - 1)), lambda b: F.getbit("mask", b) == 1)
        blocks = F.transform(bits, lambda b: (b + F.col("word") * MASK_BITS).cast("int"))
        sent = told.select("item_id", F.col("blk").alias("own"), F.explode(blocks).alias("blk"))
        return sent.where("blk <> own").select("item_id", "blk")

    def _reached(self) -> DataFrame:
        """(item_id, own, blk) of the items but the seeds: blocks whose keys can bring the product that the item needs.

        Items are looked at by parts, of neighbouring blocks where they are in blocks; a part is told once what a key
        brings, however many of its items have the key.
        """
        entry = F.explode(F.arrays_zip("keys", "weights")).alias("x")
        number = "smallint" if self.n_blocks * LEVELS < 1 << 15 else "int"
        size = self.items.agg(F.sum(F.size("keys")).cast("long")).first()[0] or 0
        n_parts = max(1, -(-size // PART_ENTRIES))
        if self.own:
            n_parts = min(n_parts, self.n_blocks)
        part_of = lambda blk: F.floor(blk * n_parts / self.n_blocks).cast("int")
        by_key = self.blocks.select("blk", entry).groupBy(F.col("x.keys").alias("key"), "blk").agg(F.max("x.weights").alias("w")).groupBy(
            "key").agg(F.max("w").alias("top"), F.collect_list(F.struct("blk", "w")).alias("in"))
        # the greatest weight in a block, in LEVELS parts of the key's greatest, rounded up
        level = lambda x: F.least(F.lit(LEVELS), F.ceil(x["w"] / F.col("top") * LEVELS * (1 + 1e-9))) - 1
        blks = F.when(F.size("in") <= KEY_BLOCKS, F.transform(
            F.filter("in", lambda x: x["w"] > 0), lambda x: (x["blk"] * LEVELS + level(x)).cast(number))).alias("blks")
        parts = F.array_distinct(F.transform("in", lambda x: part_of(x["blk"]))).alias("parts")
        by_key = by_key.where("top > 0").select("key", "top", blks, *([parts] if self.own else []))
        part = part_of(F.col("blk")) if self.own else F.pmod(F.xxhash64("item_id"), F.lit(n_parts)).cast("int")
        items = self.items.withColumn("part", part)
        if not self.own:
            by_key = by_key.join(items.select("part", F.explode("keys").alias("key")).groupBy("key").agg(
                F.collect_set("part").alias("parts")), "key")
        told = by_key.select(F.explode("parts").alias("part"), F.lit(0).alias("side"), "key", "top", "blks")
        need = (F.col("norm") - self.bound) / 2 - _slack(self.decimals)
        asking = items.join(self.seeds, "item_id", "left_anti").select(
            "part", F.lit(1).alias("side"), "item_id", F.col("blk").alias("own"), need.alias("need"), "norm", "keys", "weights")
        return told.unionByName(asking, allowMissingColumns=True).repartitionById(n_parts, F.col("part")).sortWithinPartitions(
            "part", "side").mapInArrow(_reaching(self.n_blocks), "item_id long, own int, blk int")

    def _rows(self, max_partitions: int) -> DataFrame:
        group = lambda blk: F.floor(blk / self.together).cast("int")
        own = self.blocks.withColumn("side", F.lit(0)).withColumn("grp", group(F.col("blk"))).withColumn("blks", F.array("blk"))
        # an item goes once to a group, however many of its blocks it is sent to
        to = self.routes().groupBy("item_id").agg(F.collect_set("blk").alias("to"))
        sent = self.items.drop("blk").join(to, "item_id").withColumn("side", F.lit(1)).withColumn(
            "grp", F.explode(F.array_distinct(F.transform("to", group))))
        sent = sent.withColumn("blks", F.filter("to", lambda b: group(b) == F.col("grp"))).drop("to")
        rows = own.drop("blk").unionByName(sent, allowMissingColumns=True)
        return _placed(rows, -(-self.n_blocks // self.together), max_partitions)
