"""Exact top-k nearest items over sparse item vectors, blocked for scale.

Input is a long sparse table ``vectors(item_id, key, weight)`` — one row per
non-zero coordinate (key = a user for collaborative vectors, a term for TF-IDF
vectors).  Output is ``(item_id, neighbor_id, score)`` with the ``k`` best
neighbours of every item, self excluded, ties broken by ``neighbor_id``.

Plan (no item pairs are ever materialised as rows):

1. Items are hashed into ``nb`` blocks sized from the data (items per block and
   non-zeros per block are both bounded), so one task never holds more than two
   blocks, however skewed the keys are.
2. Every row is replicated to the ``nb`` unordered block pairs its block takes
   part in and shuffled straight to the partition of its block pair
   (``repartitionById``; replication ``nb``, not the sum over keys of count²,
   which a self-join on the key would emit).
3. Inside one task, NumPy forms the block product ``W_I · W_Jᵀ`` tile by tile
   (at most 2048 x 2048 items per dense tile; dense BLAS when the key space is
   small, otherwise BLAS for the costliest keys and a chunked, vectorised merge
   on the key accumulated with ``bincount`` for the rest), turns it into
   distances or similarities, and keeps only the
   best ``k`` per row — so a task emits at most ``k · (|I| + |J|)`` rows.  A key
   shared by every item in the block (a hot user or a frequent term) costs
   ``|I|·|J|`` multiply-adds in that task and nothing more.
   Items of few entries travel as one row of arrays, so blocks can be larger
   and there are fewer copies; where their keys are few (dense vectors), a tile's
   product meets the limits of the lists so far (``_Whole``).
4. Spark keeps the global best ``k`` per item with ``row_number() <= k``, which
   the optimizer turns into a partial per-partition limit before the shuffle.
5. Hot items (more non-zeros than a task should hold) never enter a block: their
   dot products come from a join on the key, spread over all tasks, plus a
   partial/final aggregate (``_hot_candidates``).

Scores: ``l2`` is the squared Euclidean distance ``|a|² + |b|² − 2·a·b``
(ascending, every pair of items is a candidate, so it is exact even for items
sharing no key); ``cosine`` is the plain dot product of pre-normalised vectors
(descending, only positive similarities are returned).  Scores are rounded to
``decimals`` before ranking so ties are decided by id, not by float noise.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from . import routed
from .routed import Block, Items, _slack  # by name: tasks get their code with the task's, not by import

# The per-block-pair function runs in executor Python workers: ship this
# module's code with the task (pickle by value) so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUT_SCHEMA = "item_id long, neighbor_id long, score double"

# Block sizing: a task holds two blocks.  Blocks bound the replication factor
# (every non-zero is copied once per block) and the rows shipped to one Python
# worker; tiles bound the dense memory inside the task.
ITEMS_PER_BLOCK = 8192
WHOLE_ITEMS = 32768            # items of a block that are sent as whole rows (signed weights)
WHOLE_ENTRIES = 4096           # an item of more entries is sent entry by entry
WHOLE_TILE = (1024, 1024)      # rows and columns of a product of whole rows: 8 MiB
ROUTED_ITEMS = 2048            # items of a block that items are routed to by distance: few share much with so few
GROUP_ITEMS = 16384            # items of the routed blocks that one task holds
TILE_ITEMS = 2048              # dense tile inside a task: 2048² doubles = 32 MiB
ENTRIES_PER_BLOCK = 2_000_000
DENSE_CELLS = 8_000_000        # use dense BLAS when (|I|+|J|)·keys fits this
MERGE_CHUNK_PAIRS = 4_000_000  # key-matched pairs per merge chunk (~160 MB of columns)
DENSE_SHARE = 64               # keys with c_a·c_b > na·nb / 64 go through BLAS
SENT_ENTRIES = 32_000_000      # entries times blocks up to which every item is sent to every block (0.5 GB)
CLASS_ITEMS = 4096             # similarity: with more items, those of equal vectors are searched once
HOT_ENTRIES = ENTRIES_PER_BLOCK // 8  # items with more non-zeros skip the blocked path


def _dense_part(ia, ka, w, n_rows: int, n_keys: int) -> np.ndarray:
    d = np.zeros((n_rows, n_keys))
    np.add.at(d, (ia, ka), w)
    return d


def _merge_into(g: np.ndarray, ka, ia, wa, kb, ib, wb, nb: int, nkeys: int) -> None:
    """g[ia*nb + ib] += Σ wa·wb over key-matched pairs, merged in bounded chunks."""
    if len(ka) == 0 or len(kb) == 0:
        return
    pairs_per_row = np.bincount(kb, minlength=nkeys)[ka]
    cum = np.cumsum(pairs_per_row)
    total = int(cum[-1])
    edges = np.searchsorted(cum, np.arange(1, total // MERGE_CHUNK_PAIRS + 1) * MERGE_CHUNK_PAIRS)
    right = pd.DataFrame({"k": kb, "ib": ib, "wb": wb})
    for sel in np.split(np.arange(len(ka)), edges):
        if len(sel) == 0:
            continue
        left = pd.DataFrame({"k": ka[sel], "ia": ia[sel], "wa": wa[sel]})
        m = left.merge(right, on="k", how="inner", sort=False)
        if len(m):
            g += np.bincount(m["ia"].to_numpy() * nb + m["ib"].to_numpy(),
                             weights=m["wa"].to_numpy() * m["wb"].to_numpy(), minlength=len(g))


def _block_product(a: pd.DataFrame, b: pd.DataFrame, na: int, nb: int) -> np.ndarray:
    """G[i, j] = Σ_key a[i,key]·b[j,key] for local row codes ia/ib.

    Small key spaces: one dense product.  Otherwise keys are split by cost:
    a key shared by c_a rows of A and c_b rows of B costs c_a·c_b matched
    pairs in the merge but only na·nb multiply-adds in BLAS, so the costliest
    keys (c_a·c_b above na·nb/64, within the dense-cell budget) go through a
    dense product and the rest through the chunked key merge.  The key sets
    are disjoint, so the sum is exact.
    """
    keys_a = a["key"].to_numpy()
    keys_b = b["key"].to_numpy()
    codes, uniq = pd.factorize(np.concatenate([keys_a, keys_b]))
    ka, kb = codes[: len(keys_a)], codes[len(keys_a):]
    nkeys = len(uniq)
    ia, ib = a["ia"].to_numpy(), b["ib"].to_numpy()
    wa, wb = a["weight"].to_numpy(np.float64), b["weight"].to_numpy(np.float64)
    if (na + nb) * max(nkeys, 1) <= DENSE_CELLS:
        return _dense_part(ia, ka, wa, na, nkeys) @ _dense_part(ib, kb, wb, nb, nkeys).T
    work = np.bincount(ka, minlength=nkeys).astype(np.float64) * np.bincount(kb, minlength=nkeys)
    budget = DENSE_CELLS // (na + nb)
    by_cost = np.argsort(-work, kind="stable")[:budget]
    heavy = by_cost[work[by_cost] * DENSE_SHARE > float(na) * nb]
    if len(heavy):
        slot = np.full(nkeys, -1)
        slot[heavy] = np.arange(len(heavy))
        sa, sb = slot[ka], slot[kb]
        ha, hb = sa >= 0, sb >= 0
        g = (_dense_part(ia[ha], sa[ha], wa[ha], na, len(heavy))
             @ _dense_part(ib[hb], sb[hb], wb[hb], nb, len(heavy)).T).ravel()
        la, lb = ~ha, ~hb
        _merge_into(g, ka[la], ia[la], wa[la], kb[lb], ib[lb], wb[lb], nb, nkeys)
    else:
        g = np.zeros(na * nb)
        _merge_into(g, ka, ia, wa, kb, ib, wb, nb, nkeys)
    return g.reshape(na, nb)


def _best_k(r: np.ndarray, c: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best (v, c) per row r; c is in neighbour-id order."""
    order = np.lexsort((c, v, r))
    if len(order) == 0:
        return order
    rs = r[order]
    starts = np.flatnonzero(np.r_[True, rs[1:] != rs[:-1]])
    rank = np.arange(len(rs)) - np.repeat(starts, np.diff(np.r_[starts, len(rs)]))
    return order[rank < k]


def _select(val: np.ndarray, raw: np.ndarray, k: int):
    """Per row of one tile: the k best columns (ties by column = id order)."""
    n_cols = val.shape[1]
    kk = min(k, n_cols)
    kth = np.partition(val, kk - 1, axis=1)[:, kk - 1] if n_cols > kk else val.max(axis=1)
    r, c = np.nonzero((val <= kth[:, None]) & np.isfinite(val))
    keep = _best_k(r, c, val[r, c], k)
    return r[keep], c[keep], raw[r[keep], c[keep]]


def _topk_rows(a: pd.DataFrame, b: pd.DataFrame, k: int, metric: str, decimals: int,
               both: bool = False):
    """Best k columns of every row of the A×B block (self excluded).

    The block is processed in tiles of at most ``TILE_ITEMS`` x ``TILE_ITEMS``
    items, so dense memory stays bounded however large the blocks are; each
    tile keeps its own top-k per row and the tiles' candidates are merged.
    With ``both`` the B rows' best A columns come from the same tile products
    (transposed), so an off-diagonal block pair multiplies each tile once;
    then a pair of frames (A rows, B rows) is returned.
    """
    empty = pd.DataFrame({"item_id": [], "neighbor_id": [], "score": []})
    ia, items_a = pd.factorize(a["item_id"], sort=True)
    ib, items_b = pd.factorize(b["item_id"], sort=True)  # columns in id order
    items_a = np.asarray(items_a, dtype=np.int64)
    items_b = np.asarray(items_b, dtype=np.int64)
    na, nbc = len(items_a), len(items_b)
    if na == 0 or nbc == 0 or k <= 0:
        return (empty, empty) if both else empty
    if metric == "l2":
        wa2 = np.bincount(ia, weights=a["weight"].to_numpy(np.float64) ** 2, minlength=na)
        wb2 = np.bincount(ib, weights=b["weight"].to_numpy(np.float64) ** 2, minlength=nbc)
    a = a.assign(ia=ia, ta=ia // TILE_ITEMS)
    b = b.assign(ib=ib, tb=ib // TILE_ITEMS)
    a_tiles = dict(tuple(a.groupby("ta", sort=True)))
    b_tiles = dict(tuple(b.groupby("tb", sort=True)))
    acc_a: list = [[], [], []]
    acc_b: list = [[], [], []]
    for ta, at in a_tiles.items():
        a0 = ta * TILE_ITEMS
        na_t = min(TILE_ITEMS, na - a0)
        at = at.assign(ia=at["ia"] - a0)
        for tb, bt in b_tiles.items():
            b0 = tb * TILE_ITEMS
            nb_t = min(TILE_ITEMS, nbc - b0)
            g = _block_product(at, bt.assign(ib=bt["ib"] - b0), na_t, nb_t)
            if metric == "l2":
                raw = wa2[a0:a0 + na_t, None] + wb2[None, b0:b0 + nb_t] - 2.0 * g
                val = np.round(raw, decimals)
            else:  # cosine on normalised vectors: larger is better -> negate
                raw = g
                val = -np.round(raw, decimals)
                val[val >= 0] = np.inf
            val[items_a[a0:a0 + na_t, None] == items_b[None, b0:b0 + nb_t]] = np.inf
            r, c, x = _select(val, raw, k)
            acc_a[0].append(r + a0), acc_a[1].append(c + b0), acc_a[2].append(x)
            if both:
                r, c, x = _select(np.ascontiguousarray(val.T), raw.T, k)
                acc_b[0].append(r + b0), acc_b[1].append(c + a0), acc_b[2].append(x)

    def finish(acc, row_ids, col_ids):
        r, c, raw = (np.concatenate(x) for x in acc)
        val = np.round(raw, decimals) if metric == "l2" else -np.round(raw, decimals)
        keep = _best_k(r, c, val, k)
        return pd.DataFrame({"item_id": row_ids[r[keep]], "neighbor_id": col_ids[c[keep]],
                             "score": raw[keep].astype(np.float64)})

    res_a = finish(acc_a, items_a, items_b)
    return (res_a, finish(acc_b, items_b, items_a)) if both else res_a


class _Whole(Block):
    """Items as rows of a matrix, with their best neighbours by distance so far."""

    def __init__(self, ids: np.ndarray, norms: np.ndarray, matrix: np.ndarray, k: int, decimals: int):
        self.items = Items(ids, norms, None, None, None)
        self.matrix, self.k, self.metric, self.decimals = matrix, k, "l2", decimals
        self.limit = np.full(len(ids), np.inf)
        self.row = self.ids = np.zeros(0, np.int64)
        self.value = self.rounded = np.zeros(0)

    def tiles(self, size: int) -> list[_Whole]:
        """The block in parts, so that new neighbours are merged into few lists at a time."""
        cuts = [slice(at, at + size) for at in range(0, len(self.items.ids), size)]
        return [_Whole(self.items.ids[x], self.items.norms[x], self.matrix[x], self.k, self.decimals) for x in cuts]

    def offer(self, other: _Whole) -> None:
        """The items of ``other`` as candidates, by ab - |b|² / 2, which falls as the distance grows."""
        near = self.matrix @ other.matrix.T - other.items.norms / 2
        ids, limit = other.items.ids, self.limit.copy()
        none = np.flatnonzero(np.isinf(limit))
        if len(none) and len(ids) > self.k:  # one place more, as an item may meet itself
            limit[none] = np.partition(-2 * near[none], self.k, axis=1)[:, self.k]
        at = np.flatnonzero(near >= (limit + _slack(self.decimals))[:, None] / -2)
        r, c = np.divmod(at, len(ids))
        found = self.items.ids[r] != ids[c]
        if found.any():
            r, c = r[found], c[found]
            self._merge(r, ids[c], -2 * near[r, c])

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame({"item_id": self.items.ids[self.row], "neighbor_id": self.ids,
                             "score": self.items.norms[self.row] + self.value})


def _whole_blocks(sides: list[pd.DataFrame], k: int, decimals: int) -> list[_Whole] | None:
    """Blocks of rows of arrays as matrices, or None where the keys are too many for that."""
    sides = [(s["item_id"].to_numpy(np.int64), [np.asarray(x) for x in s["keys"]],
              [np.asarray(x, np.float64) for x in s["weights"]]) for s in sides]
    keys = [np.concatenate(x) if x else np.zeros(0, np.int64) for _, x, _ in sides]
    codes, uniq = pd.factorize(np.concatenate(keys))
    if sum(len(ids) for ids, _, _ in sides) * max(1, len(uniq)) > DENSE_CELLS:
        return None
    out, done = [], 0
    for (ids, lists, weights), flat in zip(sides, keys):
        row = np.repeat(np.arange(len(ids)), [len(x) for x in lists])
        w = np.concatenate(weights) if weights else np.zeros(0)
        norms = np.bincount(row, weights=w * w, minlength=len(ids))
        matrix = _dense_part(row, codes[done:done + len(flat)], w, len(ids), len(uniq))
        done += len(flat)
        real = np.isfinite(norms)  # others are at no distance from anybody
        out.append(_Whole(ids[real], norms[real], matrix[real], k, decimals))
    return out


def _whole_pair(a: pd.DataFrame, b: pd.DataFrame | None, k: int, decimals: int) -> list[pd.DataFrame] | None:
    """Best k by distance of the rows of A among those of B, and the other way round; among themselves without B."""
    blocks = _whole_blocks([a] if b is None else [a, b], k, decimals)
    if blocks is None:
        return None
    rows, cols = (x.tiles(size) for x, size in zip((blocks[0], blocks[-1]), WHOLE_TILE))
    for one in rows:
        for other in cols:
            one.offer(other)
            if b is not None:  # forming the product again takes less time than turning it
                other.offer(one)
    return [x.frame() for x in (rows if b is None else rows + cols)] or [pd.DataFrame({"item_id": [], "neighbor_id": [], "score": []})]


def _entries(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of arrays as one row an entry."""
    return pd.DataFrame({"item_id": np.repeat(rows["item_id"].to_numpy(), [len(x) for x in rows["keys"]]),
                         "key": np.concatenate([np.asarray(x) for x in rows["keys"]] or [np.zeros(0, np.int64)]),
                         "weight": np.concatenate([np.asarray(x, np.float64) for x in rows["weights"]] or [np.zeros(0)])})


def _pair_task(k: int, metric: str, decimals: int, n_blocks: int):
    los = np.arange(n_blocks)
    starts = los * n_blocks - los * (los - 1) // 2  # id of the first pair of each lower block

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pair = int(pdf["gid"].iloc[0])
        lo = int(np.searchsorted(starts, pair, side="right")) - 1
        hi = lo + pair - int(starts[lo])
        if "keys" in pdf:
            sides = [pdf[pdf["blk"] == x] for x in sorted({lo, hi})]
            found = _whole_pair(sides[0], None if lo == hi else sides[1], k, decimals) if metric == "l2" and k > 0 else None
            if found is not None:
                return pd.concat(found, ignore_index=True).astype({"item_id": "int64", "neighbor_id": "int64", "score": "float64"})
            pdf = pd.concat([_entries(side).assign(blk=x) for side, x in zip(sides, sorted({lo, hi}))], ignore_index=True)
        a = pdf[pdf["blk"] == lo]
        out = []
        if lo == hi:
            out.append(_topk_rows(a, a, k, metric, decimals))
        else:
            b = pdf[pdf["blk"] == hi]
            out.extend(_topk_rows(a, b, k, metric, decimals, both=True))
        res = pd.concat(out, ignore_index=True)
        return res.astype({"item_id": "int64", "neighbor_id": "int64", "score": "float64"})

    return run


def _run_per_group(rows: DataFrame, n_groups: int, task, max_partitions: int) -> DataFrame:
    """Run ``task(pdf)`` once per ``gid`` group, one group per task where possible.

    ``repartitionById`` sends group g to partition g mod n directly (no range
    sampling job, no hash collisions: with n = number of groups every task gets
    exactly one group); ``mapInPandas`` then consumes the partition.  One
    exchange, and no sort unless the group count exceeds ``max_partitions``:
    then partitions are sorted by ``gid`` and groups are streamed one at a time,
    so a task never holds more than one group.  An explicit partition count
    also keeps AQE from folding the CPU-heavy groups into a few tasks.
    """
    parts = max(1, min(n_groups, max_partitions))
    several = n_groups > parts
    out_types = {"item_id": "int64", "neighbor_id": "int64", "score": "float64"}

    def run(group: pd.DataFrame):
        out = task(group)
        if len(out):
            yield out.astype(out_types)

    def per_partition(batches):
        pending, current = [], None
        for b in batches:
            if not len(b):
                continue
            gids = b["gid"].to_numpy()
            cuts = np.flatnonzero(gids[1:] != gids[:-1]) + 1 if several else []
            for piece in np.split(np.arange(len(b)), cuts):
                gid = gids[piece[0]]
                if several and current is not None and gid != current:
                    yield from run(pd.concat(pending, ignore_index=True))
                    pending = []
                current = gid
                pending.append(b.iloc[piece])
        if pending:
            whole = pd.concat(pending, ignore_index=True)
            if several:
                yield from run(whole)
            else:  # one group per partition, where ids have no gaps
                for _, g in whole.groupby("gid", sort=False):
                    yield from run(g)

    target = F.pmod(F.col("gid"), F.lit(parts)).cast("int")
    placed = rows.repartitionById(parts, target)
    if several:
        placed = placed.sortWithinPartitions("gid")
    return placed.mapInPandas(per_partition, OUT_SCHEMA)


def _sizes(vectors: DataFrame) -> DataFrame:
    """Per item: non-zeros, smallest weight and squared norm."""
    return vectors.groupBy("item_id").agg(F.count("*").alias("c"), F.min("weight").alias("wmin"),
                                          F.sum(F.col("weight") * F.col("weight")).alias("norm"))


def _profile(sizes: DataFrame) -> dict:
    """Item count, non-zeros, largest item and smallest weight."""
    row = sizes.agg(F.count("*").alias("n"), F.sum("c").alias("nnz"), F.max("c").alias("cmax"),
                       F.min("wmin").alias("wmin")).first()
    return {"n_items": int(row["n"] or 0), "nnz": int(row["nnz"] or 0),
            "max_item_nnz": int(row["cmax"] or 0), "min_weight": float(row["wmin"] or 0.0)}


def profile(vectors: DataFrame) -> dict:
    """Size of a vector table: n_items, nnz, max_item_nnz, min_weight."""
    return _profile(_sizes(vectors))


def _blocks_for(n_items: int, nnz: int, parallelism: int, items_per_block: int = ITEMS_PER_BLOCK,
                entries_per_block: int = ENTRIES_PER_BLOCK) -> int:
    """Enough blocks that no block exceeds the item or non-zero budget, and —
    when the data allows — enough block pairs to give every core two tasks."""
    nb = max(1, math.ceil(n_items / items_per_block), math.ceil(nnz / entries_per_block))
    max_nb = max(1, n_items // 256)  # keep blocks large enough to be worth a task
    while nb * (nb + 1) // 2 < 2 * parallelism and nb < max_nb:
        nb += 1
    return nb


def _seeker_blocks(n_items: int, nnz: int, parallelism: int, items_per_block: int = ITEMS_PER_BLOCK) -> int:
    """Blocks of a routed search: bounded in items and non-zeros, and a task a core where there are enough items."""
    return max(1, math.ceil(n_items / items_per_block), math.ceil(nnz / ENTRIES_PER_BLOCK), min(parallelism, n_items // 256))


def _parallelism(df: DataFrame) -> int:
    """Cores available to the session (falls back to conf where no SparkContext is exposed)."""
    spark = df.sparkSession
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session
        return int(spark.conf.get("spark.default.parallelism", None)
                   or spark.conf.get("spark.sql.shuffle.partitions"))


def block_count(vectors: DataFrame) -> int:
    prof = profile(vectors)
    return _blocks_for(prof["n_items"], prof["nnz"], _parallelism(vectors))


def _blocked_candidates(vectors: DataFrame, k: int, metric: str, decimals: int, nb: int,
                        max_partitions: int, whole: bool = False) -> DataFrame:
    """Per block pair top-k candidates (item_id, neighbor_id, raw score); ``whole`` items are sent as one row of arrays."""
    n_pairs = nb * (nb + 1) // 2
    vectors = vectors.select(F.col("item_id").cast("long").alias("item_id"), "key", F.col("weight").cast("double").alias("weight"))
    if whole:
        vectors = vectors.groupBy("item_id").agg(F.collect_list(F.struct("key", "weight")).alias("e")).select(
            "item_id", F.col("e.key").alias("keys"), F.col("e.weight").alias("weights"))
    rows = vectors.withColumn("blk", F.pmod(F.xxhash64("item_id"), F.lit(nb)).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("partner")
    # Unordered block pairs (lo, hi) numbered without gaps, so that no two share a task.
    lo, hi = F.least("blk", "partner").cast("long"), F.greatest("blk", "partner")
    pair_id = lo * nb - (lo * (lo - 1) / 2).cast("long") + hi - lo
    replicated = rows.select("*", partner).select(pair_id.alias("gid"), *vectors.columns, "blk")
    return _run_per_group(replicated, n_pairs, _pair_task(k, metric, decimals, nb), max_partitions)


def _hot_candidates(vectors: DataFrame, hot: DataFrame, k: int, metric: str, decimals: int,
                    nonnegative: bool) -> DataFrame:
    """Candidates for every pair involving a hot item, without holding it in one task.

    Dot products come from a join on the key with the hot items' entries
    (partitioned by key, so a hot item's vector is spread over all tasks) and a
    partial/final aggregate per (hot item, item).  For ``l2``, pairs sharing no
    key have distance |a|² + |b|²; with non-negative weights only the k+1
    globally smallest norms can win such a slot (any other item is beaten by k
    of them), so those few pairs are added explicitly instead of all pairs.
    """
    hv = (vectors.join(hot, "item_id", "left_semi")
          .select(F.col("item_id").alias("h"), "key", F.col("weight").alias("wh")))
    dots = (vectors.join(hv, "key").where(F.col("item_id") != F.col("h"))
            .groupBy("h", "item_id").agg(F.sum(F.col("weight") * F.col("wh")).alias("dot")))
    own = dots.select(F.col("h").alias("item_id"), F.col("item_id").alias("neighbor_id"), "dot")
    as_neighbor = (dots.join(hot, "item_id", "left_anti")
                   .select("item_id", F.col("h").alias("neighbor_id"), "dot"))
    pairs = own.unionByName(as_neighbor)
    if metric == "cosine":
        return (pairs.where(F.round("dot", decimals) > 0)
                .select("item_id", "neighbor_id", F.col("dot").alias("score")))
    if not nonnegative:
        raise ValueError("the hot-item path for l2 needs non-negative weights")
    norms = vectors.groupBy("item_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n"))
    small = norms.orderBy("n", "item_id").limit(k + 1).select("item_id")  # k+1 ids
    small_ids = small.select(F.collect_list("item_id")).scalar()
    hot_small_ids = small.join(hot, "item_id", "left_semi").select(F.collect_list("item_id")).scalar()
    zero = (hot.select("item_id", F.explode(small_ids).alias("neighbor_id"))
            .unionByName(norms.join(hot, "item_id", "left_anti")
                         .select("item_id", F.explode(hot_small_ids).alias("neighbor_id")))
            .where(F.col("item_id") != F.col("neighbor_id"))
            .withColumn("dot", F.lit(0.0)))
    summed = pairs.unionByName(zero).groupBy("item_id", "neighbor_id").agg(F.sum("dot").alias("dot"))
    ni = norms.select("item_id", F.col("n").alias("ni"))
    nj = norms.select(F.col("item_id").alias("neighbor_id"), F.col("n").alias("nj"))
    return (summed.join(ni, "item_id").join(nj, "neighbor_id")
            .select("item_id", "neighbor_id",
                    (F.col("ni") + F.col("nj") - F.lit(2.0) * F.col("dot")).alias("score")))


def _query_task(k: int, metric: str, decimals: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q = pdf[pdf["side"] == 0]
        c = pdf[pdf["side"] == 1]
        res = _topk_rows(q, c, k, metric, decimals)
        return res.astype({"item_id": "int64", "neighbor_id": "int64", "score": "float64"})
    return run


def _query_candidates(vectors: DataFrame, queries: DataFrame, k: int, metric: str, decimals: int,
                      nb: int, nqb: int, max_partitions: int) -> DataFrame:
    """Top-k candidates for the query items only: query blocks x candidate blocks.

    Query rows are replicated to every candidate block and candidate rows to
    every query block, so the work is |Q|·M instead of M² and a request for a
    handful of items touches each candidate non-zero once.
    """
    q = (vectors.join(queries, "item_id", "left_semi")
         .select("item_id", "key", "weight", F.lit(0).alias("side"),
                 F.pmod(F.xxhash64("item_id"), F.lit(nqb)).alias("qb"),
                 F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("cb")))
    c = (vectors.select("item_id", "key", "weight", F.lit(1).alias("side"),
                        F.explode(F.sequence(F.lit(0), F.lit(nqb - 1))).alias("qb"),
                        F.pmod(F.xxhash64("item_id"), F.lit(nb)).alias("cb")))
    rows = q.unionByName(c).withColumn("gid", F.col("qb") * nb + F.col("cb"))
    return _run_per_group(rows.select("gid", "item_id", "key", "weight", "side"), nqb * nb,
                          _query_task(k, metric, decimals), max_partitions)


class Stored:
    """Vectors that several searches read: written once, with their items' sizes and, for searches by distance of some items, as rows."""

    def __init__(self, vectors: DataFrame):
        self.vectors = written(vectors.select(F.col("item_id").cast("long").alias("item_id"), F.col("key").cast("long").alias("key"),
                                              F.col("weight").cast("double").alias("weight")), "knn-vectors")
        self.sizes = written(_sizes(self.vectors), "knn-sizes")
        self.profile = _profile(self.sizes)
        self._rows = None

    def rows(self) -> DataFrame:
        if self._rows is None:
            self._rows = written(routed.rows_of(self.vectors), "knn-items")
        return self._rows


def _similar_by_class(vectors: DataFrame, k: int, decimals: int, queries: DataFrame | None, **search) -> DataFrame:
    """Similarity lists searched once for each different vector, then told to all of its items.

    Items whose weights agree to 12 decimals are a class, named by its least id.
    The ``k`` best other classes by (score, least id) hold everything that can
    enter a list: each item of a further class comes after their ``k`` least ids.
    """
    entries = F.sort_array(F.collect_list(F.struct("key", F.round("weight", 12).alias("weight"))))
    vector = vectors.groupBy("item_id").agg(entries.alias("e"))
    members = vector.withColumn("cls", F.min("item_id").over(Window.partitionBy("e"))).select("item_id", "cls")
    members = written(members, "knn-members")
    reps = written(vectors.join(members.where("item_id = cls").select("item_id"), "item_id", "left_semi"), "knn-classes")
    asked = members if queries is None else members.join(queries, "item_id", "left_semi")
    seek = None if queries is None else asked.select(F.col("cls").alias("item_id")).distinct()
    lists = top_k_neighbors(reps, k, "cosine", decimals, queries=seek, classes=False, **search)
    own = _sizes(reps if seek is None else reps.join(seek, "item_id", "left_semi")).select(
        "item_id", F.col("item_id").alias("neighbor_id"), F.round("norm", decimals).alias("score"))
    near = lists.select("item_id", "neighbor_id", "score").unionByName(own.where("score > 0"))
    by_id = Window.partitionBy("cls").orderBy("item_id")
    first = members.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1).groupBy("cls").agg(
        F.collect_list("item_id").alias("ids")).withColumnRenamed("cls", "neighbor_id")
    # a class's list is one place longer, as an item may meet itself in it
    offered = near.join(first, "neighbor_id").select("item_id", "score", F.explode("ids").alias("id"))
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "id")
    offered = offered.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).groupBy("item_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("list")).withColumnRenamed("item_id", "cls")
    told = asked.join(offered, "cls").select("item_id", F.filter("list", lambda x: x["id"] != F.col("item_id")).alias("list"))
    return told.select("item_id", F.posexplode(F.slice("list", 1, k)).alias("at", "x")).select(
        "item_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("neighbor_id"), F.col("x.score").alias("score"))


def top_k_neighbors(vectors: DataFrame | Stored, k: int, metric: str = "l2", decimals: int = 6,
                    n_blocks: int | None = None, max_partitions: int = 20000,
                    hot_entries: int | None = None, queries: DataFrame | None = None,
                    indexed: bool | None = None, candidates: DataFrame | None = None, classes: bool | None = None) -> DataFrame:
    """Exact k nearest items for every item in ``vectors(item_id, key, weight)``.

    ``vectors`` that several searches read are given ``Stored``.
    Returns ``(item_id, rank, neighbor_id, score)`` where ``score`` is the
    rounded squared distance (``l2``) or similarity (``cosine``).  Non-negative weights go through ``routed`` (an inverted
    index and bounds decide which items meet; ``indexed`` forces or forbids the
    index), signed ones through block pairs.
    Items with more than ``hot_entries`` non-zeros (default ``HOT_ENTRIES``) are taken out
    of the blocked path and handled by ``_hot_candidates``.  With ``queries``
    (a DataFrame of ``item_id``), only those items get neighbour lists — every
    item is still a candidate — at a cost proportional to the query count; with
    ``candidates`` too, only those are offered (non-negative weights and no item
    beyond ``hot_entries``).  With ``classes``, items of equal vectors are searched once (cosine only; by
    default where there are more than ``CLASS_ITEMS`` items and no ``candidates``).
    """
    if candidates is not None and queries is None:
        raise ValueError("candidates need queries")
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    # Sizing needs counts; write the vectors to the shared checkpoint folder
    # first so the upstream pipeline runs once, lineage is cut and a lost
    # executor re-reads files instead of recomputing the pipeline.
    stored = vectors if isinstance(vectors, Stored) else Stored(vectors)
    vectors, sizes, prof = stored.vectors, stored.sizes, stored.profile
    if classes is None:
        classes = metric == "cosine" and candidates is None and prof["n_items"] > CLASS_ITEMS
    if classes:
        if metric != "cosine" or candidates is not None:
            raise ValueError("classes are for cosine without candidates")
        asked = None if queries is None else queries.select(F.col("item_id").cast("long").alias("item_id")).distinct()
        return _similar_by_class(vectors, k, decimals, asked, n_blocks=n_blocks, max_partitions=max_partitions,
                                 hot_entries=hot_entries, indexed=indexed)
    hot_limit = HOT_ENTRIES if hot_entries is None else hot_entries
    parallelism = _parallelism(vectors)
    hot = None
    # The hot path is exact for cosine, and for l2 when weights are
    # non-negative (the smallest-norm rule); signed l2 vectors (dense
    # embeddings, never hot in practice) stay on the blocked path.
    nonnegative = prof["min_weight"] >= 0
    if candidates is not None and (not nonnegative or prof["max_item_nnz"] > hot_limit):
        raise ValueError("candidates need non-negative weights and no hot item")
    if prof["max_item_nnz"] > hot_limit and (metric == "cosine" or nonnegative):
        hot = written(sizes.where(F.col("c") > hot_limit).select("item_id"), "knn-hot")
    normal = vectors if hot is None else vectors.join(hot, "item_id", "left_anti")
    if queries is not None:
        queries = queries.select(F.col("item_id").cast("long").alias("item_id")).distinct().checkpoint(eager=True)
        n_q = queries.count()
        q_nnz = prof["nnz"] if n_q >= prof["n_items"] else vectors.join(queries, "item_id", "left_semi").count()
    if nonnegative:
        seek = (prof["n_items"], prof["nnz"]) if queries is None else (n_q, q_nnz)
        nb = n_blocks or _seeker_blocks(*seek, parallelism)
        if indexed is None:
            indexed = prof["nnz"] * nb > SENT_ENTRIES
        if indexed:
            norms = (sizes if hot is None else sizes.join(hot, "item_id", "left_anti")).select("item_id", "norm")
            together = 1
            if metric == "l2" and n_blocks is None:
                nb = max(nb, math.ceil(seek[0] / ROUTED_ITEMS))
                together = nb // _seeker_blocks(*seek, 3 * parallelism, GROUP_ITEMS)
            found = routed.RoutedSearch(normal, norms, k, metric, decimals, nb, queries, candidates, together,
                                        stored.rows() if metric == "l2" and queries is not None and hot is None else None)
        else:
            found = routed.SentToAll(normal, k, metric, decimals, nb, queries, candidates)
        lists = found.lists(max_partitions)
        if hot is None:
            return lists
        pairs = lists.select("item_id", "neighbor_id", "score")
    elif queries is None:
        whole = prof["max_item_nnz"] <= WHOLE_ENTRIES
        nb = n_blocks or _blocks_for(prof["n_items"], prof["nnz"], parallelism, WHOLE_ITEMS if whole else ITEMS_PER_BLOCK)
        pairs = _blocked_candidates(normal, k, metric, decimals, nb, max_partitions, whole)
    else:
        nqb = max(1, math.ceil(n_q / ITEMS_PER_BLOCK), math.ceil(q_nnz / ENTRIES_PER_BLOCK))
        nb_c = n_blocks or _blocks_for(prof["n_items"], prof["nnz"], max(1, parallelism // nqb))
        pairs = _query_candidates(normal, queries, k, metric, decimals, nb_c, nqb, max_partitions)
    if hot is not None:
        hot_c = _hot_candidates(vectors, hot, k, metric, decimals, nonnegative)
        if queries is not None:
            hot_c = hot_c.join(queries, "item_id", "left_semi")
        pairs = pairs.unionByName(hot_c)
    score = F.round("score", decimals)
    order = [score.asc() if metric == "l2" else score.desc(), F.col("neighbor_id").asc()]
    w = Window.partitionBy("item_id").orderBy(*order)
    return (pairs.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .select("item_id", "rank", "neighbor_id", score.alias("score")))


def _window_task(k: int, metric: str, decimals: int, pairs: int, together: int):
    groups = -(-pairs // together)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        win, ids = pdf["win"].to_numpy(), pdf["item_id"].to_numpy()
        everywhere = np.flatnonzero(win < 0)
        parts = [pd.DataFrame({"item_id": [], "neighbor_id": [], "score": []})]
        group = int(pdf["gid"].iloc[0]) % groups
        for first in range(group * together, min((group + 1) * together, pairs)):
            inside = np.flatnonzero((win == first) | (win == first + 1))
            inside = inside[~np.isin(ids[inside], ids[everywhere])]
            entries = _entries(pdf.iloc[np.concatenate([everywhere, inside])])
            parts.append(_topk_rows(entries, entries, k, metric, decimals))
        return pd.concat(parts, ignore_index=True).astype({"item_id": "int64", "neighbor_id": "int64", "score": "float64"})
    return run


def top_k_within_windows(rows: DataFrame, k: int, pairs: int, together: int, tables: int, metric: str = "l2",
                         decimals: int = 6) -> DataFrame:
    """Exact top-k among the items of each two neighbouring windows, merged per item.

    Each of the ``tables`` has windows 0 to ``pairs``; a task searches ``together``
    pairs of neighbours, one after the other, so only the items of the windows between two
    tasks are sent twice.  ``rows(gid, win, item_id, keys, weights)`` carries an
    item's sparse vector once a task: ``gid`` is the table's number times the tasks of a table, plus the
    task; an item of no window (``win`` -1) is in every pair.  An item's best k
    over all pairs is kept after de-duplicating neighbours found in several.
    """
    cands = _run_per_group(rows.select("gid", "win", "item_id", "keys", "weights"), tables * -(-pairs // together),
                           _window_task(k, metric, decimals, pairs, together), 20000)
    best = cands.groupBy("item_id", "neighbor_id").agg(F.min("score").alias("score"))
    score = F.round("score", decimals)
    order = [score.asc() if metric == "l2" else score.desc(), F.col("neighbor_id").asc()]
    w = Window.partitionBy("item_id").orderBy(*order)
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("item_id", "rank", "neighbor_id", score.alias("score")))
