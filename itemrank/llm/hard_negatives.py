"""Hard negatives: anchor spanning trees bound inner products, only overlapping candidates are rescored.

Anchors are sorted by (label, a projection) and cut into runs of at most
``TREE`` anchors; each run gets a minimum spanning tree over its vectors.  In
a task, the tree meets a block of candidates: the root is scored against all
of them; at a child a of p, <p, c> plus or minus |a - p| * |c| bounds <a, c>
for every candidate c, and only candidates whose bounds reach the anchor's
window are scored again (they carry their exact score on, the others their
bounds, widened by each edge).  The first pass looks for positives, where the
window is what can still be among the best of the same label; the second one
for negatives, whose windows are set by the positives' scores.

Candidates are hashed into blocks of at most ``BLOCK_CELLS`` components (with
a few blocks a core where there are fewer rows).  Anchors, which are the small
side, are sent to every block as trees, and a task streams them through its
block: it holds one block, one tree and the tree's bounds for ``TILE``
candidates, whatever the number of rows.  It sends out the best few of each
anchor and window, so no pairs are spread by label, and a frequent label or
vector makes no large group.  Every anchor meets every row: the work grows
with anchors times rows, as an exact search over a stated query set does; how
many of these are rescored depends on how near anchors lie to each other.

Scores are exact integers (64-bit products where doubles would round).  Rows
with a null id, label or vector or any null or non-finite component take no
part; nor do rows whose scaled vector is longer than 2**31, whose products a
long can't hold.  Missing components of shorter vectors count as zero.  Of
rows that share a ``vec_id`` the least (label, vector) counts.  Ties go to the
smaller id.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .textops import ragged

TREE = 256               # anchors of one spanning tree
TILE = 4096              # candidates bounded at a time
BLOCK_CELLS = 1 << 21    # components of a candidate block: 16 MB as doubles
MAX_TASKS = 20000
_EXACT = float(1 << 53)  # doubles hold integers up to here


def scaled_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector) as the mining reads them: integer components, relabelled multiples of 7."""
    usable = embeddings.where(
        "vec_id is not null and label is not null and embedding is not null and "
        "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    scaled = usable.selectExpr(
        "cast(vec_id as long) as vec_id",
        "if(vec_id % 7 = 0, (cast(label as long) + 1) % 10, cast(label as long)) as label",
        "transform(embedding, x -> floor(256 * cast(x as double))) as vector")
    fits = scaled.where("aggregate(vector, 0d, (s, x) -> s + cast(x as double) * cast(x as double)) <= pow(2d, 62)")
    return fits.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.*")


def _matrix(column, dims: int) -> np.ndarray:
    """Rows of an Arrow list column, padded with zeros to ``dims``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return values.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims), np.int64)
    row, at = ragged(np.cumsum(lengths) - lengths, lengths)
    out[row, at - (np.cumsum(lengths) - lengths)[row]] = values
    return out


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prim's minimum spanning tree: (order, parent's place in the order, upper bound of the edge's length)."""
    n = len(vectors)
    order, parent, edge = np.zeros(n, int), np.full(n, -1), np.zeros(n)
    left = np.ones(n, bool)
    best, nearest = np.full(n, np.inf), np.zeros(n, int)
    now = 0
    for place in range(n):
        order[place], left[now] = now, False
        if place:
            parent[place], edge[place] = nearest[now], best[now]
        far = np.sqrt(((vectors - vectors[now]) ** 2).sum(axis=1))
        closer = left & (far < best)
        best[closer], nearest[closer] = far[closer], place
        now = int(np.argmin(np.where(left, best, np.inf)))
    return order, parent, edge * (1 + 1e-9)


def anchor_trees(anchors: DataFrame, dims: int, tree: int = TREE) -> DataFrame:
    """(tree, place, parent, edge, vec_id, label, vector): spanning trees of at most ``tree`` anchors.

    Parents stand before their children; the root of a tree has parent -1.  A
    tree is named by its first anchor.
    """
    def grow(rows: list[tuple]) -> pa.RecordBatch:
        ids, labels, vectors = (np.concatenate(x) for x in zip(*rows))
        order, parent, edge = spanning_tree(vectors.astype(np.float64))
        flat = pa.array(vectors[order].ravel(), pa.int64())
        offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * dims, pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(ids), ids[0]), pa.int64()), pa.array(np.arange(len(ids)), pa.int32()),
             pa.array(parent, pa.int32()), pa.array(edge, pa.float64()), pa.array(ids[order], pa.int64()),
             pa.array(labels[order], pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
            names=["tree", "place", "parent", "edge", "vec_id", "label", "vector"])

    def runs(batches):
        held, n = [], 0
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
            vectors = _matrix(batch.column("vector"), dims)
            at = 0
            while at < len(ids):
                take = min(len(ids) - at, tree - n)
                held.append((ids[at:at + take], labels[at:at + take], vectors[at:at + take]))
                at, n = at + take, n + take
                if n == tree:
                    yield grow(held)
                    held, n = [], 0
        if n:
            yield grow(held)

    side = "aggregate(transform(vector, (x, i) -> if(xxhash64(i) % 2 = 0, x, -x)), 0d, (s, x) -> s + x)"
    near = anchors.select("vec_id", "label", "vector", F.expr(side).alias("side"))
    order = ["label", "side", "vec_id"]
    return near.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "label", "vector").mapInArrow(
        runs, "tree long, place int, parent int, edge double, vec_id long, label long, vector array<long>")


class _Block:
    """Candidates of one block, in tiles; scores anchors against them."""

    def __init__(self, rows: list[tuple]):
        self.ids, self.labels, self.vectors = (np.concatenate(x) for x in zip(*rows))
        self.doubles = self.vectors.astype(np.float64)
        self.norms = np.sqrt((self.doubles ** 2).sum(axis=1)) * (1 + 1e-12)
        self.longest = self.norms.max()

    def scores(self, rows, anchor: np.ndarray, length: float) -> np.ndarray:
        """Exact inner products of the anchor with the rows (a slice or places)."""
        if self.longest * length < _EXACT:
            return (self.doubles[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ anchor


class _Window:
    """The best ``k`` (score, id) of candidates with ``low <= score <= high`` seen so far."""

    def __init__(self, low: float, high: float, k: int):
        self.low, self.high, self.k = low, high, k
        self.scores = self.ids = np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.low) & (scores <= self.high)
        if not inside.any():
            return
        scores, ids = np.concatenate([self.scores, scores[inside]]), np.concatenate([self.ids, ids[inside]])
        if len(scores) > self.k:
            least = np.partition(scores, -self.k)[-self.k]
            scores, ids = scores[scores >= least], ids[scores >= least]
        best = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[best], ids[best]
        if len(best) == self.k:  # what scores lower can't enter any more; an equal score may, by its id
            self.low = max(self.low, int(self.scores[-1]))


def descend(block: _Block, tree: dict, windows: list[list[_Window]], same_label: bool) -> int:
    """Fill the windows of a tree's anchors from a block; returns how many scores were computed."""
    vectors, parents, edges = tree["vector"], tree["parent"], tree["edge"]
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-12)
    scored = 0
    for start in range(0, len(block.ids), TILE):
        tile = slice(start, min(start + TILE, len(block.ids)))
        ids, labels, norms = block.ids[tile], block.labels[tile], block.norms[tile]
        middle = np.zeros((len(vectors), len(ids)))
        radius = np.zeros((len(vectors), len(ids)))
        for place, anchor in enumerate(vectors):
            wanted = (labels == tree["label"][place]) == same_label
            if parents[place] < 0:
                scores = block.scores(tile, anchor, lengths[place])
                scored += len(scores)
                middle[place] = scores
                again = np.flatnonzero(wanted)
                scores = scores[again]
            else:
                at = parents[place]
                middle[place] = middle[at]
                radius[place] = radius[at] + edges[place] * norms + 1e-9 * np.abs(middle[at]) + 1e-6
                low, high = middle[place] - radius[place], middle[place] + radius[place]
                reach = np.zeros(len(ids), bool)
                for w in windows[place]:
                    reach |= (high >= w.low) & (low <= w.high)
                again = np.flatnonzero(reach & wanted)
                rows = tile if len(again) == len(ids) else start + again
                scores = block.scores(rows, anchor, lengths[place]) if len(again) else np.zeros(0, np.int64)
                scored += len(scores)
                middle[place, again], radius[place, again] = scores, 0.0
            other = ids[again] != tree["vec_id"][place]
            for w in windows[place]:
                w.add(scores[other], ids[again][other])
    return scored


_ANCHOR = ["tree", "place", "parent", "edge", "vec_id", "label", "vector", "found"]


def _search(vectors: DataFrame, trees: DataFrame, dims: int, blocks: int, window_of, same_label: bool, k: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score, other_id, score): the best of each window in each block.

    ``trees`` carries ``found``, the positives (id, score) of each anchor;
    ``window_of(found)`` gives its windows as (positive_id, positive_score, low, high).
    """
    parts = min(blocks, MAX_TASKS)
    none = {"tree": "long", "place": "int", "parent": "int", "edge": "double"}
    candidates = vectors.select(
        F.expr(f"cast(pmod(xxhash64(vec_id), {blocks}) as int)").alias("block"), F.lit(0).alias("side"),
        *[F.lit(None).cast(t).alias(c) for c, t in none.items()], "vec_id", "label", "vector",
        F.lit(None).cast("array<struct<id:long,score:long>>").alias("found"))
    sent = trees.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("side"), *_ANCHOR)
    rows = candidates.unionByName(sent).repartitionById(parts, F.col("block") % parts).sortWithinPartitions(
        "block", "side", "tree", "place")

    def finish(block, held) -> list[tuple]:
        if block is None or not held:
            return []
        tree = {c: np.concatenate([h[c] for h in held]) for c in ("vec_id", "label", "vector", "parent", "edge")}
        found = [f for h in held for f in h["found"]]
        spans = [window_of(f) for f in found]
        windows = [[_Window(low, high, k) for *_, low, high in s] for s in spans]
        descend(block, tree, windows, same_label)
        return [(int(a), p, ps, int(i), int(s)) for a, span, ws in zip(tree["vec_id"], spans, windows)
                for (p, ps, *_), w in zip(span, ws) for i, s in zip(w.ids, w.scores)]

    def as_batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                          names=["anchor_id", "positive_id", "positive_score", "other_id", "score"])

    def run(batches):
        number, block, rows_of_block, tree, held = None, None, [], None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = [batch.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in ("block", "side", "tree")]
            cuts = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1]) | (key[2][1:] != key[2][:-1])) + 1
            for first, last in zip([0, *cuts], [*cuts, batch.num_rows]):
                piece = batch.slice(first, last - first)
                now = tuple(int(x[first]) for x in key)
                if held and (now[0] != number or now[2] != tree):
                    if out := finish(block, held):
                        yield as_batch(out)
                    held = []
                if now[0] != number:
                    number, block, rows_of_block = now[0], None, []
                ids, labels = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
                matrix = _matrix(piece.column("vector"), dims)
                if now[1] == 0:
                    rows_of_block.append((ids, labels, matrix))
                    continue
                if block is None and rows_of_block:
                    block, rows_of_block = _Block(rows_of_block), []
                tree = now[2]
                held.append({"vec_id": ids, "label": labels, "vector": matrix, "found": piece.column("found").to_pylist(),
                             "parent": piece.column("parent").to_numpy(), "edge": piece.column("edge").to_numpy()})
        if out := finish(block, held):
            yield as_batch(out)

    return rows.mapInArrow(run, "anchor_id long, positive_id long, positive_score long, other_id long, score long")


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100, tree: int = TREE) -> DataFrame:
    """Hard negatives of the rows of ``vectors(vec_id, label, vector)`` whose id ``every`` divides.

    An anchor's positives are its ``positives`` best other rows of its label.
    Negatives of an anchor and a positive are the ``negatives`` best rows of
    other labels with low % <= score / positive's score <= high %.  Returns
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    """
    vectors = written(vectors, "vectors")
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dims")).first()
    n, dims = size["n"], max(1, size["dims"] or 0)
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, math.ceil(n * dims / BLOCK_CELLS), min(2 * cores, n // 1024))
    trees = written(anchor_trees(vectors.where(F.col("vec_id") % every == 0), dims, tree), "trees")

    def best_of_label(found):
        return [(0, 0, -math.inf, math.inf)]

    def around(found):
        return [(f["id"], f["score"], -(-low * f["score"] // 100), high * f["score"] // 100) for f in found or []]

    none = F.lit(None).cast("array<struct<id:long,score:long>>").alias("found")
    near = _search(vectors, trees.select("*", none), dims, blocks, best_of_label, True, positives)
    found = _best(near, ["anchor_id"], positives).groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct(F.col("other_id").alias("id"), "score")).alias("found"))
    far = _search(vectors, trees.join(found, "vec_id", "left"), dims, blocks, around, False, negatives)
    return _best(far, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
