"""Quality classifier: regularised quadratic discriminant over document statistics.

Statistics.  Each whole text gives the numbers of ``STATISTICS``: sizes, shares
of byte classes, and shares of repeated words, lines and word triples.  Sizes
are transformed by a logarithm, shares by the arc sine of their root, and the
result is kept in steps of 1 / ``SCALE``, so that the sums below are sums of
whole numbers and don't depend on the order in which Spark adds them.

Fit.  Counts, sums and products of the labelled rows that are not held out are
added up per (fold, class) in one aggregate; nothing but those few hundred
numbers reaches the driver, and all labelled rows count.  A class covariance is
shrunk towards the pooled one (``SHRINK``) and that towards its mean variance
(``RIDGE``).  Both, and the temperature by which log-density differences are
divided, are chosen by the log loss over ``FOLDS`` folds, each scored by
the model of the others, in one more pass over the labelled rows.

Scores.  A class density needs the Mahalanobis distance only: the inverse
Cholesky factors and log determinants are computed once on the driver and go
with the tasks.  The score is the logistic function of the tempered difference
of log densities plus the log odds of the classes.

Nulls: a null text counts as empty, and an empty text is scored like any other.
Null or other labels than 0 and 1, and labels of unknown or null ids, are not
used; a repeated label or document counts as often as it stands.  A null
``doc_id`` is not held out.  Without labels of both classes every text has the
same score, (good + 1) / (labels + 2).  Long texts are used whole.  Labels,
language, source and id are no inputs of a score; other columns are not read.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .textops import as_long, blank_separated, mix, ngram_hashes, text_chunks

SCALE = 1024
FOLDS = 5
SHRINK = (0.02, 0.1, 0.3, 0.6)
RIDGE = (0.001, 0.01, 0.1)
TEMPERATURE = (1.0, 2.0, 4.0, 8.0)
THRESHOLD = 0.7
HELD_OUT = "coalesce(crc32(cast(doc_id as string)) % 4 = 2, false)"

#: Byte classes, as the bytes they hold.
CLASSES = {
    "upper": range(0x41, 0x5B),
    "digit": range(0x30, 0x3A),
    "symbol": b"#*$%&|<>",
    "bracket": b"(){}[]=_~^\\/@",
    "stop": b".?!",
    "loud": b"!?",
    "comma": b",;:",
    "wide": range(0x80, 0x100),
    "break": b"\n",
}
SIZES = ("words", "lines", "word_bytes", "line_words")
SHARES = (*CLASSES, "long_words", "one_byte_words", "same_next", "repeated_words", "top_word", "repeated_lines", "repeated_triples")
STATISTICS = (*SIZES, *SHARES)


def _class_table() -> np.ndarray:
    """A row a byte class: 1 where the byte belongs to it."""
    table = np.zeros((len(CLASSES), 256), np.int64)
    for row, members in enumerate(CLASSES.values()):
        table[row, list(members)] = 1
    return table


def _per_text(flags: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between borders."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[borders[1:]] - sums[borders[:-1]]


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(different hashes, most frequent one's count) of each of the ``n`` owners."""
    if not len(hashes):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    first = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (h[1:] != h[:-1])]))
    counts = np.diff(np.concatenate([first, [len(h)]]))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, o[first], counts)
    return np.bincount(o[first], minlength=n), most


def chunk_statistics(w) -> np.ndarray:
    """A row of transformed statistics, in steps of 1 / SCALE, per text of a ``textops.Words`` chunk."""
    counts = w.counts()
    n_bytes = np.diff(w.bytes_at)
    owner = np.repeat(np.arange(w.n), counts)
    length = w.end - w.start
    hashes = w.hashes()
    shares = {}
    table = _class_table()
    for row, name in enumerate(CLASSES):
        shares[name] = _per_text(table[row][w.data], w.bytes_at) / np.maximum(n_bytes, 1)
    total = np.maximum(counts, 1)
    for name, flags in (("long_words", length > 20), ("one_byte_words", length == 1)):
        shares[name] = np.bincount(owner, weights=flags, minlength=w.n) / total
    neighbours = (owner[1:] == owner[:-1]) & (hashes[1:] == hashes[:-1])
    shares["same_next"] = np.bincount(owner[1:], weights=neighbours, minlength=w.n) / total
    different, most = _distinct(owner, hashes, w.n)
    shares["repeated_words"], shares["top_word"] = (counts - different) / total, most / total

    # lines with a word: a word begins one if a break or a text border lies between it and the word before
    breaks = np.concatenate([[0], np.cumsum(w.data == 0x0A)])[w.start]
    begins = np.ones(len(owner), bool)
    begins[1:] = (owner[1:] != owner[:-1]) | (breaks[1:] != breaks[:-1])
    at = np.flatnonzero(begins)
    lines = np.bincount(owner[at], minlength=w.n)
    if len(at):
        place = np.arange(len(owner)) - np.repeat(at, np.diff(np.concatenate([at, [len(owner)]])))
        line_hashes = np.add.reduceat(mix(hashes + place.astype(np.uint64)), at)
    else:
        line_hashes = hashes
    shares["repeated_lines"] = (lines - _distinct(owner[at], line_hashes, w.n)[0]) / np.maximum(lines, 1)

    triples = ngram_hashes(hashes, 3)
    inside = owner[:len(triples)] == owner[2:] if len(triples) else np.zeros(0, bool)
    of = owner[:len(triples)][inside]
    n_triples = np.bincount(of, minlength=w.n)
    shares["repeated_triples"] = (n_triples - _distinct(of, triples[inside], w.n)[0]) / np.maximum(n_triples, 1)

    sizes = {"words": counts, "lines": lines, "word_bytes": np.bincount(owner, weights=length, minlength=w.n) / total,
             "line_words": counts / np.maximum(lines, 1)}
    columns = [np.log1p(sizes[s]) for s in SIZES] + [np.arcsin(np.sqrt(np.clip(shares[s], 0, 1))) for s in SHARES]
    return np.rint(np.stack(columns, axis=1) * SCALE).astype(np.int64)


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, x): transformed statistics of every row as whole numbers."""
    blank = blank_separated()
    width = len(STATISTICS)

    def run(batches):
        for batch in batches:
            at = 0
            for w in text_chunks(batch.column("text"), blank):
                flat = as_long(chunk_statistics(w).ravel())
                offsets = pa.array(np.arange(w.n + 1, dtype=np.int32) * width, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, w.n), batch.column("held_out").slice(at, w.n),
                     pa.ListArray.from_arrays(offsets, flat)], names=["doc_id", "held_out", "x"])
                at += w.n

    return docs.select(F.col("doc_id").cast("long"), F.expr(HELD_OUT).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, x array<long>")


def _rows(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _moments(labelled: DataFrame) -> dict[tuple[int, int], tuple[int, np.ndarray, np.ndarray]]:
    """(fold, good) -> (rows, sums, sums of products), exactly; at most FOLDS * 2 * (1 + d + d * d) numbers."""
    d = len(STATISTICS)

    def run(batches):
        for batch in batches:
            x, fold, good = _rows(batch.column("x")), batch.column("fold").to_numpy(), batch.column("good").to_numpy()
            out = []
            for f, g in sorted(set(zip(fold.tolist(), good.tolist()))):
                part = x[(fold == f) & (good == g)]
                values = np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part)[np.triu_indices(d)]])
                out.append((np.full(len(values), f), np.full(len(values), g), np.arange(len(values)), values))
            if out:
                yield pa.RecordBatch.from_arrays([as_long(np.concatenate(c)) for c in zip(*out)],
                                                 names=["fold", "good", "place", "value"])

    sums = labelled.mapInArrow(run, "fold long, good long, place long, value long").groupBy("fold", "good", "place").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found: dict = {}
    for r in sums.collect():
        found.setdefault((r["fold"], r["good"]), {})[r["place"]] = int(r["value"])
    out = {}
    for key, v in found.items():
        values = [v[i] for i in range(len(v))]
        products = np.zeros((d, d), object)
        products[np.triu_indices(d)] = values[1 + d:]
        out[key] = (values[0], np.array(values[1:1 + d], object), products + np.triu(products, 1).T)
    return out


@dataclass(frozen=True)
class Discriminant:
    """Two normal densities by mean, inverse Cholesky factor and log determinant; ``scale`` standardises first."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    log_dets: tuple[float, float]
    log_odds: float
    temperature: float = 1.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density as good minus log density as bad, of rows of statistics."""
        z = (x - self.centre) / self.scale
        log = [-0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) - det
               for m, f, det in zip(self.means, self.factors, self.log_dets)]
        return log[1] - log[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return logistic(self.difference(x) / self.temperature + self.log_odds)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -700.0, 700.0)))


def fit(moments, shrink: float, ridge: float, without: int | None = None, temperature: float = 1.0) -> Discriminant | None:
    """The discriminant of the folds other than ``without``; None unless both classes have rows."""
    d = len(STATISTICS)
    n, sums, products = [0, 0], [np.zeros(d, object)] * 2, [np.zeros((d, d), object)] * 2
    for (fold, good), (rows, s, p) in sorted(moments.items()):
        if fold != without:
            n[good], sums[good], products[good] = n[good] + rows, sums[good] + s, products[good] + p
    if not all(n):
        return None
    total = sum(n)
    # exact whole numbers up to here: n * sum of squares - square of the sum can't cancel
    spread = np.array([float(v) for v in total * np.diag(products[0] + products[1]) - (sums[0] + sums[1]) ** 2])
    scale = np.sqrt(np.maximum(spread, 0.0)) / total
    scale[scale == 0] = 1.0
    centre = np.array([float(v) for v in sums[0] + sums[1]]) / total
    means, scatters = [], []
    for k in (0, 1):
        means.append((np.array([float(v) for v in sums[k]]) / n[k] - centre) / scale)
        scatter = (n[k] * products[k] - np.outer(sums[k], sums[k])).astype(float) / n[k]
        scatters.append(scatter / np.outer(scale, scale))
    pooled = (scatters[0] + scatters[1]) / total
    factors, log_dets = [], []
    for k in (0, 1):
        cov = (1 - shrink) * scatters[k] / n[k] + shrink * pooled
        cov = (1 - ridge) * cov + ridge * max(np.trace(cov) / d, 1e-6) * np.eye(d)
        root = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(root))
        log_dets.append(float(np.log(np.diag(root)).sum()))
    return Discriminant(centre, scale, tuple(means), tuple(factors), tuple(log_dets), float(np.log(n[1] / n[0])), temperature)


def choose(labelled: DataFrame, moments) -> Discriminant | None:
    """Shrinkage, ridge and temperature by the log loss of left-out folds (one pass), then a fit of all folds."""
    grid = list(itertools.product(SHRINK, RIDGE))
    models = {(f, i): fit(moments, *g, without=f) for f in range(FOLDS) for i, g in enumerate(grid)}
    if fit(moments, *grid[0]) is None:
        return None

    def run(batches):
        for batch in batches:
            x, fold, good = _rows(batch.column("x")), batch.column("fold").to_numpy(), batch.column("good").to_numpy()
            losses = np.zeros((len(grid), len(TEMPERATURE)))
            for (f, i), m in models.items():
                rows = fold == f
                if m is not None and rows.any():
                    difference, sign = m.difference(x[rows]), 2 * good[rows] - 1
                    for j, t in enumerate(TEMPERATURE):
                        losses[i, j] += np.logaddexp(0, -sign * (difference / t + m.log_odds)).sum()
            # steps of 2**-20: whole numbers add up alike in any order
            yield pa.RecordBatch.from_arrays([as_long(np.arange(losses.size)), as_long(np.rint(losses.ravel() * 2 ** 20))],
                                             names=["place", "loss"])

    loss = {r["place"]: r["loss"] for r in labelled.mapInArrow(run, "place long, loss long").groupBy("place").agg(
        F.sum("loss").alias("loss")).collect()}
    best = min(loss, key=lambda p: (loss[p], p))
    return fit(moments, *grid[best // len(TEMPERATURE)], temperature=TEMPERATURE[best % len(TEMPERATURE)])


def learn(statistics: DataFrame, labels: DataFrame):
    """rows of statistics -> scores, learned from the labelled rows that are not held out."""
    known = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", F.col("quality").cast("long").alias("good"))
    labelled = written(statistics.where("not held_out").join(known, "doc_id").select(
        F.expr(f"pmod(xxhash64(doc_id), {FOLDS})").alias("fold"), "good", "x"), "labelled")
    moments = _moments(labelled)
    model = choose(labelled, moments)
    if model is not None:
        return model.score
    good, n = sum(m[0] for (_, g), m in moments.items() if g), sum(m[0] for m in moments.values())
    share = (good + 1) / (n + 2)
    return lambda x: np.full(len(x), share)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs(doc_id, text)``."""
    statistics = written(document_statistics(docs), "statistics")
    score = learn(statistics, labels)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                scores = pa.array(score(_rows(batch.column("x"))), pa.float64())
                predicted = pc.greater_equal(scores, threshold).cast(pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), scores, predicted],
                                                 names=["doc_id", "held_out", "score", "predicted"])

    return statistics.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
