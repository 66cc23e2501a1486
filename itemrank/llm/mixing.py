"""Mixing sources to target weights by entropy balancing.

Each source gets a token target.  Entropy balancing finds the document rates
closest to 1 (in relative entropy, weighted by size) that meet the targets.
Its convex dual has one multiplier per source, the rates are the exponential
tilt ``min(cap, exp(lambda))``, and Newton's iterations need the tokens of
every source, one aggregate over all documents (added up on the map side, so a
hot source is no hot group).  With several ``margins`` (for example
source and language) the rate is ``exp`` of the sum of a document's
multipliers and the Hessian holds the tokens of every pair of groups.

Rates are rounded into whole copies: everybody gets ``floor(rate)``, and the
fractions are settled by priority sampling.  A document's priority is its
hash divided by its fraction, and the cut on priorities is placed, per
source, where the taken tokens reach the target; what is then still wanted is
filled, in two more rounds, from the documents that fit into it.  Cuts are found
by refining a histogram of priorities, never by sorting a source.  The hash
depends on the id alone, so reruns agree.

Nulls: a null text has size 0; the null source is a source of its own, last
in order; a null ``doc_id`` is an id of its own.  Repeated rows each have a
size and share a priority: they are taken or left together.  An empty table,
or one without words, gives targets of 0.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
LEVEL_BITS = 12
HASH_BITS = 48


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """(source, source_size, target) for ``sources(source, source_size)``, one row each.

    Weights repeat over the sources by code point, null last.  Excess over
    ``cap * source_size`` is reshared by weight among the rest; the outcome
    has every source at the smaller of its limit and weight times one common
    level, so one pass over the sources in order of limit / weight finds it.
    That pass is one task over the whole table of sources: their number is
    bounded by what one task can sort (sources by domain can be too many).
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.array(*[F.lit(float(w)) for w in weights])[(F.row_number().over(order) - 1) % len(weights)]
    ranked = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(cap))
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("limit").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) * float(share)
    filled = ranked.select("*", F.row_number().over(fill).alias("place"), ((total - before) / rest).alias("level"))
    # sources before the first that the level leaves open stand at their limit
    first = F.min(F.when(F.col("level") * F.col("weight") < F.col("limit"), F.col("place"))).over(everything)
    filled = filled.withColumn("first", first)
    shared = F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(everything)
    return filled.withColumn("shared", shared).select(
        "source", "source_size", F.when(F.col("place") >= F.col("first"), F.col("shared") * F.col("weight"))
        .otherwise(F.col("limit")).alias("target"))


def rates(targets: DataFrame, cap: float = CAP, tolerance: float = 1e-9, rounds: int = 60) -> DataFrame:
    """(source, source_size, target, rate): Newton's method on the dual, all sources at once as one table.

    The dual of one margin falls apart into one multiplier per source:
    gradient ``size * rate - target``, second derivative ``size * rate``.  Each
    iteration writes the table of multipliers; only whether a source is still
    off its target reaches the driver, so the number of sources is not bounded by it
    (it is by the one task of ``source_targets``).
    """
    state = targets.select("source", "source_size", "target", F.lit(0.0).alias("lam"))
    rate = F.least(F.exp("lam"), F.lit(float(cap)))
    gradient = F.col("source_size") * rate - F.col("target")
    off = F.abs(gradient) > tolerance * F.greatest(F.col("target"), F.lit(1.0))
    # at the cap a source that still lacks tokens can get no more
    off = off & ~((rate >= cap) & (gradient < 0))
    step = F.greatest(F.lit(-2.0), F.least(F.lit(2.0), -gradient / (F.col("source_size") * rate)))
    for _ in range(rounds):
        if not state.where(off).limit(1).count():
            break
        state = written(state.withColumn("lam", F.when(
            off, F.least(F.col("lam") + step, F.lit(math.log(cap)))).otherwise(F.col("lam"))), "multipliers")
    return state.select("source", "source_size", "target", F.round(rate, 9).alias("rate"))


def balance(cells: DataFrame, margins: Sequence[str], targets: Mapping[str, Mapping], size: str = "size",
            cap: float = CAP, tolerance: float = 1e-9, rounds: int = 60) -> dict[str, dict]:
    """Multipliers per margin and group, by Newton's method on the dual, for several margins at once.

    ``cells`` has the margin columns and ``size``; ``targets[margin][group]``
    are tokens.  Each iteration evaluates rates, slopes and areas of every
    combination of groups in Spark; the driver sees one row per combination
    and solves the step, so the margins together must have few groups (thousands).
    """
    names = [(m, g) for m in margins for g in targets[m]]
    place = {k: i for i, k in enumerate(names)}
    goal = np.array([float(targets[m][g]) for m, g in names])
    lam = np.zeros(len(names))

    def objective(sums):
        """Dual value, gradient and Hessian at ``lam`` from summed tokens per combination."""
        grad, hess, value = -goal.copy(), np.zeros((len(names), len(names))), -float(goal @ lam)
        for groups, tokens, rate, slope, area in sums:
            at = [place[(m, g)] for m, g in zip(margins, groups, strict=True)]
            grad[at] += tokens * rate
            hess[np.ix_(at, at)] += tokens * slope
            value += tokens * area
        return value, grad, hess

    # whole tokens per combination of groups, summed over all documents: exact in any order, so reruns agree
    summed = written(cells.groupBy(*margins).agg(F.sum(size).alias("tokens")), "cells")

    def sums():
        score = F.lit(0.0)
        for m in margins:
            pairs = [F.when(F.col(m).eqNullSafe(F.lit(g)), F.lit(float(lam[place[(m, g)]]))) for g in targets[m]]
            score = score + (F.coalesce(*pairs, F.lit(0.0)) if pairs else F.lit(0.0))
        e = F.exp(F.col("score"))
        # rate is exp(score) up to the cap; its integral is the dual's contribution
        area = F.when(e < cap, e).otherwise(cap + cap * (F.col("score") - math.log(cap)))
        rows = summed.withColumn("score", score).select(
            *margins, F.col("tokens").cast("double").alias("tokens"), F.least(e, F.lit(float(cap))).alias("rate"),
            F.when(e < cap, e).otherwise(0.0).alias("slope"), area.alias("area")).orderBy(*margins).collect()
        return [([r[m] for m in margins], r["tokens"] or 0.0, r["rate"], r["slope"], r["area"]) for r in rows]

    value, grad, hess = objective(sums())
    scale = max(1.0, float(np.abs(goal).max(initial=0.0)))
    for _ in range(rounds):
        if np.abs(grad).max(initial=0.0) <= tolerance * scale:
            break
        flat = np.diag(np.maximum(1e-9 * scale, 1e-12 + 0 * goal))
        step = np.clip(-np.linalg.lstsq(hess + flat, grad, rcond=None)[0], -2.0, 2.0)
        start, at = lam.copy(), value
        for _ in range(8):  # halve until the convex dual does not rise
            lam = start + step
            value, grad, hess = objective(sums())
            if value <= at + 1e-9 * scale:
                break
            step = step / 2
    return {m: {g: float(lam[place[(m, g)]]) for g in targets[m]} for m in margins}


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _cut(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Where the running tokens by priority pass the wish: (source, want, lo, hi, below, upto).

    ``rows(source, size, priority)``, ``wanted(source, want)``.  Everything
    below priority ``lo`` adds up to ``below``; the rows in [lo, hi) -- one row, or
    rows of one priority -- bring it to ``upto``, at or above ``want``.  A
    histogram of ``2**LEVEL_BITS`` cells per source is summed, and the cell that
    passes the wish is refined.  Sources whose rows do not reach the wish have no row.
    """
    state = wanted.select(F.col("source").alias("s"), "want", F.lit(0).cast("long").alias("cell"),
                          F.lit(0.0).alias("below"))
    bits = 0
    while True:
        deeper = min(bits + LEVEL_BITS, HASH_BITS)
        cells = rows.join(state, _same("source", "s")).where(
            f"shiftright(priority, {HASH_BITS - bits}) = cell").groupBy(
            "source", F.shiftright("priority", HASH_BITS - deeper).alias("c")).agg(
            F.sum("size").cast("double").alias("tokens"), F.count(F.lit(1)).alias("n"),
            F.first("want").alias("want"), F.first("below").alias("below"))
        run = Window.partitionBy("source").orderBy("c")
        passing = cells.withColumn("upto", F.col("below") + F.sum("tokens").over(run)).where("upto >= want").groupBy(
            "source").agg(F.min_by(F.struct("want", F.col("c").alias("cell"), (F.col("upto") - F.col("tokens")).alias(
                "below"), "upto", "n"), "c").alias("x"))
        state, bits = written(passing.select(F.col("source").alias("s"), "x.*"), "cut"), deeper
        if bits == HASH_BITS or not state.where("n > 1").limit(1).count():
            break
    span = 1 << (HASH_BITS - bits)
    return state.select("s", "want", (F.col("cell") * span).alias("lo"), ((F.col("cell") + 1) * span).alias("hi"),
                        "below", "upto")


def _fill(rows: DataFrame, wanted: DataFrame, rounds: int = 3) -> DataFrame:
    """(s, lows, rests): which rows get an extra copy so that a source's tokens come near the wish.

    Round k takes, of the rows not taken that fit into what is still wanted,
    those below its cut; the last round also takes the rows at the cut if that is nearer.
    """
    plan = wanted.select(F.col("source").alias("s"), F.array().cast("array<bigint>").alias("lows"),
                         F.array().cast("array<double>").alias("rests"), F.col("want").alias("rest"))
    top = 1 << HASH_BITS
    for k in range(rounds):
        left = rows.join(plan, _same("source", "s")).where(~taken_extra() & (F.col("size") <= F.col("rest")) if k
                                                           else F.lit(True))
        cut = _cut(left.select("source", "size", "priority"), plan.select(F.col("s").alias("source"), F.col("rest").alias("want")))
        sums = left.groupBy(F.col("source").alias("s2")).agg(F.sum("size").cast("double").alias("all"))
        near = (F.col("upto") - F.col("rest") < F.col("rest") - F.col("below")) if k == rounds - 1 else F.lit(False)
        joined = plan.join(cut.withColumnRenamed("s", "c").drop("want"), _same("s", "c"), "left").join(
            sums, _same("s", "s2"), "left")
        low = F.when(F.col("lo").isNull(), F.lit(top)).when(near, F.col("hi")).otherwise(F.col("lo"))
        got = F.when(F.col("lo").isNull(), F.coalesce("all", F.lit(0.0))).when(near, F.col("upto")).otherwise(F.col("below"))
        plan = written(joined.select("s", F.concat("lows", F.array(low)).alias("lows"),
                                     F.concat("rests", F.array("rest")).alias("rests"),
                                     (F.col("rest") - got).alias("rest")), "plan")
    return plan.select("s", "lows", "rests")


def taken_extra() -> Column:
    """Whether a row (size, priority) is taken by the cuts of its source (lows, rests)."""
    return F.coalesce(F.expr(
        "exists(transform(lows, (low, k) -> priority < low and (k = 0 or size <= rests[k])), x -> x)"), F.lit(False))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(doc_id, size, source, source_size, target, rate, copies, taken) per row of ``docs(doc_id, text, source)``."""
    key = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(17)), F.lit(1 << HASH_BITS))
    sized = written(docs.select("doc_id", "source", word_count().alias("size"), key.alias("hash")), "sizes")
    targets = written(source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap), "targets")
    targets = written(rates(targets, cap), "rates")
    rated = sized.join(targets.select(F.col("source").alias("s"), "rate"), _same("source", "s")).drop("s")
    # a rate within rounding of a whole number is that number
    whole = F.when(F.abs(F.col("rate") - F.round("rate")) < 1e-6, F.round("rate")).otherwise(F.floor("rate"))
    parted = rated.withColumn("whole", whole.cast("int")).withColumn("part", F.col("rate") - F.col("whole"))
    priority = F.least(F.lit(float((1 << HASH_BITS) - 1)), F.col("hash") * F.lit(0.5) / F.col("part")).cast("long")
    parted = parted.withColumn("priority", F.when((F.col("part") > 1e-6) & (F.col("size") > 0), priority))
    base = parted.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("base"),
                                        F.max("priority").alias("any"))
    want = written(base.join(targets.withColumnRenamed("source", "s"), _same("source", "s")).where(
        "any is not null").select("source", F.greatest(F.lit(0.0), F.col("target") - F.col("base")).alias("want")), "want")
    cuts = _fill(parted.where("priority is not null").select("source", "size", "priority"), want)
    figures = targets.withColumnRenamed("source", "t").drop("rate")
    return parted.join(cuts, _same("source", "s"), "left").join(figures, _same("source", "t")).withColumn(
        "copies", F.col("whole") + taken_extra().cast("int")).select(
        "doc_id", "size", "source", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"))
