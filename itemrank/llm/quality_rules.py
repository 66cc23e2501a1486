"""Quality rules: decision lists learned by sequential covering, applied as Spark expressions.

Everything runs as DataFrame expressions: no Python function touches a row.

Learning.  Labelled statistics are cut into at most ``bins`` threshold bins
per statistic (``percentile_approx`` over all labelled rows).  Rows are split
by a hash of the id into a growing part (two thirds) and a pruning part.  A
rule for the bad class is grown one threshold condition at a time, by FOIL
gain, from one aggregate of positives and negatives per (statistic, bin) --
the only thing that reaches the driver, at most ``statistics * bins`` rows
whatever the number of documents.  On the pruning part the rule is cut back
to the prefix of conditions with the best (p - n) / (p + n), accepted if its
precision there is at least ``min_precision``, and the rows it covers are
taken out before the next rule is sought.  The result is an ordered list of
threshold conjunctions, emitted as one ``CASE WHEN`` expression.

Nulls: a null text counts as empty (no words, no lines).  Labels that are
null, or for unknown documents, are not used; without usable labels of both
kinds the list is empty and only the base rule decides.  Repeated document
rows are judged alike; a label that is repeated counts as often as it stands.
Very long texts are used whole.  Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

REPEAT_WIDTH = 8

#: Scale-free statistics the rules may test, as SQL over the columns of ``text_statistics``.
RATIOS = {
    "n_words": "cast(n_words as double)",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
}

_NO_BLANK = "concat_ws('', split(coalesce(text, ''), '[ \\\\t-\\\\r]+'))"


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_distinct_words, n_repeat_words).

    Repeats are found by hashes of the 8-word windows first; only a text with
    equal hashes has its windows compared as texts, so a hash collision cannot
    change a count.
    """
    w = REPEAT_WIDTH
    split = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).selectExpr(
        "doc_id", "text", "filter(split(text, '[ \\\\t-\\\\r]+'), x -> x <> '') as words",
        "filter(split(text, '\\n'), x -> x rlike '[^ \\\\t-\\\\r]') as lines")
    counted = split.selectExpr(
        "doc_id", "words",
        "cast(size(words) as bigint) as n_words",
        "cast(char_length(array_join(words, '')) as bigint) as word_chars",
        "cast(regexp_count(text, '[#*$%&|<>]') as bigint) as n_symbols",
        "cast(size(lines) as bigint) as n_lines",
        "cast(size(lines) - size(array_distinct(lines)) as bigint) as n_dup_lines",
        "cast(size(array_distinct(words)) as bigint) as n_distinct_words",
        "transform(words, x -> xxhash64(x)) as h")
    hashed = counted.selectExpr(
        "*", f"if(size(h) > {w}, transform(sequence(1, size(h) - {w - 1}), i -> xxhash64(slice(h, i, {w}))), "
             "array()) as wins")
    return hashed.selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_distinct_words",
        f"if(size(array_distinct(wins)) = size(wins), 0L, {_covered(w)}) as n_repeat_words")


def _covered(w: int) -> str:
    """Words covered by windows that stand at least twice: sort (window, place), keep those equal to a
    neighbour, sort their places, and add up min(w, distance to the next)."""
    sorted_windows = (f"array_sort(transform(sequence(1, size(words) - {w - 1}), "
                      f"i -> struct(array_join(slice(words, i, {w}), ' ') as win, i as at)))")
    repeated = (f"transform(array({sorted_windows}), s -> array_sort(transform(filter("
                "transform(sequence(1, size(s)), j -> struct(s[j - 1].at as at, "
                "(j > 1 and s[j - 1].win = s[greatest(j - 2, 0)].win) or "
                "(j < size(s) and s[j - 1].win = s[least(j, size(s) - 1)].win) as twice)), "
                "x -> x.twice), x -> x.at)))[0]")
    return (f"aggregate({repeated}, struct(0L as n, cast({1 - w} as int) as last), "
            f"(acc, p) -> struct(acc.n + least({w}, p - acc.last) as n, p as last), acc -> acc.n)")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def with_ratios(stats: DataFrame) -> DataFrame:
    return stats.select("*", *[F.expr(sql).alias(f"r_{name}") for name, sql in RATIOS.items()])


@dataclass(frozen=True)
class Condition:
    statistic: str
    op: str  # "<=" or ">"
    value: float

    def sql(self) -> str:
        return f"{RATIOS[self.statistic]} {self.op} {self.value!r}D"


@dataclass(frozen=True)
class DecisionList:
    """Ordered conjunctions; a row that any of them covers is bad, the default is good."""

    rules: tuple[tuple[Condition, ...], ...]

    def sql(self) -> str:
        """``CASE`` giving the number of the first rule that covers a row, null by default."""
        if not self.rules:
            return "cast(null as int)"
        whens = " ".join(f"when {' and '.join(c.sql() for c in rule)} then {i}" for i, rule in enumerate(self.rules))
        return f"case {whens} else cast(null as int) end"

    def fired(self) -> Column:
        return F.expr(self.sql())


def _thresholds(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    at = [(i + 1) / bins for i in range(bins - 1)]
    got = rows.agg(*[F.percentile_approx(f"r_{s}", at, 1000).alias(s) for s in RATIOS]).first()
    return {s: sorted(set(got[s] or [])) for s in RATIOS}


def _histogram(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, dict[int, tuple[int, int]]]:
    """Per statistic and bin: (bad, good) rows; one aggregate over all statistics."""
    def bin_of(s):
        return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts[s]]), lambda c: c < F.col(f"r_{s}")))

    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), bin_of(s).alias("b")) for s in cuts if cuts[s]]))
    out: dict[str, dict[int, tuple[int, int]]] = {s: {} for s in cuts}
    for r in rows.select("bad", pairs.alias("x")).groupBy("x.s", "x.b").agg(
            F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect():
        out[r["s"]][r["b"]] = (r["p"], r["n"])
    return out


def _best_condition(hist, cuts, p0: int, n0: int) -> tuple[float, Condition | None]:
    best = (1e-9, None)
    before = math.log2(p0 / (p0 + n0))
    for s in sorted(hist):
        p_low = n_low = 0
        for b, cut in enumerate(cuts[s]):
            p, n = hist[s].get(b, (0, 0))
            p_low, n_low = p_low + p, n_low + n
            for op, pp, nn in (("<=", p_low, n_low), (">", p0 - p_low, n0 - n_low)):
                if pp:
                    gain = pp * (math.log2(pp / (pp + nn)) - before)
                    if gain > best[0]:
                        best = (gain, Condition(s, op, float(cut)))
    return best


def _where(rule) -> str:
    return " and ".join(f"r_{c.statistic} {c.op} {c.value!r}D" for c in rule) or "true"


def learn(labelled: DataFrame, bins: int = 64, max_rules: int = 8, max_conditions: int = 3,
          min_precision: float = 0.95, min_cover: int = 5) -> DecisionList:
    """Sequential covering over ``labelled(doc_id, bad, statistics of text_statistics)``, all rows."""
    rows = written(with_ratios(labelled).select(
        "bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).alias("grow"), *[f"r_{s}" for s in RATIOS]), "labelled")
    cuts = _thresholds(rows, bins)
    if not any(cuts.values()):  # no labelled rows
        return DecisionList(())
    rules: list[tuple[Condition, ...]] = []
    left = rows
    for _ in range(max_rules):
        grow, prune = left.where("grow"), left.where("not grow")
        rule: list[Condition] = []
        for _ in range(max_conditions):
            hist = _histogram(grow.where(_where(rule)), cuts)
            totals = max([sum(x[i] for x in h.values()) for i in (0, 1)] for h in hist.values())
            if totals[0] < min_cover or not totals[1]:
                break
            _, condition = _best_condition(hist, cuts, *totals)
            if condition is None:
                break
            rule.append(condition)
        if not rule:
            break
        # prune: the best prefix of the conditions on rows not used for growing
        tests = [F.struct(F.count_if(F.expr(_where(rule[:k])) & F.col("bad")).alias("p"),
                          F.count_if(F.expr(_where(rule[:k])) & ~F.col("bad")).alias("n")).alias(f"k{k}")
                 for k in range(1, len(rule) + 1)]
        scored = prune.agg(*tests).first()
        worth = {k: (scored[f"k{k}"]["p"], scored[f"k{k}"]["n"]) for k in range(1, len(rule) + 1)}
        keep = max(worth, key=lambda k: ((worth[k][0] - worth[k][1]) / max(1, sum(worth[k])), worth[k][0], -k))
        p, n = worth[keep]
        if p < 1 or p < min_precision * (p + n):
            break
        rules.append(tuple(rule[:keep]))
        left = left.where(f"not ({_where(rule[:keep])})")
    return DecisionList(tuple(rules))


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Statistics, base rule and learned verdict per row of docs.

    Rows that the base rule rejects are rejected whatever the list says, so
    the list is learned on labelled rows that pass it.
    """
    stats = written(text_statistics(docs), "statistics")
    bad = labels.where("quality is not null and doc_id is not null").select(
        "doc_id", (F.col("quality") == 0).alias("bad"))
    rules = learn(stats.where(~base_failed()).join(bad, "doc_id"), **options)
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), rules.fired().alias("rule")).select(
        "*").withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule")
