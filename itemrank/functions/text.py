"""Column expressions over titles, genres and documents.

All of these are built-in Spark expressions (regex, arrays, higher-order
functions), so they run inside whole-stage code generation or the interpreted
expression evaluator on the JVM — no Python UDFs.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the parsing rules.
YEAR_PATTERN = r"\((\d{4})\)"          # first "(dddd)" in a title is the year
GENRE_SEPARATOR = "|"                  # genres are "A|B|C"
TOKEN_PATTERN_ASCII = "[a-z0-9_]{2,}"  # tokens: two or more word characters
TOKEN_PATTERN_UNICODE = r"(?U)\b\w\w+\b"


def genre_list(genres: Column) -> Column:
    """P1: 'A|B' -> ['A', 'B']."""
    return F.split(genres, r"\|")


def title_year(title: Column) -> Column:
    """First (dddd) in the title as DOUBLE, NULL when absent."""
    return F.nullif(F.regexp_extract(title, YEAR_PATTERN, 1), F.lit("")).cast("double")


def title_clean(title: Column) -> Column:
    """Remove every (dddd) and strip surrounding whitespace."""
    return F.trim(F.regexp_replace(title, YEAR_PATTERN, ""))


def document(title_clean_col: Column, genres_arr: Column) -> Column:
    """P5: clean title + ' ' + genres joined by spaces."""
    return F.concat(title_clean_col, F.lit(" "), F.array_join(genres_arr, " "))


def tokens(doc: Column, unicode: bool = False) -> Column:
    """Lower-cased tokens of two or more word characters (duplicates kept)."""
    pattern = TOKEN_PATTERN_UNICODE if unicode else TOKEN_PATTERN_ASCII
    return F.regexp_extract_all(F.lower(doc), F.lit(pattern), 0)


@lru_cache(maxsize=1)
def english_stop_words() -> tuple[str, ...]:
    """Spark ML's built-in English stop-word list (read from the JVM once)."""
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def time_decay(now_ts: Column, last_ts: Column) -> Column:
    """1 / (1 + ln(1 + age_in_days)), ages in epoch seconds.

    Written as ln(1 + x) rather than log1p so the SQL twin has the same text.
    """
    return F.lit(1.0) / (F.lit(1.0) + F.log(F.lit(1.0) + (now_ts - last_ts) / F.lit(86400.0)))


# --- fuzzy title score (token-sort ratio) -----------------------------------

NON_ALNUM = r"[^\p{L}\p{N}]"  # anything but a Unicode letter or digit


def sort_tokens(s: Column) -> Column:
    """Lower-case, non-alphanumerics (Unicode-aware) to space, split, sort, re-join."""
    cleaned = F.trim(F.regexp_replace(F.lower(s), NON_ALNUM, " "))
    parts = F.filter(F.split(cleaned, " +"), lambda t: t != "")
    return F.array_join(F.array_sort(parts), " ")


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two strings.

    For two columns (a constant goes through ``lcs_length_const``).  Classic
    dynamic programme expressed with nested ``aggregate``: the outer
    fold walks the characters of ``a`` carrying the previous DP row; the inner
    fold builds the next row left to right over ``b``.
    """
    n = F.length(b)
    first_row = F.array_repeat(F.lit(0), n + 1)

    def next_row(prev: Column, ca: Column) -> Column:
        def cell(acc: Column, j: Column) -> Column:
            val = F.when(ca == F.substring(b, j, 1), prev[j - 1] + 1).otherwise(
                F.greatest(prev[j], acc[j - 1]))
            return F.concat(acc, F.array(val))

        return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.array(F.lit(0)),
                           lambda acc, j: F.when(n == 0, acc).otherwise(cell(acc, j)))

    last = F.aggregate(F.split(a, ""), first_row, next_row)
    return F.when((F.length(a) == 0) | (n == 0), F.lit(0)).otherwise(F.element_at(last, -1))


def sort_tokens_py(s: str) -> str:
    """The same normalisation as ``sort_tokens`` for a constant query string."""
    kept = "".join(c if unicodedata.category(c)[0] in "LN" else " " for c in s.lower())
    return " ".join(sorted(t for t in kept.split(" ") if t))


WORD_BITS = 62  # bits of a signed 64-bit word that leave room for a sum's carry


def lcs_length_const(a: Column, b: str) -> Column:
    """LCS length of a column against a constant string of any length, bit-parallel.

    Classic bit-vector LCS: one bit per character of ``b``, in words of
    ``WORD_BITS``; for each character of ``a``, from the lowest word up:
    U = V & match[c]; sum = V + U + carry; V = sum | (V - U).  LCS is the
    number of cleared bits.  One fold step is a handful of 64-bit operations a word.
    """
    n = len(b)
    if n == 0:
        return F.lit(0)
    words = [b[i:i + WORD_BITS] for i in range(0, n, WORD_BITS)]
    full = [(1 << len(w)) - 1 for w in words]
    masks: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        for j, ch in enumerate(w):
            masks.setdefault(ch, [0] * len(words))[i] |= 1 << j
    match = F.create_map(*[x for ch, bits in masks.items() for x in (F.lit(ch), F.array(*[F.lit(m) for m in bits]))])
    none = F.array(*[F.lit(0).cast("long") for _ in words])

    def step(v: Column, ca: Column) -> Column:
        row = F.coalesce(F.try_element_at(match, ca), none)

        def word(acc: Column, i: Column) -> Column:
            # acc: new words so far and the carry into the next one
            old, top = v[i], F.array(*[F.lit(f) for f in full])[i]
            u = old.bitwiseAND(row[i])
            total = old + u + acc["carry"]
            new = total.bitwiseOR(old - u).bitwiseAND(top)
            carry = F.when(total > top, F.lit(1)).otherwise(F.lit(0)).cast("long")
            return F.struct(F.concat(acc["words"], F.array(new)).alias("words"), carry.alias("carry"))

        if len(words) == 1:  # the same step without the inner fold
            u = v[0].bitwiseAND(row[0])
            return F.array((v[0] + u).bitwiseOR(v[0] - u).bitwiseAND(F.lit(full[0])))
        start = F.struct(F.array().cast("array<bigint>").alias("words"), F.lit(0).cast("long").alias("carry"))
        return F.aggregate(F.array(*[F.lit(i) for i in range(len(words))]), start, word, lambda acc: acc["words"])

    last = F.aggregate(F.split(a, ""), F.array(*[F.lit(f).cast("long") for f in full]), step)
    left = F.aggregate(last, F.lit(0), lambda acc, x: acc + F.bit_count(x))
    return F.when(F.length(a) == 0, F.lit(0)).otherwise(F.lit(n) - left)


def token_sort_score(title: Column, query: str) -> Column:
    """round(100 * 2*LCS / (|a|+|b|)) over token-sorted strings; 0 if either is empty."""
    a = sort_tokens(title)
    b_text = sort_tokens_py(query)
    lcs = lcs_length_const(a, b_text)
    total = F.length(a) + F.lit(len(b_text))
    return F.when(total == 0, F.lit(0)).otherwise(
        F.round(F.lit(200.0) * lcs / total, 0).cast("int"))
