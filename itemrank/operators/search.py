"""Catalogue search (F1-F4): fuzzy title, genre, year, and their combination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text


def by_genre(movies: DataFrame, genre: str) -> DataFrame:
    """movies having ``genre`` (case-insensitive; unknown genre -> no rows)."""
    g = genre.strip().lower()
    return movies.where(F.exists("genres", lambda x: F.lower(x) == F.lit(g)))


def by_year(movies: DataFrame, year: int) -> DataFrame:
    """F3a."""
    return movies.where(F.col("year") == F.lit(float(year)))


def by_year_range(movies: DataFrame, start: int, end: int) -> DataFrame:
    """Inclusive range."""
    return movies.where(F.col("year").between(float(start), float(end)))


def title_scores(movies: DataFrame, query: str) -> DataFrame:
    """Token-sort fuzzy score of every title against ``query``."""
    return movies.withColumn("score", text.token_sort_score(F.col("title"), query))


def by_title(movies: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """F1/T5: the ``limit`` best titles by fuzzy score (ties by id).

    Scoring is a per-row expression; ``orderBy().limit()`` keeps a bounded
    top-k per partition (TakeOrderedAndProject), so the score of every title is
    computed in parallel and only ``limit`` rows per partition move.
    """
    scored = title_scores(movies, query)
    if not query.strip():  # an empty query finds nothing (as in the reference)
        return scored.where(F.lit(False))
    return scored.orderBy(F.col("score").desc(), F.col("movie_id").asc()).limit(limit)


def parse_years(expr: str | None) -> tuple[int, int] | None:
    """'1995' -> (1995, 1995); '1995-2000' -> (1995, 2000); malformed -> None."""
    if not expr or not expr.strip():
        return None
    try:
        if "-" in expr:
            a, b = expr.split("-")
            return int(a), int(b)
        y = int(expr)
        return y, y
    except ValueError:
        return None


def advanced(movies: DataFrame, title: str | None = None, genre: str | None = None,
             years: str | None = None, title_limit: int = 50) -> DataFrame:
    """title top-``title_limit`` AND genre AND year, each criterion optional.

    An unknown genre or a malformed year expression skips that criterion.  The
    fuzzy score travels with its row (semi filter by id, not by title text).
    """
    out = movies
    if title and title.strip():
        out = by_title(out, title.strip(), title_limit)
    if genre and genre.strip():
        g = genre.strip().lower()
        has_genre = F.exists("genres", lambda x: F.lower(x) == F.lit(g))
        # Scalar subquery: does any catalogue movie carry the genre?  If not,
        # the criterion is skipped instead of emptying the result.
        known = movies.select(F.max(has_genre.cast("int")) == 1).scalar()
        out = out.where(~F.coalesce(known, F.lit(False)) | has_genre)
    rng = parse_years(years)
    if rng is not None:
        out = by_year_range(out, *rng)
    return out
