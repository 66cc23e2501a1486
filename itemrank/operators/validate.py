"""Rating validation (V1) and catalogue check of new ratings (V2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The accepted rating range, inclusive.
RATING_MIN = 0.5
RATING_MAX = 5.0
REQUIRED = ("user_id", "movie_id", "rating", "timestamp")
_FRACTIONAL = ("float", "double", "decimal")


def stamp_ratings(df: DataFrame, now_ts: int | None = None) -> DataFrame:
    """P10: a directly submitted rating gets rating -> DOUBLE and timestamp = now.

    Submissions without a timestamp column (or with NULL) are stamped with
    ``now_ts``, by default the current epoch second (``unix_timestamp()``, one
    value per query); event streams that carry their own time keep it.
    """
    now = F.unix_timestamp() if now_ts is None else F.lit(now_ts).cast("long")
    ts = F.coalesce(F.col("timestamp").try_cast("bigint"), now) if "timestamp" in df.columns else now
    rest = [c for c in df.columns if c not in ("rating", "timestamp")]
    return df.select(*rest, F.col("rating").try_cast("double").alias("rating"), ts.alias("timestamp"))


def _typed(df: DataFrame) -> DataFrame:
    """Cast untrusted fields with try_cast; keep the raw value to tell
    'missing' from 'wrong type'.

    A fractional number is no id and no time (only 2.0 is 2), and a boolean is
    neither a number nor an id.  Numeric strings are accepted: files and
    message queues deliver text, so this is a deliberate widening.
    """
    kinds = dict(df.dtypes)
    cols = [F.col(c) for c in df.columns if c not in REQUIRED]
    for c, typ in (("user_id", "bigint"), ("movie_id", "bigint"), ("rating", "double"),
                   ("timestamp", "bigint")):
        raw = F.col(c) if c in df.columns else F.lit(None)
        value = raw.try_cast(typ)
        kind = kinds.get(c, "")
        if kind == "boolean":
            value = F.lit(None).cast(typ)
        elif typ == "bigint" and kind.startswith(_FRACTIONAL):
            value = F.when(raw == F.floor(raw), value)
        cols += [raw.alias(f"_raw_{c}"), value.alias(c)]
    return df.select(*cols)


def with_reject_reason(events: DataFrame) -> DataFrame:
    """V1: add ``reject_reason`` (NULL when the rating event is valid).

    Checks, first failing wins: required fields present; ids and timestamp
    integral; rating numeric (NaN rejected) and within [0.5, 5.0].
    """
    t = _typed(events)
    reason = F.lit(None).cast("string")
    checks = []
    for c in REQUIRED:
        checks.append((F.col(f"_raw_{c}").isNull(), f"no_{c}"))
    for c in REQUIRED:
        checks.append((F.col(c).isNull(), "rating_not_a_number" if c == "rating" else f"{c}_not_whole"))
    checks.append((F.isnan("rating"), "rating_not_a_number"))
    checks.append((~F.col("rating").between(RATING_MIN, RATING_MAX), "rating_outside_scale"))
    expr = None
    for cond, msg in checks:
        expr = F.when(cond, F.lit(msg)) if expr is None else expr.when(cond, F.lit(msg))
    reason = expr.otherwise(reason)
    keep = [c for c in t.columns if not c.startswith("_raw_")]
    return t.select(*keep, reason.alias("reject_reason"))


def valid_ratings(events: DataFrame) -> DataFrame:
    v = with_reject_reason(events)
    return v.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_ratings(events: DataFrame) -> DataFrame:
    v = with_reject_reason(events)
    return v.where(F.col("reject_reason").isNotNull())


def valid_new_ratings(events: DataFrame, movies: DataFrame) -> DataFrame:
    """V2: valid events whose movie is in the catalogue (left semi join)."""
    return valid_ratings(events).join(movies.select("movie_id"), "movie_id", "left_semi")


def unknown_movie_ratings(events: DataFrame, movies: DataFrame) -> DataFrame:
    """V2 rejects: valid events for movies missing from the catalogue (left anti)."""
    return valid_ratings(events).join(movies.select("movie_id"), "movie_id", "left_anti")
