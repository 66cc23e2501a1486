"""Typed access to the rating data model over one test-data folder."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import prep
from ..session import written
from ..sources import fixtures


@dataclass
class Tables:
    """Lazy views of one test-data folder.

    ``materialize=True`` is for composite queries that read the ratings and
    the latest-rating matrix many times (scalar subqueries, anti joins, seed
    selection): both are then written once, as Parquet, into the shared
    checkpoint folder, so the orders x lineitem join and the de-duplication run
    once and every consumer scans the columns it needs.
    """

    spark: SparkSession
    sf_dir: str
    materialize: bool = False

    @cached_property
    def ratings(self) -> DataFrame:
        r = fixtures.ratings(self.spark, self.sf_dir)
        return written(r, "ratings") if self.materialize else r

    @cached_property
    def movies_raw(self) -> DataFrame:
        return fixtures.movies_raw(self.spark, self.sf_dir)

    @cached_property
    def movies(self) -> DataFrame:
        return prep.prep_movies(self.movies_raw)

    @cached_property
    def users(self) -> DataFrame:
        return fixtures.users(self.spark, self.sf_dir)

    @cached_property
    def rating_events(self) -> DataFrame:
        return fixtures.rating_events(self.spark, self.sf_dir)

    @cached_property
    def latest(self) -> DataFrame:
        if self.materialize:
            # Build from the materialised ratings only if a consumer already
            # needed them; otherwise one pass over the raw view is enough.
            src = self.__dict__["ratings"] if "ratings" in self.__dict__ else fixtures.ratings(
                self.spark, self.sf_dir)
            return written(prep.latest_ratings(src), "latest")
        return prep.latest_ratings(self.ratings)
