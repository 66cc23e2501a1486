"""Rating / movie / user / rating-event tables derived from the shared test data.

The test data is a TPC-H-shaped star schema; these views re-shape it into the
rating data model (FIXTURES.md).  Every view is a lazy DataFrame over the
parquet scan, so Catalyst prunes columns and pushes filters into the reader.
Every rating fact is kept.  The data has no user without ratings and no unrated
movie, so the ``supplier`` rows are added as both (ids from ``ADDED_IDS`` on).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: First id of the added users and movies, above every id of the base tables.
ADDED_IDS = 1_000_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ratings(user_id, movie_id, rating, timestamp) — raw, duplicates allowed."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    return (items.join(orders, items.l_orderkey == orders.o_orderkey)
            .select(
                F.col("o_custkey").alias("user_id"),
                F.col("l_partkey").alias("movie_id"),
                (((F.col("l_quantity").cast("int") - 1) % 10 + 1).cast("double")
                 * F.lit(0.5)).alias("rating"),
                F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("timestamp")))


def movies_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movies(movie_id, title, genres) exactly as the `::` file would carry them."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    key = F.col("p_partkey")
    brand = F.regexp_replace("p_brand", "#", "")
    return p.select(
        key.alias("movie_id"),
        F.when(key % 50 == 0, F.col("p_name"))
         .otherwise(F.concat("p_name", F.lit(" ("), (F.col("p_size") + 1950).cast("string"), F.lit(")")))
         .alias("title"),
        F.when(key % 3 == 0, F.concat_ws("|", "p_type", brand, F.split_part("p_name", F.lit(" "), F.lit(1))))
         .when(key % 3 == 1, F.concat_ws("|", "p_type", brand))
         .otherwise(F.col("p_type")).alias("genres")).unionByName(
        table(spark, sf_dir, "supplier").select(
            (F.col("s_suppkey") + ADDED_IDS).alias("movie_id"),
            F.concat("s_name", F.lit(" (1999)")).alias("title"), F.lit("SUPPLIED").alias("genres")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").unionAll(
        table(spark, sf_dir, "supplier").select(F.col("s_suppkey") + ADDED_IDS, "s_nationkey"))
    key = F.col("c_custkey")
    return c.select(
        key.alias("user_id"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        (F.lit(18) + key % 50).cast("int").alias("age"),
        (F.col("c_nationkey") % 21).cast("int").alias("occupation"),
        (F.lit(10000) + key % 90000).cast("string").alias("zip_code"))


def rating_events_from(events: DataFrame) -> DataFrame:
    """Shape raw `events` rows (batch or stream) into untrusted rating events."""
    return events.select(
        "event_id", "user_id",
        (F.get_json_object("props", "$.k").try_cast("bigint") * 25).alias("movie_id"),
        (F.col("value") / 10).alias("rating"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"))


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating_events_from(table(spark, sf_dir, "events"))
