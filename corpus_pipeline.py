"""Corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet into the shared folder
and read back as the next stage's ``docs``.  All stages but the last return
the columns of ``documents``; the last one adds the shard's columns.

A row with a null ``doc_id`` can't be joined to its verdict: quality rules and
decontamination keep it.  Near-duplicates judge it by its text, under an id
made from the text's hash, above other ids.  Of rows with the same id and the
same text they keep one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemrank.llm import decontaminate, minhash_dedup, mixing, quality_rules, sharding
from itemrank.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned decision list rejects go."""
    judged = quality_rules.quality(docs, table(spark, sf_dir, "labels"))
    rejected = judged.where("not kept").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, as one row."""
    by_text = F.expr("shiftleft(1L, 62) | (xxhash64(text) & (shiftleft(1L, 61) - 1))")
    rows = written(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("at"),
                               F.coalesce(F.col("doc_id").cast("long"), by_text).alias("id")), "numbered")
    kept = minhash_dedup.near_duplicates(rows.select(F.col("id").alias("doc_id"), "row.text")).where("kept").select(
        F.col("doc_id").alias("id")).distinct()
    text_hashes = [F.xxhash64(F.lit(seed), "row.text").alias(f"h{seed}") for seed in (1, 2)]
    first = rows.groupBy("id", *text_hashes).agg(F.min("at").alias("at")).join(kept, "id", "left_semi").select("at")
    return rows.join(first, "at", "left_semi").select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark windows go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    dirty = found.where("contaminated").select("doc_id").distinct()
    return docs.join(dirty, "doc_id", "left_anti").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    copies = mixing.mix(docs).groupBy(F.col("doc_id").alias("m_id"), F.col("source").alias("m_source")).agg(
        F.max("copies").alias("m_copies")).where("m_copies > 0")
    rows = docs.select(F.struct(*docs.columns).alias("row"))  # whatever other columns are called
    both = rows.join(copies, F.col("row.doc_id").eqNullSafe(F.col("m_id")) &
                     F.col("row.source").eqNullSafe(F.col("m_source")))
    return both.select("row", F.explode(F.sequence(F.lit(1), F.col("m_copies").cast("int")))).select("row.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard."""
    return sharding.assign_shards(docs)


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: The stages learn, solve and hash in ways that SQL can't express; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
