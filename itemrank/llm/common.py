"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the stages
    before the written table.  Columns are stored compressed, so this is
    smaller than ``checkpoint()``; ``compression`` is the session's by default.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected links: (node, component), component = smallest node.

    Each round takes the smallest label among a node and its neighbours and
    then follows the label once (pointer jumping), so the number of rounds
    grows with the logarithm of a component's diameter.  Minima combine on
    the map side, so a node with very many links is no hot group.  Labels are
    written to the shared folder each round; only a changed-row count reaches
    the driver.  An empty link table gives an empty result.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).unionAll(
        links.select(F.col(b).alias("node"), F.col(a).alias("other")))
    both = written(both.where("node <> other").distinct(), "links")
    labels = written(both.groupBy("node").agg(F.min("other").alias("other"))
                     .select("node", F.least("node", "other").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "component"), "other") \
                   .groupBy("node").agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", F.least("component", "near").alias("component"),
                                                F.col("component").alias("before"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        new = written(step.join(jump, "component", "left").select(
            "node", F.least("component", "root").alias("component"), "before"), "labels")
        changed = new.where("component <> before").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
