"""Sharding by extendible hashing.

A document's address is 60 bits of the md5 of its id.  A directory maps hash
prefixes to buckets: it starts as one bucket of no bits, and only a bucket
whose bytes exceed the limit is split on the next bit.  Each round counts
bytes per prefix ``STEP`` bits deeper, for the documents in oversized buckets
only (summed on the map side), and settles every bucket that fits within
those bits, so 100 TB in 256 MB shards need about four rounds.  A round's
directory entries are joined back by prefix; the directory holds a few
entries per shard, never one per document.

A document larger than the limit ends alone in a bucket as deep as needed to
part it from its neighbours; rows with the same id have one address and can't
be parted, so they share a bucket at full depth (``oversized`` tells).
Nulls: a null id has the address of the empty string, a null text no bytes.
An empty table gives an empty result.  Other columns are kept by
``assign_shards`` and must not be called ``shard``, ``depth``, ``doc_bytes``,
``shard_bytes``, ``shard_docs`` or ``oversized``: such columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

ADDED = ("shard", "depth", "doc_bytes", "shard_bytes", "shard_docs", "oversized")
BITS = 60
STEP = 10
LIMIT = 64 << 20
SMALL_LIMIT = 1 << 20  # of the registered query: small enough that every given table splits


def address(key: str = "doc_id") -> Column:
    """The first 60 bits of md5(id as text), as a long."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _prefix(depth) -> Column:
    return F.expr(f"shiftright(address, cast({BITS} - {depth} as int))")


def directory(sized: DataFrame, limit: int, step: int = STEP) -> DataFrame:
    """(prefix, depth, shard_bytes, shard_docs) of every bucket for ``sized(address, doc_bytes)``."""
    settled: list[DataFrame] = []
    left, base = sized.select("address", "doc_bytes"), 0
    while True:
        deep = min(base + step, BITS)
        cells = left.groupBy(_prefix(deep).alias("cell")).agg(
            F.sum("doc_bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        # bytes of every prefix between the two depths, from the cells at the deeper one
        depths = F.explode(F.sequence(F.lit(base), F.lit(deep))).alias("depth")
        levels = written(cells.select("cell", "b", "n", depths).groupBy(
            F.expr(f"shiftright(cell, cast({deep} - depth as int))").alias("prefix"), "depth").agg(
            F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs")), "levels")
        fits = (F.col("shard_bytes") <= limit) | (F.col("depth") == BITS) | (F.col("shard_docs") == 1)
        good = levels.where(fits)
        # a bucket is settled at the first depth that fits: its parent must not fit
        parent = levels.where(~fits).select(F.col("prefix").alias("up"), (F.col("depth") + 1).alias("depth"))
        first = good.withColumn("up", F.expr("shiftright(prefix, 1)")).join(parent, ["up", "depth"], "left_semi")
        settled.append(first.select("prefix", "depth", "shard_bytes", "shard_docs"))
        if base == 0:
            settled.append(good.where("depth = 0").select("prefix", "depth", "shard_bytes", "shard_docs"))
        over = levels.where(~fits & (F.col("depth") == deep)).select(F.col("prefix").alias("cell"))
        if deep == BITS or not over.limit(1).count():
            break
        left = written(left.withColumn("cell", _prefix(deep)).join(over, "cell", "left_semi").drop("cell"), "oversized")
        base = deep
    out = settled[0]
    for x in settled[1:]:
        out = out.unionAll(x)
    return written(out, "directory")


def _placed(rows: DataFrame, limit: int, step: int) -> DataFrame:
    """Rows with ``address`` and ``doc_bytes``, with their directory entry ``e``.

    Every entry is filed under the bits of the shallowest bucket, where a
    uniform hash leaves a handful of entries; a document meets its file by
    one equi-join and picks the entry whose bits it has.
    """
    buckets = directory(written(rows.select("address", "doc_bytes"), "sized"), limit, step)
    least = buckets.agg(F.min("depth").alias("d")).first()["d"] or 0
    files = buckets.groupBy(F.expr(f"shiftright(prefix, cast(depth - {least} as int))").alias("file")).agg(
        F.collect_list(F.struct("prefix", "depth", "shard_bytes", "shard_docs")).alias("entries"))
    own = F.expr(f"filter(entries, e -> e.prefix = shiftright(address, cast({BITS} - e.depth as int)))[0]")
    return rows.withColumn("file", _prefix(least)).join(files, "file").withColumn("e", own)


def _figures(limit: int) -> list[Column]:
    return [F.expr("if(e.depth = 0, '', lpad(bin(e.prefix), cast(e.depth as int), '0'))").alias("shard"),
            F.col("e.depth").alias("depth"), F.col("doc_bytes"), F.col("e.shard_bytes").alias("shard_bytes"),
            F.col("e.shard_docs").alias("shard_docs"), (F.col("e.shard_bytes") > limit).alias("oversized")]


def _doc_bytes() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("doc_bytes")


def shard_table(docs: DataFrame, limit: int = LIMIT, step: int = STEP) -> DataFrame:
    """(doc_id, shard, depth, doc_bytes, shard_bytes, shard_docs, oversized) per row of docs; no text is moved."""
    rows = docs.select("doc_id", address().alias("address"), _doc_bytes())
    return _placed(rows, limit, step).select("doc_id", *_figures(limit))


def assign_shards(docs: DataFrame, limit: int = LIMIT, step: int = STEP) -> DataFrame:
    """Whole rows of ``docs(doc_id, text, ...)`` with the shard's columns added (same-named columns are replaced)."""
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns if c.lower() not in ADDED]).alias("row"),
        address().alias("address"), _doc_bytes())
    return _placed(packed, limit, step).select("row.*", *_figures(limit))
