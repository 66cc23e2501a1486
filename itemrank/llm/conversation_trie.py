"""Conversation prefix trie with a depth-band rollup.

Rebuilding.  Turns are sorted once by range over (conv_id, turn, role, text)
and written with their place, so a conversation of any length lies in as many
range partitions as it needs; its places come from the counts of its earlier
partitions.  Conversation c starts with the first h turns of conversation
c - c % 20 and goes on with its own turns after its first h.

Nodes.  A node is a distinct sequence of first d turns.  Its key is d and two
64-bit sums (exclusive or) of hashes of (place, role, text); the running sums
are made inside each range partition and then carried over the partitions of
a long conversation.  Nodes are one aggregate over (conversation, depth) rows.

Rollup.  Depths are cut into bands of ``band`` levels.  A node only explodes
to its ancestors inside its band.  Totals of the band roots are summed first
(each node adds to one band root); the band roots form a trie of a ``band``-th
of the depth, which is rolled up in the same way; what comes out of it is
complete, and each band root's total is then added to its ancestors in the
band above.  So a node explodes to at most ``band`` rows a level, and there
are log(depth) / log(band) levels.

Hot keys.  Sums by node combine before the shuffle.  The only look-up that a
popular node would skew is that of its children's parent: nodes with more than
a 1/``HOT_SHARE`` of all nodes as children, which are ``HOT_SHARE`` at most,
are broadcast, the others are joined by key.  The digest of the conversations
that end at a node reads pieces of up to 4096 ids, in order, as a stream.

Nulls: a null role or text is empty, a null turn sorts first, rows with a null
``conv_id`` belong to no conversation.  Turns of equal number are ordered by
role and text; repeated rows are turns of their own.  No rows: no nodes.
Empty and very long texts are used whole.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

GROUP = 20           # conversations c - c % GROUP lend their first turns
BAND = 8
HOT_SHARE = 1000
PIECE_BITS = 12      # ids of one piece of a node's digest: 2 ** PIECE_BITS at most
KEY = ["depth", "h1", "h2"]
SUMS = ["leaves", "saved"]

_PARENT = {"h1": "p1", "h2": "p2"}


def _kept_turns() -> Column:
    """h: how many turns conversation ``conv_id`` takes from the head of its group."""
    return (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")


def _sorted_turns(convs: DataFrame) -> DataFrame:
    """(conv_id, at, part, c1, c2, words): ``at`` grows in the order of (conv_id, turn, role, text)."""
    order = ["conv_id", "turn", "role", "text"]
    rows = convs.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    return written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv_id", F.monotonically_increasing_id().alias("at"),
            F.xxhash64(F.lit(1), "role", "text").alias("c1"), F.xxhash64(F.lit(2), "role", "text").alias("c2"),
            F.regexp_count("text", F.lit(r"[^ \t-\r]+")).cast("long").alias("words")).selectExpr(
            "conv_id", "at", "at >> 33 as part", "c1", "c2", "words"), "turns")


def _running(of: Column, window) -> Column:
    return F.bit_xor(of).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _terms(rows: DataFrame) -> DataFrame:
    """Adds t1, t2: the hashes of (depth, turn)."""
    return rows.select("*", F.xxhash64(F.lit(11), "c1", "c2", F.col("depth").cast("long")).alias("t1"),
                       F.xxhash64(F.lit(12), "c1", "c2", F.col("depth").cast("long")).alias("t2"))


def paths(convs: DataFrame) -> DataFrame:
    """(conv_id, depth, h1, h2, p1, p2, words, piece): every prefix of every rebuilt conversation.

    (p1, p2) is the parent's key (null at the root); ``piece`` is null but for
    whole conversations, where it numbers blocks of conversations in id order.
    """
    turns = _sorted_turns(convs)
    by_part = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("conv_id").orderBy("part")
    by_part = by_part.select(
        "conv_id", "part", "first",
        F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"),
        F.shiftright(F.min("first").over(Window.partitionBy("conv_id")), PIECE_BITS).alias("piece"),
        _kept_turns().alias("h"))
    by_part = written(by_part, "parts")
    placed = turns.join(by_part, ["conv_id", "part"]).withColumn(
        "place", F.col("at") - F.col("first") + F.col("start") + 1)

    one = by_part.where("start = 0").select("conv_id", "h", "n_turns", "piece")
    heads = written(placed.where("place <= 3").select(
        F.col("conv_id").alias("head"), F.col("place").alias("depth"), "c1", "c2", "words"), "heads")
    lent = _terms(one.withColumn("head", F.expr(f"conv_id - conv_id % {GROUP}"))
                  .join(heads, "head").where("depth <= h"))
    in_head = Window.partitionBy("conv_id").orderBy("depth")
    lent = written(lent.select(
        "conv_id", "depth", _running(F.col("t1"), in_head).alias("h1"), _running(F.col("t2"), in_head).alias("h2"),
        "t1", "t2", "words",
        F.when((F.col("depth") == F.max("depth").over(Window.partitionBy("conv_id"))) & (F.col("n_turns") <= F.col("h")),
               F.col("piece")).alias("piece")), "lent")
    lent_sum = lent.groupBy("conv_id").agg(F.max("depth").alias("lent"), F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))

    # the conversation's own turns after its first h: what went before comes with its part
    known = by_part.join(lent_sum, "conv_id", "left").na.fill(0, ["lent", "x1", "x2"])
    own = _terms(turns.join(known, ["conv_id", "part"]).withColumn(
        "place", F.col("at") - F.col("first") + F.col("start") + 1).where("place > h").withColumn(
        "depth", F.col("place") - F.col("h") + F.col("lent")))
    in_part = Window.partitionBy("conv_id", "part").orderBy("at")
    own = written(own.select(
        "conv_id", "part", "depth", (_running(F.col("t1"), in_part)).alias("r1"), _running(F.col("t2"), in_part).alias("r2"),
        "t1", "t2", "words", "x1", "x2", F.when(F.expr("place = n_turns"), F.col("piece")).alias("piece")), "own")
    sums = own.groupBy("conv_id", "part").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv_id", "part", F.coalesce(F.bit_xor("s1").over(earlier), F.lit(0)).alias("e1"),
                          F.coalesce(F.bit_xor("s2").over(earlier), F.lit(0)).alias("e2"))
    own = own.join(carried, ["conv_id", "part"]).select(
        "conv_id", "depth", F.expr("r1 ^ e1 ^ x1").alias("h1"), F.expr("r2 ^ e2 ^ x2").alias("h2"), "t1", "t2", "words", "piece")

    root = one.join(lent_sum, "conv_id", "left").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"),
        F.lit(0).cast("long").alias("t1"), F.lit(0).cast("long").alias("t2"), F.lit(0).cast("long").alias("words"),
        F.when(F.col("lent").isNull() & (F.col("n_turns") <= F.col("h")), F.col("piece")).alias("piece"))
    every = own.unionByName(lent).unionByName(root)
    return written(every.select(
        "conv_id", "depth", "h1", "h2", F.expr("if(depth > 0, h1 ^ t1, null)").alias("p1"),
        F.expr("if(depth > 0, h2 ^ t2, null)").alias("p2"), "words", "piece"), "paths")


def _ancestors(prefixes: DataFrame, step: int, band: int) -> DataFrame:
    """(conv_id, at, path): the keys of a conversation's prefixes in each band of ``band`` steps, top first."""
    return (prefixes.where(F.col("depth") % step == 0)
            .select("conv_id", F.expr(f"depth div {step * band}").alias("at"), F.struct(*KEY).alias("node"))
            .groupBy("conv_id", "at").agg(F.array_sort(F.collect_list("node")).alias("path")))


def rollup(prefixes: DataFrame, nodes: DataFrame, values: DataFrame, deepest: int, band: int = BAND,
           step: int = 1) -> DataFrame:
    """(depth, h1, h2, sums): ``values(conv_id, depth, sums)`` of nodes summed over subtrees.

    ``conv_id`` is the node's smallest member.  Only depths that ``step``
    divides take part; the bands above are rolled up by the next call.
    """
    above = _ancestors(prefixes, step, band)
    height = step * band
    at = F.expr(f"depth div {height}").alias("at")
    adds = values
    if deepest >= height:
        tops = values.select("conv_id", at, *SUMS).join(above, ["conv_id", "at"]).groupBy(
            F.col("path")[0].alias("node")).agg(*[F.sum(s).alias(s) for s in SUMS]).select("node.*", *SUMS)
        tops = tops.join(nodes.select(*KEY, "conv_id"), KEY).select("conv_id", "depth", *SUMS)
        whole = rollup(prefixes, nodes, written(tops, "bands"), deepest, band, height)
        below = whole.where("depth > 0").join(nodes.select(*KEY, "conv_id"), KEY)
        adds = values.unionByName(below.select("conv_id", (F.col("depth") - step).alias("depth"), *SUMS))
    upward = (adds.select("conv_id", "depth", at, *SUMS).join(above, ["conv_id", "at"])
              .select("depth", F.explode("path").alias("node"), *SUMS).where("node.depth <= depth"))
    return written(upward.groupBy("node").agg(*[F.sum(s).alias(s) for s in SUMS]).select("node.*", *SUMS), "rollup")


def _digests(prefixes: DataFrame) -> DataFrame:
    """(depth, h1, h2, ends_sha256) of nodes where conversations end."""
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = (prefixes.where("piece is not null").groupBy(*KEY, "piece")
              .agg(F.array_join(ids, ",").alias("ids")))

    def digest(batches):
        current, state = None, None
        for batch in batches:
            done = []
            columns = batch.to_pydict()
            for *key, ids in zip(*[columns[c] for c in (*KEY, "ids")]):
                if key == current:
                    state.update(b",")
                else:
                    if state:
                        done.append((*current, state.hexdigest()))
                    current, state = key, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield _digest_batch(done)
        if state:
            yield _digest_batch([(*current, state.hexdigest())])

    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids").mapInArrow(
        digest, "depth long, h1 long, h2 long, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    *numbers, text = zip(*rows)
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in numbers), pa.array(text, pa.string())],
                                      names=[*KEY, "ends_sha256"])


def _with_parents(nodes: DataFrame, n_nodes: int) -> DataFrame:
    """Adds parent_conv_id (null at the root) to nodes, whose ``n_children`` are known."""
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"), "n_children")
    on = ["depth", "p1", "p2"]
    hot = parents.where(F.col("n_children") > n_nodes / HOT_SHARE).drop("n_children")  # at most HOT_SHARE rows
    rest = parents.where(F.col("n_children") <= n_nodes / HOT_SHARE).drop("n_children")
    tried = nodes.join(F.broadcast(hot), on, "left")
    found = tried.where("parent_conv_id is not null or depth = 0")
    return found.unionByName(tried.where("parent_conv_id is null and depth > 0").drop("parent_conv_id").join(rest, on))


def prefix_trie(convs: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the trie over the rebuilt conversations of ``convs(conv_id, turn, role, text)``.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256), all numbers long.  ``band`` is at least 2.
    """
    if band < 2:
        raise ValueError("a band has at least two levels")
    prefixes = paths(convs)
    nodes = prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = written(nodes, "nodes")
    size = nodes.agg(F.count("*").alias("n"), F.max("depth").alias("deepest")).first()
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(
        F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, KEY, "left").na.fill(0, ["n_children"]), "nodes")
    values = nodes.select("conv_id", "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    totals = rollup(prefixes, nodes, values, size["deepest"] or 0, band)
    out = nodes.join(totals, KEY).join(_digests(prefixes), KEY, "left")
    return _with_parents(out, size["n"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
