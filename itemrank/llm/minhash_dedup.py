"""MinHash near-duplicate classes by a signature-coordinate inverted join.

Method.  A text's set is its distinct word shingles.  Texts with equal sets
form one class (copies are folded before any join).  Each class posts itself
under every (coordinate, value) pair of its MinHash signature.  Two sets of
similarity s agree in each of ``COORDINATES`` coordinates with probability s,
so linked classes collide in at least ``MATCHES`` of them (probability of
fewer at s = 0.75: about 3e-8).  That makes the two merging rules exact:

* skip: a posting list of one class is dropped, and a class with fewer than
  ``MATCHES`` shared postings is dropped whole;
* prefix: with its shared postings ordered rarest first, a class needs only
  the first ``size - MATCHES + 1``; a pair with enough collisions meets there.

The surviving pairs' collisions are counted over the whole signatures, pairs
at or above ``MATCHES`` go on, and each is confirmed on the full shingle sets.

Hot lists.  No list is expanded into all pairs.  Each class is first compared
with one partner, the list head that it meets most often; this joins a large
group of near copies into one component through few heads.  Only classes in
different components can still add a link.  For these, lists with one head
are merged into a group (a family of near copies fills many lists with the
same members), and groups that hold more than one component are compared in
blocks inside tasks: signatures first, which marks the classes with a partner
across components, then the marked ones by their full sets.  A task emits
marks and a spanning set of links, so what leaves it grows with its members,
not with their pairs.

Nulls, empty texts: empty set, linked with nothing.  Fewer than ``width``
words: one shingle, the whole sequence.  Repeated rows of one id and text fold
into one class; if an id comes with several texts, a link of any counts for it.  An empty table gives an empty result.  Other columns, with
whatever names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, written
from .textops import as_long, blank_separated, mix, ngram_hashes, text_chunks

WIDTH = 5
PERCENT = 75
COORDINATES = 64
MATCHES = 28
BLOCK = 512
TEXT_BLOCK = 256


def shingle_sets(texts: pa.Array, width: int = WIDTH):
    """Yield (first text, sorted distinct shingle hashes, set offsets) per chunk of texts."""
    for w in text_chunks(texts, blank_separated(), lower=True):
        h, offsets = w.hashes(), w.offsets
        grams = ngram_hashes(h, width)
        parts = []
        for t in range(w.n):
            a, b = int(offsets[t]), int(offsets[t + 1])
            if b - a >= width:
                own = grams[a:b - width + 1].copy()
                own.sort()
                parts.append(own)
            elif b > a:  # too short: the whole sequence, told apart by its length
                parts.append(ngram_hashes(h[a:b], b - a) ^ np.uint64(b - a))
            else:
                parts.append(np.zeros(0, np.uint64))
        sizes = np.array([len(p) for p in parts], np.int64)
        ends = np.cumsum(sizes)
        allh = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        new = np.ones(len(allh), bool)
        new[1:] = allh[1:] != allh[:-1]
        new[(ends - sizes)[sizes > 0]] = True
        distinct = np.concatenate([[0], np.cumsum(new)])
        yield w.first, allh[new], np.concatenate([[0], distinct[ends]])


def _signatures(batches, width, coordinates):
    rng = np.random.default_rng(20240501)
    xors = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64)
    odds = rng.integers(0, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for batch in batches:
        ids = batch.column(0)
        for first, u, at in shingle_sets(batch.column(1), width):
            n = len(at) - 1
            size = np.diff(at)
            full = np.flatnonzero(size > 0)
            one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            sig = np.zeros((n, coordinates), np.uint32)
            if len(full):
                starts = at[:-1][full]
                one[full] = np.add.reduceat(mix(u), starts)
                two[full] = np.add.reduceat(mix(u ^ np.uint64(0x5851F42D4C957F2D)), starts)
                for k in range(coordinates):
                    least = np.minimum.reduceat((u ^ xors[k]) * odds[k], starts)
                    sig[full, k] = (least >> np.uint64(32)).astype(np.uint32)
            raw = sig.tobytes()
            step = 4 * coordinates
            yield pa.RecordBatch.from_arrays([
                ids.slice(first, n), pa.array(size, pa.int64()), as_long(one), as_long(two),
                pa.array([raw[i * step:(i + 1) * step] for i in range(n)], pa.binary())],
                names=["doc_id", "n_shingles", "d1", "d2", "sig"])


def _postings(batches, coordinates):
    place = np.arange(coordinates, dtype=np.uint64) << np.uint64(32)
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, coordinates)
            token = mix((sig.astype(np.uint64) | place).ravel())
            ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), coordinates)
            yield pa.RecordBatch.from_arrays([as_long(token), pa.array(ids, pa.int64())], names=["token", "rep"])


def _count_matches(batches, coordinates, matches):
    """Keep pairs whose signatures agree in at least ``matches`` coordinates."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint32).reshape(-1, coordinates)
                    for c in (2, 3))
            keep = pa.array((x == y).sum(axis=1) >= matches)
            yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)],
                                             names=["a", "b"])


def _confirm(batches, width, percent):
    """Exact similarity of pairs (a, b, text_a, text_b) on full shingle sets."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            sets = []
            for c in (2, 3):
                own, codes = [], part.column(c).dictionary_encode()
                for _, u, at in shingle_sets(codes.dictionary, width):
                    own += [u[at[i]:at[i + 1]] for i in range(len(at) - 1)]
                sets.append([own[i] for i in codes.indices.to_pylist()])
            keep = []
            for p, q in zip(*sets, strict=True):
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(p) + len(q) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(0).filter(mask), part.column(1).filter(mask)],
                                             names=["a", "b"])


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width, percent, coordinates, matches):
    """Pairs of class representatives that collide often enough and are linked on their full sets."""
    sig_a = classes.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"))
    sig_b = classes.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"))
    often = pairs.join(sig_a, "a").join(sig_b, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(
        lambda it: _count_matches(it, coordinates, matches), "a long, b long")
    text_a = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    text_b = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    return often.join(text_a, "a").join(text_b, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        lambda it: _confirm(it, width, percent), "a long, b long")


def _by_block_pair(batches):
    """Regroup rows sorted by (head, i, j) into one table per block pair, one at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in range(3)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if held and tuple(keys[:, 0]) != tuple(held[-1].column(c)[-1].as_py() for c in range(3)):
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for cut in cuts:
            yield pa.Table.from_batches([*held, batch.slice(start, cut - start)])
            held, start = [], cut
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _sides(table):
    """(rep, comp, places on the left, places on the right) of one block pair."""
    rep, comp, side = (table.column(c).to_numpy() for c in ("rep", "comp", "side"))
    every = np.arange(len(rep))
    return rep, comp, every[side == 0], (every[side == 1] if side.any() else every)


def _mark(batches, coordinates, matches, percent):
    """Classes with a partner across components whose signature agrees often enough."""
    for table in _by_block_pair(batches):
        rep, comp, left, right = _sides(table)
        if len(rep) < 2 or (comp == comp[0]).all():
            continue
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(-1, coordinates)
        size = table.column("n_shingles").to_numpy()
        marked = np.zeros(len(rep), bool)
        for x in left:
            ys = right[(comp[right] != comp[x]) & (100 * np.minimum(size[right], size[x]) >= percent * np.maximum(size[right], size[x]))]
            ys = ys[(sig[ys] == sig[x]).sum(axis=1) >= matches]
            if len(ys):
                marked[x] = True
                marked[ys] = True
        keep = pa.array(marked)
        yield pa.RecordBatch.from_arrays([table.column(c).combine_chunks().filter(keep) for c in ("head", "rep", "comp")],
                                         names=["head", "rep", "comp"])


def _link(batches, width, percent):
    """A spanning set of the exact links across components within each block pair."""
    for table in _by_block_pair(batches):
        rep, comp, left, right = _sides(table)
        comp = comp.copy()
        sets = [u[at[i]:at[i + 1]] for _, u, at in shingle_sets(table.column("text"), width) for i in range(len(at) - 1)]
        size = np.array([len(x) for x in sets])
        left, right = left[size[left] > 0], right[size[right] > 0]
        if not len(left) or not len(right):
            continue
        _, code = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(size) - size
        found = []
        right_codes = np.concatenate([code[starts[y]:starts[y] + size[y]] for y in right])
        right_starts = np.cumsum(size[right]) - size[right]
        mark = np.zeros(int(code.max()) + 1, np.int64)
        for x in left:
            own = code[starts[x]:starts[x] + size[x]]
            mark[own] = 1
            both = np.add.reduceat(mark[right_codes], right_starts)
            mark[own] = 0
            for k in np.flatnonzero((100 * both >= percent * (size[x] + size[right] - both)) & (comp[right] != comp[x])):
                y = right[k]
                if comp[y] != comp[x]:
                    found.append((min(rep[x], rep[y]), max(rep[x], rep[y])))
                    comp[comp == comp[y]] = comp[x]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _in_blocks(members: DataFrame, block: int) -> DataFrame:
    """(head, i, j, side, rep, comp): every pair of ``block``-sized parts of each group meets once."""
    counts = written(members.groupBy("head").agg(
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"), F.min("comp").alias("lo"),
        F.max("comp").alias("hi")).where("lo <> hi").select("head", "blocks"), "groups")
    dealt = members.join(counts, "head").withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "head", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "rep", "comp")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT,
                    coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs(doc_id, text)``.

    A repeated (id, text) row gives a repeated result row; ``kept`` is by id.
    A null ``doc_id`` has its own component: null, not kept.
    """
    signed = written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda it: _signatures(it, width, coordinates),
        "doc_id long, n_shingles long, d1 long, d2 long, sig binary"), "signatures")
    classes = written(signed.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.any_value("sig").alias("sig")), "classes")

    postings = classes.select("rep", "sig").mapInArrow(
        lambda it: _postings(it, coordinates), "token long, rep long")
    # (counts are written before they are joined back: Spark splits a hot list only where both sides are plain shuffles)
    shared = written(postings.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    per_class = postings.join(shared, "token").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("n", "token"))).alias("own")).where(F.size("own") >= matches)
    prefix = written(per_class.select("rep", F.explode(
        F.slice("own", 1, F.size("own") - (matches - 1))).alias("o")).select("rep", "o.token"), "prefix")

    # one partner per class: the list head met in most lists
    heads = written(prefix.groupBy("token").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1"),
                    "heads")
    met = prefix.withColumnRenamed("rep", "b").join(heads, "token").where("a < b").groupBy("a", "b").count()
    first = met.groupBy("b").agg(F.max_by("a", F.struct("count", -F.col("a"))).alias("a")).select("a", "b")
    candidates = prefix.select("rep").distinct()
    texts = written(docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(
        candidates, "rep", "left_semi"), "texts")
    linked = written(_confirmed(first, classes, texts, width, percent, coordinates, matches), "linked")
    comps = components(linked)

    # across components: groups of lists with one head that still hold more than one
    lists = prefix.join(heads.select("token", F.col("a").alias("head")), "token").select("head", "rep").distinct()
    placed = written(lists.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        "head", "rep", F.coalesce("component", "rep").alias("comp")), "placed")
    marked = written(_in_blocks(placed, BLOCK).join(classes.select("rep", "sig", "n_shingles"), "rep").select(
        "head", "i", "j", "side", "rep", "comp", "sig", "n_shingles")
        .repartition("head", "i", "j").sortWithinPartitions("head", "i", "j")
        .mapInArrow(lambda it: _mark(it, coordinates, matches, percent), "head long, rep long, comp long")
        .distinct(), "marked")
    more = _in_blocks(marked, TEXT_BLOCK).join(texts, "rep").select(
        "head", "i", "j", "side", "rep", "comp", "text").repartition("head", "i", "j").sortWithinPartitions(
        "head", "i", "j").mapInArrow(lambda it: _link(it, width, percent), "a long, b long")
    merged = components(linked.unionAll(more))

    by_class = classes.select("d1", "d2", "n_shingles", "rep").join(
        merged.withColumnRenamed("node", "rep"), "rep", "left").select(
        "d1", "d2", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    out = signed.drop("sig").join(by_class, ["d1", "d2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
