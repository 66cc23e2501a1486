"""The prefix trie against a plain dictionary of prefixes."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from itemrank.llm import conversation_trie
from itemrank.llm import queries as llm_queries

SCHEMA = "conv_id long, turn long, role string, text string, depth string, h1 string, node string, piece string, n_convs long"
EXTRA = ("x", "y", "z", "p", 5)


def plain_trie(rows):
    """Every prefix of every rebuilt conversation as a tuple of (role, text)."""
    turns = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            turns[c].append(((turn is not None, turn or 0), role or "", text or ""))
    whole = {c: [(r, t) for _, r, t in sorted(x, key=lambda y: (y[0], y[1].encode(), y[2].encode()))] for c, x in turns.items()}
    members = collections.defaultdict(list)
    for c, own in whole.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt = whole.get(head, [])[:h] + own[h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append((c, d == len(rebuilt)))
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * words
    first = {p: min(c for c, _ in m) for p, m in members.items()}
    return [(first[p], len(p), first[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p],
             hashlib.sha256(",".join(str(c) for c in sorted(c for c, end in m if end)).encode()).hexdigest())
            for p, m in members.items()]


def check(spark, rows, **options):
    got = conversation_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), **options).collect()
    assert collections.Counter(tuple(r) for r in got) == collections.Counter(plain_trie(rows))
    return got


def conversations(seed, n, longest, alphabet):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot"]), " ".join(rng.choices(alphabet, k=rng.randrange(0, 3))), *EXTRA)
            for c in range(-n // 4, n) if rng.random() < 0.8 for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("band", [2, 8])
def test_random_conversations(spark, band):
    check(spark, conversations(1, 120, 9, ["a", "b c"]), band=band)


def test_long_conversations_share_long_prefixes(spark):
    """Depths over several bands of bands; copies of a long conversation that end at different turns."""
    rows = [(20 * c, t, "user", f"turn {t}", *EXTRA) for c in range(12) for t in range(70 + 5 * (c % 3))]
    rows += [(20 * c + 400, t, "user", "a", *EXTRA) for c in range(3) for t in range(9)]
    for band in (2, 3, 8):
        got = check(spark, rows, band=band)
        assert max(r.depth for r in got) == 80


def test_one_conversation_over_many_range_partitions(spark):
    """A conversation with most of the rows: its places and keys are carried from partition to partition."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(40, t, "user", f"t{t}", *EXTRA) for t in range(300)] + [(41, t, "user", f"t{t}", *EXTRA) for t in range(300)]
        rows += [(60, 0, "user", "x", *EXTRA)]
        turns = conversation_trie._sorted_turns(spark.createDataFrame(rows, SCHEMA))
        assert turns.where("conv_id = 40").select("part").distinct().count() > 1
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_edge_cases(spark):
    """Nulls, ties, repeated rows, absent heads, turnless conversations, empty and long texts."""
    rows = [(0, None, None, None, *EXTRA), (0, 1, "user", "b", *EXTRA), (0, 1, "user", "a", *EXTRA),
            (0, 1, "user", "a", *EXTRA), (0, 2, "bot", "", *EXTRA), (None, 1, "user", "nobody", *EXTRA),
            (3, 0, "user", "long " * 50_000, *EXTRA), (4, 0, "user", "long " * 50_000, *EXTRA)]
    rows += [(c, 0, "user", "only turn", *EXTRA) for c in range(1000, 1040)]      # heads 1000 and 1020 are there
    rows += [(c, 0, "user", "only turn", *EXTRA) for c in range(2005, 2020)]      # head 2000 is not
    rows += [(2 ** 62, 0, "user", "only turn", *EXTRA), (-2 ** 62, 0, None, "only turn", *EXTRA)]
    got = check(spark, rows)
    assert any(r.depth == 0 and r.ends_sha256 != hashlib.sha256(b"").hexdigest() for r in got)
    assert conversation_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        conversation_trie.prefix_trie(spark.createDataFrame([], SCHEMA), band=1)


def test_ends_of_a_popular_node_are_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "PIECE_BITS", 3)
    monkeypatch.setattr(conversation_trie, "HOT_SHARE", 4)
    check(spark, [(20 * c, t, "user", "same", *EXTRA) for c in range(200) for t in range(4)])
    check(spark, [(20 * c, t, "user", "same" if t == 0 else f"{c} {t}", *EXTRA) for c in range(60) for t in range(3)])


def test_query_on_whole_table(spark):
    got = llm_queries.op11_conversation_trie(spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert collections.Counter(tuple(r) for r in got.collect()) == collections.Counter(plain_trie(rows))
