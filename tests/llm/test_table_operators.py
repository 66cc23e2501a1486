"""Sharding, mixing, revisits, components and the pipeline against plain Python."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from itemrank.llm import common, mixing, sharding, warc_revisits

SCHEMA = "doc_id long, text string, source string, shard string, address long, size long, hash long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [(i, " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(0, 60))), f"s{min(i % 9, 4)}", "x", 1, 2, 3)
           for i in range(300)]
    out += [(400, None, None, "x", 1, 2, 3), (401, "", None, "x", 1, 2, 3), (402, "a b c", None, "x", 1, 2, 3),
            (403, "big " * 5000, "s1", "x", 1, 2, 3), (None, "no id", "s2", "x", 1, 2, 3), (7, out[7][1], out[7][2], "x", 1, 2, 3)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def shards_by_splitting(rows, limit):
    """The directory, grown one bit at a time."""
    def bits(doc):
        return format(int(hashlib.md5(("" if doc is None else str(doc)).encode()).hexdigest()[:15], 16), "060b")
    sized = [(d, bits(d), len((t or "").encode())) for d, t, *_ in rows]
    out, todo = {}, [""]
    while todo:
        prefix = todo.pop()
        inside = [x for x in sized if x[1].startswith(prefix)]
        total = sum(x[2] for x in inside)
        if not inside:
            continue
        if total <= limit or len(prefix) == 60 or len(inside) == 1:
            for d, _, b in inside:
                out[d] = (prefix, len(prefix), b, total, len(inside), total > limit)
        else:
            todo += [prefix + "0", prefix + "1"]
    return out


@pytest.mark.parametrize("limit,step", [(10 ** 9, 10), (800, 10), (800, 3), (150, 7)])
def test_sharding(docs, rows, limit, step):
    expected = shards_by_splitting(rows, limit)
    got = sharding.shard_table(docs, limit, step).collect()
    assert collections.Counter(tuple(r) for r in got) == collections.Counter((d, *expected[d]) for d, *_ in rows)


def test_sharding_keeps_rows(spark, docs, rows):
    got = sharding.assign_shards(docs, 800)
    assert got.columns == ["doc_id", "text", "source", "address", "size", "hash", *sharding.ADDED]
    assert collections.Counter((r.doc_id, r.text, r.address) for r in got.collect()) == collections.Counter(
        (r[0], r[1], r[4]) for r in rows)
    assert sharding.assign_shards(spark.createDataFrame([], SCHEMA)).count() == 0


def water_fill(sizes, weights, share, cap):
    """Targets by resharing the excess until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, todo, left = {}, set(names), share * sum(sizes.values())
    while todo:
        level = left / sum(weight[s] for s in todo)
        over = [s for s in todo if weight[s] * level > cap * sizes[s]]
        if not over:
            target |= {s: weight[s] * level for s in todo}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            todo.remove(s)
    return target


def test_mixing(docs, rows):
    sizes = collections.Counter()
    for _, t, s, *_ in rows:
        sizes[s] += len((t or "").split())
    target = water_fill(sizes, (3, 1, 2), 1.5, 2.0)
    got = mixing.mix(docs).collect()
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    taken = collections.Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, want in target.items():
        inside = [r.size for r in got if r.source == s]
        assert abs(taken[s] - want) <= max(0.03 * want, 30, max(inside) / 2), (s, taken[s], want)
    again = mixing.mix(docs.repartition(5)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, again))


def test_mixing_empty(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    blank = spark.createDataFrame([(1, None, "a", "", 1, 1, 1), (2, "", None, "", 1, 1, 1)], SCHEMA)
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0]


def test_balance_two_margins(spark):
    cells = spark.createDataFrame([("a", "x", 100), ("a", "y", 200), ("b", "x", 300), ("b", "y", 50)],
                                  "source string, lang string, size long")
    goal = {"source": {"a": 250.0, "b": 250.0}, "lang": {"x": 300.0, "y": 200.0}}
    lam = mixing.balance(cells, ["source", "lang"], goal, cap=1e9)
    import math
    for margin, names in goal.items():
        for group, want in names.items():
            total = sum(r["size"] * math.exp(lam["source"][r["source"]] + lam["lang"][r["lang"]])
                        for r in cells.collect() if r[margin] == group)
            assert total == pytest.approx(want, rel=1e-6)


RECORDS = ("record_id long, type string, url string, ts long, status int, headers map<string,string>, "
           "payload_digest string, payload_bytes long, bucket int, id long")


def resolve(rows):
    """Latest earlier 2xx response by canonical URL (given), validators, outcome."""
    out = []
    for i, kind, url, ts, _, headers, digest, _ in rows:
        if kind != "revisit":
            continue
        before = [r for r in rows if r[1] == "response" and 200 <= r[4] < 300 and url is not None and r[2] is not None
                  and ts is not None and r[3] is not None and r[2].split("//")[1].split("#")[0] == url.split("//")[1].split("#")[0] and r[3] < ts]
        if not before:
            out.append((i, "no_earlier", None))
            continue
        full = max(before, key=lambda r: (r[3], r[0]))
        mine, theirs = ({k.lower(): v for k, v in (h or {}).items()} for h in (headers, full[5]))
        def tag(h):
            return h["etag"].removeprefix("W/") if "etag" in h else None
        outcome = "no_validator"
        for x, y in ((tag(mine), tag(theirs)), (mine.get("last-modified"), theirs.get("last-modified")), (digest, full[6])):
            if x is not None and y is not None:
                outcome = "resolved" if x == y else "mismatch"
                break
        out.append((i, outcome, full[0]))
    return collections.Counter(out)


@pytest.mark.parametrize("buckets", [1, 4, 4096])
def test_revisits(spark, buckets):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        url = rng.choice([None, "http://a.org/x", "http://a.org/x#f", "https://b.org/y"]) if i > 200 else "http://hot.org/"
        kind = rng.choice(["response", "revisit", "request"])
        headers = rng.choice([None, {}, {"ETag": '"1"'}, {"etag": 'W/"1"'}, {"ETAG": '"2"'}, {"Last-Modified": "d1"},
                              {"Last-Modified": "d2", "X": "y"}])
        rows.append((i, kind, url, rng.choice([None, *range(40)]), rng.choice([200, 206, 404]), headers,
                     rng.choice([None, "p", "q"]), 10))
    rows.append(rows[1])
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], RECORDS)
    got = warc_revisits.resolve_revisits(frame, buckets).collect()
    assert collections.Counter((r.record_id, r.outcome, r.response_id) for r in got) == resolve(rows)


def test_revisit_headers(spark):
    rows = [(1, "response", "HTTP://user@WWW.A.org:80/p/?b=2&utm_x=1&a=1#z", 5, 200,
             {"ETag": '"v"', "Content-Type": "text/html", "Cache-Control": "old"}, "d", 9, 0, 0),
            (2, "revisit", "http://a.org/p?a=1&b=2", 6, 304,
             {"etag": 'W/"v"', "cache-control": "new", "Content-Length": "0", "Set-Cookie": "c"}, None, None, 0, 0)]
    r = warc_revisits.resolve_revisits(spark.createDataFrame(rows, RECORDS)).first()
    assert r.url == "a.org/p?a=1&b=2" and r.outcome == "resolved" and r.payload_digest == "d" and r.status == 200
    assert r.headers == {"etag": 'W/"v"', "content-type": "text/html", "cache-control": "new"}
    bodies = spark.createDataFrame([(1, "<html>")], "record_id long, payload string")
    resolved = warc_revisits.resolve_revisits(spark.createDataFrame(rows, RECORDS))
    assert warc_revisits.with_payload(resolved, bodies).first().payload == "<html>"
    assert warc_revisits.resolve_revisits(spark.createDataFrame([], RECORDS)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(5, 5)]
    root = {x: x for pair in links for x in pair}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    expected = {x: find(x) for a, b in links if a != b for x in (a, b)}
    got = common.components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == expected
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark):
    """Each stage's decision, taken from its operator on its own input, has its effect."""
    import corpus_pipeline
    from itemrank.llm import decontaminate, minhash_dedup, quality_rules

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "decontamination", "mixing", "sharding"]
    verdicts = {
        "quality_rules": lambda d: quality_rules.quality(d, spark.read.parquet(f"{sf}/labels.parquet")).where("kept"),
        "minhash_near_dedup": lambda d: minhash_dedup.near_duplicates(d).where("kept"),
        "decontamination": lambda d: decontaminate.contamination(
            d, spark.read.parquet(f"{sf}/benchmark.parquet")).where("not contaminated"),
        "mixing": lambda d: mixing.mix(d).where("copies > 0").select("doc_id", F.explode(
            F.sequence(F.lit(1), F.col("copies")))),
    }
    for name, stage in corpus_pipeline.STAGES:
        out = common.written(stage(spark, docs, sf), name)
        ids = sorted(r.doc_id for r in out.select("doc_id").collect())
        if name in verdicts:
            assert out.columns == columns
            assert ids == sorted(r.doc_id for r in verdicts[name](docs).collect())
        else:
            assert ids == sorted(r.doc_id for r in docs.collect()) and "shard" in out.columns
        texts = {r.doc_id: r.text for r in docs.collect()}
        assert all(texts[r.doc_id] == r.text for r in out.collect())
        docs = out


def test_pipeline_stages_on_awkward_rows(spark, tmp_path):
    """Null, empty, repeated and clashing input goes through every stage; an empty table stays empty."""
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, m_copies int, row int, cut long"
    long = " ".join(f"w{i % 97}x{i}" for i in range(3000))
    rows = [(1, long, "en", "a", 1, "k", 2, 3, 4), (1, long, "en", "a", 1, "k", 2, 3, 4), (2, None, None, None, None, None, None, None, None),
            (3, "", "en", "b", 0, "k", 2, 3, 4), (None, " ".join(f"q{i}" for i in range(40)), "en", None, 9, "k", 2, 3, 4)]
    rows += [(10 + i, " ".join(f"u{i}v{j}" for j in range(30 + i)), "en", "ab"[i % 2], 9, "k", 2, 3, 4) for i in range(20)]
    for name, columns in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = common.written(stage(spark, docs, str(tmp_path)), name)
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert (last.count() > 0) == bool(given)


def test_near_dedup_stage_keeps_one_row_of_copies(spark):
    """Repeated rows and copies leave one row; rows without an id stay unless their text is another's copy."""
    import corpus_pipeline

    text = [" ".join(f"t{k}w{i}" for i in range(40)) for k in range(5)]
    rows = [(1, text[0], 7), (1, text[0], 7), (2, text[0] + " tail", 7), (3, text[1], 7), (None, text[2], 7), (None, text[2], 7),
            (None, text[1], 7), (None, text[3], 7), (4, text[4], 7), (4, text[4] + " other words that differ", 7), (None, None, 7), (5, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at int").repartition(3)
    got = collections.Counter(tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert got == collections.Counter([(1, text[0], 7), (3, text[1], 7), (None, text[2], 7), (None, text[3], 7), (4, text[4], 7),
                                       (4, text[4] + " other words that differ", 7), (None, None, 7), (5, "", 7)])


def test_registered_sharding_splits(spark):
    from itemrank.llm import queries as llm_queries

    got = llm_queries.op6_sharding(spark, "/root/testdata/sf0.01")
    assert got.agg(F.countDistinct("shard")).first()[0] > 2 and got.agg(F.max("shard_bytes")).first()[0] <= 1 << 20
