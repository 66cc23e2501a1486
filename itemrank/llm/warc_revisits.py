"""Resolution of not-modified revisit records against earlier full responses.

A ``revisit`` record says that the server answered 304 Not Modified: it has
headers and no body.  It is resolved by an as-of join: by canonical URL, to
the latest full (2xx) response captured before it.  The response is used if
its validators agree: entity tags where both have one (weak comparison),
otherwise Last-Modified, otherwise the payload digest.  The resolved headers
are those of the response, updated with the fields that a 304 may carry.

As-of at scale.  The answer depends on (URL, time) only, so revisits are
folded to distinct pairs before the join.  Time is cut into ``BUCKETS`` equal
spans: a window runs inside one (URL, span) and a second one, over at most
``BUCKETS`` rows of a URL, carries the last response of earlier spans, so a
URL that holds a third of all captures is split.  Bodies take no part in
either; they stay with the response and are joined by its id at the end.

Outcomes (``outcome``): ``resolved``; ``mismatch`` (validators differ);
``no_validator`` (none in common); ``no_earlier`` (no earlier full response,
no URL, or no time).  Responses at the same time are not earlier; among
responses of one time the greatest id counts.  Repeated record rows give
repeated results; a repeated response counts once.  Null headers are an empty
map; header names are compared in lower case, and of names that differ only
in case the smallest value counts.  Empty tables give empty results.  Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

BUCKETS = 4096

#: Fields a 304 may update in the stored response (fixed values, HTTP semantics).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")

#: Query parameters that do not select content (fixed values).
TRACKING = r"^(utm_[^=]*|gclid|fbclid|sessionid|jsessionid|phpsessid|sid|ref)(=.*)?$"

_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)([?][^#]*)?"


def canonical_url(url: Column) -> Column:
    """Host without scheme, user, ``www.`` and default port, path without closing slash, sorted query; no fragment."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(plain, _URL, 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", ""), "^www[0-9]*[.]", "")
    path = F.regexp_replace(F.regexp_extract(plain, _URL, 2), "/+$", "")
    query = F.array_sort(F.filter(F.split(F.substring(F.regexp_extract(plain, _URL, 3), 2, 1 << 30), "&"),
                                  lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    whole = F.concat(host, F.when(path == "", "/").otherwise(path),
                     F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))
    return F.when(plain.rlike(_URL), whole).otherwise(plain)


def _lowered(headers: Column) -> Column:
    """The header map with lower-case names, as sorted (name, value) pairs, one a name."""
    pairs = F.array_sort(F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
                                     lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
    first = F.filter(pairs, lambda e, i: (i == 0) | (e["key"] != F.get(pairs, i - 1)["key"]))
    return F.map_from_entries(first)


def _tag(h: str) -> Column:
    return F.regexp_replace(F.element_at(F.col(h), "etag"), "^W/", "")


def last_response_before(asked: DataFrame, responses: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(url, ts, response_id) for distinct ``asked(url, ts)``: the latest of ``responses(url, ts, id)`` with a smaller ts."""
    asked = asked.where("url is not null and ts is not null").distinct()
    full = responses.where("url is not null and ts is not null").groupBy("url", "ts").agg(F.max("id").alias("id"))
    events = written(asked.select("url", "ts", F.lit(None).cast("long").alias("id")).unionAll(
        full.select("url", "ts", "id")), "captures")
    span = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    lo, hi = span["lo"] or 0, span["hi"] or 0
    width = max(1, -(-(hi - lo + 1) // buckets))
    events = events.withColumn("bucket", F.expr(f"(ts - {lo}L) div {width}L"))
    inside = Window.partitionBy("url", "bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    near = events.withColumn("near", F.max(F.when(F.col("id").isNotNull(), F.struct("ts", "id"))).over(inside))
    tails = events.groupBy("url", "bucket").agg(
        F.max(F.when(F.col("id").isNotNull(), F.struct("ts", "id"))).alias("tail"))
    earlier = Window.partitionBy("url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select("url", "bucket", F.max("tail").over(earlier).alias("carried"))
    return near.where("id is null").join(carried, ["url", "bucket"]).select(
        "url", "ts", F.coalesce("near.id", "carried.id").alias("response_id"))


def resolve_revisits(records: DataFrame, buckets: int = BUCKETS, permitted=PERMITTED) -> DataFrame:
    """One row per revisit of ``records(record_id, type, url, ts, status, headers, payload_digest, payload_bytes)``.

    ``ts`` are seconds as long, ``headers`` a map.  Result: record_id, url, ts,
    outcome, response_id, status, headers (merged), payload_digest, payload_bytes;
    the last four are null unless resolved.
    """
    rows = records.select("record_id", "type", canonical_url(F.col("url")).alias("url"), "ts", "status",
                          _lowered(F.col("headers")).alias("headers"), "payload_digest", "payload_bytes")
    revisits = rows.where("type = 'revisit'")
    full = rows.where("type = 'response' and status between 200 and 299")
    found = last_response_before(revisits.select("url", "ts"), full.select("url", "ts", F.col("record_id").alias("id")),
                                 buckets)
    # written, so that a response that very many revisits refer to is a join side that Spark can split
    stored = written(full.dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("response_id"), F.col("status").alias("s_status"), F.col("headers").alias("s_headers"),
        F.col("payload_digest").alias("s_digest"), F.col("payload_bytes").alias("s_bytes")), "responses")
    both = revisits.join(found, ["url", "ts"], "left").join(stored, "response_id", "left")
    modified = [F.element_at(F.col(h), "last-modified") for h in ("headers", "s_headers")]
    agree = F.coalesce(_tag("headers") == _tag("s_headers"), modified[0] == modified[1],
                       F.col("payload_digest") == F.col("s_digest"))
    outcome = F.when(F.col("response_id").isNull(), "no_earlier").when(agree.isNull(), "no_validator").when(
        agree, "resolved").otherwise("mismatch")
    update = F.map_filter("headers", lambda k, v: k.isin(*permitted) & v.isNotNull())
    keep = F.map_filter("s_headers", lambda k, v: ~F.coalesce(F.map_contains_key(update, k), F.lit(False)))
    ok = F.col("outcome") == "resolved"
    return both.withColumn("outcome", outcome).select(
        "record_id", "url", "ts", "outcome", "response_id", F.when(ok, F.col("s_status")).alias("status"),
        F.when(ok, F.map_concat(keep, update)).alias("headers"), F.when(ok, F.col("s_digest")).alias("payload_digest"),
        F.when(ok, F.col("s_bytes")).alias("payload_bytes"))


def with_payload(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """Add the body of the resolved response from ``payloads(record_id, payload)``."""
    return resolved.join(payloads.select(F.col("record_id").alias("response_id"), "payload"), "response_id", "left") \
        .withColumn("payload", F.when(F.col("outcome") == "resolved", F.col("payload")))


def header_text(headers: Column) -> Column:
    """Headers as ``name: value`` lines in order of the name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)),
                                    lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))), "\n")


def captures_of(pages: DataFrame) -> DataFrame:
    """WARC-like records derived from ``pages(page_id, url, html)``.

    Every page gives a full response at hour ``page_id`` and a revisit of an
    equivalent URL half a day later (for every eleventh page a day earlier,
    before its own response).  Validators: the entity tag (weak on every third page's revisit,
    stale on every fifth, absent on every seventh, where Last-Modified
    stands in; every thirty-fifth has neither).
    """
    i, digest = F.col("page_id"), F.md5(F.coalesce("html", F.lit("")))
    at = i * 3600
    tag = F.concat(F.lit('"'), digest, F.lit('"'))
    modified = F.concat(F.lit("day "), (i % 28).cast("string"))
    full = pages.select(
        (i * 2).alias("record_id"), F.lit("response").alias("type"), "url", at.alias("ts"), F.lit(200).alias("status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), tag, F.lit("Last-Modified"), modified,
                     F.lit("Cache-Control"), F.lit("max-age=60")).alias("headers"),
        digest.alias("payload_digest"), F.coalesce(F.octet_length("html"), F.lit(0)).cast("long").alias("payload_bytes"))
    other = F.concat("url", F.when(F.col("url").contains("#"), "").otherwise("#again"))
    empty = F.create_map().cast("map<string,string>")
    sent = F.when(i % 7 == 0, empty).when(i % 5 == 0, F.create_map(F.lit("etag"), F.lit('"stale"'))).when(
        i % 3 == 0, F.create_map(F.lit("etag"), F.concat(F.lit("W/"), tag))).otherwise(F.create_map(F.lit("etag"), tag))
    dated = F.when((i % 7 == 0) & (i % 5 != 0), F.create_map(F.lit("Last-Modified"), modified)).otherwise(empty)
    again = pages.select(
        (i * 2 + 1).alias("record_id"), F.lit("revisit").alias("type"), other.alias("url"),
        F.when(i % 11 == 0, at - 86400).otherwise(at + 43200).alias("ts"), F.lit(304).alias("status"),
        F.map_concat(F.create_map(F.lit("Cache-Control"), F.lit("max-age=900"), F.lit("Content-Length"), F.lit("0")),
                     sent, dated).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"), F.lit(None).cast("long").alias("payload_bytes"))
    return full.unionByName(again)
