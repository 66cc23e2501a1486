"""DuckDB SQL twins of those training-data queries that SQL can express on whole tables.

The others learn, solve or tokenize (language model, licences, quality rules,
token counts, mixing); their tests compare them with brute-force versions.
"""

from __future__ import annotations

from . import conversation_trie, sharding, warc_revisits

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SQL: dict[str, str] = {}

SQL["op1_substring_dedup"] = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_BLANK}') AS words FROM documents),
wins AS (SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS win
         FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w WHERE len(words) >= 35)),
twice AS (SELECT win FROM wins GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM wins SEMI JOIN twice USING (win)),
every AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM every ANTI JOIN gone USING (doc_id, i)
         GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

SQL["op5_minhash_near_dedup"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_BLANK}') AS words FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
         FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
         GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)),
reach AS (SELECT doc_id, doc_id AS other FROM documents
          UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN sizes USING (doc_id)"""

SQL["op6_sharding"] = f"""
WITH sized AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS address,
                      CAST(strlen(coalesce(text, '')) AS BIGINT) AS doc_bytes FROM documents),
levels AS (SELECT depth, address >> ({sharding.BITS} - depth) AS prefix, sum(doc_bytes) AS b, count(*) AS n
           FROM sized, (SELECT unnest(range(0, {sharding.BITS + 1}))::INT AS depth) GROUP BY ALL),
ends AS (SELECT s.doc_id, s.address, s.doc_bytes, min(l.depth) AS depth
         FROM sized s JOIN levels l ON l.prefix = s.address >> ({sharding.BITS} - l.depth)
         WHERE l.b <= {sharding.SMALL_LIMIT} OR l.n = 1 OR l.depth = {sharding.BITS} GROUP BY ALL)
SELECT doc_id, CASE WHEN e.depth = 0 THEN '' ELSE lpad(bin(l.prefix), e.depth, '0') END AS shard, e.depth, doc_bytes,
       CAST(l.b AS BIGINT) AS shard_bytes, l.n AS shard_docs, l.b > {sharding.SMALL_LIMIT} AS oversized
FROM ends e JOIN levels l ON l.depth = e.depth AND l.prefix = e.address >> ({sharding.BITS} - e.depth)"""

SQL["op9_decontamination"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_ALNUM}') AS words FROM documents),
t AS (SELECT item_id, regexp_extract_all(coalesce({_LOWER}, ''), '{_ALNUM}') AS words FROM benchmark),
tw AS (SELECT DISTINCT item_id, least(len(words), 13) AS k, array_to_string(words[i:i + 12], ' ') AS win
       FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 11, 2))) AS i FROM t WHERE len(words) > 0)),
dw AS (SELECT doc_id, i, k, array_to_string(words[i:i + k - 1], ' ') AS win
       FROM (SELECT doc_id, k, words, unnest(range(1, len(words) - k + 2)) AS i
             FROM d, (SELECT DISTINCT k FROM tw) WHERE len(words) >= k)),
found AS (SELECT doc_id, i, k, item_id FROM dw JOIN tw USING (k, win)),
hit AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS i FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _canonical(url: str) -> str:
    plain = f"regexp_replace(trim({url}), '#.*$', '')"
    part = {i: f"regexp_extract({plain}, '{warc_revisits._URL}', {i})" for i in (1, 2, 3)}
    host = f"lower({part[1]})"
    for pattern in ("^.*@", ":(80|443)$", "^www[0-9]*[.]"):
        host = f"regexp_replace({host}, '{pattern}', '')"
    path = f"regexp_replace({part[2]}, '/+$', '')"
    query = (f"list_sort(list_filter(string_split(substr({part[3]}, 2), '&'), "
             f"lambda p: p <> '' AND NOT regexp_matches(lower(p), '{warc_revisits.TRACKING}')))")
    return (f"CASE WHEN regexp_matches({plain}, '{warc_revisits._URL}') THEN {host} || "
            f"CASE WHEN {path} = '' THEN '/' ELSE {path} END || "
            f"CASE WHEN len({query}) > 0 THEN '?' || array_to_string({query}, '&') ELSE '' END ELSE {plain} END")


SQL["op10_warc_revisits"] = f"""
WITH p AS (SELECT page_id AS i, url, md5(coalesce(html, '')) AS digest, '"' || md5(coalesce(html, '')) || '"' AS tag,
                  'day ' || CAST(page_id % 28 AS VARCHAR) AS modified, CAST(strlen(coalesce(html, '')) AS BIGINT) AS bytes
           FROM pages),
stored AS (SELECT i * 2 AS response_id, {_canonical('url')} AS url, i * 3600 AS ts, digest, tag, modified, bytes FROM p),
asked AS (SELECT i * 2 + 1 AS record_id,
                 {_canonical("CASE WHEN contains(url, '#') THEN url ELSE url || '#again' END")} AS url,
                 CASE WHEN i % 11 = 0 THEN i * 3600 - 86400 ELSE i * 3600 + 43200 END AS ts,
                 CASE WHEN i % 7 = 0 THEN NULL WHEN i % 5 = 0 THEN '"stale"' WHEN i % 3 = 0 THEN 'W/' || tag ELSE tag END AS tag,
                 CASE WHEN i % 7 = 0 AND i % 5 <> 0 THEN modified END AS modified FROM p),
met AS (SELECT a.*, s.response_id, s.tag AS s_tag, s.modified AS s_modified, s.digest, s.bytes,
               coalesce(regexp_replace(a.tag, '^W/', '') = s.tag, a.modified = s.modified) AS agree
        FROM asked a ASOF LEFT JOIN stored s ON a.url = s.url AND a.ts > s.ts),
done AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no_earlier' WHEN agree IS NULL THEN 'no_validator'
                        WHEN agree THEN 'resolved' ELSE 'mismatch' END AS outcome FROM met)
SELECT record_id, url, ts, outcome, response_id, CASE WHEN outcome = 'resolved' THEN 200 END AS status,
       CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=900' || chr(10) || 'content-type: text/html' || chr(10)
            || 'etag: ' || coalesce(tag, s_tag) || chr(10) || 'last-modified: ' || coalesce(modified, s_modified) END AS headers,
       CASE WHEN outcome = 'resolved' THEN digest END AS payload_digest,
       CASE WHEN outcome = 'resolved' THEN bytes END AS payload_bytes
FROM done"""


# CRC-32 of a text, bit by bit: the reflected polynomial is a fixed value.
_CRC32 = ("xor(list_reduce(list_concat([4294967295], range(0, 8 * strlen({s}))), lambda c, i: "
          "CASE WHEN xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr({s}, CAST(i // 8 AS BIGINT) + 1, 1)) ELSE 0 END) % 2 = 1 "
          "THEN xor(xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr({s}, CAST(i // 8 AS BIGINT) + 1, 1)) ELSE 0 END) // 2, 3988292384) "
          "ELSE xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr({s}, CAST(i // 8 AS BIGINT) + 1, 1)) ELSE 0 END) // 2 END), 4294967295)")

SQL["op11_conversation_trie"] = f"""
WITH own AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                                  ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
             FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
kept AS (SELECT *, {_CRC32.format(s="CAST(conv_id AS VARCHAR)")} % 4 AS h FROM own),
rebuilt AS (SELECT k.conv_id, list_concat(coalesce(head.turns, [])[1:h], k.turns[h + 1:]) AS turns
            FROM kept k LEFT JOIN own head ON head.conv_id = k.conv_id - k.conv_id % {conversation_trie.GROUP}),
prefixes AS (SELECT conv_id, depth, turns[1:depth] AS path, depth = len(turns) AS ends
             FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ids
          FROM prefixes GROUP BY path, depth),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (SELECT nodes.path, nodes.depth, CASE WHEN children.n IS NULL THEN 1 ELSE 0 END AS leaf,
                  (n_convs - 1) * CASE WHEN nodes.depth = 0 THEN 0
                                  ELSE len(regexp_extract_all(nodes.path[nodes.depth].text, '{_BLANK}')) END AS saved
           FROM nodes LEFT JOIN children USING (path)),
totals AS (SELECT path[1:d] AS path, sum(leaf) AS leaves, sum(saved) AS saved
           FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM valued) GROUP BY 1)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, x.n_convs,
       coalesce(children.n, 0) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(x.ids) AS ends_sha256
FROM nodes x JOIN totals USING (path) LEFT JOIN children USING (path)
LEFT JOIN nodes up ON x.depth > 0 AND up.depth = x.depth - 1 AND up.path = x.path[1:x.depth - 1]"""

SQL["op12_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
                  CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS s
           FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (SELECT a, b, s FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
met AS (SELECT p.a, p.b, p.s, n.b AS nb, n.s AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) AS rank
        FROM positive p JOIN scored n ON n.a = p.a AND NOT n.same AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s)
SELECT a AS anchor_id, b AS positive_id, CAST(rank AS INT) AS rank, nb AS negative_id, s AS positive_score, ns AS negative_score
FROM met WHERE rank <= 5"""
