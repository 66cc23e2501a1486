"""DuckDB SQL twin of every registered query (the correctness oracle).

The oracle only sees the raw test-data tables, so each statement inlines the
fixture views as CTEs.  Doubles are rounded the same way on both sides, and
every ranking ends with an id so the order is total.
"""

from __future__ import annotations

from ..streaming import batching
from . import params as P

FIXTURES = r"""
ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS movie_id,
         CAST((CAST(l_quantity AS INT) - 1) % 10 + 1 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS rating,
         CAST(epoch(l_shipdate) AS BIGINT) AS timestamp
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
movies_raw AS (
  SELECT p_partkey AS movie_id,
         CASE WHEN p_partkey % 50 = 0 THEN p_name
              ELSE concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR), ')') END AS title,
         CASE WHEN p_partkey % 3 = 0 THEN concat(p_type, '|', replace(p_brand, '#', ''), '|', split_part(p_name, ' ', 1))
              WHEN p_partkey % 3 = 1 THEN concat(p_type, '|', replace(p_brand, '#', ''))
              ELSE p_type END AS genres
  FROM part
  UNION ALL
  SELECT 1000000000000 + s_suppkey, concat(s_name, ' (1999)'), 'SUPPLIED' FROM supplier),
movies AS (
  SELECT movie_id, title, string_split(genres, '|') AS genres,
         CAST(nullif(regexp_extract(title, '\((\d{4})\)', 1), '') AS DOUBLE) AS year,
         trim(regexp_replace(title, '\((\d{4})\)', '', 'g')) AS title_clean
  FROM movies_raw),
users AS (
  SELECT c_custkey AS user_id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(18 + c_custkey % 50 AS INT) AS age, CAST(c_nationkey % 21 AS INT) AS occupation,
         CAST(10000 + c_custkey % 90000 AS VARCHAR) AS zip_code
  FROM (SELECT c_custkey, c_nationkey FROM customer
        UNION ALL SELECT 1000000000000 + s_suppkey, s_nationkey FROM supplier)),
rating_events AS (
  SELECT event_id, user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) * 25 AS movie_id,
         value / 10 AS rating, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp
  FROM events),
latest AS (
  SELECT movie_id, user_id, max_by(rating, (timestamp, rating)) AS rating, max(timestamp) AS timestamp
  FROM ratings GROUP BY movie_id, user_id),
stats AS (
  SELECT movie_id, count(rating) AS rating_count, avg(rating) AS rating_mean, max(timestamp) AS last_rated
  FROM ratings GROUP BY movie_id),
pop AS (
  SELECT movie_id, rating_count, rating_mean, last_rated,
         1.0 / (1.0 + ln(1.0 + ((SELECT max(timestamp) FROM ratings) - last_rated) / 86400.0)) AS time_weight,
         rating_count * rating_mean
           * (1.0 / (1.0 + ln(1.0 + ((SELECT max(timestamp) FROM ratings) - last_rated) / 86400.0))) AS popularity_score
  FROM stats)
"""


def q(body: str) -> str:
    """Prefix the fixture CTEs; a body starting with ',' adds more CTEs."""
    return "WITH " + FIXTURES.strip() + "\n" + body.strip()


def _lst(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


SQL: dict[str, str] = {}

SQL["scan_ratings"] = q("SELECT user_id, movie_id, rating, timestamp FROM ratings")
SQL["scan_movies"] = q("SELECT movie_id, title, genres FROM movies_raw")
SQL["scan_users"] = q("SELECT * FROM users")
SQL["prep_movies"] = q("SELECT movie_id, title, genres, year, title_clean FROM movies")
SQL["item_info"] = q("SELECT movie_id, title, array_to_string(genres, '|') AS genres, year FROM movies")
SQL["item_ids"] = q("SELECT movie_id FROM movies")
SQL["genre_vocabulary"] = q("SELECT DISTINCT unnest(genres) AS genre FROM movies")
SQL["genre_multi_hot"] = q("""
, vocab AS (SELECT DISTINCT unnest(genres) AS genre FROM movies)
SELECT m.movie_id, v.genre, CAST(list_contains(m.genres, v.genre) AS INT) AS flag
FROM movies m, vocab v""")
SQL["latest_ratings"] = q("SELECT movie_id, user_id, rating, timestamp FROM latest")
SQL["rating_stats"] = q("SELECT movie_id, rating_count, round(rating_mean, 6) AS rating_mean, last_rated FROM stats")
SQL["time_decay"] = q("SELECT movie_id, last_rated, round(time_weight, 9) AS time_weight FROM pop")
SQL["popularity_scores"] = q("""
SELECT movie_id, rating_count, round(rating_mean, 6) AS rating_mean, last_rated,
       round(time_weight, 9) AS time_weight, round(popularity_score, 6) AS popularity_score FROM pop""")
SQL["movie_stats"] = q("SELECT movie_id, count(rating) AS rating_count, round(avg(rating), 6) AS rating_mean FROM ratings GROUP BY movie_id")
SQL["popularity_share"] = q("""
SELECT movie_id, count(*) AS rating_count, round(count(*) / (SELECT count(*) FROM ratings), 9) AS share
FROM ratings GROUP BY movie_id""")
SQL["active_users"] = q(f"""
SELECT user_id, count(*) AS rating_count FROM ratings GROUP BY user_id HAVING count(*) >= {P.MIN_RATINGS}""")
SQL["top_popular"] = q(f"""
SELECT CAST(row_number() OVER (ORDER BY p.popularity_score DESC, p.movie_id) AS INTEGER) AS rank, p.movie_id, m.title,
       array_to_string(m.genres, '|') AS genres, m.year, round(p.popularity_score, 6) AS popularity_score
FROM (SELECT * FROM pop ORDER BY popularity_score DESC, movie_id LIMIT {P.TOP_N}) p
LEFT JOIN movies m USING (movie_id)""")
_genre_rec_base = f"""
, cand AS (
  SELECT m.movie_id, m.title, m.genres, m.year, s.rating_count, s.rating_mean,
         coalesce(p.popularity_score, 0.0) AS popularity_score
  FROM movies m JOIN stats s USING (movie_id) LEFT JOIN pop p USING (movie_id)
  WHERE len(list_intersect(m.genres, {_lst(P.GENRE_LIST)})) > 0)"""
SQL["genre_recommendations"] = q(_genre_rec_base + f"""
SELECT CAST(row_number() OVER (ORDER BY popularity_score DESC, rating_count DESC, rating_mean DESC, movie_id) AS INTEGER) AS rank,
       movie_id, title, array_to_string(genres, '|') AS genres, year, rating_count,
       round(rating_mean, 6) AS rating_mean, round(popularity_score, 6) AS popularity_score
FROM cand ORDER BY rank LIMIT {P.GENRE_N}""")
SQL["genre_recommendations_by_count"] = q(_genre_rec_base + f"""
SELECT CAST(row_number() OVER (ORDER BY rating_count DESC, rating_mean DESC, movie_id) AS INTEGER) AS rank,
       movie_id, title, array_to_string(genres, '|') AS genres, year, rating_count,
       round(rating_mean, 6) AS rating_mean
FROM cand ORDER BY rank LIMIT {P.GENRE_N}""")
SQL["rating_matrix_slice"] = q(
    "SELECT movie_id, " + ", ".join(
        f"CAST(coalesce(max(CASE WHEN user_id = {u} THEN rating END), 0) AS DOUBLE) AS u{u}"
        for u in P.SLICE_USERS) + " FROM latest GROUP BY movie_id")
SQL["rating_matrix"] = q(f"""
SELECT movie_id, user_id // {P.MATRIX_BLOCK} AS user_block,
       string_agg(user_id || ':' || rating, ',' ORDER BY user_id) AS cells
FROM latest GROUP BY ALL""")
SQL["normalized_ratings"] = q("""
, scale AS (
  SELECT user_id, s1 / m AS mean,
         CASE WHEN sqrt(greatest(s2 / m - (s1 / m) * (s1 / m), 0.0)) = 0 THEN 1.0
              ELSE sqrt(greatest(s2 / m - (s1 / m) * (s1 / m), 0.0)) END AS sd
  FROM (SELECT user_id, sum(rating) AS s1, sum(rating * rating) AS s2,
               (SELECT count(DISTINCT movie_id) FROM latest) AS m
        FROM latest GROUP BY user_id))
SELECT l.movie_id, l.user_id, l.rating, round((l.rating - s.mean) / s.sd, 6) AS z,
       round(l.rating / s.sd, 6) AS w
FROM latest l JOIN scale s USING (user_id)""")
SQL["search_genre"] = q(f"""
SELECT movie_id, title, array_to_string(genres, '|') AS genres, year FROM movies
WHERE len(list_filter(genres, lambda g: lower(g) = lower('{P.SEARCH_GENRE}'))) > 0""")
SQL["search_year"] = q(f"""
SELECT movie_id, title, array_to_string(genres, '|') AS genres, year FROM movies WHERE year = {P.SEARCH_YEAR}""")
SQL["search_year_range"] = q(f"""
SELECT movie_id, title, array_to_string(genres, '|') AS genres, year FROM movies
WHERE year BETWEEN {P.SEARCH_YEAR_RANGE[0]} AND {P.SEARCH_YEAR_RANGE[1]}""")
SQL["system_status"] = q(f"""
SELECT (SELECT count(*) FROM ratings) AS total_ratings,
       (SELECT count(DISTINCT user_id) FROM ratings) AS total_users,
       (SELECT count(*) FROM movies) AS total_movies,
       (SELECT count(*) FROM rating_events e
         WHERE e.event_id IS NOT NULL AND e.user_id IS NOT NULL AND e.movie_id IS NOT NULL
           AND e.timestamp IS NOT NULL AND NOT isnan(e.rating)
           AND e.rating BETWEEN {P.RATING_MIN} AND {P.RATING_MAX}
           AND e.movie_id IN (SELECT movie_id FROM movies)) AS batch_queue_size,
       (SELECT count(*) FROM (SELECT user_id FROM ratings GROUP BY user_id HAVING count(*) >= {P.MIN_RATINGS})) AS cache_size,
       false AS is_updating, '{P.CACHE_NOW}' AS last_update_time""")


# --- similarity -----------------------------------------------------------------

SCALE_CTE = """
, scale AS (
  SELECT user_id, s1 / m AS mean,
         CASE WHEN sqrt(greatest(s2 / m - (s1 / m) * (s1 / m), 0.0)) = 0 THEN 1.0
              ELSE sqrt(greatest(s2 / m - (s1 / m) * (s1 / m), 0.0)) END AS sd
  FROM (SELECT user_id, sum(rating) AS s1, sum(rating * rating) AS s2,
               (SELECT count(DISTINCT movie_id) FROM latest) AS m
        FROM latest GROUP BY user_id))"""

TFIDF_CTES = """
, docs AS (SELECT movie_id, title_clean || ' ' || array_to_string(genres, ' ') AS doc FROM movies)
, toks AS (SELECT movie_id, unnest(regexp_extract_all(lower(doc), '[a-z0-9_]{2,}')) AS term FROM docs)
, tf AS (SELECT movie_id, term, count(*) AS tf FROM toks GROUP BY movie_id, term)
, dfreq AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
, wraw AS (SELECT tf.movie_id, tf.term,
                  tf.tf * (ln((1.0 + (SELECT count(*) FROM movies)) / (1.0 + dfreq.df)) + 1.0) AS w
           FROM tf JOIN dfreq USING (term))
, tfidf AS (SELECT movie_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY movie_id)) AS weight FROM wraw)"""

CONTENT_CTES = TFIDF_CTES + f"""
, csim AS (SELECT a.movie_id, b.movie_id AS neighbor_id, round(sum(a.weight * b.weight), 9) AS similarity
           FROM tfidf a JOIN tfidf b USING (term) WHERE a.movie_id <> b.movie_id
           GROUP BY a.movie_id, b.movie_id)
, content AS (
  SELECT * FROM (
    SELECT movie_id, CAST(row_number() OVER (PARTITION BY movie_id ORDER BY similarity DESC, neighbor_id) AS INTEGER) AS rank,
           neighbor_id, similarity FROM csim WHERE similarity > 0)
  WHERE rank <= {P.NEIGHBORS})"""

def cf_ctes(src: str = "latest", p: str = "") -> str:
    """Exact CF neighbours over the matrix ``src`` (CTE names prefixed by ``p``).

    Pruned candidates: co-rated pairs plus the k+1 globally smallest norms
    (a pair sharing no rater has distance n_i + n_j).
    """
    return f"""
, {p}scale AS (
  SELECT user_id, s1 / m AS mean,
         CASE WHEN sqrt(greatest(s2 / m - (s1 / m) * (s1 / m), 0.0)) = 0 THEN 1.0
              ELSE sqrt(greatest(s2 / m - (s1 / m) * (s1 / m), 0.0)) END AS sd
  FROM (SELECT user_id, sum(rating) AS s1, sum(rating * rating) AS s2,
               (SELECT count(DISTINCT movie_id) FROM {src}) AS m
        FROM {src} GROUP BY user_id))
, {p}wv AS (SELECT movie_id, user_id, rating / sd AS w FROM {src} JOIN {p}scale USING (user_id))
, {p}norms AS (SELECT movie_id, sum(w * w) AS n FROM {p}wv GROUP BY movie_id)
, {p}dots AS (SELECT a.movie_id AS i, b.movie_id AS j, sum(a.w * b.w) AS dot
              FROM {p}wv a JOIN {p}wv b USING (user_id) WHERE a.movie_id <> b.movie_id
              GROUP BY a.movie_id, b.movie_id)
, {p}lownorm AS (SELECT movie_id AS j FROM {p}norms ORDER BY n, movie_id LIMIT {P.NEIGHBORS + 1})
, {p}cand AS (SELECT i, j, dot FROM {p}dots
              UNION ALL SELECT n1.movie_id AS i, g.j, 0.0 AS dot FROM {p}norms n1 JOIN {p}lownorm g ON n1.movie_id <> g.j)
, {p}cagg AS (SELECT i, j, sum(dot) AS dot FROM {p}cand GROUP BY i, j)
, {p}cdist AS (SELECT c.i AS movie_id, c.j AS neighbor_id, round(ni.n + nj.n - 2 * c.dot, 6) AS distance
               FROM {p}cagg c JOIN {p}norms ni ON ni.movie_id = c.i JOIN {p}norms nj ON nj.movie_id = c.j)
, {p}cf AS (
  SELECT * FROM (
    SELECT movie_id, CAST(row_number() OVER (PARTITION BY movie_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank,
           neighbor_id, distance FROM {p}cdist)
  WHERE rank <= {P.NEIGHBORS})"""


CF_CTES = cf_ctes()

SIMILAR_CTES = CF_CTES + CONTENT_CTES + f"""
, hboth AS (SELECT movie_id, neighbor_id, rank AS cf_rank, CAST(NULL AS BIGINT) AS content_rank FROM cf
            UNION ALL
            SELECT movie_id, neighbor_id, NULL, rank FROM content
            WHERE movie_id IN (SELECT movie_id FROM latest))
, hmerged AS (SELECT movie_id, neighbor_id, min(cf_rank) AS cf_rank, min(content_rank) AS content_rank
              FROM hboth GROUP BY movie_id, neighbor_id)
, hyb AS (
  SELECT * FROM (
    SELECT movie_id, neighbor_id,
           CAST(row_number() OVER (PARTITION BY movie_id ORDER BY least(cf_rank, content_rank),
             CASE WHEN cf_rank = least(cf_rank, content_rank) THEN 0 ELSE 1 END, neighbor_id) AS INTEGER) AS rank
    FROM hmerged)
  WHERE rank <= {P.NEIGHBORS})
, simitems AS (
  SELECT h.movie_id, h.rank, h.neighbor_id, m.title, array_to_string(m.genres, '|') AS genres, m.year
  FROM hyb h LEFT JOIN movies m ON m.movie_id = h.neighbor_id)"""

SQL["tfidf_vectors"] = q(TFIDF_CTES + "\nSELECT movie_id, term, round(weight, 9) AS weight FROM tfidf")
SQL["content_neighbors"] = q(CONTENT_CTES + "\nSELECT movie_id, rank, neighbor_id, similarity FROM content")
SQL["cf_neighbors"] = q(CF_CTES + "\nSELECT movie_id, rank, neighbor_id, distance FROM cf")
SQL["similar_items"] = q(SIMILAR_CTES + "\nSELECT * FROM simitems")


# --- recommendations ------------------------------------------------------------

SEEDS_CTE = f"""
, seeds AS (
  SELECT * FROM (
    SELECT user_id, movie_id, rating,
           row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, timestamp DESC, movie_id) AS seed_rank
    FROM latest)
  WHERE seed_rank <= {P.SEEDS})"""


def user_recs_cte(name: str, n: int, seed_filter: str = "") -> str:
    """CTEs computing R4 lists of length n into ``name`` (needs SIMILAR_CTES, SEEDS_CTE)."""
    return f"""
, {name}_cand AS (SELECT s.user_id, h.neighbor_id AS movie_id, s.seed_rank * 1000 + h.rank AS pos
                  FROM seeds s JOIN hyb h ON h.movie_id = s.movie_id {seed_filter})
, {name}_fresh AS (SELECT * FROM {name}_cand c
                   WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.user_id = c.user_id AND l.movie_id = c.movie_id))
, {name}_first AS (SELECT user_id, movie_id, min(pos) AS pos FROM {name}_fresh GROUP BY user_id, movie_id)
, {name} AS (
  SELECT * FROM (
    SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY pos, movie_id) AS INTEGER) AS rank,
           movie_id FROM {name}_first)
  WHERE rank <= {n})"""


def popular_cte(name: str, n: int) -> str:
    return f"""
, {name} AS (SELECT CAST(row_number() OVER (ORDER BY popularity_score DESC, movie_id) AS INTEGER) AS rank, movie_id
             FROM (SELECT * FROM pop ORDER BY popularity_score DESC, movie_id LIMIT {n}))"""


REC_CTES = SIMILAR_CTES + SEEDS_CTE + user_recs_cte("urecs", P.REC_N)

SQL["user_top_rated"] = q(SEEDS_CTE + "\nSELECT user_id, CAST(seed_rank AS INTEGER) AS seed_rank, movie_id, rating FROM seeds")
SQL["user_recommendations"] = q(REC_CTES + "\nSELECT user_id, rank, movie_id FROM urecs")
SQL["user_recommendations_by_seed"] = SQL["user_recommendations"]
SQL["cold_start_recommendations"] = q(popular_cte("poplist", P.REC_N) + """
SELECT u.user_id, p.rank, p.movie_id FROM users u CROSS JOIN poplist p
WHERE u.user_id NOT IN (SELECT user_id FROM ratings)""")
SQL["recommendations_with_fallback"] = q(
    REC_CTES + popular_cte("pop_cold", P.REC_N) + popular_cte("pop_empty", P.FALLBACK_N) + """
, everyone AS (SELECT user_id FROM users UNION SELECT user_id FROM ratings)
SELECT user_id, rank, movie_id, 'personal' AS source FROM urecs
UNION ALL
SELECT e.user_id, p.rank, p.movie_id, 'cold_start' FROM everyone e CROSS JOIN pop_cold p
WHERE e.user_id NOT IN (SELECT user_id FROM ratings)
UNION ALL
SELECT e.user_id, p.rank, p.movie_id, 'popular' FROM everyone e CROSS JOIN pop_empty p
WHERE e.user_id IN (SELECT user_id FROM ratings) AND e.user_id NOT IN (SELECT user_id FROM urecs)""")
SQL["cached_recommendations"] = q(REC_CTES + """
SELECT user_id, rank, movie_id, user_id % 2 = 0 AS from_cache FROM urecs""")


# --- evaluation -------------------------------------------------------------------

FOLD_CTES = f"""
, active AS (SELECT user_id FROM ratings GROUP BY user_id HAVING count(*) >= {P.MIN_RATINGS})
, folds AS (SELECT user_id,
                   CAST(ntile({P.EVAL_FOLDS}) OVER (ORDER BY md5(CAST(user_id AS VARCHAR) || ':{P.FOLD_SALT}'), user_id)
                        AS INTEGER) AS fold
            FROM active)"""

EVAL_CTES = FOLD_CTES + SIMILAR_CTES + SEEDS_CTE + user_recs_cte(
    "erecs", P.EVAL_K, "WHERE s.user_id IN (SELECT user_id FROM active)") + f"""
, gsets AS (SELECT movie_id, list_distinct(genres) AS gset FROM movies)
, eitems AS (SELECT r.user_id, r.rank, coalesce(g.gset, CAST([] AS VARCHAR[])) AS gset
             FROM erecs r LEFT JOIN gsets g USING (movie_id))
, epairs AS (SELECT a.user_id, len(list_intersect(a.gset, b.gset)) AS inter,
                    len(list_distinct(list_concat(a.gset, b.gset))) AS uni
             FROM eitems a JOIN eitems b ON a.user_id = b.user_id AND a.rank < b.rank)
, udiv AS (SELECT user_id, avg(1.0 - inter / uni) AS diversity FROM epairs WHERE uni > 0 GROUP BY user_id)
, shares AS (SELECT movie_id, count(*) / (SELECT count(*) FROM ratings) AS share FROM ratings GROUP BY movie_id)
, unov AS (SELECT r.user_id, avg(CASE WHEN s.share > 0 THEN -log2(s.share) ELSE 0.0 END) AS novelty
           FROM erecs r LEFT JOIN shares s USING (movie_id) GROUP BY r.user_id)
, umetrics AS (SELECT f.user_id, f.fold, coalesce(d.diversity, 0.0) AS diversity, coalesce(n.novelty, 0.0) AS novelty
               FROM folds f LEFT JOIN udiv d USING (user_id) LEFT JOIN unov n USING (user_id))
, fcov AS (SELECT f.fold, count(DISTINCT r.movie_id) / (SELECT count(*) FROM movies) AS coverage
           FROM folds f LEFT JOIN erecs r USING (user_id) GROUP BY f.fold)
, fmetrics AS (SELECT c.fold, c.coverage, m.diversity, m.novelty
               FROM fcov c JOIN (SELECT fold, avg(diversity) AS diversity, avg(novelty) AS novelty
                                 FROM umetrics GROUP BY fold) m USING (fold))
, summary AS (SELECT metric, avg(v) AS mean, stddev_pop(v) AS std
              FROM (SELECT 'coverage' AS metric, coverage AS v FROM fmetrics
                    UNION ALL SELECT 'diversity', diversity FROM fmetrics
                    UNION ALL SELECT 'novelty', novelty FROM fmetrics)
              GROUP BY metric)"""

SQL["eval_folds"] = q(FOLD_CTES + "\nSELECT user_id, fold FROM folds")
SQL["eval_coverage"] = q(EVAL_CTES + "\nSELECT fold, round(coverage, 6) AS coverage FROM fcov")
SQL["eval_diversity"] = q(EVAL_CTES + "\nSELECT user_id, fold, round(diversity, 6) AS diversity FROM umetrics")
SQL["eval_novelty"] = q(EVAL_CTES + "\nSELECT user_id, fold, round(novelty, 6) AS novelty FROM umetrics")
SQL["evaluate"] = q(EVAL_CTES + f"""
SELECT metric, round(mean, 6) AS mean, round(std, 6) AS std,
       round(mean - 1.96 * std / sqrt({P.EVAL_FOLDS}), 6) AS ci_lower,
       round(mean + 1.96 * std / sqrt({P.EVAL_FOLDS}), 6) AS ci_upper
FROM summary""")


# --- validation, merges, streaming --------------------------------------------------

CHECK_CTES = f"""
, checked AS (
  SELECT event_id, user_id, movie_id, rating, timestamp,
         CASE WHEN user_id IS NULL THEN 'no_user_id'
              WHEN movie_id IS NULL THEN 'no_movie_id'
              WHEN rating IS NULL THEN 'no_rating'
              WHEN timestamp IS NULL THEN 'no_timestamp'
              WHEN isnan(rating) THEN 'rating_not_a_number'
              WHEN NOT (rating BETWEEN {P.RATING_MIN} AND {P.RATING_MAX}) THEN 'rating_outside_scale' END AS reject_reason
  FROM rating_events)
, valid AS (SELECT event_id, user_id, movie_id, rating, timestamp FROM checked WHERE reject_reason IS NULL)
, valid_new AS (SELECT * FROM valid WHERE movie_id IN (SELECT movie_id FROM movies))
, merged_facts AS (SELECT user_id, movie_id, rating, timestamp FROM ratings
                   UNION ALL SELECT user_id, movie_id, rating, timestamp FROM valid_new)
, merged_latest AS (SELECT movie_id, user_id, max_by(rating, (timestamp, rating)) AS rating, max(timestamp) AS timestamp
                    FROM merged_facts GROUP BY movie_id, user_id)
, mstats AS (SELECT movie_id, count(rating) AS rating_count, sum(rating) AS s, max(timestamp) AS last_rated
             FROM merged_facts GROUP BY movie_id)"""

SQL["validate_ratings"] = q(CHECK_CTES + "\nSELECT * FROM valid")
SQL["rejected_ratings"] = q(CHECK_CTES + "\nSELECT * FROM checked WHERE reject_reason IS NOT NULL")
SQL["valid_new_ratings"] = q(CHECK_CTES + "\nSELECT * FROM valid_new")
SQL["merge_ratings_latest"] = q(CHECK_CTES + "\nSELECT * FROM merged_latest")
SQL["merge_ratings_sum"] = q(CHECK_CTES + """
, batch AS (SELECT movie_id, user_id, avg(rating) AS rating FROM valid_new GROUP BY movie_id, user_id)
SELECT movie_id, user_id, round(sum(rating), 6) AS rating
FROM (SELECT movie_id, user_id, rating FROM latest UNION ALL SELECT movie_id, user_id, rating FROM batch)
GROUP BY movie_id, user_id""")
SQL["stream_valid_ratings"] = SQL["valid_new_ratings"]
SQL["stream_merge_latest"] = SQL["merge_ratings_latest"]
SQL["stream_refresh_popularity"] = q(CHECK_CTES + """
SELECT movie_id, rating_count, round(s / rating_count, 6) AS rating_mean, last_rated,
       round(rating_count * (s / rating_count)
             * (1.0 / (1.0 + ln(1.0 + ((SELECT max(last_rated) FROM mstats) - last_rated) / 86400.0))), 6)
         AS popularity_score
FROM mstats""")


# --- fuzzy title search ---------------------------------------------------------------

def _sorted_tokens_sql(expr: str) -> str:
    return (f"array_to_string(list_sort(list_filter(string_split_regex(trim(regexp_replace(lower({expr}), "
            f"'[^\\p{{L}}\\p{{N}}]', ' ', 'g')), ' +'), lambda t: t <> '')), ' ')")


def _lcs_sql(a: str, b: str) -> str:
    """LCS length by a nested fold: rows over chars of a, cells over chars of b (1-based)."""
    n = f"length({b})"
    zeros = f"list_transform(range(0, {n} + 1), lambda x: 0)"
    inner = (f"list_reduce(range(1, {n} + 1), lambda acc, j: list_append(acc, "
             f"CASE WHEN ca = substring({b}, j, 1) THEN prev[j] + 1 ELSE greatest(prev[j + 1], acc[j]) END), [0])")
    return (f"CASE WHEN length({a}) = 0 OR {n} = 0 THEN 0 ELSE "
            f"list_reduce(string_split({a}, ''), lambda prev, ca: {inner}, {zeros})[{n} + 1] END")


def title_scores_cte(query: str) -> str:
    qs = query.replace("'", "''")
    return f"""
, tsort AS (SELECT movie_id, title, genres, year, {_sorted_tokens_sql('title')} AS a,
                   {_sorted_tokens_sql(f"'{qs}'")} AS b FROM movies)
, tscore AS (SELECT movie_id, title, genres, year,
                    CASE WHEN length(a) + length(b) = 0 THEN 0
                         ELSE CAST(round(200.0 * ({_lcs_sql('a', 'b')}) / (length(a) + length(b))) AS INTEGER) END
                      AS score
             FROM tsort)"""


SQL["search_title"] = q(title_scores_cte(P.TITLE_QUERY) + f"""
SELECT CAST(row_number() OVER (ORDER BY score DESC, movie_id) AS INTEGER) AS rank, movie_id, title, score
FROM (SELECT * FROM tscore ORDER BY score DESC, movie_id LIMIT {P.TITLE_LIMIT})""")
SQL["search_advanced"] = q(title_scores_cte(P.TITLE_QUERY) + f"""
, top50 AS (SELECT * FROM tscore ORDER BY score DESC, movie_id LIMIT {P.ADVANCED_TITLE_LIMIT})
, known AS (SELECT count(*) > 0 AS k FROM movies
            WHERE len(list_filter(genres, lambda g: lower(g) = lower('{P.ADVANCED_GENRE}'))) > 0)
SELECT movie_id, title, array_to_string(genres, '|') AS genres, year, score FROM top50
WHERE (NOT (SELECT k FROM known) OR len(list_filter(genres, lambda g: lower(g) = lower('{P.ADVANCED_GENRE}'))) > 0)
  AND year BETWEEN {P.ADVANCED_YEARS[0]} AND {P.ADVANCED_YEARS[1]}""")


SQL["model_roundtrip"] = q(SCALE_CTE + """
SELECT l.movie_id, l.user_id, l.rating, round(l.rating / s.sd, 6) AS w
FROM latest l JOIN scale s USING (user_id)""")


SQL["stream_batches"] = q(CHECK_CTES + f"""
SELECT {P.STREAM_FILES}::BIGINT AS batches, (SELECT count(*) FROM events) AS input_rows,
       (SELECT count(*) FROM valid_new) AS valid_rows""")
SQL["stream_merge_batches"] = SQL["merge_ratings_latest"]
SQL["stream_popularity_batches"] = SQL["stream_refresh_popularity"]
SQL["stream_model_tail"] = q(CHECK_CTES + "\nSELECT movie_id, user_id, rating FROM merged_latest")
SQL["stamp_new_ratings"] = q(f"""
SELECT event_id, user_id, movie_id, round(rating, 6) AS rating,
       CASE WHEN event_id % 2 = 0 THEN timestamp ELSE {P.CACHE_NOW} END AS timestamp
FROM rating_events""")
SQL["model_recommendations"] = SQL["user_recommendations"]
SQL["cache_second_call"] = q(REC_CTES + popular_cte("poplist", P.REC_N) + """
SELECT user_id, rank, movie_id, true AS from_cache FROM urecs
UNION ALL
SELECT u.user_id, p.rank, p.movie_id, true FROM users u CROSS JOIN poplist p
WHERE u.user_id NOT IN (SELECT user_id FROM ratings)""")


# One file source, availableNow, no per-trigger cap: every event arrives in batch 0.
SQL["stream_progress"] = "SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS num_input_rows FROM events"


SQL["stream_model_refresh"] = q(CHECK_CTES + cf_ctes("merged_latest", "m") + "\nSELECT movie_id, rank, neighbor_id, distance FROM mcf")


SQL["stream_distinct_counts"] = q(CHECK_CTES + """
SELECT count(*) AS total_ratings, count(DISTINCT user_id) AS rating_users, count(DISTINCT movie_id) AS rated_movies
FROM merged_facts""")
SQL["ann_recall"] = q(f"""
SELECT true AS recall_reached, n * least({P.NEIGHBORS}, n - 1) AS exact_neighbors
FROM (SELECT count(DISTINCT movie_id) AS n FROM ratings)""")
SQL["stream_source_ratings"] = SQL["valid_new_ratings"]
SQL["stream_size_or_time"] = f"""
WITH lanes AS (SELECT CAST(event_id % {batching.LANES} AS BIGINT) AS lane, count(*) AS n FROM events GROUP BY 1)
SELECT lane, batch, CASE WHEN (batch + 1) * {batching.SIZE} <= n THEN 'size' ELSE 'time' END AS set_off_by,
       least({batching.SIZE}, n - batch * {batching.SIZE}) AS events
FROM (SELECT lane, n, unnest(range(0, (n + {batching.SIZE} - 1) // {batching.SIZE})) AS batch FROM lanes)"""
SQL["stream_updated_neighbors"] = SQL["stream_model_refresh"]


SQL["embedding_neighbors"] = q(f"""
, ev AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(len(embedding))) AS j
         FROM embeddings)
, ed AS (SELECT a.vec_id, b.vec_id AS neighbor_id, round(sum((a.v - b.v) * (a.v - b.v)), 6) AS distance
         FROM ev a JOIN ev b ON a.j = b.j AND a.vec_id <> b.vec_id GROUP BY a.vec_id, b.vec_id)
SELECT * FROM (
  SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank,
         neighbor_id, distance FROM ed)
WHERE rank <= {P.NEIGHBORS}""")


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
