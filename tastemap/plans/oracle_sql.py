"""DuckDB reference SQL for the registered queries.

Every oracle starts from the same view definitions as ``sources.views`` (as CTEs,
since only the driver tables are registered in DuckDB) and states the query the
plain way: joins first, then grouping, exactly as the exploration SQL reads.
"""

from __future__ import annotations

VIEWS = """
WITH ratings AS (
  SELECT o_custkey AS userId, l_partkey AS movieId,
         max(ceil(l_quantity / 5) * CAST(0.5 AS double)) AS rating, max(o_orderdate) AS ts
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY o_custkey, l_partkey),
movies AS (
  SELECT p_partkey AS movieId, concat(p_name, ' (', p_brand, ')') AS title,
         CASE WHEN p_size = 50 THEN '(no genres listed)'
              ELSE concat(replace(p_name, ' ', '|'), '|', p_type) END AS genres
  FROM part),
tags AS (
  SELECT user_id AS userId, CAST(regexp_extract(props, '[0-9]+', 0) AS bigint) AS movieId,
         event_type AS tag, ts
  FROM events),
links AS (
  SELECT l_partkey AS movieId, CAST(min(l_suppkey) AS varchar(20)) AS imdbId,
         CAST(max(l_suppkey) AS varchar(20)) AS tmdbId
  FROM lineitem GROUP BY l_partkey),
event_ratings AS (
  SELECT userId, movieId, least(0.5 * count(*), 5.0) AS rating, max(ts) AS ts FROM tags GROUP BY ALL),
per_item AS (
  SELECT movieId, count(rating) AS n_ratings, sum(rating) AS total FROM ratings GROUP BY movieId)
"""


def _q(body: str) -> str:
    return VIEWS + body


ORACLES: dict[str, str] = {}

ORACLES["min_ratings_per_key"] = _q("""
SELECT 'min_ratings_per_user' AS stat, min(c) AS value
FROM (SELECT userId, count(*) AS c FROM ratings GROUP BY userId)
UNION ALL
SELECT 'min_ratings_per_item' AS stat, min(c) AS value
FROM (SELECT movieId, count(*) AS c FROM ratings GROUP BY movieId)
""")

ORACLES["items_rated_once"] = _q("""
SELECT count(*) FILTER (WHERE n = 1) AS items_rated_once, count(*) AS rated_items
FROM (SELECT count(*) AS n FROM ratings GROUP BY movieId)
""")

ORACLES["user_count"] = _q("""
SELECT count(*) AS user_count
FROM (SELECT userId FROM ratings UNION SELECT userId FROM tags) WHERE userId IS NOT NULL
""")

ORACLES["item_count"] = _q("""
SELECT count(*) AS item_count
FROM (SELECT movieId FROM movies UNION SELECT movieId FROM ratings UNION SELECT movieId FROM links
      UNION SELECT movieId FROM tags) WHERE movieId IS NOT NULL
""")

ORACLES["rated_item_counts"] = _q("""
, known AS (
  SELECT movieId, bool_or(m) AS m, bool_or(r) AS r
  FROM (SELECT movieId, true AS m, false AS r FROM movies
        UNION ALL SELECT movieId, false, true FROM event_ratings
        UNION ALL SELECT movieId, false, false FROM links
        UNION ALL SELECT movieId, false, false FROM tags)
  WHERE movieId IS NOT NULL GROUP BY movieId)
SELECT count(*) AS item_count, count(*) FILTER (WHERE m AND r) AS rated_item_count,
       count(*) FILTER (WHERE NOT (m AND r)) AS unrated_item_count
FROM known
""")

ORACLES["unrated_items"] = _q("""
SELECT m.* FROM movies AS m ANTI JOIN event_ratings AS r ON m.movieId = r.movieId
""")
ORACLES["unrated_items_not_in"] = _q("""
SELECT m.* FROM movies AS m WHERE m.movieId <> ALL (SELECT movieId FROM event_ratings)
""")

ORACLES["sql_title_counts"] = _q("""
SELECT m.title, count(*) AS n_high
FROM ratings AS r JOIN movies AS m USING (movieId) WHERE r.rating >= 4.5 GROUP BY m.title
""")

ORACLES["top_reviewed"] = _q("""
, titles AS (
  SELECT title, coalesce(sum(n_ratings), 0)::BIGINT AS n
  FROM movies LEFT JOIN per_item USING (movieId) GROUP BY title)
SELECT title, n AS count, rank FROM (
  SELECT *, row_number() OVER (ORDER BY n DESC, title)::INTEGER AS rank FROM titles)
WHERE rank <= 100
""")

ORACLES["top_rated"] = _q("""
, titles AS (
  SELECT title, coalesce(sum(n_ratings), 0)::BIGINT AS n, round(sum(total) / sum(n_ratings), 1) AS mean
  FROM movies LEFT JOIN per_item USING (movieId) GROUP BY title)
SELECT title, mean AS rate, n AS count, rank FROM (
  SELECT *, row_number() OVER (ORDER BY n DESC, mean DESC NULLS LAST, title)::INTEGER AS rank FROM titles)
WHERE rank <= 100
""")

ORACLES["genre_counts"] = _q("""
SELECT category, count(*) AS number
FROM (SELECT unnest(list_distinct(string_split(genres, '|'))) AS category FROM movies)
WHERE category <> ''
GROUP BY category
""")

ORACLES["rating_histogram"] = _q("""
SELECT rating, count(*) AS count FROM ratings GROUP BY rating
""")

ORACLES["user_history"] = _q("""
SELECT r.userId, r.movieId, r.rating, r.ts, m.title, m.genres
FROM ratings AS r LEFT JOIN movies AS m ON r.movieId = m.movieId
""")

ORACLES["table_report"] = _q("""
SELECT 'ratings' AS table_name, count(*) AS n_rows,
       count(*) FILTER (WHERE userId IS NULL OR movieId IS NULL OR rating IS NULL) AS n_rejected
FROM ratings
UNION ALL
SELECT 'movies', count(*), count(*) FILTER (WHERE movieId IS NULL OR title IS NULL) FROM movies
UNION ALL
SELECT 'links', count(*), count(*) FILTER (WHERE movieId IS NULL) FROM links
UNION ALL
SELECT 'tags', count(*), count(*) FILTER (WHERE userId IS NULL OR movieId IS NULL) FROM tags
""")

ORACLES["preview_movies"] = _q("""
SELECT * FROM movies ORDER BY movieId LIMIT 5
""")

ORACLES["rating_summary"] = _q("""
SELECT column_name, n, round(mean, 6) AS mean, round(stddev, 6) AS stddev,
       round(min, 6) AS min, round(max, 6) AS max
FROM (
  SELECT 'userId' AS column_name, count(userId) AS n, avg(userId) AS mean,
         stddev_samp(userId) AS stddev, CAST(min(userId) AS double) AS min,
         CAST(max(userId) AS double) AS max FROM ratings
  UNION ALL
  SELECT 'movieId', count(movieId), avg(movieId), stddev_samp(movieId),
         CAST(min(movieId) AS double), CAST(max(movieId) AS double) FROM ratings
  UNION ALL
  SELECT 'rating', count(rating), avg(rating), stddev_samp(rating), min(rating), max(rating)
  FROM ratings)
""")

_GENRE_SET = "list_sort(list_distinct(list_filter(string_split(genres, '|'), lambda x: x <> '')))"

ORACLES["genre_vocabulary"] = _q(f"""
SELECT DISTINCT unnest({_GENRE_SET}) AS genre FROM movies
""")

ORACLES["movie_genres"] = _q(f"""
SELECT movieId, unnest({_GENRE_SET}) AS genre FROM movies
""")

ORACLES["distinct_genre_strings"] = _q("""
SELECT DISTINCT genres FROM movies
""")

ORACLES["genre_flags"] = _q(f"""
, vocab AS (SELECT list(genre ORDER BY genre) AS v
            FROM (SELECT DISTINCT unnest({_GENRE_SET}) AS genre FROM movies))
SELECT movieId,
       list_transform(vocab.v, lambda g: CASE WHEN list_contains({_GENRE_SET}, g) THEN 1 ELSE 0 END) AS flags
FROM movies, vocab
""")

ORACLES["genre_indices"] = _q(f"""
, vocab AS (SELECT list(genre ORDER BY genre) AS v
            FROM (SELECT DISTINCT unnest({_GENRE_SET}) AS genre FROM movies))
SELECT movieId, list_filter(range(len(vocab.v)), lambda j: list_contains({_GENRE_SET}, vocab.v[j + 1])) AS indices
FROM movies, vocab
""")

ORACLES["most_rated_left"] = _q("""
SELECT * FROM (
  SELECT movieId, title, genres, n_ratings,
         row_number() OVER (ORDER BY n_ratings DESC NULLS LAST, movieId)::INTEGER AS rank
  FROM movies LEFT JOIN per_item USING (movieId))
WHERE rank <= 10
""")

ORACLES["most_rated_inner"] = _q("""
SELECT title, genres, n_ratings, CAST(row_number() OVER (ORDER BY n_ratings DESC, movieId) AS INTEGER) AS rank
FROM (
  SELECT m.movieId, m.title, m.genres, c.n_ratings
  FROM (SELECT movieId, count(rating) AS n_ratings FROM ratings GROUP BY movieId) AS c
  JOIN movies AS m ON c.movieId = m.movieId
  ORDER BY c.n_ratings DESC, m.movieId
  LIMIT 10)
""")

ORACLES["factor_columns"] = "SELECT vec_id AS id, " + ", ".join(
    f"embedding[{i + 1}] AS feature{i}" for i in range(64)) + " FROM embeddings"

ORACLES["similar_by_factors"] = _q("""
, f AS (SELECT vec_id AS id, CAST(embedding AS double[]) AS v FROM embeddings),
pairs AS (
  SELECT a.id AS target_id, b.id AS movieId, list_cosine_similarity(a.v, b.v) AS sim
  FROM f AS a JOIN f AS b ON a.id <> b.id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY target_id ORDER BY sim DESC NULLS LAST, movieId) AS INTEGER) AS rank
  FROM pairs)
SELECT r.target_id, r.movieId, round(r.sim, 6) AS similarity, r.rank, m.title, m.genres
FROM ranked AS r LEFT JOIN movies AS m ON r.movieId = m.movieId
WHERE r.rank <= 10
""")

_GENRE_PAIRS = f"""
, g AS (SELECT movieId, title, genres, {_GENRE_SET} AS gs FROM movies),
pairs AS (
  SELECT a.movieId AS target_id, b.movieId, b.title, b.genres,
         CASE WHEN len(a.gs) * len(b.gs) > 0
              THEN len(list_intersect(a.gs, b.gs)) / sqrt(len(a.gs) * len(b.gs)) END AS sim
  FROM g AS a JOIN g AS b ON a.movieId <> b.movieId)
"""

ORACLES["similar_by_genres"] = _q(_GENRE_PAIRS + """
SELECT target_id, movieId, title, genres, round(sim, 6) AS similarity, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY target_id ORDER BY sim DESC NULLS LAST, movieId) AS INTEGER) AS rank
      FROM pairs)
WHERE rank <= 10
""")

ORACLES["similar_by_genres_farthest"] = _q(_GENRE_PAIRS + """
SELECT target_id, movieId, title, genres, round(sim, 6) AS similarity, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY target_id ORDER BY sim ASC NULLS LAST, movieId) AS INTEGER) AS rank
      FROM pairs)
WHERE rank <= 10
""")

# Model inputs: cleaned ratings with int ids, split by a hash bucket that SQL can state.
_SPLIT = """
, clean AS (SELECT CAST(userId AS INTEGER) AS userId, CAST(movieId AS INTEGER) AS movieId,
                   CAST(rating AS FLOAT) AS rating FROM ratings),
bucketed AS (SELECT *, ((31 * CAST(userId AS BIGINT) + 17 * CAST(movieId AS BIGINT)) % 5 + 5) % 5 AS bucket
             FROM clean),
train AS (SELECT userId, movieId, rating FROM bucketed WHERE bucket <> 0),
test AS (SELECT userId, movieId, rating FROM bucketed WHERE bucket = 0),
mu AS (SELECT avg(CAST(rating AS double)) AS mu FROM train),
bi AS (SELECT movieId, sum(rating - mu) / (count(*) + 10.0) AS b_i FROM train, mu GROUP BY movieId),
bu AS (SELECT userId, sum(rating - mu - b_i) / (count(*) + 15.0) AS b_u
       FROM train JOIN bi USING (movieId), mu GROUP BY userId)
"""

ORACLES["hash_split_counts"] = _q(_SPLIT + """
SELECT bucket, count(*) AS n_rows FROM bucketed GROUP BY bucket
""")

ORACLES["bias_baseline_rmse"] = _q(_SPLIT + """
SELECT count(*) AS n,
       round(sqrt(avg(power(rating - least(5.0, greatest(1.0, mu + coalesce(b_u, 0) + coalesce(b_i, 0))), 2))), 6)
         AS rmse
FROM test LEFT JOIN bu USING (userId) LEFT JOIN bi USING (movieId), mu
""")

ORACLES["item_biases"] = _q(_SPLIT + """
SELECT movieId, round(b_i, 6) AS b_i FROM bi
""")

ORACLES["user_biases"] = _q(_SPLIT + """
SELECT userId, round(b_u, 6) AS b_u FROM bu
""")

ORACLES["fallback_titles"] = _q("""
SELECT string_agg(title, ' | ' ORDER BY n_ratings DESC, movieId) AS titles
FROM (SELECT m.movieId, m.title, c.n_ratings
      FROM (SELECT movieId, count(rating) AS n_ratings FROM ratings GROUP BY movieId) AS c
      JOIN movies AS m ON c.movieId = m.movieId
      ORDER BY c.n_ratings DESC, m.movieId
      LIMIT 10)
""")

ORACLES["bias_recommend"] = _q(_SPLIT + """
, items AS (
  SELECT m.movieId, m.title, m.genres, coalesce(b_i, 0) AS b_i,
         row_number() OVER (ORDER BY round(coalesce(b_i, 0), 12) DESC, m.movieId)::INTEGER AS rank
  FROM movies AS m LEFT JOIN bi USING (movieId)),
req AS (SELECT DISTINCT userId FROM tags WHERE userId IS NOT NULL)
SELECT userId, rank, items.movieId, title, genres,
       round(least(5.0, greatest(1.0, mu + coalesce(b_u, 0) + b_i)), 6) AS estimate_rating
FROM req LEFT JOIN bu USING (userId), items, mu WHERE rank <= 10
""")

ORACLES["serve_bias_requests"] = _q(_SPLIT + """
, best AS (
  SELECT list(title ORDER BY round(coalesce(b_i, 0), 12) DESC, m.movieId) AS v
  FROM movies AS m LEFT JOIN bi USING (movieId)),
most AS (SELECT list(title ORDER BY n_ratings DESC, movieId) AS v FROM per_item JOIN movies USING (movieId)),
req AS (
  SELECT p_partkey AS userId, (p_size % 7)::INTEGER AS n FROM part
  UNION ALL SELECT p_partkey // 2, (p_size % 7)::INTEGER FROM part),
told AS (SELECT req.*, req.userId IN (SELECT userId FROM ratings) AS known FROM req)
SELECT userId, n, known AND n > 0 AS is_known,
       CASE WHEN n <= 0 THEN 'invalid' WHEN known THEN 'ok' ELSE 'fallback' END AS status,
       CASE WHEN n <= 0 THEN '' ELSE
         array_to_string(list_slice(CASE WHEN known THEN best.v ELSE most.v END, 1, n), ' | ') END AS titles
FROM told, best, most
""")


def _bias_point(number: int, item: float, user: float, fold: int) -> str:
    return f"""
SELECT {number} AS grid_id, {fold} AS fold, (
  WITH fit AS (SELECT * FROM folds WHERE fold <> {fold}), m AS (SELECT avg(rating::DOUBLE) AS mu FROM fit),
  i AS (SELECT movieId, sum(rating - mu) / (count(*) + {item}) AS b_i FROM fit, m GROUP BY movieId),
  u AS (SELECT userId, sum(rating - mu - b_i) / (count(*) + {user}) AS b_u FROM fit JOIN i USING (movieId), m
        GROUP BY userId)
  SELECT sqrt(avg(power(rating - least(5.0, greatest(1.0, mu + coalesce(b_u, 0) + coalesce(b_i, 0))), 2)))
  FROM (SELECT * FROM folds WHERE fold = {fold}) LEFT JOIN u USING (userId) LEFT JOIN i USING (movieId), m) AS rmse"""


ORACLES["bias_tuning_report"] = _q(
    _SPLIT + ", folds AS (SELECT *, ((31 * userId::BIGINT + 17 * movieId::BIGINT) % 3 + 3) % 3 AS fold FROM train),\n"
    "runs AS (" + "\nUNION ALL".join(
        _bias_point(n, item, user, fold)
        for n, (item, user) in enumerate([(5.0, 5.0), (5.0, 15.0), (10.0, 5.0), (10.0, 15.0)])
        for fold in range(3)) + """),
means AS (SELECT grid_id, avg(rmse) AS mean FROM runs GROUP BY grid_id)
SELECT grid_id, fold, round(rmse, 6) AS rmse, round(mean, 6) AS avg_rmse,
       grid_id = (SELECT grid_id FROM means ORDER BY mean, grid_id LIMIT 1) AS is_best
FROM runs JOIN means USING (grid_id)
""")

ORACLES["rejected_ratings"] = _q("""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE userId IS NOT NULL AND movieId IS NOT NULL AND rating IS NOT NULL)
         AS n_kept,
       count(*) FILTER (WHERE userId IS NULL OR movieId IS NULL OR rating IS NULL) AS n_rejected
FROM ratings
""")

ORACLES["movie_text_summary"] = _q("""
SELECT 'title' AS column_name, count(title) AS n, min(title) AS min, max(title) AS max FROM movies
UNION ALL SELECT 'genres', count(genres), min(genres), max(genres) FROM movies
""")

ORACLES["similar_for_targets"] = _q(_GENRE_PAIRS + """
, wanted AS (SELECT DISTINCT movieId * 30 AS target_id FROM tags WHERE movieId IS NOT NULL)
SELECT target_id, movieId, title, genres, round(sim, 6) AS similarity, rank, true AS is_known
FROM (SELECT pairs.*, row_number() OVER (PARTITION BY target_id ORDER BY sim DESC NULLS LAST, movieId)::INTEGER AS rank
      FROM pairs SEMI JOIN wanted USING (target_id))
WHERE rank <= 10
UNION ALL
SELECT target_id, NULL, NULL, NULL, NULL, NULL, false
FROM wanted WHERE target_id NOT IN (SELECT movieId FROM movies)
""")

ORACLES["user_history_for_users"] = _q("""
SELECT r.userId, r.movieId, r.rating, r.ts, m.title, m.genres
FROM ratings AS r LEFT JOIN movies AS m ON r.movieId = m.movieId
WHERE r.userId IN (SELECT 7 * userId FROM tags)
""")

ORACLES["als_item_equations"] = _q(_SPLIT + """
SELECT movieId, count(*) AS n_ratings, CAST(0 AS double) AS residual FROM train GROUP BY movieId
""")

ORACLES["csv_movies"] = _q("""
SELECT movieId, concat('"', title, '", ', movieId, chr(10), ',""', chr(92), ' ') AS title, genres FROM movies
""")

ORACLES["csv_rejects"] = _q(""",
tenth AS (SELECT movieId AS m FROM movies WHERE movieId % 10 = 0)
SELECT 'movies' AS table_name, concat(m, ',lost') AS line, 'fields' AS reason FROM tenth
UNION ALL SELECT 'ratings', concat('u', m, ',', m, ',4.5,0'), 'userId: not a bigint' FROM tenth
UNION ALL SELECT 'ratings', concat(',', m, ',4.5,0'), 'userId: missing' FROM tenth
""")

ORACLES["csv_report"] = _q("""
SELECT 'ratings' AS table_name, count(*) AS n_rows, 0 AS n_rejected FROM ratings
UNION ALL SELECT 'movies', count(*), 0 FROM movies
UNION ALL SELECT 'links', count(*), 0 FROM links
UNION ALL SELECT 'tags', count(*), 0 FROM tags
""")
