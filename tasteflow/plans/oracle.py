"""DuckDB SQL equal to each registered query, over the raw test tables.

The domain views are repeated as CTEs so every statement runs on its own
against the pre-registered tables.
"""

from __future__ import annotations

from tasteflow.operators.als import GRID_RANKS, GRID_REGS
from tasteflow.plans.registry import ALL_PAIRS_THRESHOLD, DELAY_DAYS, LIST_THRESHOLD, PAIR_THRESHOLD, SEED, TEST_GENRES

RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS uid, CAST(l_partkey AS INTEGER) AS mid,
         CAST(ceil(l_quantity / 5) / 2 AS DOUBLE) AS score,
         CAST(epoch(l_shipdate) AS BIGINT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MOVIES = """movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name, '' AS descri,
         concat(CAST(p_size AS VARCHAR), ' minutes') AS timelong, '' AS shoot, '' AS issue,
         'English' AS language, concat(p_type, '|', replace(p_name, ' ', '|')) AS genres,
         p_brand AS actors, p_brand AS directors
  FROM part)"""

TAGS = """tags AS (
  SELECT CAST(user_id AS INTEGER) AS uid, CAST(json_extract(props, '$.k') AS INTEGER) AS mid,
         event_type AS tag, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp"
  FROM events)"""

FACTORS = """factors AS (
  SELECT CAST(vec_id AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings)"""

AVERAGES = """averages AS (SELECT mid, avg(score) AS avg_score FROM ratings GROUP BY mid)"""


def with_views(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _values(words: list[str]) -> str:
    return ", ".join("('" + w.replace("'", "''") + "')" for w in words)


def _c(col: str) -> str:
    return f"coalesce(CAST({col} AS VARCHAR), '')"


RATING_LINES = f"concat_ws(',', {_c('uid')}, {_c('mid')}, {_c('score')}, {_c('\"timestamp\"')})"
TAG_LINES = f"concat_ws(',', {_c('uid')}, {_c('mid')}, {_c('tag')}, {_c('\"timestamp\"')})"
MOVIE_LINES = "concat_ws('^', " + ", ".join(
    _c(c) for c in ["mid", "name", "descri", "timelong", "shoot", "issue", "language", "genres", "actors", "directors"]
) + ")"

INT_TEXT = "'^[+-]?[0-9]+$'"
DOUBLE_TEXT = r"'^[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)$'"


def _strict(expr: str, typ: str) -> str:
    return f"CASE WHEN regexp_matches({expr}, {INT_TEXT}) THEN TRY_CAST({expr} AS {typ}) END"


def _jvm_double(expr: str) -> str:
    t = f"regexp_replace({expr}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
    return f"CASE WHEN regexp_matches({t}, {DOUBLE_TEXT}) THEN TRY_CAST({t} AS DOUBLE) END"


SQL: dict[str, str] = {}

SQL["average_scores"] = with_views(RATINGS) + """
SELECT mid, round(avg(score), 6) AS avg_score FROM ratings GROUP BY mid"""

SQL["genre_top10"] = with_views(RATINGS, MOVIES, AVERAGES, f"genre_list(genre) AS (VALUES {_values(TEST_GENRES)})") + """
, hits AS (
  SELECT g.genre, m.mid, a.avg_score
  FROM movies m JOIN averages a USING (mid)
  JOIN genre_list g ON contains(lower(m.genres), lower(g.genre)))
, ranked AS (
  SELECT genre, CAST(row_number() OVER (PARTITION BY genre ORDER BY avg_score DESC, mid) AS INTEGER) AS "rank",
         mid, avg_score FROM hits)
SELECT genre, "rank", mid, round(avg_score, 6) AS avg_score FROM ranked WHERE "rank" <= 10"""

SQL["rating_counts"] = with_views(RATINGS) + """
SELECT mid, count(score) AS rating_count FROM ratings GROUP BY mid ORDER BY mid DESC"""

SQL["monthly_counts"] = with_views(RATINGS) + """
SELECT strftime(make_timestamp("timestamp" * 1000000), '%Y%m') AS year_month, mid, count(mid) AS rating_count
FROM ratings GROUP BY 1, 2 ORDER BY 1 DESC, 3 DESC, 2"""

SQL["distinct_genres"] = with_views(MOVIES) + """
SELECT DISTINCT unnest(string_split(regexp_replace(genres, '[|]+$', ''), '|')) AS genre FROM movies"""

SQL["sparse_genres"] = with_views(MOVIES) + """
SELECT genre, count(*) AS n FROM (
  SELECT unnest(string_split(regexp_replace(
    concat(CASE WHEN mid % 5 = 0 THEN '|' ELSE '' END, replace(genres, '|red|', '||'),
           CASE WHEN mid % 3 = 0 THEN '||' ELSE '' END), '[|]+$', ''), '|')) AS genre FROM movies)
GROUP BY genre"""

SQL["distinct_users"] = with_views(RATINGS) + """
SELECT DISTINCT uid FROM ratings"""

SQL["movies_parsed"] = with_views(MOVIES) + """
SELECT * FROM movies"""

SQL["ratings_parsed"] = with_views(RATINGS) + """
SELECT * FROM ratings"""

SQL["tags_parsed"] = with_views(TAGS) + """
SELECT * FROM tags"""

SQL["parse_rejects"] = with_views(RATINGS, TAGS, MOVIES) + f"""
, lines AS (
  SELECT {RATING_LINES} AS value FROM ratings
  UNION ALL SELECT {TAG_LINES} FROM tags
  UNION ALL SELECT {MOVIE_LINES} FROM movies)
, parts AS (SELECT value, string_split(value, ',') AS p FROM lines)
, checked AS (
  SELECT value, CASE
    WHEN len(p) < 4 THEN 'field_count'
    WHEN ({_strict('p[1]', 'INTEGER')}) IS NULL THEN 'bad_uid'
    WHEN ({_strict('p[2]', 'INTEGER')}) IS NULL THEN 'bad_mid'
    WHEN ({_jvm_double('p[3]')}) IS NULL THEN 'bad_score'
    WHEN ({_strict('p[4]', 'BIGINT')}) IS NULL THEN 'bad_timestamp'
  END AS reason FROM parts)
SELECT value, reason FROM checked WHERE reason IS NOT NULL"""

SQL["tags_by_item"] = with_views(TAGS) + """
SELECT mid, array_to_string(list_sort(list_distinct(list(tag))), '|') AS tags FROM tags GROUP BY mid"""

SQL["items_with_tags"] = with_views(MOVIES, TAGS) + """
, rollup AS (SELECT mid, array_to_string(list_sort(list_distinct(list(tag))), '|') AS tags FROM tags GROUP BY mid)
SELECT m.*, r.tags FROM movies m LEFT JOIN rollup r USING (mid)"""


def _pairs(threshold: float, name: str = "sim") -> str:
    return f"""{name} AS (
  SELECT a.id AS mid, b.id AS sim_mid, list_cosine_similarity(a.features, b.features) AS score
  FROM factors a JOIN factors b ON a.id <> b.id
  WHERE list_cosine_similarity(a.features, b.features) > {threshold})"""


SQL["item_similarity"] = with_views(FACTORS, _pairs(PAIR_THRESHOLD)) + """
SELECT mid, sim_mid, round(score, 6) AS score FROM sim"""

SQL["similar_items_list"] = with_views(FACTORS, _pairs(LIST_THRESHOLD)) + """
SELECT mid, CAST(row_number() OVER (PARTITION BY mid ORDER BY score DESC, sim_mid) AS INTEGER) AS "rank",
       sim_mid, round(score, 6) AS score FROM sim"""

SQL["factor_topk"] = with_views(FACTORS, MOVIES) + """
, items AS (SELECT * FROM factors WHERE id IN (SELECT mid FROM movies))
, scored AS (
  SELECT u.id AS uid, i.id AS mid, list_dot_product(u.features, i.features) AS score
  FROM factors u CROSS JOIN items i)
, ranked AS (
  SELECT uid, mid, score, row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS rn
  FROM scored WHERE score > 0)
SELECT uid, CAST(rn AS INTEGER) AS "rank", mid, round(score, 6) AS score FROM ranked WHERE rn <= 10"""

SQL["item_similarity_pruned"] = SQL["item_similarity"]
SQL["factor_topk_bounded"] = SQL["factor_topk"]

RECENT = """recent AS (
  SELECT uid, CAST(rn AS INTEGER) AS rn, mid, score FROM (
    SELECT uid, mid, score,
           row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid DESC, score DESC) AS rn
    FROM ratings) WHERE rn <= 10)"""

LAST_EVENT = """last_event AS (
  SELECT uid, mid, score, "timestamp" FROM (
    SELECT *, row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, mid DESC, score DESC) AS rn
    FROM ratings) WHERE rn = 1)"""

CANDIDATES = """cand AS (
  SELECT uid, CAST(rk AS INTEGER) AS "rank", mid, sim FROM (
    SELECT e.uid, s.sim_mid AS mid, s.score AS sim,
           row_number() OVER (PARTITION BY e.uid ORDER BY s.score DESC, s.sim_mid) AS rk
    FROM last_event e JOIN sim s ON s.mid = e.mid
    WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.uid = e.uid AND r.mid = s.sim_mid))
  WHERE rk <= 10)"""

SCORES = f"""scores AS (
  SELECT c.uid, c.mid,
         avg(s.score * r.score) + log2(greatest(count(*) FILTER (WHERE r.score > 3), 1))
           - log2(greatest(count(*) FILTER (WHERE r.score <= 3), 1)) AS score
  FROM cand c JOIN recent r ON r.uid = c.uid
  JOIN sim s ON s.mid = c.mid AND s.sim_mid = r.mid
  WHERE s.score > {PAIR_THRESHOLD}
  GROUP BY c.uid, c.mid)"""

SQL["recent_ratings"] = with_views(RATINGS, RECENT) + """
SELECT * FROM recent"""

SQL["last_events"] = with_views(RATINGS, LAST_EVENT) + """
SELECT * FROM last_event"""

SQL["unseen_candidates"] = with_views(RATINGS, FACTORS, _pairs(PAIR_THRESHOLD), LAST_EVENT, CANDIDATES) + """
SELECT uid, "rank", mid, round(sim, 6) AS sim FROM cand"""

SQL["realtime_scores"] = with_views(RATINGS, FACTORS, _pairs(PAIR_THRESHOLD), LAST_EVENT, CANDIDATES, RECENT, SCORES) + """
SELECT uid, mid, round(score, 6) AS score FROM scores"""

SQL["realtime_lists"] = with_views(RATINGS, FACTORS, _pairs(PAIR_THRESHOLD), LAST_EVENT, CANDIDATES, RECENT, SCORES) + """
SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INTEGER) AS "rank",
       mid, round(score, 6) AS score FROM scores"""

SQL["rmse"] = with_views(RATINGS, AVERAGES) + """
, predicted AS (SELECT r.uid, r.mid, a.avg_score AS prediction FROM ratings r JOIN averages a USING (mid))
SELECT round(sqrt(avg(power(t.score - p.prediction, 2))), 6) AS rmse
FROM ratings t JOIN predicted p USING (uid, mid)"""

SQL["log_filter_stream"] = with_views(RATINGS) + f"""
SELECT 'logProcessor' AS key, {RATING_LINES.replace("concat_ws(',',", "concat_ws('|',")} AS value FROM ratings"""

SQL["forwarded_clock"] = with_views(RATINGS) + "SELECT true AS on_time, count(*) AS n FROM ratings"

# facts about the fitted model: which rows a seed holds out, which ids have factors, what the lists are like
SPLIT = f"""split AS (
  SELECT *, ('0x' || left(md5(concat_ws('|', '{SEED}', {_c('uid')}, {_c('mid')},
      coalesce(CAST(CAST(round(score * 1000000) AS BIGINT) AS VARCHAR), ''), {_c('"timestamp"')})), 8))::BIGINT
      < {round(0.8 * 2 ** 32)} AS train FROM ratings)"""

SQL["holdout_split"] = with_views(RATINGS, SPLIT) + """
SELECT uid, mid, score, "timestamp", CASE WHEN train THEN 'train' ELSE 'test' END AS split FROM split"""

SQL["als_factor_ids"] = with_views(RATINGS) + """
SELECT DISTINCT 'user' AS side, uid AS id FROM ratings UNION ALL SELECT DISTINCT 'item', mid FROM ratings"""

SQL["als_predicted_pairs"] = with_views(RATINGS, SPLIT) + """
SELECT uid, mid FROM split WHERE NOT train AND uid IN (SELECT uid FROM split WHERE train)
  AND mid IN (SELECT mid FROM split WHERE train)"""

SQL["stored_user_lists"] = with_views(RATINGS) + """
SELECT DISTINCT uid, true AS short, true AS sorted, true AS positive, true AS in_catalogue FROM ratings"""

SQL["stored_item_lists"] = SQL["item_similarity"]

SQL["als_grid_facts"] = f"""
SELECT CAST(r AS INTEGER) AS "rank", CAST(g AS DOUBLE) AS reg_param, true AS has_error, true AS best_is_least
FROM unnest({list(GRID_RANKS)}) a(r), unnest({list(GRID_REGS)}) b(g)"""

SQL["rating_event_stream"] = SQL["ratings_parsed"]

SQL["on_time_event_stream"] = with_views(RATINGS, """arrivals AS (
  SELECT *, uid % 3 AS run FROM ratings UNION ALL SELECT *, 2 FROM ratings WHERE uid % 3 = 0)""", """newest AS (
  SELECT run, max(max("timestamp")) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM arrivals GROUP BY run)""", """firsts AS (
  SELECT uid, mid, score, "timestamp", min(run) AS run FROM arrivals GROUP BY ALL)""") + f"""
SELECT uid, mid, score, "timestamp" FROM firsts JOIN newest USING (run)
WHERE before IS NULL OR "timestamp" > before - {DELAY_DAYS} * 86400"""

SQL["stream_monthly_counts"] = SQL["monthly_counts"]

SQL["stream_average_scores"] = with_views(RATINGS) + """
SELECT mid, round(avg(score), 6) AS avg_score, count(score) AS rating_count FROM ratings GROUP BY mid"""

SQL["realtime_stream_upsert"] = SQL["realtime_lists"]

SQL["stream_list_string"] = with_views(RATINGS, FACTORS, _pairs(PAIR_THRESHOLD), LAST_EVENT, CANDIDATES, RECENT, SCORES) + """
SELECT e.uid, coalesce(string_agg(CAST(s.mid AS VARCHAR) || ':' || printf('%.6f', round(s.score, 6)), '|'
                                  ORDER BY s.score DESC, s.mid), '') AS recs
FROM last_event e LEFT JOIN scores s ON s.uid = e.uid
GROUP BY e.uid"""

SQL["genre_lists_roundtrip"] = SQL["genre_top10"]

SQL["loaded_ratings"] = SQL["ratings_parsed"]
SQL["rating_counts_sql"] = SQL["rating_counts"]
SQL["monthly_counts_sql"] = SQL["monthly_counts"]

SQL["month_view_sql"] = with_views(RATINGS) + """
SELECT strftime(make_timestamp("timestamp" * 1000000), '%Y%m') AS year_month, mid, count(mid) AS rating_count,
       round(avg(score), 6) AS avg_score
FROM ratings GROUP BY 1, 2"""

SQL["month_function_sql"] = with_views(RATINGS) + """
SELECT strftime(make_timestamp(a * 1000000), '%Y%m') AS first_month, strftime(make_timestamp(b * 1000000), '%Y%m') AS last_month,
       count(*) AS n_users
FROM (SELECT uid, min("timestamp") AS a, max("timestamp") AS b FROM ratings GROUP BY uid) GROUP BY 1, 2"""

SQL["genre_top10_token"] = SQL["genre_top10"].replace(
    "JOIN genre_list g ON contains(lower(m.genres), lower(g.genre))",
    "JOIN genre_list g ON list_contains(string_split(lower(m.genres), '|'), lower(g.genre))",
)
SQL["movie_index_roundtrip"] = SQL["items_with_tags"]

SQL["realtime_scores_all_pairs"] = with_views(RATINGS, FACTORS, _pairs(PAIR_THRESHOLD), LAST_EVENT, CANDIDATES, RECENT) + """
, scores AS (
  SELECT c.uid, c.mid, avg(coalesce(s.score, 0.0) * r.score) AS mean,
         count(*) FILTER (WHERE r.score > 3) AS boost, count(*) FILTER (WHERE r.score <= 3) AS dampen
  FROM cand c JOIN recent r ON r.uid = c.uid
  LEFT JOIN sim s ON s.mid = c.mid AND s.sim_mid = r.mid
  WHERE coalesce(s.score, 0.0) > """ + str(ALL_PAIRS_THRESHOLD) + """
  GROUP BY c.uid, c.mid)
SELECT uid, mid, round(mean + log2(greatest(boost, 1)) - log2(greatest(dampen, 1)), 6) AS score FROM scores"""
