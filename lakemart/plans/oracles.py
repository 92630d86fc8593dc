"""Independent SQL (DuckDB dialect) for each registered query.

The stand-in derivations are restated here as CTEs over the base tables, so an
oracle shares no code with the Spark plan it checks.
"""

from __future__ import annotations

from .queries import POPULAR, TOP_TITLES

RATINGS = """ratings AS (SELECT CAST(l_suppkey AS INTEGER) AS user_id,
    CAST(l_partkey AS INTEGER) AS movie_id, l_quantity AS rating,
    l_shipdate AS created_at FROM lineitem)"""
MOVIES = """movies AS (SELECT CAST(p_partkey AS INTEGER) AS movie_id, p_name AS title FROM part)"""
TAGS = """tags AS (SELECT CAST(user_id AS INTEGER) AS user_id,
    TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS movie_id,
    event_type AS tag, ts AS created_at FROM events)"""
USERS = """users AS (SELECT CAST(c_custkey AS INTEGER) AS user_id,
    split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
    n_name AS country, CAST(f.first_order AS DATE) AS registration_date,
    make_date(CAST(1950 + c_custkey % 50 AS INTEGER), CAST(1 + c_custkey % 12 AS INTEGER),
              CAST(1 + c_custkey % 28 AS INTEGER)) AS birth_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f
    ON c_custkey = f.o_custkey)"""


def R4(expr: str) -> str:
    """Same report rounding as ``queries.r4``."""
    return f"(floor(({expr}) * 10000 + 0.500001) / 10000)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLES: dict[str, str] = {}

ORACLES["fact_top_titles"] = _with(RATINGS, MOVIES, f"""t AS (
  SELECT title, sum(rating) AS s, avg(rating) AS a FROM ratings JOIN movies USING (movie_id)
  WHERE created_at >= TIMESTAMP '{TOP_TITLES['y0']}-01-01' AND created_at < TIMESTAMP '{TOP_TITLES['y1'] + 1}-01-01'
  GROUP BY title HAVING avg(rating) >= {TOP_TITLES['min_avg']}
  ORDER BY s DESC, title LIMIT {TOP_TITLES['n']})""") + """
SELECT title, s AS rating_sum, """ + R4("a") + """ AS average_rating FROM t"""

ORACLES["fact_rating_by_year"] = _with(RATINGS) + """
SELECT movie_id, CAST(year(created_at) AS INTEGER) AS movie_year, """ + R4("avg(rating)") + """ AS average_rating
FROM ratings GROUP BY movie_id, year(created_at)"""

ORACLES["fact_popular_titles"] = _with(RATINGS, MOVIES) + f"""
SELECT title, {R4("avg(rating)")} AS average_rating, count(rating) AS rating_count
FROM ratings JOIN movies USING (movie_id) GROUP BY title
HAVING avg(rating) > {POPULAR['min_avg']} AND count(rating) >= {POPULAR['min_count']}"""

ORACLES["fact_silent_users"] = _with(RATINGS, USERS) + """
SELECT count(DISTINCT u.user_id) - count(DISTINCT r.user_id) AS silent_users
FROM ratings r RIGHT JOIN users u ON u.user_id = r.user_id"""

ORACLES["tag_lists"] = _with(TAGS) + """
SELECT user_id, movie_id, string_agg(tag, ',' ORDER BY tag) AS tags FROM tags GROUP BY user_id, movie_id"""

ORACLES["tag_lists_text"] = _with(TAGS) + """
SELECT user_id, movie_id, CAST(to_json(list(tag ORDER BY tag)) AS VARCHAR) AS tag_list
FROM tags GROUP BY user_id, movie_id"""

ORACLES["tag_repeats"] = _with(TAGS, USERS, MOVIES) + """
SELECT t.user_id, concat_ws(' ', u.first_name, u.last_name) AS full_name, t.movie_id, m.title
FROM tags t JOIN users u ON u.user_id = t.user_id JOIN movies m ON m.movie_id = t.movie_id
GROUP BY t.user_id, concat_ws(' ', u.first_name, u.last_name), t.movie_id, m.title, t.tag
HAVING count(t.tag) > 1"""

ORACLES["tag_top_titles"] = _with(TAGS, MOVIES) + """
SELECT m.title, count(DISTINCT t.tag) AS tag_count, string_agg(DISTINCT t.tag, ',' ORDER BY t.tag) AS tag_set
FROM tags t JOIN movies m ON m.movie_id = t.movie_id GROUP BY m.title
ORDER BY tag_count DESC, m.title LIMIT 3"""

# ---- shared SQL pieces of the other query groups ---------------------------------

STATS = """stats AS (SELECT c_name AS name,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'good' WHEN 'MACHINERY' THEN 'good'
      WHEN 'AUTOMOBILE' THEN 'bad' WHEN 'HOUSEHOLD' THEN 'bad' WHEN 'FURNITURE' THEN 'neutral' END AS alignment,
    CAST((c_custkey * 37 + 11) % 101 AS INTEGER) AS intelligence,
    CAST((c_custkey * 53 + 7) % 101 AS INTEGER) AS strength,
    CAST((c_custkey * 71 + 3) % 101 AS INTEGER) AS speed,
    CAST((c_custkey * 89 + 17) % 101 AS INTEGER) AS durability,
    CAST((c_custkey * 97 + 29) % 101 AS INTEGER) AS power,
    CAST((c_custkey * 59 + 41) % 101 AS INTEGER) AS combat
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'),
stats_t AS (SELECT *, intelligence + strength + speed + durability + power + combat AS total FROM stats)"""
INFO = """info AS (SELECT c_name AS name,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'good' WHEN 'MACHINERY' THEN 'good'
      WHEN 'AUTOMOBILE' THEN 'bad' WHEN 'HOUSEHOLD' THEN 'bad' WHEN 'FURNITURE' THEN 'neutral' END AS alignment,
    CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    n_name AS race, r_name AS publisher, c_acctbal / 20 AS height, c_acctbal / 50 AS weight
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE c_mktsegment <> 'MACHINERY')"""
STATS_ALL = STATS.replace(" WHERE c_mktsegment <> 'HOUSEHOLD'", "")
INFO_ALL = INFO.replace("\n  WHERE c_mktsegment <> 'MACHINERY'", "")
POWERS = """powers AS (SELECT c_name AS name, c_nationkey % 3 = 0 AS flight FROM customer
  WHERE c_mktsegment <> 'FURNITURE')"""
RAW_MOVIES = """raw_movies AS (SELECT CAST(p_partkey AS INTEGER) AS movie_id,
    p_name || CASE WHEN p_size % 3 = 0 THEN ': ' || p_brand ELSE '' END
      || CASE WHEN p_type = 'PROMO' THEN ' (n/a)' ELSE ' (' || CAST(1990 + p_size % 30 AS VARCHAR) || ')' END AS t,
    p_type || '|' || p_brand AS genres FROM part)"""


def title_sql(t: str) -> str:
    n, p = f"length({t})", f"strpos({t}, ':')"
    sub = f"CASE WHEN {p} <> 0 THEN nullif(trim(substring({t}, {p} + 1, greatest({n} - {p} - 7, 0))), '') END"
    base = f"nullif(trim(substring({t}, 1, greatest(CASE WHEN {p} <> 0 THEN {p} - 1 ELSE {n} - 6 END, 0))), '')"
    return f"nullif(concat_ws(' ', {sub}, {base}), '')"


def year_sql(t: str) -> str:
    return f"TRY_CAST(substring({t}, length({t}) - 4, 4) AS INTEGER)"


IMDB = ("CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN '0' "
        "ELSE 'tt' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') END")
DENY_SQL = "('0', 'tt0113002', 'tt2423504', 'tt2622826')"
ITEMS = """items AS (SELECT l_orderkey, l_linenumber, l_returnflag, p_partkey, p_name, p_type, p_size,
    s_suppkey, s_name, n_nationkey, n_name, r_regionkey, r_name
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
KEPT = f"""kept AS (SELECT o_orderkey FROM orders WHERE {IMDB} NOT IN {DENY_SQL})"""
RATINGS_RAW = """ratings_raw AS (SELECT CAST(l_suppkey AS INTEGER) AS userId, CAST(l_partkey AS INTEGER) AS movieId,
    l_quantity / 10 AS rating FROM lineitem)"""
USERS_REPORT = """SELECT user_id, first_name, last_name, CAST(birth_date AS VARCHAR) AS birth_date, country,
  CAST(registration_date AS VARCHAR) AS registration_date,
  CAST(year(registration_date) AS SMALLINT) AS registration_year FROM users"""
TOP_HEROES = """top_heroes AS (SELECT alignment, name, score, gender, race, universe FROM (
  SELECT i.alignment, s.name, s.total AS score, i.gender, i.race, i.publisher AS universe,
    row_number() OVER (PARTITION BY i.alignment ORDER BY s.total DESC, s.name) AS rn
  FROM stats_t s JOIN info i ON i.name = s.name
  WHERE i.publisher IN ('AMERICA', 'EUROPE') AND i.alignment IN ('good', 'bad')) WHERE rn <= 10)"""

from . import o_lake, o_mart, o_apps  # noqa: E402,F401  (register the other groups)
