"""SQL oracles of the lake-edge queries."""

from __future__ import annotations

from .oracles import (R4, INFO_ALL, ORACLES, POWERS, RATINGS_RAW, RAW_MOVIES, STATS, STATS_ALL, TAGS, TOP_HEROES, USERS,
                      USERS_REPORT, _with, title_sql, year_sql)
from .standins import SEGMENT_ALIGNMENT

RATING_TEXT = """CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity / 4 AS VARCHAR) WHEN l_linenumber = 1 THEN 'n/a'
  WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 3 THEN 'NaN' WHEN l_linenumber = 4 THEN '1e12' ELSE '-1e12' END"""

ORACLES["src_delimited"] = f"""
SELECT CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS movie_id,
  {RATING_TEXT} AS rating, strftime(l_shipdate, '%m/%d/%Y %H:%M:%S') AS created_at FROM lineitem"""

ORACLES["src_csv_inferred"] = _with(STATS_ALL) + """
SELECT name AS "Name", alignment AS "Alignment", intelligence AS "Intelligence", strength AS "Strength",
  speed AS "Speed", durability AS "Durability", power AS "Power", combat AS "Combat", total AS "Total"
FROM stats_t"""

ORACLES["src_csv_multiline"] = """
SELECT CAST(o_orderkey AS INTEGER) AS id,
  CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN '0'
       ELSE 'tt' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') END AS imdb_id,
  o_orderpriority || chr(10) || '"' || o_orderstatus || '", said ' || CAST(o_custkey AS VARCHAR) AS overview,
  CASE WHEN floor(o_totalprice * 10000) <= 2147483647 THEN CAST(floor(o_totalprice * 10000) AS INTEGER) END AS revenue,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS release_date, o_totalprice / 1000 AS popularity,
  false AS adult FROM orders"""

ORACLES["src_wordlist"] = "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part"

_lookup = ", ".join(f"('{s}', '{a}')" for s, a in SEGMENT_ALIGNMENT.items())
ORACLES["src_literal_rows"] = f"""
SELECT v.alignment, count(*) AS customers FROM customer
JOIN (VALUES {_lookup}) v(segment, alignment) ON c_mktsegment = v.segment GROUP BY v.alignment"""

ORACLES["src_table"] = """
SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS acctbal FROM customer GROUP BY c_mktsegment"""

ORACLES["src_parquet"] = """
SELECT o_orderstatus, count(*) AS orders, max(o_totalprice) AS max_totalprice FROM orders GROUP BY o_orderstatus"""

ORACLES["src_labelled_files"] = """
SELECT CAST(label AS VARCHAR) AS label, CAST(sum(length(CAST(vec_id AS VARCHAR)) + 1) AS BIGINT) AS n_bytes
FROM embeddings GROUP BY label"""

_CONFORMED = """SELECT CAST(l_suppkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS movie_id,
  {rating} AS rating, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created_at FROM lineitem"""
ORACLES["prj_conform_ratings"] = _CONFORMED.format(
    rating="CASE WHEN l_returnflag <> 'R' THEN l_quantity / 4 WHEN l_linenumber = 3 THEN CAST('NaN' AS DOUBLE) "
           "WHEN l_linenumber = 4 THEN 1e12 WHEN l_linenumber > 4 THEN -1e12 END")
ORACLES["prj_conform_ratings_integral"] = _CONFORMED.format(
    rating="CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(trunc(l_quantity / 4) AS INTEGER) END")

ORACLES["prj_conform_users"] = _with(USERS) + USERS_REPORT

ORACLES["prj_split_title"] = _with(RAW_MOVIES) + f"""
SELECT movie_id, {title_sql('t')} AS title, {year_sql('t')} AS movie_year FROM raw_movies"""

ORACLES["prj_split_list"] = _with(RAW_MOVIES) + """
SELECT movie_id, replace(genres, '|', ',') AS genres, CAST(len(string_split(genres, '|')) AS INTEGER) AS n_genres
FROM raw_movies"""

ORACLES["prj_deny_strip"] = """
SELECT id, substring(imdb, 3) AS imdb_id FROM (
  SELECT CAST(o_orderkey AS INTEGER) AS id,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN '0'
         ELSE 'tt' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') END AS imdb FROM orders)
WHERE imdb NOT IN ('0', 'tt0113002', 'tt2423504', 'tt2622826')"""

ORACLES["prj_clamp"] = _with(INFO_ALL) + """
SELECT name, CASE WHEN height > 0 THEN height ELSE 0 END AS height,
  CASE WHEN weight > 0 THEN weight ELSE 0 END AS weight FROM info"""

ORACLES["prj_fill"] = _with(STATS, POWERS) + """,
names AS (SELECT name FROM stats_t UNION SELECT name FROM powers)
SELECT n.name, coalesce(s.intelligence, 0) AS intelligence, coalesce(s.strength, 0) AS strength,
  coalesce(s.speed, 0) AS speed, coalesce(s.durability, 0) AS durability, coalesce(s.power, 0) AS power,
  coalesce(s.combat, 0) AS combat, coalesce(s.total, 0) AS total, coalesce(p.flight, false) AS flight
FROM names n LEFT JOIN stats_t s ON s.name = n.name LEFT JOIN powers p ON p.name = n.name"""

ORACLES["snk_external"] = _with(RATINGS_RAW) + "SELECT userId, movieId, rating FROM ratings_raw"
ORACLES["snk_partitioned"] = _with(USERS) + USERS_REPORT
ORACLES["snk_export"] = _with(USERS) + USERS_REPORT
ORACLES["snk_insert_into"] = _with(TAGS) + """
SELECT user_id, movie_id, string_agg(tag, ',' ORDER BY tag) AS tags FROM tags GROUP BY user_id, movie_id"""
ORACLES["snk_ctas"] = _with(RATINGS_RAW) + """
SELECT movieId, """ + R4("avg(rating)") + """ AS vote_average, CAST(count(rating) AS INTEGER) AS vote_count
FROM ratings_raw GROUP BY movieId"""
ORACLES["snk_csv"] = _with(STATS_ALL, INFO_ALL, TOP_HEROES) + "SELECT * FROM top_heroes"

ORACLES["snk_preview"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer ORDER BY customer.c_custkey LIMIT 20"""

ORACLES["cat_lifecycle"] = """
SELECT * FROM (VALUES ('create_database', true), ('describe_database', true), ('database_exists', true),
  ('create_table', true), ('create_external', true), ('drop_table', true), ('drop_database', true))
  v(step, ok)"""

ORACLES["stream_conform_ratings"] = ORACLES["prj_conform_ratings"]
