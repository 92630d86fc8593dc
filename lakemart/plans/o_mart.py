"""SQL oracles of the star-schema mart: plain joins instead of text parsing."""

from __future__ import annotations

from .oracles import R4, IMDB, ITEMS, KEPT, ORACLES, RATINGS_RAW, RAW_MOVIES, _with, title_sql, year_sql

# (dimension key, dimension name, bridge extras, deny-filtered source?)
_ENTITY_SQL = {
    "companies": ("CAST(s_suppkey AS INTEGER) AS company_id", "s_name AS company_name", "", True),
    "countries": ("'N' || CAST(n_nationkey AS VARCHAR) AS country_id", "n_name AS country_name", "", True),
    "languages": ("'r' || CAST(r_regionkey AS VARCHAR) AS language_id", "r_name AS language_name", "", True),
    "genres": ("CAST(p_partkey AS INTEGER) AS genre_id", "p_name AS genre_name", "", True),
    "actors": ("CAST(s_suppkey AS INTEGER) AS actor_id", "s_name AS name",
               ", CASE WHEN l_returnflag = 'R' THEN 'R''' ELSE l_returnflag END "
               "|| CAST(l_linenumber AS VARCHAR) AS character", False),
    "keywords": ("CAST(p_size AS INTEGER) AS keyword_id", "p_type AS name", "", False),
}

for _name, (_key, _label, _extra, _deny) in _ENTITY_SQL.items():
    _src = "items JOIN kept ON kept.o_orderkey = items.l_orderkey" if _deny else "items"
    ORACLES[f"nest_dim_{_name}"] = _with(ITEMS, KEPT) + f"SELECT DISTINCT {_key}, {_label} FROM {_src}"
    ORACLES[f"nest_bridge_{_name}"] = _with(ITEMS, KEPT) + (
        f"SELECT CAST(l_orderkey AS INTEGER) AS movie_id, {_key}{_extra} FROM {_src}")

_counts = ", ".join(f"count(l_orderkey) AS n_{n}" for n in _ENTITY_SQL)
ORACLES["nest_repair"] = _with(ITEMS) + f"""
SELECT CAST(o_orderkey AS INTEGER) AS id, {', '.join(
    f"CASE WHEN count(l_orderkey) = 0 THEN NULL ELSE CAST(count(l_orderkey) AS INTEGER) END AS n_{n}"
    for n in _ENTITY_SQL)}
FROM orders LEFT JOIN items ON l_orderkey = o_orderkey GROUP BY o_orderkey"""

# a backslash goes and the cell parses; an escaped apostrophe or a bare True loses the whole cell
ORACLES["nest_repair_values"] = _with(ITEMS) + """
SELECT CAST(l_orderkey AS INTEGER) AS id, CASE WHEN l_orderkey % 4 < 2 THEN string_agg(
    p_size || ':' || p_type, ',' ORDER BY p_size || ':' || p_type) END AS keywords
FROM items GROUP BY l_orderkey"""

ORACLES["mart_votes"] = _with(RATINGS_RAW) + """
SELECT movieId, """ + R4("avg(rating)") + """ AS vote_average, CAST(count(rating) AS INTEGER) AS vote_count
FROM ratings_raw GROUP BY movieId"""

ORACLES["mart_ratings"] = _with(RATINGS_RAW) + "SELECT userId, movieId, rating FROM ratings_raw"

ORACLES["mart_movies"] = _with(RATINGS_RAW) + f""",
votes AS (SELECT movieId, avg(rating) AS va, CAST(count(rating) AS INTEGER) AS vc FROM ratings_raw GROUP BY movieId),
m AS (SELECT o.*, {IMDB} AS imdb FROM orders o)
SELECT CAST(o_orderkey AS INTEGER) AS id, substring(imdb, 3) AS imdb_id,
  'site/' || CAST(o_orderkey AS VARCHAR) AS homepage, 'Order ' || CAST(o_orderkey AS VARCHAR) AS original_title,
  o_orderpriority || chr(10) || '"' || o_orderstatus || '", said ' || CAST(o_custkey AS VARCHAR) AS overview,
  o_totalprice / 1000 AS popularity, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS release_date,
  CASE WHEN floor(o_totalprice * 10000) <= 2147483647 THEN CAST(floor(o_totalprice * 10000) AS INTEGER) END AS revenue, 90.0 + o_totalprice % 60 AS runtime,
  o_orderstatus AS status, 'Movie ' || CAST(o_orderkey AS VARCHAR) AS title,
  {R4("v.va")} AS vote_average, v.vc AS vote_count
FROM m LEFT JOIN votes v ON v.movieId = CAST(o_orderkey AS INTEGER)
WHERE imdb NOT IN ('0', 'tt0113002', 'tt2423504', 'tt2622826')"""

_star = []
for _name, (_key, _label, _extra, _deny) in _ENTITY_SQL.items():
    _src = "items JOIN kept ON kept.o_orderkey = items.l_orderkey" if _deny else "items"
    _star.append(f"SELECT '{_name}_ext' AS \"table\", count(*) AS \"rows\" FROM (SELECT DISTINCT {_key}, {_label} FROM {_src})")
    _star.append(f"SELECT '{_name}_movies_ext', count(*) FROM {_src}")
_star.append("SELECT 'ratings_ext', count(*) FROM lineitem")
_star.append("SELECT 'movies_table_ext', count(*) FROM kept")
ORACLES["mart_star_counts"] = _with(ITEMS, KEPT) + "\nUNION ALL\n".join(_star)

_GENRE_DIM = """genre_names AS (SELECT DISTINCT unnest(string_split(genres, '|')) AS genre_name FROM raw_movies),
genre_dim AS (SELECT CAST(row_number() OVER (ORDER BY genre_name) AS INTEGER) AS genre_id, genre_name FROM genre_names)"""

ORACLES["mart_genre_dim"] = _with(RAW_MOVIES, _GENRE_DIM) + "SELECT genre_id, genre_name FROM genre_dim"

ORACLES["mart_genre_refresh"] = _with(RAW_MOVIES) + """
, one AS (SELECT CAST(row_number() OVER (ORDER BY g) AS INTEGER) AS genre_id, g AS genre_name
  FROM (SELECT DISTINCT split_part(genres, '|', 1) AS g FROM raw_movies)),
new AS (SELECT DISTINCT unnest(string_split(genres, '|')) AS g FROM raw_movies),
two AS (SELECT * FROM one UNION ALL
  SELECT CAST((SELECT max(genre_id) FROM one) + row_number() OVER (ORDER BY g) AS INTEGER), g FROM new
  WHERE g NOT IN (SELECT genre_name FROM one))
SELECT genre_id, genre_name, 1 AS load FROM one UNION ALL SELECT genre_id, genre_name, 2 FROM two"""


def _genre_ids_sql(distinct: bool) -> str:
    agg = "list(DISTINCT genre_id)" if distinct else "list(genre_id)"
    return _with(RAW_MOVIES, _GENRE_DIM) + f""",
m AS (SELECT movie_id, {title_sql('t')} AS title, {year_sql('t')} AS movie_year,
        unnest(string_split(genres, '|')) AS g FROM raw_movies)
SELECT movie_id, title, movie_year, array_to_string(list_sort({agg}), ',') AS genre_ids
FROM m JOIN genre_dim ON genre_dim.genre_name = m.g GROUP BY movie_id, title, movie_year"""


ORACLES["mart_genre_ids"] = _genre_ids_sql(True)
ORACLES["mart_genre_ids_list"] = _genre_ids_sql(False)
