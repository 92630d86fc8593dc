"""SQL oracles of the application queries."""

from __future__ import annotations

from ..functions.fixed import STOPWORDS, TOKEN_SPLIT_SPEC, TOKEN_SPLIT_STRICT
from .oracles import R4, INFO, INFO_ALL, IMDB, ITEMS, KEPT, ORACLES, POWERS, STATS, STATS_ALL, TOP_HEROES, _with
from .q_apps import BRACKETS, LABEL_LIMIT, SHARDS, SPLIT, TEAMS


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SPLIT_RE = _lit(TOKEN_SPLIT_STRICT)

ORACLES["text_tokens"] = f"""
SELECT doc_id AS ArticleID, CAST(len(string_split_regex(text, {SPLIT_RE})) AS INTEGER) AS n_tokens,
  CAST(len(list_filter(string_split_regex(text, {SPLIT_RE}), lambda x: x <> '')) AS INTEGER) AS n_nonempty
FROM documents"""

ORACLES["text_token_counts"] = f"""
WITH t AS (SELECT doc_id AS ArticleID, string_split_regex(text, {SPLIT_RE}) AS ts FROM documents),
p AS (SELECT ArticleID, unnest(ts) AS token, unnest(range(len(ts))) AS pos FROM t)
SELECT ArticleID, token, count(*) AS n, CAST(min(pos) AS INTEGER) AS first_pos, CAST(max(pos) AS INTEGER) AS last_pos
FROM p GROUP BY ArticleID, token"""

_stop = ", ".join(_lit(w) for w in dict.fromkeys(STOPWORDS))
def _keywords_sql(pattern: str) -> str:
    return f"""
WITH t AS (SELECT doc_id AS ArticleID, lang AS Category, unnest(string_split_regex(text, {pattern})) AS token
           FROM documents),
f AS (SELECT * FROM t WHERE length(token) >= 3 AND NOT regexp_matches(token, '^\\d+(\\.\\d+)?$')
      AND token NOT IN ({_stop})),
c AS (SELECT ArticleID, Category, token, count(*) AS Frequency FROM f GROUP BY ArticleID, Category, token
      HAVING count(*) >= 10)
SELECT ArticleID, Category, token AS Tag, Frequency FROM (
  SELECT *, row_number() OVER (PARTITION BY ArticleID ORDER BY Frequency DESC, token) AS r FROM c) WHERE r <= 3"""


ORACLES["text_keywords"] = _keywords_sql(SPLIT_RE)
ORACLES["text_keywords_spec"] = _keywords_sql(_lit(TOKEN_SPLIT_SPEC))

ORACLES["top_by_alignment"] = _with(STATS_ALL, INFO_ALL, TOP_HEROES) + "SELECT * FROM top_heroes"

ALIGNED = """names AS (SELECT name FROM stats_t UNION SELECT name FROM info UNION SELECT name FROM powers),
s AS (SELECT n.name, coalesce(intelligence, 0) AS intelligence, coalesce(strength, 0) AS strength,
  coalesce(speed, 0) AS speed, coalesce(durability, 0) AS durability, coalesce(power, 0) AS power,
  coalesce(combat, 0) AS combat, coalesce(total, 0) AS total FROM names n LEFT JOIN stats_t USING (name)),
i AS (SELECT n.name, CASE WHEN coalesce(height, 0) > 0 THEN height ELSE 0 END AS height
  FROM names n LEFT JOIN info USING (name)),
p AS (SELECT n.name, coalesce(flight, false) AS flight FROM names n LEFT JOIN powers USING (name))"""

_K = TEAMS["n_teams"] * TEAMS["size"]
DRAWN = f"""drawn AS (SELECT *, CAST((rn - 1) // {TEAMS['size']} AS INTEGER) AS team,
  CAST((rn - 1) % {TEAMS['size']} + 1 AS INTEGER) AS slot
  FROM (SELECT s.*, row_number() OVER (ORDER BY md5('{TEAMS['seed']}|' || name), name) AS rn FROM s) WHERE rn <= {_K})"""

ROLES = """lead AS (SELECT team, name AS leader FROM (SELECT team, name,
    row_number() OVER (PARTITION BY team ORDER BY intelligence DESC, name) AS r FROM drawn) WHERE r = 1),
tank AS (SELECT team, name AS tank FROM (SELECT d.team, d.name,
    row_number() OVER (PARTITION BY d.team ORDER BY d.strength + d.durability DESC, d.name) AS r
    FROM drawn d JOIN lead l ON l.team = d.team WHERE d.name <> l.leader) WHERE r = 1),
dmg AS (SELECT team, name AS damage FROM (SELECT d.team, d.name,
    row_number() OVER (PARTITION BY d.team ORDER BY d.speed + d.power + d.combat DESC, d.name) AS r
    FROM drawn d JOIN lead l ON l.team = d.team JOIN tank t ON t.team = d.team
    WHERE d.name <> l.leader AND d.name <> t.tank) WHERE r = 1),
oth AS (SELECT d.team, list(d.name ORDER BY d.name) AS o FROM drawn d JOIN lead l ON l.team = d.team
    JOIN tank t ON t.team = d.team JOIN dmg m ON m.team = d.team
    WHERE d.name <> l.leader AND d.name <> t.tank AND d.name <> m.damage GROUP BY d.team),
strong AS (SELECT team, name AS strongest FROM (SELECT team, name, row_number() OVER (PARTITION BY team
    ORDER BY intelligence + strength + speed + durability + power + combat DESC, name) AS r FROM drawn) WHERE r = 1),
spd AS (SELECT team, avg(speed) AS v FROM (SELECT team, speed,
    row_number() OVER (PARTITION BY team ORDER BY speed DESC) AS r FROM drawn) WHERE r <= 3 GROUP BY team),
hgt AS (SELECT team, avg(height) AS v FROM (SELECT d.team, i.height,
    row_number() OVER (PARTITION BY d.team ORDER BY i.height DESC) AS r FROM drawn d JOIN i ON i.name = d.name)
    WHERE r <= 3 GROUP BY team),
fly AS (SELECT d.team, CAST(count(*) FILTER (WHERE p.flight) AS INTEGER) AS v FROM drawn d
    JOIN p ON p.name = d.name GROUP BY d.team),
teams AS (SELECT 'Team: ' || strongest AS team_name, leader, tank, damage, o[1] AS the_other_guy,
    o[2] AS the_other_guy2, spd.v AS top_average_speed, hgt.v AS top_average_height, fly.v AS flight_count
  FROM lead JOIN tank USING (team) JOIN dmg USING (team) LEFT JOIN oth USING (team) JOIN strong USING (team)
  JOIN spd USING (team) JOIN hgt USING (team) JOIN fly USING (team))"""

TEAM_SQL = _with(STATS, INFO, POWERS, ALIGNED, DRAWN, ROLES)

ORACLES["roster_align"] = _with(STATS, INFO, POWERS, ALIGNED) + """
SELECT s.name, s.total, i.height, p.flight FROM s JOIN i USING (name) JOIN p USING (name)"""

ORACLES["roster_draw"] = _with(STATS, INFO, POWERS, ALIGNED, DRAWN) + "SELECT name, team, slot FROM drawn"

ORACLES["roster_teams"] = TEAM_SQL + """
SELECT team_name, leader, tank, damage, the_other_guy, the_other_guy2,
  """ + R4("top_average_speed") + """ AS top_average_speed,
  """ + R4("top_average_height") + """ AS top_average_height, flight_count FROM teams"""

_N = BRACKETS["n"]
B1 = f"""b1 AS (SELECT team_name, top_average_speed, top_average_height, flight_count,
  CAST(least(floor((rn - 1) / greatest(floor(cnt / {_N}), 1)), {_N - 1}) AS INTEGER) AS bracket
  FROM (SELECT t.*, row_number() OVER (ORDER BY md5('{BRACKETS['seed']}|' || team_name), team_name) AS rn,
        count(*) OVER () AS cnt FROM teams t))"""


def _round(r: int) -> str:
    return f"""pairs{r} AS (SELECT a.bracket, a.team_name AS team_a, b.team_name AS team_b,
    CAST(CAST(a.top_average_speed > b.top_average_speed AS INTEGER)
       + CAST(a.top_average_height > b.top_average_height AS INTEGER) + a.flight_count AS INTEGER) AS team_a_score,
    CAST(CAST(b.top_average_speed > a.top_average_speed AS INTEGER)
       + CAST(b.top_average_height > a.top_average_height AS INTEGER) + b.flight_count AS INTEGER) AS team_b_score
  FROM b{r} a JOIN b{r} b ON a.bracket = b.bracket AND a.team_name < b.team_name),
wins{r} AS (SELECT bracket, CASE WHEN team_a_score >= team_b_score THEN team_a ELSE team_b END AS team_name,
    count(*) AS wins FROM pairs{r} GROUP BY 1, 2),
win{r} AS (SELECT bracket, team_name AS winner, wins FROM (SELECT m.bracket, m.team_name,
    coalesce(w.wins, 0) AS wins, row_number() OVER (PARTITION BY m.bracket
      ORDER BY coalesce(w.wins, 0) DESC, m.team_name) AS rr
    FROM b{r} m LEFT JOIN wins{r} w ON w.bracket = m.bracket AND w.team_name = m.team_name) WHERE rr = 1),
b{r + 1} AS (SELECT t.team_name, t.top_average_speed, t.top_average_height, t.flight_count,
    CAST(floor(w.bracket / 2) AS INTEGER) AS bracket FROM win{r} w JOIN teams t ON t.team_name = w.winner)"""


TOUR_SQL = TEAM_SQL + ",\n" + B1 + ",\n" + _round(1) + ",\n" + _round(2) + ",\n" + _round(3) + "\n"

ORACLES["tour_brackets"] = TOUR_SQL + "SELECT team_name, bracket FROM b1"
ORACLES["tour_pairs"] = TOUR_SQL + "SELECT bracket, team_a, team_b FROM pairs1"
ORACLES["tour_scores"] = TOUR_SQL + "SELECT bracket, team_a, team_b, team_a_score, team_b_score FROM pairs1"
ORACLES["tour_bracket_winner"] = TOUR_SQL + "SELECT bracket, winner, wins FROM win1"
ORACLES["tour_final"] = TOUR_SQL + """
SELECT 1 AS round, bracket, winner, wins FROM win1 UNION ALL
SELECT 2, bracket, winner, wins FROM win2 UNION ALL
SELECT 3, bracket, winner, wins FROM win3"""

ORACLES["cogroup_grades"] = """
WITH mid AS (SELECT 'Student' || CAST(o_custkey AS VARCHAR) AS student, CAST(floor(o_totalprice) % 101 AS DOUBLE) AS g
             FROM orders WHERE o_orderstatus = 'F' OR (o_orderstatus <> 'O' AND o_orderkey % 2 = 0)),
proj AS (SELECT 'Student' || CAST(o_custkey AS VARCHAR) AS student, CAST(floor(o_totalprice) % 101 AS DOUBLE) AS g
         FROM orders WHERE o_orderstatus = 'O' OR (o_orderstatus <> 'F' AND o_orderkey % 2 = 1)),
m AS (SELECT student, min(g) AS g FROM mid GROUP BY student),
p AS (SELECT student, min(g) AS g FROM proj GROUP BY student),
j AS (SELECT coalesce(m.student, p.student) AS student, coalesce(m.g, 0.0) AS midterm, coalesce(p.g, 0.0) AS project
      FROM m FULL JOIN p ON m.student = p.student)
SELECT student, midterm, project, (midterm + project) / 2.0 AS avg_grade, (midterm + project) / 2.0 >= 50.0 AS passed,
  student || CASE WHEN (midterm + project) / 2.0 >= 50.0 THEN ' has passed the subject with avg grade of '
                  ELSE ' has failed the subject with avg grade of ' END || CAST((midterm + project) / 2.0 AS VARCHAR)
    AS message
FROM j"""

PAIRS = f"""pairs AS (SELECT substring({IMDB}, 3) AS imdb_id, items.p_name AS genre
  FROM orders JOIN kept USING (o_orderkey) JOIN items ON items.l_orderkey = o_orderkey)"""
SHARDED = f"""sharded AS (SELECT imdb_id, genre,
  CAST(ntile({SHARDS}) OVER (ORDER BY imdb_id, genre) - 1 AS INTEGER) AS shard FROM pairs)"""

ORACLES["label_pairs"] = _with(ITEMS, KEPT, PAIRS) + f"SELECT imdb_id, genre FROM pairs ORDER BY imdb_id, genre LIMIT {LABEL_LIMIT}"
ORACLES["label_shards"] = _with(ITEMS, KEPT, PAIRS, SHARDED) + "SELECT imdb_id, genre, shard FROM sharded"
ORACLES["label_fetch_plan"] = _with(ITEMS, KEPT, PAIRS, SHARDED) + """
SELECT shard, imdb_id, genre, CASE WHEN nth = 1 THEN 'fetch' WHEN genre = f OR again > 1 THEN 'present' ELSE 'copy' END AS action,
  'images/' || genre || '/' || imdb_id || '.jpg' AS target,
  CASE WHEN nth > 1 AND again = 1 AND genre <> f THEN 'images/' || f || '/' || imdb_id || '.jpg' END AS source
FROM (SELECT *, min(genre) OVER (PARTITION BY shard, imdb_id) AS f,
  row_number() OVER (PARTITION BY shard, imdb_id ORDER BY genre) AS nth,
  row_number() OVER (PARTITION BY shard, imdb_id, genre) AS again FROM sharded)"""
ORACLES["label_pairs_all"] = _with(ITEMS, KEPT, PAIRS) + "SELECT imdb_id, genre FROM pairs"
ORACLES["label_dictionary"] = _with(ITEMS, KEPT, PAIRS) + """
SELECT genre, CAST(row_number() OVER (ORDER BY genre) - 1 AS INTEGER) AS label_index, n_items
FROM (SELECT genre, count(*) AS n_items FROM pairs GROUP BY genre)"""
ORACLES["label_split"] = f"""
SELECT vec_id, label, CASE WHEN rn <= floor(n * {SPLIT['fraction']}) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT vec_id, label,
  row_number() OVER (PARTITION BY label ORDER BY md5('{SPLIT['seed']}|' || CAST(vec_id AS VARCHAR)), vec_id) AS rn,
  count(*) OVER (PARTITION BY label) AS n FROM embeddings)"""
ORACLES["label_ranking_check"] = """
SELECT vec_id, (SELECT CAST(max(label) + 1 AS BIGINT) FROM embeddings) AS n_labels, true AS ranks_ok,
  true AS sums_to_one, true AS best_first, true AS first_is_prediction FROM embeddings"""

ORACLES["label_classifier_check"] = """
SELECT count(*) AS "rows", count(DISTINCT label) AS labels, true AS converged, true AS better_than_null, true AS locally_best
FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL"""
