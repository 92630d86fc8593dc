"""Registered queries of ranked search, nearest neighbours and collocations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .collocations import collocations
from .lexical import search
from .neighbours import nearest
from .tables import query, table

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_lexical_search", oracle=f"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array({LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws
  FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, ws, CAST(len(ws) AS BIGINT) AS n FROM dw WHERE len(ws) > 0),
s AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM d),
iw AS (SELECT DISTINCT item_id, text,
         list_filter(regexp_split_to_array({LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws
       FROM benchmark),
i AS (SELECT r, item_id, t, count(*) AS c
      FROM (SELECT r, item_id, unnest(ws) AS t FROM (SELECT row_number() OVER () AS r, * FROM iw)) GROUP BY 1, 2, 3),
p AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(ws) AS t FROM d)
      WHERE t IN (SELECT t FROM i) GROUP BY 1, 2, 3, 4),
w AS (SELECT t, CAST(floor(1000 * ln((2 * max(nd) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
      FROM p, s GROUP BY t),
v AS (SELECT r, doc_id, p.t, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // nt))) AS v
      FROM p JOIN w ON w.t = p.t, s),
h AS (SELECT i.r AS q, item_id, v.r, doc_id, CAST(sum(c * v) AS BIGINT) AS score
      FROM i JOIN v ON v.t = i.t GROUP BY 1, 2, 3, 4),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM h WHERE score > 0)
SELECT * FROM k WHERE rank <= 10""")
def op11_lexical_search(spark, d):
    return search(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op12_nearest_neighbours")
def op12_nearest_neighbours(spark, d):
    return nearest(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op13_collocations", oracle=f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
t AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
u AS (SELECT lang, phrase, count(*) AS f FROM (SELECT lang, unnest(ws) AS phrase FROM t) GROUP BY 1, 2),
s AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM u GROUP BY 1),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
            FROM t, (SELECT unnest([2, 3, 4]) AS k) WHERE len(ws) >= k)),
c AS (SELECT lang, phrase, k, count(*) AS a FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 30),
f AS (SELECT lang, phrase, a AS f FROM c UNION ALL SELECT lang, phrase, f FROM u),
x AS (SELECT lang, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM c),
y AS (SELECT x.lang, x.phrase, a, j, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f) AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(w[1:j], ' ')
             JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(w[j + 1:], ' ')),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
v AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS b
      FROM (SELECT lang, w, m, a, unnest(range(1, len(w) - m + 2)) AS i
            FROM (SELECT lang, string_split(phrase, ' ') AS w, a, unnest(range(2, k)) AS m FROM c WHERE k > 2)) GROUP BY 1, 2),
q AS (SELECT z.lang, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, z.phrase) AS rank,
             z.phrase, a, l, r, n, CAST(score AS BIGINT) AS score
      FROM z JOIN s ON s.lang = z.lang LEFT JOIN v ON v.lang = z.lang AND v.phrase = z.phrase
      WHERE b IS NULL OR 100::HUGEINT * b < 80::HUGEINT * a)
SELECT * FROM q WHERE rank <= 2000""")
def op13_collocations(spark, d):
    return collocations(table(spark, d, "documents"))
