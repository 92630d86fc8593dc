"""Registered queries of the near-duplicate, paragraph and fingerprint operators."""

from __future__ import annotations

from .fingerprint import fingerprint_documents
from .near_dup import near_duplicates
from .paragraphs import repeated_paragraphs
from .tables import query, table


@query("op3_superminhash_dedup", oracle="""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
     WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
     ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * c >= 80 * (na.n_shingles + nb.n_shingles - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (WITH RECURSIVE t(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT t.a, u.b FROM t JOIN u ON u.a = t.b) SELECT * FROM t)
SELECT n.doc_id, n.n_shingles, min(r.b) AS component_id, n.doc_id = min(r.b) AS kept
FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n_shingles""")
def op3_superminhash_dedup(spark, d):
    return near_duplicates(table(spark, d, "documents"))


@query("op8_fingerprints")
def op8_fingerprints(spark, d):
    return fingerprint_documents(table(spark, d, "documents"))


@query("op7_paragraph_dedup")
def op7_paragraph_dedup(spark, d):
    return repeated_paragraphs(table(spark, d, "documents"))
