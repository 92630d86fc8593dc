"""Registered queries of the scanning operators."""

from __future__ import annotations

from .decontaminate import contamination
from .licenses import oracle, scan_licenses
from .secrets import scan_documents
from .tables import query, table


@query("op2_decontaminate", oracle="""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
bk AS (SELECT item, ws, least(10, len(ws)) AS k FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item, k, array_to_string(ws[i:i + k - 1], ' ') AS g
       FROM (SELECT item, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM bk)),
dw AS (SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g
       FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
             FROM w, (SELECT DISTINCT k FROM bw) WHERE len(ws) >= k)),
h AS (SELECT doc_id, i, dw.k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
p AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS q FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS its
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(its, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN p ON p.doc_id = w.doc_id LEFT JOIN t ON t.doc_id = w.doc_id""")
def op2_decontaminate(spark, d):
    return contamination(table(spark, d, "documents"), table(spark, d, "benchmark")).drop("spans")


@query("op9_secret_ledger")
def op9_secret_ledger(spark, d):
    return scan_documents(table(spark, d, "documents"))


@query("op4_license_scan", oracle=oracle())
def op4_license_scan(spark, d):
    return scan_licenses(table(spark, d, "documents"))
