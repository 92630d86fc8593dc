"""Token counts are found inside the row; only rows that share an id are exchanged."""

from pyspark.sql import functions as F

from lakemart.operators import text as TX
from plan_report import plan_text


def test_token_counts_move_tokens_only_where_rows_share_an_id(spark):
    rows = [(1, "b a b"), (2, "a"), (None, "x y"), (3, None), (4, "")]
    schema = "ArticleID long, Text string"
    alone = TX.token_counts(spark.createDataFrame(rows, schema))
    assert " Exchange (" not in plan_text(alone)
    want = {(1, "a", 1, 1, 1), (1, "b", 2, 0, 2), (2, "a", 1, 0, 0), (None, "x", 1, 0, 0), (None, "y", 1, 1, 1), (4, "", 1, 0, 0)}
    assert {tuple(r) for r in alone.collect()} == want
    more = spark.createDataFrame([*rows, (2, "c a"), (None, "y"), (2, None)], schema)
    got = TX.token_counts(more)
    assert {tuple(r) for r in got.collect()} == want - {(2, "a", 1, 0, 0), (None, "y", 1, 1, 1)} | {
        (2, "a", 2, 0, 1), (2, "c", 1, 0, 0), (None, "y", 2, 0, 1)}
    plain = (TX.tokenize(more, keep=["ArticleID"]).groupBy("ArticleID", "token")
             .agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos")))
    assert got.dtypes == plain.dtypes and sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))
