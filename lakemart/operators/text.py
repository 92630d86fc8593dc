"""Keyword tagging: the k most frequent tokens of each document.

Plan with the built-in stop list: everything happens inside the row.  The
filtered tokens of a text are sorted, run lengths come from the positions where
the token changes, and the first k runs are kept: no exchange, and neither texts
nor tokens are shuffled.  A caller's stop list is a table of any size: then
(document, category, token) counts are joined against it and ranked per document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import STOPWORDS
from ..functions.text import is_number, tokens
from .ranking import top_k_per_group


def tokenize(df: DataFrame, text: str = "Text", mode: str = "strict", keep: Sequence[str] = (),
             counted: bool = False) -> DataFrame:
    """One row per token (with its position) of each document; with ``counted`` one
    row per distinct token of each document row: its number ``n`` and its first and last
    position, found inside the row (tokens sorted with their positions, then runs)."""
    if not counted:
        return df.select(*keep, F.posexplode(tokens(text, mode)).alias("pos", "token"))
    n = F.size("_s")
    opens = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("_s", i)["t"] != F.get("_s", i - 1)["t"]))

    def run(p, j):
        end = F.coalesce(F.get("_o", j + 1), n)
        return F.struct(F.get("_s", p)["t"].alias("token"), (end - p).cast("bigint").alias("n"),
                        F.get("_s", p)["p"].alias("first_pos"), F.get("_s", end - 1)["p"].alias("last_pos"))

    rows = df.select(*keep, tokens(text, mode).alias("_t"))
    for name, step in [("_s", F.sort_array(F.transform("_t", lambda t, i: F.struct(t.alias("t"), i.alias("p"))))),
                       ("_o", F.when(n > 0, opens)), ("_r", F.transform("_o", run))]:
        rows = rows.withColumn(name, step)
    # the outer form: see ``keywords``
    return rows.select(*keep, F.explode_outer("_r").alias("r")).where("r is not null").select(*keep, "r.*")


def token_counts(df: DataFrame, doc: str = "ArticleID", text: str = "Text", mode: str = "strict") -> DataFrame:
    """(doc, token, n, first_pos, last_pos): every token of every document.

    A document is counted inside its row, and only where rows share an id (a NULL id
    is one too) their counts are added up.  So the ids are counted first (eager, ids
    alone are read); tokens of the other documents are never exchanged."""
    shared = df.groupBy(doc).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select(F.col(doc).alias("_shared"))
    if shared.isEmpty():
        return tokenize(df, text, mode, [doc], counted=True)
    same = F.col(doc).eqNullSafe(F.col("_shared"))
    once = tokenize(df.join(shared, same, "left_anti"), text, mode, [doc], counted=True)
    again = tokenize(df.join(shared, same, "left_semi"), text, mode, [doc], counted=True)
    return once.unionByName(again.groupBy(doc, "token").agg(
        F.sum("n").alias("n"), F.min("first_pos").alias("first_pos"), F.max("last_pos").alias("last_pos")))


def stopword_frame(spark: SparkSession, words: Sequence[str] = STOPWORDS) -> DataFrame:
    return spark.createDataFrame([(w,) for w in dict.fromkeys(words)], "token string")


def _row_keywords(tokens_col: Column, words: Sequence[str], min_len: int, min_freq: int, k: int) -> list[tuple[str, Column]]:
    """Steps ``(column, expression)`` from a token array to its top k ``(-count, token)`` structs."""
    plain = F.sort_array(F.filter(tokens_col, lambda t: (F.length(t) >= min_len) & ~is_number(t) & ~t.isin(*words)))
    n = F.size("_s")
    opens = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    runs = F.transform("_o", lambda p, j: F.struct((p - F.coalesce(F.get("_o", j + 1), n)).alias("c"), F.get("_s", p).alias("t")))
    return [("_s", plain),
            ("_o", F.when(n > 0, opens)),
            ("_r", F.slice(F.sort_array(F.filter(runs, lambda r: r["c"] <= -min_freq)), 1, k))]


def keywords(df: DataFrame, stop: DataFrame | None = None, min_len: int = 3, min_freq: int = 10,
             k: int = 3, doc: str = "ArticleID", category: str = "Category", text: str = "Text",
             mode: str = "strict") -> DataFrame:
    """(ArticleID, Category, Tag, Frequency): tokens not in the stop list
    (case-sensitive), at least ``min_len`` long, not numbers, seen at least
    ``min_freq`` times; the top k per document (ties: token).  Documents with
    no such token give no row, nor does a null text.  A row is a document; with a
    caller's stop list, rows of one id are counted together."""
    if stop is None:
        rows = df.select(doc, category, tokens(text, mode).alias("_t"))
        for name, step in _row_keywords(F.col("_t"), list(dict.fromkeys(STOPWORDS)), min_len, min_freq, k):
            rows = rows.withColumn(name, step)
        # the outer form: a filter on the list would be pushed down and evaluate every step again for each element
        return (rows.select(doc, category, F.explode_outer("_r").alias("r")).where("r is not null")
                .select(doc, category, F.col("r.t").alias("Tag"), (-F.col("r.c")).cast("bigint").alias("Frequency")))
    counts = (df.select(doc, category, F.explode(tokens(text, mode)).alias("token"))
              .where((F.length("token") >= min_len) & ~is_number("token"))
              .groupBy(doc, category, "token").agg(F.count(F.lit(1)).alias("Frequency")).where(F.col("Frequency") >= min_freq))
    counts = counts.join(stop.select(F.col(stop.columns[0]).alias("token")), "token", "left_anti")
    top = top_k_per_group(counts, [doc], [F.col("Frequency").desc(), F.col("token")], k)
    return top.select(doc, category, F.col("token").alias("Tag"), "Frequency")
