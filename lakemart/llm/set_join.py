"""Exact similarity of shingle sets: verification of pairs, and the prefix join
that finds pairs between components without meeting whole buckets.

``sets`` tables are ``(node, set)`` with distinct 64-bit shingle hashes; a node may
have several sets (rows that repeat an id), each is compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import drop, land


def common_counts(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, nx, ny, c): sizes of the two full sets of every pair and of what they share."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b"))
    return both.select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), F.size(F.array_intersect("x", "y")).alias("c"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) whose full sets reach ``percent`` Jaccard similarity."""
    return (common_counts(pairs, sets).where(F.col("c") * 100 >= (F.col("nx") + F.col("ny") - F.col("c")) * percent)
            .select("a", "b").distinct())


def prefix_pairs(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of nodes ``(node, c)`` of different components ``c``.

    With shingles in one order, two sets of the similarity share one among the first
    ``n - ceil(percent * n) + 1`` of each.  The order puts rare shingles first, so
    nodes that only share a frequent passage, or edited copies below the
    similarity, meet nowhere."""
    words = (sets.join(nodes, "node")
             .select("node", "c", F.xxhash64("set").alias("k"), F.size("set").alias("n"), F.explode("set").alias("s")))
    words, words_path = land(words, "set-words")
    one_set = Window.partitionBy("node", "k").orderBy("df", "s")
    ranked = (words.join(words.groupBy("s").agg(F.count(F.lit(1)).alias("df")), "s")
              .withColumn("r", F.row_number().over(one_set))
              .where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1))
    ranked, _ = land(ranked.select("s", "node", "c", "n", "r"), "set-prefixes")
    drop(nodes.sparkSession, words_path)
    x = ranked.select("s", F.col("node").alias("a"), F.col("c").alias("ca"), F.col("n").alias("na"),
                      F.col("r").alias("ra"))
    y = ranked.select("s", F.col("node").alias("b"), F.col("c").alias("cb"), F.col("n").alias("nb"),
                      F.col("r").alias("rb"))
    # behind their first common shingle two sets share at most what is left of the shorter rest
    most = F.least(F.col("na") - F.col("ra"), F.col("nb") - F.col("rb")) + 1
    return (x.join(y, "s").where("a < b and ca <> cb")
            .where(most * 100 >= (F.col("na") + F.col("nb") - most) * percent).select("a", "b").distinct())
