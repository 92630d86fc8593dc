"""Top-k per group and global top-k with total (tie-broken) orders.

``row_number() <= k`` over a partitioned window is planned by Catalyst with a
``WindowGroupLimit`` below the shuffle, so each map task ships at most k rows
per group: a hot group does not funnel its raw rows into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence, k: int,
                    rank_col: str | None = None) -> DataFrame:
    """Rows ranked 1..k inside each group by ``order`` (must end in a unique key)."""
    w = Window.partitionBy(*group).orderBy(*order)
    name = rank_col or "_rank"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def top_by_alignment(stats: DataFrame, info: DataFrame, publishers: Sequence[str],
                     n: int = 10, alignments: Sequence[str] = ("good", "bad")) -> DataFrame:
    """Top n by total inside the given publishers, separately per alignment:
    (alignment, name, score, gender, race, universe); ties -> name."""
    s = stats.select("name", F.col("total").alias("score"))
    i = (info.where(F.col("publisher").isin(list(publishers)) & F.col("alignment").isin(list(alignments)))
         .select("name", "alignment", "gender", "race", F.col("publisher").alias("universe")))
    joined = s.join(i, "name")
    top = top_k_per_group(joined, ["alignment"], [F.col("score").desc(), F.col("name")], n)
    return top.select("alignment", "name", "score", "gender", "race", "universe")
