"""Deterministic draws and exact, skew-safe row numbering.

``draw_key`` replaces ``rand()``-based sampling: an md5 over a seed and the row
key, which any SQL engine with ``md5`` can repeat.

``global_index`` gives an exact ``row_number`` over a total order without the
single-partition window that ``row_number().over(Window.orderBy(..))`` plans:

1. ``repartitionByRange(n, order)`` cuts the rows into ``n`` contiguous key
   ranges (Spark samples the split points);
2. the range id is written *with the rows* as a Parquet table in the shared
   checkpoint folder, so every later read sees the same ranges — re-sampling,
   AQE re-planning or a lost executor cannot move a row to another range;
3. a table of range sizes (``n`` rows, broadcast) gives each range its offset,
   and a window partitioned by range id numbers the rows inside it.

Work per task is about ``rows / n``; the driver only sees range boundaries.
``index_within`` puts the group columns first in the order, so a group that
holds a third of all rows is spread over many ranges instead of landing in one
window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw_key(seed: int, *cols) -> Column:
    """Seeded, repeatable pseudo-random order key (hex string)."""
    parts = [F.lit(str(seed))] + [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def global_index(df: DataFrame, order: Sequence[str], name: str = "rn", ranges: int | None = None,
                 total_col: str | None = None) -> DataFrame:
    """Exact 1-based ``row_number`` over ascending ``order`` columns (which must
    form a total order).  ``total_col`` also attaches the total row count.
    The input is landed first, so that finding the split points and writing the
    ranges read a table and do not evaluate the input plan twice."""
    from ..session import cut_lineage
    spark = df.sparkSession
    n = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    names = list(order)
    df = cut_lineage(df, "index-input")
    landed = cut_lineage(df.repartitionByRange(n, *names).withColumn("_r", F.spark_partition_id()), "index")
    sizes = landed.groupBy("_r").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("_n").over(Window.partitionBy()).alias(total_col)] if total_col else []
    offsets = sizes.select("_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"), *extra)
    local = landed.withColumn("_pos", F.row_number().over(Window.partitionBy("_r").orderBy(*names)))
    return (local.join(F.broadcast(offsets), "_r")           # one row per range: bounded by ranges
            .withColumn(name, F.col("_off") + F.col("_pos"))
            .drop("_r", "_pos", "_off"))


def index_within(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "rn",
                 ranges: int | None = None, size_col: str | None = None) -> DataFrame:
    """Exact ``row_number() over (partition by group order by order)``, skew-safe.
    ``size_col`` also attaches the group's row count (same aggregate)."""
    g = list(group)
    if not g:
        return global_index(df, order, name, ranges, total_col=size_col)
    from .joins import join_null_safe
    indexed = global_index(df, [*g, *order], "_gix", ranges)
    extra = [F.count(F.lit(1)).alias(size_col)] if size_col else []
    firsts = indexed.groupBy(*g).agg(F.min("_gix").alias("_first"), *extra)
    return (join_null_safe(indexed, firsts, g)
            .withColumn(name, F.col("_gix") - F.col("_first") + 1)
            .drop("_gix", "_first"))


def balanced_part(rn: Column, total: Column, parts: int) -> Column:
    """0-based part of row ``rn`` (1-based) when ``total`` rows are cut into
    ``parts`` contiguous ranges whose sizes differ by at most one, larger first
    (same rule as ``ntile``)."""
    q = F.floor(total / parts)
    r = total - q * parts
    big = r * (q + 1)
    return (F.when(rn <= big, F.floor((rn - 1) / (q + 1)))
            .otherwise(r + F.floor((rn - 1 - big) / F.greatest(q, F.lit(1))))).cast("int")
