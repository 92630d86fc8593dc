"""Connected components of a link table: union-find inside tasks, star contraction
across them (alternating large-star and small-star, each round written below
``spark.checkpoint.dir``).

1. Every task unites the links it has and keeps a forest, at most one link per node.
2. A forest of at most ``ONE_TASK`` links (16 bytes each, a checked bound) is united
   by one more task; a larger one goes through star rounds, each followed by 1.

Nothing is collected but counts.  Minima are pre-aggregated before each shuffle and
joined back on a unique key, so a hub with very many links is split by the adaptive
skew join instead of meeting in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop, land

ONE_TASK = 500_000


def unite(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) of the links ``u - v``, roots left out."""
    names, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(names))
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))      # hook larger roots on smaller ones
        while True:                                                      # and shorten every path to its root
            up = root[root]
            if (up == root).all():
                break
            root = up
    node = np.flatnonzero(root != np.arange(len(names)))
    return names[node], names[root[node]]


def _forest(batches):
    u, v, held = [], [], 0
    kept = 0
    for batch in batches:
        u.append(batch.column(0).to_numpy())
        v.append(batch.column(1).to_numpy())
        held += len(batch)
        if held > 2 * max(kept, 1 << 20):                                # a forest is what must be held
            u, v = ([x] for x in unite(np.concatenate(u), np.concatenate(v)))
            held = kept = len(u[0])
    if held:
        u, v = unite(np.concatenate(u), np.concatenate(v))
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def components(links: DataFrame, a: str = "a", b: str = "b", one_task: int = ONE_TASK) -> DataFrame:
    """(node, component): for every node of a link between different nodes the
    smallest node it can reach.  Null ends and self links are ignored; an empty
    link table gives an empty result."""
    edges = (links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
             .select(F.greatest(a, b).cast("bigint").alias("u"), F.least(a, b).cast("bigint").alias("v")))
    current, path = land(edges.mapInArrow(_forest, "u bigint, v bigint"), "links")
    spark = current.sparkSession
    n = current.count()
    seen = None
    while n > one_task:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        after, new = land(small.mapInArrow(_forest, "u bigint, v bigint").distinct(), "links")
        n, *mark = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop(spark, path)
        current, path = after, new
        if mark == seen:
            break
        seen = mark
    else:
        if n:
            after, new = land(current.coalesce(1).mapInArrow(_forest, "u bigint, v bigint"), "links")
            drop(spark, path)
            current = after
    roots = current.select("v").distinct()
    return (current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("component"))))
