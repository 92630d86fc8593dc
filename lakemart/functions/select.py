"""Exact order statistics without sorting or landing the rows.

``cuts`` finds the rows at several ranks of a total order at once: sampled
splitters cut the key space, exact counts per range say which range holds each
rank, and only those ranges are refined until they are small enough to fetch.

``group_cuts`` finds, per group, the draw at a given rank: a radix histogram of the
draws' leading hex digits, then the distinct draws of the one bin that holds it.

Both move counts and a bounded number of keys, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_null_safe

#: splitters per open range and round, and rows of a range that may be fetched
SPLITTERS, SAMPLED, FETCH = 63, 2048, 20_000


@dataclass(frozen=True)
class Cut:
    """The key at one rank: its values, the rows below it and the rows equal to it."""
    key: tuple
    below: int
    ties: int


def _key(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)])


def _literal(values, types) -> Column:
    return F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(values, types))])


def _bucket(key: Column, splitters: list[Column], base: int = 0) -> Column:
    """Number of splitters at or below the key, as a balanced tree of comparisons."""
    if not splitters:
        return F.lit(base)
    mid = len(splitters) // 2
    return F.when(key < splitters[mid], _bucket(key, splitters[:mid], base)).otherwise(
        _bucket(key, splitters[mid + 1:], base + mid + 1))


def cuts(df: DataFrame, order: Sequence[str], ranks: Sequence[int], total: int | None = None, seed: int = 7) -> list[Cut]:
    """The ``Cut`` at each 1-based rank of ``order`` (NULLs first); ranks must be
    between 1 and the number of rows.

    Eager.  ``df`` is evaluated once for the count (unless ``total`` is given), and a
    round once to fetch all small ranges and twice (sample, counts) for all large ones
    together; a round cuts every open range by
    about ``SPLITTERS``, so ``n`` rows take ``log(n / FETCH) / log(SPLITTERS)`` rounds
    (none up to ``FETCH`` rows, one up to a million, three up to ten billion).  The
    driver sees at most ``2 * SAMPLED`` sampled keys a round and range, and the distinct
    keys of the fetched ranges.  A key that holds most rows ends its range at once:
    it becomes a splitter, and a range that is one key is not refined."""
    names = list(order)
    types = [df.schema[c].dataType for c in names]
    keys = df.select(_key(names).alias("k"))
    if not ranks:
        return []
    if total is None:
        total = df.count()
    # an open range: (low, high, rows below it, rows in it, its ranks); low <= key < high
    open_ranges = [(None, None, 0, total, sorted(set(ranks)))]
    found: dict[int, Cut] = {}
    while open_ranges:
        small = [r for r in open_ranges if r[3] <= FETCH]
        large = [r for r in open_ranges if r[3] > FETCH]
        if small:                                       # all of them in one pass, in key order
            small.sort(key=lambda r: r[2])
            within = keys.where(reduce(or_, [_inside(low, high, types) for low, high, *_ in small]))
            fetched = iter(within.groupBy("k").count().orderBy("k").collect())
            for _, _, below, rows, wanted in small:
                at = below
                while at < below + rows:
                    row = next(fetched)
                    for r in wanted:
                        if at < r <= at + row["count"]:
                            found[r] = Cut(tuple(row["k"]), at, row["count"])
                    at += row["count"]
        open_ranges = []
        if large:
            # a range's sample and counts go by its number; ranges hold no key in common
            at_range = F.coalesce(*[F.when(_inside(low, high, types), F.lit(i)) for i, (low, high, *_) in enumerate(large)])
            inside = keys.withColumn("r", at_range).where(F.col("r").isNotNull())
            share = F.element_at(F.array(*[F.lit(SAMPLED / rows) for *_, rows, _ in large]), F.col("r") + 1)
            sampled: list[list] = [[] for _ in large]
            for row in (inside.where(F.rand(seed) < share).limit(2 * SAMPLED * len(large))
                        .groupBy("r", "k").count().orderBy("r", "k").collect()):
                sampled[row["r"]].append(row)
            split = [_points(keys, r, sample, types) for r, sample in zip(large, sampled)]
            counts = {}
            if any(split):
                bucket = F.coalesce(*[F.when(F.col("r") == i, _bucket(F.col("k"), [_literal(p, types) for p in points]))
                                      for i, points in enumerate(split) if points])
                counts = {(r["r"], r["b"]): r["count"] for r in inside.groupBy("r", bucket.alias("b")).count().collect()}
            for i, ((low, high, below, rows, wanted), points) in enumerate(zip(large, split)):
                if not points:                          # the range is one key
                    key = tuple(keys.where(_inside(low, high, types)).agg(F.min("k").alias("k")).first()["k"])
                    found.update({r: Cut(key, below, rows) for r in wanted})
                    continue
                edges, at = [low, *points, high], below
                for b in range(len(points) + 1):
                    n = counts.get((i, b), 0)
                    here = [r for r in wanted if at < r <= at + n]
                    if here:
                        open_ranges.append((edges[b], edges[b + 1], at, n, here))
                    at += n
        seed += 1
    return [found[r] for r in ranks]


def _points(keys: DataFrame, open_range: tuple, sample: list, types) -> list[tuple]:
    """The splitters of an open range from its sample; none if it is one key."""
    low, high, *_ = open_range
    seen, step, points = 0, max(1, sum(r["count"] for r in sample) // (SPLITTERS + 1)), []
    for i, row in enumerate(sample):
        heavy = row["count"] >= 2 * step
        if heavy or seen // step != (seen + row["count"]) // step:
            points.append(tuple(row["k"]))
            if heavy and i + 1 < len(sample):
                points.append(tuple(sample[i + 1]["k"]))   # so that a heavy key is a range of its own
        seen += row["count"]
    points = [p for p in dict.fromkeys(points) if p != low]
    if points:
        return points
    inside = keys.where(_inside(low, high, types))         # the sample shows one key only: split it off
    least = low if low is not None else tuple(inside.agg(F.min("k").alias("k")).first()["k"])
    after = inside.where(F.col("k") > _literal(least, types)).agg(F.min("k").alias("k")).first()["k"]
    return [] if after is None else [tuple(after)]


def _inside(low, high, types) -> Column:
    key = F.col("k")
    out = F.lit(True)
    if low is not None:
        out = out & (key >= _literal(low, types))
    if high is not None:
        out = out & (key < _literal(high, types))
    return out


def place(df: DataFrame, order: Sequence[str], ends: Sequence[int], name: str, total: int | None = None) -> DataFrame:
    """Adds ``name``: the 0-based part of each row when the rows in ``order`` are cut
    after the ranks ``ends`` (ascending).  Row-local comparisons with literal cuts; only
    rows equal to a cut key that the cut divides are counted out, from their distinct
    rows, so that a repeated row never meets in one task."""
    names = list(order)
    if total is None:
        total = df.count()
    inner = [e for e in ends if 0 < e < total]
    found = dict(zip(inner, cuts(df, names, inner, total)))
    types = [df.schema[c].dataType for c in names]
    key = _key(names)
    divided = {c.key: c for e, c in found.items() if e < c.below + c.ties}
    part = F.lit(sum(1 for e in ends if e <= 0))
    for e, c in found.items():
        part = part + (key > _literal(c.key, types)).cast("int")
    if not divided:
        return df.withColumn(name, part.cast("int"))
    marks = [_literal(k, types) for k in divided]
    tied = F.lit(False)
    for m in marks:
        tied = tied | (key == m)
    rows = df.where(tied).groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*[F.col(f"`{c}`") for c in names]).orderBy(
        *[F.col(f"`{c}`") for c in df.columns if c not in names]) if len(df.columns) > len(names) else None
    upto = F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)) if before is not None else F.col("_n")
    below = F.lit(0)
    for k, m in zip(divided, marks):
        below = F.when(key == m, F.lit(divided[k].below)).otherwise(below)
    rows = rows.withColumn("_to", upto + below).withColumn("_rank", F.explode(F.sequence(F.col("_to") - F.col("_n") + 1, F.col("_to"))))
    exact = F.lit(0)
    for e in ends:
        exact = exact + (F.col("_rank") > e).cast("int")
    rows = rows.withColumn(name, exact.cast("int")).drop("_n", "_to", "_rank")
    return df.where(~tied).withColumn(name, part.cast("int")).unionByName(rows)


#: leading hex digits of a draw: of the histogram, and of the salt that spreads a hot group
DIGITS, SALT_DIGITS = 4, 2


def group_cuts(df: DataFrame, group: str, draw: str, rank: Column) -> DataFrame:
    """(group, cut): per group the draw (hex text) of the row at ``rank``, an
    expression over the group's row count ``n``; no row where it is below 1.

    ``df`` is evaluated twice, as (group, draw) only: once for the histogram, once for
    the rows in each group's open bin.  Rows are counted where they are read; a
    group with a third of all rows has its counts spread over its bins."""
    narrow = df.select(F.col(f"`{group}`").alias("g"), F.col(draw).alias("d"), F.substring(draw, 1, DIGITS).alias("bin"))
    along = Window.partitionBy("g").orderBy("bin")
    hist = narrow.groupBy("g", "bin").agg(F.count(F.lit(1)).alias("c"))
    hist = (hist.withColumn("upto", F.sum("c").over(along)).withColumn("n", F.sum("c").over(Window.partitionBy("g")))
            .withColumn("k", rank.cast("bigint")))
    picked = hist.where((F.col("k") >= 1) & (F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("c") < F.col("k")))
    picked = picked.select("g", "bin", (F.col("k") - F.col("upto") + F.col("c")).alias("left"))
    inner = join_null_safe(narrow, picked, ["g", "bin"]).groupBy("g", "d", "left").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("g").orderBy("d"))
    return (inner.withColumn("upto", upto).where(F.col("upto") >= F.col("left"))
            .groupBy("g").agg(F.min("d").alias("cut")).select(F.col("g").alias(group), "cut"))


def join_cuts(df: DataFrame, found: DataFrame, group: str, draw: str) -> DataFrame:
    """Left join of each row's group cut, spread over the draws' leading digits so
    that a group with a third of all rows is not one key."""
    salts = F.array(*[F.lit(f"{i:0{SALT_DIGITS}x}") for i in range(16 ** SALT_DIGITS)])
    spread = found.withColumn("_salt", F.explode(salts))
    return join_null_safe(df.withColumn("_salt", F.substring(draw, 1, SALT_DIGITS)), spread, [group, "_salt"], "left").drop("_salt")
