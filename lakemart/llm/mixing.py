"""Mixing sources to target weights by temperature.

With ``q`` the token share of a source, its weight is ``q ** a`` normalised.  The
exponent ``a`` (1: as the corpus, 0: all sources alike) is bisected so that the
mixture's entropy reaches a target between the corpus' own and the uniform one,
and raised, again by bisection, until no source is repeated more than
``max_repeats`` times.  A source of weight ``p`` gets ``floor(p * budget)``
tokens.

The budgets are realised as block permutations: documents are dealt to blocks of
about ``block_tokens`` tokens by a hash, blocks stand in a seeded order and so do
documents inside a block.  A source is read whole ``floor(budget / tokens)``
times, and what is left takes documents from the front of the permutation until
the next would exceed the budget.  One row per source (whole rounds, and the
place in the permutation where the last round ends) is all that a document
needs to know, so texts are never shuffled, and a hot source is one narrow row per
block in the only window over it.

``budget=None`` takes the smallest budget that reads every document at least
once: nothing is lost, only rare sources are repeated.

Defined results: null text has no tokens; a null source is a source of its own; a
source without tokens is read once; an empty table gives an empty result.  Rows
that repeat an id share its place in the permutation and its copies.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import land

CUTS = 15
ROUNDS = 6          # 16 ** 6 intervals of the exponent
MAX_BROADCAST_SOURCES = 100_000


@dataclass(frozen=True)
class Mixture:
    """Parameters of a mixture."""
    flatten: float = 0.5            # entropy target: share of the way from the corpus' entropy to the uniform one
    max_repeats: float = 4.0
    budget: int | None = None       # tokens; None: every document at least once
    block_tokens: int = 1 << 20
    seed: int = 17


def n_tokens(text: Column) -> Column:
    """White-space separated words."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _source(col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("null"))


def _moments(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """(Z, sum of q ** a * ln q) for each exponent, in one pass over the source table."""
    power = [F.pow("q", F.lit(a)) for a in exponents]
    aggs = [F.coalesce(F.sum(p), F.lit(0.0)) for p in power] + [F.coalesce(F.sum(p * F.log("q")), F.lit(0.0)) for p in power]
    row = sources.agg(*[a.alias(f"c{i}") for i, a in enumerate(aggs)]).first()
    return list(zip(row[:len(exponents)], row[len(exponents):]))


def _smallest(sources: DataFrame, holds) -> float:
    """Smallest exponent in [0, 1] for which ``holds(a, Z, S)`` (monotone), or 1:
    bisection with ``CUTS`` cuts a pass."""
    low, high = 0.0, 1.0
    if holds(0.0, *_moments(sources, [0.0])[0]):
        return 0.0
    for _ in range(ROUNDS):
        cuts = [low + (high - low) * (i + 1) / (CUTS + 1) for i in range(CUTS)]
        ok = [holds(a, *m) for a, m in zip(cuts, _moments(sources, cuts))]
        first = ok.index(True) if True in ok else CUTS
        low, high = ([low, *cuts][first], [*cuts, high][first])
    return round(high, 6)


def exponent(sources: DataFrame, mix: Mixture) -> float:
    """The mixture's exponent for a ``(source, tokens, q)`` table."""
    row = sources.agg(F.count(F.lit(1)).alias("n"), F.min("q").alias("lo"), F.max("q").alias("hi"),
                      F.sum("tokens").alias("t")).first()
    if not row["n"] or row["n"] == 1:
        return 1.0
    z, s = _moments(sources, [1.0])[0]
    own = math.log(z) - s / z
    target = own + mix.flatten * (math.log(row["n"]) - own)
    # entropy falls and repeats fall as the exponent grows
    by_entropy = _smallest(sources, lambda a, z, s: math.log(z) - a * s / z <= target + 1e-9)

    def repeats(a: float, z: float, _s: float) -> bool:
        if mix.budget is None:
            return (row["hi"] / row["lo"]) ** (1 - a) <= mix.max_repeats + 1e-9
        return row["lo"] ** (a - 1) / z * mix.budget / row["t"] <= mix.max_repeats + 1e-9
    return max(by_entropy, _smallest(sources, repeats))


def _keys(mix: Mixture, id_: Column, source: Column, tokens: Column) -> tuple[Column, Column]:
    """(order key of the block, order key in the block) of a document; the
    block's key is a hash of its number and so is the block's place."""
    blocks = F.greatest(F.lit(1), F.ceil(tokens / F.lit(mix.block_tokens))).cast("bigint")
    number = F.pmod(F.xxhash64(id_.cast("string"), F.lit(mix.seed)), blocks)
    return F.xxhash64(source, number, F.lit(mix.seed + 1)), F.xxhash64(id_.cast("string"), F.lit(mix.seed + 2))


def plan(docs: DataFrame, mix: Mixture = Mixture(), id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(one row per source, one narrow row per document row).

    Sources: ``s, tokens, weight, budget, rounds, end_block, end_doc, end_id`` where the last
    three name the first place of the permutation that the last round leaves out
    (null: all places).  Documents: ``id, s, n, block, place``."""
    rows = docs.select(F.col(id_col).alias("id"), _source(source_col).alias("s"),
                       n_tokens(F.col(text_col).cast("string")).alias("n"))
    rows, _ = land(rows, "mix-rows")
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sources, _ = land(rows.groupBy("s").agg(F.sum("n").alias("tokens"))
                      .withColumn("q", F.col("tokens") / F.lit(max(total, 1)).cast("double")), "mix-sources")
    some = sources.where("tokens > 0")
    a = exponent(some, mix)
    z = _moments(some, [a])[0][0] or 1.0
    weighted = sources.withColumn("weight", F.when(F.col("tokens") > 0, F.pow("q", F.lit(a)) / z).otherwise(0.0))
    if mix.budget is None:
        need = weighted.where("tokens > 0").agg(F.max(F.col("tokens") / F.col("weight"))).first()[0] or 0.0
        share = F.greatest(F.floor(F.col("weight") * need + 1e-6), F.col("tokens"))
    else:
        share = F.floor(F.col("weight") * mix.budget + 1e-6)
    weighted = (weighted.withColumn("budget", share.cast("bigint"))
                .withColumn("rounds", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens")))
                            .otherwise(1).cast("bigint"))
                .withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("rounds") * F.col("tokens"))
                            .otherwise(0)))
    weighted, _ = land(weighted.drop("q"), "mix-weights")
    block, place = _keys(mix, F.col("id"), F.col("s"), F.col("tokens"))
    placed = (rows.join(weighted.select("s", "tokens"), "s")
              .select("id", "s", "n", block.alias("block"), place.alias("place")))
    placed, _ = land(placed, "mix-places")
    ahead = Window.partitionBy("s").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (placed.groupBy("s", "block").agg(F.sum("n").alias("size"))
              .withColumn("before", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
              .join(weighted.select("s", "rest"), "s")
              .where("before <= rest and before + size > rest"))       # the block where the last round ends
    inside = Window.partitionBy("s").orderBy("place", "id").rowsBetween(Window.unboundedPreceding, 0)
    ends = (placed.join(blocks, ["s", "block"])
            .withColumn("upto", F.col("before") + F.sum("n").over(inside)).where("upto > rest")
            .groupBy("s").agg(F.min(F.struct("block", "place", "id")).alias("e"))
            .select("s", F.col("e.block").alias("end_block"), F.col("e.place").alias("end_doc"), F.col("e.id").alias("end_id")))
    sources, _ = land(weighted.join(ends, "s", "left"), "mix-plan")
    return sources, placed


def _copies() -> Column:
    """Copies of a document from its place and its source's row."""
    here = F.struct(F.col("block").alias("a"), F.col("place").alias("b"), F.col("id").alias("c"))
    end = F.struct(F.col("end_block").alias("a"), F.col("end_doc").alias("b"), F.col("end_id").alias("c"))
    extra = F.when(F.col("rest") <= 0, 0).when(F.col("end_block").isNull(), 0).when(here < end, 1).otherwise(0)
    return (F.col("rounds") + extra).cast("bigint")


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    small = sources.count() <= MAX_BROADCAST_SOURCES
    return rows.join(F.broadcast(sources) if small else sources, "s")


def mixture(docs: DataFrame, mix: Mixture = Mixture(), id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source") -> DataFrame:
    """One row per document row: ``id, source, n_tokens, weight`` (of its source),
    ``block`` and ``place`` (its order in the permutation) and ``copies``."""
    sources, placed = plan(docs, mix, id_col, text_col, source_col)
    name = F.when(F.col("s") != "null", F.expr("substring(s, 2)"))
    return _with_source(placed, sources).select(
        F.col("id").alias(id_col), name.alias(source_col), F.col("n").alias("n_tokens"), "weight", "block", "place",
        _copies().alias("copies"))


def mixed(docs: DataFrame, mix: Mixture = Mixture(), id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """``docs`` with every row repeated as often as the mixture reads it (same columns)."""
    sources, _ = plan(docs, mix, id_col, text_col, source_col)
    block, place = _keys(mix, F.col("id"), F.col("s"), F.col("tokens"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("id"),
                      _source(source_col).alias("s"))
    out = _with_source(row, sources).withColumn("block", block).withColumn("place", place)
    return (out.where(_copies() > 0).select("_row", F.explode(F.array_repeat(F.lit(0), _copies().cast("int"))))
            .select("_row.*"))
