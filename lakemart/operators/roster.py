"""Hero rosters: name alignment across tables, seeded team draw, role
assignment and team profiles — one lazy plan, no driver round trips.

Teams hold ``size`` heroes, so every per-team window below sees at most
``size`` rows whatever the size of the hero tables; the hero tables themselves
are only scanned, joined on name and cut by a distributed top-k (``orderBy +
limit``) during the draw.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import TEAM_PREFIX
from ..functions.order import draw_key

ATTRS = ["intelligence", "strength", "speed", "durability", "power", "combat"]


def align_names(*tables: DataFrame, key: str = "name") -> list[DataFrame]:
    """Every key present in any table appears in all of them (new rows carry
    NULLs); a table's own rows stay as they are, also those without a key.  One
    tagged union grouped by key says which tables hold it; no join."""
    tagged = reduce(DataFrame.unionByName, [t.select(key, F.lit(1 << i).alias("_in")) for i, t in enumerate(tables)])
    holders = tagged.groupBy(key).agg(F.bit_or("_in").alias("_in"))
    return [t.unionByName(holders.where(F.col("_in").bitwiseAND(1 << i) == 0).select(key), allowMissingColumns=True)
            for i, t in enumerate(tables)]


def draw_teams(heroes: DataFrame, n_teams: int = 8, size: int = 5, seed: int = 42,
               key: str = "name") -> DataFrame:
    """Seeded draw without replacement of ``n_teams * size`` heroes, cut into
    disjoint teams (``team`` 0..n_teams-1, ``slot`` 1..size)."""
    k = n_teams * size
    drawn = (heroes.withColumn("_draw", draw_key(seed, key))
             .orderBy("_draw", key).limit(k))          # TakeOrderedAndProject: bounded by k
    w = Window.orderBy("_draw", key)                    # over k rows only
    rn = F.row_number().over(w)
    return (drawn.withColumn("_rn", rn)
            .withColumn("team", F.floor((F.col("_rn") - 1) / size).cast("int"))
            .withColumn("slot", ((F.col("_rn") - 1) % size + 1).cast("int"))
            .drop("_draw", "_rn"))


def _best(score: Column, eligible: Column | None = None) -> Column:
    """Name with the highest score in the team (ties: smallest name)."""
    order = F.struct((-score).alias("s"), F.col("name").alias("n"))
    if eligible is not None:
        order = F.when(eligible, order)
    return F.min_by("name", order)


def assign_roles(members: DataFrame, team: str = "team") -> DataFrame:
    """leader = most intelligent; then without the leader tank = max
    strength+durability; then damage = max speed+power+combat of the rest; the
    other two by name.  ``strongest`` = max mean of the six attributes over
    the whole team."""
    w = Window.partitionBy(team)
    name = F.col("name")
    c = {a: F.col(a) for a in ATTRS}
    m = members.withColumn("leader", _best(c["intelligence"]).over(w))
    m = m.withColumn("tank", _best(c["strength"] + c["durability"], name != F.col("leader")).over(w))
    m = m.withColumn("damage", _best(c["speed"] + c["power"] + c["combat"],
                                     ~name.isin(F.col("leader"), F.col("tank"))).over(w))
    rest = F.when(~name.isin(F.col("leader"), F.col("tank"), F.col("damage")), name)
    m = m.withColumn("_others", F.array_sort(F.collect_list(rest).over(w)))
    m = m.withColumn("strongest", _best(sum((c[a] for a in ATTRS), F.lit(0))).over(w))
    return m.withColumn("the_other_guy", F.get("_others", 0)).withColumn(
        "the_other_guy2", F.get("_others", 1)).drop("_others")


def _top_mean(values: Column, k: int = 3) -> Column:
    """Mean of the k largest values in a (small, per-team) array; with fewer
    than k values the mean of those present."""
    top = F.slice(F.sort_array(values, asc=False), 1, k)
    return F.aggregate(top, F.lit(0.0), lambda acc, x: acc + x) / F.size(top)


def team_profile(roles: DataFrame, info: DataFrame, powers: DataFrame, team: str = "team") -> DataFrame:
    """One row per team: name, roles, mean of top-3 speeds and heights, flyers."""
    j = (roles.join(info.select("name", "height"), "name", "left")
         .join(powers.select("name", "flight"), "name", "left"))
    return (j.groupBy(team).agg(
        F.concat(F.lit(TEAM_PREFIX), F.first("strongest")).alias("team_name"),
        F.first("leader").alias("leader"), F.first("tank").alias("tank"),
        F.first("damage").alias("damage"), F.first("the_other_guy").alias("the_other_guy"),
        F.first("the_other_guy2").alias("the_other_guy2"),
        _top_mean(F.collect_list(F.col("speed").cast("double"))).alias("top_average_speed"),
        _top_mean(F.collect_list(F.col("height").cast("double"))).alias("top_average_height"),
        F.count_if(F.coalesce(F.col("flight"), F.lit(False))).cast("int").alias("flight_count")))


def build_teams(stats: DataFrame, info: DataFrame, powers: DataFrame, n_teams: int = 8, size: int = 5,
                seed: int = 42) -> DataFrame:
    """Draw, roles and profile: the 9-column team table (plus ``team``)."""
    roles = assign_roles(draw_teams(stats, n_teams, size, seed))
    return team_profile(roles, info, powers)


def _fill_stats(s: DataFrame) -> DataFrame:
    from .clean import fill_defaults
    return fill_defaults(s, numeric=[*ATTRS, "total"], boolean=False)


def _fill_info(i: DataFrame, clamp: Sequence[str]) -> DataFrame:
    from .clean import clamp_negative, fill_defaults
    return clamp_negative(fill_defaults(i, numeric=list(clamp), boolean=False), list(clamp))


def _fill_powers(p: DataFrame) -> DataFrame:
    from .clean import fill_defaults
    return fill_defaults(p, boolean=True)


def draft_teams(stats: DataFrame, info: DataFrame, powers: DataFrame, n_teams: int = 8, size: int = 5,
                seed: int = 42) -> DataFrame:
    """``build_teams`` of the aligned tables, from the raw ones: the same team table
    without aligning what is not drawn.

    Heroes are drawn from the stats with the names that only the other tables hold;
    only the drawn names (at most ``n_teams * size``, broadcast) are looked up in the
    raw info and powers where those are read, and only those rows are filled and
    clamped.  No hero table is shuffled by name but for the set of names itself."""
    drawn = draw_teams(_fill_stats(align_names(stats, info, powers)[0]), n_teams, size, seed)
    names = drawn.select("name").distinct()

    def looked_up(t: DataFrame, column: str) -> DataFrame:
        few = t.select("name", column).join(F.broadcast(names), "name", "left_semi")
        return names.join(few, "name", "left")
    return team_profile(assign_roles(drawn), _fill_info(looked_up(info, "height"), ["height"]),
                        _fill_powers(looked_up(powers, "flight")))


def aligned_heroes(stats: DataFrame, info: DataFrame, powers: DataFrame,
                   clamp: Sequence[str] = ("height", "weight")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three hero tables aligned on name, NULLs filled, negatives clamped."""
    s, i, p = align_names(stats, info, powers)
    return _fill_stats(s), _fill_info(i, clamp), _fill_powers(p)
