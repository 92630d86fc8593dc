"""Round-robin brackets and a knock-out tournament over a team table.

The team table is bounded by construction (``n_teams`` rows from the roster
draw), so the bracket draw may order it in one window and the pair table of a
bracket (n·(n−1)/2 pairs of at most ``ceil(n_teams/n_brackets)`` teams) is the
operator's requested output, not a data-proportional blow-up.  The knock-out is one
lazy plan: rounds fold inside rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.order import draw_key

STATS = ["top_average_speed", "top_average_height", "flight_count"]


def draw_brackets(teams: DataFrame, n: int = 4, seed: int = 7) -> DataFrame:
    """Equal-size brackets in seeded order; the remainder joins the last one."""
    order = [draw_key(seed, "team_name"), F.col("team_name")]
    rn = F.row_number().over(Window.orderBy(*order))
    total = F.count(F.lit(1)).over(Window.partitionBy())
    size = F.greatest(F.floor(total / n), F.lit(1))
    return teams.withColumn("bracket", F.least(F.floor((rn - 1) / size), F.lit(n - 1)).cast("int"))


#: members of a bracket that are paired in one task with as many others
PAIR_BLOCK = 256


def pairs(bracketed: DataFrame, block: int = PAIR_BLOCK) -> DataFrame:
    """All unordered pairs inside each bracket: (bracket, team_a, team_b, stats).

    A triangle-block join: the members of a bracket are hashed into blocks of about
    ``block``, and a member goes to the cells (its block, every later block) and
    (every earlier block, its block).  Cells are the join key, so the pairs of one
    bracket spread over as many tasks as it has cells, and a task meets about
    ``block`` * ``block`` pairs of a cell whatever the bracket's size.  A bracket of up
    to ``block`` members is one cell, that is, the plain join."""
    members = bracketed.where(F.col("bracket").isNotNull() & F.col("team_name").isNotNull())
    sizes = members.groupBy("bracket").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    t = members.join(sizes, "bracket").withColumn("_own", F.expr("cast(pmod(xxhash64(team_name), _blocks) as int)"))
    left = t.select("bracket", F.col("_own").alias("_i"), F.explode(F.expr("sequence(_own, _blocks - 1)")).alias("_j"),
                    F.struct(F.col("team_name").alias("team"), *STATS).alias("x"))
    right = t.select("bracket", F.explode(F.expr("sequence(0, _own)")).alias("_i"), F.col("_own").alias("_j"),
                     F.struct(F.col("team_name").alias("team"), *STATS).alias("y"))
    met = left.join(right, ["bracket", "_i", "_j"]).where((F.col("_i") < F.col("_j")) | (F.col("x.team") < F.col("y.team")))
    met = met.select("bracket", F.least("x.team", "y.team").alias("team_a"), F.greatest("x.team", "y.team").alias("team_b"),
                     F.when(F.col("x.team") < F.col("y.team"), F.col("x")).otherwise(F.col("y")).alias("a"),
                     F.when(F.col("x.team") < F.col("y.team"), F.col("y")).otherwise(F.col("x")).alias("b"))
    return met.select("bracket", "team_a", *[F.col(f"a.{s}").alias(f"a_{s}") for s in STATS],
                      "team_b", *[F.col(f"b.{s}").alias(f"b_{s}") for s in STATS])


def score(pair_rows: DataFrame) -> DataFrame:
    """+1 for strictly higher speed, +1 for strictly higher height, + own flyers."""
    def pts(me: str, other: str):
        return ((F.col(f"{me}_top_average_speed") > F.col(f"{other}_top_average_speed")).cast("int")
                + (F.col(f"{me}_top_average_height") > F.col(f"{other}_top_average_height")).cast("int")
                + F.col(f"{me}_flight_count")).cast("int")
    return pair_rows.select("bracket", "team_a", "team_b", pts("a", "b").alias("team_a_score"),
                            pts("b", "a").alias("team_b_score"))


def bracket_winner(scores: DataFrame, members: DataFrame) -> DataFrame:
    """Per bracket the team with most wins (a tie in a game goes to team_a; a
    tie in wins to the smaller name).  Members without a game (a bracket of
    one) count zero wins, so every non-empty bracket has a winner."""
    won = scores.select("bracket", F.when(F.col("team_a_score") >= F.col("team_b_score"), F.col("team_a"))
                        .otherwise(F.col("team_b")).alias("team_name"))
    wins = won.groupBy("bracket", "team_name").agg(F.count(F.lit(1)).alias("wins"))
    every = members.select("bracket", "team_name").join(wins, ["bracket", "team_name"], "left")
    every = every.withColumn("wins", F.coalesce("wins", F.lit(0)))
    return (every.groupBy("bracket")
            .agg(F.min_by(F.struct("team_name", "wins"), F.struct((-F.col("wins")).alias("w"), "team_name")).alias("_b"))
            .select("bracket", F.col("_b.team_name").alias("winner"), F.col("_b.wins").alias("wins")))


def play_round(bracketed: DataFrame) -> DataFrame:
    return bracket_winner(score(pairs(bracketed)), bracketed)


def _beats(x, y):
    """Whether ``x`` wins its game with ``y`` (the smaller name is team_a, and wins a tie)."""
    def points(me, other):
        return ((me["top_average_speed"] > other["top_average_speed"]).cast("int")
                + (me["top_average_height"] > other["top_average_height"]).cast("int") + me["flight_count"])
    mine, theirs = points(x, y), points(y, x)
    return F.when(x["team_name"] < y["team_name"], mine >= theirs).otherwise(~(theirs >= mine))


def in_row_winner(teams):
    """(winner, wins) of an array of teams: every pair compared inside the row.  A game
    with an unknown score goes to team_b, as in ``bracket_winner``."""
    def standing(t):
        won = F.filter(teams, lambda o: (o["team_name"] != t["team_name"]) & F.coalesce(_beats(t, o), t["team_name"] > o["team_name"]))
        return F.struct((-F.size(won)).alias("lost_rank"), t["team_name"].alias("team_name"), t.alias("team"))
    return F.array_min(F.transform(teams, standing))


def tournament(teams: DataFrame, n: int = 4, seed: int = 7) -> DataFrame:
    """Brackets -> winners; winners of brackets 2k and 2k+1 meet in the next
    round until one bracket is left.  Rows: (round, bracket, winner, wins).

    One lazy plan, a knock-out as a fold inside rows: a bracket is one row with its
    teams as an array, its games are higher-order functions over that array, and a
    round is one aggregate on ``floor(bracket / 2)`` that carries the results so far,
    so the plan grows by one exchange a round and nothing is written.  From the second
    round a row holds two teams; in the first it holds the drawn bracket, and at the
    end one row holds the 2 * ``n`` - 1 results.  Both are bounded by the team draw
    (``n_teams``); a bracket of many thousand teams is scored by ``play_round``, whose
    pairs are spread over tasks."""
    team = F.struct("team_name", *STATS)
    rows = (draw_brackets(teams, n, seed).groupBy("bracket").agg(F.collect_list(team).alias("teams"))
            .withColumn("results", F.expr("cast(array() as array<struct<round: int, bracket: int, winner: string, wins: bigint>>)")))
    width, rnd = n, 1
    while True:
        rows = rows.select("bracket", in_row_winner(F.col("teams")).alias("best"), "results")
        result = F.struct(F.lit(rnd).alias("round"), F.col("bracket"), F.col("best.team_name").alias("winner"),
                          (-F.col("best.lost_rank")).cast("bigint").alias("wins"))
        rows = rows.select("bracket", F.col("best.team").alias("team"), F.array_append("results", result).alias("results"))
        if width <= 1:
            break
        rows = (rows.groupBy(F.floor(F.col("bracket") / 2).cast("int").alias("bracket"))
                .agg(F.collect_list("team").alias("teams"), F.flatten(F.collect_list("results")).alias("results")))
        width, rnd = (width + 1) // 2, rnd + 1
    return rows.select(F.explode("results").alias("r")).select("r.round", "r.bracket", "r.winner", "r.wins")
