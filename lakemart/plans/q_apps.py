"""Queries of the applications: text tagging, rosters, tournament, grades, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import nested_standins as NS
from . import standins as S
from .registry import query, r4
from ..functions.text import tokens
from ..operators import grades as G, labels as LB, nested as N, ranking, roster as RO, text as TX
from ..operators import tournament as TR
from ..session import cut_lineage

# Parameters of the registered application queries.
PUBLISHERS = ["AMERICA", "EUROPE"]
TEAMS = dict(n_teams=8, size=5, seed=42)
BRACKETS = dict(n=4, seed=7)
LABEL_LIMIT = 100          # posters fetched in a test run
SHARDS = 5                 # download processes
SPLIT = dict(fraction=0.3, seed=7)
CERTIFICATE = dict(reg=0.01, gradient=1e-4)


# ---- text -------------------------------------------------------------------------

@query("text_tokens")
def text_tokens(spark, d):
    t = S.news(spark, d).select("ArticleID", tokens("Text").alias("_t"))
    return t.select("ArticleID", F.size("_t").alias("n_tokens"),
                    F.size(F.filter("_t", lambda x: x != "")).alias("n_nonempty"))


@query("text_token_counts")
def text_token_counts(spark, d):
    # every token of every document with its number and first and last position
    return TX.token_counts(S.news(spark, d))


@query("text_keywords")
def text_keywords(spark, d):
    return TX.keywords(S.news(spark, d))


@query("text_keywords_spec")
def text_keywords_spec(spark, d):
    # the task statement's separators (whitespace , : ! ?) instead of the code's
    return TX.keywords(S.news(spark, d), mode="spec")


# ---- heroes -------------------------------------------------------------------------

@query("top_by_alignment")
def top_by_alignment(spark, d):
    return ranking.top_by_alignment(S.hero_stats(spark, d, whole=True), S.hero_info(spark, d, whole=True), PUBLISHERS, n=10)


def _aligned(spark, d):
    return RO.aligned_heroes(S.hero_stats(spark, d), S.hero_info(spark, d), S.hero_powers(spark, d))


@query("roster_align")
def roster_align(spark, d):
    s, i, p = _aligned(spark, d)
    return s.select("name", "total").join(i.select("name", "height"), "name").join(p, "name")


@query("roster_draw")
def roster_draw(spark, d):
    s, _, _ = _aligned(spark, d)
    return RO.draw_teams(s, **TEAMS).select("name", "team", "slot")


def teams(spark, d):
    return RO.draft_teams(S.hero_stats(spark, d), S.hero_info(spark, d), S.hero_powers(spark, d), **TEAMS)


TEAM_COLS = ["team_name", "leader", "tank", "damage", "the_other_guy", "the_other_guy2"]


@query("roster_teams")
def roster_teams(spark, d):
    t = teams(spark, d)
    return t.select(*TEAM_COLS, r4("top_average_speed").alias("top_average_speed"),
                    r4("top_average_height").alias("top_average_height"), "flight_count")


# ---- tournament ----------------------------------------------------------------------

def _bracketed(spark, d):
    # pairs read the bracket table twice and the winner step a third time: land
    # it once (at most n_teams rows)
    return cut_lineage(TR.draw_brackets(teams(spark, d), **BRACKETS), "bracket")


@query("tour_brackets")
def tour_brackets(spark, d):
    return TR.draw_brackets(teams(spark, d), **BRACKETS).select("team_name", "bracket")


@query("tour_pairs")
def tour_pairs(spark, d):
    return TR.pairs(_bracketed(spark, d)).select("bracket", "team_a", "team_b")


@query("tour_scores")
def tour_scores(spark, d):
    return TR.score(TR.pairs(_bracketed(spark, d)))


@query("tour_bracket_winner")
def tour_bracket_winner(spark, d):
    return TR.play_round(_bracketed(spark, d))


@query("tour_final")
def tour_final(spark, d):
    return TR.tournament(teams(spark, d), **BRACKETS)


# ---- grades ---------------------------------------------------------------------------

@query("cogroup_grades")
def cogroup_grades(spark, d):
    return G.grade_report(S.grades(spark, d, "F"), S.grades(spark, d, "O"))


# ---- labels ---------------------------------------------------------------------------

def _genre_mart(spark, d, land: bool = True):
    # movies, bridge and dimension all derive from the same parsed metadata:
    # land the three columns they need once instead of re-deriving it per branch
    ent = N.ENTITIES["genres"]
    meta = NS.movies_whole(spark, d, (ent.column,)).select("id", "imdb_id", ent.column)
    if land:
        meta = cut_lineage(meta, "genre-meta")
    rows = N.explode_entities(meta, ent)
    return meta, N.bridge(rows, ent), N.dimension(rows, ent)


def _all_pairs(spark, d):
    return LB.label_pairs(*_genre_mart(spark, d))


@query("label_pairs")
def label_pairs(spark, d):
    # a top-n over the join: one pass, nothing to land
    return LB.label_pairs(*_genre_mart(spark, d, land=False), n=LABEL_LIMIT)


@query("label_pairs_all")
def label_pairs_all(spark, d):
    # without the limit: every pair
    return LB.label_pairs(*_genre_mart(spark, d, land=False), n=None)


def _sharded(spark, d):
    # the cuts are found by evaluating the pairs several times: their joins run once
    return LB.assign_shards(cut_lineage(_all_pairs(spark, d), "label-pairs"), SHARDS)


@query("label_shards")
def label_shards(spark, d):
    return _sharded(spark, d)


@query("label_fetch_plan")
def label_fetch_plan(spark, d):
    return LB.fetch_plan(_sharded(spark, d))


@query("label_dictionary")
def label_dictionary(spark, d):
    return LB.label_dictionary(_all_pairs(spark, d), label="genre")


def _split_embeddings(spark, d):
    e = S.table(spark, d, "embeddings")
    return LB.train_validation_split(e, label="label", key="vec_id", **SPLIT)


@query("label_split")
def label_split(spark, d):
    return _split_embeddings(spark, d).select("vec_id", "label", "split")


def _model(spark, d):
    data = LB.to_features(_split_embeddings(spark, d))
    model = LB.train_classifier(data.where(F.col("split") == "train"), max_iter=10)
    return model, data


@query("label_classifier")
def label_classifier(spark, d):
    model, data = _model(spark, d)
    return LB.evaluate(model, data)


@query("label_classifier_check")
def label_classifier_check(spark, d):
    # run to convergence with a ridge term: at the optimum the gradient vanishes
    data = LB.to_features(S.table(spark, d, "embeddings").where("embedding is not null and label is not null"))
    model = LB.train_classifier(data, max_iter=500, reg=CERTIFICATE["reg"], tol=1e-8, standardize=False)
    c = LB.fit_certificate(model, data, reg=CERTIFICATE["reg"])
    return c.select("rows", "labels", (F.col("gradient_norm") < CERTIFICATE["gradient"]).alias("converged"),
                    (F.col("objective") < F.col("null_loss")).alias("better_than_null"),
                    (F.col("objective") <= F.col("shifted_objective")).alias("locally_best"))


@query("label_ranking")
def label_ranking(spark, d):
    model, data = _model(spark, d)
    return LB.rank_labels(model, data, key="vec_id")


@query("label_ranking_check")
def label_ranking_check(spark, d):
    # what any ranking must satisfy, per item
    model, data = _model(spark, d)
    picked = model.transform(data).select("vec_id", F.col("prediction").cast("int").alias("picked"))
    each = (LB.rank_labels(model, data, key="vec_id").groupBy("vec_id")
            .agg(F.count(F.lit(1)).alias("n_labels"), F.sum("rank").alias("rank_sum"), F.sum("probability").alias("p"),
                 F.max(F.struct("probability", -F.col("rank"), "label_index")).alias("top"),
                 F.min_by("label_index", "rank").alias("first")))
    return each.join(picked, "vec_id").select(
        "vec_id", "n_labels", (F.col("rank_sum") * 2 == F.col("n_labels") * (F.col("n_labels") + 1)).alias("ranks_ok"),
        (F.abs(F.col("p") - 1) < 1e-9).alias("sums_to_one"), (F.col("top.label_index") == F.col("first")).alias("best_first"),
        (F.col("first") == F.col("picked")).alias("first_is_prediction"))
