"""Rewritten plans give the same rows as the original forms."""

from pyspark.sql import functions as F

from conftest import SF01
from lakemart.operators import facts, roster as RO
from lakemart.plans import standins as S


def _anti_join_form(stats, info, powers):
    """The original six anti joins + union by name."""
    def missing(target, a, b):
        return (a.join(target, "name", "left_anti").select("name")
                .union(b.join(target, "name", "left_anti").select("name")).distinct())
    return (stats.unionByName(missing(stats, info, powers), allowMissingColumns=True),
            info.unionByName(missing(info, stats, powers), allowMissingColumns=True),
            powers.unionByName(missing(powers, stats, info), allowMissingColumns=True))


def test_align_names_equals_anti_join_form(spark):
    st, inf, pw = S.hero_stats(spark, SF01), S.hero_info(spark, SF01), S.hero_powers(spark, SF01)
    ours = RO.align_names(st, inf, pw)
    theirs = _anti_join_form(st, inf, pw)
    for a, b in zip(ours, theirs):
        cols = sorted(a.columns)
        assert sorted(b.columns) == cols
        assert a.select(cols).exceptAll(b.select(cols)).count() == 0
        assert b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_silent_users_equals_right_join_form(spark):
    users, ratings = S.users(spark, SF01), S.ratings(spark, SF01)
    ours = facts.silent_users(users, ratings).collect()[0].silent_users
    j = ratings.alias("r").join(users.alias("u"), F.col("u.user_id") == F.col("r.user_id"), "right")
    theirs = j.agg((F.countDistinct("u.user_id") - F.countDistinct("r.user_id")).alias("x")).collect()[0].x
    assert ours == theirs > 0


def test_top_titles_preaggregation_equals_plain_form(spark):
    r, m = S.ratings(spark, SF01), S.movies(spark, SF01)
    ours = [(x.title, x.rating_sum, round(x.average_rating, 9))
            for x in facts.top_titles(r, m, 1996, 1999, 25.0, 10).collect()]
    plain = (facts.year_range(r, "created_at", 1996, 1999).join(m, "movie_id").groupBy("title")
             .agg(F.sum("rating").alias("s"), F.avg("rating").alias("a")).where("a >= 25")
             .orderBy(F.desc("s"), "title").limit(10).orderBy(F.desc("a"), "title"))
    theirs = [(x.title, x.s, round(x.a, 9)) for x in plain.collect()]
    assert ours == theirs
