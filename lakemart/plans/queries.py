"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

A query = stand-in inputs (``standins``) -> library operator -> report layout.
The report layout rounds doubles (4 places), turns arrays into sorted text and
dates into ISO text, so that the result compares value-for-value with the SQL
oracle in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import standins as S
from .registry import QUERIES, query, r4  # noqa: F401  (QUERIES is the public table)
from ..operators import facts, tags as tagops

# Parameters of the registered queries (the stand-in data has ratings 1-50 and
# ship dates 1995-2001, so the reference's 4.0 / 2005-2015 become 25 / 1996-1999).
TOP_TITLES = dict(y0=1996, y1=1999, min_avg=25.0, n=10)
POPULAR = dict(min_avg=25.5, min_count=100)


# ---- facts -----------------------------------------------------------------------

@query("fact_top_titles")
def fact_top_titles(spark, d):
    out = facts.top_titles(S.ratings(spark, d), S.movies(spark, d), **TOP_TITLES)
    return out.select("title", "rating_sum", r4("average_rating").alias("average_rating"))


@query("fact_rating_by_year")
def fact_rating_by_year(spark, d):
    out = facts.rating_by_year(S.ratings(spark, d))
    return out.select("movie_id", "movie_year", r4("average_rating").alias("average_rating"))


@query("fact_popular_titles")
def fact_popular_titles(spark, d):
    out = facts.popular_titles(S.ratings(spark, d), S.movies(spark, d), **POPULAR)
    return out.select("title", r4("average_rating").alias("average_rating"), "rating_count")


@query("fact_silent_users")
def fact_silent_users(spark, d):
    return facts.silent_users(S.users(spark, d), S.ratings(spark, d))


# ---- tags ------------------------------------------------------------------------

@query("tag_lists")
def tag_lists(spark, d):
    out = tagops.tag_lists(S.tags(spark, d))
    return out.select("user_id", "movie_id", F.array_join("tags", ",").alias("tags"))


@query("tag_lists_text")
def tag_lists_text(spark, d):
    return tagops.tag_lists_text(S.tags(spark, d))


@query("tag_repeats")
def tag_repeats(spark, d):
    return tagops.repeated_tags(S.tags(spark, d), S.users(spark, d), S.movies(spark, d))


@query("tag_top_titles")
def tag_top_titles(spark, d):
    out = tagops.most_tagged_titles(S.tags(spark, d), S.movies(spark, d), n=3)
    return out.select("title", "tag_count", F.array_join("tag_set", ",").alias("tag_set"))


from . import q_lake, q_mart, q_apps  # noqa: E402,F401  (register the other groups)
