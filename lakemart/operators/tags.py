"""Tag analytics over a (user_id, movie_id, tag) table.

Lists are built from ``(group, tag, count)`` rows produced by a partial
aggregation, so a (user, movie) pair that holds a third of all tag rows ships
one row per distinct tag through the shuffle, never its raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import full_name


def tag_lists(tags: DataFrame, keys=("user_id", "movie_id"), expand: bool = True) -> DataFrame:
    """Sorted list of tags per (user, movie), duplicates kept, NULL tags skipped.

    ``expand=False`` returns the same list in compact form, ``tag_counts``:
    sorted (tag, n) pairs, whose length is bounded by the distinct tags of the
    group rather than by its row count."""
    keys = list(keys)
    counted = tags.groupBy(*keys, "tag").agg(F.count("tag").alias("n"))
    packed = counted.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("n") > 0, F.struct("tag", "n")))).alias("_tn"))
    if not expand:
        return packed.select(*keys, F.col("_tn").alias("tag_counts"))
    expanded = F.flatten(F.transform("_tn", lambda x: F.array_repeat(x["tag"], x["n"].cast("int"))))
    return packed.select(*keys, expanded.alias("tags"))


def tag_lists_text(tags: DataFrame, keys=("user_id", "movie_id")) -> DataFrame:
    """The same list serialised to one JSON string per (user, movie)."""
    return tag_lists(tags, keys).select(*keys, F.to_json("tags").alias("tag_list"))


def repeated_tags(tags: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """One row per (user, movie, tag) given more than once; the tag itself is not
    output, so equal rows can repeat.  Counting happens before the joins."""
    rep = (tags.where(F.col("tag").isNotNull())
           .groupBy("user_id", "movie_id", "tag").agg(F.count("tag").alias("n"))
           .where(F.col("n") > 1))
    u = users.select("user_id", full_name("first_name", "last_name").alias("full_name"))
    m = movies.select("movie_id", "title")
    return rep.join(u, "user_id").join(m, "movie_id").select("user_id", "full_name", "movie_id", "title")


def most_tagged_titles(tags: DataFrame, movies: DataFrame, n: int = 3) -> DataFrame:
    """Distinct-tag count and sorted tag set per title; top n (ties: title).

    (movie, tag) pairs are de-duplicated before the movie join (the join input
    shrinks to distinct pairs); per title, ``collect_set`` de-duplicates again
    map-side, so one shuffle by title carries at most the distinct tags of a
    title per task and the count is the set's size."""
    per_movie = tags.where(F.col("tag").isNotNull()).select("movie_id", "tag").distinct()
    per_title = (per_movie.join(movies.select("movie_id", "title"), "movie_id")
                 .groupBy("title").agg(F.sort_array(F.collect_set("tag")).alias("tag_set")))
    return (per_title.select("title", F.size("tag_set").cast("long").alias("tag_count"), "tag_set")
            .orderBy(F.col("tag_count").desc(), F.col("title")).limit(n))
