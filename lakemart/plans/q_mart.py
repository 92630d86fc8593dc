"""Queries of the nested -> star-schema mart and the genre-key path."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import landing as L
from . import nested_standins as NS
from .registry import query, r4
from ..functions.nested import parse_array
from ..operators import clean, facts, nested as N
from ..session import cut_lineage, remove
from ..sources import readers as R


movies_whole = NS.movies_whole


def _source(spark, d, ent: N.Entity):
    if ent.source == "credits":
        return NS.credits_text(spark, d)
    if ent.source == "keywords":
        return NS.keywords_text(spark, d)
    return movies_whole(spark, d, (ent.column,))


@query("nest_repair")
def nest_repair(spark, d):
    m = NS.metadata_text(spark, d)
    sizes = [F.size(parse_array(e.column, e.schema)).alias(f"n_{name}") for name, e in N.ENTITIES.items()]
    return m.select("id", *sizes)


@query("nest_repair_values")
def nest_repair_values(spark, d):
    # the cells as they are, with a backslash, an escaped apostrophe and a bare True
    text, kind = F.col("keywords"), F.col("id") % 4
    cell = (F.when(kind == 0, text).when(kind == 1, F.replace(text, F.lit("'name': '"), F.lit("'name': '\\")))
            .when(kind == 2, F.replace(text, F.lit("'name': '"), F.lit("'name': 'x\\'")))
            .otherwise(F.replace(text, F.lit("'id': "), F.lit("'adult': True, 'id': "))))
    ent = N.ENTITIES["keywords"]
    parsed = (NS.keywords_text(spark, d).where(text.isNotNull())
              .select("id", parse_array(cell, ent.schema).alias("_k")))
    values = F.transform("_k", lambda e: F.concat(e["id"].cast("string"), F.lit(":"), e["name"]))
    return parsed.select("id", F.array_join(F.array_sort(values), ",").alias("keywords"))


def _register_entity(name: str, ent: N.Entity):
    def dim(spark, d):
        return N.dimension(N.explode_entities(_source(spark, d, ent), ent), ent)

    def brg(spark, d):
        return N.bridge(N.explode_entities(_source(spark, d, ent), ent), ent)

    query(f"nest_dim_{name}")(dim)
    query(f"nest_bridge_{name}")(brg)


for _name, _ent in N.ENTITIES.items():
    _register_entity(_name, _ent)


@query("mart_votes")
def mart_votes(spark, d):
    v = facts.votes(N.ratings_fact(NS.ratings_raw(spark, d)))
    return v.select("movieId", r4("vote_average").alias("vote_average"), "vote_count")


@query("mart_ratings")
def mart_ratings(spark, d):
    return N.ratings_fact(NS.ratings_raw(spark, d))


@query("mart_movies")
def mart_movies(spark, d):
    fact = N.ratings_fact(NS.ratings_raw(spark, d))
    m = N.movies_mart(L.movies_read(spark, d), facts.votes(fact))
    return m.select(*[c for c in m.columns if c not in ("release_date", "vote_average")],
                    F.col("release_date").cast("string").alias("release_date"),
                    r4("vote_average").alias("vote_average"))


@query("mart_star_counts")
def mart_star_counts(spark, d):
    folders = {}
    star = N.star_schema(*NS.file_sources(spark, d, folders), landed_source=lambda source: remove(spark, folders[source]))
    # (sources.sinks.save_star_schema writes the same 14 tables as external tables)
    # a table's count is landed before the next one starts, so that one table's shuffle is on disk at a time
    parts = [cut_lineage(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows"), "star-count")
             for name, df in star.items()]
    star.release()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _hql_movies(spark, d):
    return clean.conform_movies(R.read_delimited(spark, L.movies_text(spark, d), ["movie_id", "title", "genres"]))


@query("mart_genre_dim")
def mart_genre_dim(spark, d):
    m = _hql_movies(spark, d)
    return N.surrogate_key(m.select(F.explode("genres").alias("genre_name")), "genre_name", "genre_id")


@query("mart_genre_refresh")
def mart_genre_refresh(spark, d):
    # two loads: the first file lists part types only, the refresh brands as well,
    # whose names sort before and between the old ones
    old = _hql_movies(spark, d).select(F.element_at("genres", 1).alias("genre_name"))
    first = N.surrogate_key(old, "genre_name", "genre_id")
    names = _hql_movies(spark, d).select(F.explode("genres").alias("genre_name"))
    second = N.surrogate_key(names, "genre_name", "genre_id", existing=first)
    return first.withColumn("load", F.lit(1)).unionByName(second.withColumn("load", F.lit(2)))


@query("mart_genre_ids")
def mart_genre_ids(spark, d):
    return _genre_ids(spark, d, as_set=True)


@query("mart_genre_ids_list")
def mart_genre_ids_list(spark, d):
    return _genre_ids(spark, d, as_set=False)


def _genre_ids(spark, d, as_set: bool):
    m = _hql_movies(spark, d)
    dim = N.surrogate_key(m.select(F.explode("genres").alias("genre_name")), "genre_name", "genre_id")
    out = N.genre_ids(m, dim, as_set=as_set)
    return out.select("movie_id", "title", "movie_year",
                      F.array_join(F.transform("genre_ids", lambda x: x.cast("string")), ",").alias("genre_ids"))
