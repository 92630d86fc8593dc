"""Nested list columns -> star schema (dimensions, bridges, movie table, facts).

Every step is row-local (``from_json``, ``explode``, ``select``) except the
dimension ``distinct``, which is a partial + final hash aggregate, and the
movie table's left join to per-movie vote aggregates.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..functions.nested import parse_array
from ..functions.order import global_index
from ..session import landed, landed_parts, remove
from . import facts


def _struct(*fields) -> ArrayType:
    return ArrayType(StructType([StructField(n, t, True) for n, t in fields]))


S, I = StringType(), IntegerType()
COMPANIES = _struct(("name", S), ("id", I))
COUNTRIES = _struct(("iso_3166_1", S), ("name", S))
LANGUAGES = _struct(("iso_639_1", S), ("name", S))
GENRES = _struct(("id", I), ("name", S))
CAST = _struct(("cast_id", I), ("character", S), ("credit_id", S), ("gender", I), ("id", I),
               ("name", S), ("order", I), ("profile_path", S))
KEYWORDS = _struct(("id", I), ("name", S))


@dataclass(frozen=True)
class Entity:
    """How one list column becomes a dimension and a bridge."""
    column: str
    schema: ArrayType
    key: tuple[str, str]          # (element field, output name)
    name: tuple[str, str]
    extra: tuple[tuple[str, str], ...] = field(default_factory=tuple)  # bridge-only fields
    source: str = "metadata"      # metadata | credits | keywords


ENTITIES = {
    "companies": Entity("production_companies", COMPANIES, ("id", "company_id"), ("name", "company_name")),
    "countries": Entity("production_countries", COUNTRIES, ("iso_3166_1", "country_id"), ("name", "country_name")),
    "languages": Entity("spoken_languages", LANGUAGES, ("iso_639_1", "language_id"), ("name", "language_name")),
    "genres": Entity("genres", GENRES, ("id", "genre_id"), ("name", "genre_name")),
    "actors": Entity("cast", CAST, ("id", "actor_id"), ("name", "name"), (("character", "character"),),
                     source="credits"),
    "keywords": Entity("keywords", KEYWORDS, ("id", "keyword_id"), ("name", "name"), source="keywords"),
}

MOVIE_COLUMNS = ["id", "imdb_id", "homepage", "original_title", "overview", "popularity",
                 "release_date", "revenue", "runtime", "status", "title"]


def explode_entities(df: DataFrame, entity: Entity, movie: str = "id") -> DataFrame:
    """One row per list element: (movie, key, name, extras); empty / NULL /
    malformed lists give no row."""
    parsed = df.select(movie, F.explode(parse_array(entity.column, entity.schema)).alias("_e"))
    cols = [F.col(f"_e.{entity.key[0]}").alias(entity.key[1]),
            F.col(f"_e.{entity.name[0]}").alias(entity.name[1])]
    cols += [F.col(f"_e.{src}").alias(dst) for src, dst in entity.extra]
    return parsed.select(movie, *cols)


def dimension(entities: DataFrame, entity: Entity) -> DataFrame:
    """Distinct (key, name); a key seen with two names stays two rows."""
    return entities.select(entity.key[1], entity.name[1]).distinct()


def bridge(entities: DataFrame, entity: Entity, movie: str = "id") -> DataFrame:
    """(movie_id, key, extras) pairs, duplicates kept."""
    return entities.select(F.col(movie).alias("movie_id"), entity.key[1], *[d for _, d in entity.extra])


def movies_mart(movies: DataFrame, votes: DataFrame, movie_key: str = "movieId") -> DataFrame:
    """Kept movie columns + recomputed vote_average / vote_count (NULL if unrated)."""
    kept = movies.select(*MOVIE_COLUMNS)
    return kept.join(votes, kept.id == votes[movie_key], "left").drop(movie_key)


def ratings_fact(ratings: DataFrame) -> DataFrame:
    return ratings.select("userId", "movieId", "rating")


def tagged_entities(df: DataFrame, entities: dict[str, Entity], movie: str = "id") -> DataFrame:
    """All list columns of a source in one pass: (entity, movie, key, name, extra),
    one row per list element; keys as text, extras as an array in the entity's order."""
    def tagged(name: str, e: Entity):
        def row(x):
            extra = F.array(*[x[src].cast("string") for src, _ in e.extra]).cast("array<string>")
            return F.struct(F.lit(name).alias("entity"), x[e.key[0]].cast("string").alias("key"),
                            x[e.name[0]].alias("name"), extra.alias("extra"))
        return F.coalesce(F.transform(parse_array(e.column, e.schema), row), F.array())
    every = F.concat(*[tagged(name, e) for name, e in entities.items()])
    return df.select(movie, F.explode(every).alias("_e")).select("_e.entity", movie, "_e.key", "_e.name", "_e.extra")


def entity_rows(tagged: DataFrame, name: str, entity: Entity, movie: str = "id") -> DataFrame:
    """``explode_entities`` of one entity read back from the tagged table."""
    types = {f.name: f.dataType for f in entity.schema.elementType.fields}
    return tagged.where(F.col("entity") == name).select(
        movie, F.col("key").cast(types[entity.key[0]]).alias(entity.key[1]), F.col("name").alias(entity.name[1]),
        *[F.col("extra")[i].cast(types[src]).alias(dst) for i, (src, dst) in enumerate(entity.extra)])


class StarSchema(dict):
    """The mart tables by name, and the landed folders they read; ``release`` drops
    the folders once the tables are written elsewhere (or no longer needed)."""

    def __init__(self, spark):
        super().__init__()
        self.spark, self.folders = spark, []

    def land(self, df: DataFrame | dict[str, DataFrame], name: str, by: str | None = None) -> DataFrame:
        out, path = landed_parts(df, by, name) if by else landed(df, name)
        self.folders.append(path)
        return out

    def release(self) -> None:
        while self.folders:
            remove(self.spark, self.folders.pop())


def star_schema(metadata: DataFrame, credits: DataFrame, keywords: DataFrame,
                ratings: DataFrame, landed_source: Callable[[str], None] | None = None) -> StarSchema:
    """The 14 mart tables.  ``metadata`` must already be deny-filtered.

    Per source one tagged table partitioned by entity: every list column is parsed once,
    into its entity's partition, and the dimension and bridge of an entity read that
    partition alone.  The columns of the metadata are landed beside it, so that its files
    are parsed once.  ``landed_source`` is told the name of each source that no table
    reads any more, so that its owner can drop its files."""
    out = StarSchema(metadata.sparkSession)
    lists = [e.column for e in ENTITIES.values() if e.source == "metadata"]
    ended = landed_source or (lambda source: None)
    metadata = out.land(metadata.select(*dict.fromkeys([*MOVIE_COLUMNS, *lists])), "metadata")
    ended("metadata")
    for source, rows in {"metadata": metadata, "credits": credits, "keywords": keywords}.items():
        entities = {name: e for name, e in ENTITIES.items() if e.source == source}
        tagged = out.land({name: tagged_entities(rows, {name: e}) for name, e in entities.items()},
                          f"entities-{source}", by="entity")
        if source != "metadata":
            ended(source)
        for name, ent in entities.items():
            rows_of = entity_rows(tagged, name, ent)
            out[f"{name}_ext"] = dimension(rows_of, ent)
            out[f"{name}_movies_ext"] = bridge(rows_of, ent)
    fact = ratings_fact(ratings)
    out["ratings_ext"] = fact
    out["movies_table_ext"] = movies_mart(metadata, facts.votes(fact))
    return out


def surrogate_key(names: DataFrame, name_col: str, key_col: str, existing: DataFrame | None = None) -> DataFrame:
    """Dimension with repeatable, unique, dense int keys.

    Without ``existing`` a key is the name's rank in sort order.  With the dimension
    of an earlier load (``key_col``, ``name_col``) every old row keeps its key, also
    when its name is gone, and only names it lacks are numbered, in sort order above
    its highest key: facts loaded earlier stay valid whatever names a refresh adds.
    Ranked with a distributed range index, not a single-partition window."""
    distinct = names.select(name_col).where(F.col(name_col).isNotNull()).distinct()
    high = 0
    if existing is not None:
        existing = existing.select(F.col(key_col).cast("int").alias(key_col), name_col)
        distinct = distinct.join(existing, name_col, "left_anti")
        high = existing.agg(F.max(key_col)).first()[0] or 0
    new = global_index(distinct, [name_col], key_col).select(
        (F.col(key_col) + F.lit(high)).cast("int").alias(key_col), name_col)
    return new if existing is None else existing.unionByName(new)


def genre_ids(movies: DataFrame, genre_dim: DataFrame, genres: str = "genres",
              key_col: str = "genre_id", name_col: str = "genre_name", as_set: bool = True) -> DataFrame:
    """Per (movie_id, title, movie_year) the sorted genre keys — a set
    (``as_set``) or a list keeping repeats; movies whose genres match no
    dimension row drop out."""
    exploded = movies.select("movie_id", "title", "movie_year", F.explode(genres).alias("_g"))
    joined = exploded.join(genre_dim, exploded._g == genre_dim[name_col])
    collect = F.collect_set if as_set else F.collect_list
    return (joined.groupBy("movie_id", "title", "movie_year")
            .agg(F.array_sort(collect(key_col)).alias("genre_ids")))


def parse_report(df: DataFrame, entities: dict[str, Entity] | None = None) -> DataFrame:
    """Per list column: cells with text, and cells whose text the repair rule
    could not turn into a list (they parse to NULL and lose all elements).
    One aggregate pass over ``df`` (map-side partial counts)."""
    ents = entities or {n: e for n, e in ENTITIES.items() if e.column in df.columns}
    aggs = []
    for name, e in ents.items():
        parsed = parse_array(e.column, e.schema)
        aggs += [F.count(e.column).alias(f"{name}__text"),
                 F.count_if(F.col(e.column).isNotNull() & parsed.isNull()).alias(f"{name}__failed")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(name).alias("entity"), F.col(f"{name}__text").alias("text_cells"),
                     F.col(f"{name}__failed").alias("failed_cells")) for name in ents]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
