"""End-to-end pipelines built from the library's operators and sinks.

Each job reads the driver tables below ``sf_dir`` (through the stand-in
derivations), runs one pipeline as Spark jobs and writes its outputs below
``out``; it returns ``{output name: row count}``.

    python -m lakemart.jobs <job> --sf /root/testdata/sf0.01 --out <folder> [--db name]

Jobs: ``lake`` (landing text -> typed tables, partitioned users, tag lists,
genre keys), ``star`` (metadata -> 14 external mart tables), ``heroes`` (top 10
good / bad per publisher list, one CSV folder per alignment), ``keywords``
(top-3 tags per article as CSV), ``teams`` (teams + tournament as CSV),
``labels`` (genre pairs CSV, shard ranges and fetch plan; from the star
job's tables when given ``--db``).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import clean, labels as LB, nested as N, ranking, roster as RO, tags, text
from .operators import tournament as TR
from .plans import landing as L, nested_standins as NS, standins as S
from .session import cut_lineage
from .sources import catalog as C, readers as R, sinks as K


def _counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    return {name: df.count() for name, df in tables.items()}


def lake_job(spark: SparkSession, sf_dir: str, out: str, db: str = "movies") -> dict[str, int]:
    """Landing text -> typed tables: partitioned users, tag lists, typed movies
    with a genre-key dimension, typed ratings."""
    C.create_database(spark, db)
    users = clean.conform_users(R.read_delimited(spark, L.users_text(spark, sf_dir),
                                                 ["user_id", "first_name", "last_name", "birth_date", "country",
                                                  "registration_date"]))
    ratings = clean.conform_ratings(R.read_delimited(spark, L.ratings_text(spark, sf_dir),
                                                     ["user_id", "movie_id", "rating", "created_at"],
                                                     trailing_sep=True))
    tag_rows = clean.conform_tags(R.read_delimited(spark, L.tags_text(spark, sf_dir),
                                                   ["user_id", "movie_id", "tag", "created_at"]))
    movies = clean.conform_movies(R.read_delimited(spark, L.movies_text(spark, sf_dir),
                                                   ["movie_id", "title", "genres"]))
    movies = cut_lineage(movies, "movies-typed")       # read by the genre dimension and by the movie table
    genre_dim = N.surrogate_key(movies.select(F.explode("genres").alias("genre_name")), "genre_name", "genre_id")
    saved = {
        "users_partitioned": K.save_partitioned(users, f"{out}/users_partitioned", f"{db}.users_partitioned",
                                                ["country", "registration_year"]),
        "tags_with_list": K.save_external(tags.tag_lists(tag_rows), f"{out}/tags_with_list", f"{db}.tags_with_list"),
        "genres_table": K.save_external(genre_dim, f"{out}/genres_table", f"{db}.genres_table"),
        "movies_final": K.save_external(N.genre_ids(movies, genre_dim), f"{out}/movies_final", f"{db}.movies_final"),
        "ratings": K.save_external(ratings, f"{out}/ratings", f"{db}.ratings"),
    }
    return _counts(saved)


def star_job(spark: SparkSession, sf_dir: str, out: str, db: str = "movies",
             buckets: int | None = None) -> dict[str, int]:
    """Movie metadata, credits, keywords and ratings -> 14 external mart tables
    (movie table, ratings and bridges bucketed by movie when ``buckets``)."""
    sources = NS.file_sources(spark, sf_dir)
    star = N.star_schema(*sources)
    counts = _counts(K.save_star_schema(star, out, db, buckets=buckets))
    star.release()
    # cells whose list text the repair rule could not parse lose all their elements: report them
    for source in sources[:3]:
        for r in N.parse_report(source).collect():    # one row per list column
            counts[f"unparsed_{r.entity}"] = r.failed_cells
    return counts


def heroes_job(spark: SparkSession, sf_dir: str, out: str, publishers=("AMERICA", "EUROPE"),
               n: int = 10) -> dict[str, int]:
    """Top n heroes by total per alignment (good / bad), one CSV folder each."""
    top = ranking.top_by_alignment(S.hero_stats(spark, sf_dir, whole=True), S.hero_info(spark, sf_dir, whole=True), list(publishers), n)
    K.write_csv(top, f"{out}/top_heroes", header=True, keys=["alignment"], order=[F.desc("score"), "name"])
    return {f"top_{r.alignment}": r["count"] for r in top.groupBy("alignment").count().collect()}


def keywords_job(spark: SparkSession, sf_dir: str, out: str) -> dict[str, int]:
    """ArticleID, Category, Tag, Frequency for every article with a tag."""
    kw = cut_lineage(text.keywords(S.news(spark, sf_dir)), "keywords")
    K.write_csv(kw, f"{out}/resultset", header=True)
    return {"resultset": kw.count()}


def teams_job(spark: SparkSession, sf_dir: str, out: str, n_teams: int = 8, size: int = 5,
              seed: int = 42, brackets: int = 4) -> dict[str, int]:
    """Teams with roles and profile, then the tournament rounds."""
    teams = cut_lineage(RO.draft_teams(S.hero_stats(spark, sf_dir), S.hero_info(spark, sf_dir),
                                       S.hero_powers(spark, sf_dir), n_teams, size, seed).drop("team"), "teams")
    K.write_csv(teams, f"{out}/teams", header=True)
    rounds = TR.tournament(teams, brackets, seed)
    K.write_csv(rounds, f"{out}/tournament", header=True)
    return {"teams": teams.count(), "tournament": rounds.count()}


def labels_job(spark: SparkSession, sf_dir: str, out: str, n: int | None = None, parts: int = 5,
               db: str | None = None) -> dict[str, int]:
    """(imdb_id, genre) pairs as header-less CSV, their shard ranges and the
    fetch / copy plan.  With ``db`` the pairs are read from the mart tables the
    star job wrote there (movie table, genre bridge, genre dimension);
    otherwise they are derived from the metadata directly."""
    if db:
        movies = R.read_table(spark, f"{db}.movies_table_ext")
        bridge = R.read_table(spark, f"{db}.genres_movies_ext")
        dim = R.read_table(spark, f"{db}.genres_ext")
    else:
        ent = N.ENTITIES["genres"]
        movies = cut_lineage(NS.movies_whole(spark, sf_dir).select("id", "imdb_id", ent.column), "genre-meta")
        rows = N.explode_entities(movies, ent)
        bridge, dim = N.bridge(rows, ent), N.dimension(rows, ent)
    pairs = cut_lineage(LB.label_pairs(movies, bridge, dim, n), "label-pairs")
    K.write_csv(pairs, f"{out}/movie_genres", header=False)
    plan = LB.fetch_plan(LB.assign_shards(pairs, parts))
    K.write_csv(plan, f"{out}/fetch_plan", header=True, keys=["shard"])
    return {"movie_genres": pairs.count(), "fetch_plan": plan.count()}


JOBS = {"lake": lake_job, "star": star_job, "heroes": heroes_job, "keywords": keywords_job,
        "teams": teams_job, "labels": labels_job}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m lakemart.jobs")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--sf", required=True, help="folder with the input tables")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--db", default=None, help="catalog database for lake / star; labels: read the mart from it "
                         "(needs the session catalog the star job wrote to, e.g. a shared metastore)")
    ap.add_argument("--buckets", type=int, default=None, help="star: bucket movie-keyed tables into this many buckets")
    ap.add_argument("--limit", type=int, default=None, help="labels: export this many pairs only (default: all)")
    args = ap.parse_args(argv)
    from .session import apply_defaults
    spark = apply_defaults(SparkSession.builder.appName(f"lakemart-{args.job}")
                           .config("spark.ui.enabled", "false").getOrCreate())
    kwargs = {"db": args.db} if args.db and args.job in ("lake", "star", "labels") else {}
    if args.buckets and args.job == "star":
        kwargs["buckets"] = args.buckets
    if args.limit and args.job == "labels":
        kwargs["n"] = args.limit
    print(json.dumps(JOBS[args.job](spark, args.sf, args.out, **kwargs)))


if __name__ == "__main__":
    main()
