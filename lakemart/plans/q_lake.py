"""Queries of the lake edge: sources, sinks, catalog and typing/cleaning.

Source and sink queries write files derived from the tables below the session's
checkpoint root (a fresh folder per call), then return a lazy read of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, IntegerType, StringType, StructField, StructType)

from . import landing as L
from . import nested_standins as NS
from . import standins as S
from .registry import query, r4
from ..functions.fixed import DENY_IMDB_IDS
from ..operators import clean, tags as tagops
from ..session import scratch_path
from ..sources import catalog as C
from ..sources import readers as R
from ..sources import sinks as K

RATING_COLS = ["user_id", "movie_id", "rating", "created_at"]
USER_COLS = ["user_id", "first_name", "last_name", "birth_date", "country", "registration_date"]
MOVIE_COLS = ["movie_id", "title", "genres"]
TAG_COLS = ["user_id", "movie_id", "tag", "created_at"]
SCRATCH_DB = "lakemart_scratch"


def _ts_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _scratch_table(spark, stem: str) -> str:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {SCRATCH_DB}")
    return f"{SCRATCH_DB}.{stem}_{uuid.uuid4().hex[:10]}"


def _users_report(df):
    return df.select("user_id", "first_name", "last_name", F.col("birth_date").cast("string").alias("birth_date"),
                     "country", F.col("registration_date").cast("string").alias("registration_date"),
                     "registration_year")


# ---- sources ----------------------------------------------------------------------

@query("src_delimited")
def src_delimited(spark, d):
    return R.read_delimited(spark, L.ratings_text(spark, d), RATING_COLS, trailing_sep=True)


@query("src_csv_inferred")
def src_csv_inferred(spark, d):
    return R.read_csv_inferred(spark, L.hero_stats_csv(spark, d))


@query("src_csv_multiline")
def src_csv_multiline(spark, d):
    m = L.metadata_read(spark, d)
    return m.select("id", "imdb_id", "overview", "revenue", F.col("release_date").cast("string").alias("release_date"),
                    "popularity", "adult")


@query("src_wordlist")
def src_wordlist(spark, d):
    path = scratch_path(spark, "landing-words")
    S.table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("value")).write.text(path)
    return R.read_wordlist(spark, path)


@query("src_literal_rows")
def src_literal_rows(spark, d):
    lookup = R.rows(spark, list(S.SEGMENT_ALIGNMENT.items()), "segment string, alignment string")
    c = S.table(spark, d, "customer")
    return (c.join(F.broadcast(lookup), c.c_mktsegment == lookup.segment)  # literal rows: bounded
            .groupBy("alignment").agg(F.count(F.lit(1)).alias("customers")))


@query("src_table")
def src_table(spark, d):
    view = f"customers_{uuid.uuid4().hex[:8]}"
    S.table(spark, d, "customer").createOrReplaceTempView(view)
    by_name = R.read_table(spark, view)
    by_sql = R.read_table(spark, f"SELECT c_mktsegment, count(*) AS n FROM {view} GROUP BY c_mktsegment")
    sums = by_name.groupBy("c_mktsegment").agg(F.round(F.sum("c_acctbal"), 2).alias("acctbal"))
    return by_sql.join(sums, "c_mktsegment")


@query("src_parquet")
def src_parquet(spark, d):
    o = R.read_external(spark, f"{d.rstrip('/')}/orders.parquet")
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"),
                                          F.max("o_totalprice").alias("max_totalprice"))


@query("src_labelled_files")
def src_labelled_files(spark, d):
    root = scratch_path(spark, "labelled")
    e = S.table(spark, d, "embeddings")
    (e.select(F.col("label").cast("string").alias("label"), F.col("vec_id").cast("string").alias("value"))
     .hint("rebalance", "label").write.partitionBy("label").text(root))
    files = R.scan_labelled_files(spark, root)
    return files.groupBy("label").agg(F.sum("length").alias("n_bytes"))


# ---- cleaning ---------------------------------------------------------------------

def _landed_ratings(spark, d):
    return R.read_delimited(spark, L.ratings_text(spark, d), RATING_COLS, trailing_sep=True)


@query("prj_conform_ratings")
def prj_conform_ratings(spark, d):
    r = clean.conform_ratings(_landed_ratings(spark, d))
    return r.select("user_id", "movie_id", "rating", _ts_text("created_at").alias("created_at"))


@query("prj_conform_ratings_integral")
def prj_conform_ratings_integral(spark, d):
    r = clean.conform_ratings(_landed_ratings(spark, d), integral=True)
    return r.select("user_id", "movie_id", "rating", _ts_text("created_at").alias("created_at"))


@query("prj_conform_users")
def prj_conform_users(spark, d):
    u = clean.conform_users(R.read_delimited(spark, L.users_text(spark, d), USER_COLS))
    return _users_report(u)


@query("prj_split_title")
def prj_split_title(spark, d):
    m = clean.conform_movies(R.read_delimited(spark, L.movies_text(spark, d), MOVIE_COLS))
    return m.select("movie_id", "title", "movie_year")


@query("prj_split_list")
def prj_split_list(spark, d):
    m = clean.conform_movies(R.read_delimited(spark, L.movies_text(spark, d), MOVIE_COLS))
    return m.select("movie_id", F.array_join("genres", ",").alias("genres"), F.size("genres").alias("n_genres"))


@query("prj_deny_strip")
def prj_deny_strip(spark, d):
    m = clean.deny_and_strip(NS.metadata_text(spark, d, ("keywords",)), "imdb_id", DENY_IMDB_IDS)
    return m.select("id", "imdb_id")


@query("prj_clamp")
def prj_clamp(spark, d):
    return clean.clamp_negative(S.hero_info(spark, d, whole=True), ["height", "weight"]).select("name", "height", "weight")


@query("prj_fill")
def prj_fill(spark, d):
    stats, powers = S.hero_stats(spark, d), S.hero_powers(spark, d)
    names = stats.select("name").union(powers.select("name")).distinct()
    wide = names.join(stats.drop("alignment"), "name", "left").join(powers, "name", "left")
    return clean.fill_defaults(wide, numeric=[c for c in wide.columns if c not in ("name", "flight")])


# ---- sinks ------------------------------------------------------------------------

@query("snk_external")
def snk_external(spark, d):
    table = _scratch_table(spark, "ratings_ext")
    fact = NS.ratings_raw(spark, d).select("userId", "movieId", "rating")
    back = K.save_external(fact, scratch_path(spark, "ratings_ext"), table)
    assert C.table_type(spark, table) == "EXTERNAL"
    return back


@query("snk_partitioned")
def snk_partitioned(spark, d):
    users = clean.conform_users(R.read_delimited(spark, L.users_text(spark, d), USER_COLS))
    table = _scratch_table(spark, "users_partitioned")
    back = K.save_partitioned(users, scratch_path(spark, "users_partitioned"), table,
                              ["country", "registration_year"])
    return _users_report(back)


TAG_LIST_SCHEMA = StructType([StructField("user_id", IntegerType()), StructField("movie_id", IntegerType()),
                              StructField("tags", ArrayType(StringType()))])


@query("snk_insert_into")
def snk_insert_into(spark, d):
    table = _scratch_table(spark, "tags_with_list")
    C.create_table(spark, table, TAG_LIST_SCHEMA)
    # landing text -> typed tags -> list per (user, movie) -> positional insert
    landed = clean.conform_tags(R.read_delimited(spark, L.tags_text(spark, d), TAG_COLS))
    lists = tagops.tag_lists(landed)
    back = K.insert_into(lists.select(*TAG_LIST_SCHEMA.fieldNames()), table)
    return back.select("user_id", "movie_id", F.array_join("tags", ",").alias("tags"))


@query("snk_ctas")
def snk_ctas(spark, d):
    view = f"ratings_{uuid.uuid4().hex[:8]}"
    NS.ratings_raw(spark, d).createOrReplaceTempView(view)
    table = _scratch_table(spark, "votes")
    back = K.create_table_as(spark, table, f"""
        SELECT movieId, avg(rating) AS vote_average, CAST(count(rating) AS INT) AS vote_count
        FROM {view} GROUP BY movieId""")
    return back.select("movieId", r4("vote_average").alias("vote_average"), "vote_count")


@query("snk_export")
def snk_export(spark, d):
    table = _scratch_table(spark, "users_modified")
    users = clean.conform_users(R.read_delimited(spark, L.users_text(spark, d), USER_COLS))
    users.write.saveAsTable(table, format="parquet")
    path = K.export_parquet(spark, table, scratch_path(spark, "export"))
    return _users_report(R.read_external(spark, path))


@query("snk_csv")
def snk_csv(spark, d):
    from ..operators.ranking import top_by_alignment
    top = top_by_alignment(S.hero_stats(spark, d, whole=True), S.hero_info(spark, d, whole=True),
                           publishers=["AMERICA", "EUROPE"], n=10)
    path = K.write_csv(top, scratch_path(spark, "top_heroes"), header=True, keys=["alignment"])
    back = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return back.select("alignment", "name", "score", "gender", "race", "universe")


@query("snk_preview")
def snk_preview(spark, d):
    c = S.table(spark, d, "customer").orderBy("c_custkey").select("c_custkey", "c_name", "c_mktsegment")
    return K.preview_rows(c, 20)


# ---- catalog ----------------------------------------------------------------------

@query("cat_lifecycle")
def cat_lifecycle(spark, d):
    db = f"lakemart_cat_{uuid.uuid4().hex[:8]}"
    steps = []
    C.create_database(spark, db, location=scratch_path(spark, "db"))
    steps.append(("create_database", C.database_exists(spark, db)))
    C.describe_database(spark, db, "movies mart")
    steps.append(("describe_database", (C.database_comment(spark, db) or "") == "movies mart"))
    steps.append(("database_exists", C.database_exists(spark, db) and not C.database_exists(spark, db + "_no")))
    stats = S.hero_stats(spark, d, whole=True)
    C.create_table(spark, f"{db}.stats", stats.schema)
    steps.append(("create_table", spark.table(f"{db}.stats").count() == 0
                  and spark.table(f"{db}.stats").columns == stats.columns))
    path = scratch_path(spark, "external")
    stats.write.parquet(path)
    C.create_external(spark, f"{db}.stats_ext", path)
    steps.append(("create_external", spark.table(f"{db}.stats_ext").count() == stats.count()))
    C.drop_table(spark, f"{db}.stats")
    steps.append(("drop_table", not spark.catalog.tableExists(f"{db}.stats")))
    C.drop_database(spark, db, cascade=True)
    steps.append(("drop_database", not C.database_exists(spark, db)))
    return spark.createDataFrame(steps, "step string, ok boolean")


# ---- incremental (streaming) ingestion ----------------------------------------------

@query("stream_conform_ratings")
def stream_conform_ratings(spark, d):
    """Landing ratings arrive as files; an availableNow stream types them into
    a Parquet table (exactly-once, checkpointed); the table is read back."""
    from ..streaming.ingest import ingest
    landing = L.ratings_text(spark, d)
    target = scratch_path(spark, "stream-ratings")
    ingest(spark, landing, RATING_COLS, clean.conform_ratings, target,
           scratch_path(spark, "stream-ratings-ckpt"), trailing_sep=True)
    r = spark.read.parquet(target)
    return r.select("user_id", "movie_id", "rating", _ts_text("created_at").alias("created_at"))
