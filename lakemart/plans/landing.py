"""Landing files derived from the test tables (the raw-text edge of the lake).

Each function writes text files below the session's checkpoint root with a
distributed write and returns their location; the source operators then read
them back.  Formats follow the original landing files: header-less CSV,
``MM/dd/yyyy`` dates, a trailing comma on every ratings line, quoted multi-line
fields in the metadata file.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, StringType,
                               StructField, StructType)

from . import standins as S
from ..session import ended_shuffles_go, scratch_path


def ratings_text(spark, d) -> str:
    """user,movie,rating,MM/dd/yyyy HH:mm:ss,   (returned items have the ratings a
    typed column cannot hold: 'n/a', blank, NaN, or 1e12, which only a double can)."""
    li = S.table(spark, d, "lineitem")
    line = F.col("l_linenumber")
    odd = (F.when(line == 1, F.lit("n/a")).when(line == 2, F.lit("")).when(line == 3, F.lit("NaN"))
           .when(line == 4, F.lit("1e12")).otherwise(F.lit("-1e12")))
    rating = F.when(F.col("l_returnflag") == "R", odd).otherwise((F.col("l_quantity") / 4).cast("string"))
    line = F.concat_ws(",", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"), rating,
                       F.date_format("l_shipdate", "MM/dd/yyyy HH:mm:ss"), F.lit(""))
    path = scratch_path(spark, "landing-ratings")
    li.select(line.alias("value")).write.text(path)
    return path


def tags_text(spark, d) -> str:
    """Header-less tags CSV: user, movie, tag, MM/dd/yyyy HH:mm:ss."""
    t = S.tags(spark, d)
    out = t.select(F.col("user_id").cast("string"), F.col("movie_id").cast("string"), "tag",
                   F.date_format("created_at", "MM/dd/yyyy HH:mm:ss"))
    path = scratch_path(spark, "landing-tags")
    out.write.option("header", False).csv(path)
    return path


def users_text(spark, d) -> str:
    """Header-less users CSV: birth date as M/d/yyyy, registration as MM/dd/yyyy."""
    u = S.users(spark, d)
    out = u.select(F.col("user_id").cast("string"), "first_name", "last_name",
                   F.date_format("birth_date", "M/d/yyyy"), "country",
                   F.date_format("registration_date", "MM/dd/yyyy"))
    path = scratch_path(spark, "landing-users")
    out.write.option("header", False).csv(path)
    return path


def movies_text(spark, d) -> str:
    path = scratch_path(spark, "landing-movies")
    S.raw_movies(spark, d).write.option("header", False).csv(path)
    return path


def hero_stats_csv(spark, d) -> str:
    """character_stats.csv layout: header, capitalised names."""
    st = S.hero_stats(spark, d, whole=True)
    names = ["Name", "Alignment", "Intelligence", "Strength", "Speed", "Durability", "Power",
             "Combat", "Total"]
    path = scratch_path(spark, "landing-stats")
    st.toDF(*names).write.option("header", True).csv(path)
    return path


# Schema of the movie metadata file.
METADATA_SCHEMA = StructType([
    StructField("adult", BooleanType()), StructField("belongs_to_collection", StringType()),
    StructField("budget", IntegerType()),
    StructField("genres", StringType()), StructField("homepage", StringType()),
    StructField("id", IntegerType()), StructField("imdb_id", StringType()),
    StructField("original_language", StringType()), StructField("original_title", StringType()),
    StructField("overview", StringType()), StructField("popularity", DoubleType()),
    StructField("poster_path", StringType()),
    StructField("production_companies", StringType()), StructField("production_countries", StringType()),
    StructField("release_date", DateType()), StructField("revenue", IntegerType()),
    StructField("runtime", DoubleType()), StructField("spoken_languages", StringType()),
    StructField("status", StringType()), StructField("tagline", StringType()), StructField("title", StringType()),
    StructField("video", BooleanType()), StructField("vote_average", DoubleType()),
    StructField("vote_count", IntegerType()),
])


# Schemas of the two files with further list columns.
CREDITS_SCHEMA = StructType([StructField("cast", StringType()), StructField("crew", StringType()),
                             StructField("id", IntegerType())])
KEYWORDS_SCHEMA = StructType([StructField("id", IntegerType()), StructField("keywords", StringType())])


#: parts of the orders whose items are exchanged one after the other
ORDER_PARTS = 4

#: records of one part file: what one task has to read of an unsplittable file
CSV_RECORDS = 50_000


def _csv_files(df, schema: StructType, name: str) -> str:
    """A folder of CSV part files, each with a header and every field quoted.  Every
    task writes its own rows, in compressed files of bounded length."""
    text = df.select(*[F.col(f.name).cast("string").alias(f.name) for f in schema.fields])
    path = scratch_path(df.sparkSession, f"landing-{name}")
    with ended_shuffles_go(df.sparkSession):
        (text.write.option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True)
         .option("maxRecordsPerFile", CSV_RECORDS).option("compression", "gzip").csv(path))
    return path


def metadata_csv(spark, d) -> str:
    """The movie metadata files: quoted fields with embedded newlines, quotes and
    commas; revenue can exceed int."""
    from .nested_standins import metadata_text
    return _csv_files(metadata_text(spark, d), METADATA_SCHEMA, "metadata")


def metadata_read(spark, d):
    """The metadata files read with their schema: a field its type cannot hold is NULL."""
    from ..sources.readers import read_csv_multiline
    return read_csv_multiline(spark, metadata_csv(spark, d), METADATA_SCHEMA)


def movies_read(spark, d):
    """The files read, deny-listed and with the id prefix cut."""
    from ..functions.fixed import DENY_IMDB_IDS
    from ..operators.clean import deny_and_strip
    return deny_and_strip(metadata_read(spark, d), "imdb_id", DENY_IMDB_IDS)


def movie_files(spark, d, folders: dict[str, str] | None = None):
    """(movies, credits, keywords): the three sources written as files and read; the
    fixture's orders and items are landed once for all three, as narrow values, and go
    when the files are there.  ``folders`` receives the folder of each source.

    The exchanges that look up the items' values end before those by order begin, and the
    latter follow one another, a part of the orders at a time: their shuffle files, the
    largest of the whole job, are never on disk together.  No task can start in the midst
    of a compressed file, so each file is parsed by the task that reads it and no text is
    exchanged."""
    from .nested_standins import item_values, metadata_columns, order_items
    from ..functions.fixed import DENY_IMDB_IDS
    from ..operators.clean import deny_and_strip
    from ..session import landed, landed_parts, remove
    from ..sources.readers import read_csv_multiline
    items, items_path = landed(item_values(spark, d), "metadata-items")
    parts = {str(i): order_items(spark, d, items=items, part=(i, ORDER_PARTS)).withColumn("_part", F.lit(str(i)))
             for i in range(ORDER_PARTS)}
    met, path = landed_parts(parts, "_part", "metadata-rows")
    remove(spark, items_path)
    rows = metadata_columns(met).withColumn("crew", F.lit(None).cast("string"))
    schemas = {"metadata": METADATA_SCHEMA, "credits": CREDITS_SCHEMA, "keywords": KEYWORDS_SCHEMA}
    written = {name: _csv_files(rows, schema, name) for name, schema in schemas.items()}
    remove(spark, path)
    if folders is not None:
        folders.update(written)
    movies, credits, keywords = (read_csv_multiline(spark, written[name], schema, split=False) for name, schema in schemas.items())
    return deny_and_strip(movies, "imdb_id", DENY_IMDB_IDS), credits, keywords
