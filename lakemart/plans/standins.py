"""Reference-shaped inputs derived from the driver's test tables.

The original pipelines read movie-lens style files, hero CSVs and a news corpus
that are not available; every function here derives a table of the same shape
from the given Parquet tables with plain, lazy DataFrame expressions, so the
work of every query grows with the tables.  ``oracles.py`` holds the same
derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values of the stand-ins ---------------------------------------------
# (multiplier, offset) of the six hero attributes, each (c_custkey*m + o) % 101:
# Intelligence, Strength, Speed, Durability, Power, Combat.
HERO_ATTRS = [("intelligence", 37, 11), ("strength", 53, 7), ("speed", 71, 3),
              ("durability", 89, 17), ("power", 97, 29), ("combat", 59, 41)]
# Market segment -> alignment of the hero made from a customer.
SEGMENT_ALIGNMENT = {"BUILDING": "good", "MACHINERY": "good", "AUTOMOBILE": "bad",
                     "HOUSEHOLD": "bad", "FURNITURE": "neutral"}
# Segment missing from each hero table, so that the name sets differ.
STATS_MISSING, INFO_MISSING, POWERS_MISSING = "HOUSEHOLD", "MACHINERY", "FURNITURE"
# --- end of fixed values ---------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- movie-lens shapes ---------------------------------------------------------

def ratings(spark, d) -> DataFrame:
    """ratings(user_id int, movie_id int, rating double, created_at timestamp)."""
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_suppkey").cast("int").alias("user_id"),
                     F.col("l_partkey").cast("int").alias("movie_id"),
                     F.col("l_quantity").alias("rating"),
                     F.col("l_shipdate").alias("created_at"))


def movies(spark, d) -> DataFrame:
    """Typed movies(movie_id int, title string, genres array<string>)."""
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").cast("int").alias("movie_id"),
                    F.col("p_name").alias("title"),
                    F.array("p_type", "p_brand").alias("genres"))


def raw_movies(spark, d) -> DataFrame:
    """Landing movies(movie_id, title 'Base[: Sub] (yyyy)', genres 'a|b')."""
    p = table(spark, d, "part")
    year = (F.lit(1990) + F.col("p_size") % 30).cast("string")
    suffix = F.when(F.col("p_type") == "PROMO", F.lit(" (n/a)")).otherwise(
        F.concat(F.lit(" ("), year, F.lit(")")))
    sub = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(": "), F.col("p_brand"))).otherwise(F.lit(""))
    return p.select(F.col("p_partkey").cast("int").alias("movie_id"),
                    F.concat(F.col("p_name"), sub, suffix).alias("title"),
                    F.concat_ws("|", "p_type", "p_brand").alias("genres"))


def users(spark, d) -> DataFrame:
    """users(user_id int, first_name, last_name, birth_date date, country,
    registration_date date) — registration = first order date (NULL if none)."""
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")  # 25 rows by definition: broadcast is bounded
    first_order = (table(spark, d, "orders").groupBy("o_custkey")
                   .agg(F.min("o_orderdate").alias("first_order")))
    k = F.col("c_custkey")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .join(first_order, k == F.col("o_custkey"), "left")
            .select(k.cast("int").alias("user_id"),
                    F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
                    F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
                    F.make_date((1950 + k % 50).cast("int"), (1 + k % 12).cast("int"),
                                (1 + k % 28).cast("int")).alias("birth_date"),
                    F.col("n_name").alias("country"),
                    F.to_date("first_order").alias("registration_date")))


def tags(spark, d) -> DataFrame:
    """tags(user_id int, movie_id int, tag string, created_at timestamp)."""
    e = table(spark, d, "events")
    return e.select(F.col("user_id").cast("int").alias("user_id"),
                    F.get_json_object("props", "$.k").try_cast("int").alias("movie_id"),
                    F.col("event_type").alias("tag"),
                    F.col("ts").alias("created_at"))


# ---- heroes --------------------------------------------------------------------

def _alignment() -> F.Column:
    expr = None
    for seg, al in SEGMENT_ALIGNMENT.items():
        expr = (F.when(F.col("c_mktsegment") == seg, al) if expr is None
                else expr.when(F.col("c_mktsegment") == seg, al))
    return expr


def _heroes(spark, d, missing: str, whole: bool) -> DataFrame:
    """Customers; without ``whole`` one segment is absent, so that the tables' names differ."""
    c = table(spark, d, "customer")
    return c if whole else c.where(F.col("c_mktsegment") != missing)


def hero_stats(spark, d, whole: bool = False) -> DataFrame:
    """character_stats(name, alignment, six attributes, total)."""
    c = _heroes(spark, d, STATS_MISSING, whole)
    k = F.col("c_custkey")
    attrs = [((k * m + o) % 101).cast("int").alias(a) for a, m, o in HERO_ATTRS]
    out = c.select(F.col("c_name").alias("name"), _alignment().alias("alignment"), *attrs)
    return out.withColumn("total", sum((F.col(a) for a, _, _ in HERO_ATTRS), F.lit(0)))


def hero_info(spark, d, whole: bool = False) -> DataFrame:
    """characters_info(name, alignment, gender, race, publisher, height, weight)."""
    c = _heroes(spark, d, INFO_MISSING, whole)
    n = table(spark, d, "nation")  # 25 rows by definition
    r = table(spark, d, "region")  # 5 rows by definition
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
            .select(F.col("c_name").alias("name"), _alignment().alias("alignment"),
                    F.when(F.col("c_custkey") % 2 == 0, "Male").otherwise("Female").alias("gender"),
                    F.col("n_name").alias("race"), F.col("r_name").alias("publisher"),
                    (F.col("c_acctbal") / 20).alias("height"),
                    (F.col("c_acctbal") / 50).alias("weight")))


def hero_powers(spark, d) -> DataFrame:
    """superheroes_power_matrix(name, flight boolean)."""
    c = _heroes(spark, d, POWERS_MISSING, False)
    return c.select(F.col("c_name").alias("name"), (F.col("c_nationkey") % 3 == 0).alias("flight"))


# ---- news ----------------------------------------------------------------------

def news(spark, d) -> DataFrame:
    """bbc_news(ArticleID, Text, Category)."""
    doc = table(spark, d, "documents")
    return doc.select(F.col("doc_id").alias("ArticleID"), F.col("text").alias("Text"),
                      F.col("lang").alias("Category"))


# ---- grades --------------------------------------------------------------------

def grades(spark, d, status: str) -> DataFrame:
    """(student, grade): one row per order.  Finished orders (F) are the midterm
    list, open ones (O) the project list, all others go by even and odd key; a
    student can repeat and each side misses students of the other."""
    s = F.col("o_orderstatus")
    midterm = F.coalesce((s == "F") | (~s.isin("F", "O") & (F.col("o_orderkey") % 2 == 0)), F.lit(False))
    o = table(spark, d, "orders").where(midterm if status == "F" else ~midterm)
    return o.select(F.concat(F.lit("Student"), F.col("o_custkey").cast("string")).alias("student"),
                    (F.floor(F.col("o_totalprice")) % 101).cast("double").alias("grade"))
