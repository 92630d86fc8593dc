"""Typing and cleaning of landing text (ANSI-safe: try_* casts, never a throw)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from ..functions.text import split_list, title_text, title_year

DATE_PATTERN = "M/d/yyyy"             # takes both 01/05/2001 and 1/5/2001
TIMESTAMP_PATTERN = "M/d/yyyy H:mm:ss"


def _date(c: str):
    return F.try_to_date(F.col(c), DATE_PATTERN)


def conform_users(df: DataFrame) -> DataFrame:
    """id -> int; birth / registration dates parsed; ``registration_year`` added."""
    reg = _date("registration_date")
    return df.select(F.col("user_id").try_cast("int").alias("user_id"),
                     "first_name", "last_name",
                     _date("birth_date").alias("birth_date"),
                     "country",
                     reg.alias("registration_date"),
                     F.year(reg).cast("short").alias("registration_year"))


def conform_ratings(df: DataFrame, integral: bool = False) -> DataFrame:
    """ids -> int; rating -> double (``integral``: truncated int); created_at
    parsed from ``MM/dd/yyyy HH:mm:ss``.  Bad text -> NULL."""
    rating = F.col("rating").try_cast("double")
    if integral:
        rating = rating.try_cast("int")     # NULL beyond the int range and for NaN
    return df.select(F.col("user_id").try_cast("int").alias("user_id"),
                     F.col("movie_id").try_cast("int").alias("movie_id"),
                     rating.alias("rating"),
                     F.try_to_timestamp(F.col("created_at"), F.lit(TIMESTAMP_PATTERN)).alias("created_at"))


def conform_tags(df: DataFrame) -> DataFrame:
    return df.select(F.col("user_id").try_cast("int").alias("user_id"),
                     F.col("movie_id").try_cast("int").alias("movie_id"),
                     "tag",
                     F.try_to_timestamp(F.col("created_at"), F.lit(TIMESTAMP_PATTERN)).alias("created_at"))


def split_title(df: DataFrame, col: str = "title") -> DataFrame:
    """``title`` re-laid out (subtitle first), ``movie_year`` from its suffix."""
    return df.withColumn("movie_year", title_year(col)).withColumn(col, title_text(col))


def conform_movies(df: DataFrame) -> DataFrame:
    """Landing movies -> (movie_id int, title, movie_year int, genres array)."""
    return df.select(F.col("movie_id").try_cast("int").alias("movie_id"),
                     title_text("title").alias("title"),
                     title_year("title").alias("movie_year"),
                     split_list("genres", "|").alias("genres"))


def deny_and_strip(df: DataFrame, col: str, deny: Sequence[str], prefix_len: int = 2) -> DataFrame:
    """Drop rows whose ``col`` is in ``deny`` (and NULL ids, as ``NOT IN`` does),
    then cut the first ``prefix_len`` characters.  The deny list is a literal
    IN-set, evaluated in the scan's filter — no join."""
    kept = df.where(~F.col(col).isin(list(deny)))
    return kept.withColumn(col, F.col(col).substr(F.lit(prefix_len + 1), F.length(col)))


def clamp_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``x > 0 ? x : 0`` on each column; NULL -> 0."""
    for c in cols:
        df = df.withColumn(c, F.when(F.col(c) > 0, F.col(c)).otherwise(F.lit(0).cast(df.schema[c].dataType)))
    return df


def fill_defaults(df: DataFrame, numeric: Sequence[str] = (), boolean: bool = True) -> DataFrame:
    """NULL -> 0 on the named numeric columns; NULL -> False on every boolean column."""
    numeric = [c for c in numeric if isinstance(df.schema[c].dataType, NumericType)]
    if numeric:
        df = df.fillna(0, subset=numeric)
    if boolean:
        bools = [f.name for f in df.schema.fields if isinstance(f.dataType, BooleanType)]
        if bools:
            df = df.fillna(False, subset=bools)
    return df
