"""Sinks: external Parquet tables, partitioned tables, positional inserts, CTAS,
Parquet export and CSV (optionally one directory per key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_external(df: DataFrame, path: str, table: str, fmt: str = "parquet",
                  bucket_by: Sequence[str] | None = None, buckets: int | None = None) -> DataFrame:
    """Overwrite files at ``path`` and register them as external ``table``.

    With ``bucket_by`` the table is bucketed (and sorted) by those columns, so later
    joins or aggregations on them between tables bucketed the same way need no
    shuffle.  Rows are clustered by bucket first, so that a bucket is one file and
    not one per writing task."""
    if bucket_by:
        n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(n, *bucket_by)       # the bucket's own hash and modulus
    w = df.write.option("path", path).mode("overwrite")
    if bucket_by:
        w = w.bucketBy(n, *bucket_by).sortBy(*bucket_by)
    w.saveAsTable(table, format=fmt)
    return df.sparkSession.table(table)


def save_partitioned(df: DataFrame, path: str, table: str, keys: Sequence[str],
                     fmt: str = "parquet") -> DataFrame:
    """Dynamic-partition write by ``keys`` (they move to the end of the schema).

    Rows are clustered by the keys with a ``rebalance`` hint, so each writer
    task opens few partition directories while AQE still splits a key that
    holds a large share of the rows over several tasks (a plain
    ``repartition(keys)`` would give such a key to one task).  With dynamic
    overwrite a re-run replaces only the partitions present in ``df``.
    """
    keys = list(keys)
    ordered = df.select(*[c for c in df.columns if c not in keys], *keys)
    (ordered.hint("rebalance", *keys).write.partitionBy(*keys).option("path", path)
     .mode("overwrite").saveAsTable(table, format=fmt))
    return df.sparkSession.table(table)


def insert_into(df: DataFrame, table: str, overwrite: bool = False) -> DataFrame:
    """Append (or dynamically overwrite) ``df`` into an existing table, by position."""
    df.write.insertInto(table, overwrite=overwrite)
    return df.sparkSession.table(table)


def create_table_as(spark: SparkSession, table: str, query: str, path: str | None = None) -> DataFrame:
    """CTAS from SQL text."""
    w = spark.sql(query).write.mode("overwrite")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table, format="parquet")
    return spark.table(table)


def export_parquet(spark: SparkSession, table: str, prefix: str) -> str:
    """Export a table to ``<prefix>/<table>.parquet``; returns the location."""
    path = f"{prefix.rstrip('/')}/{table}.parquet"
    spark.table(table).write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, keys: Sequence[str] | None = None,
              order: Sequence | None = None) -> str:
    """CSV out; ``keys`` gives one directory per key value (e.g. good / bad);
    ``order`` sorts the rows inside each written file."""
    if keys:
        df = df.hint("rebalance", *keys)   # clustered by key, hot keys split by AQE
    if order:
        df = df.sortWithinPartitions(*order)
    w = df.write.mode("overwrite").option("header", header)
    if keys:
        w = w.partitionBy(*keys)
    w.csv(path)
    return path


def preview_rows(df: DataFrame, n: int = 20) -> DataFrame:
    """The rows a preview prints: the first ``n``, every value as the text shown
    (NULL as ``NULL``)."""
    shown = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NULL")).alias(c) for c in df.columns]
    return df.limit(n).select(*shown)


def preview(df: DataFrame, n: int = 20) -> None:
    preview_rows(df, n).show(n, truncate=False)


# Movie key of each mart table that is bucketed by movie (see save_star_schema).
MOVIE_KEYS = {"movies_table_ext": "id", "ratings_ext": "movieId"}


def save_star_schema(tables: dict[str, DataFrame], root: str, database: str,
                     buckets: int | None = None) -> dict[str, DataFrame]:
    """Write every mart table as an external Parquet table ``database.name`` at
    ``root/name`` (one distributed write each) and return catalog scans.

    With ``buckets`` the movie table, the ratings fact and every bridge are
    bucketed by their movie key into the same number of buckets, so joins of a
    bridge with the movie table (the label export) read co-located buckets
    instead of shuffling both sides."""
    spark = next(iter(tables.values())).sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{database}`")
    out = {}
    for name, df in tables.items():
        key = MOVIE_KEYS.get(name, "movie_id" if name.endswith("_movies_ext") else None)
        bucket = [key] if (buckets and key) else None
        out[name] = save_external(df, f"{root.rstrip('/')}/{name}", f"{database}.{name}",
                                  bucket_by=bucket, buckets=buckets)
    return out
