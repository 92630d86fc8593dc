"""Catalog: namespaces and tables (create, describe, exists, drop, external)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def create_database(spark: SparkSession, name: str, location: str | None = None,
                    comment: str | None = None) -> None:
    sql = f"CREATE SCHEMA IF NOT EXISTS {_q(name)}"
    if comment:
        sql += " COMMENT '" + comment.replace("'", "\\'") + "'"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def describe_database(spark: SparkSession, name: str, text: str) -> None:
    """Set the namespace description."""
    spark.sql(f"COMMENT ON SCHEMA {_q(name)} IS '" + text.replace("'", "\\'") + "'")


def database_comment(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE SCHEMA EXTENDED {_q(name)}").collect()  # a few metadata rows
    for r in rows:
        if r[0].strip().lower() in ("comment", "description"):
            return r[1]
    return None


def database_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.databaseExists(name)


def drop_database(spark: SparkSession, name: str, cascade: bool = True) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS {_q(name)}" + (" CASCADE" if cascade else ""))


def create_table(spark: SparkSession, name: str, schema: StructType, fmt: str = "parquet") -> None:
    """Empty typed (managed) table."""
    spark.catalog.createTable(name, schema=schema, source=fmt)


def create_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Register existing files as an external table."""
    spark.catalog.createTable(name, path=path, source=fmt)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_q(name)}")


def table_type(spark: SparkSession, name: str) -> str:
    db, _, tbl = name.rpartition(".")
    return spark.catalog.getTable(name).tableType
