"""Sources: delimited landing files, CSV with header, multi-line CSV, word
lists, literal rows, catalog tables, Parquet locations and labelled file trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .multiline import read_split_csv


def string_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str] | StructType,
                   sep: str = ",", trailing_sep: bool = False, quotes: bool = True) -> DataFrame:
    """Header-less delimited landing read, every column as text.

    Quoted fields are honoured; ``quotes=False`` splits on every separator like
    a plain delimited text table (a quoted comma then shifts the columns).
    ``trailing_sep`` reads the empty field that a separator at the end of each
    line produces and drops it.
    """
    names = columns.fieldNames() if isinstance(columns, StructType) else list(columns)
    read_names = names + (["_trailing"] if trailing_sep else [])
    reader = (spark.read.schema(string_schema(read_names)).option("sep", sep)
              .option("header", False).option("mode", "PERMISSIVE"))
    if not quotes:
        reader = reader.option("quote", "\u0000")
    return reader.csv(path).select(*names)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row; types inferred (one extra pass over the input)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv_multiline(spark: SparkSession, path: str, schema: StructType, split: bool = True) -> DataFrame:
    """CSV with header and explicit schema whose quoted fields may hold newlines;
    a quote inside a field is doubled.  ``path`` may be a file or a directory of part
    files.  A field that does not fit its type becomes NULL on its own.

    A file is read by many tasks (``sources.multiline``).  ``split=False`` reads each
    file in one task with Spark's own multi-line parser, which also takes files with
    lone quotes inside unquoted fields."""
    if split:
        return read_split_csv(spark, path, schema)
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
            .csv(path))


def read_wordlist(spark: SparkSession, path: str, column: str = "word") -> DataFrame:
    """One token per line (blank lines and punctuation included), de-duplicated."""
    return spark.read.text(path).select(F.col("value").alias(column)).distinct()


def rows(spark: SparkSession, data, schema) -> DataFrame:
    """DataFrame from in-memory literals (small lookup tables only)."""
    return spark.createDataFrame(data, schema)


def read_table(spark: SparkSession, name_or_sql: str) -> DataFrame:
    """A catalog table by name, or the result of SQL text."""
    text = name_or_sql.strip()
    if " " in text or "\n" in text:
        return spark.sql(text)
    return spark.table(text)


def read_external(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan an external location (Parquet unless told otherwise)."""
    return spark.read.format(fmt).load(path)


def scan_labelled_files(spark: SparkSession, root: str, glob: str | None = None,
                        strip_key: bool = True) -> DataFrame:
    """(path, label, length) of every file below ``root``; the parent directory
    names the label (``key=value`` directories give ``value``).  The file
    content column is never selected, so file bodies are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(root)
    parent = F.element_at(F.split("path", "/"), -2)
    label = F.regexp_replace(parent, r"^[^=]*=", "") if strip_key else parent
    return df.select("path", label.alias("label"), "length")
