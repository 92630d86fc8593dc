"""Multi-line CSV read by many tasks: a quote-parity prefix scan.

A newline ends a record only outside quotes, and whether a byte is inside quotes
depends on every quote before it, which is why a multi-line CSV file is usually one
task's.  Here each split of a file is read as lines, and what a split must know of
the bytes before it is one bit:

1. *count*: quotes per split, one row per split (a scan with a map-side aggregate;
   no text leaves the task);
2. *prefix*: the parity of all earlier splits of the file, a window over the rows of
   step 1 (one row per split);
3. *mark*: lines go to their split's partition; a running parity says for each line
   whether it starts outside quotes, that is, starts a record.  The lines of one
   record are joined there, with no further exchange;
4. *stitch*: a split's first lines may belong to a record of an earlier split.  Only
   these fragments, at most two per split, meet per file and are joined;
5. *parse*: every record is parsed on its own by ``from_csv``.

Doubled quotes leave the parity as it is.  A quote must open or close a field or be
doubled (RFC 4180): a lone quote inside an unquoted field would be taken for an opening
one.  Records end with ``\\n`` or ``\\r\\n``; empty lines between records are no record;
an unterminated quote takes the rest of its file into one record, as a parser would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SPLIT = ["_file", "_at"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, split offset, place and number of quotes modulo 2."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return text.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"),
                       F.monotonically_increasing_id().alias("_pos"), (quotes % 2).alias("_odd"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, first): every record's text, and whether it is its file's first."""
    in_order = Window.partitionBy("_file").orderBy("_at")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    splits = (_lines(spark, path).groupBy(*SPLIT).agg(F.sum("_odd").alias("_q"))
              .select(*SPLIT, F.coalesce(F.sum("_q").over(before), F.lit(0)).alias("_prefix"),
                      F.row_number().over(in_order).alias("_nth")))
    # lines are hashed by split once; the windows, the join and the aggregate below all use that
    lines = _lines(spark, path).repartition(*SPLIT)
    here = Window.partitionBy(*SPLIT).orderBy("_pos")
    inside = F.coalesce(F.sum("_odd").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumn("_inside", inside).join(splits, SPLIT)
    lines = lines.withColumn("_start", ((F.col("_prefix") + F.col("_inside")) % 2 == 0).cast("int"))
    lines = lines.withColumn("_rec", F.sum("_start").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    parts = (lines.groupBy(*SPLIT, "_rec")
             .agg(F.array_sort(F.collect_list(F.struct("_pos", "value"))).alias("_l"), (F.sum("_odd") % 2).alias("_odd"),
                  F.first("_nth").alias("_nth"))
             .select(*SPLIT, "_rec", "_odd", "_nth", F.array_join(F.col("_l.value"), "\n").alias("record")))
    whole = (F.col("_rec") > 0) & (F.col("_odd") == 0)
    done = parts.where(whole).select("record", ((F.col("_nth") == 1) & (F.col("_rec") == 1)).alias("first"))
    # the fragments: lines before a split's first record, and a last record that is still open
    chain = Window.partitionBy("_file").orderBy("_at", "_rec")
    pieces = parts.where(~whole).withColumn("_opens", F.sum((F.col("_rec") > 0).cast("int")).over(chain))
    joined = (pieces.groupBy("_file", "_opens")
              .agg(F.array_sort(F.collect_list(F.struct("_at", "_rec", "record"))).alias("_l"),
                   F.max((F.col("_nth") == 1) & (F.col("_rec") == 1)).alias("first")))
    joined = joined.select(F.array_join(F.col("_l.record"), "\n").alias("record"), "first")
    return done.unionByName(joined)


def read_split_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header record per file, columns by position; a field that does not
    fit its type becomes NULL on its own."""
    records = csv_records(spark, path).where(~F.col("first"))
    text = F.regexp_replace("record", "\r$", "")
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    # DDL in quoted names, so that any column name is taken literally
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return (records.select(text.alias("record")).where(F.col("record") != "")
            .select(F.from_csv("record", F.lit(ddl), options).alias("r")).select("r.*"))
