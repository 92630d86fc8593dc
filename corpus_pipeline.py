"""Corpus pipeline: toxicity, near-dedup, decontamination, mixing, token files.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents.  All but the last return
the columns of ``documents``.

1. toxicity: a model is trained on the stage's own documents with the ``labels``
   table, outside the held-out fold (crc32 of the id modulo 3 is 1); documents that
   score 0.7 or more go.
2. near_dedup: rows linked at 80 % Jaccard similarity of 5-word shingles form
   groups; one row of each group stays, of the smallest id (a null id counts as the
   largest).  Of word-less rows that repeat an id with equal texts one stays.
3. decontaminate: rows in which a benchmark window occurs go.
4. mix: sources are mixed by temperature; every document is read at least once and
   rare sources are repeated, four times at most.
5. tokens: the mixture's token files are written and read back, one row per document
   copy.

Stages 2 and 3 decide for every row by a landed row number, never by its id: rows that
repeat an id, or have none, are judged by their own text.

A null text stays until the last stage, where it is a document of one end id.

What a stage writes on its way is dropped when the next stage is called in the
session, so its result must be written by then.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.decontaminate import contamination
from lakemart.llm.mixing import Mixture, mixed
from lakemart.llm.near_dup import near_duplicates
from lakemart.llm.scratch import drop, drop_unread, land, written
from lakemart.llm.tables import fold, ship, table
from lakemart.llm.token_files import token_table
from lakemart.llm.toxicity import reject_toxic, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: SQL cannot state a trained stage or a tokenizer; tests compare with brute force
ORACLE_SQL = None


_left: list[str] = []


def _stage(fn):
    """A stage that first drops what earlier stages wrote on their way (their results
    are written tables by then, and folders that ``docs`` itself reads stay)."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        _left[:] = drop_unread(spark, _left, docs)
        with written() as paths:
            out = fn(spark, docs, sf_dir)
            _left.extend(paths)
        return out
    return run_stage


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    return reject_toxic(docs, train(docs, labels)).select(*COLUMNS)


def _keyed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` landed with a number of their own (``row``) for every row."""
    return land(docs.withColumn("row", F.monotonically_increasing_id()), name)[0]


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _keyed(docs.select(*COLUMNS), "near-dedup-rows")
    groups = near_duplicates(docs, id_col="row", shingle=5).select("row", "component_id")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")
    stays = groups.join(docs.select("row", "doc_id"), "row").groupBy("component_id").agg(best).select("best.row")
    kept = docs.join(stays, "row", "left_semi")
    # texts without words link with nothing: of a repeated id's equal ones one stays
    plain = kept.where("doc_id is not null and (text is null or not text rlike '[^ \t-\r]')")
    again = (plain.groupBy("doc_id", "text").agg(F.min("row").alias("first"), F.max("row").alias("last"))
             .where("first < last").select(F.col("doc_id").alias("i"), F.col("text").alias("t"), "first"))
    copies = (plain.join(again, (F.col("doc_id") == F.col("i")) & F.col("text").eqNullSafe(F.col("t")))
              .where("row > first").select("row"))
    return kept.join(copies, "row", "left_anti").select(*COLUMNS)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _keyed(docs.select(*COLUMNS), "decontaminate-rows")
    hit = (contamination(docs, table(spark, sf_dir, "benchmark"), id_col="row").where("contaminated").select("row"))
    return docs.join(hit, "row", "left_anti").select(*COLUMNS)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs, Mixture()).select(*COLUMNS)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_table(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix),
          ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a written table, dropped
    once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            drop(spark, before)
        before = path
    return docs
