"""Reading the given tables and the registry of this subpackage's queries."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            ship(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn
    return register


_shipped: set[str] = set()
#: rows of an Arrow batch, in place of Spark's default of 10,000: whole texts are long
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def ship(spark: SparkSession) -> None:
    """Prepare a session for the subpackage's tasks: batches of ``BATCH_ROWS`` rows,
    unless the session has a number of its own, and the package importable by Python
    workers (nothing to do if they start in its folder or have it on PYTHONPATH, else
    its zip goes out with the job files)."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if root in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)) or sc.applicationId in _shipped:
        return
    base = os.path.join(tempfile.mkdtemp(prefix="lakemart-code-"), "lakemart")
    sc.addPyFile(shutil.make_archive(base, "zip", root, "lakemart"))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(col: str, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts`` (null for a null id)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % parts
