"""The query registry: name -> ``(spark, sf_dir) -> DataFrame``, and the
report rounding shared by every query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


# Report rounding to 4 places, written as plain IEEE arithmetic so that Spark
# and the SQL oracle round identically: engines disagree on exact decimal ties
# (Spark rounds the decimal representation half-up, others scale the binary
# value), and a sum's last bit depends on the order of addition.  The 1e-10
# nudge is far above that noise, so exact ties round up in every engine.
ROUND_SCALE, ROUND_NUDGE = 10000, 0.500001


def r4(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * ROUND_SCALE + ROUND_NUDGE) / ROUND_SCALE
