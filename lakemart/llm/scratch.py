"""Written tables below ``spark.checkpoint.dir`` (shared by driver and executors)."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import scratch_path

_open: list[list[str]] = []


def land(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in a fresh shared folder; (scan of it, its path)."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    for paths in _open:
        paths.append(path)
    return df.sparkSession.read.schema(_nullable(df.schema)).parquet(path), path


def _nullable(schema: StructType) -> StructType:
    return StructType.fromJson({**schema.jsonValue(),
                                "fields": [{**f, "nullable": True} for f in schema.jsonValue()["fields"]]})


def drop(spark: SparkSession, path: str) -> None:
    """Remove a folder that this module wrote, once no later plan reads it."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    for paths in _open:
        if path in paths:
            paths.remove(path)


def sweep(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps that have ended: it does so once the
    driver has collected their plans, which else waits until its memory runs short.  A plan
    that Python has let go of is free only some time after, so it is collected twice."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


@contextmanager
def written() -> Iterator[list[str]]:
    """The folders that ``land`` writes inside the block and ``drop`` has not removed."""
    paths: list[str] = []
    _open.append(paths)
    try:
        yield paths
    finally:
        _open.remove(paths)


def drop_unread(spark: SparkSession, paths: list[str], reader: DataFrame) -> list[str]:
    """Drop the folders that ``reader`` does not read; those it reads are returned."""
    read = {f.split("/llm-", 1)[1].split("/", 1)[0] for f in reader.inputFiles() if "/llm-" in f}
    stay = [p for p in paths if p.rsplit("/llm-", 1)[1] in read]
    for p in [p for p in paths if p not in stay]:
        drop(spark, p)
    return stay
