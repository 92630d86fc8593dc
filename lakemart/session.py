"""Session defaults and the shared scratch location.

Every operator in the package is lazy; this module only builds a session with
settings that make results repeatable (UTC, ANSI) and plans adaptive (AQE), and
hands out directories below ``spark.checkpoint.dir`` for the few operators that
must materialise data (landing files, sinks, lineage cuts).
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

# Settings every session of the library gets.  AQE re-plans joins from measured
# shuffle sizes (runtime broadcast below the threshold, skew-join splitting) and
# coalesces small shuffle partitions; nothing is hand-scheduled.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "lakemart", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off: no listening port)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lakemart-warehouse-")))
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the library defaults on an existing session (driver-made sessions)."""
    for key, value in DEFAULTS.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static conf on a running session: keep what is there
            pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when a local session has none (tests) a private one is created; on a
    cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="lakemart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


_owned: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never re-used location below the checkpoint root, in a folder that
    belongs to this application and is removed when its driver exits."""
    root = checkpoint_root(spark).rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _owned:
        _owned[app] = f"{root}/lakemart/{app}-{uuid.uuid4().hex[:8]}"
        folder = spark._jvm.org.apache.hadoop.fs.Path(_owned[app])
        atexit.register(_remove_at_exit, folder, spark._jsc.hadoopConfiguration())
    return f"{_owned[app]}/{name}-{uuid.uuid4().hex[:12]}"


def _remove_at_exit(folder, conf) -> None:
    try:
        folder.getFileSystem(conf).delete(folder, True)
    except (Py4JError, OSError):  # the JVM has ended before its driver program: nothing can be removed any more
        pass


def remove(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder early, once no later plan reads it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def ended_shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Writes started in the block remove their shuffle files as they end; else the files
    stay until the driver's memory runs short and its garbage is collected.  Only for
    writes: their plan is their own, so no later action looks for its shuffle files."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    keep = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if keep is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, keep)


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and
    return a scan of it.

    Like a reliable ``checkpoint()`` it survives executor loss (never
    ``localCheckpoint``), but later reads prune columns and push filters into
    the scan, which an RDD checkpoint cannot."""
    return landed(df, name)[0]


def landed(df: DataFrame, name: str = "cut") -> tuple[DataFrame, str]:
    """``cut_lineage`` that also gives the folder, for owners that drop it early.
    Column order is kept."""
    path = scratch_path(df.sparkSession, name)
    _write(df, path)
    return _scan(df, path), path


def landed_parts(parts: dict[str, DataFrame], by: str, name: str = "cut") -> tuple[DataFrame, str]:
    """``landed`` of the parts of one table, each written on its own as the rows whose
    column ``by`` is its name: the scan is partitioned by that column, and no task has to
    sort the rows of all parts to write them, as ``partitionBy`` does."""
    first = next(iter(parts.values()))
    path = scratch_path(first.sparkSession, name)
    for value, df in parts.items():
        _write(df.drop(by), f"{path}/{by}={value}")
    return _scan(first, path), path


def _write(df: DataFrame, path: str) -> None:
    with ended_shuffles_go(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def _scan(df: DataFrame, path: str) -> DataFrame:
    schema = StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return df.sparkSession.read.schema(schema).parquet(path).select(*[f"`{c}`" for c in df.columns])


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so that Python-side helpers can list the path."""
    return path[5:] if path.startswith("file:") else path
