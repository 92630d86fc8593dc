"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed: its *blob* is the SHA-256 of
its UTF-8 text.  A blob is scanned at most once per rule version.  The ledger is
a Parquet table partitioned by ``rules`` (the version) with one row per scanned
blob, also when it holds no secret, so the next run reads only blob and
rule-version pairs that the ledger lacks.  Findings are joined back to all paths
that carry, or ever carried, the blob.

* content addresses are narrow: one text representative per blob (the smallest
  path) is scanned, so copies of one text are neither moved nor scanned twice;
* texts are filtered where they are read if the list of unseen representatives, or
  the list of all other paths, is at most ``BROADCAST_ROWS`` long; else they join the
  representatives on the unique path, so no copy group meets in one task;
* appending a scan is one Parquet append; a failed append leaves no rows, and a
  blob appended twice by two concurrent runs is read once.

Base rules (kinds ``assign``, ``access``, ``hex``) are the contract's.  The
added kinds find private key blocks, JSON web tokens and prefixed service
tokens.  Spans are code points, end exclusive, of the whole match.

Defined results: null text is the empty blob and has no findings; rows that
repeat a path share its smallest representative; a null path keeps its row and
is scanned as its blob.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import land

RULES_VERSION = "2"
KINDS = ("assign", "access", "hex", "private_key", "jwt", "service_token")

# A failing match is always a failure at its full length, so a minimum inside the
# pattern drops the same matches as a check afterwards, except for ``assign``.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
PRIVATE_KEY = re.compile(r"-----BEGIN (?:[A-Z0-9]+ ){0,4}PRIVATE KEY-----")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
SERVICE_TOKEN = re.compile(r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})")
MIN_VALUE, MIN_ACCESS = 6, 20
#: (path, blob) rows that may be broadcast (about 100 bytes each)
BROADCAST_ROWS = 500_000


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every finding, in order."""
    out = []
    for m in ASSIGN.finditer(text):
        if len(m.group(2)) >= MIN_VALUE:
            out.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "PRIVATE KEY" in text:
        out += [(m.start(), 3, m.end()) for m in PRIVATE_KEY.finditer(text)]
    if "eyJ" in text:
        out += [(m.start(), 4, m.end()) for m in JWT.finditer(text)]
    if "_" in text or "xox" in text:
        out += [(m.start(), 5, m.end()) for m in SERVICE_TOKEN.finditer(text)]
    return sorted(out)


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


LEDGER = "blob string, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def _scan(batches):
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            found = find_spans(text or "")
            base = [s for s in found if s[1] < 3]
            count = [sum(s[1] == k for s in base) for k in range(3)]
            rows.append((*count, hashlib.sha256(render(base).encode()).hexdigest(), render(found)))
        cols = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], *[pa.array(c, pa.string()) for c in cols[3:]]],
            names=["blob", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def read_ledger(spark: SparkSession, path: str, rules: str) -> DataFrame | None:
    """One row per blob scanned under the rule version, or None before the first scan."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    scanned = jvm.org.apache.hadoop.fs.Path(p, f"rules={rules}")        # written by the first scan under the version
    if not fs.exists(scanned):
        return None
    return (spark.read.schema(f"{LEDGER}, rules string").parquet(path)
            .where(F.col("rules") == rules).drop("rules").dropDuplicates(["blob"]))


def update_ledger(versions: DataFrame, path: str, rules: str = RULES_VERSION, path_col: str = "path",
                  text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Scan what the ledger at ``path`` lacks, append it, and return
    ``(path, blob)`` for every row of ``versions`` (an addressed listing)."""
    spark = versions.sparkSession
    rows = versions.select(F.col(path_col).alias("path"),
                           F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    blob = F.sha2(F.col("text").cast("binary"), 256)
    listing, _ = land(rows.select("path", blob.alias("blob")), "blobs")
    unseen = listing.groupBy("blob").agg(F.min("path").alias("path"))
    ledger = read_ledger(spark, path, rules)
    if ledger is not None:
        unseen = unseen.join(ledger.select("blob"), "blob", "left_anti")
    unseen, _ = land(unseen, "unseen-blobs")
    first = unseen.select(F.col("path").alias("_path"), F.col("blob").alias("_blob"))
    same = F.col("path").eqNullSafe(F.col("_path")) & (F.col("blob") == F.col("_blob"))
    other = listing.distinct().join(unseen.select(F.col("path").alias("p"), F.col("blob").alias("b")),
                                    F.col("path").eqNullSafe(F.col("p")) & (F.col("blob") == F.col("b")), "left_anti")
    other, _ = land(other.select(F.col("path").alias("_path"), F.col("blob").alias("_blob")), "seen-paths")
    rows = rows.withColumn("blob", blob)
    if unseen.count() <= broadcast_rows:            # little is new: texts are filtered where they are read
        texts = rows.join(F.broadcast(first), same, "left_semi")
    elif other.count() <= broadcast_rows:           # nearly all is new
        texts = rows.join(F.broadcast(other), same, "left_anti")
    else:
        texts = rows.join(first.hint("shuffle_hash"), same, "left_semi")
    texts = texts.select("blob", "text")
    found = texts.mapInArrow(_scan, LEDGER).withColumn("rules", F.lit(rules))
    found.write.partitionBy("rules").mode("append").parquet(path)
    return listing


def scan(versions: DataFrame, ledger: str, rules: str = RULES_VERSION, path_col: str = "path",
         text_col: str = "text") -> DataFrame:
    """Findings of every path: one row per row of ``versions`` with its blob."""
    listing = update_ledger(versions, ledger, rules, path_col, text_col)
    known = read_ledger(versions.sparkSession, ledger, rules)
    if known is None:                                # nothing to scan, so nothing was written
        known = versions.sparkSession.createDataFrame([], LEDGER)
    return (listing.join(known, "blob", "left")
            .select(F.col("path").alias(path_col), "blob", "n_assign", "n_access", "n_hex", "base_sha256", "spans"))


def scan_documents(docs: DataFrame, ledger: str | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``scan`` over a document table; without a ledger path a fresh one is kept
    below ``spark.checkpoint.dir``."""
    from ..session import scratch_path
    ledger = ledger or scratch_path(docs.sparkSession, "llm-secret-ledger")
    return scan(docs, ledger, path_col=id_col, text_col=text_col).select(
        id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "blob")
