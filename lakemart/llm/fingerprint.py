"""Document fingerprints by one-permutation MinHash.

A text's word 5-gram shingles are hashed once; the top bits of a hash name one of
``BINS`` bins and each bin keeps its smallest hash.  An empty bin copies the bin
that a fixed sequence of hashed attempts finds first (optimal densification: every
empty bin draws its own donors).  Of every bin the low ``BITS`` bits are packed,
one hexadecimal digit per bin, and a likeness corrects the share of equal digits
for the 1/16 of digits that agree by chance.

``next_documents`` walks the documents in descending id order without a global
sort in one task: approximate percentiles of the id cut contiguous buckets, one
shuffle deals every text to its bucket, and the first document of each bucket is
also sent to the bucket before it.  Tasks stream their bucket and keep one chunk.

Defined results: null text is empty; a text without words has the fingerprint
``""``, which is like another ``""`` (1.0) and like nothing else (0.0).  Rows
that repeat an id are ordered by text.  A null id sorts after all ids.  A single
document is its own next document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

BINS, BITS, SHINGLE = 256, 4, 5
ATTEMPTS, FEW = 4096, 24
MAX_BUCKETS = 1024
U = np.uint64
EMPTY = np.iinfo(np.uint64).max


def attempt_table(n: int) -> np.ndarray:
    """(n, BINS) donor bins of each attempt."""
    return (W.stream(91, n * BINS) >> U(56)).astype(np.int64).reshape(n, BINS)


_FEW = attempt_table(FEW)


def densify(low: np.ndarray) -> np.ndarray:
    """Fill empty bins of every row that has a non-empty one."""
    filled = low != EMPTY
    out = low.copy()
    row, col = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for a in range(FEW):
        donor = _FEW[a, col]
        ok = filled[row, donor]
        out[row[ok], col[ok]] = low[row[ok], donor[ok]]
        row, col = row[~ok], col[~ok]
        if not len(row):
            return out
    table = attempt_table(ATTEMPTS)
    for r in np.unique(row):
        cols = col[row == r]
        hit = filled[r][table[:, cols]]
        donor = np.where(hit.any(axis=0), table[hit.argmax(axis=0), cols], filled[r].argmax())
        out[r, cols] = low[r, donor]
    return out


def fingerprints(texts: list[str]) -> np.ndarray:
    """(n, BINS) digits 0..15; rows of -1 for texts without words."""
    out = np.empty((len(texts), BINS), np.int8)
    for start, part in W.chunks(texts):
        n = len(part)
        doc, h = W.Words(part, W.BY_SPACE).shingles(SHINGLE)
        low = np.full(n * BINS, EMPTY, U)
        np.minimum.at(low, doc * BINS + (h >> U(56)).astype(np.int64), h)
        low = low.reshape(n, BINS)
        digits = (densify(low) & U((1 << BITS) - 1)).astype(np.int8)
        digits[(low == EMPTY).all(axis=1)] = -1
        out[start:start + n] = digits
    return out


_DIGITS = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def packed(digits: np.ndarray) -> list[str]:
    """Hexadecimal fingerprints."""
    text = _DIGITS[np.maximum(digits, 0)].tobytes().decode("ascii")
    return ["" if d[0] < 0 else text[i * BINS:(i + 1) * BINS] for i, d in enumerate(digits)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bias-corrected similarity of fingerprint rows, 0 to 1."""
    chance = 1.0 / (1 << BITS)
    same = (a == b).mean(axis=1)
    out = np.clip((same - chance) / (1.0 - chance), 0.0, 1.0)
    none_a, none_b = a[:, 0] < 0, b[:, 0] < 0
    return np.where(none_a | none_b, (none_a & none_b).astype(float), out)


SCHEMA = ("id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _digest(rows: list[tuple[int, str]], after: str) -> pa.RecordBatch:
    texts = [t for _, t in rows] + [after]
    edited = [t[:len(t) - len(t) // 2] + nxt[:len(t) // 2] for t, nxt in zip(texts, texts[1:])]
    own, new = fingerprints(texts), fingerprints(edited)
    here = own[:-1]
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in rows], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
         pa.array([hashlib.sha256(e.encode("utf-8", "replace")).hexdigest() for e in edited], pa.string()),
         pa.array(packed(here), pa.string()), pa.array(packed(new), pa.string()),
         pa.array(likeness(here, new)), pa.array(likeness(here, own[1:]))],
        names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _walk(batches):
    """Rows arrive by bucket, own rows in order and then the next bucket's first row."""
    rows: list[tuple[int, str]] = []
    size, bucket, closed = 0, None, False
    for batch in batches:
        for b, tail, i, t in zip(*(batch.column(c).to_pylist() for c in range(4))):
            t = t or ""
            if b != bucket:
                bucket, closed = b, False
            if closed:          # further rows that repeat the tail's id
                continue
            if tail:
                if rows:
                    yield _digest(rows, t)
                rows, size, closed = [], 0, True
                continue
            if size > W.CHUNK_BYTES:
                yield _digest(rows, t)
                rows, size = [], 0
            rows.append((i, t))
            size += len(t)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next`` (see the module docstring)."""
    spark = docs.sparkSession
    lowest = F.lit(-(1 << 63)).cast("bigint")
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    key = F.coalesce("id", lowest)
    parts = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), MAX_BUCKETS)
    cuts = texts.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)] or [0.5], 100 * parts)
                     .alias("c")).first()["c"]
    cuts = sorted(set(cuts or ()))
    # bucket 0 holds the largest ids
    bucket = F.size(F.filter(F.array(*[F.lit(c).cast("bigint") for c in cuts]).cast("array<bigint>"),
                             lambda c: c > key))
    heads = sorted((r.b, r.k) for r in texts.groupBy(bucket.alias("b")).agg(F.max(key).alias("k")).collect())
    if not heads:
        return texts.mapInArrow(_walk, SCHEMA).withColumnRenamed("id", id_col)
    # the first document of a bucket also goes behind the bucket before it (cyclic)
    tails = spark.createDataFrame([(k, heads[i - 1][0]) for i, (_, k) in enumerate(heads)], "k bigint, into int")
    placed = (texts.withColumn("k", key).withColumn("b", bucket)
              .join(F.broadcast(tails), "k", "left")        # one row per bucket
              .select("k", "id", "text", F.explode(F.array_compact(F.array(
                  F.struct(F.col("b"), F.lit(False).alias("tail")),
                  F.when(F.col("into").isNotNull(), F.struct(F.col("into").alias("b"), F.lit(True).alias("tail"))))))
                  .alias("p"))
              .select(F.col("p.b").alias("b"), F.col("p.tail").alias("tail"), "id", "text", "k"))
    ordered = (placed.repartitionById(parts, F.col("b") % parts)
               .sortWithinPartitions("b", "tail", F.desc("k"), "text"))
    return ordered.select("b", "tail", "id", "text").mapInArrow(_walk, SCHEMA).withColumnRenamed("id", id_col)
