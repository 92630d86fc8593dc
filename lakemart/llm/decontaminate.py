"""Benchmark decontamination: a broadcast hash set of normalised test n-grams,
scanned over the token windows of every document, with verified hits.

Normalisation lower-cases A-Z and takes words of a-z, 0-9 and non-ASCII
characters.  An item gives every window of ``n`` consecutive words; an item of
fewer words, but not none, is one window of its own length.

The hash set is broadcast only while it holds at most ``max_windows`` windows
(about 700 bytes each in a worker, so 210 MB).  A larger benchmark is scanned by a
shuffle join instead: window hashes of documents meet window hashes of items by key,
with the same verification, so neither the findings nor the removal of spans depends
on the size.

Defined results: a null or word-less text has no words and no hits; a null or
word-less item never occurs.  Repeated items count once by ``item_id``; rows that
repeat a document are scanned each on its own.  A null item id is reported as
an item with an empty name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from . import words as W

WINDOW = 10
MAX_WINDOWS = 300_000
FILTER_BITS = 20


def item_windows(text: str | None, n: int = WINDOW) -> set[bytes]:
    """Distinct normalised windows of one item."""
    ws = (text or "").encode("utf-8", "replace").translate(W.BY_ALNUM).split()
    k = min(n, len(ws))
    return {b" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)} if ws else set()


class WindowSet:
    """Test windows by length: window text -> item ids, and sorted hashes with a
    bit table in front of them."""

    def __init__(self, items: Iterable[tuple[str, str | None]], n: int = WINDOW):
        self.items: dict[bytes, set[str]] = {}
        for item_id, text in items:
            for w in item_windows(text, n):
                self.items.setdefault(w, set()).add(item_id)
        by_len: dict[int, list[bytes]] = {}
        for w in self.items:
            by_len.setdefault(w.count(b" ") + 1, []).append(w)
        self.tables = {}
        for k, ws in by_len.items():
            h = np.unique(np.concatenate([W.Words(part, W.BY_ALNUM).windows(k)[1] for _, part in _grouped(ws)]))
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[(h >> W.U(64 - FILTER_BITS)).astype(np.int64)] = True
            self.tables[k] = (h, bits)

    def hits(self, words: W.Words):
        """(first word, length, window) of every verified occurrence."""
        for k, (known, bits) in self.tables.items():
            at, h = words.windows(k)
            maybe = np.flatnonzero(bits[(h >> W.U(64 - FILTER_BITS)).astype(np.int64)])
            if not len(maybe):
                continue
            place = np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)
            for i in at[maybe[known[place] == h[maybe]]]:
                w = window_text(words, i, k)
                if w in self.items:
                    yield int(i), k, w


def _grouped(ws: list[bytes]):
    """Windows as a few large texts-lists (bounded buffers)."""
    step = 20_000
    return ((i, ws[i:i + step]) for i in range(0, len(ws), step))


def window_text(words: W.Words, i: int, k: int) -> bytes:
    return b" ".join(words.data[words.begin[i]:words.end[i + k - 1]].split())


def _digest(spans: Iterable[tuple[int, int]], items: set[str]):
    """(hit words, items, their checksum, merged spans) of one text, by a sorted walk."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return sum(b - a for a, b in merged), len(items), digest, [f"{a}:{b}" for a, b in merged]


def _schema(docs: DataFrame) -> StructType:
    return StructType([docs.schema["id"], *[StructField(c, LongType()) for c in ("n_words", "n_hit", "n_items")],
                       StructField("items_sha256", StringType()), StructField("spans", ArrayType(StringType()))])


def _scan(broadcast):
    def run(batches):
        known = broadcast.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for start, part in W.chunks(texts):
                words = W.Words(part, W.BY_ALNUM)
                spans: dict[int, list] = {}
                items: dict[int, set] = {}
                for i, k, w in known.hits(words):
                    t = int(words.doc[i])
                    a = i - int(words.first[t])
                    spans.setdefault(t, []).append((a, a + k))
                    items.setdefault(t, set()).update(known.items[w])
                rows = [(int(words.count[t]), *_digest(spans.get(t, ()), items.get(t, set()))) for t in range(len(part))]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, len(part)), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()),
                     pa.array(cols[4], pa.list_(pa.string()))],
                    names=["id", "n_words", "n_hit", "n_items", "items_sha256", "spans"])
    return run


def _windows(lengths: list[int], n: int, whole_items: bool):
    """(row, first, k, hash, window) of every window of the given lengths, or of
    every window an item has."""
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for start, part in W.chunks(texts):
                words = W.Words(part, W.BY_ALNUM)
                for k in lengths:
                    at, h = words.windows(k)
                    if whole_items:
                        use = words.count[words.doc[at]] >= n if k == n else words.count[words.doc[at]] == k
                        at, h = at[use], h[use]
                    if len(at):
                        t = words.doc[at]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids.slice(start, len(part)).take(pa.array(t))),
                             pa.array((at - words.first[t]).astype(np.int32)),
                             pa.array(np.full(len(at), k, np.int32)), pa.array(h.view(np.int64)),
                             pa.array([window_text(words, i, k) for i in at], pa.binary())],
                            names=["row", "first", "k", "h", "w"])
    return run


def _count(batches):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        n = [len((t or "").encode("utf-8", "replace").translate(W.BY_ALNUM).split()) for t in texts]
        yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64())], names=["row", "n_words"])


def _scan_by_join(docs: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """The same digest without a broadcast (for benchmarks beyond the bound)."""
    from .scratch import land
    docs, _ = land(docs.withColumn("row", F.monotonically_increasing_id()), "decontaminate")    # fixes the row numbers
    texts = docs.select("row", "text")
    shape = "first int, k int, h bigint, w binary"
    lengths = list(range(1, n + 1))
    known = (items.select("item", "text")
             .mapInArrow(_windows(lengths, n, True), f"row string, {shape}")
             .groupBy("k", "h", "w").agg(F.collect_set("row").alias("its")))     # a window many items share is one row
    known, _ = land(known, "decontaminate-windows")
    used = [r.k for r in known.select("k").distinct().collect()]     # at most n lengths
    if not used:
        used = [n]
    found = (texts.mapInArrow(_windows(used, n, False), f"row bigint, {shape}")
             .join(known, ["k", "h", "w"]).select("row", "first", "k", "its"))
    digests = found.groupBy("row").agg(F.collect_list(F.struct("first", "k", "its")).alias("hits")).mapInArrow(
        _digests, "row bigint, n_hit bigint, n_items bigint, items_sha256 string, spans array<string>")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (docs.select("row", "id")
            .join(texts.mapInArrow(_count, "row bigint, n_words bigint"), "row")
            .join(digests, "row", "left")
            .select("id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
                    F.coalesce("items_sha256", nothing).alias("items_sha256"),
                    F.coalesce("spans", F.array().cast("array<string>")).alias("spans"), "row"))


def _digests(batches):
    """A row's hits (at most as many as the text has words, times window lengths)."""
    for batch in batches:
        rows = []
        for hits in batch.column(1).to_pylist():
            spans = [(x["first"], x["first"] + x["k"]) for x in hits]
            named = {i for x in hits for i in x["its"]}
            rows.append(_digest(spans, named))
        cols = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
             pa.array(cols[3], pa.list_(pa.string()))], names=["row", "n_hit", "n_items", "items_sha256", "spans"])


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_windows: int = MAX_WINDOWS,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """One row per document row: ``id, n_words, n_hit, n_items, items_sha256,
    contaminated, spans`` (word ranges ``first:end`` of the hit runs)."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.col(item_text).cast("string").alias("text"))
    # an upper bound of the number of windows, from the lengths alone
    size = items.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0))).first()[0] // 2
    if size <= max_windows:
        known = WindowSet([(r.item, r.text) for r in items.toLocalIterator()], n)
        shared = docs.sparkSession.sparkContext.broadcast(known)
        out = texts.mapInArrow(_scan(shared), _schema(texts))
    else:
        out = _scan_by_join(texts, items, n).drop("row")
    return out.select(F.col("id").alias(id_col), "n_words", "n_hit", "n_items", "items_sha256",
                      (F.col("n_hit") > 0).alias("contaminated"), "spans")


def _erase(batches):
    """(row columns, text, spans) -> text without the words of its spans."""
    for batch in batches:
        texts, out = batch.column(0).to_pylist(), []
        for text, spans in zip(texts, batch.column(1).to_pylist()):
            if not spans:
                out.append(text)
                continue
            raw = text.encode("utf-8", "replace")
            words = W.Words([raw], W.BY_ALNUM)
            kept, at = [], 0
            for a, b in (map(int, s.split(":")) for s in spans):
                kept.append(raw[at:words.begin[a]])
                at = int(words.end[b - 1])
            out.append((b"".join(kept) + raw[at:]).decode("utf-8"))
        yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(out, pa.string())], names=["row", "cut"])


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_windows: int = MAX_WINDOWS,
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with every hit run cut out of the text (other columns and their order
    unchanged), for a benchmark of any size.  Rows are numbered in a landed table, and
    only rows with a hit are joined with their spans and rewritten."""
    from .scratch import land
    # the input's columns go along as one value, whatever their names
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all"), F.monotonically_increasing_id().alias("row"))
    rows, _ = land(kept, "decontaminate-rows")
    texts = rows.select("row", F.col("all").getField(text_col).cast("string").alias("text"))
    hit = (contamination(texts, benchmark, n, max_windows, "row", "text", item_col, item_text)
           .where("contaminated").select("row", "spans"))
    cut = texts.join(hit, "row").select("text", "spans", "row").mapInArrow(_erase, "row bigint, cut string")
    kind = docs.schema[text_col].dataType
    joined = rows.join(cut, "row", "left")
    return joined.select(*[F.coalesce(F.col("cut").cast(kind), F.col("all").getField(c)).alias(c) if c == text_col
                           else F.col("all").getField(c).alias(c) for c in docs.columns])
