"""Ranked lexical search: presence masks per item, evaluated by descending bound.

Items (queries) are short texts, documents are any number of rows.  Score of a
document for an item: the sum over the item's terms, repeats included, of
``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` with ``w`` from the term's
document frequency and ``m`` from the document's length (``weights``, ``lengths``).

1. *Postings.*  One pass over the whole texts keeps, per document, its number of
   terms and the ids and counts of the terms that some item of the group uses.
   They are landed, so texts are read once per group of items.
2. *Statistics.*  N, L and df are sums over the landed rows; df comes back as one
   number per term of the group.
3. *Masks.*  A task takes its postings in blocks of documents.  Per item, bit ``j``
   of a document's mask says whether it holds the item's ``j``-th term; masks are
   OR-ed from the term lists and documents are grouped by distinct mask.  A mask's
   bound is the sum of its terms' highest contributions in the block.  Masks are
   evaluated exactly by descending bound until the next bound is below the item's
   k-th best score so far (equal bounds are still evaluated: an equal score may win
   by its id).  What a task has found so far carries over to its next block.
4. *Merge.*  A task returns at most ``k`` rows an item; they are merged by window.

Items are dealt into groups of about ``GROUP_ITEMS`` items or ``GROUP_BYTES`` of
text by a hash; only one group's items and terms are in the driver and in a task,
whatever the size of the item table.  Documents are never shuffled; a source, term
or mask that holds most rows stays spread over the input's tasks.

Defined results: null or term-free documents are counted nowhere and never found;
a null or term-free item has no rows; repeated rows of (item id, text) are one
item; an item id with two texts has both rankings under its id; documents that
repeat an id are ranked each; a null document id sorts before others among equal
scores; ids keep their type; fewer than ``k`` scoring documents give fewer rows;
empty tables give no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .scratch import land
from .words import BY_ALNUM

TOP = 10
GROUP_ITEMS, GROUP_BYTES = 2000, 8 << 20
#: terms of texts taken at a time, and documents of one block of masks
CHUNK_WORDS, BLOCK_DOCS = 1 << 20, 4096


def terms(text) -> list[bytes]:
    """Terms of a text in order (A-Z lower-cased); none for null."""
    return (text or "").encode("utf-8", "replace").translate(BY_ALNUM).split()


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The documents' length factors ``m``."""
    return 25 + (75 * n.astype(np.int64) * n_docs) // max(n_terms, 1)


class Items:
    """One group of items: its terms, and per item term ids with their repeats."""

    def __init__(self, rows):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.terms, self.repeats = [], [], []
        for item, text in rows:
            found = Counter(self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms(text))
            if found:
                self.ids.append(item)
                self.terms.append(np.fromiter(found.keys(), np.int64, len(found)))
                self.repeats.append(np.fromiter(found.values(), np.int64, len(found)))


def _postings(vocabulary):
    """(id, text) -> (id, n, terms, counts), the last two as packed int32."""
    def run(batches):
        known = vocabulary.value
        get, width = known.get, max(len(known), 1)

        def flush(ids, n, hits):
            doc = np.repeat(np.arange(len(n)), [len(h) for h in hits])
            key, count = np.unique(doc * width + np.concatenate(hits), return_counts=True)
            ends = np.searchsorted(key, np.arange(1, len(n) + 1) * width)
            at = pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32) * np.int32(4))
            packed = [pa.Array.from_buffers(pa.binary(), len(n), [None, at, pa.py_buffer(x.astype(np.int32))])
                      for x in (key % width, count)]
            return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), *packed],
                                              names=["id", "n", "terms", "counts"])

        for batch in batches:
            texts, start, size, n, hits = batch.column(1), 0, 0, [], []
            for i in range(len(texts)):
                words = terms(texts[i].as_py())
                n.append(len(words))
                hits.append(np.fromiter((x for x in map(get, words) if x is not None), np.int64))
                size += len(words)
                if size >= CHUNK_WORDS:
                    yield flush(batch.column(0).slice(start, len(n)), n, hits)
                    start, size, n, hits = i + 1, 0, [], []
            if n:
                yield flush(batch.column(0).slice(start, len(n)), n, hits)
    return run


def _unpack(column) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, values) of a binary column of packed int32."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    data = column.buffers()[2]
    values = np.frombuffer(data, np.int32, (offsets[-1] - offsets[0]) // 4, offsets[0]) if data and offsets[-1] else \
        np.zeros(0, np.int32)
    return np.diff(offsets) // 4, values.astype(np.int64)


def _frequencies(width):
    """Documents per term, one sum per task."""
    def run(batches):
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += np.bincount(_unpack(batch.column(0))[1], minlength=width)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["term", "df"])
    return run


def group_masks(docs: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group documents by the set of lists they are in: (documents in any list,
    their group, groups x lists presence)."""
    n_words = -(-len(docs) // 64)
    mask = np.zeros((n_words, n), np.uint64)
    for j, d in enumerate(docs):
        mask[j // 64, d] |= np.uint64(1 << (j % 64))
    some = np.flatnonzero(mask.any(axis=0))
    mask = mask[:, some]
    first, group = np.unique(mask[0], return_index=True, return_inverse=True)[1:]
    for w in range(1, n_words):                                 # refine by the next 64 lists
        values, second = np.unique(mask[w], return_inverse=True)
        first, group = np.unique(group * len(values) + second, return_index=True, return_inverse=True)[1:]
    bits = np.unpackbits(np.ascontiguousarray(mask[:, first].T).view(np.uint8), axis=1, bitorder="little")
    return some, group, bits[:, :len(docs)]


class Block:
    """Postings of some documents with every posting's contribution ``w * (...)``."""

    def __init__(self, n, sizes, term, count, weight, n_docs, n_terms):
        self.n, self.width = len(n), len(weight)
        doc = np.repeat(np.arange(self.n), sizes)
        m = lengths(n, n_docs, n_terms)[doc]
        value = weight[term] * ((1_000_000_000 * count) // (1000 * count + 8 * m))
        self.key, self.value = doc * self.width + term, value     # by document, then term
        order = np.argsort(term, kind="stable")
        self.by_term, term = doc[order], term[order]
        starts = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.zeros(0, np.int64)
        ends = np.concatenate((starts[1:], [len(term)])) if len(starts) else starts
        self.span = dict(zip(term[starts].tolist(), zip(starts.tolist(), ends.tolist())))
        self.most = np.zeros(self.width, np.int64)
        if len(starts):
            self.most[term[starts]] = np.maximum.reduceat(value[order], starts)

    def scores(self, docs, item_terms, repeats):
        key = docs[:, None] * self.width + item_terms[None, :]
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return (np.where(self.key[at] == key, self.value[at], 0) * repeats).sum(axis=1)

    def search(self, item_terms, repeats, floor: int, k: int):
        """(document, score) of all that may be among the k best with a score
        of at least ``floor`` (and above 0), by descending mask bound."""
        here = [(j, *self.span[t]) for j, t in enumerate(item_terms.tolist()) if t in self.span]
        if not here:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        some, group, bits = group_masks([self.by_term[a:b] for _, a, b in here], self.n)
        j = np.array([x[0] for x in here])
        item_terms, repeats = item_terms[j], repeats[j]
        bound = bits.astype(np.int64) @ (self.most[item_terms] * repeats)
        order = np.argsort(-bound, kind="stable")
        members = some[np.argsort(group, kind="stable")]
        stops = np.cumsum(np.bincount(group, minlength=len(bound)))
        starts = stops - np.bincount(group, minlength=len(bound))
        docs, found, at, step, least = [], [], 0, 16, max(floor, 1)
        while at < len(order) and bound[order[at]] >= least:
            now = order[at:at + step]
            now = now[bound[now] >= least]
            d = np.concatenate([members[starts[g]:stops[g]] for g in now])
            docs.append(d)
            found.append(self.scores(d, item_terms, repeats))
            s = np.concatenate(found)
            if len(s) >= k:
                least = max(least, int(np.partition(s, len(s) - k)[len(s) - k]))
            at, step = at + step, step * 2
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        d, s = np.concatenate(docs), np.concatenate(found)
        keep = s >= least
        return d[keep], s[keep]


def _search(items, weight, n_docs, n_terms, k, block_docs):
    """Postings -> at most k rows (item number, id, score) an item and task."""
    def run(batches):
        group, w = items.value, weight.value
        best: list[list] = [[] for _ in group.ids]
        kind = None
        for whole in batches:
            kind = whole.schema.field(0).type
            for start in range(0, len(whole), block_docs):
                batch = whole.slice(start, block_docs)
                sizes, term = _unpack(batch.column(2))
                block = Block(batch.column(1).to_numpy(), sizes, term, _unpack(batch.column(3))[1], w, n_docs, n_terms)
                ids = batch.column(0).to_pylist()
                for i, top in enumerate(best):
                    floor = -top[-1][0] if len(top) == k else 1
                    docs, scores = block.search(group.terms[i], group.repeats[i], floor, k)
                    if len(docs):
                        new = [(-s, ids[d] is not None, ids[d]) for d, s in zip(docs.tolist(), scores.tolist())]
                        best[i] = heapq.nsmallest(k, [*top, *new], key=lambda x: x if x[1] else x[:2])
        if kind is not None:
            rows = [(i, x[2], -x[0]) for i, top in enumerate(best) for x in top]
            item, ids, scores = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(ids, kind), pa.array(scores, pa.int64())],
                                             names=["item", "id", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", group_items: int = GROUP_ITEMS,
           block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The ``k`` best documents of every item: item id, ``rank`` (from 1, equal
    scores by ascending id), document id, ``score``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).distinct()
    asked, _ = land(asked, "lexical-items")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    groups = max(1, -(-size["n"] // group_items), -(-(size["b"] or 0) // GROUP_BYTES))
    id_type = texts.schema["id"].dataType
    found = None
    for g in range(groups):
        group = Items(asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).collect())
        width = len(group.vocabulary)
        postings, _ = land(texts.mapInArrow(_postings(sc.broadcast(group.vocabulary)), StructType(
            [StructField("id", id_type), StructField("n", LongType()), StructField("terms", BinaryType()),
             StructField("counts", BinaryType())])), "lexical-postings")
        total = postings.where("n > 0").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
        df = np.zeros(width, np.int64)
        counted = postings.select("terms").mapInArrow(_frequencies(width), "term bigint, df bigint")
        for row in counted.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():   # one row a term of the group
            df[row["term"]] = row["df"]
        hits = postings.where(F.octet_length("terms") > 0).mapInArrow(
            _search(sc.broadcast(group), sc.broadcast(weights(df, total["n"])), total["n"], total["l"] or 0, k, block_docs),
            StructType([StructField("item", LongType()), StructField("id", id_type), StructField("score", LongType())]))
        names = spark.createDataFrame(list(enumerate(group.ids)), StructType(
            [StructField("item", LongType()), StructField("item_id", asked.schema["item_id"].dataType)]))
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id"))
        top = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        top = top.join(F.broadcast(names), "item").select(
            F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        found = top if found is None else found.unionByName(top)
    return found

