"""Substring dedup by paragraph MinHash banding.

The unit compared is a *paragraph*: a sentence or line of a text (cut at line ends
and after ``.``, ``!`` or ``?`` before white space) of at least ``MIN_WORDS`` words;
shorter ones belong to no unit and are skipped.  Units this small make a passage
that is pasted into different surroundings fall into the same units everywhere.

1. one pass lands ``(document, unit, first word, words, hash)``; the hash is over the
   unit's normalised words, so equal paragraphs are one node from here on;
2. paragraphs of ``NEAR_WORDS`` words or more get MinHash band keys over their
   distinct 5-word shingles.  ``BANDS`` bands of ``ROWS`` rows are tuned for recall: a pair
   of Jaccard similarity 0.8 misses all of them with probability 4e-5.  One pass finds the
   keys that two nodes have (``_shared_keys``), a second lands the entries of those keys
   alone.  In every shared bucket each node is paired with the smallest one;
3. pairs are verified by exact Jaccard similarity of the full shingle sets, and
   links are contracted to components.  Nodes of buckets that still hold several
   components are then joined exactly by their rarest shingles (prefix filter),
   verified and contracted again, so a bucket never gives all its pairs;
4. a component that occurs in two or more documents is repeated text.  In every
   document, adjacent repeated units join to runs; runs of ``RUN_WORDS`` words or more
   are reported, one row per unit, with the occurrence that stays marked ``kept``
   (the smallest document and unit);
5. *passages* need no unit: every window of ``PASSAGE`` words that occurs in two or more
   documents is found.  Of the ``SEED``-word windows inside it the one of the smallest
   hash is a mark of its text (winnowing), so equal windows have an equal mark.  Windows
   around marks that two documents share are hashed at every word and compared; touching
   windows join to passages.  Words that no unit row already reports give rows without
   a ``unit``.  A word is a repeat to cut if any row that is not ``kept`` holds it.

What two nodes or documents share (keys, marks) is found by packed 8-byte entries, at
most two per key and 2^20 entries of a task, so a hot key stays small; it comes back as
a bitmap of fixed size, where an equal hash only adds a candidate that a later exact
step drops.

Disk: a step's tables are dropped, and its shuffle files swept, before the next large step
writes, so the most that lies there is one step's, not the sum of all.

Hot paragraphs are one narrow row per occurrence; counts and minima are taken with
map-side aggregation, and joins back to occurrences are on a unique key, which the
adaptive skew join splits.

A document is a distinct (id, text): ``d`` and ``h``, the id and a hash of the text whose
last bit says that the id is null.  (An id that is no integer goes into ``h`` as well.)

Defined results: null and empty texts have no units; rows that repeat id and text count
as one document, rows of one id with other texts as others, and so do rows with a null
id; ``n_docs`` is the exact number of documents that hold the component or passage; ids
keep their type; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from . import words as W
from .collocations import bitmap, has
from .components import components
from .scratch import drop, land, sweep, written
from .set_join import prefix_pairs, verified

MIN_WORDS, NEAR_WORDS, RUN_WORDS = 4, 12, 30
PASSAGE, SEED = 51, 25          # a passage window is two seeds and a word
BANDS, ROWS, SHINGLE = 10, 2, 5
PERCENT = 80
#: packed entries of a task and of a part, and the least number of bits parts are cut by
TASK_ENTRIES, PART_ENTRIES, LEAST_BITS = 1 << 20, 1 << 21, 4
U = np.uint64
_STOPS = np.zeros(256, bool)
_STOPS[[0x2E, 0x21, 0x3F]] = True
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


class Units:
    """Paragraph units of a group of texts: ``doc``, ``unit`` (number in the text),
    ``first`` (word number in the text), ``size`` (words), ``at`` (word number in the
    group), ``hash``."""

    def __init__(self, part: list[bytes]):
        words = self.words = W.Words(part, W.BY_ALNUM)
        n = len(words)
        raw = np.frombuffer(b" ".join(part) + b"  ", np.uint8)
        line = np.concatenate(([0], np.cumsum(raw == 0x0A)))
        opens = np.ones(n, bool)
        if n > 1:
            stop = _STOPS[raw[words.end[:-1]]] & _WHITE[raw[words.end[:-1] + 1]]
            newline = line[words.begin[1:]] > line[words.end[:-1]]
            opens[1:] = stop | newline | (words.doc[1:] != words.doc[:-1])
        start = np.flatnonzero(opens)
        size = np.diff(np.append(start, n))
        keep = size >= MIN_WORDS
        self.at, self.size = start[keep], size[keep]
        self.doc = words.doc[self.at]
        self.first = self.at - words.first[self.doc]
        begins = np.searchsorted(self.doc, np.arange(len(part)))
        self.unit = np.arange(len(self.at)) - begins[self.doc]
        self.hash = np.zeros(0, U)
        if len(self.at):
            owner = np.repeat(np.arange(len(self.at)), self.size)
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
            with np.errstate(over="ignore"):
                weight = W.mix(inner.astype(U) + U(99)) | U(1)
                value = words.hash[self.at[owner] + inner] * weight
                ends = np.cumsum(self.size) - self.size
                self.hash = W.mix(np.add.reduceat(value, ends) + self.size.astype(U))

    def sets(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``which``, hash) of all shingles of the chosen units (of
        ``SHINGLE`` words or more)."""
        at, h = self.words.windows(SHINGLE)
        per = self.size[which] - SHINGLE + 1
        owner = np.repeat(np.arange(len(which)), per)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        # every run of a unit is a window of its text
        return owner, h[np.searchsorted(at, self.at[which][owner] + inner)]


def _units(batches):
    for batch in batches:
        for start, part in W.chunks(batch.column(2).to_pylist()):
            u = Units(part)
            yield pa.RecordBatch.from_arrays(
                [*_owners(batch, start, u.doc), pa.array(u.unit.astype(np.int32)),
                 pa.array(u.first.astype(np.int32)), pa.array(u.size.astype(np.int32)), pa.array(u.hash.view(np.int64))],
                names=["d", "h", "unit", "first", "words", "node"])


def _owners(batch, start: int, doc: np.ndarray) -> list:
    """``d`` and ``h`` of the chunk's texts that begins at ``start``, by number."""
    at = pa.array(start + doc)
    return [batch.column(0).take(at), batch.column(1).take(at)]


def _bands(u: Units, bands: int, rows: int, seeds: np.ndarray):
    """(keys by band, node, distinct shingles) of the distinct paragraphs of a chunk."""
    _, once = np.unique(u.hash, return_index=True)
    which = np.sort(once[u.size[once] >= NEAR_WORDS])
    if not len(which):
        return np.zeros((bands, 0), U), np.zeros(0, U), np.zeros(0, np.int32)
    owner, h = u.sets(which)
    starts = np.searchsorted(owner, np.arange(len(which)))
    order = np.lexsort((h, owner))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (owner[1:] != owner[:-1])     # owner is sorted
    n = np.bincount(owner[fresh], minlength=len(which)).astype(np.int32)
    keys, value = np.zeros((bands, len(which)), U), np.empty_like(h)
    with np.errstate(over="ignore"):
        for b in range(bands):
            for r in range(rows):
                seed = seeds[b * rows + r]
                np.multiply(np.bitwise_xor(h, seed, out=value), seed | U(1), out=value)     # h is mixed already
                low = np.minimum.reduceat(value, starts)
                keys[b] = W.mix(keys[b] * U(31) + low)
            keys[b] = W.mix(keys[b] + U(b))
    return keys, u.hash[which], n


def short(key: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits of a key behind its part's ``bits``."""
    return (key << U(bits)) >> U(32)


def _two_each(key: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (key, code) with the smallest and, if another, the largest code of each
    key, and which keys have two."""
    order = np.lexsort((code, key))
    key, code = key[order], code[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(key))[:len(first)] - 1
    two = code[first] != code[last]
    at = np.sort(np.concatenate((first, last[two])))
    return key[at], code[at], key[first[two]]


class Packed:
    """Entries (64-bit key, 32-bit code of its holder) of a task, packed by part."""

    def __init__(self, bits: int):
        self.bits, self.keys, self.codes, self.held = bits, [], [], 0

    def add(self, key: np.ndarray, code: np.ndarray):
        self.keys.append(key)
        self.codes.append(code)
        self.held += len(key)
        if self.held >= TASK_ENTRIES:
            yield from self.flush()

    def flush(self):
        if not self.held:
            return
        key, code, _ = _two_each(np.concatenate(self.keys), np.concatenate(self.codes))
        here, first = np.unique((key >> U(64 - self.bits)).astype(np.int32), return_index=True)
        ends, k = [*first[1:].tolist(), len(key)], short(key, self.bits).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(here, pa.int32()), pa.array([k[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
             pa.array([code[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())], names=["part", "keys", "codes"])
        self.keys, self.codes, self.held = [], [], 0


def _shared_in_part(table: pa.Table) -> pa.Table:
    """Keys of one part that two holders have."""
    key, code = (np.frombuffer(b"".join(table[c].to_pylist()), np.uint32) for c in ("keys", "codes"))
    return pa.table({"h": pa.array(_two_each(key, code)[2].astype(np.int64))})


def _shared_keys(entries: DataFrame):
    """Broadcast bitmap of the keys that two holders have (tested by ``short``)."""
    found = entries.groupBy("part").applyInArrow(_shared_in_part, "h bigint")
    return entries.sparkSession.sparkContext.broadcast(bitmap(found))


def _code(x: np.ndarray) -> np.ndarray:
    return (W.mix(x) >> U(32)).astype(np.uint32)


def _band_keys(bands: int, rows: int, bits: int):
    seeds = W.stream(404, bands * rows)

    def run(batches):
        packed = Packed(bits)
        for batch in batches:
            for _, part in W.chunks(batch.column(0).to_pylist()):
                keys, node, _ = _bands(Units(part), bands, rows, seeds)
                yield from packed.add(keys.ravel(), np.tile(_code(node), bands))
        yield from packed.flush()
    return run


def _band_entries(bands: int, rows: int, bits: int, shared):
    seeds = W.stream(404, bands * rows)

    def run(batches):
        for batch in batches:
            for _, part in W.chunks(batch.column(0).to_pylist()):
                keys, node, n = _bands(Units(part), bands, rows, seeds)
                band, at = np.nonzero(has(shared.value, short(keys, bits)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[band, at].view(np.int64)), pa.array(node[at].view(np.int64)), pa.array(n[at])],
                    names=["key", "node", "n"])
    return run


def _node_sets(wanted):
    def run(batches):
        seen: set[int] = set()          # of this task: at most the nodes of its texts
        for batch in batches:
            for _, part in W.chunks(batch.column(0).to_pylist()):
                u = Units(part)
                h, once = np.unique(u.hash, return_index=True)
                use = (u.size[once] >= NEAR_WORDS) & has(wanted.value, h)
                use &= np.array([x not in seen for x in h.tolist()], bool)
                seen.update(h[use].tolist())
                which = once[use]
                if not len(which):
                    continue
                owner, s = u.sets(which)
                starts = np.searchsorted(owner, np.arange(len(which) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[use].view(np.int64)), pa.ListArray.from_arrays(pa.array(starts), pa.array(s.view(np.int64)))],
                    names=["node", "set"])
    return run


def _slide(values: np.ndarray, n: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of every ``n`` neighbours."""
    width = 1
    while width * 2 <= n:
        values, width = best(values[:-width], values[width:]), width * 2
    return best(values[:len(values) - (n - width)], values[n - width:])


def seeds_of(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``SEED`` words inside one text: hashes of runs of
    1, 2, 4 and more words, each from two of the last, make up those of ``SEED``."""
    n = len(words) - SEED + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    weight = W.stream(25, 2 * SEED.bit_length()) | U(1)
    run, width, done, total = words.hash, 1, 0, np.zeros(n, U)
    with np.errstate(over="ignore"):
        for level in range(SEED.bit_length()):
            if SEED & width:
                total = total * weight[2 * level] + run[done:done + n]
                done += width
            if 2 * width <= SEED:
                run, width = run[:-width] * weight[2 * level + 1] + run[width:], 2 * width
        at = np.flatnonzero(words.doc[:n] == words.doc[SEED - 1:])
        return at, W.mix(total[at])


def marks(words: W.Words, seeds: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the marks of a chunk's texts: in every run of
    ``PASSAGE`` words the ``SEED``-word window of the smallest hash."""
    span = PASSAGE - SEED + 1
    at, h = seeds
    if len(at) < span:
        return np.zeros(0, np.int64), np.zeros(0, U)
    low = _slide(h, span, np.minimum)
    doc = words.doc[at]
    low[doc[:len(low)] != doc[span - 1:]] = 0               # crosses a text's end
    edge = np.zeros(span - 1, U)
    use = np.flatnonzero(_slide(np.concatenate((edge, low, edge)), span, np.maximum) == h)
    return at[use], h[use]


def _mark_keys(bits: int):
    def run(batches):
        packed = Packed(bits)
        for batch in batches:
            with np.errstate(over="ignore"):
                code = _code(W.mix(batch.column(0).to_numpy().view(U)) * U(31) + batch.column(1).to_numpy().view(U))
            for start, part in W.chunks(batch.column(2).to_pylist()):
                words = W.Words(part, W.BY_ALNUM)
                at, h = marks(words, seeds_of(words))
                yield from packed.add(h, code[start + words.doc[at]])
        yield from packed.flush()
    return run


def _passage_windows(bits: int, shared):
    def run(batches):
        for batch in batches:
            for start, part in W.chunks(batch.column(2).to_pylist()):
                words = W.Words(part, W.BY_ALNUM)
                at, seeds = seeds_of(words)
                p, h = marks(words, (at, seeds))
                p = p[has(shared.value, short(h, bits))]
                if not len(p):
                    continue
                n = len(words) + 1
                opens = np.bincount(np.maximum(p - (PASSAGE - SEED), words.first[words.doc[p]]), minlength=n)
                near = np.cumsum(opens - np.bincount(p + 1, minlength=n))[:-1] > 0
                i = np.flatnonzero(near[:max(len(words) - PASSAGE + 1, 0)])
                i = i[words.doc[i] == words.doc[i + PASSAGE - 1]]
                if not len(i):
                    continue
                seed = np.zeros(len(words), U)
                seed[at] = seeds
                weight = W.stream(51, 3) | U(1)
                with np.errstate(over="ignore"):
                    node = W.mix(seed[i] * weight[0] + seed[i + SEED] * weight[1] + words.hash[i + 2 * SEED] * weight[2])
                doc = words.doc[i]
                yield pa.RecordBatch.from_arrays(
                    [*_owners(batch, start, doc), pa.array((i - words.first[doc]).astype(np.int32)),
                     pa.array(node.view(np.int64))], names=["d", "h", "first", "node"])
    return run


def _less(a: int, b: int, taken: list) -> list:
    """What the ranges ``taken`` leave of ``a..b``."""
    out = []
    for x, y in sorted(taken):
        if y > a and x < b:
            if x > a:
                out.append((a, x))
            a = max(a, y)
    return [*out, (a, b)] if a < b else out


def _uncovered(batches):
    for batch in batches:
        out = []
        for *key, runs, units in zip(*(batch.column(c).to_pylist() for c in range(4))):
            units = units or []
            gone = [(u["a"], u["b"]) for u in units if not u["kept"]]
            stays = [(u["a"], u["b"]) for u in units if u["kept"]]
            for r in sorted(runs, key=lambda r: (r["kept"], r["a"], r["b"], r["c"])):
                for a, b in _less(r["a"], r["b"], gone + stays if r["kept"] else gone):
                    out.append((*key, a, b - a, r["c"], r["docs"], r["b"] - r["a"], r["kept"]))
                (stays if r["kept"] else gone).append((r["a"], r["b"]))
        cols = list(zip(*out)) or [()] * 8
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=["d", "h", "first", "words", "c", "docs", "run_words", "kept"])


def _passages(texts: DataFrame, bits: int) -> DataFrame:
    """(d, h, a, b, c, docs, kept): word ranges of the passages of every document."""
    spark = texts.sparkSession
    shared = _shared_keys(texts.mapInArrow(_mark_keys(bits), PACKED))
    windows, windows_path = land(texts.mapInArrow(_passage_windows(bits, shared), "d bigint, h bigint, first int, node bigint"),
                                 "passage-windows")
    sweep(spark)
    heads = (windows.groupBy("node").agg(F.min(F.struct("d", "h", "first")).alias("head"), F.max(F.struct("d", "h")).alias("last"))
             .where(F.struct("head.d", "head.h") < F.col("last"))
             .select("node", F.col("head.d").alias("hd"), F.col("head.h").alias("hh"), F.col("head.first").alias("hat")))
    # a passage is named by where its first window starts in the smallest document
    order = Window.partitionBy("hd", "hh").orderBy("hat", "node")
    begins = F.when(F.col("hat") - F.lag("hat", 1, -2).over(order) > 1, F.col("hat"))
    heads = heads.withColumn("new", begins).withColumn("c", F.xxhash64("hd", "hh", F.last("new", True).over(order))).drop("new")
    heads, heads_path = land(heads, "passage-heads")
    sweep(spark)
    kept = (F.col("d") == F.col("hd")) & (F.col("h") == F.col("hh")) & (F.col("first") == F.col("hat"))
    found = windows.join(heads, "node").select("d", "h", "first", "c", kept.alias("kept"))
    order = Window.partitionBy("d", "h", "c", "kept").orderBy("first")
    runs = (found.withColumn("new", (F.col("first") - F.lag("first", 1, -2).over(order) > 1).cast("int"))
            .withColumn("run", F.sum("new").over(order)).groupBy("d", "h", "c", "kept", "run")
            .agg(F.min("first").alias("a"), (F.max("first") + PASSAGE).alias("b")))
    runs, _ = land(runs, "passages")
    for path in (windows_path, heads_path):
        drop(spark, path)
    sweep(spark)
    size = runs.select("c", "d", "h").distinct().groupBy("c").agg(F.count(F.lit(1)).alias("docs"))
    return runs.join(size, "c").select("d", "h", "a", "b", "c", "docs", "kept")


PACKED = "part int, keys binary, codes binary"


def _sets_of(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, set) of the given distinct nodes: their distinct shingles, read from the texts."""
    nodes, nodes_path = land(nodes, "paragraph-nodes")
    wanted = texts.sparkSession.sparkContext.broadcast(bitmap(nodes.select(F.col("node").alias("h"))))
    sets = (texts.select("text").mapInArrow(_node_sets(wanted), "node bigint, set array<bigint>")
            .join(nodes, "node", "left_semi"))
    sets, _ = land(sets.groupBy("node").agg(F.array_distinct(F.any_value("set")).alias("set")), "paragraph-sets")
    drop(texts.sparkSession, nodes_path)
    return sets


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, h, id, text) of every row; see the module docstring."""
    id_, text = F.col(id_col), F.col(text_col).cast("string")
    whole = isinstance(docs.schema[id_col].dataType, IntegralType)
    h = F.xxhash64(text) if whole else F.xxhash64(id_.cast("string"), text)
    h = F.shiftleft(F.shiftright(h, 1), 1).bitwiseOR(F.when(id_.isNull(), 1).otherwise(0).cast("bigint"))
    return docs.select((F.coalesce(id_.cast("bigint"), F.lit(0).cast("bigint")) if whole else F.lit(0).cast("bigint")).alias("d"),
                       h.alias("h"), id_.alias("id"), text.alias("text"))


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                        bands: int = BANDS, rows: int = ROWS, run_words: int = RUN_WORDS) -> DataFrame:
    """One row per unit of a repeated run and per rest of a passage outside such units
    (``unit`` is null): ``id, unit, first_word, n_words, cluster_id, n_docs, run_words,
    kept``.  Documents without repeated text have no row."""
    found = _repeats(docs, id_col, text_col, percent, bands, rows, run_words)
    kind = docs.schema[id_col].dataType
    if isinstance(kind, IntegralType):
        found = found.withColumn("id", F.when(F.col("h").bitwiseAND(F.lit(1)) == 0, F.col("d")).cast(kind))
    else:
        found = found.join(_documents(docs, id_col, text_col).select("d", "h", "id").distinct(), ["d", "h"])
    return found.select(
        F.col("id").alias(id_col), "unit", F.col("first").alias("first_word"), F.col("words").alias("n_words"),
        F.col("c").alias("cluster_id"), F.col("docs").alias("n_docs"), "run_words", "kept")


def _repeats(docs: DataFrame, id_col: str, text_col: str, percent: int, bands: int, rows: int, run_words: int) -> DataFrame:
    """The same by document: ``d, h, unit, first, words, c, docs, run_words, kept``.
    What the steps write is dropped, but for the tables the result reads."""
    texts = _documents(docs, id_col, text_col).select("d", "h", "text")
    with written() as paths:
        units, rest = _find(texts, percent, bands, rows, run_words)
        units, units_path = land(units, "paragraph-rows")
        _keep(docs.sparkSession, paths, units_path)
        rest, rest_path = land(rest(units), "passage-rows")
        _keep(docs.sparkSession, paths, units_path, rest_path)
    return units.unionByName(rest)


def _keep(spark, paths: list[str], *keep: str) -> None:
    """Drop the folders ``paths`` but for ``keep``, and what their steps have shuffled."""
    for path in [p for p in paths if p not in keep]:
        drop(spark, path)
    sweep(spark)


def _groups(texts: DataFrame, bits: int, percent: int, bands: int, rows: int) -> DataFrame:
    """(node, component) of the paragraphs that are linked to others."""
    spark = texts.sparkSession
    only = texts.select("text")
    shared = _shared_keys(only.mapInArrow(_band_keys(bands, rows, bits), PACKED))
    entries, entries_path = land(only.mapInArrow(_band_entries(bands, rows, bits, shared), "key bigint, node bigint, n int"), "paragraph-keys")
    lead = (entries.groupBy("key").agg(F.min(F.struct("node", "n")).alias("l"), F.max("node").alias("z"))
            .where("l.node < z").select("key", F.col("l.node").alias("a"), F.col("l.n").alias("na")))
    members, members_path = land(entries.join(lead, "key").distinct(), "paragraph-members")
    drop(spark, entries_path)
    sweep(spark)
    close = F.least("n", "na") * 100 >= F.greatest("n", "na") * percent
    stars, _ = land(members.where("node > a").where(close).select("a", F.col("node").alias("b")).distinct(), "paragraph-stars")
    ends = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).distinct()
    links, _ = land(verified(stars, _sets_of(ends, texts), percent), "paragraph-links")
    first = components(links)
    # nodes of one bucket that the stars left in different components
    labelled, labelled_path = land(members.join(first, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c")),
                                   "paragraph-labels")
    drop(spark, members_path)
    mixed = labelled.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    rest, _ = land(labelled.join(mixed, "key").select("node", "c").distinct(), "paragraph-mixed")
    drop(spark, labelled_path)
    sets = _sets_of(rest.select("node"), texts)
    across = prefix_pairs(rest, sets, percent).join(stars, ["a", "b"], "left_anti")
    known = first.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(known.unionByName(verified(across, sets, percent)))


def _find(texts: DataFrame, percent: int, bands: int, rows: int, run_words: int):
    spark = texts.sparkSession
    units, units_path = land(texts.mapInArrow(_units, "d bigint, h bigint, unit int, first int, words int, node bigint"), "paragraphs")
    n_words = units.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    bits = max(LEAST_BITS, min(24, (n_words // PART_ENTRIES).bit_length()))

    with written() as paths:
        groups, groups_path = land(_groups(texts, bits, percent, bands, rows), "paragraph-components")
        _keep(spark, paths, groups_path)

    # a node's own reach; nodes seen in one document only matter if they are linked
    reach, reach_path = land(units.groupBy("node").agg(F.min(F.struct("d", "h", "unit")).alias("head"),
                                                       F.max(F.struct("d", "h")).alias("last")), "paragraph-reach")
    twice = F.struct("head.d", "head.h") < F.col("last")
    alone = reach.join(groups, "node", "left_anti").where(twice)
    size = (reach.join(groups, "node").groupBy("component").agg(F.min("head").alias("head"), F.max("last").alias("last"))
            .where(twice))
    repeated = (alone.select("node", F.col("node").alias("c"), "head")
                .unionByName(groups.join(size, "component").select("node", F.col("component").alias("c"), "head")))
    hits, _ = land(units.join(repeated, "node").distinct(), "paragraph-repeated")
    for path in (units_path, reach_path, groups_path):
        drop(spark, path)
    sweep(spark)
    docs = hits.select("c", "d", "h").distinct().groupBy("c").agg(F.count(F.lit(1)).alias("docs"))
    order = Window.partitionBy("d", "h").orderBy("unit")
    runs = (hits.withColumn("new", (F.col("unit") - F.lag("unit", 1, -2).over(order) > 1).cast("int"))
            .withColumn("run", F.sum("new").over(order)))
    whole = Window.partitionBy("d", "h", "run")
    found = (runs.withColumn("run_words", (F.max(F.col("first") + F.col("words")).over(whole) - F.min("first").over(whole)))
             .where(F.col("run_words") >= run_words).join(docs, "c")
             .select("d", "h", "unit", "first", "words", "c", "docs", F.col("run_words").cast("int").alias("run_words"),
                     ((F.col("head.d") == F.col("d")) & (F.col("head.h") == F.col("h")) & (F.col("head.unit") == F.col("unit"))).alias("kept")))

    def rest_of(units: DataFrame) -> DataFrame:
        taken = (units.select("d", "h", F.struct(F.col("first").alias("a"), (F.col("first") + F.col("words")).alias("b"), "kept").alias("u"))
                 .groupBy("d", "h").agg(F.collect_set("u").alias("units")))
        passages = _passages(texts, bits).groupBy("d", "h").agg(F.collect_list(F.struct("a", "b", "c", "docs", "kept")).alias("runs"))
        out = (passages.join(taken, ["d", "h"], "left").select("d", "h", "runs", "units")
               .mapInArrow(_uncovered, "d bigint, h bigint, first int, words int, c bigint, docs bigint, run_words int, kept boolean"))
        return out.withColumn("unit", F.lit(None).cast("int"))
    return found, rest_of


def _cut(batches):
    for batch in batches:
        out = []
        for text, spans in zip(*(batch.column(c).to_pylist() for c in range(1, 3))):
            raw = (text or "").encode("utf-8", "replace")
            words = W.Words([raw], W.BY_ALNUM)
            at, kept = 0, []
            for f, n in sorted((x["first"], x["words"]) for x in spans):
                stop = words.begin[f + n] if f + n < len(words) else len(raw)
                kept.append(raw[at:max(at, int(words.begin[f]))])
                at = max(at, int(stop))
            out.append((b"".join(kept) + raw[at:]).decode("utf-8"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["id", "text"])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                    bands: int = BANDS, rows: int = ROWS, run_words: int = RUN_WORDS) -> DataFrame:
    """``id, text`` with every repeated unit and passage cut out but the occurrence that is
    kept.  Every row is cut by its own text's findings; rows that repeat id and text are
    one document and stay alike."""
    gone = (_repeats(docs, id_col, text_col, percent, bands, rows, run_words).where("not kept").groupBy("d", "h")
            .agg(F.collect_list(F.struct("first", "words")).alias("spans")))
    joined = _documents(docs, id_col, text_col).join(gone, ["d", "h"], "left")
    shape = StructType([StructField("id", docs.schema[id_col].dataType), StructField("text", StringType())])
    cut = joined.where("spans is not null").select("id", "text", "spans").mapInArrow(_cut, shape)
    return (joined.where("spans is null").select("id", "text").unionByName(cut)
            .select(F.col("id").alias(id_col), F.col("text").alias(text_col)))
