"""Phrase collocations by SON partitioning, per language.

Phrases are runs of 2 to ``MAX_WORDS`` words inside a piece of text; candidates are
those with at least ``support`` occurrences in their language.

1. *Words.*  One pass over the whole texts lands, per chunk of a language, the chunk's
   words as 32-bit codes with breaks at pieces, and its word counts.  ``f`` of single
   words and ``n`` are sums over them.
2. *Shards.*  The tasks of that pass form ``SHARDS`` shards a language.  A shard with
   ``n_i`` of the language's ``n`` words has the local support ``ceil(support * n_i / n)``:
   a phrase below it in every shard has fewer than ``support`` occurrences in all.
   Each shard is mined completely, level by level: pairs of frequent words, then runs
   of three and four all of whose pairs are candidates.  A shard is not
   a task: its runs are counted per chunk, cut by the leading bits of their hash into
   parts of about ``PART_RUNS`` and added up part by part, so memory stays the same
   whatever a shard's size, and a hot language or phrase is one entry a chunk.
3. *Union.*  A phrase that is frequent in some shards has its counts there and less
   than the local support in each other shard; if that sum can reach ``support``, it sets
   one bit of a bitmap of ``2 ** BITS`` bits (8 MB, whatever the data).  Equal hashes
   only add candidates.
4. *Count.*  A second pass over the whole texts counts every phrase whose bit is set,
   by its words; counts leave a task packed by part of the hash and are summed part by
   part, and sums below ``support`` are left out.  So counts are exact.
5. *Score.*  Every cut of a candidate joins the counts of its two parts (each part is
   a frequent word or a candidate itself); candidates inside a longer one that has
   ``inside`` percent of their occurrences go.  Arithmetic is decimal, hence exact.

Within a chunk words are told apart by a 64-bit hash and then compared byte by byte
with the word that stands for them; a chunk with a clash takes a dictionary instead.

Defined results: null text is empty, null language is ``und``; repeated rows count
each; ids are not used; an empty table or texts without words give no rows; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import drop, land
from .words import LEN_TABLE, U, WORD_TABLE, Words, byte_classes, chunks, mix, stream

SUPPORT, MAX_WORDS, INSIDE, TOP = 30, 4, 80, 2000
SHARDS, BITS = 8, 26
#: bytes tokenised at a time and held per task, words whose runs are counted at a time,
#: strings held
CHUNK_BYTES, HELD_BYTES, ROW_WORDS, HELD_STRINGS = 1 << 20, 8 << 20, 1 << 20, 1 << 17
#: codes of a landed row (4 bytes each): small enough to be no outsized object of the JVM
BLOB_CODES = 1 << 16
#: runs added up at a time, and the least number of leading bits that parts are cut by
PART_RUNS, LEAST_BITS = 1 << 21, 4
#: (language, shard) rows that may be broadcast (about 100 bytes each)
BROADCAST_SHARDS = 100_000
ENDS = b".,;:!?\n\x0b\x0c\r"
#: words are runs of anything but blank, tab and the characters that end a piece
CLASSES = byte_classes([0x20, 0x09, *ENDS])
MARKS = bytes(int(c in ENDS) for c in range(256))


class Chunk:
    """Words of some texts of one language: ``code`` and ``word`` (number among the
    distinct words) of each, ``start`` where a new piece begins."""

    def __init__(self, lang: str, texts: list[bytes]):
        w = self.words = Words(texts, CLASSES)
        ends = np.cumsum(np.frombuffer((b" ".join(texts) + b" ").translate(MARKS), np.uint8), dtype=np.int64)
        piece = ends[w.begin]
        self.start = np.ones(len(w), bool)
        self.start[1:] = (w.doc[1:] != w.doc[:-1]) | (piece[1:] != piece[:-1])
        _, first, self.word = np.unique(w.hash, return_index=True, return_inverse=True)
        if not self._same(first):
            known: dict[bytes, int] = {}
            self.word = np.array([known.setdefault(w.data[a:b], len(known)) for a, b in zip(w.begin, w.end)], np.int64)
            first = np.unique(self.word, return_index=True)[1]
        self.spelled = pa.array([w.data[a:b] for a, b in zip(w.begin[first].tolist(), w.end[first].tolist())],
                                pa.binary()).cast(pa.string())
        self.code = codes(w.hash)
        self.hash = hashes(self.code, lang)

    def _same(self, first) -> bool:
        """Whether every word equals, byte by byte, the word that stands for its hash."""
        w = self.words
        size, stands = w.end - w.begin, first[self.word]
        if (size != size[stands]).any():
            return False
        a = np.frombuffer(w.data, np.uint8)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return bool((a[at + np.repeat(w.begin, size)] == a[at + np.repeat(w.begin[stands], size)]).all())


def codes(h: np.ndarray) -> np.ndarray:
    return np.maximum((h >> U(32)).astype(np.uint32), np.uint32(1))


def hashes(code: np.ndarray, lang: str) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(code.astype(U) + stream(zlib.crc32(lang.encode()), 1)[0])


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place (places near the end left out)."""
    n = max(len(h) - k + 1, 0)
    with np.errstate(over="ignore"):
        out = np.full(n, LEN_TABLE[k], U)
        for j in range(k):
            out = out + h[j:n + j] * WORD_TABLE[j]
        return mix(out)


def has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h & U((1 << BITS) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def both(ok: np.ndarray, k: int) -> np.ndarray:
    """Places from which ``k`` consecutive flags hold."""
    n = max(len(ok) - k + 1, 0)
    out = np.ones(n, bool)
    for j in range(k):
        out &= ok[j:n + j]
    return out


def _by_language(batches):
    """(language, encoded texts) of at most ``CHUNK_BYTES`` (or one text) each."""
    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if text.is_valid:
                text = text.as_py()
                held.setdefault(lang, []).append(text)
                size += len(text)
            if size >= HELD_BYTES:
                yield from ((x, part) for x, texts in held.items() for _, part in chunks(texts, CHUNK_BYTES))
                held, size = {}, 0
    yield from ((x, part) for x, texts in held.items() for _, part in chunks(texts, CHUNK_BYTES))


class Tally:
    """Counts (and hashes) of strings, merged when more than ``HELD_STRINGS`` are held."""

    def __init__(self):
        self.parts, self.held, self.merged = [], 0, 0

    def add(self, words, counts, hashes_=None):
        h = pa.nulls(len(words), pa.uint64()) if hashes_ is None else pa.array(hashes_, pa.uint64())
        self.parts.append(pa.table({"w": words, "c": pa.array(counts, pa.int64()), "h": h}))
        self.held += len(words)
        if self.held > 2 * max(self.merged, HELD_STRINGS):
            self.merge()

    def merge(self) -> pa.Table:
        t = pa.concat_tables(self.parts).group_by("w").aggregate([("c", "sum"), ("h", "min")])
        t = pa.table({"w": t["w"], "c": t["c_sum"], "h": t["h_min"]}).combine_chunks()
        self.parts, self.held, self.merged = [t], len(t), len(t)
        return t


def _words(shards):
    def run(batches):
        shard = TaskContext.get().partitionId() % shards
        held: dict[str, list] = {}

        def flush(lang):
            parts, tally, n = held.pop(lang)
            code = np.concatenate(parts)
            ends = np.append(np.arange(BLOB_CODES, len(code), BLOB_CODES), len(code))
            # a blob ends where a piece does, so that no run crosses it
            breaks = np.flatnonzero(code == 0)
            ends = np.unique(np.append(breaks[np.maximum(np.searchsorted(breaks, ends, "right") - 1, 0)][:-1], len(code)))
            blobs = [code[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())]
            blobs = [x for x in blobs if len(x)]
            tally = tally.merge()
            words, counts = (tally[x].combine_chunks() for x in "wc")
            k, m = len(blobs), len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k, pa.string()), pa.array([shard] * k, pa.int32()),
                 pa.array([int(np.count_nonzero(x)) for x in blobs], pa.int64()),
                 pa.array([x.tobytes() for x in blobs], pa.binary()), pa.nulls(k, pa.string()), pa.nulls(k, pa.int64())], names=NAMES)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * m, pa.string()), pa.array([shard] * m, pa.int32()), pa.nulls(m, pa.int64()),
                 pa.nulls(m, pa.binary()), words, counts], names=NAMES)

        for lang, texts in _by_language(batches):
            c = Chunk(lang, texts)
            if not len(c.code):
                continue
            at = np.arange(len(c.code)) + np.cumsum(c.start)
            code = np.zeros(at[-1] + 1, np.uint32)                  # 0: a new piece
            code[at] = c.code
            row = held.setdefault(lang, [[], Tally(), 0])
            row[0].append(code)
            row[1].add(c.spelled, np.bincount(c.word, minlength=len(c.spelled)))
            row[2] += len(c.code)
            if row[2] >= ROW_WORDS:
                yield from flush(lang)
            elif sum(x[2] for x in held.values()) >= 4 * ROW_WORDS:  # many languages side by side
                for x in list(held):
                    yield from flush(x)
        for x in list(held):
            yield from flush(x)
    return run


#: a row has either codes and their number of words ``n``, or a word and its count
WORDS = "lang string, shard int, n bigint, codes binary, word string, f bigint"
NAMES = ["lang", "shard", "n", "codes", "word", "f"]


def _word_hashes(batches):
    for batch in batches:
        words = [x.encode() for x in batch.column(1).to_pylist()]
        code = codes(Words(words, CLASSES).hash) if words else np.zeros(0, np.uint32)
        lang = batch.column(0).dictionary_encode()
        h, of = np.zeros(len(words), U), lang.indices.to_numpy()
        for i, name in enumerate(lang.dictionary.to_pylist()):
            h[of == i] = hashes(code[of == i], name)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])


def low5(x: np.ndarray) -> bytes:
    """The low 40 bits of hashes, packed.  With a part's leading bits they tell a shard's
    runs apart; runs that still fall together only add candidates."""
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def from5(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel().astype(U)


def _mine(single, pairs, bits):
    """Counts of the pairs of frequent words; with ``pairs``, of the runs of three and
    more words all of whose pairs are in it.  One row per part, the leading ``bits``
    bits of the hash, with packed hashes and counts."""
    def run(batches):
        one = single.value
        two = pairs.value if pairs is not None else None
        held: dict[tuple, list] = {}
        size = 0

        def flush(key):
            lang, shard, need, slack = key
            code = np.concatenate(held.pop(key))
            h = hashes(code, lang)
            ok = (code != 0) & has(one, h)
            if two is None:
                found = runs(h, 2)[both(ok, 2)]
            else:
                near = both(ok, 2) & has(two, runs(h, 2))
                found = np.concatenate([runs(h, k)[both(near, k - 1)] for k in range(3, MAX_WORDS + 1)])
            x, count = np.unique(found, return_counts=True)
            here, first = np.unique((x >> U(64 - bits)).astype(np.int64), return_index=True)
            ends = [*first[1:].tolist(), len(x)]
            count, k = count.astype(np.uint32), len(here)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * k, pa.string()), pa.array([shard] * k, pa.int32()), pa.array([need] * k, pa.int64()),
                 pa.array([slack] * k, pa.int64()), pa.array(here, pa.int32()),
                 pa.array([low5(x[a:b]) for a, b in zip(first, ends)], pa.binary()),
                 pa.array([count[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())],
                names=["lang", "shard", "need", "slack", "part", "hashes", "counts"])

        for batch in batches:
            for *key, raw in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                key = tuple(key)
                held.setdefault(key, []).append(np.frombuffer(raw, np.uint32))
                size += len(raw) // 4
                if sum(map(len, held[key])) >= ROW_WORDS or size >= 4 * ROW_WORDS:
                    for k in [key] if size < 4 * ROW_WORDS else list(held):
                        size -= sum(map(len, held[k]))
                        yield flush(k)
        for key in list(held):
            yield flush(key)
    return run


COUNTED = "lang string, shard int, need bigint, slack bigint, part int, hashes binary, counts binary"


def _locally_frequent(table: pa.Table) -> pa.Table:
    """Hashes of one part of a shard that reach its local support: what each has beyond
    the most that an infrequent one can have, and the sum of the latter over all shards."""
    x = from5(b"".join(table["hashes"].to_pylist()))
    c = np.concatenate([np.frombuffer(v.as_buffer(), np.uint32) for v in table["counts"]]).astype(np.int64)
    order = np.argsort(x, kind="stable")
    x, c = x[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    total, need = np.add.reduceat(c, first), table["need"][0].as_py()
    often = total >= need
    x, beyond = x[first[often]], total[often] - (need - 1)
    return pa.table({"h": pa.array(x.view(np.int64)), "beyond": pa.array(beyond),
                     "slack": pa.array(np.full(len(x), table["slack"][0].as_py()), pa.int64())})


def _count(single, pairs, longer, bits):
    """Occurrences of every phrase whose bit is set, by its words: one row per part, the
    leading ``bits`` bits of the hash, with the phrases as lines and their counts."""
    def run(batches):
        one, two, more = single.value, pairs.value, longer.value
        held: dict[str, Tally] = {}

        def flush():
            for lang, tally in held.items():
                t = tally.merge()
                part = (t["h"].to_numpy() >> U(64 - bits)).astype(np.int32)
                t = t.append_column("part", pa.array(part)).sort_by([("part", "ascending"), ("w", "ascending")])
                here, first = np.unique(np.sort(part), return_index=True)
                words, counts = t["w"].to_pylist(), t["c"].to_numpy()
                ends, k = [*first[1:].tolist(), len(words)], len(here)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * k, pa.string()), pa.array(here, pa.int32()),
                     pa.array([squeeze("\n".join(words[a:b]).encode()) for a, b in zip(first, ends)], pa.binary()),
                     pa.array([squeeze(counts[a:b].tobytes()) for a, b in zip(first, ends)], pa.binary())],
                    names=["lang", "part", "phrases", "counts"])
            held.clear()

        for lang, texts in _by_language(batches):
            c = Chunk(lang, texts)
            n, word = len(c.code), c.word.astype(np.int64)
            ok = has(one, c.hash)
            join = ~c.start[1:]                                     # a word and its successor share a piece
            for k in range(2, MAX_WORDS + 1):
                if n < k:
                    break
                at = np.flatnonzero(both(ok, k) & both(join, k - 1))
                h = runs(c.hash, k)[at]
                use = has(two if k == 2 else more, h)
                at, h = at[use], h[use]
                if not len(at):
                    continue
                key = word[at]
                for j in range(1, k):                               # exact: ids of prefixes, extended word by word
                    key = np.unique(key * len(c.spelled) + word[at + j], return_inverse=True)[1]
                first, count = np.unique(key, return_index=True, return_counts=True)[1:]
                spelled = [c.spelled.take(pa.array(word[at[first] + j])) for j in range(k)]
                held.setdefault(lang, Tally()).add(pc.binary_join_element_wise(*spelled, " "), count, h[first])
            if sum(t.held for t in held.values()) > 4 * HELD_STRINGS:
                yield from flush()
        yield from flush()
    return run


PHRASES = "lang string, part int, phrases binary, counts binary"
_ZSTD = pa.Codec("zstd")


def squeeze(data: bytes) -> bytes:
    """Compressed, behind the length: sorted phrases shrink far better than rows of an exchange do."""
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def unsqueeze(data: bytes) -> bytes:
    return _ZSTD.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), asbytes=True)


def _add_up(support):
    def run(table: pa.Table) -> pa.Table:
        """Phrases of one part of a language with at least ``support`` occurrences."""
        words = pa.array(b"\n".join(map(unsqueeze, table["phrases"].to_pylist())).split(b"\n"), pa.binary()).cast(pa.string())
        counts = np.frombuffer(b"".join(map(unsqueeze, table["counts"].to_pylist())), np.int64)
        t = pa.table({"phrase": words, "f": counts}).group_by("phrase").aggregate([("f", "sum")])
        t = t.filter(pc.greater_equal(t["f_sum"], support))
        return pa.table({"lang": pa.array([table["lang"][0].as_py()] * len(t), pa.string()), "phrase": t["phrase"], "f": t["f_sum"]})
    return run


def bitmap(hashed: DataFrame) -> np.ndarray:
    """Bits of the low ``BITS`` bits of column ``h``: a fixed size for any input."""
    at = F.col("h").bitwiseAND(F.lit((1 << BITS) - 1))
    parts = hashed.groupBy(F.shiftright(at, 15).alias("part")).agg(
        F.bitmap_construct_agg(at.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for r in parts.toLocalIterator():                               # at most 2 ** (BITS - 15) rows of 4 KB
        out[r["part"] << 12:(r["part"] + 1) << 12] = np.frombuffer(r["bits"], np.uint8)
    return out


def score(candidates: DataFrame, words: DataFrame, sizes: DataFrame, inside: int, top: int) -> DataFrame:
    """Ranked collocations from the exact counts: ``candidates`` and ``words``
    (lang, phrase, f), ``sizes`` (lang, n)."""
    wide = "decimal(38,0)"
    parts = candidates.unionByName(words)
    w = F.split("phrase", " ")
    cuts = (candidates.select("lang", "phrase", F.col("f").alias("a"), w.alias("w"))
            .withColumn("k", F.explode(F.expr("sequence(1, size(w) - 1)")))
            .select("lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("head"),
                    F.array_join(F.expr("slice(w, k + 1, size(w) - k)"), " ").alias("tail")))
    for side, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    value = F.expr(f"(cast(2000000 as {wide}) * a) div (cast(l as {wide}) + r)")
    lowest = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("x"))
    subs = (candidates.select("lang", "f", w.alias("w")).where(F.size("w") > 2)
            .withColumn("k", F.explode(F.expr("sequence(2, size(w) - 1)")))
            .withColumn("i", F.explode(F.expr("sequence(1, size(w) - k + 1)")))
            .groupBy("lang", F.array_join(F.expr("slice(w, i, k)"), " ").alias("phrase")).agg(F.max("f").alias("within")))
    kept = lowest.join(subs, ["lang", "phrase"], "left").where(
        F.expr(f"within is null or cast(100 as {wide}) * within < cast({inside} as {wide}) * a"))
    order = Window.partitionBy("lang").orderBy(F.col("x.score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "x.l", "x.r", "n",
        F.col("x.score").cast("bigint").alias("score"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", support: int = SUPPORT,
                 shards: int = SHARDS, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """Each language's ``top`` collocations: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).cast("string").alias("text"))
    chunk, chunk_at = land(texts.mapInArrow(_words(shards), WORDS), "phrase-words")
    frequent = (chunk.where("word is not null").groupBy("lang", F.col("word").alias("phrase"))
                .agg(F.sum("f").alias("f")).where(F.col("f") >= support))
    frequent, _ = land(frequent, "phrase-frequent-words")
    chunk = chunk.where("codes is not null")
    local, _ = land(chunk.groupBy("lang", "shard").agg(F.sum("n").alias("n_i")), "phrase-shards")
    sizes = local.groupBy("lang").agg(F.sum("n_i").alias("n"))
    need = local.join(sizes, "lang").select("lang", "shard", F.expr(
        f"(cast({support} as decimal(38,0)) * n_i + n - 1) div n").alias("need"))
    need = need.join(need.groupBy("lang").agg(F.sum(F.col("need") - 1).alias("slack")), "lang")
    if local.count() <= BROADCAST_SHARDS:                           # else Spark's own choice
        need = F.broadcast(need)
    mined = chunk.join(need, ["lang", "shard"]).select("lang", "shard", "need", "slack", "codes")
    single = sc.broadcast(bitmap(frequent.select("lang", "phrase").mapInArrow(_word_hashes, "h bigint")))

    words = sizes.agg(F.sum("n")).first()[0] or 0
    bits = max(LEAST_BITS, min(24, (words // (shards * PART_RUNS)).bit_length()))

    def locally(pairs):
        counts = mined.mapInArrow(_mine(single, pairs, bits), COUNTED)
        often = counts.groupBy("lang", "shard", "part").applyInArrow(_locally_frequent, "h bigint, beyond bigint, slack bigint")
        # counts where frequent, and at most need - 1 in every other shard
        bound = often.groupBy("h").agg(F.sum("beyond").alias("beyond"), F.max("slack").alias("slack"))
        return sc.broadcast(bitmap(bound.where(F.col("beyond") + F.col("slack") >= support).select("h")))

    pairs = locally(None)
    longer = locally(pairs)
    counted = (texts.mapInArrow(_count(single, pairs, longer, bits + 2), PHRASES)
               .groupBy("lang", "part").applyInArrow(_add_up(support), "lang string, phrase string, f bigint"))
    candidates, _ = land(counted, "phrase-candidates")
    sizes, _ = land(sizes, "phrase-sizes")
    drop(spark, chunk_at)
    return score(candidates, frequent, sizes, inside, top)
