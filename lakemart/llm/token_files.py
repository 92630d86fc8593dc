"""Token-id files: ids of a public tokenizer, packed by an adaptive context-mixing
range coder in independently reset, checksummed blocks.

Model.  For every id three predictions are kept in the block: the id that last
followed the two ids before it (order 2), the id before it (order 1), and the id
that leads the block so far (order 0), each with a confidence.  An adaptive
probability per order and confidence says how often such a prediction is right,
and adaptive weights mix the three orders into one distribution over "equals this
prediction" and an escape.  An escaped id is coded by its bit length (counts that
adapt every ``REFRESH`` ids) and its remaining bits.  A carry-less range coder (64-bit state, 32-bit
words) turns the intervals into bytes.

Blocks of ``BLOCK`` ids start from an empty model, so any block decodes alone, and
carry the CRC-32 of their ids.  A task codes many blocks in lockstep: step ``t``
codes id ``t`` of all of them with numpy, the three orders in one array.

File format.  Documents are written in ascending id order, cut into parts by id
(one shuffle, approximate percentiles as cuts) and inside a part into *segments*
of whole documents, about ``SEGMENT`` ids each (a longer document is its own
segment).  A segment is one binary: ``CMX2``, counts, document ids, lengths, the
blocks' word counts and checksums, then the blocks.  Segments are stored as rows
``(part, segment, n_ids, payload)`` of Parquet files, so that writing is
committed by Spark and survives lost executors.

Defined results: a null text is empty and has only the end id; rows that repeat
an id are kept, ordered by text; a null id sorts first and reads back as null.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import land

BLOCK = 2048
SEGMENT = 1 << 22
LANES = 2048                    # blocks that are coded together
SLOTS1, SLOTS2 = 1024, 2048     # context tables of a block
CONF = 8
CLASSES = 17                    # bit lengths 0..16 of an escaped id
REFRESH = 32                    # ids of a block between two looks at its class counts
MAX_PARTS = 4096
CACHE = 800_000
GROUP = 500                     # texts that are tokenized together
U = np.uint64
FULL = U((1 << 64) - 1)
WORD, LOW32 = U(1 << 32), U((1 << 32) - 1)
END = 0


# ---- tokenizer ------------------------------------------------------------------

#: white space but the plain space
WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
ASCII_WHITE = [c for c in WHITE if c.isascii()]


def spaced_out(text: str) -> bool:
    """Whether every space stands between two characters that are no white space."""
    if text[:1] == " " or text[-1:] == " " or "  " in text:
        return False
    return not any(c in text and (c + " " in text or " " + c in text) for c in (ASCII_WHITE if text.isascii() else WHITE))


class Pieces(dict):
    """Numbers of pieces; one that is asked for first gets the next number and is listed in ``new``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


class Ids:
    """Ids of texts, equal to encoding each whole text, with a cache of its pieces.

    The byte-level pre-tokenizer always starts a piece at a single space between
    two characters that are no white space, and pieces are encoded on their own, so
    a text's ids are the ids of the pieces cut there.  The vocabulary's special tokens hold
    no space and take none beside them, so no cut changes one.  The cache holds the pieces
    that follow such a space, by their text behind it."""

    SAFE = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)      # ids that begin with a space
        for token, i in self.tokenizer.get_vocab().items():
            self.spaced[i] = token.startswith("\u0120")
        self._reset()

    def _reset(self):
        self.known = Pieces()
        self.table = np.zeros(0, np.uint32)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, pieces: list[str]):
        """Encode new pieces, many in one call: each starts with the only space in it."""
        plain = [i for i, p in enumerate(pieces) if " " not in p]
        other = [i for i, p in enumerate(pieces) if " " in p]
        order, ids, size = [], [], []
        for first in range(0, len(plain), 4096):
            group = plain[first:first + 4096]
            got = np.array(self._encode(" " + " ".join([pieces[i] for i in group])), np.uint32)
            at = np.flatnonzero(self.spaced[got])
            if len(at) == len(group) and at[0] == 0:
                order += group
                ids.append(got)
                size.append(np.diff(np.append(at, len(got))))
            else:
                other += group
        for i in other:
            ids.append(np.array(self._encode(" " + pieces[i]), np.uint32))
            size.append(np.array([len(ids[-1])]))
        lengths, order = np.concatenate(size).astype(np.int64), np.array(order + other, np.int64)
        start, size = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        start[order], size[order] = len(self.table) + np.cumsum(lengths) - lengths, lengths
        self.start, self.size = np.concatenate((self.start, start)), np.concatenate((self.size, size))
        self.table = np.concatenate((self.table, *ids))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        split = [(t.split(" ") if spaced_out(t) else self.SAFE.split(t)) for t in texts]
        heads = self.tokenizer.encode_batch_fast([p[0] for p in split], add_special_tokens=False)
        rest = [p[1:] for p in split]
        if len(self.known) > CACHE:
            self._reset()
        which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(rest)), np.int64, sum(map(len, rest)))
        if self.known.new:
            new, self.known.new = self.known.new, []
            self._learn(new)
        size = self.size[which]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.table[np.repeat(self.start[which] - (ends - size), size) + np.arange(total)]
        upto = np.concatenate(([0], ends))[np.cumsum([0] + [len(r) for r in rest])]
        return [np.concatenate((np.array(h.ids, np.uint32), flat[a:b])) for h, a, b in zip(heads, upto, upto[1:])]


_ids: dict[str, Ids] = {}


def tokenizer(path: str) -> Ids:
    """One per worker process."""
    if path not in _ids:
        _ids[path] = Ids(path)
    return _ids[path]


# ---- coder ----------------------------------------------------------------------

class _Model:
    """The mixed id model of ``n`` blocks side by side; a first axis of 3 holds the orders.

    A context slot holds ``id * 8 + confidence``; ``cdf`` holds the cumulative shares of
    the bit-length classes out of ``SHARES``, one column per block."""

    def __init__(self, n: int):
        self.n, self.lane = n, np.arange(n)
        self.base = np.stack((self.lane, n + self.lane * SLOTS1, n * (1 + SLOTS1) + self.lane * SLOTS2))
        self.at = self.base.copy()
        self.slot = np.zeros(n * (1 + SLOTS1 + SLOTS2), np.int32)
        self.right = np.tile(((np.arange(CONF) + 0.5) / (CONF + 4.0)).astype(np.float32), 3 * n)
        self.cells = (np.arange(3 * n) * CONF).reshape(3, n)
        self.weight = np.repeat(np.array([[0.2], [0.3], [0.5]], np.float32), n, axis=1)
        self.counts = np.ones((CLASSES, n), np.uint32)
        self.cdf = np.zeros((CLASSES + 1, n), np.uint16)
        self.flat = self.cdf.reshape(-1)
        self._share()
        self.h1, self.h2 = np.zeros(n, np.uint32), np.zeros(n, np.uint32)

    def _share(self):
        cum = np.cumsum(self.counts, axis=0, dtype=np.uint32)
        self.cdf[1:] = cum * np.uint32(SHARES) // cum[-1]

    def count(self, key: np.ndarray):
        """Learn the classes of escaped ids, given as ``class * n + lane``."""
        if len(key):
            self.counts += np.bincount(key, minlength=CLASSES * self.n).reshape(CLASSES, self.n).astype(np.uint32)
            self._share()

    def predict(self):
        """(guesses, frequencies) of orders 0, 1, 2 out of 65536; equal guesses are merged upwards."""
        np.add(self.base[1], self.h1 >> np.uint32(22), out=self.at[1])
        np.add(self.base[2], ((self.h1 ^ self.h2) * np.uint32(3266489917)) >> np.uint32(21), out=self.at[2])
        self.held = self.slot.take(self.at)
        self.sure = self.held & 7
        self.guess = g = self.held >> 3
        self.cell = self.cells + self.sure
        self.prob = self.right.take(self.cell)
        m = self.weight * self.prob
        m *= np.float32(60000.0)
        same12, same02, same01 = g[1] == g[2], g[0] == g[2], g[0] == g[1]
        m[2] += m[1] * same12 + m[0] * same02
        m[1] += m[0] * same01
        m[1] *= ~same12
        m[0] *= ~(same02 | same01)
        return g, m.astype(np.uint32)

    def bounds(self, esc: np.ndarray, key: np.ndarray):
        """Interval of a bit-length class (given as ``class * n + lane``) inside the escape's share."""
        return (esc * self.flat.take(key)) >> _SHIFT, (esc * self.flat.take(key + self.n)) >> _SHIFT

    def classes(self, esc: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The class whose interval holds ``value``."""
        upto = ((((value + np.uint32(1)) << _SHIFT) - np.uint32(1)) // esc).astype(np.uint16)
        return np.add.reduce((self.cdf[1:CLASSES] <= upto).view(np.uint8), axis=0, dtype=np.uint8)

    def learn(self, x: np.ndarray, hits: np.ndarray):
        """``hits``: which guesses are ``x``."""
        p = self.prob
        self.right[self.cell] = p + (hits - p) * np.float32(0.0625)
        votes = p * hits
        votes += np.float32(0.02)
        self.weight *= np.float32(0.95)
        self.weight += votes * (np.float32(0.05) / (votes[0] + votes[1] + votes[2]))
        sure = _NEXT.take(self.sure + hits * np.int32(CONF))
        new = self.held - self.sure + sure
        np.copyto(new, x * 8 + 1, where=sure == 0)
        self.slot[self.at] = new
        self.h2 = (self.h1 << np.uint32(7)) | (self.h1 >> np.uint32(25))
        self.h1 = x.astype(np.uint32) * np.uint32(2654435761)


SHARES, _SHIFT = 1 << 15, np.uint32(15)
#: confidence after a miss (0: the guess is replaced) and, from CONF on, after a hit
_NEXT = np.concatenate((np.where(np.arange(CONF) <= 1, 0, np.arange(CONF) >> 1),
                        np.minimum(np.arange(CONF) + 1, CONF - 1))).astype(np.int32)
#: bit length of an id; first id and raw bits of a class
_LENGTH = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.int64)
_FIRST = np.concatenate(([0], 1 << np.arange(CLASSES - 1))).astype(np.uint32)
_RAW = np.maximum(np.arange(CLASSES) - 1, 0).astype(np.uint8)


class _Out:
    """Range coder of ``n`` blocks: 64-bit state, 32-bit words, no carries (a range
    that straddles a word's end is cut short)."""

    def __init__(self, n: int, length: int):
        self.low, self.size = np.zeros(n, U), np.full(n, FULL, U)
        self.words = np.zeros((n, length + 8), np.uint32)         # a step gives a word at most
        self.flat, self.begin = self.words.reshape(-1), np.arange(n) * (length + 8)
        self.at = self.begin.copy()

    def put(self, start, width, value, bits):
        """Narrow to [start, start + width) of 65536 parts, then to ``value`` of ``2 ** bits``."""
        part = self.size >> U(16)
        size = (part * width.astype(U)) >> bits.astype(U)
        self.low = low = self.low + part * start.astype(U) + value.astype(U) * size
        self.size = size
        rows = np.flatnonzero(size < WORD)
        if len(rows):
            l, s = low[rows], size[rows]
            at = self.at[rows]
            self.flat[at] = l >> U(32)
            self.at[rows] = at + 1
            self.low[rows], self.size[rows] = l << U(32), _refilled(l, s)

    def close(self):
        for shift in (32, 0):
            self.flat[self.at] = (self.low >> U(shift)) & LOW32
            self.at += 1


def _refilled(low, size):
    """The range after a word has left: cut first if it reaches into the next word."""
    room = WORD - (low & LOW32)
    return np.minimum(size, room) << U(32)


class _In:
    def __init__(self, words: np.ndarray, starts: np.ndarray):
        n = len(starts)
        self.words = np.concatenate((words.astype(U), np.zeros(8, U)))
        s = starts.astype(np.int64)
        self.at = s + 2
        self.low, self.size = np.zeros(n, U), np.full(n, FULL, U)
        self.code = (self.words[s] << U(32)) | self.words[s + 1]

    def peek(self):
        self.part = self.size >> U(16)
        return np.minimum((self.code - self.low) // self.part, U(65535)).astype(np.uint32)

    def take(self, start, width, bits):
        """The raw value behind the interval."""
        b = bits.astype(U)
        size = (self.part * width.astype(U)) >> b
        low = self.low + self.part * start.astype(U)
        value = np.minimum((self.code - low) // size, (U(1) << b) - U(1))
        self.low = low = low + value * size
        self.size = size
        rows = np.flatnonzero(size < WORD)
        if len(rows):
            l, s = low[rows], size[rows]
            self.low[rows], self.size[rows] = l << U(32), _refilled(l, s)
            self.code[rows] = (self.code[rows] << U(32)) | self.words[np.minimum(self.at[rows], len(self.words) - 1)]
            self.at[rows] += 1
        return value.astype(np.uint32)


def encode_blocks(ids: np.ndarray) -> tuple[list[bytes], int]:
    """Blocks of ``ids`` and their length (the last one is filled with the end id)."""
    length = min(BLOCK, max(len(ids), 1))
    n = -(-len(ids) // length)
    grid = np.zeros(n * length, np.int32)
    grid[:len(ids)] = ids
    grid = grid.reshape(n, length)
    blocks: list[bytes] = []
    for first in range(0, n, LANES):
        rows = np.ascontiguousarray(grid[first:first + LANES].T)
        model, out = _Model(rows.shape[1]), _Out(rows.shape[1], length)
        for t in range(0, length, REFRESH):
            some = rows[t:t + REFRESH]
            cls = _LENGTH[some]
            key, escaped = cls * model.n + model.lane, np.empty(some.shape, bool)
            for x, k, low, bits, esc in zip(some, key, some - _FIRST[cls].view(np.int32), _RAW[cls], escaped):
                g, f = model.predict()
                hits = g == x
                by = hits & (f > 0)                 # a merged guess has frequency 0
                np.logical_not(by[0] | by[1] | by[2], out=esc)
                f21 = f[2] + f[1]
                front = f21 + f[0]
                a, b = model.bounds(np.uint32(65536) - front, k)
                own = f * by
                out.put(by[1] * f[2] + by[0] * f21 + esc * (front + a), own[0] + own[1] + own[2] + esc * (b - a), low * esc, bits * esc)
                model.learn(x, hits)
            model.count(key[escaped])
        out.close()
        blocks += [w[:c].tobytes() for w, c in zip(out.words, (out.at - out.begin).tolist())]
    return blocks, length


def decode_blocks(words: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """(blocks, length) ids of blocks that stand one after the other in ``words``."""
    starts = np.cumsum(counts) - counts
    out = np.zeros((len(counts), length), np.uint32)
    for first in range(0, len(counts), LANES):
        s = starts[first:first + LANES]
        model, coded = _Model(len(s)), _In(words, s)
        grid = np.zeros((length, len(s)), np.int32)
        for t in range(0, length, REFRESH):
            some = grid[t:t + REFRESH]
            key, escaped = np.empty(some.shape, np.int64), np.empty(some.shape, bool)
            for x, k, esc in zip(some, key, escaped):
                g, f = model.predict()
                value = coded.peek()
                f21 = f[2] + f[1]
                front = f21 + f[0]
                share = np.uint32(65536) - front
                by2, by21 = value < f[2], value < f21
                by1 = by2 ^ by21
                np.greater_equal(value, front, out=esc)
                by0 = ~(by21 | esc)
                cls = model.classes(share, (value - front) * esc) * esc
                np.add(cls * np.int64(model.n), model.lane, out=k)
                a, b = model.bounds(share, k)
                start = by1 * f[2] + by0 * f21 + esc * (front + a)
                width = by2 * f[2] + by1 * f[1] + by0 * f[0] + esc * (b - a)
                rest = coded.take(start, width, _RAW.take(cls))
                x[:] = by2 * g[2] + by1 * g[1] + by0 * g[0] + (esc * (_FIRST.take(cls) + rest)).view(np.int32)
                model.learn(x, g == x)
            model.count(key[escaped])
        out[first:first + LANES] = grid.T
    return out


# ---- segments -------------------------------------------------------------------

MAGIC = b"CMX2"


def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One segment: its documents' ids and lengths, then the coded blocks."""
    blocks, length = encode_blocks(ids)
    crc = [zlib.crc32(ids[i * length:(i + 1) * length].astype("<u4").tobytes()) for i in range(len(blocks))]
    return b"".join([
        MAGIC, struct.pack("<QQII", len(ids), len(doc_ids), length, len(blocks)),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is not None for d in doc_ids], "u1").tobytes(), np.array(lengths, "<u8").tobytes(),
        np.array([len(b) // 4 for b in blocks], "<u4").tobytes(), np.array(crc, "<u4").tobytes(), *blocks])


def unpack(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, lengths, ids) of a segment; a damaged block is an error."""
    if data[:4] != MAGIC:
        raise ValueError("not a token segment")
    n, docs, length, blocks = struct.unpack_from("<QQII", data, 4)
    at = 4 + struct.calcsize("<QQII")

    def column(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out
    doc_ids, known, lengths = column("<i8", docs), column("u1", docs), column("<u8", docs)
    counts, crc = column("<u4", blocks).astype(np.int64), column("<u4", blocks)
    grid = decode_blocks(np.frombuffer(data, "<u4", int(counts.sum()), at), counts, length)
    ids = grid.reshape(-1)[:n]
    for i in range(blocks):
        if zlib.crc32(ids[i * length:(i + 1) * length].astype("<u4").tobytes()) != crc[i]:
            raise ValueError(f"block {i} of a token segment is damaged")
    return [int(d) if k else None for d, k in zip(doc_ids, known)], lengths.astype(np.int64), ids


def _write(path: str):
    def run(batches):
        coder = tokenizer(path)
        part, segment, ids, docs, size = None, 0, [], [], 0

        def done():
            nonlocal ids, docs, size, segment
            flat = np.concatenate(ids)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(flat)], pa.int64()),
                 pa.array([pack(docs, [len(i) for i in ids], flat)], pa.binary())],
                names=["part", "segment", "n_ids", "payload"])
            ids, docs, size, segment = [], [], 0, segment + 1
            return row
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for first in range(0, len(texts), GROUP):
                coded = coder.encode(texts[first:first + GROUP])
                for (p, d), got in zip(keys[first:first + GROUP], coded):
                    if p != part:
                        if ids:
                            yield done()
                        part, segment = p, 0
                    ids.append(np.append(got, np.uint32(END)))
                    docs.append(d)
                    size += len(got) + 1
                    if size >= SEGMENT:
                        yield done()
        if ids:
            yield done()
    return run


def _read(batches):
    for batch in batches:
        for start, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            docs, lengths, ids = unpack(data)
            ends = np.cumsum(lengths)
            raw = ids.astype("<u4").tobytes()
            crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                names=["id", "start", "n_tokens", "ids_crc32"])


def write_tokens(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write the token files of ``docs`` to ``path``."""
    spark = docs.sparkSession
    key = F.coalesce(F.col("id"), F.lit(-(1 << 63)).cast("bigint"))
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), MAX_PARTS)
    cuts = texts.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)] or [0.5], 100 * parts)
                     .alias("c")).first()["c"]
    cuts = F.array(*[F.lit(c).cast("bigint") for c in sorted(set(cuts or ()))]).cast("array<bigint>")
    part = F.size(F.filter(cuts, lambda c: c < key)).cast("int")
    ordered = (texts.withColumn("part", part).repartitionById(parts, F.col("part") % parts)
               .sortWithinPartitions("part", "id", "text").select("part", "id", "text"))
    (ordered.mapInArrow(_write(vocabulary), "part int, segment int, n_ids bigint, payload binary")
     .write.parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every document, decoded from the files."""
    files = spark.read.schema("part int, segment int, n_ids bigint, payload binary").parquet(path)
    sizes = files.select("part", "segment", "n_ids")
    each = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))                   # at most MAX_PARTS rows
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = each.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.join(F.broadcast(parts), "part")
              .select("part", "segment", (F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("start")))
    starts, _ = land(starts, "token-starts")
    # one narrow row per segment; the payloads stay where they are while this is small
    small = starts.count() <= 1_000_000
    return (files.join(F.broadcast(starts) if small else starts, ["part", "segment"]).select("start", "payload")
            .mapInArrow(_read, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def token_table(docs: DataFrame, vocabulary: str | None = None, path: str | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Write the token files of ``docs`` (below ``spark.checkpoint.dir`` without a
    ``path``) and read them back: ``id, start, n_tokens, ids_crc32``."""
    from ..session import scratch_path
    path = path or scratch_path(docs.sparkSession, "llm-tokens")
    write_tokens(docs, path, vocabulary or default_vocabulary(), id_col, text_col)
    return read_tokens(docs.sparkSession, path).withColumnRenamed("id", id_col)
