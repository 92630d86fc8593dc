"""Language identification by error-correcting output codes.

Every learned language has a codeword of +1/-1 bits; each bit is predicted by a
linear classifier over hashed byte n-grams of the lower-cased letters of a text.
Decoding sums, for every language, the logistic loss of the bit margins against
its codeword, weighted by how reliable each bit was on the validation part of the
sample, and takes the nearest codeword.  The losses become a probability by a
temperature fitted on the same part; ``ambiguous`` flags texts whose best two
codewords are close.

Up to seven languages get the exhaustive code, more get the random code with the
largest minimum distance of a fixed number of draws.

Training reads a sample of the labelled rows: about ``SAMPLE`` texts, evenly split
over all languages and chosen by a hash of the id, but of every language at least the
``LEAST`` rows of the smallest hashes (or all it has).  The driver holds 32 KB a
sampled row, so its memory grows with the number of languages.  Prediction reads
every whole text.

Defined results: ``und`` with score 0 for a null text or one without a letter,
and for all texts if nothing could be learned.  Rows that repeat an id are
predicted each on its own; a null id is never trained on and not held out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words as W

DIM = 1 << 13
ORDERS = (2, 3, 4)
SAMPLE, LEAST = 2400, 8
#: bytes and texts whose feature rows (32 KB each) are made at a time
CHUNK, TEXTS = 512 << 10, 512
AMBIGUOUS = 0.6
LETTER = regex.compile(r"\p{L}")
#: ASCII characters that are no letters become a space
LETTERS = W.byte_classes([c for c in range(128) if not chr(c).isalpha()])
U = np.uint64


def pieces(texts: list) -> Iterator[tuple[int, list[bytes]]]:
    """Groups of texts bounded by bytes and by number."""
    for start, part in W.chunks(texts, CHUNK):
        for i in range(0, len(part), TEXTS):
            yield start + i, part[i:i + TEXTS]


def features(part: list[bytes]) -> np.ndarray:
    """(n, DIM) unit rows: square roots of hashed byte n-gram counts."""
    n = len(part)
    data = np.frombuffer(b" ".join(part).translate(LETTERS) + b" ", dtype=np.uint8).astype(np.uint32)
    lens = np.fromiter(map(len, part), np.int64, n)
    doc = np.repeat(np.arange(n, dtype=np.int64), lens + 1)
    out = np.zeros(n * DIM, np.float32)
    gram = data.copy()
    for k in range(2, max(ORDERS) + 1):
        gram = (gram[:-1] << np.uint32(8)) | data[k - 1:]
        if k in ORDERS and len(gram):
            slot = ((gram * np.uint32(2654435761) + np.uint32(k * 40503)) >> np.uint32(19)).astype(np.int64)
            out += np.bincount(doc[:len(slot)] * DIM + slot, minlength=n * DIM)
    x = np.sqrt(out).reshape(n, DIM)
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-12)


def codewords(k: int, draws: int = 60) -> np.ndarray:
    """(k, bits) of +1/-1."""
    if k <= 2:
        return np.array([[1.0], [-1.0]])[:k]
    if k <= 7:
        bits = (1 << (k - 1)) - 1
        return np.array([[1.0] * bits] + [[1.0 if (b >> (k - 1 - i)) & 1 else -1.0 for b in range(bits)]
                                          for i in range(1, k)])
    bits, best, far = math.ceil(10 * math.log2(k)), None, -1
    for seed in range(draws):
        code = np.where((W.stream(700 + seed, k * bits) >> U(63)).reshape(k, bits) == 1, 1.0, -1.0)
        code = code[:, np.abs(code.sum(axis=0)) < k]          # a bit must split the languages
        gap = (code.shape[1] - code @ code.T) / 2 + np.eye(k) * bits
        if gap.min() > far:
            best, far = code, gap.min()
    return best


def _fit_bits(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Logistic regressions of all bits at once (Nesterov steps); (DIM + 1, bits)."""
    x1 = np.hstack([x, np.full((len(x), 1), 0.3, np.float32)])
    w = np.zeros((x1.shape[1], y.shape[1]), np.float32)
    last = w.copy()
    for i in range(rounds):
        ahead = w + (i / (i + 3)) * (w - last)
        m = x1 @ ahead
        g = -(x1.T @ (weight[:, None] * y / (1 + np.exp(np.clip(y * m, -30, 30))))) + 2e-5 * ahead
        last, w = w, ahead - 6.0 * g
    return w


def losses(margins: np.ndarray, code: np.ndarray, bit_weight: np.ndarray) -> np.ndarray:
    """(n, languages) weighted logistic losses; a bit's loss depends on its sign alone."""
    m = np.clip(margins, -30, 30)
    loss = (np.log1p(np.exp(-m)) * bit_weight) @ (code > 0).T + (np.log1p(np.exp(m)) * bit_weight) @ (code < 0).T
    return loss / bit_weight.sum()


class Model:
    """Codewords, bit classifiers, bit weights and temperature."""

    def __init__(self, langs: list[str], x: np.ndarray, y: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs)).astype(np.float32)
        target = self.code[y]
        held = np.zeros(len(x), bool)
        for c in range(len(langs)):
            held[np.flatnonzero(y == c)[::5][1:]] = True     # a fifth of each language, never its first row
        share = np.bincount(y[~held], minlength=len(langs))
        weight = (1.0 / (share[y[~held]] * len(langs))).astype(np.float32)
        self.w = _fit_bits(x[~held], target[~held], weight)
        m, t = self.margins(x), target
        part = held if held.any() else ~held
        wrong = ((np.sign(m[part]) != t[part]).sum(axis=0) + 0.5) / (part.sum() + 1.0)
        self.bit_weight = np.maximum(np.log((1 - wrong) / wrong), 0.05).astype(np.float32)
        loss, best = losses(m[part], self.code, self.bit_weight), None
        for temp in (1, 2, 4, 8, 16, 32):
            p = self._softmax(loss * temp)[np.arange(part.sum()), y[part]]
            fit = np.log(np.maximum(p, 1e-9)).mean()
            if best is None or fit > best:
                best, self.temperature = fit, temp

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w[:-1] + 0.3 * self.w[-1]

    @staticmethod
    def _softmax(loss: np.ndarray) -> np.ndarray:
        e = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number, its probability, ambiguous)."""
        p = self._softmax(losses(self.margins(x), self.code, self.bit_weight) * self.temperature)
        best = p.argmax(axis=1)
        score = p[np.arange(len(p)), best]
        return best, score, score < AMBIGUOUS


def _clean(texts: list) -> list[str]:
    return [(t or "").lower() for t in texts]


def _sample_features(batches):
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), _clean(batch.column(1).to_pylist())
        for start, part in pieces(texts):
            x = features(part)
            cells = [np.flatnonzero(r) for r in x]
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs[start:start + len(part)], pa.string()),
                 pa.array([c.astype(np.int16) for c in cells], pa.list_(pa.int16())),
                 pa.array([r[c] for r, c in zip(x, cells)], pa.list_(pa.float32()))], names=["lang", "cell", "value"])


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE) -> Model | None:
    """Fit on about ``sample`` of the labelled ``rows`` (null labels and ids ignored).

    Rows are drawn by a hash of id and text, and rows of one draw count once: neither
    an id nor a text that repeats without bound brings more than its share."""
    known = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    spread = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"), F.lit("langid")), F.lit(1 << 30))
    narrow = known.select(F.col(lang_col).cast("string").alias("_l"), spread.alias("_h"))
    first = (narrow.withColumn("_r", F.dense_rank().over(Window.partitionBy("_l").orderBy("_h")))
             .where(F.col("_r") <= LEAST).groupBy("_l").agg(F.max("_h").alias("least")))     # LEAST rows a task and language
    counts = narrow.groupBy("_l").count().join(first, "_l").orderBy("_l").collect()          # the class list
    if not counts:
        return None
    each = max(float(LEAST), sample / len(counts))
    rate = known.sparkSession.createDataFrame(
        [(r["_l"], max(int(min(1.0, each / r["count"]) * (1 << 30)), r["least"] + 1)) for r in counts], "_l string, _t bigint")
    picked = (known.select(F.col(lang_col).cast("string").alias("_l"), F.col(text_col).cast("string").alias("_x"),
                           spread.alias("_h"))
              .join(F.broadcast(rate), "_l").where("_h < _t"))   # one row a language
    picked = picked.groupBy("_l", "_h").agg(F.min("_x").alias("_x"))                          # the rows of one draw
    got = picked.select("_l", "_x").mapInArrow(_sample_features, "lang string, cell array<smallint>, "
                                               "value array<float>").toArrow()
    if not got.num_rows:
        return None
    langs = sorted(set(got.column("lang").to_pylist()))
    number = {name: i for i, name in enumerate(langs)}
    order = sorted(range(got.num_rows), key=lambda i: (got["lang"][i].as_py(), got["cell"][i].as_py()))
    x = np.zeros((len(order), DIM), np.float32)
    y = np.zeros(len(order), np.int64)
    for row, i in enumerate(order):                           # an order that task scheduling cannot change
        x[row, got["cell"][i].values.to_numpy()] = got["value"][i].values.to_numpy()
        y[row] = number[got["lang"][i].as_py()]
    return Model(langs, x, y)


def _predict(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            texts = _clean(batch.column(1).to_pylist())
            lang: list[str] = []
            score, unsure = [], []
            for _, part in pieces(texts):
                at = len(lang)
                has = [LETTER.search(t) is not None for t in texts[at:at + len(part)]]
                if model is None:
                    has = [False] * len(part)
                    best, p, close = [0] * len(part), [0.0] * len(part), [False] * len(part)
                else:
                    best, p, close = model.predict(features(part))
                lang += [model.langs[b] if ok else "und" for b, ok in zip(best, has)]
                score += [float(v) if ok else 0.0 for v, ok in zip(p, has)]
                unsure += [bool(c) or not ok for c, ok in zip(close, has)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in (0, 2)], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(unsure, pa.bool_())], names=["id", "held_out", "lang_pred", "score", "ambiguous"])
    return run


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """Learn from the rows that are not ``held_out`` and predict every row:
    ``id, held_out, lang_pred, score, ambiguous``."""
    model = train(docs.where(~held_out), id_col, text_col, lang_col, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.coalesce(held_out, F.lit(False)).alias("held_out"))
            .mapInArrow(_predict(shared), f"id {kind}, held_out boolean, lang_pred string, score double, "
                                          "ambiguous boolean")
            .withColumnRenamed("id", id_col))
