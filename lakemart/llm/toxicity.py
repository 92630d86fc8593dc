"""Toxicity by weak supervision.

Many voters look at a text: fixed lexicons of insults, patterns of style
(shouting, piled-up exclamation marks) and word-stem patterns mined from the
labelled sample.  A generative label model (two classes, one vote table per voter,
fitted by expectation maximisation, the given label being one more noisy voter)
estimates the voters' accuracies; voters that agree beyond what the class explains
are correlated, and their evidence is discounted accordingly.  Its posterior
labels train a linear classifier over the voters' rates, which scores every text.

Training reads a bounded sample of labelled documents, chosen by a hash of the id:
at most about ``SAMPLE`` documents of each class.  Stem patterns are counted over
the whole sample by Spark; only the best ``MAX_PATTERNS`` reach the driver.
Scoring reads every whole text.

Defined results: null and empty texts get the score of a text that no voter
speaks up on; without any labelled row only the lexicons and style voters count.
Repeated labels of one id count as toxic if one of them does; null labels and ids
are ignored in training, and a null id is not held out.
"""

from __future__ import annotations

import re
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

# Insult lexicons (lower case, whole words).
LEXICONS = {
    "en_person": ("idiot idiots moron morons loser losers clown clowns scum imbecile cretin jerk bastard "
                  "bitch asshole dumbass fool coward parasite vermin").split(),
    "en_quality": ("stupid pathetic disgusting worthless dumb ugly useless filthy vile repulsive brainless "
                   "despicable revolting").split(),
    "en_object": "trash garbage filth crap shit fuck fucking damn".split(),
    "de": ("dummkopf trottel arschloch schlampe abschaum versager widerlich erbärmlich wertlos scheiße "
           "idioten vollidiot").split(),
    "fr": "imbécile connard connasse salope ordure pathétique dégoûtant minable merde abruti crétin".split(),
    "es": "idiota imbécil estúpido estúpida basura patético asqueroso mierda cabrón payaso escoria".split(),
}
STYLES = ("shouting", "exclamations", "symbols", "repetition")
SAMPLE = 4000
MAX_PATTERNS, MIN_DOCS = 240, 3
CANDIDATES = 4000
STEM = range(3, 9)
RATE = 4.0              # occurrences per 1000 words at which a voter speaks up
BETWEEN = re.compile(r"[\W\d_]+")
THRESHOLD = 0.7


def normalised(text: str) -> str:
    """Lower-case letters-only words, each with a space on both sides."""
    return f" {BETWEEN.sub(' ', text.lower()).strip()} "


def mine_counts(batches):
    """(pattern, class, documents) of the stems and words that a sample text uses at
    ``RATE`` or more (or at all, if it is short); summed per batch."""
    for batch in batches:
        out: Counter = Counter()
        n = Counter()
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = normalised(text or "").split()
            stems: Counter = Counter()
            for w, c in Counter(words).items():
                stems[f" {w} "] += c
                for k in STEM:
                    if k > len(w):
                        break
                    stems[f" {w[:k]}"] += c
            need = RATE * len(words) / 1000
            out.update((s, label) for s, c in stems.items() if c >= need)
            n[label] += 1
        rows = [(s, y, c) for (s, y), c in out.items()] + [("", y, c) for y, c in n.items()]
        cols = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()),
                                          pa.array(cols[2], pa.int64())], names=["pattern", "label", "docs"])


def mine(sample: DataFrame) -> list[str]:
    """Stem and word patterns that toxic sample texts use far more often."""
    counted = (sample.mapInArrow(mine_counts, "pattern string, label int, docs bigint").groupBy("pattern")
               .agg(F.sum(F.when(F.col("label") == 1, F.col("docs")).otherwise(0)).alias("bad"),
                    F.sum(F.when(F.col("label") == 0, F.col("docs")).otherwise(0)).alias("good")))
    size = counted.where("pattern = ''").first()
    if size is None or not size["bad"] or not size["good"]:
        return []
    nb, ng = size["bad"], size["good"]
    # log-likelihood ratio of the two document shares
    total = (F.col("bad") + F.col("good")) / (nb + ng)

    def part(k, n):
        return F.when(k > 0, k * F.log(k / (n * total))).otherwise(0.0) + \
            F.when(k < n, (n - k) * F.log((n - k) / (n * (1 - total)))).otherwise(0.0)
    best = (counted.where((F.col("pattern") != "") & (F.col("bad") >= MIN_DOCS)
                          & (F.col("bad") * ng > 3 * F.col("good") * nb)
                          & (F.col("bad") + F.col("good") < nb + ng))
            .withColumn("g", part(F.col("bad"), nb) + part(F.col("good"), ng)).where("g > 6")
            .orderBy(F.desc(F.round("g", 6)), "pattern").limit(CANDIDATES).collect())
    chosen: list[str] = []
    docs: dict[str, int] = {}
    for r in best:          # a longer or shorter form of a chosen stem says nothing new
        stem = r["pattern"].rstrip()
        kin = [c for c in chosen if c.rstrip().startswith(stem) or stem.startswith(c.rstrip())]
        if any(docs[c] * 0.6 <= r["bad"] <= docs[c] / 0.6 for c in kin):
            continue
        chosen.append(r["pattern"])
        docs[r["pattern"]] = r["bad"]
        if len(chosen) == MAX_PATTERNS:
            break
    return chosen


class Voters:
    """Rates of all voters for a text."""

    def __init__(self, patterns: list[str]):
        self.patterns = patterns
        self.names = [*LEXICONS, *patterns, *STYLES]
        groups: dict[str, list[int]] = {}
        for i, ws in enumerate(LEXICONS.values()):
            for w in ws:
                groups.setdefault(f" {w} ", []).append(i)
        for i, p in enumerate(patterns):
            groups.setdefault(p, []).append(len(LEXICONS) + i)
        self.groups = groups

    def automaton(self):
        found = ahocorasick.Automaton()
        for p, which in self.groups.items():
            found.add_word(p, tuple(which))
        found.make_automaton()
        return found

    def rates(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """((n, voters) occurrences per 1000 words, (n,) words); styles are 0 to 1000."""
        find = self.automaton()
        out = np.zeros((len(texts), len(self.names)), np.float32)
        size = np.zeros(len(texts))
        for i, t in enumerate(texts):
            if not t:
                continue
            words = normalised(t)
            n = size[i] = words.count(" ") - 1
            hits: Counter = Counter()
            for _, which in find.iter(words):
                hits.update(which)
            if n > 0:
                for v, c in hits.items():
                    out[i, v] = 1000.0 * c / n
            raw = len(t)
            out[i, -4:] = (1000.0 * (t.isupper()), min(1000.0, 1000.0 * t.count("!") / max(n, 1)),
                           min(1000.0, 1000.0 * sum(t.count(c) for c in "#$%&*") / max(raw, 1)),
                           self._repeats(words))
        return out, size

    @staticmethod
    def _repeats(words: str) -> float:
        ws = words.split()
        return 1000.0 * sum(map(str.__eq__, ws, ws[1:])) / max(len(ws), 1)

    def votes(self, rates: np.ndarray, size: np.ndarray) -> np.ndarray:
        """1 toxic, -1 clean, 0 abstains.  A content voter speaks up at ``RATE`` (one
        hit in a short text); a last voter calls texts clean that none speaks up on."""
        v = np.zeros((len(rates), rates.shape[1] + 1), np.int8)
        content = rates[:, :-4]
        v[:, :content.shape[1]] = content >= RATE
        v[:, content.shape[1]:-1] = rates[:, -4:] >= np.array([900.0, 300.0, 60.0, 500.0])
        v[:, -1] = np.where((content > 0).any(axis=1), 0, -1)
        return v


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """Posterior P(toxic) of each sample row, and the voters' evidence discounts.

    Vote tables P(vote | class) are fitted by expectation maximisation from the
    given labels.  After each round the voters' residual correlations inside the
    classes are measured, and a voter's evidence is divided by one plus its
    correlations, so that a clique of alike voters counts about once."""
    n, m = votes.shape
    post = np.where(labels > 0, 0.95, 0.05).astype(float)
    given = np.log(0.95 / 0.05) * np.where(labels > 0, 1.0, -1.0)
    spoken = np.stack([(votes == v) for v in (-1, 0, 1)], axis=2).astype(np.float32)
    discount = np.ones(m)
    for _ in range(rounds):
        share = [float(post.sum()) + 1.0, float((1 - post).sum()) + 1.0]
        bad = (np.einsum("n,nmv->mv", post, spoken) + 0.5) / (share[0] + 0.5)
        good = (np.einsum("n,nmv->mv", 1 - post, spoken) + 0.5) / (share[1] + 0.5)
        evidence = np.log(bad / good)
        resid = votes - (post[:, None] * (bad[:, 2] - bad[:, 0]) + (1 - post)[:, None] * (good[:, 2] - good[:, 0]))
        scale = np.sqrt((resid ** 2).mean(axis=0)) + 1e-6
        corr = (resid.T @ resid) / n / np.outer(scale, scale)
        np.fill_diagonal(corr, 0.0)
        discount = 1.0 / (1.0 + np.maximum(corr - 0.1, 0.0).sum(axis=1))
        logit = np.log(share[0] / share[1]) + given + np.einsum("nmv,mv,m->n", spoken, evidence, discount)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - post).max() < 1e-6:
            post = new
            break
        post = new
    return post, discount


def _inputs(rates: np.ndarray, votes: np.ndarray) -> np.ndarray:
    """Inputs of the linear classifier: damped rates, votes, and how much the
    lexicons and the mined patterns say together."""
    fixed = len(LEXICONS)
    sums = np.stack([rates[:, :fixed].sum(axis=1), rates[:, fixed:-4].sum(axis=1),
                     (votes[:, :-1] > 0).sum(axis=1)], axis=1)
    return np.hstack([np.log1p(np.minimum(rates, 60.0)) / 3.0, votes.astype(np.float32), np.log1p(sums)])


def fit_linear(x: np.ndarray, target: np.ndarray, rounds: int = 1500) -> np.ndarray:
    """Logistic regression on soft labels; the last weight is the bias."""
    x1 = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w = np.zeros(x1.shape[1])
    last = w.copy()
    step = 4.0 / max(1e-9, float(np.linalg.norm(x1, 2) ** 2) / len(x1))
    for i in range(rounds):
        ahead = w + (i / (i + 3)) * (w - last)
        p = 1 / (1 + np.exp(-np.clip(x1 @ ahead, -30, 30)))
        g = x1.T @ (p - target) / len(x1)
        g[:-1] += 2e-5 * ahead[:-1]
        last, w = w, ahead - step * g
    return w


class Model:
    def __init__(self, patterns: list[str], rates: np.ndarray, size: np.ndarray, labels: np.ndarray):
        self.voters = Voters(patterns)
        votes = self.voters.votes(rates, size)
        self.posterior, self.discount = label_model(votes, labels)
        self.weights = fit_linear(_inputs(rates, votes), self.posterior)

    def scores(self, texts: list) -> np.ndarray:
        rates, size = self.voters.rates(texts)
        x = _inputs(rates, self.voters.votes(rates, size))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


class LexiconModel:
    """Without labels: the share of lexicon hits, saturating."""

    def __init__(self):
        self.voters = Voters([])

    def scores(self, texts: list) -> np.ndarray:
        rates, _ = self.voters.rates(texts)
        return 1 - np.exp(-rates[:, :len(LEXICONS)].sum(axis=1) / 5.0)


def _sample_rates(voters: Voters):
    def run(batches):
        for batch in batches:
            rates, size = voters.rates(batch.column(1).to_pylist())
            cells = [np.flatnonzero(r) for r in rates]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array([c.astype(np.int32) for c in cells], pa.list_(pa.int32())),
                 pa.array([r[c] for r, c in zip(rates, cells)], pa.list_(pa.float32()))],
                names=["label", "size", "cell", "value"])
    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE):
    """Fit on a bounded sample of the labelled documents."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).cast("string").alias("_id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("_y")))
    count = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    if not count.get(0) or not count.get(1):
        return LexiconModel()
    rate = {y: int(min(1.0, sample / c) * (1 << 30)) for y, c in count.items()}
    draw = F.pmod(F.xxhash64("_id", F.lit("toxic")), F.lit(1 << 30))
    picked = known.where(draw < F.when(F.col("_y") == 1, rate[1]).otherwise(rate[0]))
    # about 2 * sample ids, and one text of each, however many rows repeat the id
    texts = (docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).cast("string").alias("_x"))
             .join(F.broadcast(picked), "_id").groupBy("_id", "_y").agg(F.min_by("_x", F.xxhash64("_x")).alias("_x"))
             .select("_y", "_x"))
    from .scratch import land
    texts, _ = land(texts, "toxic-sample")
    patterns = mine(texts)
    got = (texts.mapInArrow(_sample_rates(Voters(patterns)), "label int, size double, cell array<int>, "
                            "value array<float>").toArrow())
    if not got.num_rows:
        return LexiconModel()
    order = sorted(range(got.num_rows), key=lambda i: (got["label"][i].as_py(), got["size"][i].as_py(),
                                                       got["cell"][i].as_py(), got["value"][i].as_py()))
    rates = np.zeros((len(order), len(Voters(patterns).names)), np.float32)
    for row, i in enumerate(order):
        rates[row, got["cell"][i].values.to_numpy()] = got["value"][i].values.to_numpy()
    y = got["label"].to_numpy()[order]
    if y.min() == y.max():
        return LexiconModel()
    return Model(patterns, rates, got["size"].to_numpy()[order], y)


def _score(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            score = model.scores(batch.column(1).to_pylist()) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score.astype(float))], names=["id", "score"])
    return run


def score_documents(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shape = StructType([rows.schema["id"], StructField("score", DoubleType())])
    return rows.mapInArrow(_score(shared), shape).withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """``id, held_out, score, predicted`` of every row; ``held_out`` is an
    expression over the id that keeps rows out of training."""
    model = train(docs, labels.where(~held_out), id_col, text_col, label_col, sample)
    scored = score_documents(docs, model, id_col, text_col)
    return scored.select(id_col, F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _reject(shared, at, threshold):
    def run(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column(at).cast(pa.string()).to_pylist()
            yield batch.filter(pa.array(model.scores(texts) < threshold, pa.bool_())) if texts else batch
    return run


def reject_toxic(docs: DataFrame, model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more (same columns)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])         # whatever the names
    return plain.mapInArrow(_reject(shared, docs.columns.index(text_col), threshold), plain.schema).toDF(*docs.columns)
