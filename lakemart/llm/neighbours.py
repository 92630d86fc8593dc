"""Approximate nearest neighbours by cosine: stable projections in a kd-tree.

Unit vectors are projected on ``DIMS`` Gaussian (2-stable) directions: for two unit
vectors at distance ``d`` the squared projected distance is ``d * d`` times a
chi-square variable with ``DIMS`` degrees of freedom.  Projected neighbours are
taken by increasing projected distance ``r`` and verified on the original vectors,
until ``P(chi2 <= r * r / (dk * dk)) >= confidence`` for the k-th best distance
``dk`` found so far: a neighbour not yet seen would then be closer than ``dk`` with
a probability of at most ``1 - confidence``.

* *Classes.*  Equal vectors are one class with its ``k + 1`` smallest ids, which is
  all a result can name (ties go to smaller ids, a query leaves itself out).
* *Index.*  The upper levels of the kd-tree are fitted on at most ``SAMPLE``
  projected vectors (smallest hashes of the vector) and give at most ``MAX_CELLS``
  cells; every class is put into its cell, whose exact bounding box is kept.  A
  cell beyond ``block_rows`` classes is dealt by hash into blocks, each with its own
  tree, so a dense place cannot fill one task.
* *Search.*  First every query searches its own cell, which gives ``dk``; then it
  goes to the cells whose box lies within the stop radius of ``dk``, and each goes
  on from that ``dk``.  A task sees blocks one after the other, index rows before
  queries, so it holds one block and one batch of queries.
* Only the sample's projections and the boxes (numbers bounded by ``SAMPLE`` and
  ``MAX_CELLS``) come to the driver and go out to tasks.

``score`` is dot / (norm * norm) in double precision on the original vectors.

Defined results: a null id, and a null, empty or zero vector or one with null or
non-finite components takes no part; nor does one whose length is not the most
frequent one (ties: the longer); rows that repeat an id are candidates each, those
that repeat id and vector are one query; ids keep their type; fewer candidates than
``k`` give fewer rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StructField, StructType)

from .scratch import land

TOP, DIMS, CONFIDENCE, SEED = 5, 8, 0.95, 71
CELL_ROWS, MAX_CELLS, SAMPLE, LEAF = 2048, 4096, 65_536, 128
BLOCK_ROWS, BLOCK_BYTES = 32_768, 64 << 20
EPS = 1e-9


def chi2_cdf(x: float, m: int) -> float:
    """P(chi-square with ``m`` degrees of freedom <= x), by its power series."""
    if x <= 0:
        return 0.0
    a, y, term, total, n = m / 2, x / 2, 1.0, 1.0, 0
    while term > 1e-16 * total:
        n += 1
        term *= y / (a + n)
        total += term
    return min(1.0, total * math.exp(a * math.log(y) - y - math.lgamma(a + 1)))


def chi2_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1.0
    while chi2_cdf(high, m) < p and high < 1e6:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, m) < p else (low, mid)
    return high


def _matrix(column, width: int) -> np.ndarray:
    """Rows of an Arrow list column as doubles."""
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two (exact), so that squares neither over- nor underflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None]) if len(x) else x


def project(x: np.ndarray, dims: int, seed: int) -> np.ndarray:
    x = scaled(x)
    unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
    return unit @ np.random.default_rng(seed).standard_normal((x.shape[1], dims))


class Cells:
    """Upper levels of the kd-tree: a complete binary tree of median cuts."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.cut = np.zeros(2 ** depth, np.int64), np.zeros(2 ** depth)
        parts = {1: sample}
        for node in range(1, 2 ** depth):
            p = parts.pop(node)
            if len(p):
                self.axis[node] = np.argmax(p.max(axis=0) - p.min(axis=0))
                self.cut[node] = np.median(p[:, self.axis[node]])
            left = p[:, self.axis[node]] <= self.cut[node]
            parts[2 * node], parts[2 * node + 1] = p[left], p[~left]

    def locate(self, p: np.ndarray) -> np.ndarray:
        node, rows = np.ones(len(p), np.int64), np.arange(len(p))
        for _ in range(self.depth):
            node = 2 * node + (p[rows, self.axis[node]] > self.cut[node])
        return node - 2 ** self.depth


class Tree:
    """kd-tree of one block: points in leaf order, boxes of the leaves."""

    def __init__(self, x, p, ids, leaf: int = LEAF):
        todo, leaves = [np.arange(len(x))], []
        while todo:
            at = todo.pop()
            spread = p[at].max(axis=0) - p[at].min(axis=0)
            if len(at) <= leaf or not spread.max() > 0:
                leaves.append(at)
                continue
            half = np.argpartition(p[at, np.argmax(spread)], len(at) // 2)
            todo += [at[half[:len(at) // 2]], at[half[len(at) // 2:]]]
        order = np.concatenate(leaves)
        self.x, self.p = scaled(x[order]), p[order]
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        self.ids = [ids[i] for i in order]
        self.count = np.fromiter(map(len, self.ids), np.int64, len(order))
        self.stop = np.cumsum([len(a) for a in leaves])
        self.start = np.concatenate(([0], self.stop[:-1]))
        self.low = np.array([p[a].min(axis=0) for a in leaves])
        self.high = np.array([p[a].max(axis=0) for a in leaves])

    def nearest(self, own, q, pq, dk2: float, chi: float, k: int):
        """Up to ``k`` (score, id) of the block, best first; those beyond the
        caller's bound ``dk2`` (squared distance) may be missing."""
        q = scaled(q[None, :])[0]
        q_norm = math.sqrt((q * q).sum())
        gap = np.maximum(np.maximum(self.low - pq, pq - self.high), 0)
        box = (gap * gap).sum(axis=1)
        leaves = np.argsort(box, kind="stable")
        at, step, todo, dist = 0, 1, np.zeros(0, np.int64), np.zeros(0)
        best, score = np.zeros(0, np.int64), np.zeros(0)

        def weight(i, s):                                   # rows of a class that the result may name
            w = self.count[i].copy()
            for j in np.flatnonzero(s > 1 - 1e-6):
                if own in self.ids[i[j]] and (self.x[i[j]] == q).all():
                    w[j] -= 1
            return w

        while at < len(leaves) or len(todo):
            limit = chi * dk2 + EPS
            now = leaves[at:at + step]
            now = now[box[now] <= limit]
            if len(now):
                more = np.concatenate([np.arange(self.start[b], self.stop[b]) for b in now])
                far = self.p[more] - pq
                far = (far * far).sum(axis=1)
                keep = far <= limit
                todo, dist = np.concatenate((todo, more[keep])), np.concatenate((dist, far[keep]))
                at, step = at + len(now), step * 2
            else:
                at = len(leaves)
            reach = box[leaves[at]] if at < len(leaves) else math.inf
            ready = np.flatnonzero(dist <= reach)           # no unseen point is nearer in projection
            ready = ready[np.argsort(dist[ready], kind="stable")]
            a, size = 0, 64
            while a < len(ready) and dist[ready[a]] <= chi * dk2 + EPS:
                i = todo[ready[a:a + size]]
                s = (self.x[i] * q).sum(axis=1) / (self.norm[i] * q_norm)
                best, score = np.concatenate((best, i)), np.concatenate((score, s))
                if len(best) > k + 1:                       # one class may be the query alone
                    keep = score >= np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                    best, score = best[keep], score[keep]
                order = np.argsort(-score, kind="stable")
                enough = np.flatnonzero(np.cumsum(weight(best[order], score[order])) >= k)
                if len(enough):
                    dk2 = min(dk2, max(0.0, 2 - 2 * score[order[enough[0]]]))
                a, size = a + size, size * 2
            left = np.ones(len(todo), bool)
            left[ready] = False
            left &= dist <= chi * dk2 + EPS
            todo, dist = todo[left], dist[left]
        rows = []
        for i, s in zip(best.tolist(), score.tolist()):
            names = list(self.ids[i])
            if own in names and (self.x[i] == q).all():
                names.remove(own)
            rows += [(-s, n) for n in names]
        return [(-s, n) for s, n in sorted(rows)[:k]]


def _project(width, dims, seed, cells=None):
    """Adds ``p`` (and ``cell``) to rows that hold ``vec``."""
    def run(batches):
        for batch in batches:
            p = project(_matrix(batch.column("vec"), width), dims, seed)
            cols = [*batch.columns, pa.ListArray.from_arrays(
                pa.array(np.arange(len(p) + 1) * dims, pa.int32()), pa.array(p.reshape(-1), pa.float64()))]
            names = [*batch.schema.names, "p"]
            if cells is not None:
                cols, names = [*cols, pa.array(cells.locate(p), pa.int32())], [*names, "cell"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def _route(boxes, dims, chi):
    """(q, p, home, bound) -> (q, cell) for every other cell within the stop radius."""
    def run(batches):
        cell, low, high = boxes.value
        for batch in batches:
            p, bound = _matrix(batch.column("p"), dims), batch.column("bound").to_numpy(zero_copy_only=False)
            q, home = batch.column("q").to_numpy(), batch.column("cell").to_numpy()
            near = np.zeros((len(p), len(cell)))
            for j in range(dims):
                gap = np.maximum(np.maximum(low[None, :, j] - p[:, None, j], p[:, None, j] - high[None, :, j]), 0)
                near += gap * gap
            row, at = np.nonzero((near <= chi * bound[:, None] + EPS) & (cell[None, :] != home[:, None]))
            yield pa.RecordBatch.from_arrays([pa.array(q[row], pa.int64()), pa.array(cell[at], pa.int32())],
                                             names=["q", "cell"])
    return run


def _search(width, dims, chi, k):
    """Rows sorted by block, index before queries -> (q, id, score)."""
    def run(batches):
        block, parts, tree = None, [], None
        for batch in batches:
            key = batch.column("block").to_numpy()
            for piece in np.split(np.arange(len(key)), np.flatnonzero(np.diff(key)) + 1) if len(key) else []:
                if key[piece[0]] != block:
                    block, parts, tree = key[piece[0]], [], None
                rows = batch.slice(piece[0], len(piece))
                ask = rows.column("q").is_valid().to_numpy(zero_copy_only=False)
                n = int((~ask).sum())
                if n:
                    parts.append(rows.slice(0, n))
                if n == len(rows) or not parts:
                    continue
                if tree is None:
                    tree = Tree(np.concatenate([_matrix(r.column("vec"), width) for r in parts]),
                                np.concatenate([_matrix(r.column("p"), dims) for r in parts]),
                                [i for r in parts for i in r.column("ids").to_pylist()])
                rows = rows.slice(n)
                x, p = _matrix(rows.column("vec"), width), _matrix(rows.column("p"), dims)
                out = []
                for i, (q, own, bound) in enumerate(zip(rows.column("q").to_pylist(), rows.column("ids").to_pylist(),
                                                        rows.column("bound").to_pylist())):
                    out += [(q, name, s) for s, name in tree.nearest(own[0], x[i], p[i], bound, chi, k)]
                got = list(zip(*out)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[0], pa.int64()), pa.array(got[1], batch.schema.field("ids").type.value_type),
                     pa.array(got[2], pa.float64())], names=["q", "id", "score"])
    return run


def nearest(vectors: DataFrame, queries: Column, k: int = TOP, id_col: str = "vec_id", vec_col: str = "embedding",
            dims: int = DIMS, confidence: float = CONFIDENCE, seed: int = SEED, cell_rows: int = CELL_ROWS,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` nearest rows found for every row that ``queries`` selects:
    ``query_id``, ``rank``, ``vec_id``, ``score``."""
    spark = vectors.sparkSession
    sc = spark.sparkContext
    chi = chi2_quantile(confidence, dims)
    id_type = vectors.schema[id_col].dataType
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
                          F.coalesce(queries, F.lit(False)).alias("asks"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & fine & F.exists("vec", lambda x: x != 0))
    shape = rows.groupBy(F.size("vec").alias("w")).count().orderBy(F.col("count").desc(), F.col("w").desc()).first()
    width, total = (shape["w"], shape["count"]) if shape else (1, 0)
    rows = rows.where(F.size("vec") == width)

    hashed = F.pmod(F.xxhash64("vec"), F.lit(1 << 40))
    chosen = rows.where(hashed < int((1 << 40) * min(1.0, SAMPLE / max(total, 1)))).select("vec").distinct()
    chosen = chosen.orderBy(F.xxhash64("vec")).limit(SAMPLE)
    point = StructField("p", ArrayType(DoubleType()))
    vec = StructField("vec", ArrayType(DoubleType()))
    sample = chosen.mapInArrow(_project(width, dims, seed), StructType([vec, point])).select("p").collect()
    depth = max(0, math.ceil(math.log2(max(min(total / cell_rows, MAX_CELLS), 1))))
    cells = Cells(np.array([r["p"] for r in sample]).reshape(-1, dims), depth)

    first = Window.partitionBy("vec").orderBy("id")
    classes = (rows.select("id", "vec").withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
               .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    ids = StructField("ids", ArrayType(id_type))
    cell = StructField("cell", IntegerType())
    index, _ = land(classes.mapInArrow(_project(width, dims, seed, cells), StructType([vec, ids, point, cell])), "vectors")
    asked = rows.where("asks").select("vec", F.array("id").alias("ids")).distinct()
    asked = asked.mapInArrow(_project(width, dims, seed, cells), StructType([vec, ids, point, cell]))
    asked, _ = land(asked.withColumn("q", F.monotonically_increasing_id()), "vector-queries")

    boxes = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *[
        f(F.col("p")[j]).alias(f"{name}{j}") for name, f in (("low", F.min), ("high", F.max)) for j in range(dims)]).collect()
    limit = max(1, min(block_rows, BLOCK_BYTES // (8 * width)))
    parts = spark.createDataFrame([(r["cell"], -(-r["n"] // limit)) for r in boxes], "cell int, parts int")

    def block(part):
        return F.col("cell").cast("long") * F.lit(1 << 24) + part

    held = index.join(F.broadcast(parts), "cell").select(
        block(F.pmod(F.xxhash64("vec"), F.col("parts"))).alias("block"), "vec", "p", "ids",
        F.lit(None).cast("long").alias("q"), F.lit(None).cast("double").alias("bound"))
    found = StructType([StructField("q", LongType()), StructField("id", id_type), StructField("score", DoubleType())])
    n_blocks = sum(-(-r["n"] // limit) for r in boxes)
    tasks = max(1, min(n_blocks, max(2 * sc.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))))

    def visit(routed, name):
        at = routed.join(F.broadcast(parts), "cell").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        at = at.select(block(F.col("part")).alias("block"), "vec", "p", "ids", "q", "bound")
        both = held.unionByName(at).repartition(tasks, "block").sortWithinPartitions("block", F.col("q").asc_nulls_first())
        return land(both.mapInArrow(_search(width, dims, chi, k), found), name)[0]

    hits = visit(asked.withColumn("bound", F.lit(float("inf"))), "neighbours-home")
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id"))
    if len(boxes) > 1:
        kth = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select(
            "q", F.greatest(F.lit(0.0), 2 - 2 * F.col("score")).alias("bound"))
        asked = asked.join(kth, "q", "left").fillna({"bound": float("inf")})
        table = (np.array([r["cell"] for r in boxes]), *(np.array([[r[f"{n}{j}"] for j in range(dims)] for r in boxes])
                                                         for n in ("low", "high")))
        there = asked.select("q", "p", "cell", "bound").mapInArrow(_route(sc.broadcast(table), dims, chi), "q bigint, cell int")
        hits = hits.unionByName(visit(asked.drop("cell").join(there, "q"), "neighbours-far"))
    top = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = asked.select("q", F.col("ids")[0].alias("query_id"))
    return top.join(names, "q").select("query_id", "rank", F.col("id").alias("vec_id"), "score")
