"""Near-duplicate documents by SuperMinHash signatures, banding, exact
verification and connected components.

SuperMinHash walks, for every set element, one pseudo-random permutation of the
signature positions; step ``j`` offers the value ``j + r`` (``r`` in [0, 1)) to
the position the permutation names.  Since step ``j`` can never improve a
position below ``j``, a text stops as soon as its largest component is smaller
than the next step (early stopping): long texts take one or two steps, only very
short ones walk further.  All texts of a chunk walk together in numpy.

Steps of ``near_duplicates``:

1. one pass over the texts lands ``(id, set size, set hash, band keys)``;
2. documents with equal shingle sets are one node, read from their smallest id (exact
   copies never meet again), with map-side minima, so no group is collected;
3. in every band bucket each node is paired with the bucket's smallest node;
   pairs are verified on the full shingle sets, and links are contracted;
4. in buckets that still hold several components, pairs *between* components are
   verified too, unless the counts that both share with the bucket's smallest node
   already rule the similarity out (an exact bound).  The full sets are compared
   inside the join, so a bucket gives only its links and never its pairs, and a bucket
   of more than ``BLOCK`` nodes is dealt over triangle cells, which are the join key.  Every
   candidate pair is therefore verified, excluded or already connected, and no link between different
   texts is lost that the bands retrieve.

With 42 bands of 6 rows a pair of similarity 0.8 misses all bands with
probability 3e-6, one of 0.9 with 1e-14.  Texts that share one long passage
collide now and then at similarity 0.3; 128 one-bit components per node, compared
inside the join, drop those before a pair is made.  A pair of similarity 0.8
agrees in 115 of the 128 bits (deviation 3.4); 98 are asked for.

Defined results: null, empty or word-less texts have an empty set and link with
nothing.  Rows that repeat an id with different sets are different nodes; a
component is named by the smallest id of its rows.  A null id gets a null component
and is kept.  Input columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from . import words as W
from .components import components
from .scratch import drop, land, written
from .set_join import common_counts

BANDS, ROWS = 42, 6
#: one-bit components, and how many of them a candidate pair must share
BITS, AGREE = 128, 98
PERCENT = 80
#: candidate ids are broadcast up to this many (16 bytes each), joined by shuffle beyond
BROADCAST_IDS = 1_000_000
#: members of a bucket that are compared in one task with as many others
BLOCK = 512
U = np.uint64


def superminhash(doc: np.ndarray, h: np.ndarray, n: int, m: int, seed: int = 77) -> np.ndarray:
    """(n, m) signatures of the element sets given as (text, distinct hash) pairs.
    A component is ``step << 32 | r``; texts without elements keep the top value."""
    if m > 256:
        raise ValueError("at most 256 components")
    top = np.iinfo(np.uint64).max
    sig = np.full(n * m, top, U)
    state = W.mix(h ^ W.stream(seed, 1)[0])
    walk = None                 # permutations of the elements still walking
    k0 = None
    for j in range(m):
        if j:
            limit = U(j) << U(32)
            open_ = (sig.reshape(n, m).max(axis=1) >= limit)[doc]
            if not open_.all():
                doc, state, k0 = doc[open_], state[open_], k0[open_]
                walk = walk[open_] if walk is not None else None
            if not len(doc):
                break
            with np.errstate(over="ignore"):
                state = W.mix(state + U(0x9E3779B97F4A7C15))
        k = (j + (((state & U(0xFFFFFFFF)) * U(m - j)) >> U(32)).astype(np.int64))
        if j == 0:
            place, k0 = k, k
        else:
            rows = np.arange(len(doc))
            if walk is None:    # second step: Fisher-Yates state after the first swap
                walk = np.tile(np.arange(m, dtype=np.uint8), (len(doc), 1))
                walk[rows, 0], walk[rows, k0] = k0, 0
            place = walk[rows, k].astype(np.int64)
            walk[rows, k] = walk[:, j]
        np.minimum.at(sig, doc * m + place, (state >> U(32)) | (U(j) << U(32)))
    return sig.reshape(n, m)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n, bands) signed 64-bit bucket keys (band number mixed in)."""
    s = sig.reshape(len(sig), bands, rows)
    with np.errstate(over="ignore"):
        k = np.zeros(s.shape[:2], U)
        for r in range(rows):
            k = W.mix(k * U(31) + s[:, :, r])
        k = W.mix(k + W.stream(5, bands))
    return k.view(np.int64)


def sketch(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 one-bit components of each signature as two signed words."""
    bits = (W.mix(sig[:, :BITS]) >> U(63)).astype(np.uint8)
    words = np.ascontiguousarray(np.packbits(bits, axis=1)).view(np.int64)
    return words[:, 0], words[:, 1]


def _agree(a1, a2, b1, b2):
    """Shared one-bit components of two nodes (column names)."""
    differ = F.bit_count(F.col(a1).bitwiseXOR(F.col(b1))) + F.bit_count(F.col(a2).bitwiseXOR(F.col(b2)))
    return F.lit(BITS) - differ >= AGREE


def _profiles(shingle: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for start, part in W.chunks(texts):
                n = len(part)
                doc, h, size = W.distinct(*W.Words(part, W.BY_SPACE).shingles(shingle), n)
                sig = superminhash(doc, h, n, bands * rows)
                keys, bits = band_keys(sig, bands, rows), sketch(sig)
                flat = pa.array(keys.ravel())
                offsets = np.arange(0, (n + 1) * bands, bands, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, n), pa.array(size.astype(np.int64)),
                     pa.array(W.text_sums(doc, h, n, 1).view(np.int64)),
                     pa.array(W.text_sums(doc, h, n, 2).view(np.int64)),
                     pa.array(bits[0]), pa.array(bits[1]), pa.ListArray.from_arrays(pa.array(offsets), flat)],
                    names=["id", "n", "s1", "s2", "g1", "g2", "keys"])
    return run


def _sets(shingle: int):
    def run(batches):
        for batch in batches:
            for _, part in W.chunks(batch.column(1).to_pylist()):
                n = len(part)
                doc, h, size = W.distinct(*W.Words(part, W.BY_SPACE).shingles(shingle), n)
                offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(size.astype(np.int64)), pa.array(W.text_sums(doc, h, n, 1).view(np.int64)),
                     pa.array(W.text_sums(doc, h, n, 2).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))],
                    names=["n", "s1", "s2", "set"])
    return run


def _sets_of(nodes: DataFrame, texts: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """(node, set) of the given nodes; only the texts of their ids are read into sets."""
    nodes, _ = land(nodes.distinct().join(classes.select("node", "first"), "node"), "nodes")
    few = nodes.count() <= BROADCAST_IDS
    side = nodes.select(F.col("first").alias("id")).distinct()
    side = F.broadcast(side) if few else side.hint("shuffle_hash")
    sets = (texts.join(side, "id", "left_semi").select("id", "text")
            .mapInArrow(_sets(shingle), "n bigint, s1 bigint, s2 bigint, set array<bigint>")
            .where("n > 0").select(F.xxhash64("s1", "s2", "n").alias("node"), "set"))
    # an id may have other sets as well
    side = nodes.select("node")
    return land(sets.join(F.broadcast(side) if few else side, "node", "left_semi"), "sets")[0]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: ``id, n_shingles, component_id, kept`` (see the
    module docstring).  ``kept`` marks the row whose id is its component's.  What the
    steps write is dropped, but for the two tables the result reads."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    with written() as paths:
        out, needed = _near_duplicates(texts, shingle, percent, bands, rows)
        for path in [p for p in paths if p not in needed]:
            drop(spark, path)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("c").alias("component_id"), "kept")


def _near_duplicates(texts: DataFrame, shingle: int, percent: int, bands: int, rows: int) -> tuple[DataFrame, list[str]]:
    spark = texts.sparkSession
    profile, _ = land(texts.mapInArrow(_profiles(shingle, bands, rows), StructType(
        [StructField("id", texts.schema["id"].dataType), *[StructField(c, LongType()) for c in ("n", "s1", "s2", "g1", "g2")],
         StructField("keys", ArrayType(LongType()))])), "profiles")
    linkable = profile.where("n > 0 and id is not null")
    classes, _ = land(linkable.groupBy("s1", "s2", "n").agg(F.min("id").alias("first"))
                                 .withColumn("node", F.xxhash64("s1", "s2", "n")), "classes")

    # one row per node with its keys; a smallest id may repeat its set
    nodes, _ = land(linkable.join(classes, ["s1", "s2", "n"]).where("id = first")
                    .select("node", F.col("n").cast("int").alias("n"), "g1", "g2", "keys").dropDuplicates(["node"]), "node-keys")
    entries = nodes.select("node", "n", "g1", "g2", F.explode("keys").alias("key"))
    lead = F.min_by(F.struct("g1", "g2", "n"), "node")
    shared = (entries.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last"), lead.alias("l"))
              .where("leader < last").select("key", "leader", F.col("l.g1").alias("l1"), F.col("l.g2").alias("l2"), F.col("l.n").alias("ln")))
    members, members_path = land(entries.join(shared, "key"), "members")

    texts = texts.where("id is not null")
    near = (_agree("g1", "g2", "l1", "l2")
            & (F.least("n", "ln") * 100 >= F.greatest("n", "ln") * percent))
    stars, _ = land(members.where("node > leader").where(near)
                    .select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    ends = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node")))
    measured, _ = land(common_counts(stars, _sets_of(ends, texts, classes, shingle)), "measured")
    links = measured.where(F.col("c") * 100 >= (F.col("nx") + F.col("ny") - F.col("c")) * percent).select("a", "b").distinct()
    first, _ = land(components(links), "components")

    # what the stars left apart: pairs of one bucket in different components
    pivot = measured.groupBy(F.col("a").alias("leader"), F.col("b").alias("node")).agg(F.max("c").alias("i"))
    labelled = (members.join(first.select("node", "component"), "node", "left").join(pivot, ["leader", "node"], "left")
                .select("key", "node", "n", "g1", "g2", F.coalesce("component", "node").alias("c"),
                        F.when(F.col("node") == F.col("leader"), F.col("n")).otherwise(F.col("i")).alias("met")))
    labelled, labelled_path = land(labelled, "labelled")
    drop(spark, members_path)
    mixed = (labelled.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("size"))
             .where("lo < hi").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    rest, _ = land(labelled.join(mixed, "key"), "mixed")
    drop(spark, labelled_path)
    # what two sets can share at most, from what each shares with the bucket's smallest node
    most = F.coalesce(F.least("ia", "ib") + F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")), F.least("na", "nb"))
    most = F.when(F.col("ia").isNull() | F.col("ib").isNull(), F.least("na", "nb")).otherwise(F.least(most, "na", "nb"))
    open_pair = ((F.col("ca") != F.col("cb")) & _agree("a1", "a2", "b1", "b2")
                 & (most * 100 >= (F.col("na") + F.col("nb") - most) * percent))
    meet = (F.col("key") == F.col("k")) & (F.col("x") == F.col("i")) & (F.col("y") == F.col("j"))
    every = "sequence(0, blocks - 1)"
    open_, open_path = land(_cells(rest, "a", every).join(_cells(rest, "b", every), meet & (F.col("a") != F.col("b")) & open_pair, "left_semi")
                            .select("key", F.col("a").alias("node")).distinct(), "open")
    sets = _sets_of(open_.select("node"), texts, classes, shingle)
    full, full_path = land(rest.join(open_, ["key", "node"]).join(sets, "node"), "open-sets")
    drop(spark, open_path)
    shared = F.size(F.array_intersect("seta", "setb"))
    # the exact test is the join's last condition: only links leave a bucket, never its pairs
    more = _cells(full, "a", "sequence(own, blocks - 1)", "set").join(
        _cells(full, "b", "sequence(0, own)", "set"), meet & ((F.col("x") < F.col("y")) | (F.col("a") < F.col("b"))) & open_pair
        & (shared * 100 >= (F.size("seta") + F.size("setb") - shared) * percent)).select("a", "b").distinct()
    # the components so far stand for their links
    known = first.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    final, _ = land(components(known.unionByName(more)), "components")

    named, _ = land(classes.join(final, "node", "left")
                    .select("s1", "s2", "n", "first", F.coalesce("component", "node").alias("g")), "named")
    named, named_path = land(named.join(named.groupBy("g").agg(F.min("first").alias("c")), "g").select("s1", "s2", "n", "c"), "names")
    slim, slim_path = land(profile.select("id", "n", "s1", "s2"), "rows")
    out = slim.join(named, ["s1", "s2", "n"], "left").select(
        "id", "n", F.when(F.col("id").isNotNull(), F.coalesce("c", "id")).alias("c"),
        F.coalesce(F.coalesce("c", "id") == F.col("id"), F.lit(True)).alias("kept"))
    return out, [named_path, slim_path]


def _cells(rows: DataFrame, end: str, others: str, *more: str) -> DataFrame:
    """Members of the buckets as the ``a`` or ``b`` end of pairs, once per cell of their
    block with the blocks of ``others``.  A bucket of up to ``BLOCK`` members is one
    cell; a larger one spreads over its cells, which are the join key."""
    own = rows.withColumn("own", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
    own = own.withColumn("other", F.explode(F.expr(others)))
    x, y = ("own", "other") if end == "a" else ("other", "own")
    names = ("key", "x", "y") if end == "a" else ("k", "i", "j")
    return own.select(F.col("key").alias(names[0]), F.col(x).alias(names[1]), F.col(y).alias(names[2]), F.col("node").alias(end),
                      F.col("n").alias(f"n{end}"), F.col("c").alias(f"c{end}"), F.col("met").alias(f"i{end}"),
                      F.col("g1").alias(f"{end}1"), F.col("g2").alias(f"{end}2"), *[F.col(m).alias(f"{m}{end}") for m in more])
