"""Label preparation for an image classifier, and the classifier itself.

The original flow pulls (id, genre) pairs to one machine, cuts index ranges
for download processes, downloads/copies posters into ``<genre>/<id>`` folders
and trains a single-machine network.  Here every data step is a Spark job:
ranges are a distributed row index, the fetch/copy plan is a group-min join,
the per-class validation split is a skew-safe per-label index, and the model
is Spark ML's multinomial logistic regression over feature vectors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import join_null_safe
from ..functions.order import draw_key, global_index
from ..functions.select import group_cuts, join_cuts, place


def label_pairs(movies: DataFrame, bridge: DataFrame, dim: DataFrame, n: int | None = None,
                key: str = "genre_id", name: str = "genre_name") -> DataFrame:
    """(imdb_id, genre): movie -> bridge -> dimension; the first n in
    (imdb_id, genre) order when n is given (a distributed top-n)."""
    out = (movies.select("id", "imdb_id")
           .join(bridge.select("movie_id", key), F.col("id") == F.col("movie_id"))
           .join(dim.select(key, name), key)
           .select("imdb_id", F.col(name).alias("genre")))
    if n is not None:
        out = out.orderBy("imdb_id", "genre").limit(n)
    return out


def assign_shards(pairs: DataFrame, parts: int, order=("imdb_id", "genre")) -> DataFrame:
    """Cut the rows (in ``order``) into ``parts`` contiguous ranges whose sizes
    differ by at most one, larger first (``ntile`` without a window or a sort): the
    rows at the range ends are found by counting, and every row compares itself with
    them.  Nothing is landed; see ``functions.select.cuts`` for how often ``pairs`` is
    evaluated while the plan is built."""
    total = pairs.count()
    ends = [end for _, end in balanced_ranges(total, parts)[:-1]]
    return place(pairs, list(order), ends, "shard", total)


def balanced_ranges(total: int, parts: int) -> list[tuple[int, int]]:
    """[start, end) index ranges of the same rule (for callers that need them)."""
    q, r = divmod(total, parts)
    sizes = [q + (1 if i < r else 0) for i in range(parts)]
    out, start = [], 0
    for s in sizes:
        out.append((start, start + s))
        start += s
    return out


def fetch_plan(sharded: DataFrame, root: str = "images", ext: str = "jpg") -> DataFrame:
    """Per shard and id: the first row (by genre) is fetched, every later genre
    copies that file, and a row that repeats a target is ``present`` already.
    (shard, imdb_id, genre, action, target, source).

    Equal rows are counted where they are read; the smallest genre of each (shard,
    id) is a map-side minimum joined back on that key, which is unique, and the counts
    are unfolded last.  So an id with a third of all rows is as many rows as it has
    genres wherever rows are moved."""
    def path(genre):
        return F.concat_ws("/", F.lit(root), genre, F.concat(F.col("imdb_id"), F.lit("." + ext)))

    rows = sharded.groupBy("shard", "imdb_id", "genre").agg(F.count(F.lit(1)).alias("_n"))
    # min ignores NULL, so NULL is first only where there is nothing else
    first = rows.groupBy("shard", "imdb_id").agg(F.min("genre").alias("_first"))
    j = join_null_safe(rows, first, ["shard", "imdb_id"])
    fetch = F.col("genre").eqNullSafe(F.col("_first"))
    j = j.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    again = F.col("_nth") > 1
    return j.select("shard", "imdb_id", "genre",
                    F.when(again, F.lit("present")).when(fetch, F.lit("fetch")).otherwise(F.lit("copy")).alias("action"),
                    path(F.col("genre")).alias("target"),
                    F.when(~fetch & ~again, path(F.col("_first"))).alias("source"))


def label_dictionary(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, label_index, n_items): one shared, sorted label index."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_items"))
    indexed = global_index(counts, [label], "_rn")
    return indexed.select(label, (F.col("_rn") - 1).cast("int").alias("label_index"), "n_items")


def train_validation_split(df: DataFrame, fraction: float = 0.3, label: str = "label", key: str = "id",
                           seed: int = 7) -> DataFrame:
    """Adds ``split``: per label, the first floor(fraction * n) rows in seeded
    order are 'validation', the rest 'train' — disjoint and complete.

    The draw at that rank is selected per label by a radix histogram
    (``functions.select.group_cuts``): no sort, no index, nothing landed, one lazy plan.
    Rows that repeat a key within a label fall on the same side."""
    keyed = df.withColumn("_draw", draw_key(seed, key))
    cuts = group_cuts(keyed, label, "_draw", F.floor(F.col("n") * F.lit(fraction)))
    out = join_cuts(keyed, cuts, label, "_draw")
    return out.select(*df.columns, F.when(F.col("_draw") <= F.col("cut"), "validation").otherwise("train").alias("split"))


def train_classifier(train: DataFrame, features: str = "features", label: str = "label",
                     max_iter: int = 10, reg: float = 0.0, tol: float = 1e-6, standardize: bool = True):
    """Multinomial logistic regression (softmax) with an iteration limit; ``reg`` is
    the ridge term's weight (on the features as they are if not ``standardize``)."""
    from pyspark.ml.classification import LogisticRegression
    lr = LogisticRegression(featuresCol=features, labelCol=label, family="multinomial",
                            maxIter=max_iter, regParam=reg, tol=tol, standardization=standardize)
    return lr.fit(train)


def fit_certificate(model, df: DataFrame, features: str = "features", label: str = "label", reg: float = 0.0,
                    shift: float = 1e-2) -> DataFrame:
    """One row that says how good a fit of ``train_classifier(standardize=False)`` is,
    from sums over the rows and not from the optimiser's own report:

    * ``rows``, ``labels``: rows summed, distinct labels among them;
    * ``objective``: mean loss (minus log of the label's probability) plus the ridge
      term; ``null_loss``: that of the best model without features (the entropy
      of the label shares), which any fit must beat;
    * ``gradient_norm``: length of the objective's gradient in all weights and
      intercepts; the objective is convex, so a fit is optimal where it is zero, and
      with a ridge term no better one exists beyond gradient_norm^2 / (2 * reg) below;
    * ``shifted_objective``: the objective after a step of ``shift`` along the gradient.

    Two aggregates over ``df`` with map-side sums; a row's gradient is the outer
    product of (probabilities - label) and its features, built inside the row."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    scored = model.transform(df).select(F.col(label).cast("int").alias("y"), vector_to_array(features).alias("x"),
                                        vector_to_array("probability").alias("p"))
    off = F.transform("p", lambda p, i: p - (F.col("y") == i).cast("double"))
    outer = F.flatten(F.transform(off, lambda e: F.transform(F.concat("x", F.array(F.lit(1.0))), lambda v: e * v)))
    loss = -F.log(F.element_at("p", F.col("y") + 1))
    sums = scored.select(array_to_vector(outer).alias("g"), loss.alias("loss"), "y").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("y").alias("labels"), F.avg("loss").alias("loss"))
    mean = scored.select(array_to_vector(outer).alias("g")).agg(Summarizer.mean(F.col("g")).alias("g")).first()["g"]
    weights = model.coefficientMatrix.toArray()
    k, w = weights.shape
    ridge = 0.5 * reg * float((weights ** 2).sum())
    gradient = mean.toArray().reshape(k, w + 1).copy()
    gradient[:, :w] += reg * weights
    norm = float((gradient ** 2).sum() ** 0.5)
    moved = weights - shift * gradient[:, :w] / max(norm, 1e-300)
    offset = model.interceptVector.toArray() - shift * gradient[:, w] / max(norm, 1e-300)
    logits = F.array(*[F.aggregate(F.zip_with("x", F.array(*[F.lit(float(v)) for v in row]), lambda a, b: a * b),
                                   F.lit(float(b)), lambda s, v: s + v) for row, b in zip(moved, offset)])
    top = F.array_max("z")
    shifted = scored.select("y", logits.alias("z")).select(
        (F.log(F.aggregate(F.transform("z", lambda v: F.exp(v - top)), F.lit(0.0), lambda s, v: s + v))
         + top - F.element_at("z", F.col("y") + 1)).alias("loss")).agg(F.avg("loss").alias("shifted"))
    shares = scored.groupBy("y").count()
    total = F.sum("count")
    entropy = shares.agg((F.log(total) - F.sum(F.col("count") * F.log("count")) / total).alias("null_loss"))
    shifted_loss = shifted.first()["shifted"] + 0.5 * reg * float((moved ** 2).sum())
    return sums.select("rows", "labels", (F.col("loss") + F.lit(ridge)).alias("objective"),
                       F.lit(entropy.first()["null_loss"]).alias("null_loss"), F.lit(norm).alias("gradient_norm"),
                       F.lit(shifted_loss).alias("shifted_objective"))


def to_features(df: DataFrame, array_col: str = "embedding", out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def evaluate(model, df: DataFrame, label: str = "label", group: str = "split") -> DataFrame:
    """(split, rows, accuracy) of the model on each part."""
    pred = model.transform(df)
    return pred.groupBy(group).agg(F.count(F.lit(1)).alias("rows"),
                                   F.avg((F.col("prediction") == F.col(label).cast("double")).cast("double"))
                                   .alias("accuracy"))


def rank_labels(model, df: DataFrame, key: str = "id", labels: DataFrame | None = None) -> DataFrame:
    """Per item every label with its probability, ranked (1 = predicted)."""
    from pyspark.ml.functions import vector_to_array
    # sorted inside the row: no exchange
    ordered = F.array_sort(F.transform(vector_to_array("probability"),
                                       lambda p, i: F.struct((-p).alias("p"), i.alias("i"))))
    ranked = (model.transform(df).select(key, F.posexplode(ordered).alias("_r", "_s"))
              .select(key, F.col("_s.i").alias("label_index"), (-F.col("_s.p")).alias("probability"),
                      (F.col("_r") + 1).alias("rank")))
    if labels is not None:
        ranked = ranked.join(labels, "label_index", "left")
    return ranked
