"""Classifier and label ranking on a separable set made in the test (the
driver's embeddings carry no learnable signal, so accuracy is not tested there)."""

from pyspark.sql import functions as F

from conftest import SF01
from lakemart.operators import labels as LB
from lakemart.plans import q_apps


def test_softmax_learns_a_separable_set(spark):
    df = spark.range(600).select(
        F.col("id"), (F.col("id") % 3).cast("int").alias("label"))
    df = df.withColumn("embedding", F.array(*[F.when(F.col("label") == k, F.lit(1.0) + F.rand(1) * 0.1)
                                              .otherwise(F.rand(2) * 0.1) for k in range(3)]))
    data = LB.to_features(LB.train_validation_split(df, 0.3, label="label", key="id", seed=3))
    model = LB.train_classifier(data.where("split = 'train'"), max_iter=50)
    acc = {r.split: r.accuracy for r in LB.evaluate(model, data).collect()}
    assert acc["validation"] > 0.95 and acc["train"] > 0.95
    ranked = LB.rank_labels(model, data.where("split = 'validation'"), key="id")
    per_item = ranked.groupBy("id").agg(F.sum("probability").alias("p"), F.count("*").alias("n"),
                                        F.min("rank").alias("r0"), F.max("rank").alias("r1")).collect()
    assert all(abs(r.p - 1.0) < 1e-6 and r.n == 3 and (r.r0, r.r1) == (1, 3) for r in per_item)


def test_registered_classifier_queries_have_expected_rows(spark):
    ev = q_apps.label_classifier(spark, SF01).collect()
    assert sorted(r.split for r in ev) == ["train", "validation"]
    assert q_apps.label_ranking(spark, SF01).count() == sum(r.rows for r in ev) * 10


def test_fetch_plan_fetches_once_per_shard_and_id(spark):
    plan = q_apps.label_fetch_plan(spark, SF01)
    assert plan.where("action = 'fetch'").count() == plan.select("shard", "imdb_id").distinct().count()
    copies = plan.where("action = 'copy'").where(F.col("source").isNull()).count()
    assert copies == 0
